import hashlib
import itertools
import random
import re

import duckdb
import pytest

from checks.compare import differences
from kerbside.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, fault int, pos long, block int"


def plain_walk(codes):
    """Cost and ASCII-least audit by trying all edits in order of cost."""
    ok = re.compile(r"(s?(ua)+)?")
    best = None
    # at most one pair of inserts before each row is ever useful, and two at the end
    for edits in itertools.product(*["DKua" for _ in codes]):
        for inserts in itertools.product(["", "u", "a", "ua", "au"], repeat=len(codes) + 1):
            cost, audit, roles = 0, "", ""
            for i in range(len(codes) + 1):
                cost += 3 * len(inserts[i])
                audit += "I" * len(inserts[i])
                roles += inserts[i]
                if i == len(codes):
                    break
                code, edit = codes[i], edits[i]
                if edit == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                if code == "d":
                    cost = None
                    break
                cost += 3 if code.isupper() else 0
                cost, audit, roles = (cost, audit + "K", roles + code.lower()) if edit == "K" else (cost + 3, audit + "R", roles + edit)
            if cost is not None and ok.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_walks_are_cheapest_and_least():
    rng = random.Random(1)
    cases = ["", "s", "u", "a", "d", "x", "sua", "uaua", "aus", "SUA"] + ["".join(rng.choice("suaaudSUAx") for _ in range(rng.choice([2, 3, 3]))) for _ in range(60)]
    for codes in cases:
        costs = repair.END
        for code in reversed(codes):
            costs = repair.back(costs, code)
        audit, state = repair.walk(codes, repair.END, 0, True)
        assert (costs[0], audit) == plain_walk(codes), codes
        assert repair.END[state] == 0


def test_blocks_and_matrices_agree_with_one_walk():
    rng = random.Random(2)
    for n in [1, 2, 7, 40, 300]:
        codes = "".join(rng.choice("suaudaSUAx") for _ in range(n))
        whole, end = repair.walk(codes, repair.END, 0, True)
        size = rng.choice([1, 3, 17])
        parts = [codes[i : i + size] for i in range(0, n, size)]
        rows = [(i, p, [c for costs in repair.matrix(p) for c in costs]) for i, p in enumerate(parts)]
        told = {r[1]: (r[2], r[4]) for r in repair._checkpoints(("c",), rows)}
        audit, state = "", 0
        for i, p in enumerate(parts):
            more, state = repair.walk(p, tuple(told[i][0]), state, told[i][1])
            audit += more
        assert (audit, state) == (whole, end)


def test_long_walks_store_checkpoints_only(monkeypatch):
    """Twice the vectors of one pass, and no more than about two square roots of them at once."""
    made, back = [0], repair.back

    def counting(costs, code):
        made[0] += 1
        return back(costs, code)

    monkeypatch.setattr(repair, "back", counting)
    audit, _ = repair.walk("ua" * 5000, repair.END, 0, True)
    assert audit == "K" * 10_000 and made[0] == 20_000


def conversations(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(60):
        for turn in range(rng.choice([1, 2, 5, 9, 14])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["a.", "b!", "c", "", None, " \n", f"Text {turn}.", "ends. ", "x.y"])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, text, 1, 1, 1))
    rows += [(None, 0, "user", "null id.", 0, 0, 0), (None, 1, "assistant", "yes.", 0, 0, 0), (None, None, None, None, 0, 0, 0)]
    rows += [(70, 3, "user", "same.", 0, 0, 0)] * 4
    rows += [(71, t, ("user", "assistant")[t % 2], f"turn {t}.", 0, 0, 0) for t in range(700)]
    rows += [(72, 0, "user", "long " * 100_000 + ".", 0, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("block", [2, 5, 4096])
def test_against_sql(spark, block):
    """Nulls, ties, repeated rows, a long conversation; also in blocks so small that most have several."""
    frame = conversations(spark).repartition(3)
    con = duckdb.connect()
    con.register("given", frame.select("conv_id", "turn", "role", "text").toArrow())
    con.execute("CREATE TABLE conversations AS SELECT * FROM given")
    got = repair.repair(repair.damage(frame), frame, block)
    assert differences(got, con, queries.OP12_SQL) == []


def test_results(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 4, "assistant", "No."), (2, 0, "user", " "), (3, 0, "user", "cut")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, copy int")
    out = {r["conv_id"]: r for r in repair.repair(frame, frame).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out[1][1:] == (2, 0, 0, 0, 1, 3, "KKIK", digest("user:Hi.\nassistant:Yes.\nuser:\nassistant:No."))
    assert out[2][1:] == (0, 1, 0, 0, 0, 4, "D", digest(""))
    assert out[3][1:] == (0, 0, 0, 1, 0, 4, "D", digest(""))
    gone = repair.repair(frame.limit(0), frame).collect()
    assert {r[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", digest(""))} and len(gone) == 3
    assert repair.repair(frame.limit(0), frame.limit(0)).count() == 0
