import hashlib

from kerbside.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example_no string, n_turns string"
ODD = ["", None, "<turn user>x</turn>", "&lt;&amp;<", "a\nb", "é🙂 </turn", "\\n"]


def make(spark):
    rows = [(c, t, ["system", "user", "assistant"][(t + c) % 3], ODD[(c * 3 + t) % len(ODD)], "x", "y") for c in range(4) for t in range(6)]
    rows += [(9, 1, "assistant", "same", "x", "y"), (9, 1, "assistant", "same", "x", "y"), (9, None, None, None, None, None)]
    rows += [(10, 0, "user", "no reply", "x", "y"), (None, 0, "assistant", "z" * 300_000, "x", "y")]
    return spark.createDataFrame(rows, SCHEMA)


def plain(frame):
    turns = {}
    for r in frame.collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    return {c: [t[2:] for t in sorted(rows)] for c, rows in turns.items()}


def test_examples_and_digest(spark):
    frame = make(spark)
    want = plain(frame)
    examples = chat.expand(frame).collect()
    for c, turns in want.items():
        own = sorted((e for e in examples if e["conv_id"] == c), key=lambda e: e["example_no"])
        replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        assert [e["n_turns"] for e in own][: len(replies)] == [i + 1 for i in replies]
        assert own[-1]["n_turns"] == len(turns)
        for e, i in zip(own, replies, strict=False):
            masked = e["text"][e["loss_start"] : e["loss_start"] + e["loss_chars"]]
            assert masked.replace("&gt;", ">").replace("&lt;", "<").replace("&amp;", "&") == turns[i][1]
    for r in chat.digest(chat.expand(frame)).collect():
        turns = want[r["conv_id"]]
        told = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(e["text"]) for e in examples if e["conv_id"] == r["conv_id"])


def test_empty(spark):
    assert chat.digest(chat.expand(make(spark).limit(0))).count() == 0


def test_no_python_in_plan(spark):
    plan = chat.digest(chat.expand(make(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
