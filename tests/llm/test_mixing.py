import os
import tempfile
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import mixing


def shares(sizes, weights=(1, 2, 3), most=3.0):
    """Targets by giving out and taking back in rounds; sizes in source order."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, capped = float(sum(sizes)), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        open_w = sum(w[i] for i in range(len(sizes)) if i not in capped)
        target = [most * s if i in capped else w[i] * left / open_w for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if target[i] > most * s}
        if not above:
            return target
        capped |= above


def corpus(documents, sizes, each=300):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for source, size in sizes.items():
        parts = rng.multinomial(size, np.ones(each) / each)
        for words in parts:
            rows.append((n, " ".join(["w"] * words) if words else None, "en", source))
            n += 1
    return documents(rows)


def test_targets_and_totals(spark, documents):
    sizes = {"a": 5000, "b": 300, "c": 40_000, "d": 10, "Z": 9000, "é": 700, None: 2000}
    found = corpus(documents, sizes)
    plan = mixing.mix(found, cell_rows=40, fan_in=3).toPandas()
    assert len(plan) == found.count()
    order = sorted((s for s in sizes if s), key=lambda s: [ord(c) for c in s]) + [None]
    want = dict(zip(order, shares([sizes[s] for s in order]), strict=True))
    for source, size in sizes.items():
        own = plan[plan.source.isna()] if source is None else plan[plan.source == source]
        assert (own["source_size"] == size).all()
        assert own["target"].iloc[0] == pytest.approx(want[source])
        assert abs(own["taken"].sum() - want[source]) <= own["size"].max()
    assert (plan["copies"] <= 3).all() and (plan["taken"] == plan["copies"] * plan["size"]).all()
    again = mixing.mix(found.repartition(5), cell_rows=40, fan_in=3).toPandas()
    key = lambda p: sorted(zip(p["doc_id"], p["copies"], strict=True))
    assert key(plan) == key(again)


def test_pivotal_keeps_sum_and_expectation():
    rng = np.random.Generator(np.random.PCG64(1))
    p, w = np.array([0.3, 0.6, 0.55, 0.2, 0.9]), np.array([5, 1, 30, 8, 2])
    runs = np.array([mixing.pivotal(p, w, rng) for _ in range(20_000)])
    assert np.allclose(runs @ w, p @ w)
    assert ((runs > 0) & (runs < 1)).sum(axis=1).max() <= 1
    assert np.abs(runs.mean(axis=0) - p).max() < 0.015


def test_odd_rows(documents):
    found = documents([(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (None, "c", "en", None), (4, "x " * 150_000, "en", "t")])
    plan = mixing.mix(found)
    assert plan.count() == 6 and plan.where("size = 0 and taken > 0").count() == 0
    mixed = mixing.apply_mix(found, plan)
    assert mixed.columns == found.columns
    want = {r["doc_id"]: r["n"] for r in plan.groupBy("doc_id").agg({"copies": "sum"}).withColumnRenamed("sum(copies)", "n").collect() if r["n"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want
    empty = found.limit(0)
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty, mixing.mix(empty)).count() == 0


@pytest.mark.parametrize("doc_id", [7, None])
def test_equal_rows_are_many_tasks(documents, doc_id):
    found = documents([(doc_id, "a b c", "en", "s")] * 2500 + [(100 + i, "d e " * (i % 5), "en", "s") for i in range(1000)] + [(9000, "f " * 4000, "en", "t")])
    plan = mixing.mix(found, cell_rows=50, fan_in=5)
    got = plan.toPandas()
    assert len(got) == 3501 and (got["doc_id"].isna().sum() if doc_id is None else (got["doc_id"] == doc_id).sum()) == 2500
    for _, own in got.groupby("source"):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= own["size"].max()
    again = mixing.mix(found.repartition(3), cell_rows=50, fan_in=5).toPandas()
    key = lambda p: sorted(zip(p["doc_id"].fillna(-1), p["copies"], strict=True))
    assert key(got) == key(again)
    mixed = mixing.apply_mix(found, plan)
    assert mixed.columns == found.columns and mixed.count() == got["copies"].sum()
    same = F.col("doc_id").eqNullSafe(F.lit(doc_id))
    assert mixed.where(same).count() == plan.where(same).agg(F.sum("copies")).first()[0] > mixing.MOST_COPIES


def test_cells_of_equal_rows_are_bounded(documents, monkeypatch):
    sizes, plain_round = [], mixing._round_cell
    folder = tempfile.mkdtemp(prefix="run-")

    def counting(*args):
        run = plain_round(*args)

        def counted(key, rows):
            open(f"{folder}/{len(rows)}-{uuid.uuid4()}", "w").close()
            return run(key, rows)

        return counted

    monkeypatch.setattr(mixing, "_round_cell", counting)
    mixing.mix(documents([(7, "a b c", "en", "s")] * 2000 + [(8, "d " * 9000, "en", "t")]), cell_rows=100).count()
    sizes = [int(name.split("-")[0]) for name in os.listdir(folder)]
    assert sum(sizes) >= 2000 and max(sizes) < 300
