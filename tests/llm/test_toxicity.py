import random

from pyspark.sql import functions as F

from kerbside.llm import toxicity as t


def plain_segments(values, n, rest):
    """Maximal scoring segments by their definition: the best one, then the same left and right of it."""
    scores = [rest] * n
    for i, s in values:
        scores[i] = s

    def split(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-9 or (abs(total - best[2]) <= 1e-9 and j + 1 - i < best[1] - best[0])):
                    best = (i, j + 1, total)
        return [] if best is None else split(a, best[0]) + [best] + split(best[1], b)

    return split(0, n)


def test_segments():
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randint(1, 25)
        values = sorted((i, rng.choice([3.1, 1.7, 0.9, -1.317])) for i in rng.sample(range(n), rng.randint(0, n)))
        got, want = t.segments(values, n, -0.3713), plain_segments(values, n, -0.3713)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want, strict=True))


def corpus(spark, documents):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(20, 200))]
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(["blorg", "snark", "vexed", "grunk"]) for _ in range(4)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1))
    rows += [(2000, None), (2001, ""), (2002, "BLORG!! snark, grunk "), (2002, "BLORG!! snark, grunk "), (None, "x"), (2003, "w1 " * 100_000)]
    labels += [(0, 1, 0), (5, None, 1), (None, 1, 1), (7777, 1, 1)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int, score int")


def test_held_out(spark, documents):
    found, labels = corpus(spark, documents)
    model = t.train(found, labels.where(F.col("doc_id") % 4 != 2))
    assert set(sorted(model.scores, key=model.scores.get)[-4:]) == {"blorg", "snark", "vexed", "grunk"}
    out = t.score(found, model).collect()
    assert len(out) == found.count() and all(0 <= r["score"] <= 1 for r in out)
    score = {r["doc_id"]: r["score"] for r in out}
    held = [i for i in range(900) if i % 4 == 2]
    assert sum((score[i] >= 0.3) == (i % 6 == 0) for i in held) >= 0.98 * len(held)
    assert score[2000] == score[2001] < 0.1 and score[2002] > 0.5 and score[2003] < 0.1
    passage = next(r for r in out if r["doc_id"] == 2002)
    assert (passage["n_segments"], passage["best_start"], passage["best_end"]) == (1, 0, 3)
    kept = t.reject(found, model, 0.3)
    assert kept.columns == found.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(repr(r["doc_id"]) for r in out if r["score"] < 0.3)


def test_many_texts_under_one_id(spark, documents):
    """The sample is bounded in texts, not in ids alone, and the same on each run."""
    rows = documents([(i % 2, f"text {i % 700} w{i % 5}") for i in range(2_000)])
    rows = rows.withColumn("label", F.col("doc_id").cast("int"))
    assert t._first(rows.limit(0), 50).count() == 0
    different = rows.dropDuplicates(["text", "label"])
    assert t._first(different, 10_000).count() == different.count() > 500
    some = [sorted(r["text"] for r in t._first(different.repartition(n), 50).collect()) for n in (1, 7)]
    assert some[0] == some[1] and len(some[0]) == 50
    labels = spark.createDataFrame([(0, 0, 1), (1, 1, 1)], "doc_id long, toxic int, score int")
    assert t.score(rows.limit(3), t.train(rows, labels, most_rows=20)).count() == 3


def test_nothing_to_learn(spark, documents):
    found, labels = corpus(spark, documents)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        model = t.train(found, some)
        assert not model.scores
        assert {r["score"] for r in t.score(found, model).collect()} == {0.0}
    assert t.score(found.limit(0), model).count() == 0
