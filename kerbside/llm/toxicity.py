"""Toxic passages as maximum-scoring segments of word log-odds."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.frames import map_chunks, map_rows, stage

TOKEN = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Model:
    """Word scores, the score of any other word, and the calibration.

    A segment of score s among n words is expected by chance in ``k n exp(-lam s)``
    places of clean text. A document's evidence is the sum, over its significant
    segments, of minus the logarithm of that number; ``slope`` and ``offset`` make it a probability.
    """

    scores: dict[str, float]
    rest: float
    lam: float
    k: float
    slope: float
    offset: float


def segments(values: list[tuple[int, float]], n: int, rest: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of n words: start, end (exclusive), score.

    ``values`` are the places and scores of the words that have one of their
    own; all others score ``rest`` (negative). One pass from left to right: each new
    candidate looks back for the nearest one whose left sum is lower, and either
    stands alone or takes in everything from there on, as each candidate is
    removed once at most.
    """
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    total, at = 0.0, 0
    for place, score in values:
        total += rest * (place - at)
        at = place + 1
        before, total = total, total + score
        if score <= 0:
            continue
        start, left = place, before
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= total:
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
            j -= 1
        found.append((start, place + 1, left, total))
    return [(start, end, right - left) for start, end, left, right in found]


def _hits(text: str, scores: dict[str, float]) -> tuple[list[tuple[int, float]], list[str]]:
    tokens = TOKEN.findall(text.lower())
    return [(i, s) for i, s in enumerate(map(scores.get, tokens)) if s is not None], tokens


def _significant(text: str, scores: dict[str, float], rest: float, lam: float, k: float) -> tuple[list[tuple[int, int, float]], int]:
    """Segments whose expected number by chance is below 1, with minus its logarithm; the words of the text."""
    hits, tokens = _hits(text, scores)
    if not hits:
        return [], len(tokens)
    own = [(a, b, lam * s - math.log(k * len(tokens))) for a, b, s in segments(hits, len(tokens), rest)]
    return [x for x in own if x[2] > 0], len(tokens)


def train(
    documents: DataFrame,
    labels: DataFrame,
    most_rows: int = 20_000,
    prior: float = 500.0,
    least_z: float = 3.5,
    least_odds: float = 1.0,
    most_words: int = 20_000,
) -> Model:
    """Learn a model from labelled documents (``doc_id``, ``toxic``).

    At most ``most_rows`` labelled documents are used, the first by a hash of
    their id; ids and labels of these come to the driver's side of a join, never more;
    of equal texts one counts. Where many documents share an id, the first
    ``most_rows`` texts by a hash are used, so the numbers that come to the
    driver, one row a text, are as many at most. A document with several labels is toxic if one of them says so; null
    labels are no labels. A word's log-odds between toxic and clean documents
    (each document counts a word once) have a Dirichlet prior, half a word and
    ``prior`` words spread as the words of both; it has a score of its own if they are
    ``least_z`` standard errors and ``least_odds`` away from 0. ``most_words``
    such words at most are kept, those of highest z. The extreme-value
    parameters come from the clean documents: ``lam`` from their word scores,
    ``k`` from their best segments by maximum likelihood.
    Without both labels nothing is learned and every score is the share of toxic rows, 0 if there is none.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # most_rows pairs of numbers at most
    rows = _first(stage(rows.dropDuplicates(["text", "label"]), "toxic-sample"), most_rows)

    def counter():
        def count(texts, marks):
            seen = (Counter(), Counter())
            sizes = [0, 0]
            for text, mark in zip(texts, marks, strict=True):
                own = set(TOKEN.findall((text or "").lower()))
                seen[mark].update(own)
                sizes[mark] += len(own)
            out = [(w, seen[0][w], seen[1][w], 0) for w in seen[0].keys() | seen[1].keys()]
            return [*out, ("", sizes[0], sizes[1], sum(marks)), (" ", 0, 0, len(marks))]

        return count

    counts = map_chunks(rows, ["text", "label"], counter, "word string, clean long, toxic long, n long").groupBy("word")
    counts = counts.agg(*(F.sum(c).alias(c) for c in ("clean", "toxic", "n")))
    sizes = {r["word"]: r for r in counts.where(F.col("word").isin("", " ")).collect()}
    if not sizes:
        return Model({}, -1.0, 1.0, 1.0, 0.0, -math.inf)
    n0, n1, n_toxic, n_rows = sizes[""]["clean"], sizes[""]["toxic"], sizes[""]["n"], sizes[" "]["n"]
    if not 0 < n_toxic < n_rows or not n0 or not n1:
        share = n_toxic / n_rows
        return Model({}, -1.0, 1.0, 1.0, 0.0, math.inf if share == 1 else -math.inf if share == 0 else math.log(share / (1 - share)))
    a = F.lit(0.5) + F.lit(prior) * (F.col("clean") + F.col("toxic")) / F.lit(float(n0 + n1))
    y0, y1 = F.col("clean") + a, F.col("toxic") + a
    odds = F.log(y1 / F.lit(n1 + prior)) - F.log(y0 / F.lit(n0 + prior))
    scored = (
        counts.where(~F.col("word").isin("", " ") & (F.col("clean") + F.col("toxic") >= 5))
        .select("word", y0.alias("y0"), y1.alias("y1"), odds.alias("odds"), (F.abs(odds) / F.sqrt(1 / y0 + 1 / y1)).alias("z"))
        .where((F.col("z") >= least_z) & (F.abs("odds") >= least_odds))
        .orderBy(F.desc("z"), "word")
        .limit(most_words)
        .collect()
    )
    scores = {r["word"]: r["odds"] for r in scored}
    q0 = sum(r["y0"] for r in scored) / (n0 + prior)
    q1 = sum(r["y1"] for r in scored) / (n1 + prior)
    rest = min(math.log((1 - q1) / (1 - q0)), -1e-3)
    shares = [(r["y0"] / (n0 + prior), r["odds"]) for r in scored]
    lam = _lambda([*shares, (1 - q0, rest)])
    best = map_rows(rows, ["text", "label"], lambda: lambda t, y: [_best(t or "", y, scores, rest)], "label int, n long, best double").collect()
    clean = [(r["n"], r["best"]) for r in best if not r["label"]]
    k = max(sum(m > 0 for _, m in clean), 1) / max(sum(n * math.exp(-lam * m) for n, m in clean), 1.0)

    def evidence():
        return lambda t, y: [(y, float(sum(x[2] for x in _significant(t or "", scores, rest, lam, k)[0])))]

    pairs = map_rows(rows, ["text", "label"], evidence, "label int, evidence double").collect()
    slope, offset = _logistic(np.array([p["evidence"] for p in pairs]), np.array([p["label"] for p in pairs], float))
    return Model(scores, rest, lam, k, slope, offset)


def _first(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of different rows by a hash of their text and label; only hashes are sorted."""
    order = F.xxhash64("text", "label")
    last = rows.select(order.alias("hash")).orderBy("hash").limit(most).agg(F.max("hash").alias("last")).first()["last"]
    return rows if last is None else rows.where(order <= F.lit(last))


def _best(text: str, label: int, scores: dict[str, float], rest: float) -> tuple[int, int, float]:
    hits, tokens = _hits(text, scores)
    return label, len(tokens), max((s for _, _, s in segments(hits, len(tokens), rest)), default=0.0)


def _lambda(shares: list[tuple[float, float]]) -> float:
    """The positive root of sum(share * exp(lam * score)) = 1."""
    excess = lambda x: math.log(sum(p * math.exp(x * s) for p, s in shares))
    if not any(s > 0 for _, s in shares) or sum(p * s for p, s in shares) >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a logistic curve, on the logarithm of 1 + x, by Newton's method."""
    f = np.column_stack([np.log1p(x), np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        gradient = f.T @ (p - y) + ridge * w
        step = np.linalg.solve((f * (p * (1 - p))[:, None]).T @ f + ridge * np.eye(2), gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def probability(model: Model, evidence: float) -> float:
    x = model.offset + model.slope * math.log1p(evidence)
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def score(documents: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key``, score (0 to 1), n_segments, best_start and best_end of each whole text.

    The last two are the words of the most significant passage, null if there
    is none. Empty and null texts have the score of a text without evidence.
    Rows stay as they are, repeated ones too; other columns are not read.
    """
    kind = documents.schema[key].dataType.simpleString()

    def start():
        def row(k, text):
            own, _ = _significant(text or "", model.scores, model.rest, model.lam, model.k)
            top = max(own, key=lambda s: (s[2], -s[0]), default=(None, None, 0.0))
            return [(k, probability(model, sum(s[2] for s in own)), len(own), top[0], top[1])]

        return row

    return map_rows(documents, [key, "text"], start, f"{key} {kind}, score double, n_segments long, best_start long, best_end long")


def reject(documents: DataFrame, model: Model, score_from: float) -> DataFrame:
    """The documents whose score stays below ``score_from``, all columns and rows as they are."""
    columns = documents.columns
    at = columns.index("text")

    def start():
        def chunk(*lists):
            rows = zip(*lists, strict=True)
            return [r for r in rows if probability(model, sum(s[2] for s in _evidence(r[at], model))) < score_from]

        return chunk

    return map_chunks(documents, [f"`{c}`" for c in columns], start, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema))


def _evidence(text: str | None, model: Model) -> list[tuple[int, int, float]]:
    return _significant(text or "", model.scores, model.rest, model.lam, model.k)[0]
