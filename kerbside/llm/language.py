"""Language identification by a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.frames import map_chunks, map_rows, stage

UNKNOWN = "und"


@dataclass(frozen=True)
class Network:
    """Filters over bytes (``filters[i]`` is width x 256 x n, with a bias each), and the softmax above their maxima.

    Byte 0 is padding: its weights are 0 and stay so.
    """

    langs: list[str]
    window: int
    filters: list[np.ndarray] = field(default_factory=list)
    bias: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    offset: np.ndarray | None = None


@dataclass(frozen=True)
class Plan:
    """What is learned from, and how.

    ``rows`` texts of each of the ``langs`` most frequent languages at most, ``windows`` windows of
    ``window`` bytes of each, evenly over the whole text: so much comes to the driver, never more.
    """

    rows: int = 400
    windows: int = 8
    langs: int = 200
    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


def windows_of(text: bytes, window: int) -> np.ndarray:
    """A text as rows of ``window`` bytes, the last one filled up with zeros."""
    n = max(1, -(-len(text) // window))
    out = np.zeros(n * window, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, window)


def sample(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """lang and window (bytes) of the texts to learn from.

    Different texts are chosen by a hash; of each language about as many as wanted by a
    share of their number, then exactly, so no language meets in one task. Null languages and texts
    without a letter are left out.
    """
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text")
    hashed = rows.withColumn("h", F.xxhash64("text", F.lit(plan.seed)))
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(plan.langs)
    share = F.lit(2.0 * plan.rows + 100) / F.col("n")  # twice as many as wanted, by chance hardly fewer than wanted
    drawn = hashed.join(F.broadcast(counts), "lang").where(F.pmod("h", F.lit(1 << 40)) < share * (1 << 40))
    drawn = drawn.groupBy("lang", "h").agg(F.min("text").alias("text"))
    first = Window.partitionBy("lang").orderBy("h", "text")
    drawn = drawn.withColumn("at", F.row_number().over(first)).where(F.col("at") <= plan.rows)

    def start():
        def row(lang, text):
            own = windows_of(text, plan.window)
            places = np.unique(np.linspace(0, len(own) - 1, plan.windows).astype(int))
            return [(lang, own[i].tobytes()) for i in places]

        return row

    drawn = drawn.select("lang", F.col("text").cast("binary").alias("text"))
    return map_rows(drawn, ["lang", "text"], start, "lang string, window binary", chunk=100)


def _convolve(net: Network, x: np.ndarray) -> Iterator[np.ndarray]:
    """Filter values (windows x places x n) of each width, all at the places that the widest has."""
    places = x.shape[1] - max(map(len, net.filters)) + 1
    for f, b in zip(net.filters, net.bias, strict=True):
        out = f[0][x[:, :places]]
        for k in range(1, len(f)):
            out += f[k][x[:, k : k + places]]
        yield out + b


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(pairs: list[tuple[str, bytes]], plan: Plan = Plan()) -> Network:
    """Train on (language, window) pairs by Adam on cross-entropy, the same for the same pairs in any order.

    The maximum of a filter passes its gradient to the bytes of one place only, so a step costs little.
    Without pairs nothing is learned; with one language everything is that language.
    """
    pairs = sorted(pairs)
    langs = sorted({lang for lang, _ in pairs})
    random = np.random.Generator(np.random.PCG64(plan.seed))
    n = len(plan.widths) * plan.filters
    net = Network(
        langs, plan.window,
        [random.normal(0, 0.1, (w, 256, plan.filters)).astype(np.float32) for w in plan.widths],
        [np.zeros(plan.filters, np.float32) for _ in plan.widths],
        random.normal(0, 0.3, (n, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32),
    )
    for f in net.filters:
        f[:, 0] = 0
    if len(langs) < 2:
        return net
    x = np.frombuffer(b"".join(w for _, w in pairs), np.uint8).reshape(len(pairs), plan.window)
    y = np.searchsorted(langs, [lang for lang, _ in pairs])
    values = [*net.filters, *net.bias, net.weights, net.offset]
    first, second, steps = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(plan.epochs):
        order = random.permutation(len(pairs))
        for at in range(0, len(pairs), plan.batch):
            rows = order[at : at + plan.batch]
            batch, who = x[rows], np.arange(len(rows))
            best, pooled = [], []
            for conv in _convolve(net, batch):
                place = conv.argmax(axis=1)
                best.append(place)
                pooled.append(np.take_along_axis(conv, place[:, None], 1)[:, 0])
            h = np.concatenate(pooled, axis=1)
            active = np.maximum(h, 0)
            delta = _softmax(active @ net.weights + net.offset)
            delta[who, y[rows]] -= 1
            delta /= len(rows)
            back = (delta @ net.weights.T) * (h > 0)
            grads = [np.zeros_like(f) for f in net.filters]
            own = [back[:, i * plan.filters : (i + 1) * plan.filters] for i in range(len(plan.widths))]
            for g, place, d in zip(grads, best, own, strict=True):
                for k in range(len(g)):
                    at_byte = batch[who[:, None], place + k].astype(np.int64) * plan.filters + np.arange(plan.filters)
                    g[k] = np.bincount(at_byte.ravel(), d.ravel(), 256 * plan.filters).reshape(256, -1)
                g[:, 0] = 0
            grads += [d.sum(axis=0) for d in own] + [active.T @ delta, delta.sum(axis=0)]
            steps += 1
            for v, g, a, b in zip(values, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= plan.rate * (a / (1 - 0.9**steps)) / (np.sqrt(b / (1 - 0.999**steps)) + 1e-8)
    return net


class Reader:
    """A network made fast: two bytes of a filter are one look-up in a table of byte pairs."""

    def __init__(self, net: Network) -> None:
        self.net = net
        pairs = [[(f[k][:, None] + f[k + 1][None, :]).reshape(65536, -1) for k in range(0, len(f) - 1, 2)] for f in net.filters]
        self.first = np.concatenate([p[0] for p in pairs], axis=1)  # of all widths in one
        self.later = [p[1:] for p in pairs]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each language, for each window, some windows at a time."""
        out, step = [], 128
        places = self.net.window - max(map(len, self.net.filters)) + 1
        for at in range(0, len(x), step):
            rows = x[at : at + step].astype(np.int64)
            two = rows[:, :-1] * 256 + rows[:, 1:]
            conv, low = self.first.take(two[:, :places], axis=0), 0
            for f, tables in zip(self.net.filters, self.later, strict=True):
                own = conv[:, :, low : low + f.shape[2]]
                for i, table in enumerate(tables, 1):
                    own += table.take(two[:, 2 * i : 2 * i + places], axis=0)
                if len(f) % 2:
                    own += f[-1].take(rows[:, len(f) - 1 : len(f) - 1 + places], axis=0)
                low += f.shape[2]
            h = np.maximum(conv.max(axis=1) + np.concatenate(self.net.bias), 0)
            out.append(_softmax(h @ self.net.weights + self.net.offset))
        return np.concatenate(out)


def train(documents: DataFrame, plan: Plan = Plan()) -> Network:
    """A network learned from a bounded sample of ``documents`` (``text``, ``lang``)."""
    return fit([(r["lang"], bytes(r["window"])) for r in stage(sample(documents, plan), "language-sample").collect()], plan)


def identify(documents: DataFrame, net: Network, key: str = "doc_id") -> DataFrame:
    """``key``, lang_pred and score of each whole text.

    A text is read in windows of fixed length; the probabilities of its windows are averaged, by their
    bytes. The score is the mean probability of the language named. Null texts and texts
    without a letter are ``und`` with score 0, as is everything if nothing was learned.
    Rows stay as they are, repeated ones too; lang, source and other columns are not read.
    """
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(
        F.col(key).alias("key"), F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary")).alias("text")
    )

    def start():
        reader = Reader(net)

        def chunk(keys, texts):
            out = []
            some, size = [], 0
            for k, text in zip(keys, texts, strict=True):
                if not text or not net.langs:
                    out.append((k, UNKNOWN, 0.0))
                    continue
                some.append((k, text))
                size += len(text)
                if size > 4_000_000:
                    out += judged(some)
                    some, size = [], 0
            return out + judged(some)

        def judged(some):
            if not some:
                return []
            windows = [windows_of(text, net.window) for _, text in some]
            counts = np.array([len(w) for w in windows])
            ends = np.cumsum(counts)
            sums = np.zeros((len(some), len(net.langs)))
            p = reader.probabilities(np.concatenate(windows)).astype(np.float64)
            last = np.array([len(t) - (c - 1) * net.window for (_, t), c in zip(some, counts, strict=True)]) / net.window
            p[ends - 1] *= last[:, None]
            sums = np.add.reduceat(p, ends - counts, axis=0)
            sums /= (counts - 1 + last)[:, None]
            best = sums.argmax(axis=1)
            return [(k, net.langs[b], min(float(s[b]), 1.0)) for (k, _), b, s in zip(some, best, sums, strict=True)]

        return chunk

    found = map_chunks(rows, ["key", "text"], start, f"key {kind}, lang_pred string, score double", chunk=500)
    return found.withColumnRenamed("key", key)
