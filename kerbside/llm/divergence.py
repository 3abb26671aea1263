"""Quality rules: how far a text's histograms lie from those of its language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.frames import map_chunks, words

#: Characters that count as symbols, fixed by the base rules.
SYMBOLS = "#*$%&|<>"
BLANKS = "\t\n\x0b\x0c\r "
#: Character classes of a histogram; UTF-8 continuation bytes count for none.
CLASSES = ("lower", "upper", "digit", "blank", "line end", "stop", "symbol", "other ASCII", "Latin letter", "other")
SKIP = len(CLASSES)


def _class_table() -> np.ndarray:
    kinds = np.full(256, CLASSES.index("other ASCII"))
    for b in range(256):
        c = chr(b)
        if "a" <= c <= "z":
            kinds[b] = 0
        elif "A" <= c <= "Z":
            kinds[b] = 1
        elif "0" <= c <= "9":
            kinds[b] = 2
        elif c == "\n":
            kinds[b] = 4
        elif c in BLANKS:
            kinds[b] = 3
        elif c in ".,;:!?":
            kinds[b] = 5
        elif c in SYMBOLS:
            kinds[b] = 6
        elif 0x80 <= b < 0xC0:
            kinds[b] = SKIP
        elif b in (0xC3, 0xC4, 0xC5):
            kinds[b] = 8
        elif b >= 0xC0:
            kinds[b] = 9
    return kinds


CLASS_OF = _class_table()


def class_counts(text: str) -> np.ndarray:
    return np.bincount(CLASS_OF[np.frombuffer(text.encode(), np.uint8)], minlength=SKIP + 1)[:SKIP]


@dataclass(frozen=True)
class Limits:
    """``least_words``, ``most_repeated``: base rules (count, percent). A word is common in a language
    from ``common`` of its words on. ``class_distance`` and ``word_distance`` are the largest distances
    of a good text; they hold from ``class_guard`` characters and ``word_guard`` words on, as short
    texts stray by chance."""

    least_words: int = 50
    most_repeated: int = 50
    common: float = 0.004
    class_distance: float = 0.25
    word_distance: float = 0.28
    class_guard: int = 200
    word_guard: int = 100


@dataclass
class References:
    """For each language its class shares, its common words and their shares, the rest last."""

    classes: dict[str, np.ndarray] = field(default_factory=dict)
    words: dict[str, list[bytes]] = field(default_factory=dict)
    shares: dict[str, np.ndarray] = field(default_factory=dict)


def _summaries(counters: int):
    """Misra-Gries summaries of a task's words by language: at most ``counters`` words each.

    An estimate is at most the true count and falls short of it by a share of 1 / ``counters``
    of the task's words at most.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        totals: dict[str, np.ndarray] = {}
        kept: dict[str, Counter] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    text, lang = text or "", lang or ""
                    totals[lang] = totals.get(lang, 0) + np.append(class_counts(text), 0)
                    own = words(text)
                    totals[lang][-1] += len(own)
                    kept.setdefault(lang, Counter()).update(own)
                for lang, counts in kept.items():
                    if len(counts) > 50 * counters:
                        kept[lang] = _shrunk(counts, counters)
        rows = [(lang, word, n) for lang, counts in kept.items() for word, n in _shrunk(counts, counters).items()]
        rows += [(lang, bytes([255, k]), int(n)) for lang, sums in totals.items() for k, n in enumerate(sums)]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())],
                ["lang", "word", "n"],
            )

    return run


def _shrunk(counts: Counter, counters: int) -> Counter:
    if len(counts) <= counters:
        return counts
    most = counts.most_common(counters + 1)
    cut = most[-1][1]
    return Counter({word: n - cut for word, n in most if n > cut})


def learn(documents: DataFrame, limits: Limits = Limits(), counters: int = 4096) -> References:
    """Class shares and common words of each language, counted over all documents.

    The common words are found exactly in two passes. Summaries of the tasks
    name every word that can reach the share ``common``: 1 / (common - 1 /
    counters) words a language at most, by the summaries' bound, so the lists
    that come to the driver and go out again are of bounded size, whatever the
    input. The second pass counts just these.
    """
    from kerbside.session import ship_package

    spark = documents.sparkSession
    ship_package(spark)
    told = documents.select("text", "lang").mapInArrow(_summaries(counters), "lang string, word binary, n long")
    told = told.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    is_total = (F.length("word") == 2) & (F.substring("word", 1, 1) == F.lit(b"\xff"))
    totals = told.where(is_total & (F.substring("word", 2, 1) == F.lit(bytes([SKIP])))).select(F.col("lang").alias("of"), F.col("n").alias("all_n"))
    likely = told.join(totals, F.col("lang") == F.col("of"), "left").where(
        is_total | (F.col("n") >= (limits.common - 1 / counters) * F.col("all_n"))
    )
    references, all_words, candidates = References(), {}, {}
    for lang, word, n in ((r["lang"], bytes(r["word"]), r["n"]) for r in likely.select("lang", "word", "n").collect()):
        if len(word) == 2 and word[0] == 255:
            if word[1] == SKIP:
                all_words[lang] = n
            else:
                references.classes.setdefault(lang, np.zeros(SKIP))[word[1]] = n
        else:
            candidates.setdefault(lang, set()).add(word)

    def counter():
        def count(texts, langs):
            found: dict[str, Counter] = {}
            for text, lang in zip(texts, langs, strict=True):
                lang = lang or ""
                wanted = candidates.get(lang, ())
                found.setdefault(lang, Counter()).update(w for w in words(text) if w in wanted)
            return [(lang, word, n) for lang, counts in found.items() for word, n in counts.items()]

        return count

    exact = map_chunks(documents, ["text", "lang"], counter, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    for row in exact.orderBy("lang", F.desc("n"), "word").collect():
        if row["n"] >= limits.common * all_words[row["lang"]]:
            references.words.setdefault(row["lang"], []).append(bytes(row["word"]))
            references.shares.setdefault(row["lang"], []).append(row["n"] / all_words[row["lang"]])
    for lang in references.classes:
        references.classes[lang] /= max(references.classes[lang].sum(), 1)
        shares = np.array(references.shares.get(lang, []))
        references.words.setdefault(lang, [])
        references.shares[lang] = np.append(shares, max(0.0, 1 - shares.sum()))
    return references


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance (root of the divergence in bits, 0 to 1) of each row of ``p`` from ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.maximum(0, (left + right) / 2))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    own = words(text)
    n = len(own)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return n, word_chars, symbols, len(lines) - len(set(lines)), _repeated(own)


def _repeated(own: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    n = len(own)
    if n < 4:
        return 0
    h = np.fromiter(map(hash, own), np.int64, n).view(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    key = h[:-2] * np.uint64(0xBF58476D1CE4E5B9) + (h[1:-1] ^ (h[1:-1] >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + h[2:]
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    for shift in range(3):
        twice[starts + shift] = True
    return int(twice.sum())


def judge(documents: DataFrame, references: References, limits: Limits = Limits(), key: str = "doc_id") -> DataFrame:
    """The base rules and the verdict for each whole text.

    ``key``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, class_distance, word_distance. A text that passes the
    base rules is kept if both histograms lie near those of one language: its
    own, or the nearest one where ``lang`` is null or unknown. A distance below
    its guard of length is null and counts as near; so it is without any
    reference. Null texts have no words. Rows stay as they are, repeated ones
    too; other columns are not read.
    """
    names = sorted(references.classes)
    index: dict[bytes, int] = {}
    for name in names:
        for word in references.words[name]:
            index.setdefault(word, len(index))
    places = {name: np.array([index[w] for w in references.words[name]], int) for name in names}
    kind = documents.schema[key].dataType.simpleString()

    def start():
        def verdicts(keys, texts, langs):
            texts = [t or "" for t in texts]
            base = [base_counts(t) for t in texts]
            counts = np.zeros((len(texts), max(len(index), 1)))
            classes = np.zeros((len(texts), SKIP))
            get = index.get
            for i, text in enumerate(texts):
                classes[i] = class_counts(text)
                hits = [at for at in map(get, words(text)) if at is not None]
                counts[i] = np.bincount(hits, minlength=counts.shape[1]) if hits else 0
            n_words = np.array([b[0] for b in base], float)
            of_class, of_word = {}, {}
            for name in names:
                of_class[name] = jensen_shannon(classes / np.maximum(classes.sum(axis=1, keepdims=True), 1), references.classes[name])
                own = counts[:, places[name]] / np.maximum(n_words, 1)[:, None]
                own = np.column_stack([own, np.maximum(0, 1 - own.sum(axis=1))])
                of_word[name] = jensen_shannon(own, references.shares[name])
            rows = []
            for i, (k, lang, b) in enumerate(zip(keys, langs, base, strict=True)):
                near = lang or ""
                if names and (not lang or near not in of_class):
                    near = min(names, key=lambda name: of_class[name][i] + of_word[name][i])
                c = float(of_class[near][i]) if names and len(texts[i]) >= limits.class_guard else None
                w = float(of_word[near][i]) if names and b[0] >= limits.word_guard else None
                failed = b[0] < limits.least_words or 100 * b[4] > limits.most_repeated * b[0]
                far = (c is not None and c > limits.class_distance) or (w is not None and w > limits.word_distance)
                rows.append((k, *b, failed, not failed and not far, c, w))
            return rows

        return verdicts

    return map_chunks(
        documents,
        [key, "text", "lang"],
        start,
        f"{key} {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, class_distance double, word_distance double",
    )
