"""Near-duplicate documents: a chosen-path join on word shingles."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kerbside.llm.frames import map_rows, record_batch, stage, stage_counted, words
from kerbside.session import ship_package


@dataclass(frozen=True)
class Plan:
    """``shingle`` words make a token and ``similar`` is the least Jaccard similarity of a link.

    ``recall`` is the least share of such pairs found, wherever their buckets are
    split; sketches and runs may each lose half of the rest. A bucket of up to ``leaf`` sets is
    compared by brute force; a larger one is split on up to ``depth`` more
    tokens, then in blocks. ``rows`` and ``tokens`` bound a block of the exact comparison.
    """

    shingle: int = 5
    similar: float = 0.8
    recall: float = 0.999999
    leaf: int = 4096
    depth: int = 3
    rows: int = 1024
    tokens: int = 3_000_000
    seed: int = 9

    @property
    def runs(self) -> int:
        """A run keeps a pair if it shares the first sampled token and, at each of ``depth`` splits, one of two others."""
        once = self.similar * (1 - (1 - self.similar) ** 2) ** self.depth
        runs = math.ceil(math.log((1 - self.recall) / 2) / math.log(1 - once))
        if runs > SKETCH:
            raise ValueError(f"{runs} runs are more than the {SKETCH} places of a sketch: take a smaller depth or recall")
        return runs

    @property
    def least_equal(self) -> int:
        """Equal places of two sketches from which a pair is a candidate: the most that lose no more than their share."""
        least, lost = 0, 0.0
        while True:
            lost += math.comb(SKETCH, least) * self.similar**least * (1 - self.similar) ** (SKETCH - least)
            if lost > (1 - self.recall) / 2:
                return least
            least += 1


#: Places of a sketch; each holds the least token under one hash.
SKETCH = 128
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, _U), np.ones(1, _U)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_MULTIPLIERS = (_mix(np.arange(1, SKETCH + 1, dtype=_U) * _U(0xD1B54A32D192ED03)) >> _U(32)).astype(np.uint32) | np.uint32(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The set of a text's word shingles, as sorted 64-bit hashes.

    A text of fewer words is one shingle, one without words has none.
    """
    own = words(text)
    if not own:
        return np.zeros(0, _U)
    joined = np.frombuffer(b" ".join(own), np.uint8)
    up, down = _powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, _U)
    np.cumsum(_BYTE[joined] * up[: len(joined)], out=sums[1:])
    blanks = np.flatnonzero(joined == 32)
    starts, ends = np.append(0, blanks + 1), np.append(blanks, len(joined))
    if len(own) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    return np.unique(_mix((sums[ends] - sums[starts]) * down[starts]))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The least token under each hash: two sets agree in a place with the probability of their similarity."""
    low = (tokens >> _U(32)).astype(np.uint32)
    out = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 1024):
        np.minimum(out, (low[at : at + 1024, None] * _MULTIPLIERS).min(axis=0), out=out)
    return out


def _signed(x) -> int:
    return int(np.array(x, _U).view(np.int64))


def fingerprints(documents: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, text_hash, n (tokens), hash and check (of the token set), sketch; staged."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    hashed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def start():
        def row(doc_id, text_hash, text):
            tokens = shingles(text, plan.shingle)
            if not len(tokens):
                return [(doc_id, text_hash, 0, None, None, None)]
            ids = _mix(tokens).sum(dtype=_U), _mix(tokens ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)
            return [(doc_id, text_hash, len(tokens), _signed(ids[0]), _signed(ids[1]), sketch(tokens).tobytes())]

        return row

    schema = f"doc_id {kind}, text_hash long, n int, hash long, check long, sketch binary"
    return stage(map_rows(hashed, ["doc_id", "text_hash", "text"], start, schema), "fingerprints")


def map_groups(frame: DataFrame, keys: list[str], function: Callable[[tuple, list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """Run a function over the rows of each key, one group in memory at a time.

    For many small groups: rows are dealt and sorted by key, and a task cuts its
    rows where the key changes. Groups must be of bounded size.
    """
    ship_package(frame.sparkSession)
    kind = StructType.fromDDL(schema)
    arrow, n = to_arrow_schema(kind), len(keys)
    columns = [*keys, *(c for c in frame.columns if c not in keys)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True):
                    if row[:n] != key:
                        if rows:
                            out.extend(function(key, rows))
                        key, rows = row[:n], []
                        if len(out) >= 5000:
                            yield record_batch(out, arrow)
                            out = []
                    rows.append(row[n:])
        if rows:
            out.extend(function(key, rows))
        if out:
            yield record_batch(out, arrow)

    return frame.select(*columns).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, kind)


def _components(near: np.ndarray) -> np.ndarray:
    """The component of each row of a symmetric matrix of links, numbered by its first row."""
    label = np.full(len(near), -1)
    for first in range(len(near)):
        if label[first] >= 0:
            continue
        label[first] = first
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & (label < 0))
            label[front] = first
    return label


def _bucket(least: int) -> Callable[[tuple, list[tuple]], Iterable[tuple]]:
    """Compare all sketches of a bucket; a link from each set to the first of its candidates."""

    def run(_: tuple, rows: list[tuple]) -> Iterable[tuple]:
        by_id = dict(rows)
        if len(by_id) < 2:
            return
        ids = sorted(by_id)
        sketches = np.frombuffer(b"".join(by_id[i] for i in ids), np.uint32).reshape(len(ids), SKETCH)
        places = np.ascontiguousarray(sketches.T)
        near = np.zeros((len(ids), len(ids)), bool)
        step = max(1, 1_000_000 // len(ids))
        for at in range(0, len(ids), step):
            equal = np.zeros((min(step, len(ids) - at), len(ids)), np.uint8)
            for place in places:
                equal += place[at : at + step, None] == place[None, :]
            near[at : at + step] = equal >= least
        for i, first in enumerate(_components(near)):
            if first != i:
                yield ids[i], ids[first]

    return run


def _place(i: Column | int) -> Column:
    """One place of the sketch column."""
    return F.col("sketch").substr(F.lit(i) * 4 + 1 if isinstance(i, int) else i * 4 + 1, F.lit(4))


def candidates(sets: DataFrame, plan: Plan, most_sets: int) -> DataFrame:
    """Links (a, b) that hold every likely pair of sets together, by chosen paths.

    A run begins with a path of one sampled token: sets go to the bucket of what
    their sketch has in one place. A bucket that is too large is split again,
    by two different places that depend on its path; sets meet there if they share what
    is sampled. A bucket that stays too large after ``depth`` splits holds sets
    that are all alike: it is cut into blocks and every pair of blocks compared,
    so no limit drops a pair. ``sets`` has set_id and sketch, ``most_sets`` is how many there are at most.
    """
    order = np.random.Generator(np.random.PCG64(plan.seed)).permutation(SKETCH)
    first = [F.xxhash64(F.lit(plan.seed + run), _place(int(order[run]))) for run in range(plan.runs)]
    level = sets.select("set_id", F.explode(F.array(*first)).alias("key"))
    leaves: list[DataFrame] = []
    most = most_sets * plan.runs
    for depth in range(plan.depth + 1):
        shared = level.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
        above = F.coalesce(F.sum((F.col("c") > plan.leaf).cast("long")), F.lit(0)).alias("large")
        level, told = stage_counted(level.join(shared, "key"), f"paths{depth}", most, above)
        leaves.append(level.where(F.col("c") <= plan.leaf).select("set_id", "key"))
        large, most = level.where(F.col("c") > plan.leaf), 2 * told["large"]
        if not told["large"]:
            break
        if depth == plan.depth:
            blocks = F.ceil(F.col("c") / plan.leaf).cast("int")
            own = F.pmod(F.xxhash64("set_id", F.lit(plan.seed)), blocks).cast("int")
            pairs = large.select("set_id", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
            leaves.append(pairs.select("set_id", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key")))
            break
        split = []
        one = F.pmod(F.xxhash64("key", F.lit(0), F.lit(plan.seed)), F.lit(SKETCH)).cast("int")
        other = (one + 1 + F.pmod(F.xxhash64("key", F.lit(1), F.lit(plan.seed)), F.lit(SKETCH - 1)).cast("int")) % SKETCH
        for place in (one, other):
            split.append(F.xxhash64("key", place, _place(place)))
        level = large.join(sets.select("set_id", "sketch"), "set_id").select("set_id", F.explode(F.array(*split)).alias("key")).distinct()
    met = leaves[0]
    for more in leaves[1:]:
        met = met.unionByName(more)
    met = met.join(sets.select("set_id", "sketch"), "set_id").select("key", "set_id", "sketch")
    return map_groups(met, ["key"], _bucket(plan.least_equal), "a long, b long").distinct()


def connected(links: DataFrame, name: str, most_links: int, turns: int = 100) -> DataFrame:
    """node and root, the least node of its component, for every node with a link.

    Alternating stars: every node passes the least node it knows to its larger
    neighbours, then to its smaller ones, until nothing changes. Least nodes are
    found by aggregation, so a node with many links is no task of its own. A turn is one job, which
    also tells if anything has changed; there are ``most_links`` links at most. If
    it has not settled after ``turns``, it fails.
    """
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest")
    first = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, told = stage_counted(first, name, most_links, digest)
    for turn in range(turns):
        if not told["rows"]:
            break
        least = edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
        large = edges.join(least, F.col("b") == F.col("of"), "left").select("a", F.coalesce("m", "b").alias("b"))
        lower = large.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
        small = large.join(lower, F.col("a") == F.col("of")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = small.unionByName(lower.select(F.col("of").alias("a"), F.col("m").alias("b"))).distinct()
        before = told
        edges, told = stage_counted(new, f"{name}-{turn}", 2 * before["rows"], digest)
        if told == before:
            break
    else:
        raise RuntimeError(f"components of {name} have not settled after {turns} turns")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _compare(similar: float) -> Callable[[tuple, list[tuple]], Iterable[tuple]]:
    """Exact similarities of a group's sets: set_id, root, whether the family has several blocks, links to texts and to documents.

    A group is one block of a family or two. Shared tokens are counted by
    products of the sets' token matrices, some tokens at a time.
    """

    def run(key: tuple, rows: list[tuple]) -> Iterable[tuple]:
        _, one, two = key
        rows = sorted(rows, key=lambda r: r[0])
        ids, block = [r[0] for r in rows], np.array([r[1] for r in rows])
        docs = np.array([r[2] for r in rows])
        sets = [np.frombuffer(r[3], _U) for r in rows]
        sizes = np.array([len(s) for s in sets])
        m = len(ids)
        values, where = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(m), sizes)
        common = np.bincount(where, minlength=len(values)) > 1
        number = np.cumsum(common) - 1
        owner, where = owner[common[where]], number[where[common[where]]]
        order = np.argsort(where, kind="stable")
        owner, where = owner[order], where[order]
        shared = np.zeros((m, m), np.float32)
        step = max(1, 4_000_000 // m)
        for low in range(0, int(common.sum()), step):
            part = slice(*np.searchsorted(where, [low, low + step]))
            matrix = np.zeros((m, step), np.float32)
            matrix[owner[part], where[part] - low] = 1
            shared += matrix @ matrix.T
        both = sizes[:, None] + sizes[None, :] - shared
        linked = shared >= similar * both - 1e-6
        np.fill_diagonal(linked, False)
        if one != two:
            linked &= block[:, None] != block[None, :]
        texts, documents = linked.sum(axis=1), linked @ docs
        for i, first in enumerate(_components(linked)):
            yield ids[i], ids[first], rows[i][4], int(texts[i]), int(documents[i])

    return run


def in_blocks(members: DataFrame, plan: Plan) -> DataFrame:
    """``members`` (set_id, root, n and others) with parted, their block, ``own``, and those they may be linked into, ``low`` to ``high``.

    A family that exceeds ``plan.rows`` or ``plan.tokens`` is parted: cut by size, n tokens, and by a hash where
    sizes are equal, into blocks that hold about as much at most. Sets of a similarity s have sizes within a factor s of
    each other, so a set meets the blocks of such sizes alone. Which these are follows from counts by family and size.
    """
    large = (F.count(F.lit(1)) > plan.rows) | (F.sum("n") > plan.tokens)
    members = members.join(members.groupBy("root").agg(large.alias("parted")), "root")
    sizes = members.where("parted").groupBy(F.col("root").alias("__root"), F.col("n").alias("__n")).agg(F.count(F.lit(1)).alias("equal"))
    whole = plan.rows * plan.tokens  # a block; a set is the larger of its shares of both limits
    sizes = sizes.withColumn("share", F.greatest(F.lit(plan.tokens).cast("long"), F.col("__n") * F.lit(plan.rows).cast("long")))
    fine = 10**9  # ranges go over whole numbers
    far = math.ceil(-math.log(plan.similar) * fine) + 1000
    family = Window.partitionBy("__root").orderBy("__n")
    near = Window.partitionBy("__root").orderBy(F.floor(F.log("__n") * fine)).rangeBetween(-far, far)
    sizes = sizes.withColumn("after", F.sum(F.col("equal") * F.col("share")).over(family))
    sizes = sizes.withColumn("before", F.col("after") - F.col("equal") * F.col("share"))
    sizes = sizes.withColumns({"first": F.min("before").over(near), "last": F.max("after").over(near) - 1})
    placed = members.join(sizes, (F.col("root") == F.col("__root")) & (F.col("n") == F.col("__n")), "left")
    place = F.col("before") + F.pmod(F.xxhash64("set_id"), F.col("equal")) * F.col("share")
    block = lambda at: F.coalesce(F.floor(at / F.lit(whole)).cast("int"), F.lit(0))
    return placed.select(*members.columns, block(place).alias("own"), block(F.col("first")).alias("low"), block(F.col("last")).alias("high"))


def families(documents: DataFrame, sets: DataFrame, roots: DataFrame, plan: Plan) -> tuple[DataFrame, dict]:
    """set_id, root, parted, texts, docs: the exact links within each family of candidates; staged.

    A family goes to one group, or, if it is large, to one for each pair of its blocks that may have links
    (``in_blocks``): a set is a row for each block it meets.
    """
    members = roots.select(F.col("node").alias("set_id"), "root").join(sets.select("set_id", "hash", "n", "doc_id", "text_hash", "docs"), "set_id")
    place = ["parted", "own", "low", "high"]
    wanted = in_blocks(members, plan).select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__hash"), "set_id", "hash", "root", "docs", *place)
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    # by both, as an id may have many texts
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("text_hash") == F.col("__hash")))

    def start():
        def row(text, set_id, digest, root, docs, *place):
            tokens = shingles(text, plan.shingle)
            same = _signed(_mix(tokens).sum(dtype=_U)) == digest  # texts of one hash may differ
            return [(set_id, root, docs, *place, tokens.tobytes())] if same else []

        return row

    schema = "set_id long, root long, docs long, parted boolean, own int, low int, high int, tokens binary"
    tokens = map_rows(texts, ["text", "set_id", "hash", "root", "docs", *place], start, schema, chunk=200)
    dealt = tokens.withColumn("other", F.explode(F.sequence("low", "high"))).select(
        "root", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        "set_id", F.col("own").alias("block"), "docs", "tokens", "parted",
    )
    compared = map_groups(_once(dealt), ["root", "one", "two"], _compare(plan.similar), "set_id long, root long, parted boolean, texts long, docs long")
    found = stage(compared, "families")
    return found, found.agg(F.coalesce(F.sum(F.col("parted").cast("long")), F.lit(0)).alias("parted")).first().asDict()


def _once(dealt: DataFrame) -> DataFrame:
    """A set once in each group, also where its document comes in several equal rows."""
    return dealt.dropDuplicates(["root", "one", "two", "set_id"])


def join(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The near-duplicate class of each document.

    One row for each row: doc_id, text_hash, class_id, n_links, n_text_links, kept.
    Documents are linked if the Jaccard similarity of their sets of word
    shingles reaches ``plan.similar``; a class is what links hold together and
    class_id its least doc_id. ``n_links`` counts the linked documents, copies
    with equal sets among them, ``n_text_links`` the different sets linked.
    ``kept`` is true for one row of each class (equal rows may share it).

    Equal sets are one set from the first step on, so copies never meet in
    pairs. Distinct sets meet by chosen paths (``candidates``); likely pairs make families,
    and in these all pairs are compared exactly. Rows that carry links grow
    with the sets, not with the pairs.

    Words are cut at ASCII white space and compared as they are. Documents
    without words (null, empty, blank) are classes of their own, without links.
    Repeated rows are copies. A class whose ids are all null has a null class_id. Other columns are not read.
    """
    told = fingerprints(documents, plan)
    sets = told.where("n > 0").groupBy("hash", "check", "n")
    own = F.struct("doc_id", "text_hash")
    least = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), own)), F.min(own))  # a null id only if there is no other
    sets = sets.agg(least.alias("least"), F.count(F.lit(1)).alias("docs"), F.first("sketch").alias("sketch"))
    number = F.monotonically_increasing_id().alias("set_id")  # of its own for each set, fixed by being written
    sets, some = stage_counted(
        sets.select(number, "hash", "check", "n", "least.doc_id", "least.text_hash", "docs", "sketch"), "sets", told.count()
    )
    links, found = stage_counted(candidates(sets, plan, some["rows"]), "links", some["rows"] * plan.runs)
    roots, _ = stage_counted(connected(links, "candidates", found["rows"]), "roots", some["rows"])
    linked, parted = families(documents, sets, roots, plan)
    counts = linked.groupBy("set_id").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("linked_docs"))
    stars = linked.where("not parted").select(F.col("set_id").alias("node"), "root")
    if parted["parted"]:  # classes of one group are whole; others go on over groups
        over = linked.where("parted").select(F.col("set_id").alias("a"), F.col("root").alias("b"))
        stars = stars.unionByName(connected(over, "classes", parted["parted"]))
    own = sets.select("set_id", "hash", "check", "doc_id", "docs").join(stars.withColumnRenamed("node", "set_id"), "set_id", "left").join(counts, "set_id", "left")
    own = own.withColumn("root", F.coalesce("root", "set_id"))
    least = own.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    own = own.join(least, "root").select(
        F.col("hash").alias("__hash"), F.col("check").alias("__check"), "root", "class_id",
        (F.coalesce("linked_docs", F.lit(0)) + F.col("docs") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"),
    )
    same = (F.col("hash") == F.col("__hash")) & (F.col("check") == F.col("__check"))
    rows = told.select("doc_id", "text_hash", "n", "hash", "check").join(own, same, "left")
    # the row that stays: the least text_hash among those of the least doc_id
    best = rows.where("n > 0 and doc_id <=> class_id").groupBy(F.col("root").alias("best_root")).agg(F.min("text_hash").alias("best_hash"))
    return rows.join(best, F.col("root") == F.col("best_root"), "left").select(
        "doc_id",
        "text_hash",
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"),
        ((F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("best_hash")))).alias("kept"),
    )


def one_of_each(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The documents with one row of each near-duplicate class, all columns as they are."""
    kept = join(documents, plan).where("kept").select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__hash")).distinct()
    hashed = documents.withColumn("__own", F.xxhash64("text"))
    rows = hashed.join(kept, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__own") == F.col("__hash")), "left_semi")
    with_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return rows.where(with_words).dropDuplicates(["doc_id", "__own"]).unionByName(rows.where(~with_words)).select(*documents.columns)
