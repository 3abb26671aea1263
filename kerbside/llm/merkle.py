"""A Merkle manifest of a table: one tree for each language, one above them.

Trees are built by time-forward processing. Nodes are labelled by the last leaf below
them, then by level, so children come before parents. A queue ordered by label
holds what children send to their parents; the sweep takes the least label, makes that node's digest
of what has arrived, and sends it on. The reversed sweep sends every node what its leaves need
to reach the root: the rest of their proof.

A tree of any size is swept in blocks of leaves, one Spark group each; the messages that
leave a block are rows, sorted and spilled by Spark's shuffle, which is the queue between blocks.
Inside a block the queue holds a few messages for each level, as labels finish whole subtrees first.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.frames import sha256, stage
from kerbside.llm.ranks import ranked
from kerbside.llm.similarity import map_groups

#: Levels of a block: 4,096 leaves.
LEVELS = 12


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """The digest of a row's values, each with its length, so that no two rows read alike."""
    return F.sha2(F.concat(*(_field(c) for c in columns)), 256)


def levels_of(n: int) -> int:
    """Levels above n leaves until one node is left."""
    return max(n - 1, 0).bit_length()


def forward(leaves: list[str], levels: int) -> dict[tuple[int, int], str]:
    """Digests of all nodes (level, index) of the ``levels`` levels above some leaves.

    A queue entry is (label, child, digest); a node that gets one message has one child.
    """
    n, queue, digests = len(leaves), [], {}
    for i, own in enumerate(leaves):
        heapq.heappush(queue, ((i, 0, i), i, own))
        while queue and queue[0][0][0] <= i:  # nodes whose last leaf has been read
            label, _, told = heapq.heappop(queue)
            parts = [told]
            while queue and queue[0][0] == label:
                parts.append(heapq.heappop(queue)[2])
            _, level, index = label
            digest = digests[level, index] = sha256("".join(parts)) if level else told
            if level < levels:
                up = index >> 1
                last = min((up + 1) << (level + 1), n) - 1
                heapq.heappush(queue, ((last, level + 1, up), index, digest))
    return digests


def backward(digests: dict[tuple[int, int], str], n: int, levels: int, rest: str) -> list[str]:
    """The path of each leaf: a step for each level, then ``rest``, the path of the block's own root.

    A step is L or R and the digest of the sibling on that side, or - for a node without one. The queue has
    the greatest label first: parents come before their children.
    """
    queue, paths = [((1 - n, -levels, 0), rest)], [""] * n
    while queue:
        (_, level, index), path = heapq.heappop(queue)
        level, index = -level, -index
        if not level:
            paths[index] = path
            continue
        left, right = 2 * index, 2 * index + 1
        two = (level - 1, right) in digests
        steps = [(left, f"R{digests[level - 1, right]}" if two else "-")]
        if two:
            steps.append((right, f"L{digests[level - 1, left]}"))
        for child, step in steps:
            last = min((child + 1) << (level - 1), n) - 1
            heapq.heappush(queue, ((-last, 1 - level, -child), step + path))
    return paths


def steps(path: str) -> Iterable[str]:
    at = 0
    while at < len(path):
        size = 1 if path[at] == "-" else 65
        yield path[at : at + size]
        at += size


def fold(digest: str, path: str) -> str:
    """The root that a leaf's digest leads to along its path."""
    for step in steps(path):
        own = step[1:]
        digest = sha256(own + digest if step[0] == "L" else digest + own)
    return digest


def proof(path: str) -> str:
    """The siblings of a path, one after the other."""
    return "".join(step[1:] for step in steps(path))


def _up(done: int, most: int) -> Callable[[tuple, list[tuple]], Iterable[tuple]]:
    """A block's root, after ``done`` levels below it."""

    def run(key: tuple, rows: list[tuple]) -> Iterable[tuple]:
        rows = sorted(rows)
        n = rows[0][2]
        levels = min(most, max(levels_of(n) - done, 0))
        yield *key, forward([r[1] for r in rows], levels)[levels, 0], n

    return run


def _down(done: int, most: int, last: bool) -> Callable[[tuple, list[tuple]], Iterable[tuple]]:
    """Paths of a block's nodes. The row without a digest has the path of the block's root."""

    def run(key: tuple, rows: list[tuple]) -> Iterable[tuple]:
        own = sorted((r for r in rows if r[1] is not None), key=lambda r: r[0])
        rest, subroot, root = next(r[3:6] for r in rows if r[1] is None)
        n = own[0][2]
        levels = min(most, max(levels_of(n) - done, 0))
        digests = forward([r[1] for r in own], levels)
        for row, path in zip(own, backward(digests, len(own), levels, rest), strict=True):
            if last:
                folded = fold(row[7] or row[1], path)
                yield row[6], row[1], subroot, root, sha256(proof(path)), folded, folded == root
            else:
                yield key[0], row[0], path, subroot, root

    return run


def _rounds(nodes: DataFrame, group: str, kind: str, levels: int, name: str) -> list[DataFrame]:
    """The nodes that blocks are made of: leaves (group, pos, digest, n), roots of their blocks, and so on."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = [nodes]
    for i in range(-(-levels_of(most) // levels)):
        rows = out[-1].select(group, F.shiftright("pos", levels).alias("block"), "pos", "digest", "n")
        roots = map_groups(rows, [group, "block"], _up(i * levels, levels), f"{group} {kind}, pos long, digest string, n long")
        out.append(stage(roots, f"{name}-{i}"))
    return out


def _paths(rounds: list[DataFrame], ends: DataFrame, group: str, kind: str, levels: int, key: str | None) -> DataFrame:
    """Paths of the first round's nodes, from those of the trees' roots (group, path, subroot, root).

    With ``key``, the type of doc_id, the result is the manifest.
    """
    nothing = F.lit(None)
    told = ends.select(group, F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
    done = max(len(rounds) - 1, 1)
    for i in reversed(range(done)):
        bottom = key is not None and i == 0
        extra = ["doc_id", "bad"] if bottom else []
        nodes = rounds[i].select(
            group, F.shiftright("pos", levels).alias("block"), "pos", "digest", "n",
            *(nothing.cast("string").alias(c) for c in ("path", "subroot", "root")), *extra,
        )
        above = told.select(
            group, F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), nothing.cast("string").alias("digest"),
            nothing.cast("long").alias("n"), "path", "subroot", "root",
            *(nothing.cast(nodes.schema[c].dataType).alias(c) for c in extra),
        )
        schema = f"{group} {kind}, pos long, path string, subroot string, root string"
        if bottom:
            schema = f"doc_id {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        told = map_groups(nodes.unionByName(above), [group, "block"], _down(i * levels, levels, bottom), schema)
    return told


def manifest(documents: DataFrame, tampered: Column, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each row.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Each language is a binary tree over its leaves by
    doc_id (null first; rows of one id by their leaf), a null language is one too; the languages' roots, null first and then by
    bytes, are the leaves of the last tree. A node without a sibling is hashed alone; a tree of one leaf is that leaf.
    ``proof_sha256`` is the digest of a leaf's siblings up to the root. ``folded_root`` follows from these
    and the leaf, with n_chars one higher where ``tampered`` is true (null is false); ``verified`` says that it is the root.
    A tree is swept in blocks of ``levels`` levels, one block above many until one is left.
    Nulls, empty texts and repeated rows are leaves like others; an empty table gives no rows. Other columns are not read.
    """
    lang, key = documents.schema["lang"].dataType.simpleString(), documents.schema["doc_id"].dataType.simpleString()
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    bad = F.when(tampered & F.col("n_chars").isNotNull(), leaf([more if c is values[3] else c for c in values]))
    leaves = documents.select("lang", "doc_id", leaf(values).alias("digest"), bad.alias("bad"))
    own = _rounds(ranked(leaves, ["lang"], ["doc_id", "digest"], "merkle-leaves"), "lang", lang, levels, "merkle")
    subroots = own[-1].select(F.lit(0).alias("tree"), "lang", "digest")
    top = ranked(subroots, ["tree"], ["lang"], "merkle-subroots")
    above = _rounds(top, "tree", "int", levels, "merkle-top")
    root = above[-1].select(F.lit(0).alias("tree"), F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    paths = stage(_paths(above, root, "tree", "int", levels, None), "merkle-paths").select(F.col("pos").alias("__pos"), "path", "root")
    ends = top.join(paths, F.col("pos") == F.col("__pos")).select("lang", "path", F.col("digest").alias("subroot"), "root")
    return _paths(own, ends, "lang", lang, levels, key)
