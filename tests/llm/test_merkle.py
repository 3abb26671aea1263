import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kerbside.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root and the proof of each leaf as (sibling, whether it is on the left), level by level."""
    level, proofs = [(d, [i]) for i, d in enumerate(leaves)], [[] for _ in leaves]
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            pair = level[i : i + 2]
            for at, (_, below) in enumerate(pair):
                for leaf_at in below:
                    proofs[leaf_at].append((pair[1 - at][0], at == 1) if len(pair) == 2 else ("", False))
            up.append((h(*(d for d, _ in pair)), [x for _, below in pair for x in below]))
        level = up
    return level[0][0], proofs


def plain(rows, tampered):
    """doc_id, leaf, subroot, root, proof, folded root, verified of (doc_id, text, lang, source, n_chars)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for lang in langs:
        mine = sorted(((r[0], leaf((r[0], r[3], r[2], r[4], r[1])), r) for r in rows if r[2] == lang), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        own[lang] = mine, *tree([d for _, d, _ in mine])
    root, above = tree([own[lang][1] for lang in langs])
    out = []
    for lang, higher in zip(langs, above):
        mine, subroot, proofs = own[lang]
        for (doc_id, digest, r), proof in zip(mine, proofs):
            path = proof + higher
            folded = leaf((r[0], r[3], r[2], r[4] + 1, r[1])) if tampered(doc_id) and r[4] is not None else digest
            for sibling, left in path:
                folded = h(sibling, folded) if left else h(folded, sibling)
            out.append((doc_id, digest, subroot, root, h(*(s for s, _ in path)), folded, folded == root))
    return sorted(out, key=repr)


def seven(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 0


def odd_rows():
    rng = random.Random(3)
    rows = [(i, f"text {i} é", rng.choice(["en", "en", "en", "en", "de", None, "ß"]), rng.choice([None, "", "a:b"]), rng.choice([None, i])) for i in range(-20, 120)]
    rows += [(7, "same id", "en", "s", 1), (7, "same id", "en", "s", 1), (7, "other", "en", "s", 1), (None, None, None, None, None), (None, "", "en", "", 0)]
    return rows + [(900, "alone", "zu", "s", 5), (901, "long " * 200_000, "fr", "s", 2**63 - 1)]


@pytest.mark.parametrize("levels", [1, 2, 5, 12])
def test_against_a_plain_tree(documents, rows, levels):
    """Also in blocks so small that trees of several rounds arise, and with nulls, ties and repeated rows."""
    own = odd_rows()
    assert rows(merkle.manifest(documents(own), tampered(), levels)) == plain(own, seven)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_small_trees(documents, rows, n):
    own = [(i, "t", "en", "s", 1) for i in range(n)]
    assert rows(merkle.manifest(documents(own), tampered())) == plain(own, seven)


def test_empty(documents):
    frame = merkle.manifest(documents([(1, "t")]).limit(0), tampered())
    assert frame.count() == 0
    assert frame.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_queue_stays_small(monkeypatch):
    """Labels finish whole subtrees first, so a sweep holds a few messages a level, whatever the leaves."""
    sizes, push = [], merkle.heapq.heappush
    monkeypatch.setattr(merkle.heapq, "heappush", lambda queue, x: (push(queue, x), sizes.append(len(queue))))
    digests = merkle.forward([h(str(i)) for i in range(4000)], 12)
    paths = merkle.backward(digests, 4000, 12, "")
    assert max(sizes) <= 2 * 13
    assert all(merkle.fold(h(str(i)), paths[i]) == digests[12, 0] for i in (0, 1, 2047, 3999))


def test_one_language_is_many_tasks(spark, documents):
    """A language with all rows is numbered and swept in parts."""
    from kerbside.llm.ranks import ranked

    frame = spark.range(20_000).select(F.lit("en").alias("lang"), F.col("id").alias("doc_id")).repartition(5)
    got = ranked(frame, ["lang"], ["doc_id"], "rank-test")
    assert got.where("pos <> doc_id or n <> 20000").isEmpty() and got.count() == 20_000
