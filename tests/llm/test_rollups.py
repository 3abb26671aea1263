import pytest

from kerbside.llm import rollups
from kerbside.session import staging_path

SCHEMA = "kind string, source string, lang string, tokenizer_version string, tokens long, old_tokens long, docs string"


def changes(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def test_batches(spark, rows):
    rollup = rollups.TokenRollup(spark, staging_path(spark, "rollup-test"))
    first = changes(spark, ("insert", "a", "en", "1", 10, None), ("insert", "a", "en", "1", 5, None), ("insert", None, None, "1", None, None))
    rollup.commit("b1", first)
    rollup.commit("b2", changes(spark, ("revise", "a", "en", "1", 7, 5), ("delete", None, None, "1", None, None)))
    assert rows(rollup.totals()) == [("a", "en", "1", 2, 17)]
    rollup.commit("b1", first)  # delivered again
    rollup.commit("b3", first.limit(0))
    assert rows(rollup.totals()) == [("a", "en", "1", 2, 17)]
    folded = rollup.fold(staging_path(spark, "rollup-folded"))
    folded.commit("b4", changes(spark, ("delete", "a", "en", "1", 10, None)))
    assert rows(folded.totals()) == [("a", "en", "1", 1, 7)]


def test_batches_delivered_again(spark, rows):
    """Also with nothing, also after folding; and totals before any commit."""
    rollup = rollups.TokenRollup(spark, staging_path(spark, "rollup-again"))
    assert rows(rollup.totals()) == [] and rollup.fold(staging_path(spark, "rollup-none")).totals().isEmpty()
    one = changes(spark, ("insert", "a", "en", "1", 10, None))
    rollup.commit("b1", one)
    rollup.commit("b2", one.limit(0))
    folded = rollup.fold(staging_path(spark, "rollup-again-folded"))
    folded.commit("b1", one)
    assert rows(folded.totals()) == [("a", "en", "1", 1, 10)]
    folded.commit("b2", changes(spark, ("insert", "b", None, "1", None, None)))
    assert rows(folded.totals()) == [("a", "en", "1", 1, 10), ("b", None, "1", 1, 0)]
    folded.commit("b1", one.limit(0))
    assert rows(folded.totals()) == [("b", None, "1", 1, 0)]
    assert rows(rollup.totals()) == [("a", "en", "1", 1, 10)]


def test_writers_at_the_same_moment_both_count(spark, rows, monkeypatch):
    path = staging_path(spark, "rollup-race")
    one, other = rollups.TokenRollup(spark, path), rollups.TokenRollup(spark, path)
    plain, told = rollups.Versions._commit, []

    def late(self, base, version, parts):
        if self is one and not told:
            told.append(other.commit("b2", changes(spark, ("insert", "b", "en", "1", 1, None))))
        return plain(self, base, version, parts)

    monkeypatch.setattr(rollups.Versions, "_commit", late)
    one.commit("b1", changes(spark, ("insert", "a", "en", "1", 1, None)))
    assert rows(one.totals()) == [("a", "en", "1", 1, 1), ("b", "en", "1", 1, 1)]


def test_a_batch_that_dies_leaves_no_trace(spark, rows, monkeypatch):
    rollup = rollups.TokenRollup(spark, staging_path(spark, "rollup-dies"))
    rollup.commit("b1", changes(spark, ("insert", "a", "en", "1", 1, None)))
    plain = rollups.Versions._commit
    monkeypatch.setattr(rollups.Versions, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        rollup.commit("b1", changes(spark, ("insert", "a", "en", "1", 5, None)))
    monkeypatch.setattr(rollups.Versions, "_commit", plain)
    assert rows(rollup.totals()) == [("a", "en", "1", 1, 1)]


def test_order_does_not_matter(spark, rows):
    batches = {"x": changes(spark, ("insert", "a", "en", "1", 4, None)), "y": changes(spark, ("delete", "a", "en", "1", 4, None), ("insert", "b", "en", "1", 1, None))}
    totals = []
    for order in ("xy", "yx", "xyxy"):
        rollup = rollups.TokenRollup(spark, staging_path(spark, "rollup-order"))
        for name in order:
            rollup.commit(name, batches[name])
        totals.append(rows(rollup.totals()))
    assert totals[0] == totals[1] == totals[2] == [("b", "en", "1", 1, 1)]


def test_unknown_kind(spark):
    with pytest.raises(Exception, match="unknown kind"):
        rollups.signed(changes(spark, ("move", "a", "en", "1", 4, None))).collect()
