"""Each stage on its own input against a plain version of its decision."""

import math
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from kerbside.llm import pii, toxicity
from kerbside.llm.frames import stage, table
from .test_mixing import shares
from .test_similarity import plain
from .test_toxicity import plain_segments

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, function in p.STAGES:
        before, docs = docs, stage(function(spark, docs, SF), f"test-{name}")
        out.append((before, docs))
    return out


def test_stages():
    assert [name for name, _ in p.STAGES] == ["toxic_segments", "near_duplicates", "personal_data", "source_mix", "tokens"]


def test_columns(outputs):
    assert all(after.schema == before.schema for before, after in outputs[:-1])


def test_toxic(spark):
    """What stays is all whose score, from segments found by their definition, is below the limit.

    On the larger table: the smaller one has too few toxic documents to learn from.
    """
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    before, after = ({r["doc_id"]: r for r in f.collect()} for f in (docs, p.toxic_segments(spark, docs, sf)))
    labels = table(spark, sf, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    model = toxicity.train(docs, labels)

    def score(text):
        tokens = toxicity.TOKEN.findall((text or "").lower())
        hits = [(i, model.scores[w]) for i, w in enumerate(tokens) if w in model.scores]
        own = [model.lam * total - math.log(model.k * len(tokens)) for _, _, total in plain_segments(hits, len(tokens), model.rest)] if hits else []
        evidence = sum(x for x in own if x > 0)
        return 1 / (1 + math.exp(-(model.offset + model.slope * math.log1p(evidence))))

    brief = {i: r for i, r in before.items() if len(r["text"] or "") < 4_000}  # the definition takes the square of a text's words
    assert len(brief) > 0.8 * len(before)
    assert {i: r for i, r in after.items() if i in brief} == {i: r for i, r in brief.items() if score(r["text"]) < p.TOXIC_FROM}
    assert after.items() <= before.items() and len(after) < len(before)


def test_near_duplicates(outputs):
    before, after = (f.orderBy("doc_id").collect() for f in outputs[1])
    label, _ = plain([r["text"] for r in before])
    assert [r["doc_id"] for r in after] == [before[i]["doc_id"] for i in sorted(set(label))]


def test_personal_data(outputs):
    before, after = ({r["doc_id"]: r for r in f.collect()} for f in outputs[2])
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert row["n_chars"] == len(row["text"]) or row["text"] == before[i]["text"]
        assert not pii.base_spans(row["text"])


def test_mix(outputs):
    before, after = outputs[3]
    kept = {r["doc_id"]: r for r in before.collect()}
    mixed = after.collect()
    assert all(kept[r["doc_id"]] == r for r in mixed)
    size = lambda r: len((r["text"] or "").encode().split())
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    sources = sorted({r["source"] for r in kept.values()}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    own = lambda rows, source: [size(r) for r in rows if r["source"] == source]
    targets = shares([sum(own(kept.values(), s)) for s in sources])
    for source, target in zip(sources, targets, strict=True):
        assert abs(sum(own(mixed, source)) - target) <= max(own(kept.values(), source))  # one document at most


def test_tokens(outputs):
    before, after = outputs[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r["doc_id"], library.encode(r["text"], add_special_tokens=False).ids) for r in before.collect())
    assert sorted((r["doc_id"], r["ids"]) for r in after.collect()) == want


def test_run_equals_stages(spark, outputs):
    again = p.run(spark, SF)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, outputs[-1][1].collect()))


def test_model_is_the_same_again(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    assert toxicity.train(docs, labels) == toxicity.train(docs.repartition(3), labels)
