import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import language
from kerbside.llm.frames import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trained(spark):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs = table(spark, SF, "documents")
    return docs.where(held_out), language.train(docs.where(~held_out))


def test_held_out_accuracy(trained):
    docs, net = trained
    found = language.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 200 and np.mean([r["lang_pred"] == r["lang"] for r in found]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_look_ups_equal_the_convolution(trained):
    _, net = trained
    random = np.random.Generator(np.random.PCG64(1))
    x = random.integers(0, 256, (700, net.window)).astype(np.uint8)
    x[:5, 40:] = 0
    h = np.concatenate([np.maximum(c.max(axis=1), 0) for c in language._convolve(net, x)], axis=1)
    want = language._softmax(h @ net.weights + net.offset)
    assert np.allclose(language.Reader(net).probabilities(x), want, atol=1e-4)


def test_training_does_not_depend_on_order(trained):
    pairs = [(lang, bytes(np.frombuffer((word * 40).encode()[:128].ljust(128, b"\0"), np.uint8))) for lang, word in [("x", "abc "), ("y", "zzq "), ("x", "abd "), ("y", "qqz ")] * 30]
    plan = language.Plan(epochs=3)
    a, b = language.fit(pairs, plan), language.fit(pairs[::-1], plan)
    assert all(np.array_equal(x, y) for x, y in zip(a.filters, b.filters)) and np.array_equal(a.weights, b.weights)
    assert language.Reader(a).probabilities(np.frombuffer(pairs[0][1], np.uint8)[None])[0].argmax() == 0


def test_gradient():
    """One step of training lowers the loss of its own batch, for each kind of weight by its own gradient."""
    random = np.random.Generator(np.random.PCG64(2))
    pairs = [(lang, random.integers(97, 110 if lang == "x" else 123, 128).astype(np.uint8).tobytes()) for lang in "xy" for _ in range(40)]

    def loss(net):
        x = np.frombuffer(b"".join(w for _, w in sorted(pairs)), np.uint8).reshape(-1, 128)
        p = language.Reader(net).probabilities(x)
        return -np.log(p[np.arange(80), [0] * 40 + [1] * 40]).mean()

    losses = [loss(language.fit(pairs, language.Plan(epochs=e, batch=80, rate=0.002))) for e in range(6)]
    assert all(b < a for a, b in zip(losses, losses[1:]))


def test_odd_rows(trained, documents, rows):
    docs, net = trained
    german = docs.where("lang = 'de' and length(text) > 2000").first()["text"]
    english = docs.where("lang = 'en' and length(text) > 2000").first()["text"]
    own = [(1, None), (2, ""), (3, "12 34 !?\n"), (4, german), (4, german), (None, english), (5, "x"), (6, german[:500] + english * 300), (7, "日本")]
    found = rows(language.identify(documents(own), net))
    assert len(found) == len(own)
    by_id = {r[0]: r[1:] for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == ("und", 0.0)
    assert by_id[4][0] == "de" and by_id[None][0] == "en"
    assert by_id[6][0] == "en"  # the whole text counts, not how it begins
    assert by_id[5][0] in net.langs and by_id[7][0] in net.langs
    assert language.identify(documents(own).limit(0), net).count() == 0


def test_what_is_learned_from(spark, documents):
    rows = [(i, f"text number {i} of this", "en") for i in range(60)] + [(100 + i, "one and the same", "de") for i in range(50)]
    rows += [(200, None, "fr"), (201, "123", "fr"), (202, "sans langue", None)]
    found = language.sample(documents(rows), language.Plan(rows=20)).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in found} == {"en": 20, "de": 1}
    nothing = language.train(documents(rows).where("doc_id >= 200"))
    assert {r["lang_pred"] for r in language.identify(documents(rows), nothing).collect()} == {"und"}
    one = language.train(documents(rows).where("lang = 'en'"))
    assert {r["lang_pred"] for r in language.identify(documents(rows[:3]), one).collect()} == {"en"}
