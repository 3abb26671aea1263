import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kerbside.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
OWN, OTHER = bpe.Encoder.load(PATH), Tokenizer.from_file(PATH)
TEXTS = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "it's  \t\n x\x1c \x1d\x1f y\x85z\xa0 ½ ²٣ Ⅷ 한국어 🙂", " x", "x ", "a. b, c.. d,. .", "a" * 3000]


@settings(max_examples=800, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="ab' .,\n\té1<|endoftext|>s", max_size=60)))
def test_as_the_library(text):
    ids = OTHER.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == OTHER.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids_decode(ids):
    assert OWN.decode(ids) == OTHER.decode(ids, skip_special_tokens=False)


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    own = bpe.Encoder.load(PATH)
    text = " ".join(f"word{i} and, x{i % 7}." for i in range(60))
    assert own.encode(text) == OTHER.encode(text, add_special_tokens=False).ids
    assert len(own.spaced.young) <= 5 and len(own.spaced.old) <= 5


def test_frames(documents):
    found = documents([*enumerate(TEXTS), (90, None), (0, ""), (None, "x")])
    out = {(r["doc_id"], r["ids_sha256"]): r for r in bpe.round_trip(found, PATH).collect()}
    for i, text in enumerate(TEXTS):
        ids = OTHER.encode(text, add_special_tokens=False).ids
        r = out[(i, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())]
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    encoded = bpe.encode(found, PATH)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()}[2] == OTHER.encode(TEXTS[2], add_special_tokens=False).ids
    assert {r["doc_id"]: r["text"] for r in bpe.decode(encoded, PATH).collect()}[3] == TEXTS[3]
    assert encoded.count() == found.count() and bpe.encode(found.limit(0), PATH).count() == 0
    assert bpe.round_trip(found.limit(0), PATH).count() == 0


def test_unknown_id():
    with pytest.raises(ValueError, match="no such token"):
        OWN.decode([50257])
