import re

from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PLAIN = {
    "email": (EMAIL, lambda m: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and checksum(d)),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def checksum(digits):
    return sum(d if i % 2 == 0 else d // 5 + d * 2 % 10 for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0


def plain(text):
    return [(k, *m.span()) for k, (p, ok) in PLAIN.items() for m in p.finditer(text) if ok(m.group())]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab1234567890.@+-_% ()\né٣", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_field_on_unseen_rows():
    field = pii.train(pii.labelled_table())
    unseen = pii.labelled_table(rows=400, seed=77)
    found = pii.viterbi(field, [run for run, _ in unseen])
    assert sum(a == b for a, (_, b) in zip(found, unseen, strict=True)) >= 0.95 * len(unseen)


def test_viterbi_is_the_best_path_of_all():
    import itertools

    import numpy as np

    field = pii.train(pii.labelled_table(rows=200), steps=15)
    for run, _ in pii.labelled_table(rows=60, seed=5):
        if len(run.words) > 2:
            continue
        emit = [field.emit[[field.index[f] for f in names if f in field.index]].sum(axis=0) for names in pii.features(run)]
        moves = field.move + np.where(pii.ALLOWED, 0.0, -1e4)

        def total(path):
            return sum(e[t] for e, t in zip(emit, path, strict=True)) + sum(moves[a + 1, b] for a, b in zip((-1, *path), path, strict=False))

        best = max(itertools.product(range(len(pii.TAGS)), repeat=len(run.words)), key=total)
        assert [pii.TAGS[t] for t in best] == pii.viterbi(field, [run])[0]


def test_odd_rows(documents, rows):
    field = pii.train(pii.labelled_table())
    mail = "é mail a.b@c.example.com, token = \"" + "0123456789abcdef" * 2 + "00112233\""
    found = documents([(1, mail), (2, None), (3, ""), (1, mail), (None, "+49 170 1234567"), (4, "x " * 200_000 + "1.2.3.4")])
    out = {r["doc_id"]: r for r in pii.digests(found, field).collect()}
    assert out[1]["spans"].split(",")[0] == "email:7:24" and "secret" in out[1]["spans"] and out[1]["n_email"] == 1
    assert out[2]["spans"] == out[3]["spans"] == "" and out[None]["n_phone"] == 1
    assert out[4]["spans"] == "ip:400000:400007"
    assert pii.digests(found, field).count() == 6
    assert pii.digests(found.limit(0), field).count() == 0
    redacted = pii.redact(found, field)
    assert redacted.columns == found.columns and redacted.count() == 6
    texts = {r["doc_id"]: r["text"] for r in redacted.collect()}
    assert texts[1] == 'é mail <email>, token = "<secret>"' and texts[2] is None and texts[3] == ""
    assert texts[4].endswith("x <ip>")
