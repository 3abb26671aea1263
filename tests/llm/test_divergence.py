import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import divergence as d
from kerbside.llm.frames import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines, seen, same = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), same, len(repeated)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aab \n\té#\x1c\x85\x0b", max_size=80))
def test_base_counts(text):
    assert d.base_counts(text) == plain(text)


def test_distance():
    p, q = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]]), np.array([0.5, 0.5, 0.0])
    assert np.allclose(d.jensen_shannon(p, q), [0, 1])


TEXT = {"en": "the cat of the house and a dog of the town went to the sea and sat ", "de": "der hund und die katze in der stadt und das haus an der see "}


def corpus(documents):
    rows = [(i, TEXT[lang] * 12 + " ".join(f"w{i}x{j}" for j in range(40)), lang) for i, lang in enumerate(["en", "de"] * 20)]
    rows += [(100, "#### $$$$ %%%% " * 60, "en"), (101, "few words", "en"), (102, None, "en"), (103, "", None)]
    rows += [(104, " ".join(f"zq{j}$$ {j}%%% <>" for j in range(80)), "en"), (104, " ".join(f"zq{j}$$ {j}%%% <>" for j in range(80)), "en")]
    rows += [(105, TEXT["de"] * 2 + " ".join(f"q{j}" for j in range(60)) + " " + "x" * 100_000, None), (None, None, None)]
    return documents(rows)


def test_verdicts(documents):
    found = corpus(documents)
    references = d.learn(found, counters=600)
    assert references.words["en"][0] == b"the" and references.words["de"][0] == b"der"
    out = d.judge(found, references).collect()
    by_id = {r["doc_id"]: r for r in out}
    assert len(out) == found.count()
    assert by_id[100]["base_failed"] and by_id[101]["base_failed"] and by_id[102]["n_words"] == 0 and by_id[103]["base_failed"]
    assert not by_id[104]["base_failed"] and not by_id[104]["kept"]
    assert all(by_id[i]["base_failed"] for i in range(40))  # they repeat themselves
    assert d.judge(found.limit(0), references).count() == 0
    empty = d.learn(found.limit(0))
    assert not empty.classes and d.judge(found, empty).where("kept").count() == 3  # 104 twice and 105 pass the base rules


def test_common_words_are_exact(documents):
    found = corpus(documents)
    few, many = d.learn(found, counters=300), d.learn(found, counters=100_000)
    assert few.words == many.words
    assert all(np.allclose(few.shares[k], many.shares[k]) for k in many.shares)


def histograms(text):
    """Numbers of bytes by class and of words, by their definition."""
    classes = Counter(int(d.CLASS_OF[b]) for b in text.encode())
    return [classes[k] for k in range(d.SKIP)], Counter(WORD.findall(text))


def far(p, q):
    """Jensen-Shannon distance of two lists of shares."""
    total = 0.0
    for a, b in zip(p, q, strict=True):
        m = (a + b) / 2
        total += sum(x * math.log2(x / m) / 2 for x in (a, b) if x > 0)
    return math.sqrt(max(0.0, total))


def of(classes, words, reference):
    """Distances of a text from a language's shares."""
    reference_classes, common = reference
    n = max(sum(words.values()), 1)
    own = [words[w] / n for w in common]
    shares = list(common.values())
    rest = lambda values: [*values, max(0.0, 1 - sum(values))]
    return far([c / max(sum(classes), 1) for c in classes], reference_classes), far(rest(own), rest(shares))


def test_verdicts_against_a_plain_version(spark):
    documents = table(spark, "/root/testdata/sf0.001", "documents")
    rows, limits = documents.select("doc_id", "text", "lang").collect(), d.Limits()
    sums = {}
    for r in rows:
        classes, words = histograms(r["text"] or "")
        before = sums.get(r["lang"] or "", ([0] * d.SKIP, Counter()))
        sums[r["lang"] or ""] = ([a + b for a, b in zip(before[0], classes, strict=True)], before[1] + words)
    references = {}
    for lang, (classes, words) in sums.items():
        n = sum(words.values())
        references[lang] = ([c / max(sum(classes), 1) for c in classes], {w: k / n for w, k in words.items() if k >= limits.common * n})
    learned = d.learn(documents)
    assert {lang: {w.encode() for w in common} for lang, (_, common) in references.items()} == {k: set(v) for k, v in learned.words.items()}
    want = []
    for r in rows:
        text, lang = r["text"] or "", r["lang"] or ""
        n, *_, repeated = plain(text)
        failed = n < limits.least_words or 100 * repeated > limits.most_repeated * n
        classes, words = histograms(text)
        near = [references[lang]] if lang else [references[k] for k in sorted(references)]
        c, w = min((of(classes, words, x) for x in near), key=sum)
        strays = (len(text) >= limits.class_guard and c > limits.class_distance) or (n >= limits.word_guard and w > limits.word_distance)
        want.append((r["doc_id"], failed, not failed and not strays))
    got = [(r["doc_id"], r["base_failed"], r["kept"]) for r in d.judge(documents, learned).collect()]
    assert sorted(got) == sorted(want)
    assert 0 < sum(kept for _, _, kept in want) < len(want)
