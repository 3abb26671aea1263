"""Personal data: fixed patterns, and a linear-chain conditional random field for other forms."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.frames import map_chunks, sha256

#: Base kinds, in the order of digests, and those that only the field finds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "id", "secret")
TAGS = ("O", *(f"{place}-{kind}" for kind in KINDS for place in "BI"))
#: Fixed patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BLANKS = frozenset("\t\n\x0b\x0c\r ")
NOT_DIGIT = re.compile("[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from each @: the longest run of local characters before it, the domain after it."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        if found := DOMAIN.match(text, at + 1):
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                free = found.end()
                out.append(("email", start, free))
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: by kind, then start; code points, end exclusive."""
    out = _emails(text)
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(_part(p) for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group()) if len(m.group()) >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def _part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


# --- the field -------------------------------------------------------------------------------------------------

#: A word can only be tagged if it holds a digit or an @.
MARK = re.compile("[0-9@]")
#: Characters of text beside a run of such words in which the words next to it are looked for.
CONTEXT = 60
EDGES = re.compile(r"^[^\w+(@]*|[^\w)]*$")


@dataclass(frozen=True)
class Run:
    """Neighbouring words that may be tagged: their places, two words before and two after."""

    words: list[str]
    places: list[tuple[int, int]]
    before: list[str]
    after: list[str]


def runs(text: str) -> list[Run]:
    """Maximal runs of words with a digit or an @.

    All words outside are O, so the best path of the text is O there and the
    best path of each run inside: runs are decoded for themselves.
    """
    words: list[tuple[int, int]] = []
    n = len(text)
    at = MARK.search(text)
    while at:
        start = at.start()
        while start > 0 and text[start - 1] not in BLANKS:
            start -= 1
        end = at.end()
        while end < n and text[end] not in BLANKS:
            end += 1
        words.append((start, end))
        at = MARK.search(text, end)
    out, i = [], 0
    while i < len(words):
        j = i + 1
        while j < len(words) and text[words[j - 1][1] : words[j][0]].isspace():
            j += 1
        places = words[i:j]
        before = text[max(0, places[0][0] - CONTEXT) : places[0][0]].split()[-2:]
        after = text[places[-1][1] : places[-1][1] + CONTEXT].split()[:2]
        out.append(Run([text[a:b] for a, b in places], places, before, after))
        i = j
    return out


def shape(word: str) -> tuple[str, str]:
    """Every character as its class, and the same with repeats once."""
    whole = "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in word[:48])
    return whole, re.sub(r"(.)\1+", r"\1+", whole)


CUES = (
    "token", "key", "secret", "password", "=", ":", "mail", "email", "phone", "tel", "call", "fax", "mobile", "card", "visa",
    "account", "iban", "ssn", "id", "passport", "ip", "host", "server", "address", "version", "license", "page", "chapter", "on", "in",
)


def features(run: Run) -> list[list[str]]:
    """Names of the features of each word of a run."""
    padded = ["<", "<", *run.before][-2:] + run.words + [*run.after, ">", ">"][:2]
    shapes = [shape(EDGES.sub("", w))[1] for w in padded]
    lower = [EDGES.sub("", w).lower() or w for w in padded]
    out = []
    for i in range(2, len(padded) - 2):
        word = EDGES.sub("", padded[i])
        whole, short = shape(word)
        digits = NOT_DIGIT.sub("", word)
        own = ["bias", f"s={short}", f"digits={min(len(digits), 41) // 3}", f"length={min(len(word), 60) // 4}"]
        own += [f"whole={whole}"] if len(whole) <= 16 else []
        own += ["@"] if "@" in word else []
        own += ["hex"] if len(word) >= 16 and re.fullmatch("[0-9a-fA-F]+", word) else []
        own += ["mixed"] if len(word) >= 16 and digits and re.search("[A-Za-z]", word) and "@" not in word and "." not in word else []
        own += ["luhn"] if 13 <= len(digits) <= 19 and luhn(digits) else []
        own += ["dots=" + str(min(word.count("."), 5)), "first=" + short[:1]]
        own += [f"s-1={shapes[i - 1]}", f"s+1={shapes[i + 1]}"]
        own += [f"w-1={lower[i - 1]}"] if lower[i - 1] in CUES else []
        own += [f"w-2={lower[i - 2]}"] if lower[i - 2] in CUES else []
        out.append(own)
    return out


@dataclass(frozen=True)
class Field:
    """Feature numbers, their weights by tag, and weights from tag to tag (first row: the start)."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray


#: A run starts after O and no I may follow another kind.
ALLOWED = np.array(
    [[not t.startswith("I-") for t in TAGS]]
    + [[not t.startswith("I-") or p[2:] == t[2:] for t in TAGS] for p in TAGS]
)


def labelled_table(rows: int = 900, seed: int = 11) -> list[tuple[Run, list[str]]]:
    """A small labelled table: runs with a tag for each word, made by rule.

    Positive forms of every kind, with and without the words that announce
    them, and numbers that are no personal data: dates, times, versions, prices, years,
    measures, numbered lines, long numbers, ranges.
    """
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    letters = lambda n: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(n))
    filler = lambda: rng.choice([letters(rng.randint(2, 9)), letters(rng.randint(2, 9)).capitalize(), letters(5) + ","])

    def card() -> str:
        digits = number(15)
        return next(digits + d for d in "0123456789" if luhn(digits + d))

    def grouped(digits: str, mark: str) -> str:
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))

    def positive() -> tuple[str, str, list[str]]:
        kind = rng.choice(KINDS)
        if kind == "email":
            host = rng.choice([f"mail{rng.randint(1, 9)}.example.com", f"{letters(6)}.org", letters(7), "localhost"])
            return kind, f"{letters(3)}{rng.choice(['.', '_', ''])}{number(2)}@{host}", ["mail", "email", "", ""]
        if kind == "ip":
            return kind, ".".join(str(rng.randint(0, 255)) for _ in range(4)) + rng.choice(["", ":8080", "/24"]), ["ip", "host", "server", ""]
        if kind == "card":
            return kind, grouped(card(), rng.choice(["", "", "-", " ", "."])), ["card", "visa", "", ""]
        if kind == "phone":
            forms = [
                f"+1 ({number(3)}) 555-{number(4)}", f"+{rng.randint(20, 99)} {number(3)} {number(7)}", f"({number(3)}) 555-{number(4)}",
                f"{number(3)}-555-{number(4)}", f"00{number(2)} {number(3)} {number(6)}", f"{number(3)}.555.{number(4)}",
            ]
            return kind, rng.choice(forms), ["phone", "tel", "call", "mobile", ""]
        if kind == "iban":
            return kind, rng.choice(["DE", "FR", "ES", "GB"]) + number(2) + rng.choice(["", " "]).join(["", *(number(4) for _ in range(4))]), ["iban", "account", ""]
        if kind == "id":
            return kind, f"{number(3)}-{number(2)}-{number(4)}", ["ssn", "id", "passport", ""]
        size = rng.choice([32, 40, 40, 40, 64])
        alphabet = rng.choice(["0123456789abcdef"] * 3 + ["0123456789ABCDEF", "ABCDEFGHabcdefgh0123456789"])
        return kind, "".join(rng.choice(alphabet) for _ in range(size)), ["token =", "key =", "secret:", "password =", ""]

    def negative() -> str:
        forms = [
            f"{rng.randint(1, 31)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}", f"{rng.randint(1900, 2030)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}",
            f"{rng.randint(0, 23)}:{number(2)}", f"{rng.randint(0, 9)}.{rng.randint(0, 9)}", f"{rng.randint(0, 9)}.", f"{rng.randint(0, 9)}.0.{rng.randint(0, 20)}",
            number(rng.randint(1, 6)), str(rng.randint(1900, 2030)), f"{number(2)}%", f"${number(3)}.{number(2)}", f"{number(3)},{number(3)}",
            f"{number(2)}km", f"{letters(3)}{number(1)}", f"({number(1)})", f"[{number(2)}]", f"{number(2)}-{number(2)}", number(rng.randint(20, 30)),
            f"@{letters(6)}", "@", f"{letters(4)}@", f"#{number(3)}", f"{number(7)}", number(16),
        ]
        return rng.choice(forms)

    table = []
    while len(table) < rows:
        kind, value, cues = positive()
        cue = rng.choice(cues)
        end = rng.choice(["", "", "", ".", ",", "!!", "%%%", "***", "###", "$$$"])
        quote = '"' if kind == "secret" and rng.random() < 0.7 else ""
        if rng.random() < 0.45:
            words, tags, cue = negative().split(), None, rng.choice(["", "version", "page", "on", "in", ""])
            tags = ["O"] * len(words)
        else:
            words = (quote + value + quote).split()
            tags = [f"B-{kind}", *[f"I-{kind}"] * (len(words) - 1)]
        words[-1] += end
        if rng.random() < 0.15:
            words, tags = [*words, f"{rng.randint(1, 99)}"], [*tags, "O"]
        before = [filler(), *cue.split()] if cue else [filler(), filler()]
        if rng.random() < 0.15:  # shouted texts
            words, before = [w.upper() for w in words], [w.upper() for w in before]
        table.append((Run(words, [], before[-2:], [filler(), filler()]), tags))
    return table


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(table: list[tuple[Run, list[str]]], steps: int = 120, rate: float = 0.5, ridge: float = 2e-4) -> Field:
    """Weights of largest penalised likelihood, by forward and backward sums over padded batches and Adagrad steps."""
    told = sorted(((features(run), [TAGS.index(t) for t in tags]) for run, tags in table), key=lambda x: -len(x[1]))
    index = {name: i for i, name in enumerate(sorted({f for rows, _ in told for row in rows for f in row}))}
    n, longest, most = len(told), max(len(t) for _, t in told), max(len(r) for rows, _ in told for r in rows)
    active = np.full((n, longest, most), len(index))
    gold, mask = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for s, (rows, tags) in enumerate(told):
        mask[s, : len(tags)], gold[s, : len(tags)] = True, tags
        for t, row in enumerate(rows):
            active[s, t, : len(row)] = [index[f] for f in row]
    lasting = mask.sum(axis=0)
    # places that are words, and for each feature the places that have it, end to end
    flat = active[mask]
    order = np.argsort(flat, axis=None, kind="stable")
    having = (np.arange(flat.size) // most)[order]
    names, begins = np.unique(flat.reshape(-1)[order], return_index=True)
    k = len(TAGS)
    emit, move = np.zeros((len(index) + 1, k)), np.zeros((k + 1, k))
    barred = np.where(ALLOWED, 0.0, -1e4)
    squares = [np.full_like(emit, 1e-6), np.full_like(move, 1e-6)]
    for _ in range(steps):
        e, m = np.zeros((n, longest, k)), move + barred
        e[mask] = emit[flat].sum(axis=1)
        ahead, behind = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        ahead[:, 0] = e[:, 0] + m[0]
        for t in range(1, longest):  # the first rows are the longest ones
            on = slice(0, lasting[t])
            ahead[on, t] = _log_sum(ahead[on, t - 1, :, None] + m[1:], 1) + e[on, t]
        for t in range(longest - 2, -1, -1):
            on = slice(0, lasting[t + 1])
            behind[on, t] = _log_sum(m[1:] + (e[on, t + 1] + behind[on, t + 1])[:, None, :], 2)
        z = _log_sum(ahead[np.arange(n), mask.sum(axis=1) - 1], 1)
        rest = -np.exp(np.where(mask[:, :, None], ahead + behind - z[:, None, None], -np.inf))
        rest[np.nonzero(mask) + (gold[mask],)] += 1
        grad_emit = np.zeros_like(emit)
        grad_emit[names] = np.add.reduceat(rest[mask][having], begins)
        grad_move = np.zeros_like(move)
        grad_move[0] = rest[:, 0].sum(axis=0)
        for t in range(1, longest):
            on = slice(0, lasting[t])
            edge = np.exp(ahead[on, t - 1, :, None] + m[1:] + (e[on, t] + behind[on, t])[:, None, :] - z[on, None, None])
            grad_move[1:] -= edge.sum(axis=0)
            np.add.at(grad_move, (gold[on, t - 1] + 1, gold[on, t]), 1)
        for weights, gradient, square in ((emit, grad_emit, squares[0]), (move, grad_move, squares[1])):
            gradient = gradient / n - ridge * weights
            square += gradient**2
            weights += rate * gradient / np.sqrt(square)
        emit[-1] = 0
    return Field(index, emit, move)


def viterbi(field: Field, found: list[Run], batch: int = 256) -> list[list[str]]:
    """The best tags of each run, decoded in padded batches of runs of like length."""
    out: list[list[str]] = [[] for _ in found]
    order = sorted(range(len(found)), key=lambda i: len(found[i].words))
    moves = field.move + np.where(ALLOWED, 0.0, -1e4)
    at = 0
    while at < len(order):
        size = len(found[order[at]].words)
        part = [order[at]]
        while len(part) < batch and at + len(part) < len(order) and len(found[order[at + len(part)]].words) <= max(size + 2, size * 1.25):
            part.append(order[at + len(part)])
        at += len(part)
        longest = max(len(found[i].words) for i in part)
        emit = np.zeros((len(part), longest, len(TAGS)))
        for row, i in enumerate(part):
            for t, names in enumerate(features(found[i])):
                emit[row, t] = field.emit[[field.index[f] for f in names if f in field.index]].sum(axis=0)
        best, back = emit[:, 0] + moves[0], []
        last = [None] * len(part)
        for t in range(longest):
            if t:
                options = best[:, :, None] + moves[1:]
                back.append(options.argmax(axis=1))
                best = options.max(axis=1) + emit[:, t]
            for row, i in enumerate(part):
                if len(found[i].words) == t + 1:
                    last[row] = int(best[row].argmax())
        for row, i in enumerate(part):
            tag, tags = last[row], []
            for t in range(len(found[i].words) - 1, -1, -1):
                tags.append(TAGS[tag])
                if t:
                    tag = int(back[t - 1][row, tag])
            out[i] = tags[::-1]
    return out


def _spans(text: str, run: Run, tags: list[str]) -> list[Span]:
    """The tagged words of a run as spans, without punctuation at their ends."""
    out, t = [], 0
    while t < len(tags):
        if tags[t] == "O":
            t += 1
            continue
        u = t + 1
        while u < len(tags) and tags[u] == "I" + tags[t][1:]:
            u += 1
        start, end = run.places[t][0], run.places[u - 1][1]
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if start < end:
            out.append((tags[t][2:], start, end))
        t = u
    return out


def added_spans(field: Field, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """What the field finds in each text and no base span touches."""
    where = [(i, run) for i, text in enumerate(texts) for run in runs(text)]
    out: list[list[Span]] = [[] for _ in texts]
    for (i, run), tags in zip(where, viterbi(field, [r for _, r in where]), strict=True):
        if any(t != "O" for t in tags):
            near = [s for s in base[i] if s[1] < run.places[-1][1] and s[2] > run.places[0][0]]
            out[i] += [s for s in _spans(texts[i], run, tags) if all(s[2] <= a or s[1] >= b for _, a, b in near)]
    return out


def find(documents: DataFrame, field: Field, key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep``, base and added: arrays of kind, start, end for each whole text.

    Null and empty texts have no spans. Rows stay as they are, repeated ones too.
    """
    wanted = list(dict.fromkeys([key, "text", *keep]))
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    span = "array<struct<kind:string,start:int,end:int>>"

    def start():
        def chunk(*lists):
            texts = [t or "" for t in lists[1]]
            base = [base_spans(t) for t in texts]
            named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
            rows = zip(*lists, base, added_spans(field, texts, base), strict=True)
            return [(*row[:-2], named(row[-2]), named(row[-1])) for row in rows]

        return chunk

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in wanted) + f", base {span}, added {span}"
    out = map_chunks(documents, wanted, start, schema, chunk=500)
    return out.select(*(F.col(f"`{c}`") for c in dict.fromkeys([key, *keep])), "base", "added")


def listed(spans: list[Span]) -> str:
    """kind:start:end by kind, then start, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def digests(documents: DataFrame, field: Field, key: str = "doc_id") -> DataFrame:
    """Counts and a digest of the base spans, and all spans as one text."""
    found = find(documents, field, key)
    kind = documents.schema[key].dataType.simpleString()

    def start():
        def chunk(keys, base, added):
            rows = []
            for k, b, a in zip(keys, base, added, strict=True):
                b, a = ([(s["kind"], s["start"], s["end"]) for s in spans] for spans in (b, a))
                rows.append((k, *(sum(s[0] == name for s in b) for name in BASE), sha256(listed(b)), listed(b + a), len(a)))
            return rows

        return chunk

    schema = f"{key} {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_chunks(found, [key, "base", "added"], start, schema)


def redact(documents: DataFrame, field: Field) -> DataFrame:
    """The documents with each span replaced by its kind, as in ``<email>``.

    Of overlapping spans the union is replaced, under the kind that starts
    first. Null texts stay null; ``n_chars``, if there is one, follows the text.
    All columns and rows stay.
    """
    columns = documents.columns
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    at, size = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def start():
        def chunk(*lists):
            texts = [t or "" for t in lists[at]]
            base = [base_spans(t) for t in texts]
            rows = []
            for row, text, spans in zip(zip(*lists, strict=True), texts, map(list.__add__, base, added_spans(field, texts, base)), strict=True):
                if spans:
                    row = list(row)
                    row[at] = replaced(text, spans)
                    if size is not None:
                        row[size] = len(row[at])
                rows.append(tuple(row))
            return rows

        return chunk

    return map_chunks(documents, [f"`{c}`" for c in columns], start, ", ".join(f"`{c}` {kinds[c]}" for c in columns), chunk=500)


def replaced(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])
