"""Byte-pair encoding with a public vocabulary, and decoding."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from kerbside.llm.frames import map_rows, sha256
from kerbside.session import ship_package

#: Fixed: how the vocabulary's text is cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of each half of a cache in a worker, and the length of what is kept.
CACHE_ENTRIES, CACHE_CHARS = 350_000, 30


def byte_characters() -> dict[int, str]:
    """How a byte-level vocabulary writes each byte as one printable character.

    Fixed rule: printable Latin-1 bytes stand for themselves, the others take
    the characters from U+0100 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + n) for n, b in enumerate(others)}


class Halves:
    """A bounded cache: when the young half is full, it becomes the old one."""

    def __init__(self) -> None:
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def put(self, key: str, value: str) -> None:
        if len(key) <= CACHE_CHARS:
            if len(self.young) >= CACHE_ENTRIES:
                self.old = dict(self.young)
                self.young.clear()  # in place: callers hold its ``get``
            self.young[key] = value

    def from_old(self, key: str) -> str | None:
        """What the young half lacks and the old one has, moved to the young one."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value


class Encoder:
    """Encoder and decoder for one vocabulary file.

    Inside, ids are decimal text joined by commas: one string for a piece, a
    chunk or a text, so that cached parts join without a loop over ids.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int], pattern: str = PATTERN) -> None:
        to_byte = {c: b for b, c in byte_characters().items()}
        spell = lambda token: bytes(to_byte[c] for c in token)
        ids = {spell(token): i for token, i in vocabulary.items()}
        self.strings = {i: s for s, i in ids.items()} | {i: s.encode() for s, i in special.items()}
        #: the same strings end to end, and where each begins and ends
        spelt = [self.strings.get(i, b"") for i in range(max(self.strings) + 1)]
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.lengths = np.array([len(s) for s in spelt])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.first = [ids[bytes([b])] for b in range(256)]
        #: by left id: right id to rank; by rank: left, right and merged id
        self.ranks: list[dict[int, int]] = [{} for _ in spelt]
        self.left, self.right, self.merged = [], [], []
        for rank, (left, right) in enumerate(merges):
            a, b = ids[spell(left)], ids[spell(right)]
            self.ranks[a].setdefault(b, rank)
            self.left.append(a)
            self.right.append(b)
            self.merged.append(ids[spell(left) + spell(right)])
        self.special = special
        self.cut = regex.compile(pattern)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        #: pieces that begin with a space, without it, and all others
        self.spaced, self.others = Halves(), Halves()

    @classmethod
    def load(cls, path: str) -> Encoder:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return cls(model["vocab"], merges, {t["content"]: t["id"] for t in told.get("added_tokens", [])})

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece: the pair of lowest rank merges first, the leftmost of equal ones.

        Symbols lie in a doubly linked list, possible merges in a heap, each as
        one number of rank and place. A merge leaves the entries of its old
        neighbours in the heap; an entry is stale, and skipped, if the symbols
        at its place are no longer the pair of its rank.
        """
        ranks, lefts, rights, first = self.ranks, self.left, self.right, self.first
        symbols = [first[b] for b in piece]
        n = len(symbols)
        heap, i = [], 0
        for a, b in zip(symbols, symbols[1:], strict=False):
            rank = ranks[a].get(b)
            if rank is not None:
                heap.append(rank << 40 | i)
            i += 1
        if not heap:
            return symbols
        heapq.heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[i]
            if j >= n or symbols[i] != lefts[rank] or symbols[j] != rights[rank]:
                continue
            symbols[i] = merged = self.merged[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = ranks[merged].get(symbols[k])
                if found is not None:
                    heapq.heappush(heap, found << 40 | i)
            h = before[i]
            if h >= 0:
                found = ranks[symbols[h]].get(merged)
                if found is not None:
                    heapq.heappush(heap, found << 40 | h)
        return [s for s in symbols if s >= 0]

    def _piece(self, piece: str) -> str:
        cache, key = (self.spaced, piece[1:]) if piece[0] == " " else (self.others, piece)
        ids = cache.young.get(key) or cache.from_old(key)
        if ids is None:
            ids = ",".join(map(str, self.merge(piece.encode())))
            cache.put(key, ids)
        return ids

    def _cut(self, text: str) -> str:
        return ",".join([self._piece(p) for p in self.cut.findall(text)])

    def _chunks(self, text: str) -> str:
        """A text without special tokens.

        The pattern always starts a piece at a space between two characters that
        are not white space, so the text falls into chunks there. Most chunks
        are one cached piece, or one and a stop or comma, which is a piece too
        if a letter is before it. A text with a space beside other white space
        is cut whole.
        """
        chunks = text.split(" ")
        if not chunks[0] or chunks[0][-1].isspace():
            return self._cut(text)
        get = self.spaced.young.get
        ends = {c: self._piece(c) for c in ".,"}
        out = [get(c) for c in chunks]
        out[0] = self._cut(chunks[0])
        for at, ids in enumerate(out):
            if ids is None:
                chunk = chunks[at]
                if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                    return self._cut(text)
                end = ends.get(chunk[-1])
                if end is None or not chunk[-2:-1].isalpha():
                    out[at] = self._cut(" " + chunk)
                else:
                    word = chunk[:-1]
                    out[at] = f"{get(word) or (self._piece(' ' + word) if word.isalpha() else self._cut(' ' + word))},{end}"
        return ",".join(out)

    def encode_decimal(self, text: str) -> str:
        """The ids of a text as decimals joined by commas."""
        if not self.specials or not any(s in text for s in self.special):
            return self._chunks(text) if text else ""
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [self._chunks(text[at : found.start()]), str(self.special[found.group()])]
            at = found.end()
        out.append(self._chunks(text[at:]))
        return ",".join(x for x in out if x)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The vocabulary strings of the ids, one after the other."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.spelt[shift + np.arange(len(shift))].tobytes()

    def decode_decimal(self, ids: str) -> str:
        """The text of ids that ``encode_decimal`` returned."""
        return self.decode_bytes(np.fromstring(ids, np.int64, sep=",")).decode("utf-8", "replace") if ids else ""

    def encode(self, text: str) -> list[int]:
        ids = self.encode_decimal(text)
        return list(map(int, ids.split(","))) if ids else []

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; broken UTF-8 becomes U+FFFD, an unknown id is an error."""
        if unknown := [i for i in ids if i not in self.strings]:
            raise ValueError(f"no such token: {unknown[0]}")
        return self.decode_bytes(np.array(ids, np.int64)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker and file; its caches outlive a task."""
    return Encoder.load(path)


def _on_worker(name: str) -> Encoder:
    return encoder(SparkFiles.get(name))


def _ship(frame: DataFrame, path: str) -> str:
    """Send the vocabulary file (about 2 MB) to the workers; its name there."""
    frame.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(frame: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens and ids (an array) of each whole text, null texts as empty ones.

    Special tokens of the file are found in the text, none is added. ``path`` is
    the file of a byte-level BPE tokenizer. Rows stay as they are, repeated ones
    too; other columns are not read.
    """
    name = _ship(frame, path)
    ship_package(frame.sparkSession)
    kind = frame.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _on_worker(name)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                decimals = [own.encode_decimal(t or "") for t in part.column(1).to_pylist()]
                arrays = [np.fromstring(d, np.int32, sep=",") if d else np.zeros(0, np.int32) for d in decimals]
                sizes = np.array([len(a) for a in arrays])
                ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), ids], names=[key, "n_tokens", "ids"])

    return frame.select(key, text).mapInArrow(run, f"{key} {kind}, n_tokens long, ids array<int>")


def decode(frame: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and text of each array of ids; null ones give empty texts, unknown ids are an error."""
    name = _ship(frame, path)
    kind = frame.schema[key].dataType.simpleString()

    def start():
        own = _on_worker(name)
        return lambda k, i: [(k, own.decode(i or []))]

    return map_rows(frame, [key, ids], start, f"{key} {kind}, text string", chunk=200)


def round_trip(frame: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode each text in one pass and keep digests of both.

    ``key``, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256 (of the decoded text). Rows as in ``encode``.
    """
    name = _ship(frame, path)
    kind = frame.schema[key].dataType.simpleString()

    def start():
        own = _on_worker(name)

        def row(k, t):
            ids = own.encode_decimal(t or "")
            return [(k, ids.count(",") + 1 if ids else 0, sha256(ids), sha256(own.decode_decimal(ids)))]

        return row

    return map_rows(frame, [key, text], start, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
