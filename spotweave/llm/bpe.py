"""Byte-level BPE of whole texts with a public vocabulary.

A text is cut into pieces by the vocabulary's pattern, vectorised over a batch of texts by classes of
characters. The merges of a piece are done with a priority queue of merge ranks over a doubly linked list of
symbols, where entries that a later merge made stale are skipped. Pieces repeat, so a worker remembers the ids
of short ones. Ids are decoded by concatenating the vocabulary's byte strings.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where the vocabulary lies on every node; a parameter of each operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A worker forgets its pieces when it has so many, and remembers none of more characters.
CACHE_PIECES, CACHE_CHARS = 400_000, 48
_SPACE, _LETTER, _NUMBER, _OTHER = 1, 2, 3, 4
#: Endings split from a word (fixed values of the pattern).
_ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache(2)
def classes() -> np.ndarray:
    """The class of every code point: white space, letter, number or other."""
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text, table = "".join(map(chr, points)), np.full(0x110000, _OTHER, np.uint8)
    points = np.array(points)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            table[points[m.start() : m.end()]] = kind
    return table


def starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point of texts that lie one after another and end at ``ends``."""
    n = len(points)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[0] = True
    first[ends] = True
    at = first[:n].copy()
    at[1:] |= kind[1:] != kind[:-1]
    # the last of several white-space characters before something else is a piece of its own, or a space joins what follows
    white = kind == _SPACE
    last = white & ~first[1:]
    last[:-1] &= ~white[1:]
    at |= last
    joins = last & (points == 0x20)
    follows = np.zeros(n, bool)
    follows[1:] = joins[:-1]
    at &= ~follows
    # endings after a lone apostrophe that no space joins
    quote = np.flatnonzero((points == 0x27) & at)
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        stop = np.concatenate([first, np.ones(2, bool)])
        for ending in _ENDINGS:
            hit = quote
            for j, ch in enumerate(ending, 1):
                hit = hit[(padded[hit + j] == ord(ch)) & ~stop[hit + j]]
            at[hit + 1] = False
            after = hit + len(ending) + 1
            at[after[after < n]] = True
    return at


class Vocabulary:
    """The ranks of a vocabulary file and the ids of pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.strings = {i: s for s, i in self.ranks.items()}
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        symbol: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, size = heapq.heappop(queue)
            left = symbol[i]
            j = after[i]
            if left is None or j >= n or len(left) + len(symbol[j]) != size:
                continue  # stale: one of the two was merged since
            symbol[i], symbol[j] = left + symbol[j], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(symbol[i] + symbol[k])) is not None:
                    heapq.heappush(queue, (r, i, size + len(symbol[k])))
            h = before[i]
            if h >= 0 and (r := ranks.get(symbol[h] + symbol[i])) is not None:
                heapq.heappush(queue, (r, h, len(symbol[h]) + size))
        return [ranks[s] for s in symbol if s is not None]

    def ids_of(self, piece: str) -> bytes:
        """The ids of a piece as 32-bit integers, remembered if it's short."""
        ids = array("i", self.merge(piece.encode())).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self.known) >= CACHE_PIECES:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's end."""
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ends = np.cumsum([len(t) for t in texts])
        cut = np.flatnonzero(starts(np.frombuffer(joined.encode("utf-32-le"), np.uint32), ends))
        at = cut.tolist()
        at.append(len(joined))
        get, other = self.known.get, self.ids_of
        found = [get(p) or other(p) for p in map(joined.__getitem__, map(slice, at, at[1:]))]
        sizes = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // 4
        pieces = np.searchsorted(cut, ends)  # pieces that lie within the first texts
        upto = np.where(pieces > 0, sizes[np.maximum(pieces, 1) - 1], 0)
        return np.frombuffer(b"".join(found), np.int32), upto

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a worker."""
    return Vocabulary(path)


_GROUP_CHARS = 4 << 20


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a bounded number of characters together."""
    a = size = 0
    for b, t in enumerate(texts, 1):
        size += len(t)
        if size >= _GROUP_CHARS or b == len(texts):
            yield a, b
            a, size = b, 0


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids``: the ids of each whole text, without special tokens, whose strings are ordinary text.

    Null and empty texts have an empty list. Rows sent twice come out twice, and a null ``doc_id`` stays; an
    empty table gives an empty one. No other column of ``df`` is read. A text of any length is encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _groups(texts):
                ids, upto = v.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["doc_id", "ids"])

    return df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def lengths(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens``: as ``encode``, but only how many ids there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _groups(texts):
                upto = v.encode(texts[a:b])[1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(upto, prepend=0))], ["doc_id", "n_tokens"])

    return df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(run, "doc_id bigint, n_tokens bigint")


def decode(df: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``: the vocabulary's strings one after another; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [None if ids is None else v.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
