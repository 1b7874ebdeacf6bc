"""Byte-level text helpers shared by the operators of this subpackage.

They work on one Arrow string column at a time, viewed as a single UTF-8 buffer
with document offsets, so every step is a numpy operation over many documents.
A column is cut into runs of whole documents of about ``CHUNK`` bytes (256 KB); that
bounds the memory of a task (a single longer document is one run).  Whole texts
are always processed.

Words are the runs of bytes 0-9, a-z, A-Z and 0x80 upwards after lower-casing
A-Z: exactly ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` over the code points.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18

_GOLD = 0x9E3779B97F4A7C15
_M1 = 0xBF58476D1CE4E5B9
_M2 = 0x94D049BB133111EB
_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix): spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(_GOLD)
    x ^= x >> np.uint64(30)
    x *= np.uint64(_M1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(_M2)
    x ^= x >> np.uint64(31)
    return x


def pair_id(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One identifier for an ordered pair of identifiers."""
    return mix(a * np.uint64(_BASE) + b)


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_table() -> np.ndarray:
    t = np.zeros(256, bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        t[lo:hi] = True
    return t


LOWER = lower_table()
IS_WORD = word_table()
BYTE_CODE = mix(np.arange(256, dtype=np.uint64))
WORD_CODE = BYTE_CODE[LOWER]


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _Powers()


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """``s`` with ``s[j] - s[i]`` the (position-weighted) code sum of ``i..j-1``."""
    up, _ = _POWERS.get(len(codes) + 1)
    s = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:-1], out=s[1:])
    return s


def span_ids(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit identifiers of the strings ``start..end-1`` (equal strings, equal ids)."""
    _, down = _POWERS.get(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def gram_ids(sums: np.ndarray, q: int) -> np.ndarray:
    """Identifiers of all strings of ``q`` consecutive codes."""
    n = len(sums) - q
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, down = _POWERS.get(len(sums))
    return mix((sums[q:] - sums[:-q]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """``min(x[p..p+width-1])`` for every p that has the whole window."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if buffers[2] is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def runs(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole documents: (first, last + 1, bytes, offsets)."""
    data, offsets = utf8(texts)
    lo, n = 0, len(texts)
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


@dataclass
class Words:
    start: np.ndarray   # byte offset in the run
    end: np.ndarray
    doc: np.ndarray     # document of the run
    first: np.ndarray   # index of each document's first word; one more at the end
    id: np.ndarray      # 64-bit identifier of the lower-cased word

    @property
    def pos(self) -> np.ndarray:
        """Word number inside its document, from 0."""
        return np.arange(len(self.start)) - self.first[self.doc]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of a run of documents (words never cross documents)."""
    n, docs = len(data), len(offsets) - 1
    inside = IS_WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
        after[-1] = False
        after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    first = np.searchsorted(doc, np.arange(docs + 1), "left")
    return Words(start, end, doc, first, span_ids(prefix_sums(WORD_CODE[data]), start, end))


def shingle_ids(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of all runs of ``k`` consecutive words of a document, and the
    index of their first word.  A document of 1 to k - 1 words has one shingle:
    all its words."""
    n = len(w.id)
    sums = prefix_sums(w.id)
    count = w.counts()
    short = np.flatnonzero((count > 0) & (count < k))
    at = np.arange(n)
    full = at[at + k <= w.first[w.doc + 1]] if n else at
    start = np.concatenate([full, w.first[short]])
    end = np.concatenate([full + k, w.first[short + 1]])
    ids = span_ids(sums, start, end)
    if len(short):
        order = np.argsort(start, kind="stable")
        return ids[order], start[order]
    return ids, start


def as_long(ids: np.ndarray) -> pa.Array:
    """Unsigned identifiers as a bigint column."""
    return pa.array(np.ascontiguousarray(ids).view(np.int64))
