"""Whole-column text work on Arrow batches: words, their hashes and their n-grams, without a Python loop over words.

A word is a maximal run of bytes that are neither space nor \\t \\n \\v \\f \\r. UTF-8 keeps
these six bytes out of every other character, so words can be cut on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
# Lower case, and every ASCII character that is no letter or digit is a blank.
PLAIN = np.where([c < 128 and not chr(c).isalnum() for c in range(256)], 0x20, LOWER).astype(np.uint8)

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(max(n - 1, 0), _ODD))])


@dataclass
class Words:
    """Words of a few documents: byte bounds in `data`, and the document each is in."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.offsets) - 1

    def first(self) -> np.ndarray:
        """Number of the first word of every document, and one more at the end."""
        return np.searchsorted(self.doc, np.arange(self.docs + 1))

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first `prefix` bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        length = self.ends - self.starts
        if prefix is not None:
            length = np.minimum(length, prefix)
        before = np.cumsum(length) - length
        within = np.arange(length.sum()) - np.repeat(before, length)
        values = _BYTE[self.data[np.repeat(self.starts, length) + within]] * _powers(int(length.max()))[within]
        return mix(np.add.reduceat(values, before) ^ length.astype(np.uint64))


    def prefixes(self, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size, rising: the size, the numbers of the longer words, and `hashes(size)` of these."""
        length, least, most = self.ends - self.starts, min(sizes, default=0), max(sizes, default=0)
        at = np.flatnonzero(length > least)
        total, powers = np.zeros(len(at), np.uint64), _powers(most)
        for n in range(1, most + 1):
            total = total + _BYTE[self.data[self.starts[at] + n - 1]] * powers[n - 1]
            if n >= least:
                longer = length[at] > n
                at, total = at[longer], total[longer]
            if n in sizes:
                yield n, at, mix(total ^ np.uint64(n))


def cut(column: pa.Array, table: np.ndarray | None = None) -> Words:
    """Words of every text in `column`; null counts as empty. `table` (LOWER, PLAIN) replaces bytes first."""
    data, offsets = utf8(column)
    return cut_bytes(data if table is None else table[data], offsets)


def cut_bytes(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts given as bytes and bounds."""
    solid = np.concatenate([[False], ~BLANK[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | edge)) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | edge)) if len(data) else np.zeros(0, np.int64)
    return Words(data, offsets, starts, ends, np.searchsorted(offsets, starts, "right") - 1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where each begins (one more entry than texts)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def ngrams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `n` words within one document, and the number of its first word."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for k, power in enumerate(_powers(n)):
        total += hashes[k:k + count] * power
    at = np.flatnonzero(words.doc[:count] == words.doc[n - 1:])
    return mix(total[at]), at


def long_ngrams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """`ngrams` at a cost that does not depend on `n`; within one document, equal runs still hash alike."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rising = _powers(len(hashes))
    falling = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(
        np.full(count - 1, np.uint64(pow(int(_ODD), -1, 2**64))))])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * rising)])
    at = np.flatnonzero(words.doc[:count] == words.doc[n - 1:])
    return mix((sums[at + n] - sums[at]) * falling[at]), at


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... (size[0] numbers), then the same from begin[1], and so on."""
    before = np.cumsum(size) - size
    return np.repeat(begin - before, size) + np.arange(int(size.sum()))


def joined(words: Words, keep: np.ndarray) -> list[bytes]:
    """For every document, its words where `keep` holds, with one space between them."""
    starts, doc = words.starts[keep], words.doc[keep]
    size = words.ends[keep] - starts + 1
    data = np.concatenate([words.data, [0]]).astype(np.uint8)[spread(starts, size)]
    ends = np.cumsum(size)
    data[ends - 1] = 0x20
    whole = data.tobytes()
    bounds = np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(words.docs + 1))]
    return [whole[a:max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about `max_bytes` of text, so that work arrays stay small.

    A longer text is a run of its own.
    """
    for batch in batches:
        _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list column whose k-th entry holds the next counts[k] values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
