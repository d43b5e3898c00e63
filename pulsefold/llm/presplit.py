"""Byte-level BPE over Arrow text columns: every distinct space-led chunk of a batch is encoded once.

The byte-level pre-tokenizer always starts a new piece at a space that a non-blank character
follows. Texts can be cut there, the distinct chunks encoded, and their ids laid out again by
index arithmetic. A text where a space is followed by white space or by nothing, or which spells
a special token, is encoded as a whole instead, cut at its special tokens.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pulsefold.llm.texts import spread

# Ids of many chunks (a column of texts) end to end, and how many each has.
Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """What `make` gives, made once in a Python worker and used by all its tasks.

    The functions of this package travel by value, so their globals are new in every task; a module object is not.
    """
    held = sys.modules.setdefault("_pulsefold_held", types.ModuleType("_pulsefold_held"))
    if getattr(held, "key", None) != key:
        held.key, held.value = key, make()
    return held.value


def begins_blank(texts: pa.Array, last: bool = False) -> pa.Array:
    """Whether the first (`last`: the last) character of each text is white space."""
    return pc.utf8_is_space(pc.utf8_slice_codeunits(texts, -1) if last else pc.utf8_slice_codeunits(texts, 0, 1))


class Remembering:
    """An encoder that keeps the ids of short chunks, up to `most` of them, for the batches and tasks that follow.

    When there is no more room, only chunks that the last batch had stay.
    """

    LONGEST = 64

    def __init__(self, encode_many: Encoder, most: int = 300_000):
        self.encode_many, self.most = encode_many, most
        self.known, self.ids = pa.array([], pa.string()), np.zeros(0, np.uint32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        place = pc.fill_null(pc.index_in(chunks, value_set=self.known), -1).to_numpy()
        new = place < 0
        ids, counts = self.encode_many(chunks.filter(pa.array(new)))
        size, begin = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        size[new], begin[new] = counts, len(self.ids) + np.cumsum(counts) - counts
        size[~new], begin[~new] = self.size[place[~new]], self.begin[place[~new]]
        flat = np.concatenate([self.ids, ids.astype(np.uint32, copy=False)])
        self._keep(chunks, place, new, flat, begin, size)
        return flat[spread(begin, size)], size

    def _keep(self, chunks: pa.Array, place: np.ndarray, new: np.ndarray, flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        more = np.flatnonzero(new & (pc.binary_length(chunks).to_numpy(zero_copy_only=False) <= self.LONGEST))
        stay = np.arange(len(self.known)) if len(self.known) + len(more) <= self.most else np.unique(place[~new])
        more = more[:max(0, self.most - len(stay))]
        self.known = pa.concat_arrays([self.known.take(pa.array(stay)), chunks.take(pa.array(more))])
        begin, self.size = np.concatenate([self.begin[stay], begin[more]]), np.concatenate([self.size[stay], size[more]])
        self.ids = flat[spread(begin, self.size)]
        self.begin = np.cumsum(self.size) - self.size


class ChunkCoder:
    """`encode_many` gives the ids of each of many texts; `encode_chunks`, if given, those of chunks."""

    def __init__(self, encode_many: Encoder, specials: dict[str, int], encode_chunks: Encoder | None = None):
        self.encode_many, self.specials, self.encode_chunks = encode_many, specials, encode_chunks or encode_many
        self.at_special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None

    def irregular(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has; they may spell special tokens."""
        pieces, of = [], []
        for k, text in enumerate(texts):
            some = self.at_special.split(text) if self.at_special else [text]
            pieces += some
            of += [k] * len(some)
        special = np.array([self.specials.get(p, -1) if self.at_special else -1 for p in pieces], np.int64)
        ids, counts = self.encode_many(pa.array(["" if s >= 0 else p for p, s in zip(pieces, special.tolist(), strict=True)], pa.string()))
        at = np.flatnonzero(special >= 0)
        ids = np.insert(ids, (np.cumsum(counts) - counts)[at], special[at].astype(ids.dtype))
        counts[at] = 1
        return ids, np.bincount(np.array(of, np.int64), counts, len(texts)).astype(np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (null: none), and the number of ids of each text."""
        column = pc.fill_null(column, "")
        split = pc.split_pattern(column, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        offsets -= offsets[0]
        values = coded.dictionary
        del split, coded
        blank = pc.or_(pc.equal(values, ""), begins_blank(values)).to_numpy(zero_copy_only=False)
        first = offsets[:-1]
        odd = blank[index] if len(values) else np.zeros(0, bool)
        odd[first] = False
        irregular = np.add.reduceat(odd, first) > 0 if len(odd) else np.zeros(0, bool)
        for special in self.specials:
            irregular |= pc.match_substring(column, special).to_numpy(zero_copy_only=False)
        # A text's first chunk has no space before it: these are chunks of their own, behind the distinct ones.
        chunk = index.copy()
        chunk[first] = len(values) + np.arange(len(first))
        regular = ~np.repeat(irregular, np.diff(offsets))
        wanted = np.zeros(len(values) + len(first), bool)
        wanted[chunk[regular]] = True
        led = pc.binary_join_element_wise("", values.filter(pa.array(wanted[:len(values)])), " ").cast(pa.string())
        bare = values.take(pa.array(index[first[wanted[len(values):]]])).cast(pa.string())
        ids, counts = self.encode_chunks(pa.concat_arrays([led, bare]))
        # Irregular texts stand as a whole in the place of their first chunk.
        whole = np.flatnonzero(irregular)
        more, more_counts = self.irregular([column[int(k)].as_py() for k in whole])
        size = np.zeros(len(wanted), np.int64)
        begin = np.zeros(len(wanted), np.int64)
        size[wanted], begin[wanted] = counts, np.cumsum(counts) - counts
        size[len(values) + whole], begin[len(values) + whole] = more_counts, len(ids) + np.cumsum(more_counts) - more_counts
        flat = np.concatenate([ids, more])
        regular[first] = True
        chunk, doc = chunk[regular], np.repeat(np.arange(len(first), dtype=np.int32), np.diff(offsets))[regular]
        out, at = np.empty(int(size[chunk].sum()), flat.dtype), 0
        # Laid out in stretches, as the places of all ids would take far more room than the ids.
        for k in range(0, len(chunk), 200_000):
            some = chunk[k:k + 200_000]
            length = size[some]
            n = int(length.sum())
            out[at:at + n] = flat[spread(begin[some], length)]
            at += n
        return out, np.bincount(doc, size[chunk], len(first)).astype(np.int64)


def byte_letters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the remaining bytes follow from 256 on in rising order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
