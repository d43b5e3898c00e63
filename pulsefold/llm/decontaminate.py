"""Benchmark items inside documents, by CGK embeddings, bit sampling and exact edit distance.

Items and documents are sequences of words (lower case, ASCII punctuation as blanks), and
distances count words. For an item of n words, every window of n words of every document is asked whether it begins
within `edits(n)` word edits of the item, that is, at a similarity of 0.8 or more:

1. A window can only be that close if at least n - 1 - 2 * edits(n) of its word pairs occur among the
   items' pairs. This bound is exact, so windows below it are passed over without loss.
2. CGK: a random walk over the window, which repeats a word or goes on by a bit hashed from
   (step, word), turns edit distance into Hamming distance. Several walks are sampled at several
   pairs of steps; a window becomes a candidate of each item with an equal sample.
3. Candidates are verified by exact edit distance against the item, at free end within n + edits(n) words.

The walks' recall falls with the length of an item, as steps and edits grow and the samples do not. So steps 2 and 3 are
for items of at most `walked_words` words, where recall at the greatest distance is above 0.95 with the default numbers.
For longer items the pair bound is asked for each item alone, and all stretches of a document that meet it are verified by
one exact alignment with free beginning and end: none is missed (tests/llm measures both). Unaltered items are always found.

Items travel to the documents in blocks of bounded number and size, documents are never shuffled,
and a block is one pass. Defined results: null or empty texts hold no item; items of fewer than `min_words`
words are not looked for; an empty benchmark leaves all documents clean; repeated rows give
repeated results; a document with several items has one row for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.tables import own_columns
from pulsefold.llm.texts import PLAIN, cut, mix, ngrams, slices, spread


@dataclass(frozen=True)
class Settings:
    percent: int = 80
    min_words: int = 5
    walks: int = 8
    draws: int = 8
    picks: int = 3
    walked_words: int = 50
    block_items: int = 2000
    block_bytes: int = 8_000_000
    seed: int = 11

    def edits(self, n: int) -> int:
        return n * (100 - self.percent) // 100


def samples(rows: np.ndarray, settings: Settings) -> np.ndarray:
    """One key for each walk and draw of each row of word hashes, from its CGK embeddings.

    At each step of a walk the current word is read, and a bit hashed from walk, step and word says whether
    the walk goes on; behind the end it reads 0. Steps are drawn where walks have seldom reached the end.
    """
    s, (count, n) = settings, rows.shape
    steps = max(2 * n - 2, 1)
    padded = np.concatenate([rows, np.zeros((count, 1), np.uint64)], 1)
    row, at = np.arange(count)[None, :], np.zeros((s.walks, count), np.int64)
    draw = np.random.default_rng((s.seed, n))
    salt = draw.integers(0, 2**63, (steps, s.walks, 1), dtype=np.uint64)
    drawn = draw.integers(0, steps, (s.walks, s.draws, s.picks))
    wanted = set(drawn.ravel().tolist())
    read = {}
    for j in range(steps):
        word = padded[row, at]
        if j in wanted:
            read[j] = word
        at = np.minimum(at + (mix(word ^ salt[j]) >> np.uint64(63)).astype(np.int64), n)
    keys = np.empty((count, s.walks * s.draws), np.uint64)
    for walk in range(s.walks):
        for k in range(s.draws):
            key = np.full(count, walk * s.draws + k, np.uint64)
            for j in drawn[walk, k].tolist():
                key = mix(key + read[j][walk])
            keys[:, walk * s.draws + k] = key
    return keys


def distances(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Edit distance of each item to the nearest beginning of its window (0 pads a window behind its document)."""
    width = windows.shape[1]
    column = np.arange(width + 1, dtype=np.int16 if width < 10_000 else np.int64)
    row = np.repeat(column[None, :], len(items), 0)
    for i in range(items.shape[1]):
        replaced = row[:, :-1] + (items[:, i:i + 1] != windows)
        row = np.concatenate([row[:, :1] + 1, np.minimum(replaced, row[:, 1:] + 1)], 1)
        row = np.minimum.accumulate(row - column, 1) + column
    return row.min(1)


def nearest(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of an item to any stretch of a text, and the first place where such a stretch begins."""
    # Distance and beginning in one number, so that the least one is the nearest and, among these, the first.
    one = np.int64(1 << 40)
    column = np.arange(len(text) + 1, dtype=np.int64)
    row, steps = column.copy(), column * one
    for word in item:
        replaced = row[:-1] + np.where(text == word, 0, one)
        row = np.concatenate([row[:1] + one, np.minimum(replaced, row[1:] + one)])
        row = np.minimum.accumulate(row - steps) + steps
    return divmod(int(row.min()), int(one))


@dataclass
class Group:
    """Items of one length: their numbers, words, word pairs, and their keys in sorted order. Long items have no keys,
    but an index: their pairs in sorted order, and the item of each."""

    chosen: np.ndarray
    rows: np.ndarray
    pairs: np.ndarray
    keys: np.ndarray | None = None
    order: np.ndarray | None = None
    index: tuple[np.ndarray, np.ndarray] | None = None


class Block:
    """Some items, ready to be looked for."""

    def __init__(self, ids: list, texts: list, settings: Settings):
        self.settings, self.ids = settings, ids
        self.by_length: dict[int, Group] = {}
        words = cut(pa.array(texts, pa.string()), PLAIN)
        hashes, first = words.hashes(), words.first()
        length = np.diff(first)
        pairs, at = ngrams(words, hashes, 2)
        for n in np.unique(length[length >= settings.min_words]).tolist():
            chosen = np.flatnonzero(length == n)
            rows = np.stack([hashes[first[d]:first[d] + n] for d in chosen])
            mine = length[words.doc[at]] == n
            group = self.by_length[n] = Group(chosen, rows, np.unique(pairs[mine]))
            if n <= settings.walked_words:
                keys = samples(rows, settings)
                group.order = np.argsort(keys, 0, kind="stable")
                group.keys = np.take_along_axis(keys, group.order, 0)
            else:
                pair, item = pairs[mine], np.searchsorted(chosen, words.doc[at[mine]])
                order = np.lexsort((item, pair))
                pair, item = pair[order], item[order]
                new = np.append(True, (pair[1:] != pair[:-1]) | (item[1:] != item[:-1]))
                group.index = pair[new], item[new]
        self.filter = np.zeros(1 << 20, bool)
        for group in self.by_length.values():
            self.filter[group.pairs & np.uint64((1 << 20) - 1)] = True

    def find(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item, distance, first word, words of the item): the best place of each item in each text."""
        words = cut(column, PLAIN)
        hashes = words.hashes()
        pairs, at = ngrams(words, hashes, 2)
        maybe = self.filter[pairs & np.uint64((1 << 20) - 1)]
        pairs, at = pairs[maybe], at[maybe]
        first = words.first()
        # Words, then zeros behind the last document.
        longest = max((n for n, group in self.by_length.items() if not group.index), default=0) * 2
        padded = np.concatenate([hashes, np.zeros(longest, np.uint64)])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, group in self.by_length.items():
            if group.index:
                self.align(n, group, pairs, at, hashes, words.doc, first, best)
                continue
            starts = self.starts(n, group, pairs, at, words.doc, first)
            for part in range(0, len(starts), 4096):
                self.verify(n, group, starts[part:part + 4096], padded, words.doc, first, best)
        return [(doc, item, *found) for (doc, item), found in sorted(best.items())]

    def starts(self, n: int, group: Group, pairs: np.ndarray, at: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
        """First words of the windows that hold enough of the pairs. Only the last windows of a document may be shorter."""
        edits = self.settings.edits(n)
        need = max(1, n - 1 - 2 * edits)
        known = at[group.pairs[np.minimum(np.searchsorted(group.pairs, pairs), len(group.pairs) - 1)] == pairs]
        if len(known) < need:
            return known[:0]
        # A window with enough pairs begins at most n words before its need-th last pair: try the places around pairs.
        k = np.arange(len(known) - need + 1)
        close = k[(known[k + need - 1] - known[k] < n) & (doc[known[k + need - 1]] == doc[known[k]])]
        if not len(close):
            return known[:0]
        tried = np.unique((known[close][:, None] - np.arange(n)[None, :]).ravel())
        tried = tried[tried >= 0]
        stop = np.minimum(tried + n - 1, first[doc[tried] + 1] - 1)
        held = np.searchsorted(known, stop) - np.searchsorted(known, tried)
        return tried[(held >= need) & (stop - tried + 1 >= n - edits)]

    def align(self, n: int, group: Group, pairs: np.ndarray, at: np.ndarray, hashes: np.ndarray, doc: np.ndarray, first: np.ndarray, best: dict) -> None:
        """Each long item against all stretches that hold enough of its own pairs."""
        edits = self.settings.edits(n)
        need = max(1, n - 1 - 2 * edits)
        held = group.pairs[np.minimum(np.searchsorted(group.pairs, pairs), len(group.pairs) - 1)] == pairs
        pairs, known = pairs[held], at[held]
        if len(known) < need:
            return
        # Only pairs that lie in a window with enough pairs of all items together.
        k = np.flatnonzero((known[need - 1:] - known[:len(known) - need + 1] < n) & (doc[known[need - 1:]] == doc[known[:len(known) - need + 1]]))
        cover = np.zeros(len(known) + 1, np.int64)
        np.add.at(cover, k, 1)
        np.add.at(cover, k + need, -1)
        inside = np.cumsum(cover[:-1]) > 0
        pairs, known = pairs[inside], known[inside]
        lo, hi = (np.searchsorted(group.index[0], pairs, side) for side in ("left", "right"))
        item = group.index[1][spread(lo, hi - lo)]
        known = np.repeat(known, hi - lo)
        order = np.lexsort((known, item))
        item, known = item[order], known[order]
        if len(known) < need:
            return
        begin, end = slice(0, len(known) - need + 1), slice(need - 1, None)
        k = np.flatnonzero((known[end] - known[begin] < n) & (item[end] == item[begin]) & (doc[known[end]] == doc[known[begin]]))
        # Windows that hold these pairs begin from `low` to `high`; overlapping stretches are aligned as one.
        low = np.maximum(known[k + need - 1] - n + 1, first[doc[known[k]]])
        high = np.minimum(known[k] + n + edits, first[doc[known[k]] + 1])
        item, of = item[k], doc[known[k]]
        new = np.ones(len(k), bool)
        new[1:] = (item[1:] != item[:-1]) | (of[1:] != of[:-1]) | (low[1:] > high[:-1])
        starts = np.flatnonzero(new)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(k)]):
            away, place = nearest(group.rows[item[a]], hashes[low[a]:high[b - 1]])
            if away <= edits:
                d = int(of[a])
                key = (d, int(group.chosen[item[a]]))
                best[key] = min(best.get(key, (n + 1, 0, 0)), (away, int(low[a] - first[d]) + place, n))

    def verify(self, n: int, group: Group, starts: np.ndarray, padded: np.ndarray, doc: np.ndarray, first: np.ndarray, best: dict) -> None:
        edits = self.settings.edits(n)
        window = np.lib.stride_tricks.sliding_window_view(padded, n + edits)[starts].copy()
        window[starts[:, None] + np.arange(n + edits) >= first[doc[starts] + 1][:, None]] = 0
        mine = samples(window[:, :n], self.settings)
        found: set[tuple[int, int]] = set()
        for k in range(mine.shape[1]):
            lo = np.searchsorted(group.keys[:, k], mine[:, k])
            hi = np.searchsorted(group.keys[:, k], mine[:, k], "right")
            for w in np.flatnonzero(hi > lo).tolist():
                found.update((w, i) for i in group.order[lo[w]:hi[w], k].tolist())
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        for i in range(0, len(pairs), 4096):
            w, item = pairs[i:i + 4096].T
            away = distances(group.rows[item], window[w])
            for j in np.flatnonzero(away <= edits).tolist():
                d = int(doc[starts[w[j]]])
                key = (d, int(group.chosen[item[j]]))
                place = (int(away[j]), int(starts[w[j]] - first[d]), n)
                best[key] = min(best.get(key, (n + 1, 0, 0)), place)


def blocks(benchmark: DataFrame, settings: Settings) -> Iterator[Block]:
    """The items in blocks of bounded size: only one block at a time is on the driver."""
    items = own_columns(benchmark, "item_id", "text").where("text is not null")
    row = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    parts = max(1, -(-row["n"] // settings.block_items), -(-(row["size"] or 0) // settings.block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        held = items.where(part == k).collect()
        if held:
            yield Block([r["item_id"] for r in held], [r["text"] for r in held], settings)


def contaminations(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, distance, similarity, first_word, n_words: one row per document and item found in it."""
    docs = own_columns(documents, "doc_id", "text")
    schema = "doc_id long, item_id long, distance int, similarity double, first_word long, n_words int"
    out = None
    for block in blocks(benchmark, settings):
        def run(batches, block=block):
            for piece in slices(batches, "text"):
                ids = piece.column(0).to_pylist()
                rows = [(ids[d], block.ids[i], e, 1 - e / n, at, n) for d, i, e, at, n in block.find(piece.column(1))]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "item_id", "distance", "similarity", "first_word", "n_words"), r, strict=True)) for r in rows],
                    pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()),
                               ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int32())]))

        found = docs.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `documents` (all columns) whose text holds no item: one pass per block, no shuffle."""
    for block in blocks(benchmark, settings):
        def run(batches, block=block):
            for piece in slices(batches, "text"):
                hit = {row[0] for row in block.find(piece.column(piece.schema.get_field_index("text")))}
                yield piece.filter(pa.array([k not in hit for k in range(len(piece))], pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
