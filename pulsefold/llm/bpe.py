"""Byte-level BPE as a deterministic automaton, built merge by merge, and its use on text columns.

The automaton starts with one state and an arc for every byte. The gadget of merge (u, v) -> w,
applied in the order of the merges, takes the state that u leads to, makes a copy without the
arc v, lets every u-arc lead to the copy, and gives every state that has a u-arc a w-arc to the
place v led to. What the finished automaton accepts are exactly the token sequences that BPE
produces, so any two neighbours can be checked by one transition.

A label always leads to one state, so a state is stored as what its gadgets took away: `cut`
holds the number of the gadget that removed arc v behind u. A state shared before a gadget and
copied after it is told apart by that number (`born`), never stored twice; the whole automaton is
as large as the merge list.

Encoding a pre-split word takes, at each place, the longest arc the current state has, and a
shorter one where the word could not go on; every place of a word is entered once, because a prefix
has one BPE sequence. `Tables` holds the automaton as arrays, made once on the driver: all distinct words of a batch
take their steps side by side, each step a few look-ups of whole arrays. Decoding emits the bytes of the arc labels.

Defined results: a null or empty text has no ids and decodes to the empty text; a special token
spelled in a text is that token; all texts are taken whole.
"""

from __future__ import annotations

import hashlib
import json
import pickle
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from pulsefold.llm.presplit import ChunkCoder, byte_letters, per_worker
from pulsefold.llm.tables import own_columns
from pulsefold.llm.texts import lists, slices, spread, utf8

# Fixed value: the byte-level pre-tokenizer's pieces, white space as Unicode defines it.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# Words of up to so many bytes are encoded side by side; a longer one goes through the automaton alone.
LOCKSTEP_BYTES = 64


@dataclass(frozen=True)
class Vocabulary:
    """What the automaton needs from a vocabulary file: label bytes, merges in order, special tokens."""

    labels: list[bytes]
    merges: np.ndarray
    specials: dict[str, int]

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as source:
            held = json.load(source)
        model, letters = held["model"], byte_letters()
        specials = {x["content"]: x["id"] for x in held["added_tokens"]}
        ids = model["vocab"]
        labels = [b""] * (max([*ids.values(), *specials.values()]) + 1)
        for token, k in ids.items():
            labels[k] = bytes(letters[c] for c in token)
        for token, k in specials.items():
            labels[k] = token.encode()
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        return cls(labels, np.array([[ids[u], ids[v], ids[u + v]] for u, v in merges], np.int32).reshape(-1, 3), specials)


class Automaton:
    """Tables of the automaton; `transition(u, w)` tells if an arc w leaves the state that u leads to."""

    def __init__(self, vocabulary: Vocabulary):
        size = len(vocabulary.labels)
        self.size, self.labels = size, vocabulary.labels
        self.born, self.left, self.right = [0] * size, [-1] * size, [-1] * size
        self.cut: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        special = set(vocabulary.specials.values())
        token = {b: k for k, b in enumerate(self.labels) if len(b) == 1 and k not in special}
        for number, (u, v, w) in enumerate(vocabulary.merges.tolist(), 1):
            # A gadget whose arc v is already missing behind u changes nothing: w can't occur.
            if self.has_arc(u, v):
                self.cut[u * size + v] = number
                self.born[w], self.left[w], self.right[w] = number, u, v
                token[self.labels[w]] = w
        self.token = token
        # For each label the longest shorter label it begins with, to fall back on.
        self.shorter = [-1] * size
        for label, k in token.items():
            self.shorter[k] = next((token[label[:n]] for n in range(len(label) - 1, 0, -1) if label[:n] in token), -1)
        self.prefixes = {label[:n] for label in token for n in range(1, len(label) + 1)}
        self._tables: Tables | None = None

    def has_arc(self, u: int, w: int) -> bool:
        """Follow the gadgets back: the state behind u was last split off by u, before u existed by its right part,
        and so on; the arc w came with its left part, and so on. The arc is missing if a gadget in reach took it."""
        size, cut, born = self.size, self.cut, self.born
        until_u = 1 << 60
        while u >= 0:
            y, until_y = w, 1 << 60
            while y >= 0:
                number = cut.get(u * size + y)
                if number is not None and number < until_u and number <= until_y:
                    return False
                y, until_y = self.left[y], born[y]
            u, until_u = self.right[u], born[u]
        return True

    def transition(self, u: int, w: int) -> bool:
        key = u * self.size + w
        known = self.arcs.get(key)
        if known is None:
            known = self.arcs[key] = self.has_arc(u, w)
        return known

    def longest(self, word: bytes, at: int) -> int:
        end, found = at + 1, -1
        while (part := word[at:end]) in self.prefixes:
            found = self.token.get(part, found)
            if end == len(word):
                break
            end += 1
        return found

    def encode_word(self, word: bytes) -> list[int]:
        whole = self.token.get(word)
        path: list[int] = []
        at, arc = 0, whole if whole is not None else self.longest(word, 0)
        while at < len(word):
            if path:
                while arc >= 0 and not self.transition(path[-1], arc):
                    arc = self.shorter[arc]
            if arc >= 0:
                path.append(arc)
                at += len(self.labels[arc])
                if at < len(word):
                    arc = self.longest(word, at)
            else:
                arc = path.pop()
                at -= len(self.labels[arc])
                arc = self.shorter[arc]
        return path

    def encode_many(self, chunks: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self._tables is None:
            self._tables = Tables(self)
        return self._tables.encode_many(chunks)


class HashedKeys:
    """Whole-array look-up of 64-bit keys: open addressing in a table at least four times as large."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * max(len(keys), 1) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        place, left = self._place(keys), np.arange(len(keys))
        while len(left):
            # Of those that want the same free place, the last one gets it; the others go on.
            free = self.keys[place[left]] < 0
            some = left[free]
            self.keys[place[some]], self.values[place[some]] = keys[some], values[some]
            left = left[self.keys[place[left]] != keys[left]]
            place[left] = (place[left] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of every key, -1 where it is missing."""
        place = self._place(keys)
        held = self.keys[place]
        out = np.where(held == keys, self.values[place], -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            place[left] = (place[left] + 1) & self.mask
            held = self.keys[place[left]]
            hit = held == keys[left]
            out[left[hit]] = self.values[place[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out


class Tables:
    """The automaton as arrays: a trie of its labels, the gadgets' cuts, and where labels come from."""

    def __init__(self, automaton: Automaton):
        self.size = automaton.size
        self.born, self.left, self.right, self.shorter = (
            np.array(x, np.int32) for x in (automaton.born, automaton.left, automaton.right, automaton.shorter))
        self.bytes = np.array([len(x) for x in automaton.labels], np.int32)
        self.cut = HashedKeys(np.array(list(automaton.cut), np.int64), np.array(list(automaton.cut.values()), np.int32))
        number = {b"": 0}
        for prefix in sorted(automaton.prefixes, key=len):
            number[prefix] = len(number)
        edges = [(number[p[:-1]] << 8 | p[-1], n) for p, n in number.items() if p]
        self.trie = HashedKeys(np.array([k for k, _ in edges], np.int64), np.array([n for _, n in edges], np.int32))
        self.label = np.full(len(number), -1, np.int32)
        self.label[[number[b] for b in automaton.token]] = list(automaton.token.values())
        self._alone: Automaton | None = automaton

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "pieces"}

    def longest(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For every byte, the longest label that begins there and ends by the end of its word."""
        out, at = np.full(len(data), -1, np.int32), np.arange(len(data))
        node, depth = np.zeros(len(data), np.int64), 0
        while len(at):
            node = self.trie.find(node << 8 | data[at + depth]).astype(np.int64)
            some = node >= 0
            at, node, depth = at[some], node[some], depth + 1
            label = self.label[node]
            out[at] = np.where(label >= 0, label, out[at])
            on = at + depth < ends[at]
            at, node = at[on], node[on]
        return out

    def has_arcs(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """`Automaton.has_arc` of all pairs at once."""
        out = np.ones(len(u), bool)
        rows, state, until = np.arange(len(u)), u.astype(np.int64), np.full(len(u), 1 << 30, np.int64)
        while len(rows):
            # Along the arcs that w came from, all of them against the same states.
            some, arc, arc_until = np.arange(len(rows)), w[rows].astype(np.int64), np.full(len(rows), 1 << 30, np.int64)
            while len(some):
                number = self.cut.find(state[some] * self.size + arc)
                taken = (number >= 0) & (number < until[some]) & (number <= arc_until)
                out[rows[some[taken]]] = False
                arc, arc_until, some = arc[~taken], self.born[arc[~taken]], some[~taken]
                arc = self.left[arc].astype(np.int64)
                on = arc >= 0
                arc, arc_until, some = arc[on], arc_until[on], some[on]
            on = out[rows]
            rows, state = rows[on], state[on]
            until, state = self.born[state].astype(np.int64), self.right[state].astype(np.int64)
            on = state >= 0
            rows, state, until = rows[on], state[on], until[on]
        return out

    def encode_words(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as bounds in `data`, none longer than LOCKSTEP_BYTES: one step of every word at a time."""
        words = len(begin)
        ends = np.zeros(len(data), np.int64)
        length = end - begin
        ends[spread(begin, length)] = np.repeat(end, length)
        best = self.longest(data, ends)
        path = np.full((words, int(length.max(initial=0)) + 1), -1, np.int32)
        top, at, arc = np.zeros(words, np.int64), begin.copy(), np.full(words, -1, np.int32)
        live = np.flatnonzero(length > 0)
        arc[live] = best[begin[live]]
        while len(live):
            here, a = top[live], arc[live]
            # The place before the first one is the last column, which is never filled.
            before = path[live, here - 1]
            tried = np.flatnonzero((a >= 0) & (here > 0))
            good = a >= 0
            good[tried] = self.has_arcs(before[tried], a[tried])
            go = live[good]
            path[go, top[go]] = arc[go]
            top[go] += 1
            at[go] += self.bytes[arc[go]]
            back = live[~good & (a < 0)]
            top[back] -= 1
            last = path[back, top[back]]
            at[back] -= self.bytes[last]
            arc[back] = self.shorter[last]
            stay = live[~good & (a >= 0)]
            arc[stay] = self.shorter[arc[stay]]
            on = at[go] < end[go]
            arc[go[on]] = best[at[go[on]]]
            live = np.concatenate([go[on], back, stay])
        return path[np.arange(path.shape[1]) < top[:, None]].astype(np.uint32), top

    def encode_many(self, chunks: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks end to end, and how many each has. Every distinct piece is encoded once."""
        chunks = chunks.to_pylist() if isinstance(chunks, pa.Array) else chunks
        if not hasattr(self, "pieces"):
            self.pieces = regex.compile(PIECES)
        found = [self.pieces.findall(c) for c in chunks]
        per_chunk = np.fromiter(map(len, found), np.int64, len(found))
        coded = pa.array(list(chain.from_iterable(found)), pa.string()).dictionary_encode()
        data, offsets = utf8(coded.dictionary)
        begin, end = offsets[:-1], offsets[1:]
        short = end - begin <= LOCKSTEP_BYTES
        counts, parts, place = np.zeros(len(begin), np.int64), [np.zeros(0, np.uint32)], np.zeros(len(begin), np.int64)
        done, at = np.flatnonzero(short), 0
        # By length, so that the paths of a block take little room.
        done = done[np.argsort((end - begin)[done], kind="stable")]
        for k in range(0, len(done), 65_536):
            some = done[k:k + 65_536]
            size = end[some] - begin[some]
            ends = np.cumsum(size)
            ids, n = self.encode_words(data[spread(begin[some], size)], ends - size, ends)
            parts.append(ids)
            counts[some], place[some] = n, at + np.cumsum(n) - n
            at += len(ids)
        for k in np.flatnonzero(~short):
            ids = np.array(self._alone.encode_word(data[begin[k]:end[k]].tobytes()), np.uint32)
            parts.append(ids)
            counts[k], place[k] = len(ids), at
            at += len(ids)
        flat, index = np.concatenate(parts), coded.indices.to_numpy()
        sizes = counts[index]
        owner = np.repeat(np.arange(len(chunks)), per_chunk)
        return flat[spread(place[index], sizes)], np.bincount(owner, sizes, len(chunks)).astype(np.int64)


class Decoder:
    """Bytes of the arc labels, end to end."""

    def __init__(self, labels: list[bytes]):
        self.size = np.array([len(x) for x in labels], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(labels), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of each text; bytes that are no UTF-8 become U+FFFD."""
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = np.empty(int(ends[-1]), np.uint8)
        # Laid out in stretches, as the places of all bytes would take far more room than the bytes.
        for k in range(0, len(ids), 100_000):
            some = slice(k, k + 100_000)
            data[ends[k]:ends[min(k + 100_000, len(ids))]] = self.data[spread(self.begin[ids[some]], size[some])]
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def encode_and_decode(documents: DataFrame, vocabulary_path: str, with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text of every row of `documents` (doc_id, text).

    `with_ids` and `with_text` add the ids and the decoded text themselves.
    """
    def step(ids, counts, tables):
        texts, ends = tables.decode(ids, counts), np.cumsum(counts)
        raw = ids.astype("<u4").tobytes()
        yield pa.array(counts)
        yield pa.array([hashlib.sha256(raw[4 * (e - n):4 * e]).hexdigest() for e, n in zip(ends, counts, strict=True)], pa.string())
        yield pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
        if with_ids:
            yield lists(ids.astype(np.int32), counts)
        if with_text:
            yield pa.array([t.decode() for t in texts], pa.string())

    more = ", ids array<int>" * with_ids + ", decoded string" * with_text
    return _each(documents, vocabulary_path, step, "n_tokens long, ids_sha256 string, decoded_sha256 string" + more)


def pickled(vocabulary: Vocabulary) -> bytes:
    """The finished automaton with its tables, and the special tokens."""
    automaton = Automaton(vocabulary)
    automaton._tables = Tables(automaton)
    return cloudpickle.dumps((automaton, vocabulary.specials))


def _each(documents: DataFrame, vocabulary_path: str, step, columns: str) -> DataFrame:
    docs = own_columns(documents, "doc_id", "text")
    # The vocabulary file bounds what is sent out: some MB, however many documents there are.
    read = Vocabulary.from_file(vocabulary_path)
    sent = docs.sparkSession.sparkContext.broadcast(pickled(read))
    name = hashlib.md5(sent.value).hexdigest()
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[c.strip().split(" ")[0] for c in columns.split(",")]]

    def run(batches):
        automaton, specials = per_worker(name, lambda: pickle.loads(sent.value))
        coder, tables = ChunkCoder(automaton.encode_many, specials), Decoder(automaton.labels)
        for piece in slices(batches, "text"):
            ids, counts = coder.encode(piece.column(1))
            yield pa.RecordBatch.from_arrays([piece.column(0), *step(ids, counts, tables)], names)

    return docs.mapInArrow(run, f"doc_id {kind}, {columns}")
