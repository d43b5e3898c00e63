"""Toxicity of texts whose words may be disguised: a noisy channel restores them, then the restored text is scored.

Most words are their own restoration. A word with digits or signs between its letters, with letters drawn out, or
spelled out with gaps, spans a lattice: each character is itself or a letter it stands for, a repeated letter
may count once, signs between letters may count for nothing. Viterbi search over the last letters finds the path
with the best sum of channel costs and character probabilities.

What may as well be no disguise is read both ways, as it stands and restored: words with a doubled letter, and two to PIECES
neighbouring pieces of one or two letters, joined. Words broken into longer pieces are not joined.

The character model (4-grams) is counted over all texts, merged by key, and normalised; it is bounded by its alphabet.
The classifier is learned from the labelled rows whose crc32(doc_id) mod 3 is not 1. Features are hashes of restored
words and of their beginnings. On a bounded sample of labelled rows (`train_rows`, half of it of either class where there
are as many) they are counted, those that tell the classes apart best are kept, and a logistic model over them is fitted.

Defined results: null, empty and wordless texts have no features and get the score of the intercept; rows without a
doc_id are never used for learning (they have no label); without labels of both classes every score is 0;
rows with several labels count once for each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.tables import own_columns, part_of, stored
from pulsefold.llm.texts import PLAIN, Words, cut, cut_bytes, lists, slices, spread, utf8

HELD_OUT_PARTS, HELD_OUT = 3, 1

# What disguising characters stand for, each with its channel cost (negative log probability).
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "#": "h", "&": "a", "€": "e", "£": "l",
}
SIGNS = "-._*~'^+#%&"
SWAP, DROP_REPEAT, DROP_SIGN, KEEP_SIGN = 1.0, 0.7, 0.8, 6.0

# Classes of bytes: letters (all of other alphabets' bytes too), and what may stand between or for them.
LETTER = np.array([chr(c).isalpha() if c < 128 else True for c in range(256)])
STAND_IN = np.zeros(256, bool)
STAND_IN[[ord(c) for c in "0123456789@$!|(" + SIGNS]] = True
SPACED, PIECES = 4, 10
# Letters with single gaps, then signs; up to so many choices a word are written out.
LETTERS_AND_GAPS = re.compile(r"((?:[^\W\d_]+ )*[^\W\d_]+)(\W*)")
CHOICES = 6

LETTERS = "abcdefghijklmnopqrstuvwxyz"
OTHER, EDGE, SYMBOLS = 26, 27, 28
START = (EDGE * SYMBOLS + EDGE) * SYMBOLS + EDGE
# Accented letters count as their base letter, all further letters as one symbol.
BASE_LETTER = str.maketrans("àâäáãåçéèêëíìîïñóòôöõúùûüÿß", "aaaaaaceeeeiiiinooooouuuuys")


@dataclass(frozen=True)
class Settings:
    """`features` and `train_rows` bound the classifier, not the character model."""

    features: int = 3000
    train_rows: int = 20_000
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    least_documents: int = 4
    epochs: int = 300
    rate: float = 0.1
    ridge: float = 1e-3
    beam: int = 4096
    remembered: int = 200_000


def codes(text: str) -> list[int]:
    """Symbols of a lower-case text's letters; anything else is an edge."""
    text = text.translate(BASE_LETTER)
    return [ord(c) - 97 if "a" <= c <= "z" else OTHER if c.isalpha() else EDGE for c in text]


def character_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | three symbols before) from the numbers of all 28**4 4-grams, smoothed towards shorter histories."""
    c4 = counts.reshape((SYMBOLS,) * 4).astype(np.float64)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for level in (c4.sum((0, 1, 2)), c4.sum((0, 1)), c4.sum(0), c4):
        p = (level + 4 * p) / (level.sum(-1, keepdims=True) + 4)
    return -np.log(p)


class Channel:
    """Restores disguised words under a character model; what it has restored is remembered."""

    def __init__(self, costs: np.ndarray, settings: Settings):
        self.cost, self.settings, self.known = costs, settings, {}
        # The same numbers for looking them up one by one.
        self.flat, self.options = costs.ravel().tolist(), {}

    def restore(self, seen: str) -> str:
        out = self.known.get(seen)
        if out is None:
            if len(self.known) > self.settings.remembered:
                self.known.clear()
            out = self.known[seen] = self.decode(seen.lower())
        return out

    def restore_many(self, seen: list[str]) -> list[str]:
        """`restore` of many words. Those of letters and gaps only, with few choices, are decoded together."""
        known, new = self.known, []
        if len(known) > self.settings.remembered:
            known.clear()
        new = [x for x in dict.fromkeys(seen) if x not in known]
        cores, tails, names = [], [], []
        for x in new:
            fits = LETTERS_AND_GAPS.fullmatch(x.lower())
            # One or two signs at the end may be letters, as in `decode`.
            if fits is None or fits[2] in ("@", "$", "@@", "@$", "$@", "$$"):
                known[x] = self.decode(x.lower())
            else:
                core, tail = fits.groups()
                cores.append(core)
                tails.append(tail)
                names.append(x)
        for name, tail, out in zip(names, tails, self.decode_letters(cores), strict=True):
            known[name] = out + tail
        return [known[x] for x in seen]

    def decode_letters(self, cores: list[str]) -> list[str]:
        """`decode` of words whose lattice only has choices between keeping and dropping: a repeated letter, a gap.

        Every path of such a lattice is written out and its costs are summed, for all words side by side; a word of
        more than CHOICES choices is searched alone.
        """
        out: list[str] = [""] * len(cores)
        points = np.frombuffer("".join(cores).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, cores), np.int64, len(cores))
        begin = np.cumsum(size) - size
        first = np.zeros(len(points), bool)
        first[begin[size > 0]] = True
        gap = points == 0x20
        choice = gap.copy()
        choice[1:] |= (points[1:] == points[:-1]) & ~first[1:]
        sums = np.concatenate([[0], np.cumsum(choice)])
        choices = sums[begin + size] - sums[begin]
        for k in np.flatnonzero(choices > CHOICES):
            out[k] = self.decode(cores[k])
        kinds_, place = np.unique(points, return_inverse=True)
        symbol = np.array([EDGE if c == 0x20 else codes(chr(c))[0] for c in kinds_.tolist()] or [0], np.int64)[place]
        table = self.cost.reshape(-1)
        for b in range(CHOICES + 1):
            group = np.flatnonzero((choices == b) & (size > 0))
            step = max(1, 20_000 >> b)
            for some in (group[k:k + step] for k in range(0, len(group), step)):
                n, paths = size[some], 1 << b
                # All paths of a word one behind the other; bit j of a path's number drops the j-th choice.
                at = spread(np.repeat(begin[some], paths), np.repeat(n, paths))
                path = np.repeat(np.arange(len(some) * paths), np.repeat(n, paths))
                nth = sums[at] - np.repeat(np.repeat(sums[begin[some]], paths), np.repeat(n, paths))
                drop = choice[at] & ((path % paths) >> np.minimum(nth, 62) & 1 == 1)
                costs = np.bincount(path, np.where(drop, np.where(gap[at], DROP_SIGN, DROP_REPEAT), np.where(gap[at], KEEP_SIGN, 0.0)), len(some) * paths)
                at, path = at[~drop], path[~drop]
                length = np.bincount(path, minlength=len(some) * paths)
                # Three edges before each path, one behind it.
                whole = np.full(len(at) + 4 * len(length), EDGE, np.int64)
                ends = np.cumsum(length + 4)
                whole[spread(ends - length - 1, length)] = symbol[at]
                inside = spread(ends - length - 1, length + 1)
                grams = ((whole[inside - 3] * SYMBOLS + whole[inside - 2]) * SYMBOLS + whole[inside - 1]) * SYMBOLS + whole[inside]
                costs += np.bincount(np.repeat(np.arange(len(length)), length + 1), table[grams], len(length))
                best = np.arange(len(some)) * paths + costs.reshape(-1, paths).argmin(1)
                starts = np.cumsum(length) - length
                text = points[at[spread(starts[best], length[best])]].tobytes().decode("utf-32-le")
                stop = np.cumsum(length[best]).tolist()
                for k, a, z in zip(some.tolist(), [0, *stop], stop):
                    out[k] = text[a:z]
        return out

    def decode(self, seen: str) -> str:
        """The best path through the lattice of `seen`. States are the last three symbols, as one number; the best `beam` go on, which is
        all of them unless several hundred signs stand in a row (28**3 states at most).

        Scores are per path, so a shorter reading is not preferred for being short: each character dropped
        costs what the channel asks for it.
        """
        end = len(seen)
        while end and not seen[end - 1].isalnum():
            end -= 1
        # One or two signs at the end may be letters; a longer tail is decoration.
        end += len(seen) - end if len(seen) - end < 3 and set(seen[end:]) <= {"@", "$"} else 0
        tail, seen = seen[end:], seen[:end]
        paths = {START: (0.0, "")}
        flat, before = self.flat, ""
        for char in seen:
            step: dict[int, tuple[float, str]] = {}
            letter, options = self.readings_of(char)
            repeated = letter and char == before
            before = char
            drop, keep = not letter and (char in SIGNS or char == " "), not letter
            for state, (cost, out) in paths.items():
                place = state * SYMBOLS
                moved = place % SYMBOLS**3
                for written, symbol, more in options:
                    offered = cost + more + flat[place + symbol]
                    held = step.get(moved + symbol)
                    if held is None or held[0] > offered:
                        step[moved + symbol] = (offered, out + written)
                if repeated or drop:
                    offered = cost + (DROP_REPEAT if repeated else DROP_SIGN)
                    held = step.get(state)
                    if held is None or held[0] > offered:
                        step[state] = (offered, out)
                if keep:
                    offered = cost + KEEP_SIGN + flat[place + EDGE]
                    held = step.get(moved + EDGE)
                    if held is None or held[0] > offered:
                        step[moved + EDGE] = (offered, out + char)
            paths = dict(sorted(step.items(), key=lambda x: x[1][0])[:self.settings.beam]) if len(step) > self.settings.beam else step
        best = min(((cost + flat[state * SYMBOLS + EDGE], out) for state, (cost, out) in paths.items()), default=(0.0, seen))
        return best[1] + tail

    def readings_of(self, char: str) -> tuple[bool, list[tuple[str, int, float]]]:
        """Whether a character is a letter, and what it may be read as: letter, symbol and channel cost."""
        found = self.options.get(char)
        if found is None:
            letter = char.isalpha()
            found = self.options[char] = (
                letter, [(char, codes(char)[0], 0.0)] if letter else [(c, ord(c) - 97, SWAP) for c in STANDS_FOR.get(char, "")])
        return found


def character_counts(docs: DataFrame) -> DataFrame:
    """gram, n: 4-grams of the letters of all texts, one row per gram and task before they are merged."""
    table = np.full(256, EDGE, np.int64)
    for k, c in enumerate(LETTERS):
        table[ord(c)] = table[ord(c.upper())] = k
    # Two-byte letters (Latin with accents) by their second byte; the first byte is passed over.
    accents = np.full(256, OTHER, np.int64)
    for k in range(0x80, 0xC0):
        base = chr(0xC0 + k - 0x80).lower().translate(BASE_LETTER)
        accents[k] = ord(base) - 97 if "a" <= base <= "z" else OTHER

    def run(batches):
        total = np.zeros(SYMBOLS**4, np.int64)
        for piece in slices(batches, "text"):
            data, _ = utf8(piece.column(0))
            second = np.concatenate([[False], data[:-1] == 0xC3])
            symbol = np.where(second, accents[data], np.where(data < 0x80, table[data], OTHER))[data != 0xC3]
            if len(symbol) > 3:
                total += np.bincount(((symbol[:-3] * SYMBOLS + symbol[1:-2]) * SYMBOLS + symbol[2:-1]) * SYMBOLS + symbol[3:], minlength=SYMBOLS**4)
        gram = np.flatnonzero(total)
        for k in range(0, len(gram), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(gram[k:k + 50_000].astype(np.int32)), pa.array(total[gram[k:k + 50_000]])], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are letters, and which are stand-ins, of more than one byte too."""
    letter, stands = LETTER[data], STAND_IN[data]
    for sign in (x.encode() for x in STANDS_FOR if len(x.encode()) > 1):
        found = np.flatnonzero(data[:len(data) - len(sign) + 1] == sign[0])
        for k in range(1, len(sign)):
            found = found[data[found + k] == sign[k]]
        for k in range(len(sign)):
            letter[found + k], stands[found + k] = False, True
    return letter, stands


def doubtful(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of what may be disguised or not: words with a doubled letter, and all of two to PIECES
    neighbouring words of one or two characters (and a sign behind them)."""
    data, n = words.data, len(words.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter, stands = kinds(data)
    lower = np.where(data < 0x80, data | 0x20, 0)
    double = np.zeros(len(data), bool)
    double[:-1] = letter[:-1] & letter[1:] & (lower[:-1] == lower[1:]) & (lower[:-1] > 0)
    sums = np.concatenate([[0], np.cumsum(double)])
    doubled = np.flatnonzero(sums[words.ends - 1] > sums[words.starts])
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    size = characters[words.ends] - characters[words.starts]
    behind = words.ends - 1
    piece = (letter | stands)[words.starts] & ((size <= 2) | ((size == 3) & ~letter[behind] & ~stands[behind]))
    # Pieces from each word on, to the end of its run.
    stop = np.flatnonzero(np.concatenate([~piece[:-1] | (words.doc[1:] != words.doc[:-1]), [True]]))
    at = np.flatnonzero(piece)
    left = stop[np.searchsorted(stop, at)] - at + 1
    first, last = [doubled], [doubled]
    for k in range(2, PIECES + 1):
        first.append(at[left >= k])
        last.append(first[-1] + k - 1)
    return np.concatenate(first), np.concatenate(last)


def suspects(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each disguised word: a stand-in before or behind a letter, a letter three times, or a
    run of at least SPACED words of one character."""
    data, n = words.data, len(words.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter, stands = kinds(data)
    marked = np.zeros(len(data), bool)
    marked[:-1] = stands[:-1] & letter[1:]
    marked[:-1] |= letter[:-1] & stands[1:]
    if len(data) > 2:
        marked[:-2] |= (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) & letter[:-2] & (data[:-2] < 0x80)
    # A mark counts within its word; signs that only end a word are punctuation.
    sums = np.concatenate([[0], np.cumsum(marked)])
    last = words.ends - 1
    for _ in range(2):
        tail = ~letter[np.maximum(last, words.starts)] & ~np.isin(data[np.maximum(last, words.starts)], np.frombuffer(b"0123456789", np.uint8))
        last = last - tail
    decorated = last - words.starts
    odd = sums[np.maximum(last, words.starts)] > sums[words.starts]
    size, behind = words.ends - words.starts, data[words.ends - 1]
    single = (letter | stands)[words.starts] & ((size == 1) | ((size == 2) & ~LETTER[behind] & ~STAND_IN[behind]))
    change = np.flatnonzero(np.concatenate([[True], (single[1:] != single[:-1]) | (words.doc[1:] != words.doc[:-1]), [True]]))
    begin, end = change[:-1], change[1:]
    runs = single[begin] & (end - begin >= SPACED)
    alone = np.flatnonzero(odd & ~single & (decorated > 0))
    return np.concatenate([alone, begin[runs]]), np.concatenate([alone, end[runs] - 1])


class Wanted:
    """Which of many hashes are among some. The last bits tell of most that they are not."""

    def __init__(self, some: np.ndarray):
        self.some, self.ends = np.sort(some), np.zeros(1 << 16, bool)
        self.ends[some.astype(np.uint16)] = True

    def among(self, hashes: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.ends[hashes.astype(np.uint16)])
        if not len(maybe):
            return maybe
        there = hashes[maybe]
        return maybe[self.some[np.minimum(np.searchsorted(self.some, there), len(self.some) - 1)] == there]


def features_of(column: pa.Array, channel: Channel, settings: Settings, only: Wanted | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of each text with its disguised words restored, and the text of each. Of features not in `only`
    nothing is kept."""
    data, offsets = utf8(column)
    words = cut_bytes(data, offsets)
    first, last = suspects(words)
    plain = PLAIN[data]
    # Capitals with accents: the second byte of a two-byte letter.
    accented = np.concatenate([[False], data[:-1] == 0xC3]) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    plain[accented] += 0x20
    a, b = words.starts[first], words.ends[last]
    also = doubtful(words)
    c, d = words.starts[also[0]], words.ends[also[1]]
    plain_words = cut_bytes(spread_blank(plain, a, b), offsets)
    found = [_hashed(plain_words, settings, only)]
    for begin, end, doc, joined in ((a, b, words.doc[first], False), (c, d, words.doc[also[0]], True)):
        # What is seen more than once is restored and hashed once.
        seen = stretches(data, begin, end).dictionary_encode()
        distinct = seen.dictionary.to_pylist()
        restored = pa.array(channel.restore_many([" ".join(x.split()) for x in distinct] if joined else distinct), pa.string())
        hashes, which = _hashed(cut(restored, PLAIN), settings, only)
        index = seen.indices.to_numpy()
        times = np.bincount(index, minlength=len(distinct))
        places = doc[np.argsort(index, kind="stable")]
        found.append((np.repeat(hashes, times[which]), places[spread((np.cumsum(times) - times)[which], times[which])]))
    hashes, doc = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], doc[new]


def spread_blank(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """`data` with spaces from each `begin` to its `end`."""
    data[spread(begin, end - begin)] = 0x20
    return data


def stretches(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The texts of bytes begin[k] to end[k]; cut at words, so that no character is split."""
    size = end - begin
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    whole = pa.py_buffer(np.ascontiguousarray(data[spread(begin, size)]))
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), whole)


def _hashed(words: Words, settings: Settings, only: Wanted | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of their beginnings, and the text of each, as far as they are in `only`."""
    hashes, doc = [], []
    for n, at, some in ((0, None, words.hashes()), *words.prefixes(settings.prefixes)):
        of, some = (words.doc, some) if at is None else (words.doc[at], some ^ np.uint64(n))
        kept = slice(None) if only is None else only.among(some)
        hashes.append(some[kept])
        doc.append(of[kept])
    return np.concatenate(hashes), np.concatenate(doc)


@dataclass
class Model:
    """What scoring needs: character costs, sorted feature hashes, their weights, the intercept."""

    costs: np.ndarray
    features: np.ndarray
    weights: np.ndarray
    intercept: float


def learn(docs: DataFrame, known: DataFrame, settings: Settings) -> Model | None:
    """Fit on the rows of `docs` with a label in `known` (doc_id, toxic); character counts come from all of `docs`.

    Only the sizes of the classes come from all labels; the sample drawn by a hash holds about `train_rows` / 2 of each at most, so
    it can be broadcast, and texts are not shuffled.
    """
    # 28**4 numbers at most, whatever the size of the corpus.
    counts = np.zeros(SYMBOLS**4, np.int64)
    grams = character_counts(docs).toPandas()
    counts[grams["gram"].to_numpy()] = grams["n"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(character_costs(counts))
    classes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (classes.get(0) and classes.get(1)):
        return None
    share = {c: min(1.0, settings.train_rows / 2 / n) for c, n in classes.items()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))

    def run(batches):
        channel = Channel(sent.value, settings)
        for piece in slices(batches, "text"):
            found, doc = features_of(piece.column(1), channel, settings)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(2), lists(found.view(np.int64), np.bincount(doc, minlength=len(piece)))],
                ["doc_id", "toxic", "features"])

    drawn = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    rows = stored(drawn.mapInArrow(run, "doc_id long, toxic int, features array<long>"), "features")
    seen = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (seen.get(0) and seen.get(1)):
        return None
    # How much more often a feature stands in toxic rows than in others, in deviations of its log odds.
    told = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").cast("double").alias("bad"), F.count("*").cast("double").alias("all"))
    bad, good = F.col("bad") + 0.5, F.col("all") - F.col("bad") + 0.5
    odds = F.log(bad / (seen[1] + 1)) - F.log(good / (seen[0] + 1))
    told = told.where(F.col("all") >= settings.least_documents).withColumn("z", F.abs(odds) / F.sqrt(1 / bad + 1 / good))
    chosen = np.sort(np.array([r["feature"] for r in told.orderBy(F.desc("z"), "feature").limit(settings.features).collect()], np.int64).view(np.uint64))
    if not len(chosen):
        return None
    kept = docs.sparkSession.sparkContext.broadcast(chosen)

    def only_kept(batches):
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy().view(np.uint64)
            place = np.minimum(np.searchsorted(kept.value, flat), len(kept.value) - 1)
            hit = kept.value[place] == flat
            doc = np.repeat(np.arange(len(batch)), np.diff(batch.column(2).offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists(flat[hit].view(np.int64), np.bincount(doc[hit], minlength=len(batch)))], batch.schema.names)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        features = kept.value
        flat = np.concatenate([np.asarray(x, np.int64) for x in pdf["features"]] or [np.zeros(0, np.int64)]).view(np.uint64)
        row = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["features"]])
        place = np.minimum(np.searchsorted(features, flat), len(features) - 1)
        hit = features[place] == flat
        row, place = row[hit], place[hit]
        target = pdf["toxic"].to_numpy(np.float64)
        # Each class counts by its share in all labelled rows, not in the sample.
        importance = np.where(target == 1, 1 / share[1], 1 / share[0])
        importance /= importance.sum()
        weights, intercept = np.zeros(len(features)), 0.0
        mean, square = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
        for step in range(1, settings.epochs + 1):
            margin = np.bincount(row, weights[place], len(pdf)) + intercept
            error = (1 / (1 + np.exp(-margin.clip(-30, 30))) - target) * importance
            grad = np.append(np.bincount(place, error[row], len(features)) + settings.ridge * weights / 10, error.sum())
            mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
            move = settings.rate * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
            weights, intercept = weights - move[:-1], intercept - move[-1]
        return pd.DataFrame({"weights": [weights.tobytes()], "intercept": [float(intercept)]})

    narrow = rows.mapInArrow(only_kept, "doc_id long, toxic int, features array<long>")
    row = narrow.groupBy(F.lit(0).alias("_all")).applyInPandas(fit, "weights binary, intercept double").first()
    return Model(sent.value, chosen, np.frombuffer(bytes(row["weights"])), row["intercept"])


def score(docs: DataFrame, model: Model | None, settings: Settings) -> DataFrame:
    """doc_id, score of every row of `docs` (doc_id, text)."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast((model.costs, model.features, model.weights, model.intercept))

    def run(batches):
        held = Model(*sent.value)
        channel, only = Channel(held.costs, settings), Wanted(held.features)
        for piece in slices(batches, "text"):
            found, doc = features_of(piece.column(1), channel, settings, only)
            margin = np.bincount(doc, held.weights[np.searchsorted(held.features, found)], len(piece)) + held.intercept
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(1 / (1 + np.exp(-margin.clip(-30, 30))))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def judge(documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), limit: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `documents` (doc_id, text), learned from `labels` (doc_id, toxic)."""
    docs = own_columns(documents, "doc_id", "text")
    held_out = part_of("doc_id", HELD_OUT_PARTS) == HELD_OUT
    known = own_columns(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out)
    known = known.withColumn("toxic", F.col("toxic").cast("int"))
    scored = score(docs, learn(docs, known, settings), settings)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
