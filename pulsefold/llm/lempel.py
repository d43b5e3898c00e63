"""Repeated passages by relative Lempel-Ziv factors against an index of all documents.

A document's parse is a run of factors (reference document, start, length) and literal words. Only
factors of at least `window` words matter. The index that makes them findable holds, for every document,
its anchors: word groups of `gram` words that have the least hash in some window. Equal windows
choose equal anchors wherever they stand, so a window can only occur twice if its anchor does.

1. One pass over the texts gives word counts, the digest of all words, and the anchors.
2. Equal word sequences are folded: copies of a document are one factor of its whole length.
3. The index, dealt in blocks by anchor, tells which anchors several documents share.
4. Documents with shared anchors are read again; the windows around these anchors look up the smallest document
   holding the same window. From each place, a factor is extended while the next window is found in the same
   reference. Where it stops, the windows over the boundary have been looked up by themselves, so none
   is lost between two factors.

Hashes have 64 bits, window keys 128. Defined results: null and wordless texts have no words; texts shorter than
a window are kept; rows without doc_id are neither reference nor reduced; rows that share a doc_id do not
reduce each other; copies within one document stay.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.tables import own_columns, stored
from pulsefold.llm.texts import Words, cut, joined, lists, long_ngrams, mix, ngrams, slices

_TOP = np.iinfo(np.uint64).max


@dataclass(frozen=True)
class Settings:
    window: int = 50
    gram: int = 12


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(words: Words, hashes: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first word of every anchor, and for every window its first word and its anchor's hash.

    Returned as (anchor hashes, window starts, anchor hash of each window); an anchor is listed once for each window.
    """
    s, n = settings, len(hashes)
    starts = np.flatnonzero(words.doc[:max(0, n - s.window + 1)] == words.doc[s.window - 1:])
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(0, np.uint64)
    rank = np.full(n, _TOP, np.uint64)
    gram, at = ngrams(words, hashes, s.gram)
    rank[at] = mix(gram)
    chosen = least(rank, s.window - s.gram + 1)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (words.doc[starts[1:]] != words.doc[starts[:-1]])
    return chosen[new], starts, chosen


def survey(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, text_key, n_words, the digest of its words, and its distinct anchors."""
    def run(batches):
        for piece in slices(batches, "text", 1_000_000):
            words = cut(piece.column(1))
            hashes = words.hashes()
            _, starts, chosen = anchors(words, hashes, settings)
            doc = words.doc[starts]
            order = np.lexsort((chosen, doc))
            doc, chosen = doc[order], chosen[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (chosen[1:] != chosen[:-1])
            digests = [hashlib.sha256(x).digest() for x in joined(words, np.ones(len(words.starts), bool))]
            yield pa.RecordBatch.from_arrays([
                piece.column(0), piece.column(2), pa.array(np.diff(words.first())), pa.array(digests, pa.binary()),
                lists(chosen[new].view(np.int64), np.bincount(doc[new], minlength=len(piece))),
            ], ["doc_id", "text_key", "n_words", "digest", "anchors"])

    return docs.mapInArrow(run, "doc_id long, text_key long, n_words long, digest binary, anchors array<long>")


def windows(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, text_key, start and 128-bit key of each window whose anchor is among the row's `shared` ones."""
    def run(batches):
        for piece in slices(batches, "text", 1_000_000):
            words = cut(piece.column(1))
            hashes = words.hashes()
            _, starts, chosen = anchors(words, hashes, settings)
            wanted = piece.column(3)
            owner = np.repeat(np.arange(len(piece)), np.diff(wanted.offsets.to_numpy()))
            # An anchor counts where its own document lists it.
            listed = np.unique(mix(wanted.flatten().to_numpy().view(np.uint64)) ^ mix(owner.astype(np.uint64)))
            mine = mix(chosen) ^ mix(words.doc[starts].astype(np.uint64))
            some = np.isin(mine, listed)
            key_a, at = long_ngrams(words, hashes, settings.window)
            key_b, _ = long_ngrams(words, mix(hashes), settings.window)
            # Windows are numbered alike in both: all runs of `window` words within a document.
            first = words.first()[:-1][words.doc[at]]
            yield pa.RecordBatch.from_arrays([
                piece.column(0).take(pa.array(words.doc[at[some]])), piece.column(2).take(pa.array(words.doc[at[some]])),
                pa.array((at - first)[some].astype(np.int32)), pa.array(key_a[some].view(np.int64)), pa.array(key_b[some].view(np.int64)),
            ], ["doc_id", "text_key", "start", "key_a", "key_b"])

    return docs.mapInArrow(run, "doc_id long, text_key long, start int, key_a long, key_b long")


def parse(found: DataFrame, settings: Settings) -> DataFrame:
    """Factors of each document from its windows' references: (first word, words, reference document)."""
    def factors(key, table):
        # Extended greedily: as long as the next window is found in the same reference.
        order = np.argsort(table.column("start").to_numpy())
        start = table.column("start").to_numpy()[order].astype(np.int64)
        reference = table.column("reference").to_numpy()[order]
        cuts = np.flatnonzero((np.diff(start) != 1) | (np.diff(reference) != 0)) + 1
        begin, end = start[np.concatenate([[0], cuts])], start[np.concatenate([cuts - 1, [len(start) - 1]])]
        return pa.table({
            "doc_id": pa.array([key[0].as_py()], pa.int64()), "text_key": pa.array([key[1].as_py()], pa.int64()),
            "begin": lists(begin, np.array([len(begin)])), "length": lists(end - begin + settings.window, np.array([len(begin)])),
            "reference": lists(reference[np.concatenate([[0], cuts])], np.array([len(begin)])),
        })

    return found.groupBy("doc_id", "text_key").applyInArrow(
        factors, "doc_id long, text_key long, begin array<long>, length array<long>, reference array<long>")


def reduce(parsed: DataFrame) -> DataFrame:
    """doc_id, text_key, n_removed, kept_sha256 and the kept text of rows (doc_id, text_key, text, begin, length)."""
    def run(batches):
        for piece in slices(batches, "text", 1_000_000):
            words = cut(piece.column(2))
            first = words.first()
            edge = np.zeros(len(words.starts) + 1, np.int64)
            begin, length = piece.column(3), piece.column(4)
            owner = np.repeat(np.arange(len(piece)), np.diff(begin.offsets.to_numpy()))
            at = first[owner] + begin.flatten().to_numpy()
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length.flatten().to_numpy(), -1)
            gone = np.cumsum(edge)[:-1] > 0
            kept = joined(words, ~gone)
            yield pa.RecordBatch.from_arrays([
                piece.column(0), piece.column(1), pa.array(np.bincount(words.doc[gone], minlength=len(piece)).astype(np.int64)),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array([x.decode("utf-8", "replace") for x in kept], pa.string()),
            ], ["doc_id", "text_key", "n_removed", "kept_sha256", "kept_text"])

    return parsed.mapInArrow(run, "doc_id long, text_key long, n_removed long, kept_sha256 string, kept_text string")


def deduplicate(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of `documents` (doc_id, text)."""
    docs = own_columns(documents, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    seen = stored(survey(docs.select("doc_id", "text", "text_key"), settings), "survey")
    # Copies: all but the smallest document go as one factor.
    long_enough = seen.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= settings.window))
    smallest = long_enough.groupBy("digest").agg(F.min("doc_id").alias("original"))
    owners = smallest.select(F.col("original").alias("doc_id"), "digest").join(long_enough, ["doc_id", "digest"]).select(
        "doc_id", "text_key", F.explode("anchors").alias("anchor")).distinct()
    owners = stored(owners, "anchors")
    shared = owners.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    wanted = owners.join(shared, "anchor").groupBy("doc_id", "text_key").agg(F.collect_set("anchor").alias("shared"))
    texts = stored(docs.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text", "text_key", "shared"), "parsed-texts")
    looked = stored(windows(texts, settings), "windows")
    lowest = looked.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("reference"), F.max("doc_id").alias("last")).where("reference < last")
    found = looked.join(lowest.drop("last"), ["key_a", "key_b"]).where("reference < doc_id").select("doc_id", "text_key", "start", "reference")
    spans = parse(found, settings)
    cut_rows = reduce(texts.select("doc_id", "text_key", "text").join(spans, ["doc_id", "text_key"]).select(
        "doc_id", "text_key", "text", "begin", "length")).select("doc_id", "text_key", "n_removed", "kept_sha256")
    cut_rows = cut_rows.dropDuplicates(["doc_id", "text_key"])
    rows = seen.drop("anchors").join(smallest, "digest", "left").join(cut_rows, ["doc_id", "text_key"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("original"), F.lit(False))
    return rows.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )
