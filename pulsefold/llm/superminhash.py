"""Near-duplicate groups by SuperMinHash signatures, banding, full verification and connected components.

SuperMinHash gives each shingle a random permutation of the signature's slots; in round j a
shingle offers j plus a fraction to the j-th slot of its permutation. The ranks of one shingle are
correlated, which lowers the variance against independent hashes, and rounds stop as soon as all
slots hold a value below the next round's: later offers can't win any more.

Equal sets are folded first, so copies cost one representative however many there are. A band of equal slots
names a bucket; every member of a bucket is held against its smallest member on the full
sets. Members left in different components of one bucket are then compared among each other, unless size or
signature rule a link out; so a bucket of true copies costs one comparison per member, and no link is lost to
the star.

Defined results: null and wordless texts have an empty set, are linked with nothing and kept. Rows that
share a doc_id count as one document with the sets of all of them. A row without doc_id is
linked with nothing, has no component and is kept. Other columns are left aside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.components import components
from pulsefold.llm.tables import own_columns, stored
from pulsefold.llm.texts import LOWER, Words, cut, lists, mix, ngrams, slices


@dataclass(frozen=True)
class Settings:
    """A pair at the threshold meets in a band but for a chance of (1 - 0.8**rows)**bands, here 5e-8."""

    shingle: int = 4
    percent: int = 80
    bands: int = 32
    rows: int = 4
    # A pair whose signatures agree in fewer slots than this share of the threshold isn't verified; see `rest`.
    doubt: float = 0.75
    # Second look at what is left in large buckets: one bit of each of so many slots, and the least estimated similarity.
    fine_slots: int = 2048
    fine_doubt: float = 0.91

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each document, and the document of each.

    A document with fewer than `size` words has them all as its one shingle.
    """
    hashes = words.hashes()
    grams, at = ngrams(words, hashes, size)
    doc = words.doc[at]
    first = words.first()
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.array([_whole(hashes[first[d]:first[d + 1]]) for d in short], np.uint64)
        grams, doc = np.concatenate([grams, whole]), np.concatenate([doc, short])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[new], doc[new]


def _whole(hashes: np.ndarray) -> int:
    total = np.zeros(1, np.uint64)
    for h in hashes:
        total = mix(total * np.uint64(31) + h)
    return total[0]


def signatures(grams: np.ndarray, doc: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """SuperMinHash of every document: docs x slots; a document without shingles keeps the greatest value."""
    best = np.full(docs * slots, np.iinfo(np.uint64).max, np.uint64)
    rows, owner, ranks = grams, doc, None
    for j in range(slots):
        random = mix(rows ^ np.uint64(j * 0xD1B54A32D192ED03 % 2**64))
        swap = j + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot = swap
        else:
            at = np.arange(len(rows))
            slot = ranks[at, swap].astype(np.int64)
            ranks[at, swap] = ranks[:, j]
        np.minimum.at(best, owner * slots + slot, (np.uint64(j) << np.uint64(32)) | (random >> np.uint64(32)))
        # Documents whose every slot is settled take no further part.
        open_doc = best.reshape(docs, slots).max(1) >= np.uint64(j + 1) << np.uint64(32)
        keep = open_doc[owner]
        if not keep.any():
            break
        if ranks is None:
            rows, owner, first = rows[keep], owner[keep], slot[keep]
            ranks = np.tile(np.arange(slots, dtype=np.uint16 if slots > 256 else np.uint8), (len(rows), 1))
            ranks[np.arange(len(rows)), first] = 0
        elif not keep.all():
            rows, owner, ranks = rows[keep], owner[keep], ranks[keep]
    return best.reshape(docs, slots)


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, set size, a 128-bit fingerprint of the set, band hashes, and one byte of every slot."""
    s = settings

    def run(batches):
        for piece in slices(batches, "text", 1_000_000):
            n = len(piece)
            grams, doc = shingle_sets(cut(piece.column(1), LOWER), s.shingle)
            size = np.bincount(doc, minlength=n)
            first = np.searchsorted(doc, np.arange(n))
            sums = [np.zeros(n, np.uint64) for _ in range(2)]
            for k, total in enumerate(sums):
                np.add.at(total, doc, mix(grams + np.uint64(k + 1)))
            best = signatures(grams, doc, n, s.slots)
            banded = best.reshape(n, s.bands, s.rows)
            bands = np.broadcast_to(np.arange(s.bands, dtype=np.uint64), (n, s.bands)).copy()
            for r in range(s.rows):
                bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + banded[:, :, r])
            full = size > 0
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array(size.astype(np.int64)), *[pa.array(x.view(np.int64)) for x in sums],
                lists(bands[full].ravel().view(np.int64), np.where(full, s.bands, 0)),
                lists((best[full] & np.uint64(0xFF)).astype(np.uint8).view(np.int8).ravel(), np.where(full, s.slots, 0)),
            ], ["doc_id", "n_shingles", "set_a", "set_b", "bands", "slots"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, slots array<tinyint>")


def full_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and its whole shingle set."""
    def run(batches):
        for piece in slices(batches, "text", 1_000_000):
            grams, doc = shingle_sets(cut(piece.column(1), LOWER), settings.shingle)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), lists(grams.view(np.int64), np.bincount(doc, minlength=len(piece)))], ["doc_id", "grams"])

    return docs.mapInArrow(run, "doc_id long, grams array<long>")


def fine_sketches(sets: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and one bit of each of many slots, packed in 64-bit words, from whole sets."""
    slots = settings.fine_slots

    def run(batches):
        for batch in batches:
            size = np.diff(batch.column(1).offsets.to_numpy())
            at = 0
            while at < len(batch):
                # Few enough shingles at a time for their permutations to stay small.
                end = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at:]), 8000, "right")))
                part = batch.slice(at, end - at)
                grams = part.column(1).flatten().to_numpy().view(np.uint64)
                best = signatures(grams, np.repeat(np.arange(end - at), size[at:end]), end - at, slots)
                bits = np.packbits((best & np.uint64(1)).astype(np.uint8), axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), lists(bits.view(np.int64).ravel(), np.full(end - at, slots // 64))], ["doc_id", "bits"])
                at = end

    return sets.mapInArrow(run, "doc_id long, bits array<long>")


def verified(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left, right = (sets.select(F.col("doc_id").alias(k), F.col("grams").alias(f"{k}_grams")) for k in "ab")
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("a_grams", "b_grams"))
    union = F.size("a_grams") + F.size("b_grams") - F.col("common")
    return both.withColumn("common", common).where(100 * F.col("common") >= settings.percent * union).select("a", "b")


def links(docs: DataFrame, sketch: DataFrame, settings: Settings) -> DataFrame:
    """Verified links between representatives of equal sets: enough of them to give every component."""
    named = sketch.where("n_shingles > 0 and doc_id is not null")
    representatives = named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    banded = named.join(representatives.hint("merge"), "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("bucket")).distinct()
    buckets = banded.groupBy("bucket").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).where("lead < last")
    shared = stored(banded.join(buckets.select("bucket", "lead").hint("merge"), "bucket"), "buckets")
    # The one time texts are shuffled, and the sets of those that share a bucket are kept. A merge at every size:
    # nothing here is broadcast.
    wanted = shared.select("doc_id").distinct()
    sets = stored(full_sets(docs.join(wanted.hint("merge"), "doc_id", "left_semi").select("doc_id", "text"), settings), "sets")
    star = stored(shared.where("doc_id <> lead").select(F.col("doc_id").alias("a"), F.col("lead").alias("b")).distinct(), "star")
    first = stored(verified(star, sets, settings), "links")
    return first.unionByName(rest(sets, named, shared, star, first, settings))


def rest(sets: DataFrame, named: DataFrame, shared: DataFrame, tried: DataFrame, found: DataFrame, settings: Settings) -> DataFrame:
    """Links between members that the stars left in different components of one bucket.

    Most pairs are ruled out before their sets are compared. Exactly: shingles that no other open document has
    are in no intersection, so with `own` of them two sets share at most c = min(n - own), and c must reach
    the threshold of n + n' - c. And by signature: at the threshold the share of equal slots has a deviation below
    sqrt(0.8 * 0.2 / slots), so falling under `doubt` of it is five to six deviations off. The same holds for the
    bits of the finer signature, two of which agree by (1 + similarity) / 2, and for `fine_doubt`.
    """
    roots = components(found)
    placed = shared.join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
    open_rows = stored(placed.join(mixed.hint("merge"), "bucket", "left_semi"), "open")
    open_docs = open_rows.select("doc_id").distinct()
    grams = sets.join(open_docs.hint("merge"), "doc_id", "left_semi").select("doc_id", F.explode("grams").alias("gram"))
    alone = grams.groupBy("gram").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")).where("doc_id = last")
    own = alone.groupBy("doc_id").agg(F.count("*").alias("own"))
    sketched = named.select("doc_id", "n_shingles", "slots", "bands").dropDuplicates(["doc_id"])
    described = sketched.join(open_docs.hint("merge"), "doc_id", "left_semi").join(own.hint("merge"), "doc_id", "left").select(
        "doc_id", "n_shingles", "slots", "bands", (F.col("n_shingles") - F.coalesce("own", F.lit(0))).alias("common"))
    # A document that can't reach the threshold with any set is settled.
    described = stored(described.where(100 * F.col("common") >= settings.percent * F.col("n_shingles")), "described")
    hopeful = sets.join(described.select("doc_id").hint("merge"), "doc_id", "left_semi")
    described = described.join(fine_sketches(hopeful, settings).dropDuplicates(["doc_id"]).hint("merge"), "doc_id")
    open_rows = open_rows.join(described.hint("merge"), "doc_id")
    left, right = (open_rows.select("bucket", *[F.col(c).alias(f"{k}_{c}") for c in ("doc_id", "root", "n_shingles", "common", "slots", "bands", "bits")]) for k in "ab")
    same = F.size(F.filter(F.zip_with("a_slots", "b_slots", lambda x, y: x == y), lambda x: x))
    most = F.least("a_common", "b_common")
    apart = F.aggregate(F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    possible = (
        (left["bucket"] == right["bucket"]) & (F.col("a_root") != F.col("b_root")) & (F.col("a_doc_id") > F.col("b_doc_id"))
        & (100 * most >= settings.percent * (F.col("a_n_shingles") + F.col("b_n_shingles") - most))
        & (same >= int(settings.doubt * settings.percent / 100 * settings.slots))
        & (apart <= int(settings.fine_slots * (1 - settings.fine_doubt * settings.percent / 100) / 2))
        # A pair that meets in several buckets is taken in one of them.
        & (F.array_min(F.array_intersect("a_bands", "b_bands")) == left["bucket"])
    )
    pairs = left.join(right, possible).select(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b")).distinct()
    pairs = stored(pairs.join(tried.hint("merge"), ["a", "b"], "left_anti"), "rest")
    return verified(pairs, sets, settings)


def group(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `documents` (doc_id, text)."""
    docs = own_columns(documents, "doc_id", "text")
    sketch = stored(sketches(docs, settings), "sketches")
    roots = components(links(docs, sketch, settings))
    named = sketch.where("n_shingles > 0 and doc_id is not null")
    lowest = named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("representative"))
    lowest = lowest.join(roots.withColumnRenamed("node", "representative"), "representative", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("root", "representative").alias("root"))
    rows = sketch.select("doc_id", "n_shingles", "set_a", "set_b").join(lowest, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id"))
    out = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_of_groups(documents: DataFrame, settings: Settings = Settings(shingle=5)) -> DataFrame:
    """The rows of `documents` (all columns) that stand for their group; of rows sharing a doc_id one stays.

    Rows without doc_id stay.
    """
    copies = group(documents, settings).where(~F.col("kept")).select("doc_id").distinct()
    named = documents.where("doc_id is not null").join(copies.hint("merge"), "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return named.select(*documents.columns).unionByName(documents.where("doc_id is null"))
