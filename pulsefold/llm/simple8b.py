"""Token ids in binary files of word-aligned blocks (Simple-8b), and back.

A 64-bit word holds a selector in its top 4 bits and as many values of one width as fit below it. Packing is greedy:
the most values that fit. A value of more than 60 bits follows an escape word as a raw word. Values are packed in
blocks; the offset of every block lets blocks be decoded side by side.

File: magic, then counts of documents, values, blocks and words (4 unsigned 64-bit numbers), then per document
its id (signed) and number of values, per block its first word, then the words. All little-endian. A file never
holds part of a document.

Order over all files is ascending doc_id (nulls first, ties by text): rows are range-partitioned, sorted, and each task
writes files of bounded size under a name of its own attempt; only names that a finished task reports are
read, so a lost or repeated task leaves nothing behind but an unused file.

Defined results: a null or empty text has only the end id; repeated rows are written each; an empty table gives no file.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsefold.llm.presplit import ChunkCoder, Remembering, begins_blank, per_worker
from pulsefold.llm.tables import fresh_folder, own_columns, stored
from pulsefold.llm.texts import slices, spread

# How many values of how many bits each selector packs; the last selector marks an escape.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
ESCAPE = 15
MAGIC = b"S8BLOCK1"


@dataclass(frozen=True)
class Settings:
    """`file_values`: the ids after which a file ends with the document; `block`: values of a block."""

    block: int = 1024
    file_values: int = 2_000_000
    end_id: int = 0


def pack(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the first word of each block of `block` values."""
    # Whole blocks, as many at a time as keep the working arrays small.
    step = max(1, 128 * 1024 // block) * block
    parts = [_pack(values[k:k + step], block) for k in range(0, max(len(values), 1), step)]
    before = np.cumsum([0, *[len(words) for words, _ in parts[:-1]]])
    return np.concatenate([w for w, _ in parts]), np.concatenate([first + n for (_, first), n in zip(parts, before, strict=True)])


def _pack(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    small = int(values.max()) < 2**24
    bits = np.maximum(np.frexp(values.astype(np.float32 if small else np.float64))[1], 1)
    if not small:
        # Near a power of two a float rounds up: set that right.
        exact = bits.clip(1, 64).astype(np.uint64)
        bits = bits - ((exact > 1) & (values >> (exact - np.uint64(1)) == 0))
    # One row per block; what is missing in the last one is narrow enough for everything.
    blocks = -(-n // block)
    wide = np.zeros((blocks, block), np.int8)
    wide.ravel()[:n] = bits
    # For every place, the selector that would begin there: the last one that fits, from one value up to the most.
    chosen = np.full((blocks, block), ESCAPE, np.int8)
    beyond = np.zeros((blocks, block + 1), np.int32)
    for k in range(len(WIDTHS) - 1, -1, -1):
        np.cumsum(wide > WIDTHS[k], axis=1, out=beyond[:, 1:])
        span = min(int(COUNTS[k]), block)
        # Fewer values than a selector holds are only packed at the end of a block.
        last = np.concatenate([beyond[:, span:], np.broadcast_to(beyond[:, -1:], (blocks, span - 1))], 1)
        chosen[last == beyond[:, :-1]] = k
    chosen = chosen.ravel()[:n]
    room = np.concatenate([COUNTS, [1, 1]])[chosen]
    follow = np.minimum(np.arange(n) + room, np.minimum((np.arange(n) // block + 1) * block, n))
    # All blocks are walked side by side, one word of each at a time.
    begins = np.zeros(n, bool)
    at, stop = np.arange(0, n, block), np.minimum(np.arange(block, n + block, block), n)
    while len(at):
        begins[at] = True
        at = follow[at]
        on = at < stop
        at, stop = at[on], stop[on]
    starts = np.flatnonzero(begins)
    number, selector, count = starts // block, chosen[starts].astype(np.int64), follow[starts] - starts
    width = np.where(selector == ESCAPE, 0, WIDTHS[np.minimum(selector, len(WIDTHS) - 1)])
    packed = selector.astype(np.uint64) << np.uint64(60)
    some = np.flatnonzero(selector != ESCAPE)
    for j in range(int(count.max())):
        some = some[count[some] > j]
        packed[some] |= values[starts[some] + j] << (width[some] * j).astype(np.uint64)
    size = np.where(selector == ESCAPE, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = packed
    words[place[selector == ESCAPE] + 1] = values[starts[selector == ESCAPE]]
    return words, place[np.searchsorted(number, np.arange(-(-n // block)))]


def unpack(words: np.ndarray, first_word: np.ndarray, values: int, block: int) -> np.ndarray:
    """The values again. Which words are raw is known only from the word before, so blocks are walked side by side
    where there are escapes; all else is decoded at once."""
    raw = np.zeros(len(words), bool)
    marks = np.flatnonzero(words >> np.uint64(60) == ESCAPE)
    if len(marks):
        # A raw word can look like a mark: in a run of marks from a true one, every other word is raw.
        begins = np.concatenate([[True], (np.diff(marks) != 1) | np.isin(marks[1:], first_word)])
        runs = np.maximum.accumulate(np.where(begins, np.arange(len(marks)), 0))
        true = (np.arange(len(marks)) - runs) % 2 == 0
        raw[marks[true] + 1] = True
    heads = np.flatnonzero(~raw)
    selector = (words[heads] >> np.uint64(60)).astype(np.int64)
    width = np.concatenate([WIDTHS, [0, 0]])[selector].astype(np.uint64)
    count = np.concatenate([COUNTS, [0, 1]])[selector]
    # The last word of a block may be filled up: cut it to what the block holds.
    number = np.searchsorted(first_word, heads, "right") - 1
    before = np.cumsum(count) - count
    begin = before[np.searchsorted(heads, first_word)]
    held = np.minimum(block, values - np.arange(len(first_word)) * block)
    count = np.minimum(count, held[number] - (before - begin[number]))
    step = spread(np.zeros(len(count), np.int64), count).astype(np.uint64)
    wide = np.repeat(width, count)
    mask = (np.uint64(1) << wide) - np.uint64(1)
    out = (np.repeat(words[heads], count) >> (step * wide)) & mask
    escapes = np.flatnonzero(selector == ESCAPE)
    if len(escapes):
        out[(np.cumsum(count) - count)[escapes]] = words[heads[escapes] + 1]
    return out


def to_file(ids: np.ndarray, counts: np.ndarray, values: np.ndarray, block: int) -> bytes:
    words, first = pack(values, block)
    head = np.array([len(ids), len(values), len(first), len(words)], "<u8")
    return b"".join([MAGIC, head.tobytes(), ids.astype("<i8").tobytes(), counts.astype("<i8").tobytes(), first.astype("<i8").tobytes(), words.astype("<u8").tobytes()])


def from_file(blob: bytes, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, values per document, and all values of a file."""
    if blob[:8] != MAGIC:
        raise ValueError("not a file of packed token ids")
    docs, values, blocks, words = np.frombuffer(blob, "<u8", 4, 8).astype(np.int64).tolist()
    at, out = 40, []
    for kind, n in (("<i8", docs), ("<i8", docs), ("<i8", blocks), ("<u8", words)):
        out.append(np.frombuffer(blob, kind, n, at))
        at += 8 * n
    return out[0], out[1], unpack(out[3], out[2], values, block)


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with the scheme that Spark gives it, so that workers write where Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return "file://" + whole.removeprefix("file:") if whole.startswith("file:/") and not whole.startswith("file://") else whole


class LibraryCoder:
    """`encode_many` by the tokenizers library. Texts that begin with a space and a visible character are given to it in
    runs, as no piece crosses their beginnings; the bytes of the tokens tell where each ends."""

    RUN, AT_ONCE = 2_000, 8

    def __init__(self, library):
        # Spark has a task for every core: threads of the library would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = library
        ids = library.get_vocab(with_added_tokens=True)
        added = library.get_added_tokens_decoder()
        self.bytes = np.zeros(max(ids.values(), default=0) + 1, np.int64)
        for token, k in ids.items():
            self.bytes[k] = len(added[k].content.encode()) if k in added else len(token)

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        visible = pc.invert(pc.or_(begins_blank(pc.utf8_slice_codeunits(texts, 1, 2)), begins_blank(texts, last=True)))
        joins = pc.and_(pc.starts_with(texts, " "), pc.and_(pc.greater(pc.utf8_length(texts), 1), visible)).to_numpy(zero_copy_only=False)
        begins = np.ones(len(texts), bool)
        begins[1:] = ~(joins[1:] & joins[:-1]) | (np.arange(1, len(texts)) % self.RUN == 0)
        starts = np.flatnonzero(begins).tolist()
        ends = [*starts[1:], len(texts)]
        runs = pc.binary_join(pa.ListArray.from_arrays(pa.array([*starts, len(texts)], pa.int32()), texts), "") if len(texts) else texts
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        parts, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        for k in range(0, len(starts), self.AT_ONCE):
            found = self.library.encode_batch_fast(runs.slice(k, self.AT_ONCE).to_pylist(), add_special_tokens=False)
            for a, b, encoded in zip(starts[k:k + self.AT_ONCE], ends[k:k + self.AT_ONCE], found, strict=True):
                ids = np.array(encoded.ids, np.uint32)
                parts.append(ids)
                if b - a == 1:
                    counts[a] = len(ids)
                else:
                    at = np.cumsum(self.bytes[ids])
                    counts[a:b] = np.diff(np.searchsorted(at, np.cumsum(sizes[a:b]), "right"), prepend=0)
        return np.concatenate(parts), counts


def write(documents: DataFrame, vocabulary_path: str, settings: Settings = Settings()) -> DataFrame:
    """Encode `documents` (doc_id, text), write the files, and return the table of files: name, place in order, documents, values.

    doc_id must not be null in a file; a null is written as the least number and read back as null.
    """
    spark = documents.sparkSession
    docs = own_columns(documents, "doc_id", "text")
    folder = qualified(spark, fresh_folder(spark, "ids"))
    with open(vocabulary_path, encoding="utf-8") as source:
        sent = spark.sparkContext.broadcast(source.read())
    key = hashlib.md5(sent.value.encode()).hexdigest() + "-library"

    def make() -> ChunkCoder:
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(sent.value)
        library.no_padding()
        library.no_truncation()
        specials = {t.content: k for k, t in library.get_added_tokens_decoder().items()}
        encode_many = LibraryCoder(library).encode_many
        return ChunkCoder(encode_many, specials, Remembering(encode_many))

    def run(batches):
        coder = per_worker(key, make)
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        held, size, nth = [], 0, 0

        def flush():
            nonlocal held, size, nth
            ids, counts, values = (np.concatenate(x) for x in zip(*held, strict=True))
            name = f"{uuid.uuid4().hex}.s8b"
            with store.open_output_stream(f"{path}/{name}") as target:
                target.write(to_file(ids, counts, values, settings.block))
            row = pa.RecordBatch.from_pydict({"nth": pa.array([nth], pa.int64()), "name": [name], "docs": pa.array([len(ids)], pa.int64()),
                                              "n_values": pa.array([len(values)], pa.int64())})
            held, size, nth = [], 0, nth + 1
            return row

        for piece in slices(batches, "text", 10_000_000):
            ids, counts = coder.encode(piece.column(1))
            ends = np.cumsum(counts)
            values = np.insert(ids, ends, np.uint32(settings.end_id))
            held.append((piece.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(), counts + 1, values))
            size += len(values)
            if size >= settings.file_values:
                yield flush()
        if held:
            yield flush()

    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(parts, "doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    ranged = ranged.select("doc_id", "text")
    files = ranged.mapInArrow(run, "nth long, name string, docs long, n_values long").withColumn("part", F.spark_partition_id())
    return stored(files.withColumn("folder", F.lit(folder)), "id-files")


def read(spark: SparkSession, files: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files.

    `files` has one row per file, millions of ids each, so ordering it is small work. A file of the table that is
    missing, or holds other counts than the table says, is an error.
    """
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("n_values").over(before), F.lit(0)))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    # A file a task and more: the names are dealt out, the files are read where they are decoded.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.select("name", "base", "docs", "n_values", "folder").repartition(parts, "name")

    def run(batches):
        for batch in batches:
            for name, base, docs, n_values, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, path = fs.FileSystem.from_uri(place)
                if store.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{name} is missing")
                with store.open_input_file(f"{path}/{name}") as source:
                    ids, counts, values = from_file(source.read(), settings.block)
                if (len(ids), len(values)) != (docs, n_values):
                    raise ValueError(f"{name} holds {len(ids)} documents and {len(values)} ids, not {docs} and {n_values}")
                ends = np.cumsum(counts)
                data = values.astype("<u4").tobytes()
                crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                missing = ids == np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=missing), pa.array(base + ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return dealt.mapInArrow(run, schema)
