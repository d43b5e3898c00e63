"""Prefix trie of conversations from ternary search trees over range shards.

Turns travel as the md5 of role and text (with the role's length) and the bytes of the text, never as texts. Equal
sequences of turns are one entry before the trie is built. The entries are range-partitioned by sequence; each shard
encodes its turns with a dictionary of its own (codes in the order of the digests) and inserts its entries, the median
first, then the medians of both halves, and so on, into a ternary search tree, which is then balanced at every
level. One traversal from the last node to the first gathers members, children, leaves and savings.

A node that several shards share begins the first or the last entry of a shard. These nodes are left open: shards in
runs of neighbours are merged, what no longer lies on the first or last path of the run is closed, and runs of runs
follow until one is left, so that no task holds more than the paths of `merge_shards` shards.

Defined results: a null role or text is the empty one; turns sort by (turn, digest), so rows that share a turn have
a fixed order; repeated rows are repeated turns; rows without conv_id belong to no conversation; an empty table has no
nodes, not even a root. A conversation is one value: its turns (24 bytes each) must fit in a Spark row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pulsefold.llm.tables import own_columns, stored

STEP = 16
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Settings:
    """`family`: conversations whose ids share a multiple of it take their head from that one; `heads`: heads have fewer turns
    than this; `shard_turns`: turns of distinct sequences in a shard; `merge_shards`: shards merged at once; `block_ids`: ids
    in one piece of a list of members."""

    family: int = 5
    heads: int = 9
    shard_turns: int = 20_000
    merge_shards: int = 256
    block_ids: int = 50_000


def rebuilt(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """conv_id, key, seq (digests end to end), sizes (bytes of each text) of every rebuilt conversation: one shuffle."""
    c = own_columns(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)).cast("binary"))
    turns = c.select((F.col("conv_id") - F.col("conv_id") % settings.family).alias("family"), "conv_id", F.struct(
        "turn", digest.alias("digest"), F.octet_length(text).alias("size")).alias("t"))
    # Families are placed first: neither the grouping nor the window moves the rows again.
    own = turns.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    first = F.first(F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, settings.heads)), ignorenulls=True)
    own = own.withColumn("head", first.over(Window.partitionBy("family")))
    own = own.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % settings.heads).cast("int"))
    nothing = F.slice("own", 1, 0)
    whole = own.select("conv_id", F.concat(
        F.coalesce(F.slice("head", F.lit(1), F.col("h")), nothing),
        F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))).alias("whole"))
    seq = F.unhex(F.array_join(F.col("whole.digest"), ""))
    return whole.select("conv_id", F.unhex(F.md5(seq)).alias("key"), seq.alias("seq"), F.col("whole.size").alias("sizes"))


def members(whole: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """key, n, conv_id (smallest), ends_sha256 of the conversations with each key.

    Ids are written to pieces of lists where they lie in order, so a key that holds a third of all rows is spread over as
    many tasks as it needs; the digest, which can only be taken in order, then reads pieces as a stream.
    """
    per_piece = settings.block_ids

    def pieces(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            frame = batch.to_pandas()
            new = frame["key"] != frame["key"].shift()
            run = new.cumsum()
            run = run * (len(frame) + 1) + (frame.groupby(run).cumcount() // per_piece)
            out = frame.groupby(run, sort=False).agg(key=("key", "first"), first=("conv_id", "first"), n=("conv_id", "size"),
                                                     ids=("conv_id", lambda x: ",".join(map(str, x))))
            yield pa.RecordBatch.from_pandas(out, schema=_PIECES, preserve_index=False)

    def digests(batches: Iterator[pa.RecordBatch]):
        key, n, first, sha = None, 0, None, None
        for batch in batches:
            rows = []
            for k, f, m, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if key is not None:
                        rows.append((key, n, first, sha.hexdigest()))
                    key, n, first, sha = k, 0, f, hashlib.sha256()
                else:
                    sha.update(b",")
                n += m
                sha.update(ids.encode())
            yield _table(rows, _MEMBERS)
        if key is not None:
            yield _table([(key, n, first, sha.hexdigest())], _MEMBERS)

    kind = whole.schema["conv_id"].dataType.simpleString()
    parts = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = whole.select("key", F.col("conv_id").cast("long").alias("conv_id")).repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    listed = ranged.mapInArrow(pieces, "key binary, first long, n long, ids string")
    placed = listed.repartition("key").sortWithinPartitions("key", "first")
    return placed.mapInArrow(digests, "key binary, n long, conv_id long, ends_sha256 string").withColumn("conv_id", F.col("conv_id").cast(kind))


_PIECES = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
_MEMBERS = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())])
# Rows of a partial trie. Closed ones are final, but that parent_key names a parent that was still open; in open ones
# children, leaves and saved count what is closed below.
_NODES = pa.schema([
    ("open", pa.bool_()), ("place", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("size", pa.int64()), ("ends_sha256", pa.string())])
_SCHEMA = ("open boolean, place long, first boolean, last boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, "
           "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends_sha256 string")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class TernaryTree:
    """Arrays of a ternary search tree over turn codes; node 0 is the textless root, which has no code.

    `low` and `high` lead to siblings with a smaller or larger code, `down` to the children, `up` to the parent in the trie.
    """

    def __init__(self):
        self.code, self.low, self.high, self.down, self.up, self.depth, self.size = [-1], [-1], [-1], [-1], [-1], [0], [0]

    def insert(self, codes: list[int], sizes: list[int]) -> int:
        """The node at the end of `codes`, made where it is missing."""
        code, low, high, down = self.code, self.low, self.high, self.down
        at = 0
        for c, size in zip(codes, sizes, strict=True):
            node, link, from_ = down[at], down, at
            while node >= 0 and code[node] != c:
                link, from_ = (low, node) if c < code[node] else (high, node)
                node = link[node]
            if node < 0:
                node = len(code)
                link[from_] = node
                code.append(c)
                low.append(-1)
                high.append(-1)
                down.append(-1)
                self.up.append(at)
                self.depth.append(self.depth[at] + 1)
                self.size.append(size)
            at = node
        return at


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1: the median, then the medians of both halves, and so on."""
    ranges = [(0, n)]
    for begin, end in ranges:
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            ranges += [(begin, middle), (middle + 1, end)]


def shard_nodes(place: int, seqs: list[bytes], sizes: list[list[int]], n: list[int], ids: list[int], ends: list[str]) -> pa.RecordBatch:
    """Nodes of the trie of one shard, whose distinct sequences come in order."""
    digests = np.frombuffer(b"".join(seqs), f"S{STEP}")
    codes = np.unique(digests, return_inverse=True)[1].tolist()
    bounds = np.cumsum([0, *[len(s) // STEP for s in seqs]]).tolist()
    tree, end_of = TernaryTree(), {}
    for k in medians_first(len(seqs)):
        end_of[tree.insert(codes[bounds[k]:bounds[k + 1]], sizes[k])] = k
    count = len(tree.code)
    members, smallest, children, leaves, saved = [0] * count, [None] * count, [0] * count, [0] * count, [0] * count
    keys: dict[int, bytes] = {}
    on = [set(), set()]
    last_end = max(end_of, key=end_of.get)
    for side, node in enumerate((min(end_of, key=end_of.get), last_end)):
        k, path = end_of[node], []
        while node >= 0:
            path.append(node)
            node = tree.up[node]
        on[side] = set(path)
        key = hashlib.md5(b"").digest()
        for d, node in enumerate(reversed(path)):
            if d:
                key = hashlib.md5(key + seqs[k][(d - 1) * STEP:d * STEP]).digest()
            keys[node] = key
    # A child is always made after its parent: backwards, every node comes after all below it.
    for t in range(count - 1, -1, -1):
        k = end_of.get(t)
        if k is not None:
            members[t] += n[k]
            smallest[t] = ids[k] if smallest[t] is None else min(ids[k], smallest[t])
        p = tree.up[t]
        if p >= 0:
            members[p] += members[t]
            smallest[p] = smallest[t] if smallest[p] is None else min(smallest[t], smallest[p])
        if t not in keys:
            leaves[t] += not children[t]
            saved[t] += (members[t] - 1) * tree.size[t]
            children[p] += 1
            leaves[p] += leaves[t]
            saved[p] += saved[t]
    rows = []
    for t in range(count):
        p = tree.up[t]
        hashed = ends[end_of[t]] if t in end_of else None
        if t in keys:
            rows.append((True, place, t in on[0], t in on[1], keys[t], keys.get(p), smallest[t], tree.depth[t], None, members[t],
                         children[t], leaves[t], saved[t], tree.size[t], hashed))
        else:
            rows.append((False, place, False, False, None, keys.get(p), smallest[t], tree.depth[t], None if p in keys else smallest[p],
                         members[t], children[t], leaves[t], saved[t], tree.size[t], hashed or EMPTY))
    return _table(rows, _NODES)


def merged(frame: pd.DataFrame, final: bool) -> list[tuple]:
    """The open nodes of neighbouring shards as one partial trie. Its first and last path stay open unless it is `final`."""
    frame = frame.sort_values(["place", "depth"], kind="stable")
    low, high = frame["place"].min(), frame["place"].max()
    nodes: dict[bytes, list] = {}
    names = ["place", "first", "last", "key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "size", "ends_sha256"]
    for place, first, last, key, parent, conv, depth, n, children, leaves, saved, size, ends in zip(*(frame[x].tolist() for x in names), strict=True):
        first, last = first and place == low, last and place == high
        known = nodes.get(key)
        if known is None:
            nodes[key] = [first, last, parent, conv, depth, n, children, leaves, saved, size, ends]
        else:
            known[0] |= first
            known[1] |= last
            known[3] = min(known[3], conv)
            known[10] = known[10] or ends
            for j, v in ((5, n), (6, children), (7, leaves), (8, saved)):
                known[j] += v
    rows = []
    for key, v in sorted(nodes.items(), key=lambda item: -item[1][4]):
        first, last, parent, conv, depth, n, children, leaves, saved, size, ends = v
        above = nodes.get(parent)
        if (first or last) and not final:
            rows.append((True, int(low), first, last, key, parent, conv, depth, None, n, children, leaves, saved, size, ends))
            continue
        leaves += not children
        saved += (n - 1) * size
        closed = above is not None and (final or not (above[0] or above[1]))
        if above is not None:
            above[6] += 1
            above[7] += leaves
            above[8] += saved
        rows.append((False, int(low), False, False, key, None if closed or above is None else parent, conv, depth,
                     above[3] if closed else None, n, children, leaves, saved, size, ends or EMPTY))
    return rows


def _merging(final: bool):
    return lambda table: pa.Table.from_batches([_table(merged(table.to_pandas(), final), _NODES)])


def trie(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    whole = stored(rebuilt(conversations, settings), "rebuilt")
    spark = conversations.sparkSession
    distinct = whole.groupBy("key").agg(F.first("seq").alias("seq"), F.first("sizes").alias("sizes"))
    entries = stored(distinct.join(members(whole, settings), "key"), "sequences")
    turns = entries.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = max(1, -(-turns // settings.shard_turns))

    def build(batches):
        columns: list[list] = [[], [], [], [], []]
        for batch in batches:
            for held, column in zip(columns, batch.columns, strict=True):
                held.extend(column.to_pylist())
        if columns[0]:
            yield shard_nodes(TaskContext.get().partitionId(), *columns)

    ranged = entries.select("seq", "sizes", "n", F.col("conv_id").cast("long"), "ends_sha256").repartitionByRange(shards, "seq").sortWithinPartitions("seq")
    nodes = stored(ranged.mapInArrow(build, _SCHEMA), "trie")
    done, open_ = [nodes.where("not open")], nodes.where("open")
    last, run = open_.agg(F.max("place")).first()[0], 1
    while last is not None:
        run *= settings.merge_shards
        final = run > last

        # Places are the numbers of the first shards of a run, so neighbours stay neighbours.
        level = stored(open_.groupBy(F.floor(F.col("place") / run).alias("run")).applyInArrow(_merging(final), _SCHEMA), "trie")
        done.append(level.where("not open"))
        open_ = level.where("open")
        if final:
            break
    closed = done[0]
    for more in done[1:]:
        closed = closed.unionByName(more)
    # Few nodes were ever open, but their number grows with the shards: the engine measures before it broadcasts.
    were_open = closed.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    waiting = closed.where("parent_key is not null").join(were_open, "parent_key", "left").withColumn("parent_conv_id", F.col("found"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = closed.where("parent_key is null").select(columns).unionByName(waiting.select(columns))
    return out.withColumns({c: F.col(c).cast(kind) for c in ("conv_id", "parent_conv_id")})
