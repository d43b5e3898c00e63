"""Near copies among embeddings of one label: a robust-pruned graph searched by every vector within a range.

1. Equal vectors of a label are one node with its number of copies.
2. A label is cut into regions, and a region into shards, by centres fitted to a bounded sample of each cell until every
   cell is small enough; all nodes are assigned. A node also visits the regions nearly as close as its own and stands in
   the `overlap` nearest shards.
3. Each shard builds a graph of its own by inserts with robust pruning and names its medoid.
4. Each region unites the lists of its shards and is searched by every node in it: greedily from the medoids, then expanded
   through all that lies within the range. What is found is verified in double precision and taken in both directions.
   A pair that two regions share counts in the first of them. A region gives one row per linked node: its links and the
   smallest node linked with it, so no row stands for a pair, however dense a group is.
5. Components of these rows are those of all links.
6. An audit compares the links of a few hundred nodes with all vectors of their label; below the wanted recall, graph, beam
   and overlap grow and steps 2 to 5 are done again.

Defined results: vectors that are null, empty, zero or hold null or non-finite entries, and rows without a label, link
with nothing. Vectors of different lengths never link. Repeated vec_ids are separate vectors that share a name. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import warnings
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from pulsefold.llm import graphs
from pulsefold.llm.components import components
from pulsefold.llm.tables import own_columns, stored
from pulsefold.llm.texts import lists, spread
from pulsefold.llm.whitening import usable

BROADCAST_CELLS = 2_000


@dataclass(frozen=True)
class Settings:
    """`region_rows` and `shard_rows` bound the nodes of a cell; `sample` is the number of nodes drawn per centre (at most 16
    centres a cell); `slack` is the angle by which a visited region may be farther than the own one, in parts of the
    angle of `cosine`; `margin` widens the range that is expanded; `audited` nodes measure the recall."""

    cosine: float = 0.93
    region_rows: int = 10_000
    shard_rows: int = 1_500
    sample: int = 64
    overlap: int = 2
    slack: float = 0.5
    degree: int = 24
    alpha: float = 1.2
    beam: int = 32
    margin: float = 0.03
    audited: int = 200
    recall: float = 0.95
    attempts: int = 3


def keyed(embeddings: DataFrame, with_vectors: bool) -> DataFrame:
    """vec_id, key (16 bytes of label and vector; null where the vector can't link), and on request label and vec (raw bytes)."""
    e = own_columns(embeddings, "vec_id", "label", "embedding").withColumn("label", F.col("label").cast("string"))
    kind = e.schema["vec_id"].dataType.simpleString()
    raw = _raw_type(embeddings)

    def run(batches):
        for batch in batches:
            at, length, values = usable(batch.column(2))
            labels, values = batch.column(1).to_pylist(), values.astype(raw)
            keys, held = [None] * len(batch), [None] * len(batch)
            ends = np.cumsum(length)
            for i, end, n in zip(at.tolist(), ends.tolist(), length.tolist(), strict=True):
                vector = values[end - n:end]
                if labels[i] is not None and vector.any():
                    held[i] = (vector + 0).tobytes()
                    keys[i] = hashlib.md5(f"{len(labels[i])}:{labels[i]}".encode() + held[i]).digest()
            columns = {"vec_id": batch.column(0), "key": pa.array(keys, pa.binary())}
            if with_vectors:
                columns |= {"label": batch.column(1), "vec": pa.array(held, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    return e.mapInArrow(run, f"vec_id {kind}, key binary" + ", label string, vec binary" * with_vectors)


def _raw_type(embeddings: DataFrame) -> str:
    return "<f8" if isinstance(embeddings.schema["embedding"].dataType.elementType, DoubleType) else "<f4"


def nodes_of(embeddings: DataFrame) -> DataFrame:
    """id, key, cell (label and length), vec, smallest (vec_id), copies of every distinct vector of a label."""
    rows = keyed(embeddings, True).where("key is not null")
    distinct = rows.groupBy("key").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.min("vec_id").alias("smallest"), F.count("*").alias("copies"))
    cell = F.concat_ws(":", F.octet_length("vec").cast("string"), "label")
    return distinct.select(F.monotonically_increasing_id().alias("id"), "key", cell.alias("cell"), "vec", "smallest", "copies")


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def vectors(column: pa.Array, raw: str) -> np.ndarray:
    """Raw bytes of equally long vectors as rows of doubles."""
    data = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column.cast(pa.binary())), b"")[0].as_buffer() \
        if len(column) else b""
    return np.frombuffer(data, raw).reshape(len(column), -1).astype(np.float64)


def divide(rows: DataFrame, limit: int, raw: str, settings: Settings, shards: bool) -> DataFrame:
    """`rows` (region, cell, id, vec, copies, home) with cells of at most `limit` nodes at home.

    Each round cuts the cells that are too large. A node goes home to the nearest centre and visits others: as a shard member
    the next `overlap` - 1, otherwise all within the slack. Visitors stay with their nearest centre in later rounds.
    """
    most_angle = settings.slack * math.acos(settings.cosine)
    for round_ in range(64):
        sizes = stored(rows.where("home").groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > limit), "cells")
        large = sizes.count()
        if not large:
            return rows
        hint = F.broadcast if large <= BROADCAST_CELLS else (lambda df: df)
        fan = F.least(F.lit(16), F.ceil(F.col("size") * 1.5 / limit).cast("int"))
        chance = F.pmod(F.xxhash64("id", F.lit(round_)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        sample = rows.where("home").join(hint(sizes), "cell").withColumn("fan", fan)
        sample = sample.where(chance < F.col("fan") * settings.sample / F.col("size")).select("cell", "vec", "fan", "id")

        def fit(table: pa.Table) -> pa.Table:
            table = table.sort_by("id").combine_chunks()
            points = unit(vectors(table.column("vec").combine_chunks(), raw))
            centres = graphs.k_means(points, table.column("fan")[0].as_py(), 0)
            return pa.table({"cell": table.column("cell")[:1], "centres": pa.array([centres.astype("<f8").tobytes()], pa.binary())})

        centres = stored(sample.groupBy("cell").applyInArrow(fit, "cell string, centres binary"), "centres")

        def assign(batches):
            for batch in batches:
                cells = batch.column("cell").dictionary_encode()
                for number, cell in enumerate(cells.dictionary.to_pylist()):
                    some = batch.filter(pc.equal(cells.indices, number))
                    held = some.column("centres")[0].as_py()
                    some = some.drop_columns(["centres"])
                    if held is None:
                        yield some
                        continue
                    points = unit(vectors(some.column("vec"), raw))
                    middle = np.frombuffer(held, "<f8").reshape(-1, points.shape[1])
                    far = graphs.distances(points, middle)
                    nearest = far.argmin(1)
                    home = some.column("home").to_numpy(zero_copy_only=False)
                    if shards:
                        visits = far.argsort(1).argsort(1) < settings.overlap
                    else:
                        angle = np.arccos(np.clip(points @ (middle / np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-300)).T, -1, 1))
                        visits = angle <= angle[np.arange(len(points)), nearest][:, None] + most_angle
                    visits &= home[:, None]
                    visits[np.arange(len(points)), nearest] = True
                    who, to = np.nonzero(visits)
                    out = some.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{cell}/{j}" for j in to.tolist()]) if c == "cell" else pa.array(home[who] & (to == nearest[who])) if c == "home" else out.column(c)
                         for c in out.schema.names], schema=out.schema)

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        joined = rows.join(hint(centres), "cell", "left").select(*rows.columns, "centres")
        rows = stored(joined.mapInArrow(assign, schema), "cells")
    raise RuntimeError("cells could not be cut to the wanted size in 64 rounds")


def shard_graphs(rows: DataFrame, raw: str, settings: Settings) -> DataFrame:
    """Every row with its list of neighbours in its shard (edges), and whether it is the shard's medoid."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id").combine_chunks()
        ids = table.column("id").to_numpy()
        units = unit(vectors(table.column("vec").combine_chunks(), raw)).astype(np.float32)
        adjacency, start = graphs.build(units, settings.degree, 2 * settings.degree, settings.alpha)
        some = adjacency != graphs.NONE
        table = table.append_column("edges", lists(ids[adjacency[some]], some.sum(1)))
        return table.append_column("medoid", pa.array(np.arange(len(ids)) == start)).select(
            ["region", "id", "vec", "copies", "others", "edges", "medoid"])

    schema = "region string, id long, vec binary, copies long, others array<string>, edges array<long>, medoid boolean"
    return rows.groupBy("region", "cell").applyInArrow(run, schema)


def region_links(graph: DataFrame, raw: str, settings: Settings) -> DataFrame:
    """id, links (copies counted, not its own), root for every node of a region that has a link there."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id").combine_chunks()
        ids, first, place = np.unique(table.column("id").to_numpy(), return_index=True, return_inverse=True)
        edges = table.column("edges").combine_chunks()
        n = len(ids)
        to = np.searchsorted(ids, edges.flatten().to_numpy())
        keys = np.unique(np.repeat(place, edges.value_lengths().to_numpy()) * n + to)
        begin = np.searchsorted(keys, np.arange(n + 1) * n)
        size = np.diff(begin)
        adjacency = np.full((n, max(int(size.max()), 1)), graphs.NONE, np.int64)
        adjacency[np.repeat(np.arange(n), size), spread(np.zeros(n, np.int64), size)] = keys % n
        starts = np.unique(place[table.column("medoid").to_numpy(zero_copy_only=False)])
        rows = table.take(pa.array(first)).combine_chunks()
        vecs = vectors(rows.column("vec").combine_chunks(), raw)
        norms = np.linalg.norm(vecs, axis=1)
        units = (vecs / norms[:, None]).astype(np.float32)
        both = graphs.both_ways(adjacency)
        bits = np.zeros((n, -(-n // 8)), np.uint8)
        for k in range(0, n, 256):
            block = np.zeros((min(256, n - k), n), bool)
            who, node = graphs.within(units, adjacency, both, starts, units[k:k + 256], settings.beam, settings.cosine - 1e-4, settings.margin)
            for j in range(0, len(who), 50_000):
                a, b = who[j:j + 50_000], node[j:j + 50_000]
                exact = np.einsum("ij,ij->i", vecs[k + a], vecs[b]) / (norms[k + a] * norms[b])
                block[a, b] = exact >= settings.cosine
            bits[k:k + 256] = np.packbits(block, axis=1)
        # Other regions that come before this one and hold a node too: a pair that shares one counts there.
        region = rows.column("region")[0].as_py()
        earlier = [[o for o in (x or []) if o < region] for x in rows.column("others").to_pylist()]
        names = sorted({o for x in earlier for o in x})
        shared = np.zeros((n, len(names)), np.float32)
        for i, x in enumerate(earlier):
            shared[i, [names.index(o) for o in x]] = 1
        copies, links = rows.column("copies").to_numpy().astype(np.float64), np.zeros(n)
        linked = np.empty_like(bits)
        for k in range(0, n, 256):
            own = np.unpackbits(bits[k:k + 256], axis=1, count=n).astype(bool)
            own |= np.unpackbits(bits[:, k // 8:(k + 256) // 8], axis=1)[:, :len(own)].astype(bool).T
            own[np.arange(len(own)), k + np.arange(len(own))] = False
            linked[k:k + 256] = np.packbits(own, axis=1)
            if names:
                own &= shared[k:k + 256] @ shared.T == 0
            links[k:k + 256] = own @ copies
        root = np.arange(n)
        waiting = linked.any(1)
        for k in range(n):
            if not waiting[k]:
                continue
            front = np.array([k])
            waiting[k] = False
            while len(front):
                root[front] = k
                reached = np.zeros(n, bool)
                for j in range(0, len(front), 256):
                    reached |= np.unpackbits(np.bitwise_or.reduce(linked[front[j:j + 256]], 0), count=n).astype(bool)
                front = np.flatnonzero(reached & waiting)
                waiting[front] = False
        some = linked.any(1)
        return pa.table({"id": ids[some], "links": links[some].astype(np.int64), "root": ids[root[some]]})

    return graph.groupBy("region").applyInArrow(run, "id long, links long, root long")


def audit(nodes: DataFrame, links: DataFrame, raw: str, settings: Settings) -> float:
    """Share of the true links of about `audited` nodes that `links` (id, links) holds; 1 where there are none."""
    count = nodes.count()
    chosen = nodes.where(F.pmod(F.xxhash64("id", F.lit("audit")), F.lit(max(count, 1))) < settings.audited).select("id", "cell", "vec").collect()
    if not chosen:
        return 1.0
    cells: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for cell in {r["cell"] for r in chosen}:
        own = [r for r in chosen if r["cell"] == cell]
        cells[cell] = np.array([r["id"] for r in own]), np.array([np.frombuffer(r["vec"], raw) for r in own]).astype(np.float64)

    def run(batches):
        for batch in batches:
            coded = batch.column("cell").dictionary_encode()
            for number, cell in enumerate(coded.dictionary.to_pylist()):
                if cell in cells:
                    some = batch.filter(pc.equal(coded.indices, number))
                    ids, asked = cells[cell]
                    vecs = vectors(some.column("vec"), raw)
                    cosines = asked @ vecs.T / np.linalg.norm(asked, axis=1)[:, None] / np.linalg.norm(vecs, axis=1)
                    hit = (cosines >= settings.cosine) & (ids[:, None] != some.column("id").to_numpy())
                    yield pa.RecordBatch.from_pydict({"id": ids, "truth": (hit @ some.column("copies").to_numpy().astype(np.float64)).astype(np.int64)})

    truth = nodes.select("id", "cell", "vec", "copies").mapInArrow(run, "id long, truth long").groupBy("id").agg(F.sum("truth").alias("truth"))
    # As many rows as nodes were drawn.
    row = links.join(F.broadcast(truth), "id", "right").agg(F.sum(F.least("truth", F.coalesce("links", F.lit(0)))).alias("found"), F.sum("truth").alias("truth")).first()
    return row["found"] / row["truth"] if row["truth"] else 1.0


def search(nodes: DataFrame, raw: str, settings: Settings) -> DataFrame:
    """id, links, root of every node with a link, one row per region it is linked in."""
    rows = nodes.select(F.lit("").alias("region"), "cell", "id", "vec", "copies", F.lit(True).alias("home"))
    regions = divide(rows, settings.region_rows, raw, settings, shards=False)
    if regions is not rows:
        lists_ = regions.groupBy("id").agg(F.collect_set("cell").alias("others")).where(F.size("others") > 1)
        regions = regions.join(lists_, "id", "left")
    else:
        regions = regions.withColumn("others", F.lit(None).cast("array<string>"))
    regions = regions.select(F.col("cell").alias("region"), "cell", "id", "vec", "copies", F.lit(True).alias("home"), "others")
    shards = divide(regions, settings.shard_rows, raw, settings, shards=True)
    return stored(region_links(shard_graphs(shards, raw, settings), raw, settings), "links")


def linked_nodes(embeddings: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame, float]:
    """The nodes, their links (id, links, root by region), and the recall measured."""
    raw = _raw_type(embeddings)
    nodes = stored(nodes_of(embeddings), "nodes")
    best, best_recall = None, -1.0
    for _ in range(settings.attempts):
        found = search(nodes, raw, settings)
        recall = audit(nodes, found.groupBy("id").agg(F.sum("links").alias("links")), raw, settings)
        if recall > best_recall:
            best, best_recall = found, recall
        if recall >= settings.recall:
            break
        settings = replace(settings, beam=2 * settings.beam, overlap=settings.overlap + 1, slack=2 * settings.slack, degree=settings.degree + 16)
    if best_recall < settings.recall:
        warnings.warn(f"recall of {best_recall:.3f} below the wanted {settings.recall}", stacklevel=2)
    return nodes, best, best_recall


def group(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `embeddings` (vec_id, embedding, label)."""
    nodes, found, _ = linked_nodes(embeddings, settings)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    own = nodes.select("id", "key", "smallest", "copies").join(links, "id", "left").join(roots, "id", "left")
    own = stored(own.select("key", "smallest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("root")), "linked")
    least = own.groupBy("root").agg(F.min("smallest").alias("component_id"))
    answers = own.join(least, "root").select("key", F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"))
    rows = keyed(embeddings, False)
    apart = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    out = rows.where("key is not null").join(answers, "key").select("vec_id", "n_links", "component_id").unionByName(apart)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
