"""Exact order-dependent work without ever gathering one key, or the whole table, in a task.

A table is range-partitioned on a total order and sorted there, once; each range is a `chunk`, and the task that sorts it
also numbers its rows. What one chunk must know about those before it is their number of rows, so that travels as a table
with one row per chunk. The number of chunks is the number of shuffle partitions (or `num_chunks`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulsefold.session import written

# monotonically_increasing_id holds the partition above these bits and the place within it below them.
PLACE_BITS = 33


def range_chunks(df: DataFrame, order: list[str], num_chunks: int | None = None) -> DataFrame:
    """`df` plus `chunk`, rising along `order`, and `_place`, the row's place in its chunk from 0.

    `order` should be unique, so no chunk can be hot. The only shuffle of the table is the one by ranges.
    """
    num_chunks = num_chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(num_chunks, *order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("_place", F.monotonically_increasing_id())
    return written(numbered.withColumns({
        "chunk": F.shiftright("_place", PLACE_BITS).cast("int"),
        "_place": F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
    }), "chunks")


def dense_index(df: DataFrame, order: list[str], out: str = "row_index", num_chunks: int | None = None) -> DataFrame:
    """Number all rows 0, 1, 2, ... along `order`."""
    chunks = range_chunks(df, order, num_chunks)
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk, so this single-task window and the broadcast stay small.
    starts = (
        chunks.groupBy("chunk").agg(F.count("*").alias("_rows"))
        .select("chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        chunks.join(F.broadcast(starts), "chunk")
        .withColumn(out, F.col("_start") + F.col("_place"))
        .drop("chunk", "_start", "_place")
    )


def blocks_with_halo(df: DataFrame, order: list[str], reach: int, block_rows: int, num_chunks: int | None = None) -> DataFrame:
    """`df` with its dense position `_pos`, cut into blocks (`_block`) of `block_rows` positions.

    Each block also gets the `reach` rows before it and behind it, with `_own` = false. Blocks are equally large whatever the
    keys in `order` look like, and what is copied is 2 * reach rows a block.
    """
    if block_rows < reach:
        raise ValueError(f"blocks of {block_rows} rows can't lend {reach} rows to their neighbours")
    numbered = dense_index(df, order, "_pos", num_chunks)
    home, at = F.expr(f"_pos div {block_rows}"), F.col("_pos") % block_rows
    nobody = F.array().cast("array<bigint>")
    holders = F.concat(
        F.array(home),
        F.when(at < reach, F.array(home - 1)).otherwise(nobody),
        F.when(at >= block_rows - reach, F.array(home + 1)).otherwise(nobody),
    )
    return numbered.withColumn("_block", F.explode(holders)).withColumn("_own", F.col("_block") == home)
