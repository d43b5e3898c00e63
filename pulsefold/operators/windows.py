"""Rolling mean and deviation over 12 readings, and the change since the reading before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from pulsefold.operators.chunks import blocks_with_halo
from pulsefold.operators.joins import attach
from pulsefold.schema import ORDER, ROLLING_ROWS
from pulsefold.session import written_and_counted

SERIES_BYTES = 64 << 20
BLOCK_ROWS = 16_384


def row_bytes(df: DataFrame) -> int:
    """Spark's estimate of a row's size from its column types."""
    return df._jdf.schema().defaultSize()


def _features(df: DataFrame, rows: WindowSpec, null_std: str) -> DataFrame:
    frame = rows.rowsBetween(1 - ROLLING_ROWS, 0)
    # A series has over 12 rows exactly where more than 12 rows of it lie within 12 rows of this one.
    long_series = F.count("*").over(rows.rowsBetween(-ROLLING_ROWS, ROLLING_ROWS)) > ROLLING_ROWS
    glucose = F.col("glucose")
    deviation = F.stddev_samp("glucose").over(frame)
    if null_std == "zero":
        deviation = F.coalesce(deviation, F.lit(0.0))
    return df.withColumns({
        "glucose_ma_1h": F.when(long_series, F.avg("glucose").over(frame)).otherwise(glucose),
        "glucose_std_1h": F.when(long_series, deviation).otherwise(0.0),
        "glucose_roc": F.coalesce(glucose - F.lag("glucose").over(rows), F.lit(0.0)),
    })


def rolling_in_blocks(df: DataFrame, keys: list[str], order: tuple[str, ...], null_std: str = "keep",
                      block_rows: int = BLOCK_ROWS, num_chunks: int | None = None) -> DataFrame:
    """The table in order, cut into blocks that overlap by 12 rows; series of any length, also without a key."""
    blocks = blocks_with_halo(df, [*keys, *order], ROLLING_ROWS, block_rows, num_chunks)
    rows = Window.partitionBy("_block", *keys).orderBy("_pos")
    return _features(blocks, rows, null_std).where("_own").drop("_block", "_own", "_pos")


def rolling_features(df: DataFrame, series: str | None = "series_id", order: tuple[str, ...] = ORDER,
                     null_std: str = "keep", series_bytes: int = SERIES_BYTES, block_rows: int = BLOCK_ROWS,
                     num_chunks: int | None = None) -> DataFrame:
    """Add glucose_ma_1h, glucose_std_1h and glucose_roc.

    `series=None` treats the whole table as one series; rows without a series key are one series. A first row has no
    deviation: `null_std` says whether it stays NULL ("keep") or becomes 0 ("zero"). Series of 12 rows or fewer get their own
    glucose as mean and 0 as deviation.

    Tables without a key, rows without one, and series of more than `series_bytes` (rows, counted over the key column alone,
    times the size of a row) go through blocks of `block_rows` rows, at least 12. All other series need one shuffle.
    """
    if null_std not in ("keep", "zero"):
        raise ValueError(f"null_std must be 'keep' or 'zero', not {null_std!r}")
    if series is None:
        return rolling_in_blocks(df, [], order, null_std, block_rows, num_chunks)
    rows = Window.partitionBy(series).orderBy(*order)
    large = (F.col("_rows") > series_bytes // row_bytes(df)) | F.col(series).isNull()
    sizes = df.groupBy(series).agg(F.count("*").alias("_rows")).where(large)
    long_ones, number = written_and_counted(sizes, "long-series")
    if number == 0:
        return _features(df, rows, null_std)
    marked = attach(df, long_ones, [series])
    # A missing key meets nothing in a join.
    in_blocks = F.col("_rows").isNotNull() | F.col(series).isNull()
    hot, usual = marked.where(in_blocks).drop("_rows"), marked.where(~in_blocks).drop("_rows")
    return _features(usual, rows, null_std).unionByName(
        rolling_in_blocks(hot, [series], order, null_std, block_rows, num_chunks))
