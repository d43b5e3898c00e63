"""Where readings come from: CSV folders, JSON lines, Parquet, and the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pulsefold.operators.joins import attach
from pulsefold.schema import EVENTS_SCHEMA, NA_TOKENS, STREAM_SCHEMA
from pulsefold.session import written

FILE_ORDER = ("_file", "_block", "_line")


def read_csv(spark: SparkSession, path: str, file_order: bool = False) -> DataFrame:
    """Every *.csv below `path`, all columns as text, the usual missing-value tokens as NULL.

    Files must share one header. With `file_order` the columns `FILE_ORDER` tell where a
    row stood: file, block within it, and place within the block.
    """
    raw = (
        spark.read.option("header", True).option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv").csv(path)
    )
    clean = {c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)) for c in raw.columns}
    if not file_order:
        return raw.withColumns(clean)
    place = {
        "_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_line": F.monotonically_increasing_id(),
    }
    return raw.withColumns(place).withColumns(clean)


def number_rows(df: DataFrame, out: str = "event_id") -> DataFrame:
    """Turn the file-order columns into one dense row number, without moving any row.

    `_line` counts on by one within a block of a file, so a row only needs the number of
    rows in the blocks before its own: one short row per block of input.
    """
    staged = written(df, "in-file-order")
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = staged.groupBy("_file", "_block").agg(F.min("_line").alias("_first"), F.count("*").alias("_n"))
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = blocks.select("_file", "_block", shift.alias("_shift"))
    numbered = attach(staged, starts, ["_file", "_block"]).withColumn(out, F.col("_line") + F.col("_shift"))
    return numbered.drop(*FILE_ORDER, "_shift")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = STREAM_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def events_as_readings(events: DataFrame) -> DataFrame:
    """The events table seen as glucose readings of three institutions.

    Errors count as missing readings, so the fill has work to do, and the shift by 30 puts
    values beyond both ends of the clip. Times stay naive. Batch or streaming.
    """
    missing = F.col("event_type") == "error"
    return events.select(
        F.concat(F.lit("institution_"), (F.pmod("user_id", F.lit(3)) + 1).cast("string")).alias("institution"),
        F.col("user_id").alias("series_id"),
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "event_type",
        F.when(~missing, F.col("value") + 30.0).alias("glucose"),
        F.get_json_object("props", "$.k").cast("int").alias("steps"),
        (F.col("event_id") % 60 + 60).cast("int").alias("heart_rate"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_readings(read_parquet(spark, f"{sf_dir}/events.parquet", EVENTS_SCHEMA))
