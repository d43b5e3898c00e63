"""Structured Streaming: sources, the stateless enrichment, sinks, live statistics and timed runs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pulsefold.functions import columns as C
from pulsefold.operators.clean import fill_constants
from pulsefold.operators.stats import live_statistics
from pulsefold.schema import STREAM_SCHEMA

COMPACT_EVERY = 16


def json_source(spark: SparkSession, path: str, schema: T.StructType = STREAM_SCHEMA,
                max_files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).json(path)


def parquet_source(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
                   max_files_per_trigger: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def enrich(df: DataFrame) -> DataFrame:
    """Parse the time, fill constants, add night, weekend, category and the time of processing.

    The same for batch and stream; text that is no time becomes NULL.
    """
    parsed = fill_constants(df.withColumn("timestamp", C.parse_time_lenient(F.col("timestamp"))))
    return parsed.withColumns({
        "is_night": C.is_night(F.col("hour")),
        "is_weekend": C.is_weekend(F.col("day_of_week")),
        "glucose_category": C.category_stream(F.col("glucose")),
        "processing_time": F.current_timestamp(),
    })


def _start(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def to_memory(df: DataFrame, name: str, checkpoint: str | None = None, available_now: bool = False,
              mode: str = "append") -> StreamingQuery:
    """A table named `name` in the driver's memory: for aggregates in `complete` mode, or for trials.

    In append mode it holds every row and cannot restart; use `to_parquet` for data.
    """
    writer = df.writeStream.outputMode(mode).format("memory").queryName(name)
    return _start(writer.option("checkpointLocation", checkpoint) if checkpoint else writer, available_now)


def to_console(df: DataFrame, name: str, checkpoint: str, rows: int = 10, available_now: bool = False) -> StreamingQuery:
    writer = (
        df.writeStream.outputMode("append").format("console").queryName(name)
        .option("truncate", False).option("numRows", rows).option("checkpointLocation", checkpoint)
    )
    return _start(writer, available_now)


def to_parquet(df: DataFrame, path: str, checkpoint: str, by: str = "glucose_category",
               available_now: bool = False) -> StreamingQuery:
    """Exactly-once Parquet files, one folder per category."""
    writer = (
        df.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy(by)
    )
    return _start(writer, available_now)


def fan_out(df: DataFrame, paths: dict[str, Callable[[DataFrame], DataFrame]], checkpoint: str,
            available_now: bool = False) -> StreamingQuery:
    """Several tables from one read of the source: `paths` maps a folder to what it receives.

    Each batch overwrites its own `batch_id=` folder, so a repeated batch leaves no copies.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, shape in paths.items():
                shape(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def to_statistics(df: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = (),
                  available_now: bool = False, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Keep `live_statistics` as running state; a batch writes the keys it has changed, and nothing else.

    `changes/batch=<n>` holds the new values of batch n, so a repeated batch replaces its own. Every `compact_every` batches all
    that is known is merged into `base/upto=<n>`; what only readers of the base before could need is deleted a generation
    later. An empty batch of changes is there from the start.
    """
    spark = df.sparkSession
    statistics = live_statistics(df, *by)
    schema = T.StructType([*statistics.schema.fields, T.StructField("batch_id", T.LongType())])
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/changes/batch=-1")

    def keep_changes(rows: DataFrame, batch_id: int) -> None:
        stamped = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        stamped.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact_statistics(rows.sparkSession, path, by, schema, batch_id)

    writer = statistics.writeStream.outputMode("update").foreachBatch(keep_changes).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def compact_statistics(spark: SparkSession, path: str, by: tuple[str, ...], schema: T.StructType, upto: int) -> None:
    """Merge the newest base and the changes since into `base/upto=<upto>`, then drop what the base before has made needless."""
    bases = [n for n in completed(spark, f"{path}/base", "upto") if n < upto]
    merged = newest_of(known_statistics(spark, path, schema, upto - 1, also=upto), by)
    merged.write.mode("overwrite").parquet(f"{path}/base/upto={upto}")
    if bases:
        last = max(bases)
        old = [f"{path}/changes/batch={n}" for n in completed(spark, f"{path}/changes", "batch") if 0 <= n <= last]
        remove(spark, *old, *[f"{path}/base/upto={n}" for n in bases if n < last])


def known_statistics(spark: SparkSession, path: str, schema: T.StructType | None = None, upto: int | None = None,
                     also: int | None = None) -> DataFrame:
    """Every version of every key that is still needed: the newest base (not after `upto`) and the changes since."""
    bases = [n for n in completed(spark, f"{path}/base", "upto") if upto is None or n <= upto]
    start = max(bases, default=-2)
    changes = [n for n in completed(spark, f"{path}/changes", "batch") if n > start and (upto is None or n <= upto or n == also)]
    folders = [f"{path}/base/upto={start}"] * bool(bases) + [f"{path}/changes/batch={n}" for n in sorted(changes)]
    if not folders:
        folders = [f"{path}/changes/batch=-1"]
    return (spark.read.schema(schema) if schema else spark.read).parquet(*folders)


def newest_of(versions: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The row of the highest batch of every key."""
    rest = [c for c in versions.columns if c not in by]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("_newest")
    groups = list(by) or [F.lit(0).alias("_all")]
    return versions.groupBy(*groups).agg(newest).select(*by, "_newest.*")


def latest_statistics(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The newest values of all keys (`by` as given to `to_statistics`); no rows while no batch is done.

    Folders that a compaction removes while they are read raise an error: reading again finds the newer base.
    """
    return newest_of(known_statistics(spark, path), by).drop("batch_id")


def completed(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers n of all `folder`/`name`=n whose write has ended."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = [s.getPath() for s in files.listStatus(place) if s.getPath().getName().startswith(f"{name}=")]
    ended = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in ended)


def remove(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stop_after(query: StreamingQuery, batches: int, seconds: float = 600) -> int:
    """Let a query finish `batches` batches, or end by itself, then stop it; how many batches of this start were done.

    What the stop interrupts is done again by the next start with the same checkpoint.
    """
    deadline = time.monotonic() + seconds
    while query.isActive and time.monotonic() < deadline:
        if _batches_done(query) >= batches:
            break
        time.sleep(0.05)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return _batches_done(query)


def _batches_done(query: StreamingQuery) -> int:
    return len({p["batchId"] for p in query.recentProgress if p["numInputRows"] > 0})


def drain(*queries: StreamingQuery) -> None:
    """Wait until `available_now` queries have taken everything there is; failures surface here."""
    for query in queries:
        query.awaitTermination()


def timed_run(queries: Iterable[StreamingQuery], seconds: float, every: float = 5.0,
              on_tick: Callable[[float], None] | None = None) -> None:
    """Let queries run for a while, calling `on_tick` in between, then stop these and no others."""
    queries = list(queries)
    begun = time.monotonic()
    try:
        while (passed := time.monotonic() - begun) < seconds:
            for query in queries:
                if query.exception() is not None:
                    raise query.exception()
            time.sleep(min(every, seconds - passed))
            if on_tick:
                on_tick(time.monotonic() - begun)
    finally:
        for query in queries:
            query.stop()
