"""Batch writers. All are distributed; nothing passes through the driver. Each replaces what an earlier run left.

CSV, JSON lines and Parquet are written beside the target, which is replaced when the whole table is there: a failing write
leaves the table before it as it was. Partitioned tables are first dealt by their key and the parts cut to size from what the
shuffle has measured, so a key with most of the rows has many writers and a small one has one file
(`spark.sql.adaptive.advisoryPartitionSizeInBytes`).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

JSON_DECIMALS = 10
# A replay has at most about so many files, and its files at most so many rows.
REPLAY_FILES, REPLAY_MOST_RECORDS = 4_000, 100_000


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A fresh folder beside `path`, which takes its place once the block has ended without an error.

    The exchange is two renames: on a file system, readers see the old table or the new one but for the moment between
    them; object stores that copy on rename take longer. What an interrupted run leaves is a hidden folder beside the target.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = files.makeQualified(target)
    mark = uuid.uuid4().hex
    fresh, former = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{kind}-{mark}") for kind in ("new", "old"))
    try:
        yield fresh.toString()
        existed = files.exists(target)
        if existed and not files.rename(target, former):
            raise OSError(f"cannot put {path} aside")
        if not files.rename(fresh, target):
            if existed:
                files.rename(former, target)
            raise OSError(f"cannot move the new table to {path}")
    except BaseException:
        files.delete(fresh, True)
        raise
    if existed:
        files.delete(former, True)


def clustered(df: DataFrame, by: str) -> DataFrame:
    """`df` dealt by `by`, evaluated once: adaptive execution splits what is over its advisory size and joins what is below."""
    return df.hint("rebalance", by)


def write_csv(df: DataFrame, path: str) -> None:
    with replacing(df.sparkSession, path) as fresh:
        df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(fresh)


def as_json_rows(df: DataFrame) -> DataFrame:
    """Timestamps as text and doubles to ten decimals, the way readings travel as JSON."""
    def render(field: T.StructField):
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.round(field.name, JSON_DECIMALS)
        return F.col(field.name)

    return df.select(*[render(f).alias(f.name) for f in df.schema.fields])


def write_jsonl(df: DataFrame, path: str, by: str | None = "institution") -> None:
    """JSON lines, one folder per institution, missing values written as explicit nulls."""
    rows = as_json_rows(df)
    with replacing(df.sparkSession, path) as fresh:
        if by:
            clustered(rows, by).write.option("ignoreNullFields", False).partitionBy(by).json(fresh)
        else:
            rows.write.option("ignoreNullFields", False).json(fresh)


def write_by_institution(df: DataFrame, path: str, by: str = "institution") -> None:
    """Parquet, one folder per institution."""
    with replacing(df.sparkSession, path) as fresh:
        clustered(df, by).write.partitionBy(by).parquet(fresh)


def replay_records(rows: int, least: int = 100) -> int:
    """Rows a file of a replay of `rows` rows: `least`, until that would make more than `REPLAY_FILES` files.

    Every file costs a listing, an entry in the stream's log and a rename, and a trigger takes files by number, so with files of
    one size the batches of a replay would grow with the table. Beyond `REPLAY_MOST_RECORDS` they do.
    """
    return max(least, min(-(-rows // REPLAY_FILES), REPLAY_MOST_RECORDS))


def write_replay(df: DataFrame, path: str, order: tuple[str, ...] = ("timestamp",), records_per_file: int = 100) -> None:
    """Cut a table into small JSON files in time order, as food for a streaming source.

    Each file appears whole on commit, so a reader never sees half of one. The number of
    ranges is given, as adaptive execution would otherwise merge small ranges into one writer.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        as_json_rows(df).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .write.mode("overwrite").option("ignoreNullFields", False).option("maxRecordsPerFile", records_per_file).json(path)
    )
