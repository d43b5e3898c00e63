"""The few things all corpus operators need from Spark: narrow inputs, and stored intermediate tables."""

from __future__ import annotations

import atexit

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsefold.session import shared_path

_STORED: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: lost executors re-read it, and it is computed once.

    The folder goes when the driver's Python ends, or with `release`.
    """
    spark, schema = df.sparkSession, df.schema
    path = shared_path(spark, label)
    df.write.parquet(path)
    _STORED.append((spark, path))
    return spark.read.schema(schema).parquet(path)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that goes like those of `stored`."""
    path = shared_path(spark, label)
    _STORED.append((spark, path))
    return path


def release() -> None:
    """Delete every stored table of this process. Frames that still read them can't be used any more."""
    while _STORED:
        spark, path = _STORED.pop()
        try:
            jvm = spark._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session has gone; nothing can be reached any more
            continue


atexit.register(release)


def own_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that clashing extra columns never meet the operator's own."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def part_of(column: str, parts: int) -> Column:
    """crc32 of the value written as text, modulo `parts`; a missing value counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))
