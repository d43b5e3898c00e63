"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Fixed-size settings are left to the cluster; these only switch features on.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_WRITTEN: list[tuple[SparkSession, str]] = []


def build_session(app: str = "pulsefold", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session with the defaults above; `conf` wins over them.

    Keyword names use `__` for dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster it would be
    visible to one machine, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pulsefold-"))
    return sc.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark)}/pulsefold/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of recomputing it, and
    partition-dependent columns keep the values they had when they were written. The folder
    goes when the driver's Python ends, or with `release`.
    """
    path = shared_path(df.sparkSession, label)
    _WRITTEN.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_and_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`written`, and its number of rows, which costs no more than reading the file footers."""
    table = written(df, label)
    return table, table.count()


def release() -> None:
    """Delete every table of `written` in this process. Frames that still read them can't be used any more."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session has gone; nothing can be reached any more
            continue


atexit.register(release)
