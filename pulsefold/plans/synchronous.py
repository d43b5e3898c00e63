"""Training whose steps are sums over all shards, so a model does not depend on how its rows are cut.

A step scores every shard of an institution under the institution's present parameters, adds the slopes of all shards
(one array per shard, merged map-side first) and moves the parameters once. States are written tables, one row per
institution and step: lost executors repeat a step's tasks, never the steps before.

Rows in batches: an epoch deals rows to `batches` steps by a hash of the row id, again independent of shards. There is no
dropout here, as its draws would follow the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from pulsefold.functions import network
from pulsefold.session import written

SUMS = ("institution string, num_examples bigint, weight double, loss double, correct bigint, slope array<double>, "
        "val_examples bigint, val_loss double, val_correct bigint")
STATE = ("institution string, epoch int, batch int, params array<double>, first array<double>, second array<double>, "
         "num_examples bigint, weight double, loss double, correct bigint, val_examples bigint, val_loss double, val_correct bigint")
EPOCHS = ("institution string, epoch int, num_examples bigint, train_loss double, train_accuracy double, "
          "val_examples bigint, val_loss double, val_accuracy double")


@dataclass(frozen=True)
class StepSettings:
    """`epochs` passes of `batches` steps each (1: all rows in a step); `adam` or plain descent."""

    epochs: int = 5
    batches: int = 1
    learning_rate: float = 0.001
    adam: bool = True
    seed: int = 42


def shard_sums(rows: DataFrame, models: DataFrame, dims: tuple[int, ...], batch: int, held_out: bool) -> DataFrame:
    """Sums of every shard under its institution's parameters: slopes over the training rows of `batch`, loss and hits over
    the held-out rows where asked for. `models` has one row per shard (institution, shard, params)."""
    gradient, probabilities = network.gradient, network.positive_probability
    columns = [f.strip().split(" ")[0] for f in SUMS.split(", ")]

    def sums(part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if part.empty or model.empty:
            return pd.DataFrame(columns=columns)
        params = np.array(model["params"].iloc[0], dtype=float)
        part = part.sort_values("event_id")
        out = [part["institution"].iloc[0], 0, 0.0, 0.0, 0, np.zeros(len(params)), 0, 0.0, 0]
        train = part[part["is_train"] & (part["batch"] == batch)]
        if len(train):
            y, w = train["label"].to_numpy(), train["weight"].to_numpy()
            loss, p, slope = gradient(params, dims, np.stack(train["features"].to_numpy()), y, w)
            out[1:6] = [len(train), w.sum(), loss * w.sum(), int((p.argmax(axis=1) == y).sum()), slope * w.sum()]
        rest = part[~part["is_train"]] if held_out else part[:0]
        if len(rest):
            y, p = rest["label"].to_numpy(), probabilities(params, dims, np.stack(rest["features"].to_numpy()))
            cost = -np.log(np.maximum(np.where(y == 1, p, 1 - p), 1e-15)).sum()
            out[6:] = [len(rest), float(cost), int(((p > 0.5) == (y == 1)).sum())]
        return pd.DataFrame([out], columns=columns)

    return rows.groupBy("institution", "shard").cogroup(models.groupBy("institution", "shard")).applyInPandas(sums, SUMS)


def institution_sums(shards: DataFrame) -> DataFrame:
    """One row per institution: the sums of its shards."""
    counts = [c.strip().split(" ")[0] for c in SUMS.split(", ") if not c.startswith(("institution", "slope"))]
    added = Summarizer.sum(array_to_vector("slope")).alias("_slope")
    return shards.groupBy("institution").agg(added, *[F.sum(c).alias(c) for c in counts]).withColumn("slope", vector_to_array("_slope")).drop("_slope")


def moved(states: DataFrame, sums: DataFrame, step: int, epoch: int, batch: int, settings: StepSettings) -> DataFrame:
    """The states after one step. An institution without rows in the batch stays where it was."""
    mean = F.transform("slope", lambda s: F.try_divide(s, F.col("weight")))
    old = states.select("institution", F.col("params").alias("_params"), F.col("first").alias("_first"), F.col("second").alias("_second"))
    joined = old.join(sums, "institution", "left").withColumn("_mean", F.when(F.col("weight") > 0, mean))
    if settings.adam:
        joined = joined.withColumn("first", F.zip_with("_first", "_mean", lambda f, g: f + 0.1 * (g - f)))
        joined = joined.withColumn("second", F.zip_with("_second", "_mean", lambda s, g: s + 0.001 * (g * g - s)))
        size = F.zip_with("first", "second", lambda f, s: F.lit(settings.learning_rate / (1 - 0.9**step)) * f / (F.sqrt(s / F.lit(1 - 0.999**step)) + 1e-8))
    else:
        joined = joined.withColumns({"first": F.col("_first"), "second": F.col("_second")})
        size = F.transform("_mean", lambda g: F.lit(settings.learning_rate) * g)
    joined = joined.withColumn("params", F.zip_with("_params", size, lambda p, s: p - s))
    kept = {c: F.when(F.col("_mean").isNotNull(), F.col(c)).otherwise(F.col(f"_{c}")) for c in ("params", "first", "second")}
    return _shaped(joined.withColumns(kept), epoch, batch)


def _shaped(states: DataFrame, epoch: int, batch: int) -> DataFrame:
    known = {"epoch": F.lit(epoch), "batch": F.lit(batch)}
    names = [f.strip().split(" ") for f in STATE.split(", ")]
    return states.select(*[known.get(n, F.col(n) if n in states.columns else F.lit(None)).cast(kind).alias(n) for n, kind in names])


def train_synchronous(rows: DataFrame, params: np.ndarray, dims: tuple[int, ...], settings: StepSettings, path: str) -> DataFrame:
    """Every step's states, from `rows` (institution, shard, event_id, features, label, weight, is_train).

    All institutions start from `params`. Step k of `path` holds the parameters after it and the sums before it; held-out
    sums are those of the epoch before.
    """
    spark = rows.sparkSession
    shards = written(rows.select("institution", "shard").distinct(), "shards")
    start = [float(p) for p in params]
    states = shards.select("institution").distinct().select(
        "institution", F.lit(start).cast("array<double>").alias("params"),
        *[F.lit([0.0] * len(start)).cast("array<double>").alias(c) for c in ("first", "second")])
    step = 0
    for epoch in range(1, settings.epochs + 1):
        dealt = rows.withColumn("batch", dealt_to(settings, epoch))
        for batch in range(settings.batches):
            models = shards.join(states.select("institution", "params"), "institution")
            sums = institution_sums(shard_sums(dealt, models, dims, batch, batch == 0 and epoch > 1))
            step += 1
            moved(states, sums, step, epoch, batch, settings).write.mode("overwrite").parquet(f"{path}/step={step}")
            states = spark.read.schema(STATE).parquet(f"{path}/step={step}")
    # What the last epoch left, on the held-out rows.
    models = shards.join(states.select("institution", "params"), "institution")
    last = institution_sums(shard_sums(rows.withColumn("batch", F.lit(-1)), models, dims, 0, True))
    ended = states.select("institution", "params", "first", "second").join(last, "institution")
    _shaped(ended, settings.epochs + 1, 0).write.mode("overwrite").parquet(f"{path}/step={step + 1}")
    return spark.read.schema(f"{STATE}, step int").parquet(path)


def dealt_to(settings: StepSettings, epoch: int) -> Column:
    """The step of an epoch that a row belongs to."""
    return F.pmod(F.xxhash64("event_id", F.lit(settings.seed), F.lit(epoch)), F.lit(settings.batches)).cast("int")


def epoch_metrics(states: DataFrame) -> DataFrame:
    """institution, epoch, num_examples, train_loss, train_accuracy, val_examples, val_loss, val_accuracy: means over rows,
    the training ones as the rows were met, the held-out ones after the epoch."""
    train = states.groupBy("institution", "epoch").agg(
        F.sum("num_examples").alias("num_examples"), F.try_divide(F.sum("loss"), F.sum("weight")).alias("train_loss"),
        F.try_divide(F.sum("correct"), F.sum("num_examples")).alias("train_accuracy"))
    after = states.where("batch = 0 and epoch > 1").select(
        "institution", (F.col("epoch") - 1).alias("epoch"), "val_examples",
        F.try_divide("val_loss", "val_examples").alias("val_loss"), F.try_divide("val_correct", "val_examples").alias("val_accuracy"))
    return train.join(after, ["institution", "epoch"]).select(
        "institution", "epoch", "num_examples", "train_loss", "train_accuracy", "val_examples", "val_loss", "val_accuracy")


def final_models(states: DataFrame) -> DataFrame:
    """institution and params after the last step."""
    return states.groupBy("institution").agg(F.max_by("params", "step").alias("params"))
