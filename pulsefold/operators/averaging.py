"""Federated averaging of parameter arrays."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def finite_params(updates: DataFrame, params: str = "params") -> DataFrame:
    """Leave out clients that returned NaN or infinite parameters; one would spoil every mean."""
    fine = F.forall(params, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return updates.where(fine)


def average_params(updates: DataFrame, by: list[str], weight: str | None = "num_examples",
                   params: str = "params", *extra: Column) -> DataFrame:
    """Elementwise mean of `params` per group, weighted by examples unless `weight` is None.

    The means are merged map-side first, so a group of any number of clients sends one
    array per task. No clients give no rows. `extra` aggregates ride along.
    """
    vector = array_to_vector(F.col(params))
    mean = Summarizer.mean(vector, F.col(weight).cast("double")) if weight else Summarizer.mean(vector)
    total = F.sum(weight) if weight else F.count("*")
    size = weight or "clients"
    # Grouping on a constant, unlike no grouping, gives no row when there are no clients.
    groups = by or [F.lit(0).alias("_everyone")]
    merged = updates.groupBy(*groups).agg(total.alias(size), mean.alias("_mean"), *extra)
    return merged.withColumn(params, vector_to_array("_mean")).drop("_mean", "_everyone")
