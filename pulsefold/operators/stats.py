"""Counts, live statistics and class balance: partial aggregation first, then one small shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsefold.operators.joins import attach
from pulsefold.schema import LABEL


def live_statistics_columns() -> list[Column]:
    return [
        F.count("*").alias("total_records"),
        F.avg("glucose").alias("avg_glucose"),
        F.min("glucose").alias("min_glucose"),
        F.max("glucose").alias("max_glucose"),
        F.stddev_samp("glucose").alias("std_glucose"),
        F.sum(F.when(F.col(LABEL) == 1, 1).otherwise(0)).alias("hypo_events"),
        F.avg("heart_rate").alias("avg_heart_rate"),
        F.sum("steps").alias("total_steps"),
    ]


def live_statistics(df: DataFrame, *by: str) -> DataFrame:
    """One row over everything (also when there is nothing), or one per key. Batch or streaming."""
    return (df.groupBy(*by) if by else df).agg(*live_statistics_columns())


def record_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("records"))


def class_distribution(df: DataFrame, by: list[str], label: str = LABEL) -> DataFrame:
    return df.groupBy(*by, label).agg(F.count("*").alias("records"))


def class_weights(df: DataFrame, by: list[str], label: str = LABEL) -> DataFrame:
    """total / (classes present * records of the class), per group."""
    group = Window.partitionBy(*by)  # over one row per class, not over the data
    return class_distribution(df, by, label).withColumn(
        "weight",
        F.sum("records").over(group) / (F.count("*").over(group) * F.col("records")),
    )


def with_class_weight(df: DataFrame, by: list[str], label: str = LABEL) -> DataFrame:
    return attach(df, class_weights(df, by, label).drop("records"), [*by, label])
