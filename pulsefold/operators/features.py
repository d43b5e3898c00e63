"""From cleaned readings to standardised feature arrays."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from pulsefold.functions.columns import category_batch, is_night, is_weekend
from pulsefold.operators.joins import attach
from pulsefold.schema import FEATURE_COLUMNS, LABEL


def calendar_and_category(df: DataFrame) -> DataFrame:
    """is_night, is_weekend and the batch category."""
    return df.withColumns({
        "is_night": is_night(F.col("hour")),
        "is_weekend": is_weekend(F.col("day_of_week")),
        "glucose_category": category_batch(F.col("glucose")),
    })


def complete(columns: tuple[str, ...] = FEATURE_COLUMNS) -> Column:
    """True where every feature is there and is a number."""
    present = F.lit(True)
    for name in columns:
        value = F.col(name).cast("double")
        present = present & value.isNotNull() & ~F.isnan(value)
    return present


def reject_counts(df: DataFrame, *by: str, columns: tuple[str, ...] = FEATURE_COLUMNS) -> DataFrame:
    """How many rows `ml_table` leaves out for an incomplete feature."""
    return df.groupBy(*by).agg(F.count_if(~complete(columns)).alias("rejected"))


def scaler_statistics(df: DataFrame, by: list[str], columns: tuple[str, ...] = FEATURE_COLUMNS,
                      population: bool = True) -> DataFrame:
    """Mean and deviation of every feature for all groups in one pass."""
    deviation = F.stddev_pop if population else F.stddev_samp
    sums = [F.avg(c).alias(f"{c}__mean") for c in columns]
    sums += [F.coalesce(deviation(c), F.lit(0.0)).alias(f"{c}__std") for c in columns]
    return df.groupBy(*by).agg(*sums)


def scaled(column: str) -> Column:
    """(x - mean) / deviation; a constant feature becomes 0."""
    centred = F.col(column) - F.col(f"{column}__mean")
    return F.when(F.col(f"{column}__std") == 0, 0.0).otherwise(centred / F.col(f"{column}__std"))


def standardise(df: DataFrame, by: list[str], columns: tuple[str, ...] = FEATURE_COLUMNS,
                population: bool = True, fit_on: Column | None = None) -> DataFrame:
    """Replace each feature by its standardised value, fitted per group.

    `population` divides by n (the batch way), otherwise by n - 1 (the streaming way).
    `fit_on` restricts the rows the scaler sees, e.g. ``F.col("is_train")``.
    """
    statistics = scaler_statistics(df if fit_on is None else df.where(fit_on), by, columns, population)
    scaled_columns = {c: scaled(c) for c in columns}
    extra = [f"{c}__{part}" for c in columns for part in ("mean", "std")]
    return attach(df, statistics, by).withColumns(scaled_columns).drop(*extra)


def ml_table(df: DataFrame, by: list[str], keep: tuple[str, ...] = (), population: bool = True) -> DataFrame:
    """(`by`..., `keep`..., features ARRAY<DOUBLE>, hypo_risk) from rows with all features present."""
    rows = df.select(*by, *keep, *[F.col(c).cast("double") for c in FEATURE_COLUMNS], LABEL).where(complete())
    return standardise(rows, by, population=population).select(
        *by, *keep, F.array(*FEATURE_COLUMNS).alias("features"), LABEL
    )


def feature_stages(columns: tuple[str, ...] = FEATURE_COLUMNS) -> Pipeline:
    """Assembler and scaler as Spark ML stages, for one table scaled as a whole."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="features_raw", handleInvalid="error"),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True),
    ])


def prepare_ml_data(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fit and apply `feature_stages`; the vectors are stored as ARRAY<DOUBLE>."""
    rows = df.where(complete())
    scaled_rows = feature_stages().fit(rows).transform(rows)
    return scaled_rows.select(*keep, vector_to_array("features").alias("features"), LABEL)


def input_dimension(df: DataFrame) -> int:
    """Length of the feature arrays; all must agree."""
    low, high = df.agg(F.min(F.size("features")), F.max(F.size("features"))).first()
    if low is None or low != high:
        raise ValueError(f"feature arrays must have one length, found {low} to {high}")
    return low
