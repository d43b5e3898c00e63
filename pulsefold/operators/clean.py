"""Raw readings to the cleaned feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsefold.functions import columns as C
from pulsefold.operators.chunks import dense_index
from pulsefold.operators.median import exact_median
from pulsefold.operators.windows import SERIES_BYTES, rolling_features
from pulsefold.schema import FILL_VALUES, GLUCOSE_ALIASES, ORDER, PROCESSED_COLUMNS


def resolve_glucose(df: DataFrame) -> DataFrame:
    """Name the first known glucose column `glucose`; without one there is nothing to analyse."""
    name = next((alias for alias in GLUCOSE_ALIASES if alias in df.columns), None)
    if name is None:
        raise ValueError(f"no glucose column: expected one of {', '.join(GLUCOSE_ALIASES)}, found {df.columns}")
    return df.withColumn("glucose", C.known(F.col(name)))


def regular_timestamps(df: DataFrame, start: str, order: list[str], out: str = "ts",
                       num_chunks: int | None = None) -> DataFrame:
    """Row i along `order` gets `start` + 5 i minutes."""
    numbered = dense_index(df, order, "_i", num_chunks)
    return numbered.withColumn(out, C.spaced_time(start, F.col("_i"))).drop("_i")


def resolve_time(df: DataFrame, start: str | None = None, index: str | None = None) -> DataFrame:
    """`ts` from `timestamp`, else from `time`, else regular steps from `start` by the dense row number `index`."""
    for name in ("timestamp", "time"):
        if name in df.columns:
            return df.withColumn("ts", C.parse_time_strict(F.col(name)))
    if start is None or index is None:
        raise ValueError("no time column: pass start and the name of a dense row number")
    return df.withColumn("ts", C.spaced_time(start, F.col(index)))


def fill_and_clip(df: DataFrame) -> DataFrame:
    """Missing glucose becomes the median of the whole table, then everything goes into [40, 400]."""
    median = exact_median(df, "glucose")
    glucose = C.known(F.col("glucose"))
    return df.withColumn("glucose", C.clip_glucose(F.coalesce(glucose, F.lit(median).cast("double"))))


def calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"hour": F.hour("ts"), "day_of_week": C.monday_based_weekday(F.col("ts"))})


def vitals(df: DataFrame, row_id: str = "event_id", seed: int = 42, made_up: bool = False) -> DataFrame:
    """Steps and heart rates as whole numbers; text such as `71.0` counts, `71.5` or text that is no number is an error.

    Missing ones become the declared constants, or with `made_up` repeatable draws.
    """
    stand_in = {
        "steps": C.synthetic_steps(F.col(row_id), seed) if made_up else F.lit(FILL_VALUES["steps"]).cast("int"),
        "heart_rate": C.synthetic_heart_rate(F.col(row_id), seed) if made_up else F.lit(FILL_VALUES["heart_rate"]).cast("int"),
    }
    return df.withColumns({
        name: F.coalesce(C.whole_number(F.col(name), name), value) if name in df.columns else value
        for name, value in stand_in.items()
    })


def fill_constants(df: DataFrame) -> DataFrame:
    """The streaming fill: constants instead of statistics; hour, day and label stay as they are."""
    return df.fillna({k: v for k, v in FILL_VALUES.items() if k in df.columns})


def preprocess(df: DataFrame, series: str | None = "series_id", keep: tuple[str, ...] = ("series_id", "event_id"),
               null_std: str = "keep", series_bytes: int = SERIES_BYTES,
               order: tuple[str, ...] = ORDER, made_up: bool = False) -> DataFrame:
    """Fill, clip, window and label readings that have `ts`, `event_id` and a glucose column.

    Windows run along `order` within each `series`. Returns `keep` and the ten processed columns.
    """
    filled = calendar(vitals(fill_and_clip(resolve_glucose(df)), made_up=made_up))
    rolled = rolling_features(filled, series, order, null_std, series_bytes)
    labelled = rolled.withColumns({"hypo_risk": C.hypo_risk(F.col("glucose")), "timestamp": F.col("ts")})
    return labelled.select(*keep, *PROCESSED_COLUMNS)
