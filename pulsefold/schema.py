"""Column names, schemas and the fixed values shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Results depend on these exactly.
GLUCOSE_ALIASES = ("glucose", "bg", "blood_glucose", "glucose_value", "CGM")
GLUCOSE_MIN, GLUCOSE_MAX = 40.0, 400.0
LOW_BELOW, HIGH_ABOVE, BIN_TOP = 70.0, 180.0, 500.0
ROLLING_ROWS = 12
SPACING_MINUTES = 5
FILL_VALUES = {
    "glucose": 120.0,
    "glucose_ma_1h": 120.0,
    "glucose_std_1h": 0.0,
    "glucose_roc": 0.0,
    "steps": 0,
    "heart_rate": 75,
}
PROCESSED_COLUMNS = (
    "timestamp", "glucose", "glucose_ma_1h", "glucose_std_1h", "glucose_roc",
    "steps", "heart_rate", "hour", "day_of_week", "hypo_risk",
)
FEATURE_COLUMNS = (
    "glucose", "glucose_ma_1h", "glucose_std_1h", "glucose_roc", "steps",
    "heart_rate", "hour", "day_of_week", "is_night", "is_weekend",
)
# Tokens pandas reads as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

LABEL = "hypo_risk"
ORDER = ("ts", "event_id")

STREAM_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("glucose", "glucose_ma_1h", "glucose_std_1h", "glucose_roc")]
    + [T.StructField(c, T.IntegerType()) for c in ("steps", "heart_rate", "hour", "day_of_week", "hypo_risk")]
)

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# The same feed when one source carries many institutions and series.
KEYED_STREAM_SCHEMA = T.StructType(
    [
        T.StructField("institution", T.StringType()),
        T.StructField("series_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
    ]
    + STREAM_SCHEMA.fields
)
