"""Column expressions: everything row-wise, all inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulsefold.schema import BIN_TOP, GLUCOSE_MAX, GLUCOSE_MIN, HIGH_ABOVE, LOW_BELOW, SPACING_MINUTES


def known(x: Column) -> Column:
    """NaN counts as missing."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def whole_number(x: Column, name: str) -> Column:
    """`x` as an int; a fraction is an error that names the column, never cut off."""
    value = known(x)
    fraction = F.raise_error(F.concat(F.lit(f"{name} must be whole numbers, found "), value.cast("string"))).cast("int")
    return F.when(value != F.floor(value), fraction).otherwise(value.cast("int"))


def clip_glucose(x: Column) -> Column:
    """Into [40, 400]; a missing value stays missing (least/greatest would invent 400)."""
    return F.when(x < GLUCOSE_MIN, GLUCOSE_MIN).when(x > GLUCOSE_MAX, GLUCOSE_MAX).otherwise(x)


def parse_time_strict(x: Column) -> Column:
    """Naive timestamp; text that is no timestamp fails the query whatever the ANSI setting."""
    parsed = x.try_cast("timestamp_ntz")
    bad = x.isNotNull() & parsed.isNull()
    message = F.concat(F.lit("not a timestamp: "), x.cast("string"))
    return F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)


def parse_time_lenient(x: Column) -> Column:
    """Naive timestamp; text that is no timestamp becomes NULL."""
    return x.try_cast("timestamp_ntz")


def spaced_time(start: str, index: Column) -> Column:
    """`index` five-minute steps after `start`."""
    return F.timestamp_add("MINUTE", index * SPACING_MINUTES, F.lit(start).cast("timestamp_ntz"))


def monday_based_weekday(ts: Column) -> Column:
    return F.weekday(ts)


def hypo_risk(glucose: Column) -> Column:
    """1 below 70, else 0; a missing reading is no risk."""
    return F.when(known(glucose) < LOW_BELOW, 1).otherwise(0)


def is_night(hour: Column) -> Column:
    return F.when((hour >= 22) | (hour <= 6), 1).otherwise(0)


def is_weekend(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(5, 6), 1).otherwise(0)


def category_stream(glucose: Column) -> Column:
    """Streaming rule: exactly 70 and a missing value are both `normal`."""
    return F.when(glucose < LOW_BELOW, "low").when(glucose > HIGH_ABOVE, "high").otherwise("normal")


def category_batch(glucose: Column) -> Column:
    """Batch rule, bins closed on the right: exactly 70 is `low`; outside (0, 500] is NULL."""
    return (
        F.when((glucose > 0) & (glucose <= LOW_BELOW), "low")
        .when((glucose > LOW_BELOW) & (glucose <= HIGH_ABOVE), "normal")
        .when((glucose > HIGH_ABOVE) & (glucose <= BIN_TOP), "high")
    )


def synthetic_steps(row_id: Column, seed: int) -> Column:
    """Repeatable stand-in for a missing step count, in [0, 100)."""
    return (_drawn(row_id, f"steps:{seed}") % 100).cast("int")


def synthetic_heart_rate(row_id: Column, seed: int) -> Column:
    """Repeatable stand-in for a missing heart rate, in [60, 120)."""
    return (_drawn(row_id, f"heart:{seed}") % 60 + 60).cast("int")


def _drawn(row_id: Column, seed: str) -> Column:
    """A number of 32 bits from the same hash that orders the shuffles, so any SQL engine can repeat it."""
    return F.conv(F.substring(shuffle_key(row_id, seed), 1, 8), 16, 10).cast("bigint")


def institution_name(number: Column) -> Column:
    return F.format_string("institution_%d", number.cast("int"))


def shuffle_key(row_id: Column, seed: int | str) -> Column:
    """Pseudo-random order that does not depend on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")).cast("binary"))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
