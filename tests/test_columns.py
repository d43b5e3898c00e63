import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pulsefold.functions import columns as C


def values(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.fixture
def glucose(frame):
    rows = [None, math.nan, 39.9, 40.0, 69.99, 70.0, 180.0, 180.01, 400.0, 500.1]
    return frame("i int, x double", *enumerate(rows))


def test_clip_keeps_missing_missing(glucose):
    clipped = values(glucose, C.clip_glucose(C.known(F.col("x"))))
    assert clipped == [None, None, 40.0, 40.0, 69.99, 70.0, 180.0, 180.01, 400.0, 400.0]


def test_category_rules_differ_at_70_and_on_missing(glucose):
    x = C.known(F.col("x"))
    assert values(glucose, C.category_stream(x)) == [
        "normal", "normal", "low", "low", "low", "normal", "normal", "high", "high", "high"]
    assert values(glucose, C.category_batch(x)) == [
        None, None, "low", "low", "low", "low", "normal", "high", "high", None]


def test_hypo_risk(glucose):
    assert values(glucose, C.hypo_risk(F.col("x"))) == [0, 0, 1, 1, 1, 0, 0, 0, 0, 0]


def test_night_and_weekend(frame):
    hours = frame("i int, h int", *enumerate([5, 6, 7, 21, 22, 23, None]))
    assert values(hours, C.is_night(F.col("h"))) == [1, 1, 0, 0, 1, 1, 0]
    days = frame("i int, d string", (0, "2024-01-05"), (1, "2024-01-06"), (2, "2024-01-07"), (3, "2024-01-08"))
    weekday = C.monday_based_weekday(F.to_date("d"))
    assert values(days, weekday) == [4, 5, 6, 0]
    assert values(days, C.is_weekend(weekday)) == [0, 1, 1, 0]


def test_time_parsing(frame):
    texts = frame("i int, t string", (0, "2024-01-01 00:05:00"), (1, "2024-01-01 00:05:00.250001"), (2, None))
    expected = [dt.datetime(2024, 1, 1, 0, 5), dt.datetime(2024, 1, 1, 0, 5, 0, 250001), None]
    assert values(texts, C.parse_time_strict(F.col("t"))) == expected
    bad = frame("i int, t string", (0, "yesterday"))
    assert values(bad, C.parse_time_lenient(F.col("t"))) == [None]
    with pytest.raises(Exception, match="not a timestamp: yesterday"):
        values(bad, C.parse_time_strict(F.col("t")))


def test_made_up_vitals_are_in_range_and_repeatable(spark):
    ids = spark.range(2000)
    steps, heart = C.synthetic_steps(F.col("id"), 7), C.synthetic_heart_rate(F.col("id"), 7)
    row = ids.agg(F.min(steps), F.max(steps), F.min(heart), F.max(heart)).first()
    assert tuple(row) == (0, 99, 60, 119)
    again = ids.repartition(5)
    assert ids.agg(F.sum(steps)).first() == again.agg(F.sum(steps)).first()


def test_safe_ratio(frame):
    assert values(frame("i int, a int, b int", (0, 1, 4), (1, 1, 0)), C.safe_ratio(F.col("a"), F.col("b"))) == [0.25, 0.0]
