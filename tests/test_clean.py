import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsefold.operators.clean import (
    fill_and_clip, fill_constants, preprocess, regular_timestamps, resolve_glucose, resolve_time, vitals,
)
from pulsefold.operators.median import exact_median


@pytest.mark.parametrize("finish", [1, 3, 40, 10**6])
@pytest.mark.parametrize("data", [
    [5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [1.0, 1.0, 9.0, 9.0], [1.0] * 50 + [9.0] * 50,
    [1.0] * 50 + [4.0, 5.0, 6.0] + [9.0] * 50, list(np.random.default_rng(1).normal(size=501)),
    [7.0] * 300 + list(np.random.default_rng(2).normal(size=600)),
])
def test_exact_median(spark, data, finish):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [*data, None, math.nan]], "g double").repartition(3)
    assert exact_median(df, "g", finish) == pytest.approx(float(np.median(data)), abs=1e-12)


def test_median_of_nothing(frame):
    empty = frame("glucose double", (None,), (math.nan,))
    assert exact_median(empty, "glucose") is None
    assert [r[0] for r in fill_and_clip(empty).collect()] == [None, None]


def test_fill_and_clip(frame):
    df = frame("i int, glucose double", (0, None), (1, math.nan), (2, 30.0), (3, 100.0), (4, 900.0))
    assert [r[1] for r in fill_and_clip(df).orderBy("i").collect()] == [100.0, 100.0, 40.0, 100.0, 400.0]


def test_glucose_alias_priority(frame):
    assert resolve_glucose(frame("CGM double, bg double", (1.0, 2.0))).first()["glucose"] == 2.0
    assert resolve_glucose(frame("bg double, glucose double", (1.0, 2.0))).first()["glucose"] == 2.0
    assert resolve_glucose(frame("CGM string", ("7.5",))).first()["glucose"] == 7.5
    with pytest.raises(ValueError, match="no glucose column"):
        resolve_glucose(frame("sugar double", (1.0,)))


def test_time_column_choice(frame):
    both = frame("timestamp string, time string", ("2024-01-02", "2024-01-01"))
    assert str(resolve_time(both).first()["ts"]) == "2024-01-02 00:00:00"
    assert str(resolve_time(frame("time string", ("2024-01-01",))).first()["ts"]) == "2024-01-01 00:00:00"
    none = frame("event_id long", (0,), (3,))
    spaced = resolve_time(none, "2024-01-01", "event_id").orderBy("event_id")
    assert [str(r["ts"]) for r in spaced.collect()] == ["2024-01-01 00:00:00", "2024-01-01 00:15:00"]
    with pytest.raises(ValueError, match="no time column"):
        resolve_time(none)


def test_regular_timestamps(spark):
    ids = spark.range(0, 1000, 7).withColumnRenamed("id", "event_id").repartition(6)
    got = regular_timestamps(ids, "2024-01-01", ["event_id"], num_chunks=5).orderBy("event_id").toPandas()["ts"]
    assert list(got) == list(pd.date_range("2024-01-01", periods=143, freq="5min"))


def test_fill_constants_leaves_label_and_calendar(frame):
    schema = ("glucose double, glucose_ma_1h double, glucose_std_1h double, glucose_roc double, steps int, "
              "heart_rate int, hour int, day_of_week int, hypo_risk int")
    row = fill_constants(frame(schema, (math.nan, *[None] * 8))).first()
    assert tuple(row) == (120.0, 120.0, 0.0, 0.0, 0, 75, None, None, None)


def test_vitals_keep_supplied_values(frame):
    supplied = frame("event_id long, steps string", (1, "4321"), (2, "71.0"), (3, None))
    rows = {r["event_id"]: r for r in vitals(supplied).collect()}
    assert [rows[k]["steps"] for k in (1, 2, 3)] == [4321, 71, 0] and rows[1]["heart_rate"] == 75
    drawn = {r["event_id"]: r for r in vitals(supplied, made_up=True).collect()}
    assert drawn[2]["steps"] == 71 and 0 <= drawn[3]["steps"] < 100 and 60 <= drawn[1]["heart_rate"] < 120
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        vitals(frame("event_id long, steps string", (1, "many"))).collect()
    with pytest.raises(Exception, match="heart_rate must be whole numbers, found 71.5"):
        vitals(frame("event_id long, heart_rate string", (1, "71.0"), (2, "71.5"))).collect()
    assert vitals(frame("event_id long, heart_rate double", (1, 71.0), (2, math.nan))).orderBy("event_id").toPandas()["heart_rate"].tolist() == [71, 75]


def test_preprocess_matches_pandas(spark):
    n = 200
    rng = np.random.default_rng(5)
    raw = rng.normal(130, 80, n)
    raw[::17] = np.nan
    pdf = pd.DataFrame({"event_id": range(n), "ts": pd.date_range("2024-03-01", periods=n, freq="5min"), "bg": raw})
    got = preprocess(spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")), None, ("event_id",))
    got = got.orderBy("event_id").toPandas()
    g = pdf["bg"].fillna(pdf["bg"].median()).clip(40, 400)
    roll = g.rolling(12, min_periods=1)
    np.testing.assert_allclose(got["glucose"], g)
    np.testing.assert_allclose(got["glucose_ma_1h"], roll.mean())
    np.testing.assert_allclose(got["glucose_std_1h"], roll.std(), atol=1e-9)
    np.testing.assert_allclose(got["glucose_roc"], g.diff().fillna(0))
    assert list(got["hour"]) == list(pdf["ts"].dt.hour) and list(got["day_of_week"]) == list(pdf["ts"].dt.dayofweek)
    assert list(got["hypo_risk"]) == list((g < 70).astype(int))
