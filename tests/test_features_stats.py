import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsefold.operators.features import (
    calendar_and_category, complete, input_dimension, ml_table, prepare_ml_data, reject_counts, standardise,
)
from pulsefold.operators.joins import attach
from pulsefold.operators.stats import class_weights, live_statistics, record_counts, with_class_weight
from pulsefold.schema import FEATURE_COLUMNS


@pytest.fixture
def rows(spark):
    """Two groups of ten features; feature 3 is constant, one row lacks feature 2."""
    rng = np.random.default_rng(0)
    data = [(g, i, *[float(v) for v in rng.normal(size=3)], 4.0, *[float(v) for v in rng.normal(size=6)], int(i % 3 == 0))
            for i, g in enumerate("aaaaabbbbbbb")]
    data.append(("a", 99, 1.0, 2.0, None, *[1.0] * 7, 0))
    columns = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(data, f"institution string, event_id long, {columns}, hypo_risk int")


@pytest.mark.parametrize("population,ddof", [(True, 0), (False, 1)])
def test_ml_table(rows, population, ddof):
    table = ml_table(rows, ["institution"], ("event_id",), population)
    got = table.toPandas()
    assert 99 not in set(got["event_id"]) and input_dimension(table) == 10
    raw = rows.where(complete()).toPandas()
    for name, part in got.groupby("institution"):
        x = raw[raw.institution == name].set_index("event_id").loc[part.event_id, list(FEATURE_COLUMNS)].to_numpy()
        std = x.std(axis=0, ddof=ddof)
        want = np.where(std == 0, 0.0, (x - x.mean(axis=0)) / np.where(std == 0, 1, std))
        np.testing.assert_allclose(np.stack(part["features"]), want, atol=1e-9)


def test_ml_stages_use_the_sample_deviation(rows):
    whole = rows.withColumn("one", F.lit(1))
    a = prepare_ml_data(whole, ("event_id",)).toPandas().sort_values("event_id")
    b = ml_table(whole, ["one"], ("event_id",), population=False).toPandas().sort_values("event_id")
    np.testing.assert_allclose(np.stack(a["features"]), np.stack(b["features"]), atol=1e-9)


def test_rejects_are_counted(rows):
    assert dict(map(tuple, reject_counts(rows, "institution").collect())) == {"a": 1, "b": 0}


def test_scaler_can_be_fitted_on_training_rows(frame):
    df = frame("g string, t boolean, x double", ("a", True, 1.0), ("a", True, 3.0), ("a", False, 100.0))
    got = standardise(df, ["g"], ("x",), fit_on=F.col("t")).orderBy("x")
    assert [r["x"] for r in got.collect()] == [-1.0, 1.0, 98.0]


def test_input_dimension_must_be_constant(frame):
    with pytest.raises(ValueError, match="one length"):
        input_dimension(frame("features array<double>", ([1.0],), ([1.0, 2.0],)))


def test_calendar_and_category(frame):
    row = calendar_and_category(frame("hour int, day_of_week int, glucose double", (6, 5, 70.0))).first()
    assert (row["is_night"], row["is_weekend"], row["glucose_category"]) == (1, 1, "low")


def test_live_statistics_of_nothing(frame):
    empty = frame("glucose double, hypo_risk int, heart_rate int, steps int")
    assert tuple(live_statistics(empty).first()) == (0, *[None] * 7)


def test_live_statistics(frame):
    df = frame("k string, glucose double, hypo_risk int, heart_rate int, steps int", ("a", 60.0, 1, 70, 5), ("a", 80.0, 0, 90, 6))
    row = live_statistics(df, "k").first()
    assert tuple(row)[:5] == ("a", 2, 70.0, 60.0, 80.0) and row["std_glucose"] == pytest.approx(math.sqrt(200))
    assert tuple(row)[6:] == (1, 80.0, 11)
    assert record_counts(df, "k").first()["records"] == 2


def test_class_weights(frame):
    df = frame("g string, hypo_risk int", *[("a", 0)] * 6, *[("a", 1)] * 2, *[("b", 0)] * 3)
    got = {(r["g"], r["hypo_risk"]): r["weight"] for r in class_weights(df, ["g"]).collect()}
    assert got == pytest.approx({("a", 0): 8 / 12, ("a", 1): 2.0, ("b", 0): 1.0})
    assert with_class_weight(df, ["g"]).agg(F.sum("weight")).first()[0] == pytest.approx(8 + 3)


def test_attach_beyond_the_broadcast_limit(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 50).alias("k"))
    keys = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        small = attach(rows, keys, ["k"], how)
        large = attach(rows, keys, ["k"], how, max_cells=5, salts=7)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, small.select("id", "k", "v").collect()), key=str) == sorted(
            map(tuple, large.select("id", "k", "v").collect()), key=str)
