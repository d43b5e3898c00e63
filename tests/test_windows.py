import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsefold.operators.chunks import blocks_with_halo, dense_index
from pulsefold.operators.windows import ROLLING_ROWS, rolling_features, row_bytes

ROLLED = ["glucose_ma_1h", "glucose_std_1h", "glucose_roc"]


def series_frame(sizes, seed=0):
    """One series per size; times repeat, so the order needs event_id."""
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for name, size in enumerate(sizes):
        for i in range(size):
            rows.append((name, at, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=int(i // 3)), float(rng.integers(40, 400))))
            at += 1
    return pd.DataFrame(rows, columns=["series_id", "event_id", "ts", "glucose"])


def by_hand(pdf, key):
    parts = []
    for _, part in pdf.groupby(key) if key else [(0, pdf)]:
        part = part.sort_values(["ts", "event_id"]).copy()
        g = part["glucose"]
        long = len(part) > ROLLING_ROWS
        part["glucose_ma_1h"] = g.rolling(12, min_periods=1).mean() if long else g
        part["glucose_std_1h"] = g.rolling(12, min_periods=1).std() if long else 0.0
        part["glucose_roc"] = g.diff().fillna(0.0)
        parts.append(part)
    return pd.concat(parts).sort_values("event_id").reset_index(drop=True)


def check(spark, pdf, key="series_id", **options):
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=3)).repartition(5)
    got = rolling_features(df, key, **options).toPandas().sort_values("event_id").reset_index(drop=True)
    want = by_hand(pdf, key)
    assert len(got) == len(want)
    for c in ROLLED:
        np.testing.assert_allclose(got[c], want[c], atol=1e-9, err_msg=c)


def test_short_and_long_series(spark):
    check(spark, series_frame([1, 12, 13, 60]))


def test_first_deviation_can_be_zero(spark):
    df = spark.createDataFrame(series_frame([20]))
    assert rolling_features(df, null_std="zero").where("glucose_std_1h is null").isEmpty()
    assert rolling_features(df).where("glucose_std_1h is null").count() == 1
    with pytest.raises(ValueError, match="null_std"):
        rolling_features(df, null_std="drop")


@pytest.mark.parametrize("chunks", [1, 2, 7, 60])
def test_one_series_with_most_rows_is_cut_into_blocks(spark, chunks):
    pdf = series_frame([400, 13, 30, 5, 90, 1])
    check(spark, pdf, series_bytes=25 * row_bytes(spark.createDataFrame(pdf)), block_rows=25, num_chunks=chunks)


@pytest.mark.parametrize("chunks", [3, 150])
def test_whole_table_as_one_series(spark, chunks):
    """150 ranges over 300 rows: a range may hold fewer rows than the window looks back."""
    check(spark, series_frame([300]), None, block_rows=20, num_chunks=chunks)


@pytest.mark.parametrize("block", [12, 13, 24, 25, 1000])
def test_blocks_of_any_size_agree(spark, block):
    check(spark, series_frame([12, 13, 1, 25, 12, 40, 2, 24]), series_bytes=0, block_rows=block, num_chunks=3)


def test_blocks_smaller_than_the_halo_are_refused(spark):
    with pytest.raises(ValueError, match="blocks of 11"):
        rolling_features(spark.createDataFrame(series_frame([5])), None, block_rows=11)


def test_rows_without_a_series_are_one_series_in_many_blocks(spark):
    pdf = series_frame([100])
    df = spark.createDataFrame(pdf).withColumn("series_id", F.lit(None).cast("string"))
    got = rolling_features(df, block_rows=20).toPandas().sort_values("event_id").reset_index(drop=True)
    want = by_hand(pdf, None)
    for c in ROLLED:
        np.testing.assert_allclose(got[c], want[c], atol=1e-9, err_msg=c)
    blocks = blocks_with_halo(df, ["series_id", "ts", "event_id"], 12, 20)
    assert blocks.where("_own").groupBy("_block").count().where("count = 20").count() == 5
    assert blocks.count() == 100 + 2 * 12 * 5


def test_missing_keys_go_through_blocks_beside_usual_series(spark):
    pdf = series_frame([40, 30, 12])
    df = spark.createDataFrame(pdf).withColumn("series_id", F.expr("nullif(series_id, 1)"))
    got = rolling_features(df, block_rows=12).toPandas().sort_values("event_id").reset_index(drop=True)
    want = by_hand(pdf, "series_id")
    for c in ROLLED:
        np.testing.assert_allclose(got[c], want[c], atol=1e-9, err_msg=c)


def test_an_empty_table_stays_empty(spark):
    assert rolling_features(spark.createDataFrame(series_frame([5])).where("event_id < 0"), None).isEmpty()
    assert rolling_features(spark.createDataFrame(series_frame([5])).where("event_id < 0")).isEmpty()


def test_equal_times_do_not_make_a_hot_range(spark):
    pdf = series_frame([300])
    pdf["ts"] = pd.Timestamp("2024-01-01")
    check(spark, pdf, None, block_rows=20, num_chunks=9)


@pytest.mark.parametrize("chunks", [1, 6, 50])
def test_dense_index(spark, chunks):
    df = spark.range(300).select((F.col("id") * 7919 % 1009).alias("k"), "id").repartition(4)
    got = dense_index(df, ["k", "id"], num_chunks=chunks).orderBy("k", "id").select("row_index").collect()
    assert [r[0] for r in got] == list(range(300))


def test_numbering_shuffles_the_table_once(spark, capsys):
    """Ranges are the only shuffle of the rows; afterwards only one row per chunk is exchanged and broadcast."""
    df = spark.range(300).select((F.col("id") * 7919 % 1009).alias("k"), "id")
    dense_index(df, ["k", "id"], num_chunks=4).explain()
    after = capsys.readouterr().out
    assert after.count("Exchange hashpartitioning") == 1 and "HashAggregate(keys=[chunk" in after
    assert "Exchange rangepartitioning" not in after and "row_number" not in after
    assert after.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in after
