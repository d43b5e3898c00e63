import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pulsefold.functions import network
from pulsefold.functions.descent import minimise
from pulsefold.operators.splits import split_train_val
from pulsefold.plans import central, perceptron
from pulsefold.plans.federated import RoundSettings, client_table, in_teams, local_updates


@pytest.fixture(scope="module")
def ml(spark):
    """Rows of three institutions of different size; positives lie outside a circle, so steps are not easy to find."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 4))
    y = (x[:, 0] ** 2 + x[:, 1] ** 2 > 2).astype(int)
    place = ["institution_1"] * 450 + ["institution_2"] * 300 + ["institution_3"] * 150
    rows = [(place[i], i, x[i].tolist(), int(y[i])) for i in range(900)]
    return spark.createDataFrame(rows, "institution string, event_id long, features array<double>, hypo_risk int").repartition(3, "event_id").cache()


@pytest.mark.parametrize("blocks", [128, 50])
def test_fit_is_that_of_spark(ml, blocks):
    rows = ml.select("features", F.col("hypo_risk").cast("double").alias("label"))
    learner = MultilayerPerceptronClassifier(layers=[4, 6, 3, 2], maxIter=25, seed=7, blockSize=blocks)
    want = learner.fit(rows.withColumn("features", array_to_vector("features")))
    got = perceptron.fit_perceptron(rows, learner)
    np.testing.assert_allclose(got.weights.toArray(), want.weights.toArray(), rtol=0, atol=1e-6)
    assert type(got) is type(want) and got.getMaxIter() == 25 and not got.isSet(got.initialWeights)


def test_values_on_the_way_are_those_of_spark(ml):
    rows = ml.select("features", F.col("hypo_risk").cast("double").alias("label"))
    learner = MultilayerPerceptronClassifier(layers=[4, 6, 2], maxIter=15, seed=7)
    want = learner.fit(rows.withColumn("features", array_to_vector("features"))).summary().objectiveHistory
    arrays = perceptron.as_arrays(perceptron.in_blocks(rows, 4, 128, 2), 4, 2)
    nothing = rows.withColumn("features", array_to_vector("features")).limit(1)
    start = learner.copy({learner.maxIter: 0}).fit(nothing).weights.toArray()
    _, values = minimise(lambda at: perceptron.objective(arrays, at, (4, 6, 2)), start, 15)
    assert values == pytest.approx(want, abs=1e-9)


def test_blocks_are_those_of_the_partitions_and_tasks_equally_large(ml):
    rows = ml.select("features", F.col("hypo_risk").alias("label"))
    sizes = [r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
    blocks = perceptron.in_blocks(rows, 4, 32, 5)
    want = sum(-(-n // 32) for n in sizes)
    assert blocks.agg(F.sum("share")).first()[0] == pytest.approx(want)
    assert blocks.count() == 900 and blocks.select("part").distinct().count() == 5
    held = perceptron.as_arrays(blocks, 4, 5).glom().map(lambda part: sum(len(b) for b in part) // 48).collect()
    assert len(held) == 5 and sum(held) == 900 and max(held) - min(held) <= 3 * 32


@pytest.mark.parametrize("broken", ["array(1.0D, null, 2.0D, 3.0D)", "null"])
def test_missing_features_or_labels_are_an_error(ml, broken):
    rows = ml.select("features", F.col("hypo_risk").cast("double").alias("label")).limit(20)
    last = rows.limit(1)
    last = last.withColumn("label", F.expr(broken).cast("double")) if broken == "null" else last.withColumn("features", F.expr(broken))
    with pytest.raises(Exception, match="must not be missing"):
        perceptron.fit_perceptron(rows.unionByName(last), MultilayerPerceptronClassifier(layers=[4, 3, 2], maxIter=2))


def test_descent_finds_the_least_value_and_gives_up_without_one():
    def valley(x):
        a, b = 1 - x[0], x[1] - x[0] ** 2
        return a * a + 100 * b * b, np.array([-2 * a - 400 * x[0] * b, 200 * b])

    x, values = minimise(valley, np.array([-1.2, 1.0]), 200)
    assert x == pytest.approx([1.0, 1.0], abs=1e-2) and values[-1] < 1e-4 and len(values) < 100
    assert len(minimise(valley, np.array([-1.2, 1.0]), 3)[1]) == 4
    x, values = minimise(lambda at: (1.0 + at[0], np.array([-1.0])), np.array([0.0]), 10)
    assert x == pytest.approx([0.0]) and values == [1.0]


def test_central_training_sums_over_arrays(ml, monkeypatch):
    """The central network takes the sums of `fit_perceptron`, over all training rows of every evaluation."""
    met, plain = [], perceptron.as_arrays
    monkeypatch.setattr(perceptron, "as_arrays", lambda blocks, *rest: met.append(blocks.count()) or plain(blocks, *rest))
    _, metrics = central.train_central(ml, "mlp", 20, (6,), by=("institution",))
    assert met == [720] and metrics.first()["num_examples"] == 180


@pytest.mark.parametrize("dims, sizes, batch, dropout", [
    ((4, 8, 5, 2), (101, 64, 5, 133), 32, 0.3), ((4, 8, 2), (64, 70), 32, 0.0), ((4, 2), (33, 31), 32, 0.3)])
def test_shards_side_by_side_train_as_each_alone(dims, sizes, batch, dropout):
    def shard(k):
        rng = np.random.default_rng(k)
        x, y = rng.normal(size=(sizes[k], dims[0])), rng.integers(0, 2, sizes[k])
        return x, y, rng.random(sizes[k]) + 0.5, np.random.default_rng([9, k]), (x[:4], y[:4]) if k else None

    start = network.initial_params(dims, 1)
    together = network.train_each(start, dims, [shard(k) for k in range(len(sizes))], 3, batch, 0.01, dropout)
    for k, (params, history) in enumerate(together):
        x, y, w, rng, held_out = shard(k)
        alone, alone_history = network.train(start, dims, x, y, w, 3, batch, 0.01, dropout, rng, held_out)
        np.testing.assert_array_equal(params, alone)
        assert history == alone_history


def test_teams_share_a_task_and_train_as_shards_do(spark, ml, monkeypatch):
    settings = RoundSettings(rows_per_shard=20, local_epochs=2, hidden=(8,))
    table, shards = client_table(ml, settings)
    assert shards == 46
    table = table.cache()
    monkeypatch.setattr("pulsefold.plans.federated.SIDE_BY_SIDE", 3)
    rows, name = in_teams(table, shards)
    teams = rows.groupBy("team").agg(F.count_distinct("institution", "shard"), F.count_distinct("place")).collect()
    assert len(teams) == 16 and {r[1] for r in teams} <= {2, 3} and all(r[1] == r[2] for r in teams)
    dims, start = (4, 8, 2), network.initial_params((4, 8, 2), 0)
    updates = local_updates(rows, start, dims, settings, 1)
    plan = updates._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "Exchange" not in plan
    buckets = rows.select(F.pmod(F.hash("team"), F.lit(16))).distinct()
    assert buckets.count() == 16
    alone = local_updates(table, start, dims, settings, 1)
    want = {(r["institution"], r["shard"]): r for r in alone.collect()}
    got = {(r["institution"], r["shard"]): r for r in updates.collect()}
    assert got.keys() == want.keys() and len(got) == 46
    assert all(got[k] == want[k] for k in got)
    spark.sql(f"DROP TABLE {name}")
