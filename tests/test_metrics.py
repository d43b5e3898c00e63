import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsefold.operators import metrics as M


def auc_by_pairs(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    if not pos or not neg:
        return 0.0
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.fixture
def scored(spark):
    """Three groups: ties, a third of all rows with one score, and a single class."""
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(300):
        rows.append(("ties", int(rng.random() < 0.4), float(rng.integers(0, 20)) / 20))
        rows.append(("hot", int(rng.random() < 0.3), 0.5 if rng.random() < 0.6 else float(rng.random())))
    rows += [("single", 1, 0.9)] * 5
    return rows


def groups_of(rows):
    return {g: [r[1:] for r in rows if r[0] == g] for g in {r[0] for r in rows}}


@pytest.mark.parametrize("chunks", [None, 1, 4, 40])
def test_roc_auc(spark, scored, chunks):
    df = spark.createDataFrame(scored, "g string, label int, p double").repartition(5)
    got = dict(map(tuple, M.roc_auc(df, ["g"], num_chunks=chunks).collect()))
    for name, rows in groups_of(scored).items():
        assert got[name] == pytest.approx(auc_by_pairs(*zip(*rows)), abs=1e-12)


def test_rank_sums_have_one_plan(spark, scored):
    def operators(rows):
        df = spark.createDataFrame(rows, "g string, label int, p double")
        plan = M.roc_auc(df, ["g"], num_chunks=4)._jdf.queryExecution().sparkPlan().toString()
        return [line.strip(" :+-*()0123456789").split("(")[0].split(" ")[0] for line in plan.splitlines()]

    assert operators(scored) == operators(scored[:3])


def test_evaluation_agrees_with_its_parts(spark, scored):
    df = spark.createDataFrame(scored, "g string, label int, p double")
    whole = {r["g"]: r for r in M.evaluation(df, ["g"], num_chunks=10).collect()}
    parts = {r["g"]: r for r in M.confusion_metrics(df.withColumn("predicted", (F.col("p") > 0.5).cast("int")), ["g"]).collect()}
    losses = dict(map(tuple, M.cross_entropy(df, ["g"]).collect()))
    for name, rows in groups_of(scored).items():
        for column in ("num_examples", "accuracy", "precision", "recall", "f1"):
            assert whole[name][column] == pytest.approx(parts[name][column])
        loss = np.mean([-math.log(max(p if y else 1 - p, 1e-15)) for y, p in rows])
        assert whole[name]["loss"] == pytest.approx(loss) and losses[name] == pytest.approx(loss)
        assert whole[name]["auc"] == pytest.approx(auc_by_pairs(*zip(*rows)))


def test_no_predicted_positive_gives_zero(frame):
    df = frame("g int, label int, predicted int", (1, 1, 0), (1, 0, 0))
    row = M.confusion_metrics(df, ["g"]).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_certain_and_wrong_has_finite_loss(frame):
    row = M.cross_entropy(frame("g int, label int, p double", (1, 1, 0.0)), ["g"]).first()
    assert row["loss"] == pytest.approx(-math.log(1e-15))


def test_weighted_metrics_keep_the_full_denominator(frame):
    df = frame(
        "round int, institution string, num_examples long, train_loss double, val_f1 double, val_auc double",
        (1, "a", 10, 1.0, 0.5, None), (1, "b", 30, 2.0, None, 0.9), (2, "a", 5, 3.0, None, 0.1), (2, "b", 5, 5.0, 0.4, 0.3),
    )
    got = {r["round"]: r for r in M.weighted_metrics(df, ("train_loss", "val_f1", "val_auc")).collect()}
    assert got[1]["train_loss"] == pytest.approx(70 / 40)
    assert got[1]["val_f1"] == pytest.approx(5 / 40)  # b adds nothing above, 30 below
    assert got[1]["val_auc"] is None  # the first client does not report it
    assert got[2]["val_f1"] is None and got[2]["val_auc"] == pytest.approx(0.2)


def test_history_and_summary(frame):
    fit = frame("round int, train_loss double, val_accuracy double", (1, 0.9, 0.8), (2, 0.5, None), (3, 0.4, 0.8))
    evaluated = frame("round int, accuracy double, f1 double, auc double", (1, 0.1, 0.2, 0.3), (2, 0.8, 0.5, 0.6), (4, 0.7, 0.4, 0.5))
    history = M.round_history(fit, evaluated)
    rows = {r["round"]: r for r in history.collect()}
    assert [rows[r]["val_accuracy"] for r in (1, 2, 3, 4)] == [0.8, 0.8, 0.8, 0.7]
    assert rows[4]["train_loss"] is None and rows[1]["val_f1"] == 0.2 and rows[3]["val_f1"] is None
    best = M.summary(history).first()
    assert (best["total_rounds"], best["best_round"], best["best_val_accuracy"]) == (4, 1, 0.8)
    assert best["final_val_accuracy"] == 0.7
    long = M.long_history(history)
    assert long.where("metric = 'train_loss'").count() == 3
    wide = {r["round"]: r for r in M.wide_history(long).collect()}
    assert wide[2]["val_auc"] == 0.6 and wide[2]["val_loss"] is None
    arrays = M.history_arrays(history).first()
    assert arrays["rounds"] == [1, 2, 3, 4] and arrays["train_loss"] == [0.9, 0.5, 0.4]


def test_last_epoch(frame):
    df = frame("round int, epoch int, loss double", (1, 1, 0.9), (1, 5, 0.1), (1, 3, 0.5), (2, 1, 0.7))
    assert sorted(map(tuple, M.last_epoch(df, ["round"], ("loss",)).collect())) == [(1, 0.1), (2, 0.7)]
