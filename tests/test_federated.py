import math
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsefold.functions import network
from pulsefold.operators.averaging import average_params, finite_params
from pulsefold.plans import queries
from pulsefold.plans.central import compare, train_central
from pulsefold.plans.federated import (
    RoundSettings, client_table, bucketed, finished_rounds, load_model, local_updates, logistic_rounds, save_model,
    score_global, score_local, train_federated,
)
from pulsefold.session import shared_path


@pytest.fixture(scope="module")
def ml(spark):
    """Separable rows of three institutions of different size, a fifth of them positive."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] > 1).astype(int)
    place = ["institution_1"] * 450 + ["institution_2"] * 300 + ["institution_3"] * 150
    rows = [(place[i], i, x[i].tolist(), int(y[i])) for i in range(900)]
    return spark.createDataFrame(rows, "institution string, event_id long, features array<double>, hypo_risk int").cache()


REPO = Path(__file__).resolve().parents[1]
QUICK = RoundSettings(rounds=3, local_epochs=3, hidden=(8,), dropout=0.0, learning_rate=0.01)


def test_averages(frame):
    df = frame("num_examples long, params array<double>", (1, [1.0, 2.0]), (3, [4.0, 8.0]))
    assert average_params(df, []).first()["params"] == [3.25, 6.5]
    assert average_params(df, [], None).first()["params"] == [2.5, 5.0]
    same = frame("num_examples long, params array<double>", (1, [1.5, 2.0]), (9, [1.5, 2.0]))
    assert average_params(same, []).first()["params"] == pytest.approx([1.5, 2.0])
    assert average_params(df.limit(0), []).first() is None
    assert average_params(df.limit(0), ["num_examples"]).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_average_ignores_partitioning(spark, parts):
    df = spark.range(200).select((F.col("id") % 9 + 1).alias("num_examples"), F.array(F.sin("id"), F.cos("id")).alias("params"))
    n = np.arange(200) % 9 + 1
    want = [np.average(f(np.arange(200)), weights=n) for f in (np.sin, np.cos)]
    assert average_params(df.repartition(parts), []).first()["params"] == pytest.approx(want, abs=1e-12)


def test_clients_with_broken_params_are_left_out(frame):
    df = frame("num_examples long, params array<double>", (1, [1.0, 2.0]), (5, [math.nan, 1.0]), (5, [1.0, math.inf]))
    assert average_params(finite_params(df), []).first()["params"] == [1.0, 2.0]


def test_gradient_against_finite_differences():
    dims, rng = (3, 4, 2), np.random.default_rng(0)
    params, x = network.initial_params(dims, 1), rng.normal(size=(6, 3))
    y, w = np.array([0, 1, 1, 0, 1, 0]), np.array([1.0, 2.0, 1.0, 1.0, 3.0, 1.0])
    _, _, g = network.gradient(params, dims, x, y, w)
    for i in range(len(params)):
        up, down = params.copy(), params.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (network.gradient(up, dims, x, y, w)[0] - network.gradient(down, dims, x, y, w)[0]) / 2e-6
        assert g[i] == pytest.approx(slope, abs=1e-6)
    assert len(params) == network.parameter_count(dims) == 26


def test_shards_are_bounded_and_whole(ml):
    table, shards = client_table(ml, RoundSettings(rows_per_shard=100))
    assert shards == 10
    table = table.cache()
    assert table.count() == 900
    counts = {r[0]: r[1] for r in table.groupBy("institution").agg(F.count_distinct("shard")).collect()}
    assert counts == {"institution_1": 5, "institution_2": 3, "institution_3": 2}
    assert table.where("is_train").count() == 360 + 240 + 120
    weights = table.groupBy("institution").agg(F.sum("weight")).collect()
    assert sorted(round(r[1]) for r in weights) == [150, 300, 450]


def test_a_step_holds_a_shard_and_not_an_institution(spark, events_dir, monkeypatch):
    def values():
        return [r["value"] for r in queries.network_step(spark, events_dir).orderBy("pos").collect()]

    whole = values()
    met, plain = [], queries.local_updates

    def noted(rows, *rest):
        met.extend(rows.groupBy("institution", "shard").count().collect())
        return plain(rows, *rest)

    monkeypatch.setattr(queries, "local_updates", noted)
    monkeypatch.setattr(queries, "RoundSettings", lambda: RoundSettings(rows_per_shard=50))
    assert values() == pytest.approx(whole, abs=2e-6)
    assert sum(r["count"] for r in met) == 1000 and max(r["count"] for r in met) < 100


@pytest.mark.parametrize("dims, rows, size, dropout", [((4, 8, 5, 2), 101, 32, 0.3), ((4, 8, 2), 64, 32, 0.0), ((4, 2), 5, 32, 0.3), ((3, 6, 3), 50, 7, 0.5)])
def test_training_takes_the_steps_of_the_gradient(dims, rows, size, dropout):
    rng = np.random.default_rng(3)
    x, y, w = rng.normal(size=(rows, dims[0])), rng.integers(0, dims[-1], rows), rng.random(rows) + 0.5
    start = network.initial_params(dims, 1)
    got, history = network.train(start, dims, x, y, w, 2, size, 0.01, dropout, np.random.default_rng(5))
    params, first, second, step, draws = start.copy(), 0.0, 0.0, 0, np.random.default_rng(5)
    for epoch in range(2):
        order, losses, right = draws.permutation(rows), [], 0
        for pick in np.split(order, range(size, rows, size)):
            loss, p, g = network.gradient(params, dims, x[pick], y[pick], w[pick], 1.0 - dropout, draws)
            step += 1
            first, second = first + 0.1 * (g - first), second + 0.001 * (g * g - second)
            params = params - 0.01 / (1 - 0.9**step) * first / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            losses.append(loss)
            right += (p.argmax(axis=1) == y[pick]).sum()
        assert history[epoch][:2] == pytest.approx((np.mean(losses), right / rows), abs=1e-12)
    np.testing.assert_allclose(got, params, rtol=0, atol=1e-12)


def test_rounds_do_not_shuffle_the_client_table(ml):
    rows, _ = bucketed(*client_table(ml, QUICK))
    updates = local_updates(rows.where("is_train"), network.initial_params((4, 8, 2), 0), (4, 8, 2), QUICK, 1)
    plan = updates._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "Exchange" not in plan


def test_loss_falls_and_model_beats_the_majority(ml):
    result = train_federated(ml, QUICK)
    rows = result.history().orderBy("round").collect()
    assert [r["round"] for r in rows] == [1, 2, 3]
    assert rows[2]["train_loss"] < rows[0]["train_loss"]
    majority = 1 - ml.agg(F.avg("hypo_risk")).first()[0]
    assert rows[2]["val_accuracy"] > majority + 0.05 and rows[2]["val_auc"] > 0.95


def test_one_institution_equals_its_local_fit(ml):
    alone = ml.where("institution = 'institution_3'")
    settings = RoundSettings(rounds=1, local_epochs=2, hidden=(8,), min_clients=1, min_fit_clients=1, min_evaluate_clients=1)
    result = train_federated(alone, settings)
    rows, _ = bucketed(*client_table(alone, settings))
    start = network.initial_params((4, 8, 2), settings.seed)
    update = local_updates(rows.where("is_train"), start, (4, 8, 2), settings, 1).first()
    np.testing.assert_allclose(result.params, update["params"], atol=1e-12)


def test_a_broken_run_goes_on_where_it_stopped(spark, ml):
    whole, halves = shared_path(spark, "run"), shared_path(spark, "run")
    a = train_federated(ml, QUICK, whole)

    class Lost(Exception):
        pass

    def lose(number, _):
        if number == 2:
            raise Lost

    with pytest.raises(Lost):
        train_federated(ml, QUICK, halves, on_round=lose)
    assert finished_rounds(spark, halves) == 2
    b = train_federated(ml, QUICK, halves)
    np.testing.assert_allclose(a.params, b.params, atol=1e-9)
    assert b.history().count() == 3


def test_scores_do_not_depend_on_how_models_travel(spark, ml):
    rows = client_table(ml, RoundSettings(rows_per_shard=100))[0].where("not is_train")
    dims = (4, 8, 2)
    local = spark.createDataFrame(
        [(f"institution_{i}", network.initial_params(dims, i).tolist()) for i in (1, 2)],
        "institution string, params array<double>")
    a, b = (
        score_local(rows, local, dims, limit).groupBy("institution", "label").agg(
            F.count("*"), F.round(F.sum("p"), 9)).orderBy("institution", "label").collect()
        for limit in (10, 1)
    )
    assert a == b and len(a) == 4
    one = local.where("institution = 'institution_1'")
    shared = score_global(rows, network.initial_params(dims, 1), dims).where("institution = 'institution_1'")
    assert shared.agg(F.sum("p")).first()[0] == pytest.approx(score_local(rows, one, dims).agg(F.sum("p")).first()[0])


def test_fraction_of_clients(ml):
    settings = RoundSettings(rounds=2, local_epochs=1, hidden=(4,), fraction_fit=0.4, fraction_evaluate=0.4)
    result = train_federated(ml, settings)
    assert result.fit.groupBy("round").count().agg(F.max("count")).first()[0] == 2
    assert result.evaluated.groupBy("round").count().agg(F.max("count")).first()[0] == 2
    with pytest.raises(ValueError, match="required"):
        train_federated(ml, RoundSettings(min_clients=4))


def test_logistic_rounds_by_hand(ml):
    got = {(r["round"], r["institution"]): np.array(r["params"]) for r in logistic_rounds(ml, 2, 0.5).collect()}
    pdf, start = ml.toPandas(), np.zeros(5)
    for number in (1, 2):
        merged = np.zeros(5)
        for name, part in pdf.groupby("institution"):
            x = np.c_[np.stack(part["features"]), np.ones(len(part))]
            error = 1 / (1 + np.exp(-x @ start)) - part["hypo_risk"].to_numpy()
            step = start - 0.5 * (error[:, None] * x).mean(axis=0)
            np.testing.assert_allclose(got[number, name], step, atol=1e-12)
            merged += len(part) / len(pdf) * step
        start = merged


def test_save_and_load(spark):
    path = shared_path(spark, "model")
    save_model(spark, path, network.initial_params((3, 2), 1), (3, 2))
    params, dims = load_model(spark, path)
    assert dims == (3, 2) and (params == network.initial_params((3, 2), 1)).all()


@pytest.mark.parametrize("kind,weighted", [("mlp", False), ("logistic", True)])
def test_central_model(ml, kind, weighted):
    _, metrics = train_central(ml, kind, 30, (8,), weighted)
    row = metrics.first()
    assert row["num_examples"] == 180 and row["auc"] > 0.95
    side_by_side = compare(metrics, metrics)
    assert side_by_side.count() == 6 and side_by_side.where("federated = centralised").count() == 6


def test_unknown_kind(ml):
    with pytest.raises(ValueError, match="kind"):
        train_central(ml, "forest")


def test_executors_need_no_installed_package(tmp_path):
    """From another working folder the Python workers cannot import the package by accident."""
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pulsefold.session import build_session
from pulsefold.plans.federated import RoundSettings, train_federated
from pulsefold.plans.queries import training_rows
spark = build_session(master="local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
result = train_federated(training_rows(spark, "/root/testdata/sf0.001"), RoundSettings(rounds=1, local_epochs=1))
print("rounds", result.history().count())
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rounds 1" in run.stdout, run.stderr[-2000:]


def test_hooks_for_training_options_and_metrics(spark, ml):
    def constant_step(key, rows, params, options):
        institution, shard = key
        # One institution breaks down in round 2 and has to be reported, not just missed.
        broken = institution == "institution_2" and options["round"] == 2
        new = params + options["step"] * (float("nan") if broken else 1.0)
        return pd.DataFrame({
            "institution": [institution], "shard": [int(shard)], "num_examples": [len(rows)], "params": [new.tolist()],
            "train_loss": [0.5], "train_accuracy": [0.25 * options["round"]],
        })

    settings = RoundSettings(rounds=3, hidden=(8,), min_clients=3, min_fit_clients=3, min_evaluate_clients=3)
    start = np.zeros(4 * 8 + 8 + 8 * 2 + 2)
    result = train_federated(ml, settings, config_fn=lambda number: {"step": 10.0**-number}, local_fit=constant_step, initial=start)
    np.testing.assert_allclose(result.params, start + 0.111)
    assert [(r["round"], r["institution"]) for r in result.left_out().collect()] == [(2, "institution_2")]
    usual = {r["round"]: r["train_accuracy"] for r in result.history().collect()}
    assert usual == pytest.approx({1: 0.25, 2: 0.5, 3: 0.75})

    def greatest(rows):
        return rows.groupBy("round").agg(F.max("num_examples").alias("num_examples"), (F.max("train_accuracy") * 2).alias("train_accuracy"))

    own = {r["round"]: r["train_accuracy"] for r in result.history(fit_agg=greatest).collect()}
    assert own == pytest.approx({1: 0.5, 2: 1.0, 3: 1.5})
