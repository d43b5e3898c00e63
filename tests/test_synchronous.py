"""Steps over shards against steps over all rows at once."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsefold.functions import network
from pulsefold.operators.splits import split_train_val
from pulsefold.plans.central import compare_on_same_rows
from pulsefold.plans.federated import RoundSettings, bucketed, client_table, train_federated
from pulsefold.plans.synchronous import StepSettings, epoch_metrics, final_models, train_synchronous
from pulsefold.session import shared_path

DIMS = (4, 5, 2)
SYNCHRONOUS = RoundSettings(rounds=2, local_epochs=2, learning_rate=0.05, hidden=(5,), mode="synchronous", rows_per_shard=1000)


@pytest.fixture(scope="module")
def ml(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(240, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] > 1).astype(int)
    rows = [(f"institution_{1 + i % 3 % 2}", i, x[i].tolist(), int(y[i])) for i in range(240)]
    return spark.createDataFrame(rows, "institution string, event_id long, features array<double>, hypo_risk int").cache()


def by_hand(ml, settings, epochs):
    """{institution: (parameters, [(train loss, held-out loss) by epoch])} from full-batch Adam or descent in numpy."""
    out = {}
    rows = split_train_val(ml, ["institution"], "event_id", 0.8, 42).toPandas().sort_values("event_id")
    for name, part in rows.groupby("institution"):
        train, rest = part[part.is_train], part[~part.is_train]
        x, y = np.stack(train.features), train.hypo_risk.to_numpy()
        counts = np.bincount(part.hypo_risk)
        w = (len(part) / (2 * counts))[y]
        params, first, second, figures = network.initial_params(DIMS, 42), 0.0, 0.0, []
        for step in range(1, epochs + 1):
            loss, _, g = network.gradient(params, DIMS, x, y, w)
            if settings.adam:
                first, second = first + 0.1 * (g - first), second + 0.001 * (g * g - second)
                params = params - settings.learning_rate / (1 - 0.9**step) * first / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            else:
                params = params - settings.learning_rate * g
            p = network.positive_probability(params, DIMS, np.stack(rest.features))
            figures.append((loss, -np.log(np.where(rest.hypo_risk == 1, p, 1 - p)).mean()))
        out[name] = params, figures
    return out


@pytest.mark.parametrize("per_shard,adam", [(1000, True), (60, True), (10, False)])
def test_models_do_not_depend_on_the_shards(spark, ml, per_shard, adam):
    settings = StepSettings(3, 1, 0.05, adam)
    rows, name = bucketed(*client_table(ml, replace(SYNCHRONOUS, rows_per_shard=per_shard)))
    shards = rows.select("institution", "shard").distinct().count()
    assert shards == sum(-(-n // per_shard) for n in (160, 80))
    states = train_synchronous(rows, network.initial_params(DIMS, 42), DIMS, settings, shared_path(spark, "steps"))
    want = by_hand(ml, settings, 3)
    got = {r["institution"]: r["params"] for r in final_models(states).collect()}
    assert set(got) == set(want)
    for institution, (params, figures) in want.items():
        np.testing.assert_allclose(got[institution], params, atol=1e-12)
        mine = epoch_metrics(states).where(F.col("institution") == institution).orderBy("epoch").collect()
        np.testing.assert_allclose([(r["train_loss"], r["val_loss"]) for r in mine], figures, atol=1e-12)
    spark.sql(f"DROP TABLE {name}")


def test_batches_take_every_row_once(spark, ml):
    rows, name = bucketed(*client_table(ml, replace(SYNCHRONOUS, rows_per_shard=50)))
    states = train_synchronous(rows, network.initial_params(DIMS, 1), DIMS, StepSettings(2, 4, 0.01), shared_path(spark, "steps"))
    steps = states.where("epoch <= 2").groupBy("institution", "epoch").agg(F.sum("num_examples").alias("n"), F.count("*").alias("steps"))
    assert sorted((r["institution"], r["epoch"], r["n"], r["steps"]) for r in steps.collect()) == [
        ("institution_1", 1, 128, 4), ("institution_1", 2, 128, 4), ("institution_2", 1, 64, 4), ("institution_2", 2, 64, 4)]
    spark.sql(f"DROP TABLE {name}")


def test_rounds_in_both_modes(ml):
    whole = train_federated(ml, SYNCHRONOUS)
    cut = train_federated(ml, replace(SYNCHRONOUS, rows_per_shard=30))
    np.testing.assert_allclose(whole.params, cut.params, atol=1e-12)
    epochs = whole.epochs().orderBy("round", "institution", "epoch").collect()
    assert len(epochs) == 8 and all(r["val_examples"] == (32 if r["institution"] == "institution_1" else 16) for r in epochs)
    last = {(r["round"], r["institution"]): r for r in epochs if r["epoch"] == 2}
    for r in whole.fit.collect():
        assert r["train_loss"] == pytest.approx(last[r["round"], r["institution"]]["train_loss"])
        assert r["val_loss"] == pytest.approx(last[r["round"], r["institution"]]["val_loss"])
    averaged = train_federated(ml, replace(SYNCHRONOUS, mode="averaged", dropout=0.0, rounds=1, rows_per_shard=60))
    table = averaged.epochs().orderBy("institution", "epoch").collect()
    assert [(r["institution"], r["epoch"], r["num_examples"], r["val_examples"]) for r in table] == [
        ("institution_1", 1, 128, 32), ("institution_1", 2, 128, 32), ("institution_2", 1, 64, 16), ("institution_2", 2, 64, 16)]
    assert all(0 < r["val_loss"] < 5 and 0 <= r["val_accuracy"] <= 1 for r in table)


def test_comparison_holds_out_the_same_rows(ml):
    result, table = compare_on_same_rows(ml, replace(SYNCHRONOUS, rounds=1, local_epochs=8, learning_rate=0.3, hidden=()))
    rows = {r["metric"]: r for r in table.collect()}
    assert set(rows) == {"loss", "accuracy", "precision", "recall", "f1", "auc"}
    assert rows["auc"]["federated"] > 0.9 and rows["auc"]["centralised"] > 0.9
    assert result.dims == (4, 2)


def test_a_run_with_other_hooks_is_another_run(spark, ml):
    place = shared_path(spark, "run")
    settings = replace(SYNCHRONOUS, mode="averaged", rounds=1, local_epochs=1)
    train_federated(ml, settings, place, config_fn=lambda number: {"learning_rate": 0.1})
    with pytest.raises(ValueError, match="another run"):
        train_federated(ml, settings, place, config_fn=lambda number: {"learning_rate": 0.2})
    with pytest.raises(ValueError, match="another run"):
        train_federated(ml, settings, place, initial=np.zeros(4 * 5 + 5 + 12))
    with pytest.raises(ValueError, match="mode"):
        RoundSettings(mode="both")
