"""Centralised training on the union of all institutions, and its comparison with the federated model."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from pulsefold.functions.network import initial_params as network_start
from pulsefold.operators.features import input_dimension
from pulsefold.operators.metrics import evaluation
from pulsefold.operators.splits import SEED, split_train_val
from pulsefold.operators.stats import with_class_weight
from pulsefold.plans.federated import (
    FederatedResult, RoundSettings, bucketed, client_table, score_global, train_federated,
)
from pulsefold.plans.perceptron import fit_perceptron
from pulsefold.plans.synchronous import StepSettings, final_models, train_synchronous
from pulsefold.schema import LABEL
from pulsefold.session import shared_path, written

MEASURES = ("loss", "accuracy", "precision", "recall", "f1", "auc")


def union_institutions(tables: list[DataFrame]) -> DataFrame:
    """All rows of all institutions, columns matched by name."""
    whole, *rest = tables
    for table in rest:
        whole = whole.unionByName(table)
    return whole


def train_central(ml: DataFrame, kind: str = "mlp", max_iter: int = 50, hidden: tuple[int, ...] = (64, 32, 16),
                  weighted: bool = False, row_id: str = "event_id", seed: int = SEED, by: tuple[str, ...] = ()):
    """Fit on 80 % of all rows, measure on the rest. Returns (model, one-row metrics).

    `by` takes the 80 % of every group: with ("institution",) the same rows are held out as in federated training.
    """
    rows = split_train_val(ml, list(by), row_id, 0.8, seed)
    if weighted:
        rows = with_class_weight(rows.withColumn("_all", F.lit(1)), ["_all"]).drop("_all")
    ready = on_all_cores(written(rows.withColumn("label", F.col(LABEL).cast("double")), "central"), row_id)
    vectors = ready.withColumn("features", array_to_vector("features"))
    held_out = vectors.where("not is_train")
    if kind == "mlp":
        inputs = input_dimension(ready)
        learner = MultilayerPerceptronClassifier(layers=[inputs, *hidden, 2], maxIter=max_iter, seed=seed)
        model = fit_perceptron(ready.where("is_train"), learner)
    elif kind == "logistic":
        learner = LogisticRegression(maxIter=max_iter)
        if weighted:
            learner.setWeightCol("weight")
        model = learner.fit(vectors.where("is_train"))
    else:
        raise ValueError(f"kind must be 'mlp' or 'logistic', not {kind!r}")
    scored = model.transform(held_out).select(
        F.lit("central").alias("model"),
        F.col("label").cast("int").alias("label"),
        vector_to_array("probability")[1].alias("p"),
    )
    return model, evaluation(scored, ["model"])


def train_central_steps(rows: DataFrame, shards: int, params: np.ndarray, dims: tuple[int, ...],
                        settings: StepSettings) -> np.ndarray:
    """One model of all institutions by steps that are sums over all shards, from a client table. Returns its parameters."""
    spark = rows.sparkSession
    pooled = rows.withColumn("shard", F.xxhash64("institution", "shard")).withColumn("institution", F.lit("central"))
    table, name = bucketed(pooled, shards)
    try:
        states = train_synchronous(table, params, dims, settings, shared_path(spark, "central-steps"))
        return np.array(final_models(states).first()["params"])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def held_out_metrics(rows: DataFrame, params: np.ndarray, dims: tuple[int, ...], model: str, digits: int | None = None) -> DataFrame:
    """One row: the quality of one model over all held-out rows of a client table together, from score counts.

    `digits` rounds the scores first, so that another engine finds the same ties.
    """
    scored = score_global(rows.where("not is_train"), params, dims)
    p = F.col("p") if digits is None else F.round("p", digits)
    return evaluation(scored.select(F.lit(model).alias("model"), "label", p.alias("p")), ["model"])


def compare_on_same_rows(ml: DataFrame, settings: RoundSettings, initial: np.ndarray | None = None, run_dir: str | None = None,
                         digits: int | None = None) -> tuple[FederatedResult, DataFrame]:
    """Federated rounds and a central model with as many epochs in all, trained on the same rows and measured on the same
    others: (federated run, table of metric, federated, centralised)."""
    table, shards = client_table(ml, settings)
    rows = written(table, "clients")
    result = train_federated(ml, settings, run_dir, initial=initial)
    steps = StepSettings(settings.rounds * settings.local_epochs, settings.step_batches, settings.learning_rate, settings.adam, settings.seed)
    start = initial if initial is not None else network_start(result.dims, settings.seed)
    central = train_central_steps(rows, shards, start, result.dims, steps)
    return result, compare(held_out_metrics(rows, result.params, result.dims, "federated", digits),
                           held_out_metrics(rows, central, result.dims, "central", digits))


def on_all_cores(stored: DataFrame, key: str) -> DataFrame:
    """Iterative training is bound by arithmetic: a table of few files is spread over all cores once.

    A large table has more splits than cores and stays where it is.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return stored if stored.rdd.getNumPartitions() >= cores else stored.repartition(cores, key)


def compare(federated: DataFrame, central: DataFrame) -> DataFrame:
    """(metric, federated, centralised) from one row of each."""
    def tall(df: DataFrame, name: str) -> DataFrame:
        return df.select(*MEASURES).unpivot([], list(MEASURES), "metric", name)

    return tall(federated, "federated").join(tall(central, "centralised"), "metric")
