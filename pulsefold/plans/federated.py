"""Federated training: institutions fit locally, only parameters and metrics leave them."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pulsefold.functions import network
from pulsefold.operators.averaging import average_params, finite_params
from pulsefold.operators.features import input_dimension
from pulsefold.operators.joins import attach
from pulsefold.operators.metrics import evaluation, round_history, weighted_metrics
from pulsefold.operators.splits import SEED, sample_clients, split_train_val
from pulsefold.operators.stats import class_weights
from pulsefold.plans import synchronous
from pulsefold.plans.synchronous import StepSettings, epoch_metrics, train_synchronous
from pulsefold.schema import LABEL
from pulsefold.session import shared_path, written

# The helpers travel with the functions that use them, so executors need no installed package.
cloudpickle.register_pickle_by_value(network)
cloudpickle.register_pickle_by_value(synchronous)

MODELS_IN_CLOSURE = 1_000
# Shards that a task trains side by side: each costs about 150 MB at 250,000 rows, and more of them save next to nothing.
SIDE_BY_SIDE = 3
Aggregate = Callable[[DataFrame], DataFrame]
# (key, rows of a shard, global parameters, options of the round) -> one row as in UPDATE.
LocalFit = Callable[[tuple, pd.DataFrame, np.ndarray, dict], pd.DataFrame]
UPDATE = (
    "institution string, shard int, num_examples bigint, params array<double>, "
    "train_loss double, train_accuracy double, val_examples bigint, "
    "epochs array<struct<train_loss:double,train_accuracy:double,val_loss:double,val_accuracy:double>>"
)
LOCAL = (
    "institution string, num_examples bigint, train_loss double, train_accuracy double, params array<double>"
)
STEP = "institution string, num_examples bigint, params array<double>"
EVALUATED = (
    "institution string, model string, num_examples bigint, loss double, accuracy double, precision double, "
    "recall double, f1 double, auc double"
)
FIT_COLUMNS = ("train_loss", "train_accuracy", "val_loss", "val_accuracy", "val_f1", "val_auc")
EVAL_COLUMNS = ("loss", "accuracy", "precision", "recall", "f1", "auc")


@dataclass(frozen=True)
class RoundSettings:
    rounds: int = 10
    local_epochs: int = 5
    batch_size: int = 32
    learning_rate: float = 0.001
    hidden: tuple[int, ...] = (64, 32, 16)
    dropout: float = 0.3
    weighted_loss: bool = True
    fraction_fit: float = 1.0
    fraction_evaluate: float = 1.0
    min_clients: int = 2
    min_fit_clients: int = 2
    min_evaluate_clients: int = 2
    rows_per_shard: int = 250_000
    seed: int = 42
    # How shards of an institution make one model: "averaged" trains each on its own and averages the parameters,
    # "synchronous" sums their slopes in every step (`batch_size` does not apply; `step_batches` steps an epoch).
    mode: str = "averaged"
    step_batches: int = 1
    adam: bool = True

    def __post_init__(self):
        if self.mode not in ("averaged", "synchronous"):
            raise ValueError(f"mode must be 'averaged' or 'synchronous', not {self.mode!r}")

    def dims(self, inputs: int) -> tuple[int, ...]:
        return (inputs, *self.hidden, 2)

    def round_options(self, number: int) -> dict:
        """What a client is told for one round."""
        return {"round": number, "local_epochs": self.local_epochs, "batch_size": self.batch_size}


@dataclass
class FederatedResult:
    params: np.ndarray
    dims: tuple[int, ...]
    run_dir: str
    fit: DataFrame
    evaluated: DataFrame

    def history(self, fit_agg: Aggregate | None = None, evaluate_agg: Aggregate | None = None) -> DataFrame:
        """Metrics by round; the hooks turn client rows into one row per round in another way."""
        fit_agg = fit_agg or (lambda rows: weighted_metrics(rows, FIT_COLUMNS))
        evaluate_agg = evaluate_agg or (lambda rows: weighted_metrics(rows, EVAL_COLUMNS))
        return round_history(fit_agg(self.fit), evaluate_agg(self.evaluated))

    def epochs(self) -> DataFrame:
        """round, institution, epoch, num_examples and the training and held-out figures of every local epoch."""
        shards = kept_rounds(self.evaluated.sparkSession, self.run_dir, "shards", UPDATE)
        return merged_epochs(shards, ["round", "institution"])

    def left_out(self) -> DataFrame:
        """round, institution, shard, num_examples of every update whose parameters were not finite."""
        shards = kept_rounds(self.evaluated.sparkSession, self.run_dir, "shards", UPDATE)
        return left_out(shards).select("round", "institution", "shard", "num_examples")


def client_table(ml: DataFrame, settings: RoundSettings, row_id: str = "event_id") -> tuple[DataFrame, int]:
    """Training input with `is_train`, class `weight`, a `shard` of bounded size and its `place` among all; the number of shards.

    An institution of up to `rows_per_shard` rows is one shard, hence one client as a whole.
    `ml` is read several times, so it should be a stored table.
    """
    # All over one row per class of an institution.
    classes = Window.partitionBy("institution")
    records = F.sum("records").over(classes)
    once = F.when(F.row_number().over(classes.orderBy(LABEL)) == 1, F.col("_shards"))
    upto = F.sum("_once").over(Window.orderBy("institution").rangeBetween(Window.unboundedPreceding, 0))
    known = written(class_weights(ml, ["institution"]).select(
        "institution", LABEL, F.ceil(records / settings.rows_per_shard).cast("int").alias("_shards"),
        "weight" if settings.weighted_loss else F.lit(1.0).alias("weight"),
    ).withColumn("_once", once).withColumn("_before", (upto - F.col("_shards")).cast("int")).drop("_once"), "classes")
    shards = known.select("institution", "_shards").distinct().agg(F.sum("_shards")).first()[0] or 0
    shard = F.pmod(F.xxhash64(F.col(row_id), F.lit(settings.seed)), F.col("_shards")).cast("int")
    rows = attach(ml, known, ["institution", LABEL])
    split = split_train_val(rows, ["institution"], row_id, 0.8, settings.seed)
    return split.select(
        "institution", shard.alias("shard"), row_id, "features", F.col(LABEL).alias("label"), "weight", "is_train",
        (F.col("_before") + shard).alias("place"),
    ), shards


def in_shards(rows: DataFrame, rows_per_shard: int, seed: int = SEED) -> DataFrame:
    """`rows` plus a `shard` of about `rows_per_shard` rows of an institution, dealt by the whole row, as ids may be missing.

    `rows` is read twice, so it should be a stored table. Rows without an institution are one shard.
    """
    counts = rows.groupBy("institution").agg(F.ceil(F.count("*") / rows_per_shard).cast("int").alias("_shards"))
    shard = F.pmod(F.xxhash64(*rows.columns, F.lit(seed)), F.col("_shards")).cast("int")
    return attach(rows, counts, ["institution"]).withColumn("shard", F.coalesce(shard, F.lit(0))).drop("_shards")


def bucketed(rows: DataFrame, shards: int) -> tuple[DataFrame, str]:
    """Store the client table bucketed by (institution, shard): rounds then need no shuffle of it.

    Few shards get more buckets than there are shards, so that two rarely wait for each other.
    """
    spark = rows.sparkSession
    buckets = max(1, min(8 * shards, max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    name = f"pulsefold_clients_{uuid.uuid4().hex}"
    (
        rows.repartition(buckets, "institution", "shard")
        .write.partitionBy("is_train").bucketBy(buckets, "institution", "shard")
        .option("path", shared_path(spark, "clients")).saveAsTable(name)
    )
    return spark.table(name), name


def in_teams(rows: DataFrame, shards: int) -> tuple[DataFrame, str]:
    """`bucketed`, but by `team`: as many shards as a task trains side by side, at most `SIDE_BY_SIDE`.

    Shards go to teams in turn by their `place`, so teams are equally large; beyond the number of cores, the teams are a
    multiple of it.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    teams = max(1, min(shards, cores * math.ceil(shards / (SIDE_BY_SIDE * cores))))
    name = f"pulsefold_clients_{uuid.uuid4().hex}"
    # For every bucket a number that Spark's hash puts there: a team then has a task to itself.
    bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(teams))
    own = dict(tuple(r) for r in spark.range(64 * teams).groupBy(bucket).agg(F.min("id")).collect())
    names = F.lit([own.get(team, team) for team in range(teams)]).cast("array<int>")
    (
        rows.withColumn("team", F.element_at(names, F.pmod("place", F.lit(teams)) + 1))
        .repartition(teams, "team")
        .write.partitionBy("is_train").bucketBy(teams, "team")
        .option("path", shared_path(spark, "clients")).saveAsTable(name)
    )
    return spark.table(name), name


def local_updates(train: DataFrame, params: np.ndarray, dims: tuple[int, ...], settings: RoundSettings,
                  number: int, options: dict | None = None, local_fit: LocalFit | None = None) -> DataFrame:
    """Every shard trains from the global parameters; one row per shard comes back.

    `options` are the round's (default: the settings'), `local_fit` replaces the network's training.
    """
    # Only plain values and `network` go into the function: an object of a class defined here
    # would make every executor import this package.
    options, columns = {**settings.round_options(number), **(options or {})}, [c.split(" ")[0] for c in UPDATE.split(", ")]
    if local_fit is not None:
        own = train.where("is_train") if "is_train" in train.columns else train
        return own.groupBy("institution", "shard").applyInPandas(
            lambda key, rows: local_fit(key, rows, params, options).assign(val_examples=None, epochs=None)[columns], UPDATE)
    fit, flat, inputs = network.train_each, params, [f"x{i}" for i in range(dims[0])]
    seed, rate, dropout = settings.seed, options.get("learning_rate", settings.learning_rate), settings.dropout

    def fit_shards(rows: pd.DataFrame) -> pd.DataFrame:
        shards, known = [], []
        for (institution, shard), part in rows.groupby(["institution", "shard"], sort=False, dropna=False):
            part = part.sort_values("event_id")
            own = part["is_train"].to_numpy()
            if not own.any():
                continue
            x, y, w = np.ascontiguousarray(part[inputs].to_numpy()), part["label"].to_numpy(), part["weight"].to_numpy()
            held_out = None if own.all() else (x[~own], y[~own])
            rng = np.random.default_rng([seed, options["round"], int(shard), *institution.encode()])
            shards.append((x[own], y[own], w[own], rng, held_out))
            known.append((institution, int(shard), int(own.sum()), int((~own).sum())))
        if not shards:
            return pd.DataFrame(columns=columns)
        found = []
        for (institution, shard, n, held), (new, epochs) in zip(known, fit(
                flat, dims, shards, options["local_epochs"], options["batch_size"], rate, dropout)):
            each = [dict(zip(("train_loss", "train_accuracy", "val_loss", "val_accuracy"), e)) for e in epochs]
            found.append([institution, shard, n, new.tolist(), *epochs[-1][:2], held, each])
        return pd.DataFrame(found, columns=columns)

    # Features travel as plain columns: an array would be an object in Python for every row.
    by = ["team"] if "team" in train.columns else ["institution", "shard"]
    is_train = "is_train" if "is_train" in train.columns else F.lit(True).alias("is_train")
    plain = train.select(*dict.fromkeys([*by, "institution", "shard", "event_id", "label", "weight"]), is_train,
                         *[F.col("features")[i].alias(name) for i, name in enumerate(inputs)])
    return plain.groupBy(*by).applyInPandas(fit_shards, UPDATE)


def synchronous_updates(rows: DataFrame, params: np.ndarray, dims: tuple[int, ...], settings: RoundSettings,
                        number: int, path: str, options: dict | None = None) -> DataFrame:
    """`local_updates` by steps over all shards of an institution: one row per institution, as its shard 0."""
    options = {**settings.round_options(number), **(options or {})}
    steps = StepSettings(
        options["local_epochs"], options.get("step_batches", settings.step_batches),
        options.get("learning_rate", settings.learning_rate), settings.adam, settings.seed)
    states = train_synchronous(rows, params, dims, steps, path)
    figures = F.struct("epoch", "train_loss", "train_accuracy", "val_loss", "val_accuracy")
    epochs = epoch_metrics(states).groupBy("institution").agg(
        F.max_by("num_examples", "epoch").alias("num_examples"), F.max_by("train_loss", "epoch").alias("train_loss"),
        F.max_by("train_accuracy", "epoch").alias("train_accuracy"), F.max("val_examples").alias("val_examples"),
        F.array_sort(F.collect_list(figures)).alias("epochs"))  # as many as the settings say
    without = F.transform("epochs", lambda e: e.dropFields("epoch"))
    return epochs.join(synchronous.final_models(states), "institution").select(
        "institution", F.lit(0).alias("shard"), "num_examples", "params", "train_loss", "train_accuracy", "val_examples", without.alias("epochs"))


def merged_epochs(updates: DataFrame, by: list[str]) -> DataFrame:
    """One row per epoch: the figures of the shards, weighted by their training and held-out rows."""
    each = updates.select(*by, "num_examples", "val_examples", F.posexplode("epochs").alias("epoch", "e"))
    n, v = F.col("num_examples"), F.when(F.col("e.val_loss").isNotNull(), F.col("val_examples"))
    return each.groupBy(*by, (F.col("epoch") + 1).alias("epoch")).agg(
        F.sum(n).alias("num_examples"), *[(F.sum(n * F.col(f"e.{m}")) / F.sum(n)).alias(m) for m in ("train_loss", "train_accuracy")],
        F.sum(v).alias("val_examples"), *[(F.sum(v * F.col(f"e.{m}")) / F.sum(v)).alias(m) for m in ("val_loss", "val_accuracy")])


def left_out(updates: DataFrame) -> DataFrame:
    """The rows that `merge_shards` can't use."""
    return updates.where(F.exists("params", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def merge_shards(updates: DataFrame) -> DataFrame:
    """One row per institution: averaged parameters, example-weighted training metrics."""
    n = F.col("num_examples")
    metrics = [(F.sum(n * F.col(m)) / F.sum(n)).alias(m) for m in ("train_loss", "train_accuracy")]
    return average_params(finite_params(updates), ["institution"], "num_examples", "params", *metrics)


def score_global(rows: DataFrame, params: np.ndarray, dims: tuple[int, ...]) -> DataFrame:
    """(institution, label, p) under the one global model."""
    probability = network.positive_probability

    @F.pandas_udf("double")
    def p(features: pd.Series) -> pd.Series:
        return pd.Series(probability(params, dims, np.stack(features.to_numpy())))

    return rows.select("institution", "label", p("features").alias("p"))


def score_local(rows: DataFrame, local: DataFrame, dims: tuple[int, ...],
                max_models: int = MODELS_IN_CLOSURE) -> DataFrame:
    """(institution, label, p) under each institution's own model; without a model, no score.

    Up to `max_models` models travel with the function; more are joined to the rows shard
    by shard.
    """
    probability = network.positive_probability
    few = local.select("institution", "params").limit(max_models + 1).collect()
    if len(few) <= max_models:
        models = {r["institution"]: np.array(r["params"]) for r in few}

        @F.pandas_udf("double")
        def p(institution: pd.Series, features: pd.Series) -> pd.Series:
            out = pd.Series(np.nan, index=features.index)
            for name, part in features.groupby(institution):
                out.loc[part.index] = probability(models[name], dims, np.stack(part.to_numpy()))
            return out

        present = rows.where(F.col("institution").isin(list(models)))
        return present.select("institution", "label", p("institution", "features").alias("p"))

    def score_shard(part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if part.empty or model.empty:
            return pd.DataFrame(columns=["institution", "label", "p"])
        p = probability(np.array(model["params"].iloc[0]), dims, np.stack(part["features"].to_numpy()))
        return part[["institution", "label"]].assign(p=p)

    shards = rows.select("institution", F.col("shard").alias("_shard")).distinct()
    models = local.select("institution", "params").join(shards, "institution")
    return rows.groupBy("institution", "shard").cogroup(models.groupBy("institution", "_shard")).applyInPandas(
        score_shard, "institution string, label int, p double"
    )


def finished_rounds(spark: SparkSession, run_dir: str) -> int:
    """How many rounds an earlier run left complete in `run_dir`."""
    spark.createDataFrame([], EVALUATED).write.mode("ignore").parquet(f"{run_dir}/evaluated/round=0")
    return kept_rounds(spark, run_dir, "evaluated", EVALUATED).agg(F.max("round")).first()[0] or 0


def train_federated(ml: DataFrame, settings: RoundSettings = RoundSettings(), run_dir: str | None = None,
                    row_id: str = "event_id", on_round: Callable[[int, DataFrame], None] | None = None,
                    config_fn: Callable[[int], dict] | None = None, local_fit: LocalFit | None = None,
                    initial: np.ndarray | None = None) -> FederatedResult:
    """Run the rounds. Each leaves its parameters and metrics in `run_dir`, so a broken run goes on there.

    Hooks: `config_fn(round)` gives options of a round over the settings' own, `local_fit` is
    another trainer, `initial` its first parameters, `on_round` sees each round's metrics.
    """
    spark = ml.sparkSession
    run_dir = run_dir or shared_path(spark, "federated")
    # Only the network's own training takes shards side by side.
    store = in_teams if settings.mode == "averaged" and local_fit is None else bucketed
    rows, table = store(*client_table(ml.withColumnRenamed(row_id, "event_id"), settings))
    try:
        params, dims = _run_rounds(rows, settings, run_dir, on_round, config_fn, local_fit, initial)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    measured = kept_rounds(spark, run_dir, "evaluated", EVALUATED)
    own = measured.where("model = 'local'").select(
        "round", "institution", F.col("loss").alias("val_loss"), F.col("accuracy").alias("val_accuracy"),
        F.col("f1").alias("val_f1"), F.col("auc").alias("val_auc"),
    )
    fit = kept_rounds(spark, run_dir, "local", LOCAL).drop("params").join(own, ["round", "institution"], "left")
    return FederatedResult(params, dims, run_dir, fit, measured.where("model = 'global'").drop("model"))


def same_run(spark: SparkSession, run_dir: str, text: str) -> None:
    """Note what a run was started with; refuse to go on in the folder of a different one."""
    spark.createDataFrame([(text,)], "manifest string").write.mode("ignore").parquet(f"{run_dir}/manifest")
    found = spark.read.schema("manifest string").parquet(f"{run_dir}/manifest").first()["manifest"]
    if found != text:
        raise ValueError(f"{run_dir} holds another run: {found}, not {text}")


def _run_rounds(rows: DataFrame, settings: RoundSettings, run_dir: str, on_round, config_fn, local_fit,
                initial) -> tuple[np.ndarray, tuple[int, ...]]:
    spark = rows.sparkSession
    everyone = written(rows.select("institution").distinct(), "institutions")
    dims = settings.dims(input_dimension(rows))
    params = network.initial_params(dims, settings.seed) if initial is None else np.asarray(initial, float)
    # More rounds may be asked of a finished run, everything else must be as it was.
    hooks = f"config_fn={named(config_fn)} local_fit={named(local_fit)} initial={hashlib.md5(params.tobytes()).hexdigest()}"
    same_run(spark, run_dir, f"{replace(settings, rounds=0)} dims={dims} rows={rows.count()} {hooks}")
    start = finished_rounds(spark, run_dir)
    if start:
        params = global_params(spark, run_dir, start)
    for number in range(start + 1, settings.rounds + 1):
        clients = sample_clients(
            everyone, number, settings.fraction_fit, settings.min_fit_clients, settings.min_clients, settings.seed
        )
        judges = sample_clients(
            everyone, -number, settings.fraction_evaluate, settings.min_evaluate_clients, settings.min_clients,
            settings.seed,
        )
        chosen, held_out = only(rows, clients, everyone), rows.where("not is_train")
        options = config_fn(number) if config_fn else None
        if settings.mode == "synchronous" and local_fit is None:
            updates = synchronous_updates(chosen, params, dims, settings, number, f"{run_dir}/steps/round={number}", options)
        else:
            updates = local_updates(chosen, params, dims, settings, number, options, local_fit)
        keep_round(updates, run_dir, "shards", number)
        keep_round(merge_shards(kept_round(spark, run_dir, "shards", UPDATE, number)), run_dir, "local", number)
        params = global_params(spark, run_dir, number)
        local = kept_round(spark, run_dir, "local", LOCAL, number)
        own = score_local(only(held_out, clients, everyone), local, dims).withColumn("model", F.lit("local"))
        shared = score_global(only(held_out, judges, everyone), params, dims).withColumn("model", F.lit("global"))
        measured = evaluation(own.unionByName(shared), ["institution", "model"])
        # Written last: its presence says the round is complete.
        keep_round(measured, run_dir, "evaluated", number)
        if on_round:
            on_round(number, measured)
    return params, dims


def named(hook: Callable | None) -> str:
    """What tells one hook from another between runs: where it is defined and a digest of its code and constants."""
    if hook is None:
        return "none"
    code = getattr(hook, "__code__", None)
    text = f"{code.co_code!r}{[c for c in code.co_consts if not hasattr(c, 'co_code')]!r}{code.co_names!r}" if code else repr(type(hook))
    return f"{getattr(hook, '__module__', '')}.{getattr(hook, '__qualname__', type(hook).__qualname__)}:{hashlib.md5(text.encode()).hexdigest()[:12]}"


def only(rows: DataFrame, chosen: DataFrame, everyone: DataFrame) -> DataFrame:
    """The rows of the chosen institutions."""
    return rows if chosen is everyone else attach(rows, chosen, ["institution"], "left_semi")


def global_params(spark: SparkSession, run_dir: str, number: int) -> np.ndarray:
    """The weighted mean of a round's institutions: one array, whatever their number."""
    merged = average_params(kept_round(spark, run_dir, "local", LOCAL, number), []).first()
    if merged is None:
        raise RuntimeError(f"round {number}: no client returned finite parameters")
    return np.array(merged["params"])


def keep_round(df: DataFrame, run_dir: str, what: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{run_dir}/{what}/round={number}")


def kept_round(spark: SparkSession, run_dir: str, what: str, schema: str, number: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{run_dir}/{what}/round={number}")


def kept_rounds(spark: SparkSession, run_dir: str, what: str, schema: str) -> DataFrame:
    """All rounds of a run, told apart by `round`."""
    return spark.read.schema(f"{schema}, round int").parquet(f"{run_dir}/{what}")


def save_model(spark: SparkSession, path: str, params: np.ndarray, dims: tuple[int, ...]) -> None:
    spark.createDataFrame(
        [(list(dims), np.asarray(params, dtype=float).tolist())], "dims array<int>, params array<double>"
    ).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> tuple[np.ndarray, tuple[int, ...]]:
    row = spark.read.parquet(path).first()
    return np.array(row["params"]), tuple(row["dims"])


# Exact mode: logistic regression by full-batch gradient steps, all of it SQL aggregates.

def logistic_step(ml: DataFrame, params: list[float], learning_rate: float) -> DataFrame:
    """One local step per institution from the shared parameters (bias last)."""
    d = len(params) - 1
    x = [F.col("features")[j] for j in range(d)]
    z = sum((F.lit(params[j]) * x[j] for j in range(d)), F.lit(params[d]))
    error = 1.0 / (1.0 + F.exp(-z)) - F.col(LABEL)
    errors = ml.withColumn("_e", error)
    slopes = [F.avg(F.col("_e") * F.col("features")[j]) for j in range(d)] + [F.avg("_e")]
    stepped: list[Column] = [F.lit(p) - F.lit(learning_rate) * g for p, g in zip(params, slopes)]
    return errors.groupBy("institution").agg(F.count("*").alias("num_examples"), F.array(*stepped).alias("params"))


def logistic_rounds(ml: DataFrame, rounds: int, learning_rate: float = 0.5) -> DataFrame:
    """(round, institution, num_examples, params) of every local model, one job per round."""
    spark = ml.sparkSession
    data = written(ml.select("institution", "features", LABEL), "logistic")
    params = [0.0] * (input_dimension(data) + 1)
    path = shared_path(spark, "logistic-rounds")
    for number in range(1, rounds + 1):
        keep_round(logistic_step(data, params, learning_rate), path, "local", number)
        params = average_params(kept_round(spark, path, "local", STEP, number), []).first()["params"]
    return kept_rounds(spark, path, "local", STEP)
