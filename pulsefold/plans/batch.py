"""The batch run from raw files to trained models, one function per stage."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsefold.operators.clean import preprocess, resolve_time
from pulsefold.operators.features import calendar_and_category, ml_table, reject_counts
from pulsefold.operators.metrics import history_arrays, summary, weighted_metrics
from pulsefold.operators.splits import split_institutions
from pulsefold.plans.central import MEASURES, compare, held_out_metrics, train_central
from pulsefold.plans.federated import (
    EVAL_COLUMNS, FederatedResult, RoundSettings, client_table, save_model, train_federated,
)
from pulsefold.schema import ORDER
from pulsefold.sources.readings import number_rows, read_csv
from pulsefold.sources.sinks import write_by_institution, write_jsonl


@dataclass(frozen=True)
class Folders:
    """Where the stages leave their tables below one base folder."""

    base: str

    def __getattr__(self, name: str) -> str:
        if name in ("stream_input", "batch", "epochs", "ml", "rejected", "left_out", "federated", "history", "comparison", "model", "central_model"):
            return f"{self.base}/{name}"
        raise AttributeError(name)


def ingest(spark: SparkSession, raw_dir: str, start: str | None = None) -> DataFrame:
    """Raw CSV readings with `ts` and a dense `event_id` in file order."""
    rows = number_rows(read_csv(spark, raw_dir, file_order=True))
    return resolve_time(rows, start, "event_id")


def prepare_institutions(readings: DataFrame, folders: Folders, institutions: int = 3,
                         series: str | None = None, made_up: bool = False) -> DataFrame:
    """Clean, split and store readings as JSON lines and Parquet. Returns the stored table.

    Rolling features come before the split, so a row keeps the neighbours it had in its series.
    Without a series key the whole input is one series in file order.
    """
    keep, order = (("event_id",), ("event_id",)) if series is None else ((series, "event_id"), ORDER)
    cleaned = preprocess(readings, series, keep, null_std="zero", order=order, made_up=made_up)
    write_by_institution(split_institutions(cleaned, institutions), folders.batch)
    stored = cleaned.sparkSession.read.parquet(folders.batch)
    write_jsonl(stored, folders.stream_input)
    return stored


def build_ml_tables(prepared: DataFrame, folders: Folders) -> DataFrame:
    """Standardise per institution and store the training table, and how many rows of each had to be left out."""
    rows = calendar_and_category(prepared)
    write_by_institution(ml_table(rows, ["institution"], ("event_id",)), folders.ml)
    reject_counts(rows, "institution").write.mode("overwrite").parquet(folders.rejected)
    return prepared.sparkSession.read.parquet(folders.ml)


def train_and_compare(ml: DataFrame, folders: Folders, settings: RoundSettings = RoundSettings(),
                      max_iter: int = 50) -> tuple[FederatedResult, DataFrame, DataFrame]:
    """Federated rounds, the central model, and both over the same held-out rows, all stored."""
    spark = ml.sparkSession
    result = train_federated(ml, settings, folders.federated)
    save_model(spark, folders.model, result.params, result.dims)
    history = result.history()
    history_arrays(history).coalesce(1).write.mode("overwrite").json(folders.history)  # one object of parallel arrays
    result.left_out().write.mode("overwrite").parquet(folders.left_out)
    model, central = train_central(ml, "mlp", max_iter, settings.hidden, seed=settings.seed, by=("institution",))
    model.write().overwrite().save(folders.central_model)
    federated = held_out_metrics(client_table(ml, settings)[0], result.params, result.dims, "federated")
    result.epochs().write.mode("overwrite").parquet(folders.epochs)
    compare(federated, central).write.mode("overwrite").parquet(folders.comparison)
    return result, summary(history), spark.read.parquet(folders.comparison)


def last_evaluation(result: FederatedResult) -> DataFrame:
    """The global model's metrics in the last round, weighted over institutions."""
    rounds = weighted_metrics(result.evaluated, EVAL_COLUMNS)
    last = F.max_by(F.struct(*MEASURES), "round").alias("m")
    return rounds.agg(last).select("m.*")


def run_batch(spark: SparkSession, raw_dir: str, out_dir: str, institutions: int = 3, start: str | None = None,
              settings: RoundSettings = RoundSettings(), max_iter: int = 50, made_up: bool = False):
    """All stages; each replaces what an earlier run left, and the rounds go on where it broke off.

    The first failure stops the run. Every institution takes part in every round.
    """
    folders = Folders(out_dir)
    prepared = prepare_institutions(ingest(spark, raw_dir, start), folders, institutions, made_up=made_up)
    ml = build_ml_tables(prepared, folders)
    everyone = replace(
        settings, min_clients=institutions, min_fit_clients=institutions, min_evaluate_clients=institutions
    )
    return train_and_compare(ml, folders, everyone, max_iter)
