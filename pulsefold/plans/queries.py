"""Every operator as a query over the given tables: name -> function(spark, folder) -> DataFrame."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsefold.functions import columns as C, network
from pulsefold.operators import metrics as M
from pulsefold.operators.averaging import average_params
from pulsefold.operators.clean import (
    calendar, fill_and_clip, fill_constants, preprocess, regular_timestamps, resolve_glucose, resolve_time,
    vitals,
)
from pulsefold.operators.features import (
    calendar_and_category, input_dimension, ml_table, prepare_ml_data, reject_counts, standardise,
)
from pulsefold.operators.median import exact_median
from pulsefold.operators.splits import sample_clients, shuffled_position, split_institutions, split_train_val
from pulsefold.operators.stats import class_distribution, class_weights, live_statistics, record_counts, with_class_weight
from pulsefold.operators.windows import rolling_features
from pulsefold.plans.central import (
    MEASURES, compare, compare_on_same_rows, held_out_metrics, train_central, train_central_steps, union_institutions,
)
from pulsefold.plans.federated import (
    FederatedResult, RoundSettings, client_table, in_shards, kept_rounds, local_updates, logistic_rounds, merge_shards, score_global, train_federated, LOCAL,
)
from pulsefold.plans.synchronous import StepSettings
from pulsefold.schema import EVENTS_SCHEMA, FEATURE_COLUMNS, GLUCOSE_ALIASES, KEYED_STREAM_SCHEMA, LABEL, ORDER
from pulsefold.session import shared_path, written
from pulsefold.sources.readings import events_as_readings, read_csv, read_jsonl, read_parquet, readings
from pulsefold.sources.sinks import as_json_rows, replay_records, write_by_institution, write_csv, write_jsonl, write_replay
from pulsefold.streaming import flow

KEYS = ("institution", "series_id", "event_id")
ROLLED = ("glucose_ma_1h", "glucose_std_1h", "glucose_roc")
SECONDS = "yyyy-MM-dd HH:mm:ss"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def processed(spark: SparkSession, sf_dir: str, null_std: str = "zero") -> DataFrame:
    return preprocess(readings(spark, sf_dir), keep=KEYS, null_std=null_std)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_and_category(processed(spark, sf_dir))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml_table(features(spark, sf_dir), ["institution"], ("event_id",))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The feature array as one rounded column per feature."""
    return df.select(*keys, *[F.round(F.col("features")[i], 6).alias(c) for i, c in enumerate(FEATURE_COLUMNS)], LABEL)


# Sources and sinks

def csv_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings to CSV with a differently named glucose column and NA tokens, back, to JSON lines, back."""
    csv, jsonl = shared_path(spark, "csv"), shared_path(spark, "jsonl")
    raw = readings(spark, sf_dir)
    write_csv(raw.select(
        "institution", "series_id", "event_id", F.col("ts").alias("time"),
        F.coalesce(F.col("glucose").cast("string"), F.lit("NA")).alias("bg"), "steps", "heart_rate",
    ), csv)
    back = resolve_time(resolve_glucose(read_csv(spark, csv)))
    typed = back.select(
        "institution", F.col("series_id").cast("bigint"), F.col("event_id").cast("bigint"),
        F.col("ts").alias("timestamp"), "glucose", F.col("steps").cast("int"), F.col("heart_rate").cast("int"),
    )
    write_jsonl(typed, jsonl)
    again = read_jsonl(spark, jsonl, KEYED_STREAM_SCHEMA)
    return again.select(
        *KEYS, F.date_format(C.parse_time_strict(F.col("timestamp")), SECONDS).alias("ts"),
        F.round("glucose", 6).alias("glucose"), "steps", "heart_rate",
    )


def ml_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "ml")
    write_by_institution(training_rows(spark, sf_dir), path)
    return spread(read_parquet(spark, path), "institution", "event_id")


def ml_input_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    size = input_dimension(rows)
    return rows.select("institution", F.lit(size).cast("bigint").alias("input_dim")).distinct()


# Cleaning

def glucose_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = readings(spark, sf_dir)
    median = exact_median(raw, "glucose")
    return raw.agg(F.count("glucose").alias("known"), F.lit(median).alias("median_glucose"))


def clean_median_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_and_clip(readings(spark, sf_dir)).select("event_id", F.round("glucose", 6).alias("glucose"))


def glucose_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings under every known name of the glucose column, beside columns with the names that rank behind it."""
    raw = readings(spark, sf_dir)
    found = []
    for k, alias in enumerate(GLUCOSE_ALIASES):
        behind = [F.lit(-1.0).alias(name) for name in GLUCOSE_ALIASES[k + 1:]]
        named = raw.select("event_id", *behind, F.col("glucose").alias(alias))
        found.append(resolve_glucose(named).select("event_id", F.lit(alias).alias("found_as"), F.round("glucose", 6).alias("glucose")))
    return union_institutions(found)


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_text = readings(spark, sf_dir).select("event_id", F.col("ts").cast("string").alias("timestamp"))
    parsed = calendar(resolve_time(as_text))
    return parsed.select(
        "event_id", F.date_format("ts", SECONDS).alias("ts"), "hour", "day_of_week",
        C.is_night(F.col("hour")).alias("is_night"), C.is_weekend(F.col("day_of_week")).alias("is_weekend"),
    )


def regular_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    timeless = readings(spark, sf_dir).select("event_id")
    spaced = regular_timestamps(timeless, "2024-01-01 00:00:00", ["event_id"])
    return spaced.select("event_id", F.date_format("ts", SECONDS).alias("ts"))


def category_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("event_id", C.category_stream(F.col("glucose")).alias("glucose_category"))


def category_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("event_id", C.category_batch(F.col("glucose")).alias("glucose_category"))


def hypo_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("event_id", C.hypo_risk(F.col("glucose")).alias("hypo_risk"))


def constant_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over readings with gaps leave NULLs everywhere; the constants close them."""
    gaps = readings(spark, sf_dir).withColumn("steps", F.when(F.col("event_type") != "view", F.col("steps")))
    filled = fill_constants(rolling_features(gaps.withColumn("hour", F.hour("ts"))))
    return rounded(filled.select("event_id", "glucose", *ROLLED, "steps", "heart_rate", "hour"), "glucose", *ROLLED)


def synth_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    made_up = vitals(readings(spark, sf_dir).select("event_id", "glucose"), made_up=True)
    return made_up.select("event_id", "steps", "heart_rate")


def processed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten columns of the cleaned table, a first deviation left missing."""
    table = processed(spark, sf_dir, "keep").withColumn("timestamp", F.date_format("timestamp", SECONDS))
    return rounded(table, "glucose", *ROLLED)


# Windows

def _rolled(df: DataFrame) -> DataFrame:
    return rounded(df.select("event_id", "glucose", *ROLLED), "glucose", *ROLLED)


def rolling_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(rolling_features(fill_and_clip(readings(spark, sf_dir))))


def rolling_short_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series per user and event type: about half have 12 readings or fewer."""
    filled = fill_and_clip(readings(spark, sf_dir))
    keyed = filled.withColumn("series_id", F.concat_ws(":", "series_id", "event_type"))
    return _rolled(rolling_features(keyed))


def rolling_long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All series in blocks of 70 rows, as if each were too long for one task."""
    return _rolled(rolling_features(fill_and_clip(readings(spark, sf_dir)), series_bytes=0, block_rows=70))


def rolling_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as one series, in blocks of 100 rows."""
    return _rolled(rolling_features(fill_and_clip(readings(spark, sf_dir)), None, block_rows=100))


# Statistics

def stats_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(live_statistics(features(spark, sf_dir)), "avg_glucose", "std_glucose", "avg_heart_rate")


def stats_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = live_statistics(features(spark, sf_dir), "institution")
    return rounded(statistics, "avg_glucose", "std_glucose", "avg_heart_rate")


def record_count_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_counts(readings(spark, sf_dir), "institution")


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_distribution(features(spark, sf_dir), ["institution"])


def class_weight_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_weights(features(spark, sf_dir), ["institution"]), "weight")


def class_weighted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_class_weight(features(spark, sf_dir), ["institution"])
    return rounded(rows.select("event_id", "institution", LABEL, "weight"), "weight")


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With gaps left open, incomplete rows are counted before they are left out."""
    rows = calendar_and_category(processed(spark, sf_dir, "keep"))
    return reject_counts(rows, "institution")


# Splits

def shuffled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled_position(readings(spark, sf_dir).select("event_id")).select("event_id", "position")


def institution_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_institutions(readings(spark, sf_dir).select("event_id"), 3)


def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_train_val(readings(spark, sf_dir).select("institution", "event_id"), ["institution"])
    return split.withColumn("is_train", F.col("is_train").cast("int"))


# Features

def scaled_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(training_rows(spark, sf_dir), "institution", "event_id")


def scaled_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(ml_table(features(spark, sf_dir), ["institution"], ("event_id",), population=False),
                  "institution", "event_id")


def scaled_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table through the Spark ML assembler and scaler."""
    return spread(prepare_ml_data(features(spark, sf_dir), ("event_id",)), "event_id")


def scaled_on_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaler fitted on training rows only."""
    rows = split_train_val(features(spark, sf_dir), ["institution"])
    scaled = standardise(rows, ["institution"], fit_on=F.col("is_train"))
    return rounded(scaled.select("event_id", *FEATURE_COLUMNS), *FEATURE_COLUMNS)


def union_of_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored tables of all institutions in one scan, however many they are."""
    path = shared_path(spark, "ml")
    write_by_institution(training_rows(spark, sf_dir), path)
    return spread(read_parquet(spark, path), "event_id")


# Model quality

def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed logistic score with many ties, from the rolling mean in whole units."""
    level = F.floor(F.round("glucose_ma_1h", 6)).cast("double")
    rows = features(spark, sf_dir).select("institution", F.col(LABEL).alias("label"), C.sigmoid((75.0 - level) / 10.0).alias("p"))
    return rows.withColumn("predicted", (F.col("p") > 0.5).cast("int"))


def confusion_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = M.confusion_metrics(scored_rows(spark, sf_dir), ["institution"])
    return rounded(table, "accuracy", "precision", "recall", "f1")


def roc_auc_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.roc_auc(scored_rows(spark, sf_dir), ["institution"]), "auc")


def roc_auc_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous scores: as many distinct values as rows."""
    rows = features(spark, sf_dir).select("institution", F.col(LABEL).alias("label"), (-F.round("glucose_ma_1h", 6)).alias("p"))
    return rounded(M.roc_auc(rows, ["institution"]), "auc")


def cross_entropy_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.cross_entropy(scored_rows(spark, sf_dir), ["institution"]), "loss")


def evaluation_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = M.evaluation(scored_rows(spark, sf_dir), ["institution"])
    return rounded(table, "loss", "accuracy", "precision", "recall", "f1", "auc")


# Rounds: each day of the month stands for a round, each institution for a client.

def client_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.dayofmonth("timestamp")
    per_client = features(spark, sf_dir).groupBy(day.alias("round"), "institution").agg(
        F.count("*").alias("num_examples"),
        (F.avg("glucose") / 100).alias("train_loss"),
        F.avg(F.lit(1.0) - F.col(LABEL)).alias("train_accuracy"),
        F.avg("is_night").alias("_night"), F.avg("is_weekend").alias("_weekend"),
    )
    second, first = F.col("institution") == "institution_2", F.col("institution") == "institution_1"
    return per_client.withColumns({
        "val_f1": F.when(~(second & (F.col("round") % 2 == 0)), F.col("_night")),
        "val_auc": F.when(~(first & (F.col("round") % 7 == 0)), F.col("_night") / 2 + 0.25),
        "val_accuracy": F.when(F.col("round") % 5 != 0, F.round(1 - F.col("_night"), 1)),
    }).drop("_night", "_weekend")


def global_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.dayofmonth("timestamp")
    return features(spark, sf_dir).groupBy(day.alias("round"), "institution").agg(
        F.count("*").alias("num_examples"), F.avg("is_night").alias("accuracy"),
        F.avg(LABEL).alias("f1"), (F.avg(LABEL) / 2).alias("auc"),
    )


FIT = ("train_loss", "train_accuracy", "val_accuracy", "val_f1", "val_auc")
EVALUATED = ("accuracy", "f1", "auc")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some odd rounds lack the fit, every fourth the evaluation, none lacks both."""
    fit = M.weighted_metrics(client_results(spark, sf_dir).where("round % 6 <> 3"), FIT)
    evaluated = M.weighted_metrics(global_results(spark, sf_dir).where("round % 4 <> 0"), EVALUATED)
    return M.round_history(fit, evaluated)


def weighted_client_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = M.weighted_metrics(client_results(spark, sf_dir), FIT)
    return rounded(table, *FIT).withColumn("round", F.col("round").cast("bigint"))


def round_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(history(spark, sf_dir), *M.FIT_METRICS).withColumn("round", F.col("round").cast("bigint"))


def round_history_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = M.long_history(history(spark, sf_dir))
    return rounded(long, "value").withColumn("round", F.col("round").cast("bigint"))


def round_history_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = M.wide_history(M.long_history(history(spark, sf_dir)))
    return rounded(wide, *M.FIT_METRICS).withColumn("round", F.col("round").cast("bigint"))


def best_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = M.summary(history(spark, sf_dir)).withColumn("best_round", F.col("best_round").cast("bigint"))
    return rounded(table, "final_val_accuracy", "final_val_f1", "final_val_auc", "best_val_accuracy")


def last_epoch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour of a day stands for an epoch."""
    epochs = features(spark, sf_dir).groupBy(F.dayofmonth("timestamp").alias("round"), "institution", "hour").agg(
        F.avg("glucose").alias("train_loss"), F.avg(LABEL).alias("train_accuracy")
    )
    last = M.last_epoch(epochs, ["round", "institution"], ("train_loss", "train_accuracy"), "hour")
    return rounded(last, "train_loss", "train_accuracy").withColumn("round", F.col("round").cast("bigint"))


def history_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as one JSON document of parallel arrays, read back."""
    path = shared_path(spark, "history")
    M.history_arrays(history(spark, sf_dir)).write.json(path)
    back = spark.read.schema("rounds array<bigint>, train_accuracy array<double>, val_accuracy array<double>").json(path)
    return back.select(
        F.array_join(F.transform("rounds", lambda v: v.cast("string")), ",").alias("rounds"),
        F.size("train_accuracy").cast("bigint").alias("train_rounds"),
        F.round(F.aggregate("val_accuracy", F.lit(0.0), lambda a, v: a + v), 6).alias("val_accuracy_sum"),
    )


def pooled_against_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric by metric: the weighted mean over institutions beside all rows measured as one."""
    rows = written(scored_rows(spark, sf_dir), "scored")
    clients = M.evaluation(rows, ["institution"]).withColumn("round", F.lit(1))
    together = M.evaluation(rows.withColumn("all", F.lit("all")), ["all"])
    return rounded(compare(M.weighted_metrics(clients, MEASURES), together), "federated", "centralised")


def client_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as clients: a tenth of them is drawn for each of three rounds."""
    users = written(readings(spark, sf_dir).select(F.col("series_id").cast("string").alias("institution")).distinct(), "users")
    rounds = [sample_clients(users, r, 0.1).withColumn("round", F.lit(r).cast("bigint")) for r in (1, 2, 3)]
    return union_institutions(rounds)


def first_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest reading of every series, as an aggregate rather than a sort."""
    place = F.struct(*ORDER)
    first = F.min_by(F.struct("event_id", "glucose", "steps"), place).alias("r")
    return readings(spark, sf_dir).groupBy("series_id").agg(first).select("series_id", "r.*")


# Federated averaging

def client_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("glucose", *ROLLED, "steps", "heart_rate")
    return features(spark, sf_dir).groupBy("institution").agg(
        F.count("*").alias("num_examples"), F.array(*[F.avg(c) for c in columns]).alias("params")
    )


def _positions(averaged: DataFrame) -> DataFrame:
    placed = averaged.select(F.posexplode("params").alias("pos", "value"))
    return placed.select(F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


def fedavg_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(average_params(client_params(spark, sf_dir), []))


def fedavg_unweighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(average_params(client_params(spark, sf_dir), [], None))


def fedavg_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector a client of its label, weighted by its id: one averaged array per label."""
    vectors = read_parquet(spark, f"{sf_dir}/embeddings.parquet").select(
        "label", (F.col("vec_id") % 7 + 1).alias("num_examples"), F.col("embedding").cast("array<double>").alias("params")
    )
    merged = average_params(vectors, ["label"])
    placed = merged.select(F.col("label").cast("bigint").alias("label"), F.posexplode("params").alias("pos", "value"))
    return placed.select("label", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


def fed_logreg_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = logistic_rounds(training_rows(spark, sf_dir), 3)
    names = [*FEATURE_COLUMNS, "bias"]
    return local.select(
        F.col("round").cast("bigint").alias("round"), "institution", "num_examples",
        *[F.round(F.col("params")[i], 6).alias(f"w_{n}") for i, n in enumerate(names)],
    )


# Streaming: the same rows through a real stream, read back from its sink.

def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows as they travel in JSON, with gaps for the stream's fill to close."""
    rows = processed(spark, sf_dir, "keep")
    return rows.withColumn("heart_rate", F.when(F.col("steps") >= 10, F.col("heart_rate")))


def _json_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 500) -> DataFrame:
    source = shared_path(spark, "replay")
    # Counting the readings costs no more than their file footers.
    write_replay(feed(spark, sf_dir), source, records_per_file=replay_records(readings(spark, sf_dir).count()))
    return flow.enrich(flow.json_source(spark, source, KEYED_STREAM_SCHEMA, files_per_trigger))


def _enriched_columns(df: DataFrame) -> DataFrame:
    return rounded(df.select(
        *KEYS, F.date_format("timestamp", SECONDS).alias("ts"), "glucose", *ROLLED, "steps", "heart_rate", "hour",
        "day_of_week", LABEL, "is_night", "is_weekend", F.col("glucose_category").cast("string").alias("glucose_category"),
    ), "glucose", *ROLLED)


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay files -> JSON stream -> enrichment -> exactly-once Parquet by category."""
    sink = shared_path(spark, "enriched")
    flow.drain(flow.to_parquet(_json_stream(spark, sf_dir), sink, shared_path(spark, "state"), available_now=True))
    return _enriched_columns(read_parquet(spark, sink))


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of the stream into two tables: all rows, and the risky ones."""
    rows, risky = shared_path(spark, "all"), shared_path(spark, "risky")
    shapes = {rows: lambda b: b.select("institution", "event_id", LABEL), risky: lambda b: b.where(f"{LABEL} = 1")}
    flow.drain(flow.fan_out(_json_stream(spark, sf_dir, 200), shapes, shared_path(spark, "state"), available_now=True))
    seen = read_parquet(spark, rows).groupBy("institution").agg(F.count("*").alias("records"))
    found = read_parquet(spark, risky).groupBy("institution").agg(F.count("*").alias("risky"))
    return seen.join(found, "institution", "left")


def stream_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live statistics kept in a memory table: one row per institution, all that reaches the driver."""
    name = f"live_{abs(hash(shared_path(spark, 'm')))}"
    statistics = live_statistics(_json_stream(spark, sf_dir), "institution")
    flow.drain(flow.to_memory(statistics, name, available_now=True, mode="complete"))
    return rounded(spark.table(name), "avg_glucose", "std_glucose", "avg_heart_rate")


BATCHES = 8


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of `BATCHES` files, one in each micro-batch."""
    source = shared_path(spark, "event-files")
    read_parquet(spark, f"{sf_dir}/events.parquet").repartition(BATCHES).write.parquet(source)
    rows = events_as_readings(flow.parquet_source(spark, source, EVENTS_SCHEMA, max_files_per_trigger=1))
    labelled = calendar(rows).withColumns({
        "timestamp": F.col("ts").cast("string"), LABEL: C.hypo_risk(F.col("glucose")),
    })
    return flow.enrich(labelled)


def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running statistics as streaming state."""
    path = shared_path(spark, "statistics")
    flow.drain(flow.to_statistics(
        _event_stream(spark, sf_dir), path, shared_path(spark, "state"), ("institution",), available_now=True
    ))
    return rounded(flow.latest_statistics(spark, path, ("institution",)), "avg_glucose", "std_glucose", "avg_heart_rate")


def stream_series_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running statistics of every series: batches write the series they have met, merged every three batches."""
    path, keys = shared_path(spark, "statistics"), ("institution", "series_id")
    flow.drain(flow.to_statistics(
        _event_stream(spark, sf_dir), path, shared_path(spark, "state"), keys, available_now=True, compact_every=3
    ))
    return rounded(flow.latest_statistics(spark, path, keys), "avg_glucose", "std_glucose", "avg_heart_rate", digits=9)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is stopped after two batches and started again from its checkpoint: its files hold every row once."""
    source, sink, state = (shared_path(spark, x) for x in ("replay", "enriched", "state"))
    as_json_rows(feed(spark, sf_dir)).repartition(BATCHES).write.json(source)
    for stop in (2, None):
        rows = flow.enrich(flow.json_source(spark, source, KEYED_STREAM_SCHEMA, 1))
        query = flow.to_parquet(rows, sink, state, available_now=True)
        flow.drain(query) if stop is None else flow.stop_after(query, stop)
    return _enriched_columns(read_parquet(spark, sink))


def stream_restart_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for running statistics: state and written changes go on where they were."""
    path, state, source = (shared_path(spark, x) for x in ("statistics", "state", "event-files"))
    read_parquet(spark, f"{sf_dir}/events.parquet").repartition(BATCHES).write.parquet(source)
    for stop in (3, None):
        rows = events_as_readings(flow.parquet_source(spark, source, EVENTS_SCHEMA, max_files_per_trigger=1))
        labelled = calendar(rows).withColumns({"timestamp": F.col("ts").cast("string"), LABEL: C.hypo_risk(F.col("glucose"))})
        query = flow.to_statistics(flow.enrich(labelled), path, state, ("institution",), available_now=True, compact_every=2)
        flow.drain(query) if stop is None else flow.stop_after(query, stop)
    return rounded(flow.latest_statistics(spark, path, ("institution",)), "avg_glucose", "std_glucose", "avg_heart_rate")


def stream_to_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> Parquet -> standardised training rows, whole table at once."""
    sink = shared_path(spark, "enriched")
    flow.drain(flow.to_parquet(_json_stream(spark, sf_dir), sink, shared_path(spark, "state"), available_now=True))
    return spread(prepare_ml_data(flow.fill_constants(read_parquet(spark, sink)), ("event_id",)), "event_id")


# Training

SMALL_NET = (len(FEATURE_COLUMNS), 3, 2)


def fixed_params() -> np.ndarray:
    """Parameters by a rule, so that plain SQL can write the same network out."""
    return (np.arange(network.parameter_count(SMALL_NET)) * 37 % 23 - 11) / 20.0


def client_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(spark, sf_dir).select(
        "institution", F.lit(0).alias("shard"), "event_id", "features", F.col(LABEL).alias("label"), F.lit(1.0).alias("weight"))


def network_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed network's scores of all rows, through the scoring function of the rounds."""
    scores = score_global(client_rows(spark, sf_dir), fixed_params(), SMALL_NET)
    table = scores.groupBy("institution", "label").agg(
        F.count("*").alias("records"), F.avg("p").alias("mean_p"), F.min("p").alias("least_p"), F.max("p").alias("greatest_p"))
    return rounded(table, "mean_p", "least_p", "greatest_p")


def network_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One full-batch gradient step of that network at every institution, averaged by examples."""
    gradient, dims = network.gradient, SMALL_NET

    def step(key, rows, params, options):
        x, y, w = np.stack(rows["features"].to_numpy()), rows["label"].to_numpy(), rows["weight"].to_numpy()
        loss, p, slope = gradient(params, dims, x, y, w)
        new = params - options["learning_rate"] * slope
        return pd.DataFrame([[key[0], int(key[1]), len(y), new.tolist(), float(loss), float((p.argmax(axis=1) == y).mean())]], columns=[
            "institution", "shard", "num_examples", "params", "train_loss", "train_accuracy"])

    # The mean slope of an institution is the mean of its shards' by examples, so shards bound what a task holds.
    rows = in_shards(written(client_rows(spark, sf_dir).drop("shard"), "clients"), RoundSettings().rows_per_shard)
    updates = local_updates(rows, fixed_params(), dims, RoundSettings(), 1, {"learning_rate": 0.5}, step)
    return _positions(average_params(merge_shards(updates), []))


ROUNDS = RoundSettings(min_clients=3, min_fit_clients=3, min_evaluate_clients=3)


def fed_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_federated(written(training_rows(spark, sf_dir), "ml"), ROUNDS).history()


def central_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_central(written(training_rows(spark, sf_dir), "ml"))[1]


def central_logistic_lbfgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_central(written(training_rows(spark, sf_dir), "ml"), "logistic", weighted=True)[1]


def compare_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The federated network and the central one, measured on the same held-out rows."""
    rows = written(training_rows(spark, sf_dir), "ml")
    result = train_federated(rows, ROUNDS)
    federated = held_out_metrics(client_table(rows, ROUNDS)[0], result.params, result.dims, "federated")
    return compare(federated, train_central(rows, by=("institution",))[1])


# Exact training: full-batch descent, so that plain SQL can take the same steps.
EXACT = RoundSettings(rounds=2, local_epochs=2, learning_rate=0.5, hidden=(3,), weighted_loss=False, min_clients=3, min_fit_clients=3,
                      min_evaluate_clients=3, mode="synchronous", adam=False, rows_per_shard=1_000)
LOGISTIC = (len(FEATURE_COLUMNS), 2)


def ruled_params(dims: tuple[int, ...]) -> np.ndarray:
    return (np.arange(network.parameter_count(dims)) * 37 % 23 - 11) / 20.0


def exact_run(spark: SparkSession, sf_dir: str, settings: RoundSettings = EXACT) -> FederatedResult:
    rows = written(training_rows(spark, sf_dir), "ml")
    return train_federated(rows, settings, initial=ruled_params(settings.dims(len(FEATURE_COLUMNS))))


def fed_mlp_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of two full-batch steps of a small network over many shards: every institution's parameters."""
    result = exact_run(spark, sf_dir)
    local = kept_rounds(spark, result.run_dir, "local", LOCAL)
    placed = local.select(F.col("round").cast("bigint").alias("round"), "institution", "num_examples", F.posexplode("params").alias("pos", "value"))
    return placed.withColumns({"pos": F.col("pos").cast("bigint"), "value": F.round("value", 6)})


def training_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What local training says of every epoch, on its own rows and on the held-out ones."""
    epochs = exact_run(spark, sf_dir).epochs()
    whole = epochs.withColumns({c: F.col(c).cast("bigint") for c in ("round", "epoch", "num_examples", "val_examples")})
    return rounded(whole, "train_loss", "train_accuracy", "val_loss", "val_accuracy")


def last_epoch_of_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last epoch of each institution's local training, which stands for its round."""
    epochs = exact_run(spark, sf_dir).epochs()
    figures = ("train_loss", "train_accuracy", "val_loss", "val_accuracy")
    last = M.last_epoch(epochs, ["round", "institution"], figures)
    return rounded(last.withColumn("round", F.col("round").cast("bigint")), *figures)


def _measured(metrics: DataFrame) -> DataFrame:
    return rounded(metrics.select("num_examples", *MEASURES), *MEASURES)


def central_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-weighted logistic regression of all institutions by four full-batch steps, on the rows held out."""
    settings = RoundSettings(rows_per_shard=1_000)
    table, shards = client_table(written(training_rows(spark, sf_dir), "ml"), settings)
    rows = written(table, "clients")
    params = train_central_steps(rows, shards, ruled_params(LOGISTIC), LOGISTIC, StepSettings(4, 1, 0.5, adam=False))
    return _measured(held_out_metrics(rows, params, LOGISTIC, "central", 9))


def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Federated against central logistic regression: the same steps, the same held-out rows, pooled figures."""
    settings = replace(EXACT, hidden=())
    rows = written(training_rows(spark, sf_dir), "ml")
    _, table = compare_on_same_rows(rows, settings, ruled_params(LOGISTIC), digits=9)
    return rounded(table, "federated", "centralised")


def hooked_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds under hooks: options by round, another trainer, and own aggregates of the fit and evaluation metrics."""
    gradient, dims = network.gradient, SMALL_NET

    def step(key, rows, params, options):
        x, y, w = np.stack(rows["features"].to_numpy()), rows["label"].to_numpy(), rows["weight"].to_numpy()
        loss, p, slope = gradient(params, dims, x, y, w)
        new = params - options["learning_rate"] * slope
        return pd.DataFrame([[key[0], int(key[1]), len(y), new.tolist(), float(loss), float((p.argmax(axis=1) == y).mean())]], columns=[
            "institution", "shard", "num_examples", "params", "train_loss", "train_accuracy"])

    settings = replace(EXACT, mode="averaged", rows_per_shard=250_000)
    rows = written(training_rows(spark, sf_dir), "ml")
    result = train_federated(rows, settings, config_fn=lambda number: {"learning_rate": 1.0 / number}, local_fit=step, initial=fixed_params())
    history = result.history(
        lambda fit: fit.groupBy("round").agg(F.max("train_loss").alias("train_loss"), F.min("train_accuracy").alias("train_accuracy"), F.min("val_loss").alias("val_loss")),
        lambda ev: ev.groupBy("round").agg(F.min("accuracy").alias("accuracy"), F.max("f1").alias("f1")))
    table = history.select(F.col("round").cast("bigint").alias("round"), "train_loss", "train_accuracy", "val_loss", "val_accuracy", "val_f1")
    return rounded(table, "train_loss", "train_accuracy", "val_loss", "val_accuracy", "val_f1")


QUERIES = {f.__name__: f for f in (
    csv_jsonl_roundtrip, ml_table_roundtrip, ml_input_dimension, glucose_aliases, glucose_median, clean_median_clip, time_features,
    regular_times, category_stream, category_batch, hypo_labels, constant_fill, synth_vitals, processed_table,
    rolling_by_series, rolling_short_series, rolling_long_series, rolling_whole_table, stats_global,
    stats_by_institution, record_count_by_institution, class_counts, class_weight_table, class_weighted_rows,
    rejected_rows, shuffled_rows, institution_split, train_val_split, scaled_population, scaled_sample, scaled_stages,
    scaled_on_train, union_of_institutions, confusion_by_institution, roc_auc_by_institution, roc_auc_in_ranges,
    cross_entropy_by_institution, evaluation_by_institution, weighted_client_metrics, round_history,
    round_history_long, round_history_wide, best_round, last_epoch_metrics,
    history_export, pooled_against_clients, client_sample, first_reading, fedavg_weighted, fedavg_unweighted,
    fedavg_embeddings, fed_logreg_rounds, stream_enrich, stream_fan_out, stream_memory, stream_stats, stream_series_stats, stream_restart, stream_restart_stats, stream_to_ml,
    network_scores, network_step, fed_mlp, central_mlp, central_logistic, central_logistic_lbfgs, compare_models, compare_networks,
    fed_mlp_exact, training_epochs, last_epoch_of_training, hooked_rounds,
)}
