"""Model quality and per-round bookkeeping as plain aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsefold.functions.columns import safe_ratio
from pulsefold.operators.chunks import range_chunks

PROBABILITY_FLOOR = 1e-15

# Fixed names of the round history.
FIT_METRICS = ("train_loss", "train_accuracy", "val_loss", "val_accuracy", "val_f1", "val_auc")
EVAL_FALLBACKS = {"val_accuracy": "accuracy", "val_f1": "f1", "val_auc": "auc"}


def log_loss_of(label: Column, p: Column) -> Column:
    """-ln of the probability given to the true class, floored away from ln 0."""
    return -F.ln(F.greatest(F.when(label == 1, p).otherwise(1.0 - p), F.lit(PROBABILITY_FLOOR)))


def with_ratios(counts: DataFrame) -> DataFrame:
    """Add num_examples, accuracy, precision, recall and f1 to tp, fp, fn and tn."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "num_examples": tp + fp + fn + tn,
        "accuracy": safe_ratio(tp + tn, tp + fp + fn + tn),
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
    })


def confusion_metrics(scored: DataFrame, by: list[str], label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Counts, accuracy, precision, recall and F1 of class 1 per group; a zero denominator gives 0."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return with_ratios(scored.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    ))


def cross_entropy(scored: DataFrame, by: list[str], label: str = "label", p: str = "p") -> DataFrame:
    """Mean over rows, so the figure does not depend on any batching."""
    return scored.groupBy(*by).agg(F.avg(log_loss_of(F.col(label), F.col(p))).alias("loss"))


def score_counts(scored: DataFrame, by: list[str], label: str = "label", p: str = "p",
                 num_chunks: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score, written once in ranges (`chunk`) along (`by`, score)."""
    y = F.col(label) == 1
    counts = scored.groupBy(*by, F.col(p).alias("p")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    return range_chunks(counts, [*by, "p"], num_chunks).drop("_place")


def area_under_roc(counts: DataFrame, by: list[str]) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, from `score_counts`.

    Within a range of scores a running sum tells how many negatives a positive beats; of the ranges before it
    only their number of negatives is needed. No task holds more than one range of one group.
    """
    lower = Window.partitionBy(*by, "chunk").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.coalesce(F.sum("neg").over(lower), F.lit(0)) + F.col("neg") / 2
    parts = counts.withColumn("won", F.col("pos") * beaten).groupBy(*by, "chunk").agg(
        F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    earlier = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.col("pos") * F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return parts.withColumn("won", F.col("won") + carried).groupBy(*by).agg(
        safe_ratio(F.sum("won"), pairs).alias("auc")
    )


def roc_auc(scored: DataFrame, by: list[str], label: str = "label", p: str = "p",
            num_chunks: int | None = None) -> DataFrame:
    """Exact area under the ROC curve per group, ties counted half; one class only gives 0."""
    return area_under_roc(score_counts(scored, by, label, p, num_chunks), by)


def evaluation(scored: DataFrame, by: list[str], num_chunks: int | None = None) -> DataFrame:
    """num_examples, loss, accuracy, precision, recall, f1 and auc per group, in one pass over the rows.

    Expects `label` and the probability `p` of class 1; above 0.5 counts as class 1. Every
    figure follows from the counts per distinct score. `by` must not be empty.
    """
    counts = score_counts(scored, by, num_chunks=num_chunks)
    # With p given, a positive costs -ln p and a negative -ln (1 - p).
    cost = F.col("pos") * log_loss_of(F.lit(1), F.col("p")) + F.col("neg") * log_loss_of(F.lit(0), F.col("p"))
    over = F.col("p") > 0.5
    totals = counts.groupBy(*by).agg(
        F.sum(F.when(over, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(over, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(over, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(over, 0).otherwise(F.col("neg"))).alias("tn"),
        (F.sum(cost) / F.sum(F.col("pos") + F.col("neg"))).alias("loss"),
    )
    auc = area_under_roc(counts, by)
    return with_ratios(totals).join(auc, by).select(
        *by, "num_examples", "loss", "accuracy", "precision", "recall", "f1", "auc"
    )


def weighted_metrics(results: DataFrame, metrics: tuple[str, ...], by: str = "round", client: str = "institution",
                     examples: str = "num_examples") -> DataFrame:
    """Example-weighted mean of each metric over the clients of a round.

    The first client (by name) decides which metrics a round has. A client without a metric
    adds nothing to the numerator but its examples stay in the denominator.
    """
    n = F.col(examples)
    means = [
        F.when(F.min_by(F.col(m).isNotNull(), client), F.coalesce(F.sum(n * F.col(m)), F.lit(0.0)) / F.sum(n)).alias(m)
        for m in metrics
    ]
    return results.groupBy(by).agg(F.sum(n).alias(examples), *means)


def last_epoch(epochs: DataFrame, by: list[str], metrics: tuple[str, ...], epoch: str = "epoch") -> DataFrame:
    return epochs.groupBy(*by).agg(*[F.max_by(m, epoch).alias(m) for m in metrics])


def round_history(fit: DataFrame, evaluated: DataFrame) -> DataFrame:
    """One row per round: fit metrics, gaps filled from the evaluation of the global model."""
    f, e = fit.alias("f"), evaluated.alias("e")
    joined = f.join(e, F.col("f.round") == F.col("e.round"), "full_outer")
    columns = []
    for name in FIT_METRICS:
        value = F.col(f"f.{name}") if name in fit.columns else F.lit(None).cast("double")
        other = EVAL_FALLBACKS.get(name)
        if other in evaluated.columns:
            value = F.coalesce(value, F.col(f"e.{other}"))
        columns.append(value.cast("double").alias(name))
    return joined.select(F.coalesce("f.round", "e.round").alias("round"), *columns)


def long_history(history: DataFrame) -> DataFrame:
    """(round, metric, value), without the gaps."""
    names = [c for c in history.columns if c != "round"]
    return history.unpivot("round", names, "metric", "value").where(F.col("value").isNotNull())


def wide_history(long: DataFrame, metrics: tuple[str, ...] = FIT_METRICS) -> DataFrame:
    return long.groupBy("round").pivot("metric", list(metrics)).agg(F.first("value"))


def history_arrays(history: DataFrame) -> DataFrame:
    """One row of parallel arrays in round order; a history has one row per round, so it is short."""
    names = [c for c in history.columns if c != "round"]
    return (
        history.agg(F.array_sort(F.collect_list(F.struct("round", *names))).alias("h"))
        .select(F.col("h.round").alias("rounds"), *[
            F.filter(F.col(f"h.{n}"), lambda v: v.isNotNull()).alias(n) for n in names
        ])
    )


def summary(history: DataFrame) -> DataFrame:
    """Number of rounds, the last validation figures, and the first round with the best accuracy."""
    ranked = F.when(F.col("val_accuracy").isNotNull(), F.struct("val_accuracy", -F.col("round")))
    last = [F.max_by(m, "round").alias(f"final_{m}") for m in ("val_accuracy", "val_f1", "val_auc")]
    return history.agg(
        F.count_distinct("round").alias("total_rounds"), *last,
        (-F.max(ranked)[F.lit("col2")]).alias("best_round"),
        F.max("val_accuracy").alias("best_val_accuracy"),
    )
