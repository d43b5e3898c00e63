"""Exact median of a column of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulsefold.functions.columns import known

FINISH_VALUES = 1_000_000
MARGIN = 0.001


def exact_median(df: DataFrame, column: str, finish_values: int = FINISH_VALUES) -> float | None:
    """Median of the known values, the mean of the middle two when their number is even.

    Never sorts the whole column. A bounded quantile sketch proposes two values round the
    middle, exact counts tell where the middle ranks lie relative to them, and the search
    goes on strictly between the two until at most `finish_values` distinct values remain.
    Those are counted per value and walked in order, so copies of a value cost nothing.
    """
    x = F.col("x")
    values = df.select(known(F.col(column)).alias("x")).where(x.isNotNull())
    rows, distinct = values.agg(F.count("*"), F.approx_count_distinct("x")).first()
    if rows == 0:
        return None
    wanted = {(rows - 1) // 2, rows // 2}
    found: dict[int, float] = {}
    inside, below, margin = values, 0, MARGIN
    while wanted and distinct > finish_values:
        reach = [max(0.0, (min(wanted) - below) / rows - margin), min(1.0, (max(wanted) - below) / rows + margin)]
        low, high = inside.agg(F.percentile_approx("x", reach, 10_000)).first()[0]
        between = (x > low) & (x < high)
        under, at_low, held, at_high, kinds = inside.agg(
            F.count_if(x < low), F.count_if(x == low), F.count_if(between), F.count_if(x == high),
            F.approx_count_distinct(F.when(between, x)),
        ).first()
        first_low = below + under
        first_held = first_low + at_low
        first_high = first_held + held
        end = first_high + (at_high if high > low else 0)
        if min(wanted) < first_low or max(wanted) >= end:
            margin *= 10
            continue
        found.update({r: low for r in wanted if r < first_held})
        found.update({r: high for r in wanted if r >= first_high})
        wanted -= found.keys()
        inside, below, rows, distinct, margin = values.where(between), first_held, held, kinds, MARGIN
    if wanted:
        upto = F.sum("count").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
        steps = inside.groupBy("x").count().withColumn("upto", upto + F.lit(below))
        ranks = sorted(wanted)
        picks = steps.agg(*[F.min(F.when(F.col("upto") > r, x)) for r in ranks]).first()
        found.update(zip(ranks, picks))
    return (min(found.values()) + max(found.values())) / 2
