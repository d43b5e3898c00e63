"""Seeded exact splits that label rows in place instead of sorting them.

The shuffled order is the order of md5(seed:id), so it is the same for every partitioning.
A split at rank k needs only the k-th smallest key: counts per 4-digit key prefix find the
prefix holding it, the rows of that prefix (1/65536 of the table) are ranked, and every
row is then labelled by comparing its key with the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsefold.functions.columns import institution_name, shuffle_key
from pulsefold.operators.chunks import dense_index
from pulsefold.operators.joins import attach
from pulsefold.session import written

SEED = 42
PREFIX_DIGITS = 4


def shuffled_position(df: DataFrame, row_id: str = "event_id", seed: int = SEED, out: str = "position",
                      num_chunks: int | None = None) -> DataFrame:
    """0-based place of every row in the seeded shuffle of the whole table."""
    keyed = df.withColumn("_key", shuffle_key(F.col(row_id), seed))
    return dense_index(keyed, ["_key", row_id], out, num_chunks).drop("_key")


def cut_keys(df: DataFrame, row_id: str, seed: int, ranks_of, by: list[str]) -> DataFrame:
    """Rows (`by`..., _rank, _cut, _cut_id): the key and id at each rank of each group.

    `ranks_of(n)` turns the group's row count into an array of 1-based ranks.
    """
    key = shuffle_key(F.col(row_id), seed)
    keyed = df.select(*by, F.col(row_id).alias("_cut_id"), key.alias("_cut")).withColumn(
        "_prefix", F.substring("_cut", 1, PREFIX_DIGITS)
    )
    counts = written(keyed.groupBy(*by, "_prefix").agg(F.count("*").alias("_n")), "prefix-counts")
    # At most 16^PREFIX_DIGITS rows per group from here on.
    group = Window.partitionBy(*by)
    upto = group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    places = (
        counts.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(group)})
        .withColumn("_skip", F.col("_upto") - F.col("_n"))
        .withColumn("_ranks", F.filter(
            ranks_of(F.col("_all")), lambda r: (r > F.col("_skip")) & (r <= F.col("_upto"))
        ))
        .where(F.size("_ranks") > 0)
        .select(*by, "_prefix", "_skip", "_ranks")
    )
    ordered = Window.partitionBy(*by, "_prefix").orderBy("_cut", "_cut_id")
    return (
        attach(keyed, places, [*by, "_prefix"], "inner")
        .withColumn("_rank", F.col("_skip") + F.row_number().over(ordered))
        .where(F.array_contains("_ranks", F.col("_rank")))
        .select(*by, "_rank", "_cut", "_cut_id")
    )


def split_institutions(df: DataFrame, n: int = 3, row_id: str = "event_id", seed: int = SEED) -> DataFrame:
    """Shuffle, then give n equal runs of rows to institution_1..n, the remainder to the last.

    `row_id` must be unique. Fewer rows than institutions all go to the last one.
    """
    if n < 1:
        raise ValueError("n must be at least 1")

    if n == 1:
        return df.withColumn("institution", institution_name(F.lit(1)))

    def run_ends(total: Column) -> Column:
        return F.transform(F.sequence(F.lit(1).cast("bigint"), F.lit(n - 1).cast("bigint")), lambda i: i * F.floor(total / n))

    cuts = written(cut_keys(df, row_id, seed, run_ends, []), "cuts")
    if cuts.count() < n - 1:
        return df.withColumn("institution", institution_name(F.lit(n)))
    ident = F.col(row_id)
    keyed = df.withColumn("_key", shuffle_key(ident, seed)).withColumn("_prefix", F.substring("_key", 1, PREFIX_DIGITS))
    placed = attach(keyed, cuts_by_prefix(cuts), ["_prefix"], "inner")
    passed = F.size(F.filter("_cuts", lambda c: c < F.struct(F.col("_key").alias("_cut"), ident.alias("_cut_id"))))
    number = (F.lit(1) + F.col("_before") + passed).cast("int")
    return placed.withColumn("institution", institution_name(number)).select(*df.columns, "institution")


def cuts_by_prefix(cuts: DataFrame) -> DataFrame:
    """For every key prefix there can be: the cuts within it, and how many lie before it.

    A row finds its part by its prefix and the few cuts there, so neither the plan nor the work of a row grows with the cuts.
    """
    within = cuts.groupBy(F.substring("_cut", 1, PREFIX_DIGITS).alias("_prefix")).agg(
        F.array_sort(F.collect_list(F.struct("_cut", "_cut_id"))).alias("_cuts"))
    every = cuts.sparkSession.range(16**PREFIX_DIGITS).select(F.lpad(F.lower(F.hex("id")), PREFIX_DIGITS, "0").alias("_prefix"))
    # 16^PREFIX_DIGITS rows, whatever the table and the number of cuts.
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    known = every.join(within, "_prefix", "left").withColumn("_cuts", F.coalesce("_cuts", F.slice(F.array(F.struct(
        F.lit("").alias("_cut"), F.lit(None).cast(cuts.schema["_cut_id"].dataType).alias("_cut_id"))), 1, 0)))
    return known.withColumn("_before", F.coalesce(F.sum(F.size("_cuts")).over(before), F.lit(0)))


def split_train_val(df: DataFrame, by: list[str], row_id: str = "event_id", fraction: float = 0.8,
                    seed: int = SEED) -> DataFrame:
    """Add `is_train`: exactly int(fraction * n) rows of every group, chosen by the seeded shuffle."""
    cuts = cut_keys(df, row_id, seed, lambda n: F.array(train_size(n, fraction)), by).drop("_rank")
    key, ident = shuffle_key(F.col(row_id), seed), F.col(row_id)
    at_or_before = (key < F.col("_cut")) | ((key == F.col("_cut")) & (ident <= F.col("_cut_id")))
    keyed, on = (df, by) if by else (df.withColumn("_one", F.lit(1)), ["_one"])
    cuts = cuts if by else cuts.withColumn("_one", F.lit(1))
    return (
        attach(keyed, cuts, on)
        .withColumn("is_train", F.coalesce(at_or_before, F.lit(False)))
        .drop("_cut", "_cut_id", "_one")
    )


def train_size(n: Column, fraction: float) -> Column:
    return F.floor(F.lit(float(fraction)) * n.cast("double")).cast("bigint")


def sample_clients(institutions: DataFrame, round_number: int, fraction: float = 1.0, minimum: int = 2,
                   min_available: int = 2, seed: int = SEED) -> DataFrame:
    """The clients of one round: max(int(fraction * K), minimum) of the K rows, in seeded random order."""
    available, needed = institutions.count(), max(min_available, minimum)
    if available < needed:
        raise ValueError(f"{available} institutions, but {needed} are required")
    size = max(int(fraction * available), minimum)
    if size >= available:
        return institutions
    return institutions.orderBy(shuffle_key(F.col("institution"), f"{seed}:{round_number}"), "institution").limit(size)
