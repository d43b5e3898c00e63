import hashlib

import pytest
from pyspark.sql import functions as F

from pulsefold.operators.splits import sample_clients, shuffled_position, split_institutions, split_train_val


def ranked(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def rows(spark, n, parts=4):
    return spark.range(n).withColumnRenamed("id", "event_id").repartition(parts)


@pytest.mark.parametrize("n,k", [(10, 3), (9, 3), (2, 3), (0, 3), (1, 1), (100, 7), (5000, 2)])
def test_institution_sizes_and_members(spark, n, k):
    got = {r["event_id"]: r["institution"] for r in split_institutions(rows(spark, n), k).collect()}
    size = n // k
    want = {i: f"institution_{min(p // size, k - 1) + 1 if size else k}" for p, i in enumerate(ranked(range(n)))}
    assert got == want


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_split_ignores_partitioning(spark, parts):
    split = split_institutions(rows(spark, 500, parts), 3)
    total = split.agg(F.sum(F.hash("event_id", "institution").cast("long"))).first()[0]
    reference = split_institutions(rows(spark, 500, 2), 3)
    assert total == reference.agg(F.sum(F.hash("event_id", "institution").cast("long"))).first()[0]


def test_train_val_is_exact_per_group(spark):
    df = rows(spark, 400).withColumn("g", F.when(F.col("event_id") < 300, "big").when(F.col("event_id") == 399, "one").otherwise("small"))
    got = split_train_val(df, ["g"]).groupBy("g").agg(F.count("*"), F.sum(F.col("is_train").cast("int"))).collect()
    assert sorted(map(tuple, got)) == [("big", 300, 240), ("one", 1, 0), ("small", 99, 79)]
    train = {r[0] for r in split_train_val(rows(spark, 50), []).where("is_train").select("event_id").collect()}
    assert train == set(ranked(range(50))[:40])


def test_shuffled_position(spark):
    got = [r["event_id"] for r in shuffled_position(rows(spark, 200)).orderBy("position").collect()]
    assert got == ranked(range(200))


def test_client_sampling(spark):
    names = spark.range(1, 11).select(F.format_string("institution_%d", "id").alias("institution"))

    def taken(*args):
        return sorted(r[0] for r in sample_clients(names.repartition(3), *args).collect())

    assert len(taken(1)) == 10
    assert len(taken(3, 0.5)) == 5 and taken(3, 0.5) == taken(3, 0.5) != taken(4, 0.5)
    assert len(taken(3, 0.01)) == 2
    with pytest.raises(ValueError, match="required"):
        sample_clients(names.limit(1), 1)


def test_a_thousand_parts(spark):
    df = spark.range(25_500).withColumnRenamed("id", "event_id").withColumn("x", F.col("event_id") * 2)
    parts = split_institutions(df, 1000)
    sizes = {r["institution"]: r["count"] for r in parts.groupBy("institution").count().collect()}
    assert len(sizes) == 1000 and sizes["institution_1000"] == 525 and {n for k, n in sizes.items() if k != "institution_1000"} == {25}
    order = ranked(range(25_500))
    want = {i: min(k // 25, 999) + 1 for k, i in enumerate(order)}
    assert {r["event_id"]: r["institution"] for r in parts.collect()} == {i: f"institution_{k}" for i, k in want.items()}
    plan = lambda n: len(split_institutions(df, n)._jdf.queryExecution().optimizedPlan().toString())
    assert plan(1000) < 1.2 * plan(5)
