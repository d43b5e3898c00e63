"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (the smallest node reachable) for every node of `edges` (a, b: comparable, not null).

    Each round hangs the larger neighbours of a node below its smallest one, then links the
    smaller ones to it. Chains shrink by half or better, so rounds grow with the logarithm of
    the longest path. Every round is a stored table; nothing is gathered on the driver but two sums.
    """
    own = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    own, before = stored(own, "edges"), None
    while True:
        size, low = _state(own)
        if size == 0 or (size, low) == before:
            break
        before = (size, low)
        both = own.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionByName(
            own.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        least = both.groupBy("n").agg(F.least("n", F.min("m")).alias("low"))
        large = both.where("m > n").join(least, "n").select(F.col("m").alias("hi"), F.col("low").alias("lo")).distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("low"))
        small = large.join(smallest, "hi").select(
            F.explode(F.array(F.struct("hi", F.col("low").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("low").alias("lo")))).alias("e"))
        own = stored(small.select("e.hi", "e.lo").where("hi <> lo").distinct(), "edges")
    children = own.groupBy("hi").agg(F.min("lo").alias("root")).withColumnRenamed("hi", "node")
    roots = own.select(F.col("lo").alias("node")).distinct().withColumn("root", F.col("node"))
    # A root is never a larger end once the stars are flat.
    return children.unionByName(roots.join(children.select("node"), "node", "left_anti"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.col("lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)
