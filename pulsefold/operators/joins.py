"""Joining a per-key table onto many rows without trusting the keys to be spread evenly."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsefold.session import written_and_counted

BROADCAST_CELLS = 2_000_000
SALTS = 64


def attach(rows: DataFrame, per_key: DataFrame, on: list[str], how: str = "left",
           max_cells: int = BROADCAST_CELLS, salts: int = SALTS) -> DataFrame:
    """Join `per_key` (one row per key) onto `rows`.

    `per_key` is written once and counted. Within `max_cells` (rows times columns) it is
    broadcast, so `rows` is not shuffled. Beyond that both sides are shuffled on (key, salt): the salt comes from
    a hash of the whole row, so a key holding a third of the rows is spread over `salts`
    tasks.
    """
    per_key, keys = written_and_counted(per_key, "per-key")
    if keys * len(per_key.columns) <= max_cells:
        return rows.join(F.broadcast(per_key), on, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
