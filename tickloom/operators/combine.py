"""Merging sources and comparing snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.dedupe import dedupe
from tickloom.operators.latest import extreme


def merge_priority(
    live: DataFrame,
    history: DataFrame,
    keys: Sequence[str] = ("entity", "ts"),
    arrival: str = "arrival",
) -> DataFrame:
    """Union in which live rows win over history rows of the same key.

    Among live rows of a key the last arrival wins, among history rows the
    first. ``arrival`` is a number. Rows of one key and arrival are told apart by a
    hash of the other columns, so the survivor is the same on every run.
    """
    both = live.withColumn("_rank", F.lit(False)).unionByName(
        history.withColumn("_rank", F.lit(True))
    )
    turn = F.when(~F.col("_rank"), -F.col(arrival)).otherwise(F.col(arrival))
    rest = [c for c in both.columns if c not in keys]
    tie = F.pmod(F.xxhash64(*rest), F.lit(1 << 31)).cast("int")
    found = extreme(both, list(keys), ["_rank", turn, tie], last=False)
    if found is not None:
        return found.drop("_rank")
    return dedupe(both, list(keys), ["_rank", turn]).drop("_rank")


def compare_versions(
    before: DataFrame, after: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Added, removed and changed rows between two versions of a table.

    Rows that both versions have equally often cancel out. What is left of a key
    is paired in the order of its values, so keys may repeat; a value without a
    partner is added or removed.
    """
    tagged = before.select(*keys, *cols, F.lit(-1).alias("_v")).unionByName(
        after.select(*keys, *cols, F.lit(1).alias("_v"))
    )
    left = tagged.groupBy(*keys, *cols).agg(F.sum("_v").alias("_d")).where("_d <> 0")
    left = left.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_d"))))
    left = left.withColumn("_v", (F.col("_d") > 0).cast("int"))
    nth = F.row_number().over(Window.partitionBy(*keys, "_v").orderBy(*cols))
    tagged = left.withColumn("_nth", nth)

    def side(v: int, name: str, suffix: str):
        return F.max(F.when(F.col("_v") == v, F.col(name))).alias(f"{name}_{suffix}")

    pairs = tagged.groupBy(*keys, "_nth").agg(
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        *[side(0, c, "before") for c in cols],
        *[side(1, c, "after") for c in cols],
    )
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after"))
    change = (
        F.when(F.col("_lo") == 1, "added")
        .when(F.col("_hi") == 0, "removed")
        .when(~same, "changed")
    )
    return (
        pairs.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .drop("_lo", "_hi", "_nth")
    )
