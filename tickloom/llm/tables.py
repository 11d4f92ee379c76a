"""Helpers that the operators share: tables, words, positions, bounded ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import scratch_dir

# A word is a run of anything but these characters.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
# Copies of one row that one task makes at once.
COPIES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Later stages start from these files, also if an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def each_copy(rows: DataFrame, copies: str, nth: str) -> DataFrame:
    """A row for each of its copies, numbered from 0.

    A row with very many copies is first cut into parts that are dealt over tasks.
    """
    zero, number = F.lit(0).cast("long"), F.col(copies)
    few = rows.where(number <= COPIES).withColumn(nth, F.explode(F.sequence(zero, number - 1)))
    part = F.explode(F.sequence(zero, F.floor((number - 1) / COPIES)))
    many = rows.where(number > COPIES).withColumn("_part", part)
    start = F.col("_part") * COPIES
    end = F.least(start + COPIES, number) - 1
    many = many.repartition("_part").withColumn(nth, F.explode(F.sequence(start, end)))
    return few.unionByName(many.drop("_part"))


def word_count(text: Column | str) -> Column:
    """Words of a text as long; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    counted = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))
    return counted.cast("long")


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    amount: Column,
    name: str,
    chunk: Column,
) -> DataFrame:
    """Total of ``amount`` over the rows before each one, per group.

    ``chunk`` cuts a group into bounded pieces along the order. A window runs
    within each piece only, and a second one over one row per piece, so no task
    sorts a whole hot group.
    """
    rows = df.withColumn("_chunk", chunk).withColumn("_amount", amount.cast("long"))
    keys = [*group, "_chunk"]
    sums = rows.groupBy(*keys).agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = rows.withColumn("_local", F.coalesce(F.sum("_amount").over(within), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = local.join(starts, same, "left")
    total = (F.col("_start") + F.col("_local")).alias(name)
    return joined.select(*[c for c in df.columns if c != name], total)
