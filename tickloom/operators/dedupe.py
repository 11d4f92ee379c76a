"""One row per key, and counts of what cleaning removes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the row that comes first by ``order`` for every key (nulls are equal).

    Copies are merged before the shuffle, so a key with very many copies costs
    one row per input task. The remaining columns break ties, which makes the
    survivor the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    if len(rest) == 1 and list(order) in ([], rest):
        # One column is left: a plain minimum, which needs no sort.
        return df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0])).select(*df.columns)
    ranked = [F.col(o) if isinstance(o, str) else o for o in order]
    first = F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(ranked)], F.struct(*rest).alias("_row")
    )
    kept = df.groupBy(*keys).agg(F.min(first).alias("_first"))
    return kept.select(*keys, "_first._row.*").select(*df.columns)


def quality_audit(
    df: DataFrame, keys: Sequence[str], price: str = "price", ident: str | None = None
) -> DataFrame:
    """Rows read, rows dropped per rule and rows kept, in one pass.

    ``price`` must be one of ``keys``: rows are first counted per key, so all
    rules can be read off the small per-key counts.
    """
    if price not in keys:
        raise ValueError("price must be one of the keys")
    value = F.col(price).try_cast("double")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    valid = value > 0
    total = F.sum("_n")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0)).cast("long")

    kept = F.count_if(valid)
    return per_key.agg(
        F.coalesce(total, F.lit(0)).cast("long").alias("rows_read"),
        rows(value.isNull()).alias("null_price"),
        rows(value <= 0).alias("non_positive"),
        (rows(valid) - kept).alias("duplicates"),
        kept.alias("rows_kept"),
    )


def observe_quality(df: DataFrame, name: str | Observation, price: str = "price") -> DataFrame:
    """Pass rows through and report their counts per rule as observed metrics.

    Costs no job of its own and also works on streams, where each batch reports.
    """
    value = F.col(price).try_cast("double")
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(value.isNull()).alias("null_price"),
        F.count_if(value <= 0).alias("non_positive"),
    )
