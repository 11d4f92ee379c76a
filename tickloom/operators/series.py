"""Per-entity time series: changes, alerts, gap filling, recent rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.numbers import alert_class, pct_change
from tickloom.operators.ranges import previous_value
from tickloom.operators.skew import position
from tickloom.session import stored


def price_changes(
    ticks: DataFrame, order: Sequence[str] = ("ts", "id"), chunks: int | None = None
) -> DataFrame:
    """Previous price of the same entity and the change in percent."""
    df = previous_value(ticks, "price", "prev_price", 1, order=order, chunks=chunks)
    return df.withColumn("pct_change", pct_change("price", "prev_price", zero=None))


def alerts(
    ticks: DataFrame,
    threshold: float = 5.0,
    order: Sequence[str] = ("ts", "id"),
    chunks: int | None = None,
) -> DataFrame:
    """Changes of strictly more than ``threshold`` percent."""
    df = price_changes(ticks, order, chunks).withColumn(
        "alert", alert_class("pct_change", threshold)
    )
    return df.where(F.col("alert").isNotNull())


def two_back_changes(
    ticks: DataFrame, order: Sequence[str] = ("ts", "id"), chunks: int | None = None
) -> DataFrame:
    """Change against the price two ticks earlier, the baseline for the first two."""
    df = previous_value(ticks, "price", "prev_price", 2, order=order, chunks=chunks)
    df = df.withColumn("prev_price", F.coalesce("prev_price", "baseline"))
    return df.withColumn("pct_change", pct_change("price", "prev_price"))


def trend_filled(tr: DataFrame, dim: DataFrame, chunks: int | None = None) -> DataFrame:
    """Every entity of ``dim`` in every period, with the last known price.

    Before its first period an entity has its baseline. Each known price covers
    the run of periods up to the next known one, so it is spread over that run
    directly: no product of entities and periods and no window over the grid.
    A run's end is found over ranges of (entity, period), so that an entity with
    very many periods fills several tasks (``chunks`` of them in all, if given).
    """
    dim = stored(dim.select("entity", "baseline"), "baselines")
    tr = tr.where(F.col("period").isNotNull())
    tr = stored(tr.join(dim.select("entity"), "entity", "left_semi"), "trend")
    periods = tr.select("period").distinct().withColumn("_day", F.to_date("period"))
    # Number the periods within each day and shift by the periods of earlier days;
    # the running sum sees one row per day.
    earlier_days = W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    shift = (
        periods.groupBy("_day")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_day", F.coalesce(F.sum("_n").over(earlier_days), F.lit(0)).alias("_shift"))
    )
    within_day = F.row_number().over(W.partitionBy("_day").orderBy("period"))
    numbered = periods.join(shift, "_day").select(
        "period", (within_day - 1 + F.col("_shift")).cast("int").alias("_i")
    )
    n_periods = periods.agg(F.count(F.lit(1)).cast("int")).scalar()
    known = tr.join(numbered, "period").select("entity", "_i", F.col("price_avg").alias("_price"))
    seed = dim.select("entity", F.lit(0).alias("_i"), F.col("baseline").alias("_price"))
    points = seed.withColumn("_known", F.lit(0)).unionByName(known.withColumn("_known", F.lit(1)))
    # In falling order the next known period is the one of the row before.
    falling = points.withColumn("_down", -(F.col("_i").cast("long") * 2 + F.col("_known")))
    runs = previous_value(falling, "_i", "_end", order=("_down",), chunks=chunks)
    runs = runs.withColumn("_end", F.coalesce("_end", n_periods))
    spread = runs.where(F.col("_end") > F.col("_i")).select(
        "entity",
        F.col("_price").alias("price_avg"),
        F.explode(F.sequence("_i", F.col("_end") - 1)).alias("_i"),
    )
    return spread.join(numbered, "_i").select("entity", "period", "price_avg")


def recent(df: DataFrame, n: int, order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """The newest ``n`` rows, newest first; each task keeps only its own top n."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def recent_per_entity(df: DataFrame, n: int, order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """The newest ``n`` rows of each entity, cut to n per task before the shuffle."""
    newest_first = W.partitionBy("entity").orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(newest_first)).where(f"_rn <= {n}").drop("_rn")


def ml_features(
    ticks: DataFrame, order: Sequence[str] = ("ts", "id"), chunks: int | None = None
) -> DataFrame:
    """Row index, hour and price per entity; an unreadable time counts as hour 0."""
    df = position(ticks, by="entity", order=order, chunks=chunks)
    return df.withColumn("hour", F.coalesce(F.hour(order[0]), F.lit(0)))


def split_by_time(features: DataFrame, share: float = 0.8, min_rows: int = 5) -> DataFrame:
    """Mark the first part of each series as training rows; drop short series."""
    n_train = F.greatest(F.floor(F.col("n_total") * share), F.lit(3))
    return (
        features.where(F.col("n_total") >= min_rows)
        .withColumn("n_train", n_train.cast("long"))
        .withColumn("is_train", F.col("time_idx") < F.col("n_train"))
    )
