"""Grouped statistics; all of them combine rows before the shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.numbers import sign_class, trend_band
from tickloom.functions.text import holds, needles
from tickloom.functions.times import truncate_time
from tickloom.operators.latest import extreme
from tickloom.operators.match import match_entities
from tickloom.session import stored


def volatility(ticks: DataFrame) -> DataFrame:
    """Price range per entity and its width in percent of the minimum."""
    stats = ticks.groupBy("entity").agg(
        F.max("price").alias("price_max"),
        F.min("price").alias("price_min"),
        F.avg("price").alias("price_avg"),
        F.count("price").alias("n"),
    )
    spread = F.try_divide(F.col("price_max") - F.col("price_min"), F.col("price_min")) * 100
    width = F.when(F.col("price_min") <= 0, 0.0).otherwise(spread)
    return stats.withColumn("volatility_pct", width)


def ranked(vol: DataFrame) -> DataFrame:
    """Most volatile first; a sort over range partitions, for reports."""
    return vol.orderBy(F.desc("volatility_pct"), "entity")


def volatility_share(vol: DataFrame) -> DataFrame:
    """Volatility in percent of the highest one, 0 if that is 0."""
    top = vol.agg(F.max("volatility_pct")).scalar()
    share = F.when(top > 0, F.col("volatility_pct") / top * 100).otherwise(0.0)
    return vol.withColumn("share_pct", share)


def trend(ticks: DataFrame, unit: str = "minute") -> DataFrame:
    """Average price per entity and period."""
    period = truncate_time(ticks, unit)
    return ticks.groupBy("entity", period.alias("period")).agg(F.avg("price").alias("price_avg"))


def trend_matrix(
    tr: DataFrame, entities: Sequence[str] | None = None, n: int = 12
) -> DataFrame:
    """The last ``n`` periods as rows, one price column per entity.

    Columns are the entities that occur in these periods, or the given ones.
    """
    tr = stored(tr, "trend")
    newest = tr.select("period").distinct().orderBy(F.desc("period")).limit(n)
    recent = tr.join(newest, "period", "left_semi")
    names = list(entities) if entities is not None else None
    return recent.groupBy("period").pivot("entity", names).agg(F.first("price_avg"))


def trend_blocks(tr: DataFrame, n: int = 12, width: int = 256) -> DataFrame:
    """The last ``n`` periods of any number of entities, in blocks of columns.

    The entities of these periods are numbered in ascending order (no entity comes first)
    and cut into blocks of ``width``. A row is a period of a block: block, period, its
    entities and their prices as two arrays, null where an entity has no price.
    """
    tr = stored(tr, "trend")
    newest = stored(tr.select("period").distinct().orderBy(F.desc("period")).limit(n), "periods")
    recent = tr.join(newest, tr["period"].eqNullSafe(newest["period"]), "left_semi")
    ranges = recent.select("entity").distinct().repartitionByRange("entity")
    names = stored(ranges.withColumn("_range", F.spark_partition_id()), "names")
    # Numbers within a range are shifted by the names of earlier ranges, one row each.
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shift = (
        names.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    )
    within = F.row_number().over(W.partitionBy("_range").orderBy("entity"))
    numbered = names.join(shift, "_range").select(
        F.col("entity").alias("_name"), (within - 1 + F.col("_shift")).alias("_i")
    )
    numbered = numbered.select(
        "_name", F.floor(F.col("_i") / width).alias("block"), (F.col("_i") % width).cast("int").alias("_place")
    )
    cells = recent.join(numbered, F.col("entity").eqNullSafe(F.col("_name"))).groupBy("block", "period")
    entry = F.struct("_place", "price_avg")
    cells = cells.agg(F.map_from_entries(F.collect_list(entry)).alias("_cells"))
    heads = numbered.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("_place", F.col("_name").alias("entity")))).alias("_names")
    )
    periods = newest.agg(F.collect_list(F.struct("period"))).scalar()
    grid = heads.withColumn("_period", F.explode(periods)).select("block", "_names", "_period.period")
    cells = cells.withColumnsRenamed({"block": "_block", "period": "_of"})
    same = (F.col("block") == F.col("_block")) & F.col("period").eqNullSafe(F.col("_of"))
    return grid.join(cells, same, "left").select(
        "block",
        "period",
        F.col("_names.entity").alias("entities"),
        F.transform("_names", lambda x: F.try_element_at("_cells", x["_place"])).alias("prices"),
    )


def average_change(ticks: DataFrame, change: str = "pct_change") -> DataFrame:
    return ticks.groupBy("entity").agg(F.avg(change).alias("avg_change_pct"))


def mention_counts(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_news"))


def news_correlation(
    ticks: DataFrame,
    news: DataFrame | None,
    keywords: Mapping[str, Iterable[str]],
    text: str = "text",
    mode: str = "substring",
    change: str = "pct_change",
) -> DataFrame:
    """Mentions beside the average price change; 0 where one side has none.

    Without a news table there is nothing to correlate and the result is empty.
    """
    if news is None:
        empty = average_change(ticks, change).where(F.lit(False))
        return empty.select("entity", F.lit(0).cast("long").alias("n_news"), "avg_change_pct")
    counts = mention_counts(match_entities(news.select(text), text, keywords, mode))
    both = counts.join(average_change(ticks, change), "entity", "full")
    return both.select(
        "entity",
        F.coalesce("n_news", F.lit(0)).alias("n_news"),
        F.coalesce("avg_change_pct", F.lit(0.0)).alias("avg_change_pct"),
    )


def change_signs(correlation: DataFrame) -> DataFrame:
    return correlation.withColumns(
        {"direction": sign_class("avg_change_pct"), "abs_change_pct": F.abs("avg_change_pct")}
    )


def price_change_by_keyword(
    ticks: DataFrame, keywords: Mapping[str, Iterable[str]], change: str = "pct_change"
) -> DataFrame:
    """Average change over the ticks whose own name contains a keyword, else 0.

    Ticks are summed per name first; the names are matched after that. Every
    entity of ``keywords`` is in the result.
    """
    sums = ticks.groupBy("entity").agg(F.sum(change).alias("_sum"), F.count(change).alias("_n"))
    names = sums.withColumn("_name", F.lower("entity"))
    tests = {e: holds("_name", needles(ks, "substring")) for e, ks in keywords.items()}
    # One global row that holds, for every entity, the sum and count of its names.
    cells = names.agg(
        F.array(
            *[
                F.struct(
                    F.lit(e).alias("entity"),
                    F.sum(F.when(test, F.col("_sum"))).alias("total"),
                    F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0)).alias("n"),
                )
                for e, test in tests.items()
            ]
        ).alias("_cells")
    ).select(F.inline("_cells"))
    mean = F.coalesce(F.try_divide(F.col("total"), F.col("n")), F.lit(0.0))
    return cells.select("entity", F.col("n").alias("n_changes"), mean.alias("avg_change_pct"))


def keyword_correlation(
    ticks: DataFrame,
    news: DataFrame | None,
    keywords: Mapping[str, Iterable[str]],
    text: str = "text",
    mode: str = "substring",
    change: str = "pct_change",
) -> DataFrame:
    """Like ``news_correlation``, for exactly the entities of ``keywords``.

    Both sides are matched by keyword, the articles by text and the ticks by name.
    Without a news table every entity has no mention.
    """
    if news is None:
        changes = price_change_by_keyword(ticks, keywords, change)
        return changes.select("entity", F.lit(0).cast("long").alias("n_news"), "avg_change_pct")
    counts = mention_counts(match_entities(news.select(text), text, keywords, mode))
    changes = price_change_by_keyword(ticks, keywords, change)
    return changes.join(counts, "entity", "left").select(
        "entity", F.coalesce("n_news", F.lit(0)).alias("n_news"), "avg_change_pct"
    )


def newest(df: DataFrame, order: Sequence[str | Column], by: str = "entity") -> DataFrame:
    """The last row per entity by ``order``, combined before the shuffle.

    Rows of numbers and times are aggregated by hash, others by sorting.
    """
    found = extreme(df, [by], order, last=True)
    if found is not None:
        return found.select(by, *[c for c in df.columns if c != by])
    rest = [c for c in df.columns if c != by]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(by).agg(last.alias("_last")).select(by, "_last.*")


def latest_prices(
    ticks: DataFrame, dim: DataFrame, order: Sequence[str] = ("ts", "id")
) -> DataFrame:
    """Last price per entity; known entities without a tick show their baseline."""
    last = newest(ticks, order)
    have = set(last.columns)

    def own(name: str, fallback: Column) -> Column:
        return F.coalesce(F.col(name), fallback) if name in have else fallback

    seed = dim.select("entity", F.col("baseline").alias("_baseline"))
    both = last.join(seed, "entity", "full")
    pct = own("pct_change", F.lit(0.0))
    return both.select(
        "entity",
        own("price", F.col("_baseline")).alias("price"),
        pct.alias("pct_change"),
        trend_band(pct).alias("trend"),
        own("region", F.lit("Nasional")).alias("region"),
        F.col("ts"),
        own("baseline", F.col("_baseline")).alias("baseline"),
    )


def price_flash(before: DataFrame, after: DataFrame) -> DataFrame:
    """Direction of each entity's price since the snapshot before."""
    old = before.select("entity", F.col("price").alias("prev_price"))
    step = F.col("price") - F.col("prev_price")
    flash = F.when(F.col("prev_price") == 0, "").when(step > 0, "up").when(step < 0, "down")
    return (
        after.select("entity", "price")
        .join(old, "entity", "left")
        .withColumn("flash", F.coalesce(flash, F.lit("")))
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert").agg(F.count(F.lit(1)).alias("n"))
