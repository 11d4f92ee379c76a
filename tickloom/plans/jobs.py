"""The stored layers: raw, clean, analysis, model and report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import dimensions, schemas
from tickloom.functions.numbers import round_for_report
from tickloom.functions.text import search_text
from tickloom.operators import aggregate, clean, combine, model, series, versions
from tickloom.sources import readers, sinks

# Digits shown in reports.
REPORT_DIGITS = {
    "volatility": {"price_avg": 2, "volatility_pct": 2},
    "trend": {"price_avg": 0},
    "correlation": {"avg_change_pct": 2},
    "models": {
        "coef_time": 6,
        "coef_hour": 6,
        "intercept": 2,
        "r2_train": 4,
        "rmse_train": 2,
        "mae_train": 2,
        "r2_test": 4,
        "rmse_test": 2,
        "mae_test": 2,
    },
}
BY_DATE = ("date",)
TABLES = ("ticks", "news")


def ingest_raw(
    spark: SparkSession,
    tick_sources: Iterable[tuple[str, str]],
    news_sources: Iterable[tuple[str, str]],
    base: str,
    batch_id: str | None = None,
) -> None:
    """Raw layer: messages as received plus load time and origin."""
    feeds = (
        ("ticks", "api", tick_sources, schemas.RAW_TICK, schemas.TICK_FIELDS),
        ("news", "rss", news_sources, schemas.RAW_NEWS, schemas.NEWS_FIELDS),
    )
    for table, origin, sources, schema, fields in feeds:
        df = readers.read_first_available(spark, list(sources), schema, fields, clean.POSITION)
        sinks.append_table(clean.with_ingest_meta(df, origin), f"{base}/raw/{table}", batch_id)


def build_clean(spark: SparkSession, base: str, canonicalize_first: bool = False) -> None:
    """Clean layer: versioned ticks and news."""
    aliases = dimensions.alias_table(spark)
    # With the known columns, since a table that got no rows yet has no file to tell them.
    schemas_of = {"ticks": schemas.RAW_TICK, "news": schemas.RAW_NEWS}
    raw = {
        t: readers.read_table(spark, f"{base}/raw/{t}", clean.with_meta(schemas_of[t])).drop(
            sinks.BATCH
        )
        for t in TABLES
    }
    ticks = clean.clean_ticks(raw["ticks"], aliases, canonicalize_first)
    versions.commit(ticks, f"{base}/clean/ticks", partition_by=BY_DATE)
    versions.commit(clean.clean_news(raw["news"]), f"{base}/clean/news")


def correct_floor(spark: SparkSession, base: str, entity: str, floor: float) -> DataFrame:
    """Raise an entity's too low prices to the floor; returns what changed."""
    path = f"{base}/clean/ticks"
    before = versions.as_of(spark, path)
    low = (F.col("entity") == entity) & (F.col("price") < floor)
    versions.update_table(spark, path, low, {"price": F.lit(floor)}, BY_DATE)
    after = versions.as_of(spark, path)
    # Ticks have no id of their own; rows of equal time are told apart by source fields.
    keys = ["entity", "ts", "source", "region"]
    return combine.compare_versions(before, after, keys, ["price"])


def analyse(
    ticks: DataFrame,
    news: DataFrame | None,
    keywords: Mapping[str, Iterable[str]] = dimensions.ENTITY_KEYWORDS,
    mode: str = "substring",
    known: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The analysis tables of clean ticks and news.

    Without ``known`` all entities are analysed as they occur. With a baseline
    table only its entities are, the trend has every one of them in every
    period, and the correlation matches summaries and entity names by keyword.
    """
    order = ("ts", "id") if "id" in ticks.columns else ("ts", "price")
    cols = ("title", "summary") if known is None else ("summary",)
    if news is not None:
        news = news.withColumn("text", search_text(*cols))
    if known is None:
        correlation = aggregate.news_correlation(ticks, news, keywords, mode=mode)
    else:
        correlation = aggregate.keyword_correlation(ticks, news, keywords, mode=mode)
    if known is not None:
        ticks = ticks.join(known.select("entity"), "entity", "left_semi")
    trend = aggregate.trend(ticks)
    return {
        "volatility": aggregate.volatility(ticks),
        "trend": trend if known is None else series.trend_filled(trend, known),
        "alerts": series.alerts(ticks, order=order).select(
            "entity", "price", "prev_price", "pct_change", "alert", "ts"
        ),
        "correlation": correlation,
    }


def model_input(ticks: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Ticks for the model, completed by stored trend rows; ticks win.

    Of several ticks of an entity and time the last to arrive wins.
    """
    live = ticks.select("entity", "ts", "price", clean.arrival(ticks).alias("arrival"))
    if history is None:
        history = live.limit(0).withColumnsRenamed({"ts": "period", "price": "price_avg"})
    past = history.select(
        "entity",
        F.col("period").cast("timestamp").alias("ts"),
        F.col("price_avg").alias("price"),
        F.unix_micros(F.col("period").cast("timestamp")).cast("decimal(38,0)").alias("arrival"),
    )
    return combine.merge_priority(live, past)


def build_analysis(spark: SparkSession, base: str, known_only: bool = False) -> None:
    """Analysis layer; the report keeps the sections it does not rebuild."""
    ticks = versions.as_of(spark, f"{base}/clean/ticks")
    try:
        news = versions.as_of(spark, f"{base}/clean/news")
    except ValueError:
        news = None
    known = dimensions.baseline_table(spark) if known_only else None
    tables = analyse(ticks, news, known=known)
    tables["trend"] = tables["trend"].withColumn("date", F.to_date("period"))
    tables["alerts"] = tables["alerts"].withColumn("date", F.to_date("ts"))
    for name, df in tables.items():
        layout = BY_DATE if "date" in df.columns else ()
        sinks.overwrite_table(df, f"{base}/analysis/{name}", layout)
    stored = {
        name: readers.read_table(spark, f"{base}/analysis/{name}")
        for name in ("volatility", "trend", "correlation")
    }
    _update_report(spark, base, stored)


def build_models(spark: SparkSession, base: str, penalty: str = "mllib") -> None:
    """Fit and forecast every known entity, from its ticks and the stored trend."""
    known = dimensions.baseline_table(spark).select("entity")
    ticks = versions.as_of(spark, f"{base}/clean/ticks").join(known, "entity", "left_semi")
    try:
        history = readers.read_table(spark, f"{base}/analysis/trend")
        history = history.join(known, "entity", "left_semi")
    except AnalysisException:  # no analysis has run yet
        history = None
    rows = model_input(ticks, history)
    split = series.split_by_time(series.ml_features(rows, order=("ts", "price")))
    report = model.model_report(split, penalty=penalty)
    sinks.overwrite_table(report, f"{base}/analysis/models")
    _update_report(
        spark, base, {"models": readers.read_table(spark, f"{base}/analysis/models")}
    )


def summary(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """What a run is read for: the most volatile entities and the model comparison."""
    models = readers.read_table(spark, f"{base}/analysis/models")
    volatility = readers.read_table(spark, f"{base}/analysis/volatility")
    return {
        "most volatile": aggregate.ranked(volatility).limit(5),
        "best and worst model": model.leaderboard(models),
        "directions": model.direction_lists(models, list(dimensions.BASELINES)),
    }


def export_report(spark: SparkSession, base: str, path: str) -> None:
    """The latest report as a folder of files that together are one JSON document."""
    rows = versions.as_of(spark, f"{base}/report")
    sections = [label for label, _ in schemas.REPORT_FIELDS.values()]
    sinks.report_document(rows, sections).write.mode("overwrite").text(path)


def _update_report(spark: SparkSession, base: str, tables: dict[str, DataFrame]) -> None:
    path = f"{base}/report"
    rounded = {name: round_for_report(df, REPORT_DIGITS[name]) for name, df in tables.items()}
    rows = sinks.report_rows(rounded, local_names=True)
    try:
        last = versions.as_of(spark, path)
    except (ValueError, AnalysisException):
        last = None
    if last is not None:
        rows = sinks.merge_report(rows, last, [schemas.REPORT_FIELDS[n][0] for n in tables])
    versions.commit(rows, path)
