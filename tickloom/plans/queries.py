"""The registered queries: every operator on the driver tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom import dimensions, schemas
from tickloom.functions import numbers, times
from tickloom.functions.numbers import trend_band
from tickloom.functions.text import contains_any, plain_text, search_text
from tickloom.operators import (
    aggregate,
    clean,
    combine,
    dedupe,
    match,
    model,
    series,
    versions,
)
from tickloom.plans import bindings as b
from tickloom.session import input_bytes, scratch_dir
from tickloom.sources import readers, sinks
from tickloom.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT = 64  # chunks per hot entity in the queries that force the split plan
FILE_BYTES = 32 << 20  # of a table, for each file that a stream reads it from
EVENT_TOPIC = schemas.struct(entity="string", price="double", ts="timestamp_ntz", id="bigint")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Both engines agree on sums and averages to 8 digits."""
    return df.withColumns({c: F.round(c, 8) for c in cols})


def plain_ts(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# Cleaning


@query
def silver_ticks(spark, sf):
    return plain_ts(clean.clean_ticks(b.raw_event_ticks(spark, sf), b.event_aliases(spark)), "ts")


@query
def silver_ticks_unified(spark, sf):
    raw, aliases = b.raw_event_ticks(spark, sf), b.event_aliases(spark)
    return plain_ts(clean.clean_ticks(raw, aliases, canonicalize_first=True), "ts")


@query
def silver_news(spark, sf):
    return plain_ts(clean.clean_news(b.raw_articles(spark, sf)), "published_ts")


@query
def canonical_entities(spark, sf):
    raw = b.raw_event_ticks(spark, sf).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    named = raw.withColumn("raw_entity", F.col("entity"))
    return clean.canonicalize(named, b.event_aliases(spark))


@query
def quality_audit(spark, sf):
    return dedupe.quality_audit(b.raw_event_ticks(spark, sf), ["ts", "entity", "price"])


# Grouped analysis


@query
def volatility(spark, sf):
    vol = aggregate.volatility(b.lineitem_ticks(spark, sf, "p_brand"))
    return rounded(vol, "price_avg", "volatility_pct")


@query
def volatility_ranked(spark, sf):
    ticks = clean.filter_valid_price(b.event_ticks(spark, sf, "user_id"))
    return rounded(aggregate.ranked(aggregate.volatility(ticks)), "price_avg", "volatility_pct")


@query
def volatility_share(spark, sf):
    vol = aggregate.volatility(b.event_ticks(spark, sf, "user_id"))
    return rounded(aggregate.volatility_share(vol), "price_avg", "volatility_pct", "share_pct")


@query
def trend(spark, sf):
    return rounded(aggregate.trend(b.event_ticks(spark, sf)), "price_avg")


@query
def trend_hourly(spark, sf):
    return rounded(aggregate.trend(b.event_ticks(spark, sf, "user_id"), "hour"), "price_avg")


@query
def trend_matrix(spark, sf):
    hourly = aggregate.trend(b.event_ticks(spark, sf), "hour")
    return rounded(aggregate.trend_matrix(hourly), *b.EVENT_TYPES)


@query
def trend_blocks(spark, sf):
    """The matrix of all users, none of which is named: blocks of 64 columns, a row a cell."""
    hourly = aggregate.trend(b.event_ticks(spark, sf, "user_id"), "hour")
    blocks = aggregate.trend_blocks(hourly, width=64)
    cells = blocks.select(
        "block", "period", F.posexplode(F.arrays_zip("entities", "prices")).alias("place", "cell")
    )
    found = cells.select("block", "place", "period", "cell.entities", "cell.prices")
    return rounded(found.withColumnsRenamed({"entities": "entity", "prices": "price_avg"}), "price_avg")


@query
def trend_filled(spark, sf):
    ticks = b.event_ticks(spark, sf, "user_id")
    dim = ticks.groupBy("entity").agg(F.min("price").alias("baseline"))
    return rounded(series.trend_filled(aggregate.trend(ticks, "hour"), dim), "price_avg")


@query
def trend_filled_split(spark, sf):
    """Few entities with many periods, dealt over many ranges."""
    ticks = b.event_ticks(spark, sf)
    dim = ticks.groupBy("entity").agg(F.min("price").alias("baseline"))
    return rounded(series.trend_filled(aggregate.trend(ticks), dim, chunks=SPLIT), "price_avg")


@query
def latest_prices(spark, sf):
    ticks = b.lineitem_ticks(spark, sf).withColumn(
        "pct_change", (F.col("price") - F.col("baseline")) / F.col("baseline") * 100
    )
    dim = b.table(spark, sf, "part").select(
        F.col("p_partkey").alias("entity"), F.col("p_retailprice").alias("baseline")
    )
    return aggregate.latest_prices(ticks, dim, b.LINEITEM_ORDER)


# Series


@query
def price_changes(spark, sf):
    return series.price_changes(b.event_ticks(spark, sf))


@query
def price_changes_split(spark, sf):
    return series.price_changes(b.event_ticks(spark, sf), chunks=SPLIT)


@query
def alerts(spark, sf):
    found = series.alerts(b.event_ticks(spark, sf, "user_id"))
    return found.select("entity", "price", "prev_price", "pct_change", "alert", "ts")


@query
def alert_summary(spark, sf):
    return aggregate.alert_summary(series.alerts(b.event_ticks(spark, sf)))


@query
def pct_change_prev2(spark, sf):
    return series.two_back_changes(b.lineitem_ticks(spark, sf), b.LINEITEM_ORDER)


@query
def pct_change_prev2_split(spark, sf):
    ticks = b.lineitem_ticks(spark, sf, "p_brand")
    return series.two_back_changes(ticks, b.LINEITEM_ORDER, chunks=SPLIT)


@query
def price_flash(spark, sf):
    events = b.event_ticks(spark, sf, "user_id")
    last_day = events.agg(F.date_trunc("day", F.max("ts")).cast("timestamp_ntz")).scalar()
    before = events.where(F.col("ts") < last_day)
    return aggregate.price_flash(
        aggregate.newest(before, ["ts", "id"]), aggregate.newest(events, ["ts", "id"])
    )


@query
def recent_ticks(spark, sf):
    return series.recent(b.event_ticks(spark, sf), 200)


@query
def recent_news(spark, sf):
    return series.recent(b.documents(spark, sf).select("id", "source", "text"), 20, ["id"])


@query
def recent_per_entity(spark, sf):
    return series.recent_per_entity(b.event_ticks(spark, sf, "user_id"), 5)


@query
def merged_history(spark, sf):
    events = b.table(spark, sf, "events")
    keyed = events.select(
        F.col("user_id").alias("entity"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
        F.col("value").alias("price"),
        F.col("event_id").alias("arrival"),
        "event_type",
    )
    live = keyed.where(F.col("event_type").isin("purchase", "signup")).drop("event_type")
    return combine.merge_priority(live, keyed.drop("event_type"))


@query
def price_floor(spark, sf):
    low = (F.col("entity") == "view") & (F.col("price") < 5)
    return versions.update_where(b.event_ticks(spark, sf), low, {"price": F.lit(5.0)})


@query
def snapshot_diff(spark, sf):
    before = b.event_ticks(spark, sf)
    low = (F.col("entity") == "view") & (F.col("price") < 5)
    after = versions.update_where(before, low, {"price": F.lit(5.0)})
    refunds = before.where("entity = 'purchase'").withColumns(
        {"entity": F.lit("refund"), "id": -F.col("id") - 1}
    )
    after = after.where("entity <> 'signup'").unionByName(refunds)
    return combine.compare_versions(before, after, ["entity", "ts", "id"], ["price"])


# Text


def _doc_text(spark, sf):
    docs = b.documents(spark, sf).select("id", "text")
    return docs.select("id", search_text("text").alias("text"))


@query
def news_mentions(spark, sf):
    found = match.match_entities(_doc_text(spark, sf), "text", b.EVENT_KEYWORDS)
    return aggregate.mention_counts(found)


@query
def news_mentions_word(spark, sf):
    found = match.match_entities(_doc_text(spark, sf), "text", b.EVENT_KEYWORDS, mode="word")
    return aggregate.mention_counts(found)


@query
def news_mentions_join(spark, sf):
    words = dimensions.keyword_table(spark, b.EVENT_KEYWORDS)
    found = match.match_entities_by_join(_doc_text(spark, sf), "text", words)
    return aggregate.mention_counts(found)


def _type_ticks(spark, sf):
    return b.lineitem_ticks(spark, sf, "p_type").withColumn(
        "pct_change", (F.col("price") - F.col("baseline")) / F.col("baseline") * 100
    )


@query
def price_change_by_keyword(spark, sf):
    found = aggregate.price_change_by_keyword(_type_ticks(spark, sf), b.TYPE_KEYWORDS)
    return rounded(found, "avg_change_pct")


@query
def keyword_correlation(spark, sf):
    both = aggregate.keyword_correlation(
        _type_ticks(spark, sf), _doc_text(spark, sf), b.TYPE_KEYWORDS
    )
    return rounded(both, "avg_change_pct")


@query
def news_correlation(spark, sf):
    ticks = series.price_changes(b.event_ticks(spark, sf))
    both = aggregate.news_correlation(ticks, _doc_text(spark, sf), b.EVENT_KEYWORDS)
    return rounded(aggregate.change_signs(both), "avg_change_pct", "abs_change_pct")


@query
def relevant_docs(spark, sf):
    docs = b.documents(spark, sf)
    return match.filter_relevant(docs, ["source", "text"], b.TOPIC_WORDS).select("id", "source")


@query
def relevant_docs_word(spark, sf):
    docs = b.documents(spark, sf)
    kept = match.filter_relevant(docs, ["text"], b.WHOLE_WORDS, mode="word")
    return kept.select("id", "source")


@query
def allowed_pages(spark, sf):
    rules = dimensions.link_rule_table(spark, b.PAGE_RULES)
    return match.filter_links(b.page_items(spark, sf), rules).select("id", "link", "source")


@query
def relevant_pages(spark, sf):
    """On its source's own site, and about the topic."""
    pages = match.filter_links(
        b.page_items(spark, sf), dimensions.link_rule_table(spark, b.PAGE_RULES)
    )
    kept = match.filter_relevant(pages, ["title", "summary"], b.TOPIC_WORDS)
    return kept.select("id", "link", "source")


@query
def page_plain_text(spark, sf):
    pages = b.page_items(spark, sf).select("id", "summary")
    return pages.select("id", plain_text("summary").alias("text"))


@query
def news_payload(spark, sf):
    return sinks.news_payload(b.page_items(spark, sf)).drop("id")


@query
def keyword_flags(spark, sf):
    docs = _doc_text(spark, sf)
    return docs.select("id", contains_any("text", b.TOPIC_WORDS).alias("on_topic"))


@query
def price_bands(spark, sf):
    changes = series.price_changes(b.event_ticks(spark, sf))
    return changes.groupBy("entity", trend_band("pct_change").alias("band")).agg(
        F.count(F.lit(1)).alias("n")
    )


# Model


@query
def ml_features(spark, sf):
    return series.ml_features(b.event_ticks(spark, sf, "user_id"))


@query
def ml_features_split(spark, sf):
    return series.ml_features(b.event_ticks(spark, sf), chunks=SPLIT)


@query
def ml_split(spark, sf):
    return series.split_by_time(series.ml_features(b.event_ticks(spark, sf, "user_id")))


def _features(spark, sf):
    return series.ml_features(b.event_ticks(spark, sf, "user_id"))


def _part_split(spark, sf):
    return series.split_by_time(series.ml_features(b.lineitem_ticks(spark, sf), b.LINEITEM_ORDER))


COEFS = ("coef_time", "coef_hour", "intercept")
SCORES = ("r2_train", "rmse_train", "mae_train", "r2_test", "rmse_test", "mae_test")


@query
def price_model(spark, sf):
    fitted = model.fit(series.split_by_time(_features(spark, sf)))
    return rounded(fitted.select("entity", *COEFS), *COEFS)


@query
def price_model_ridge_sum(spark, sf):
    fitted = model.fit(_part_split(spark, sf), penalty="ridge_sum")
    return rounded(fitted.select("entity", *COEFS), *COEFS)


@query
def model_metrics(spark, sf):
    split, fitted = model.fit_once(series.split_by_time(_features(spark, sf)))
    return rounded(model.metrics(split, fitted), *SCORES)


@query
def price_forecast(spark, sf):
    ahead = model.forecast(model.fit(series.split_by_time(_features(spark, sf))))
    return rounded(ahead, "price_pred")


@query
def model_report(spark, sf):
    report = model.model_report(series.split_by_time(_features(spark, sf)))
    report = rounded(report, *COEFS, *SCORES)
    steps = F.transform(
        "forecast",
        lambda p: F.concat_ws(":", p["step"], p["time_idx"], p["hour"]),
    )
    return report.withColumn("forecast", F.array_join(steps, " "))


@query
def model_leaderboard(spark, sf):
    split, fitted = model.fit_once(series.split_by_time(_features(spark, sf)))
    board = model.leaderboard(model.scored_models(split, fitted))
    return rounded(board, "best_r2", "worst_r2")


@query
def model_directions(spark, sf):
    split, fitted = model.fit_once(
        series.split_by_time(series.ml_features(b.event_ticks(spark, sf)))
    )
    report = model.scored_models(split, fitted)
    return model.direction_lists(report)


@query
def model_directions_users(spark, sf):
    """Lists of all fitted entities, none of which is named beforehand."""
    split, fitted = model.fit_once(series.split_by_time(_features(spark, sf)))
    return model.direction_lists(model.scored_models(split, fitted))


@query
def report_document(spark, sf):
    """The items of a written report, read back from its lines."""
    ticks = b.event_ticks(spark, sf, "user_id")
    sections = {
        "volatility": aggregate.volatility(ticks),
        "trend": aggregate.trend(ticks, "hour"),
    }
    names = [schemas.REPORT_FIELDS[s][0] for s in sections]
    path = scratch_dir(spark, "report")
    sinks.report_document(sinks.report_rows(sections, local_names=True), names).write.text(path)
    item = F.regexp_extract("value", r'^,?(\{"komoditas".*\})$', 1)
    fields = "komoditas string, periode string, harga_rata double, harga_max double, volatilitas_pct double"
    items = spark.read.text(path).select(F.from_json(item, fields).alias("i"))
    found = items.where("i.komoditas is not null").select("i.*")
    return rounded(found, "harga_rata", "harga_max", "volatilitas_pct")


@query
def report_sections(spark, sf):
    ticks = b.event_ticks(spark, sf)
    changes = series.price_changes(ticks)
    sections = {
        "volatility": aggregate.volatility(ticks),
        "trend": aggregate.trend(ticks),
        "correlation": aggregate.news_correlation(changes, _doc_text(spark, sf), b.EVENT_KEYWORDS),
    }
    models = model.model_report(series.split_by_time(series.ml_features(ticks)))
    old = sinks.report_rows({"models": models, "trend": aggregate.trend(ticks, "hour")})
    rows = sinks.merge_report(sinks.report_rows(sections), old, list(sections))
    return rows.groupBy("section").agg(F.count("item").alias("items"))


# Files, written and read back


PUBLISHED = {"komoditas": "entity", "harga": "price", "timestamp": "ts"}
TICK_LINE = schemas.struct(entity="string", price="double", ts="timestamp_ntz", id="bigint")


def _published(spark, sf):
    """Events under their published field names."""
    return b.event_ticks(spark, sf).withColumnsRenamed({v: k for k, v in PUBLISHED.items()})


def _write_lines(ticks, path):
    ticks.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)


@query
def jsonl_ticks(spark, sf):
    """JSON lines under their published names, with lines that are no JSON among them."""
    path = scratch_dir(spark, "jsonl")
    _write_lines(_published(spark, sf), path)
    broken = b.event_ticks(spark, sf).select(F.concat(F.lit('{"komoditas": '), "id").alias("value"))
    broken.write.mode("append").text(path)
    return readers.read_jsonl(spark, path, TICK_LINE, PUBLISHED)


def _write_arrays(spark, sf, path):
    """One array a day, in order of the ids."""
    row = F.to_json(F.struct("komoditas", "harga", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "id"))
    days = _published(spark, sf).groupBy(F.to_date("timestamp").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("id", row.alias("item")))).alias("items")
    )
    text = F.concat(F.lit("["), F.array_join("items.item", ",\n"), F.lit("]"))
    days.select("day", text.alias("value")).write.partitionBy("day").option("lineSep", "\n\n").text(path)


@query
def array_ticks(spark, sf):
    """JSON arrays, a file a day, with the place of each tick in its array."""
    path = scratch_dir(spark, "arrays")
    _write_arrays(spark, sf, path)
    return readers.read_json_array(spark, f"{path}/day=*", TICK_LINE, PUBLISHED, position="place")


@query
def first_available_ticks(spark, sf):
    """The first source does not exist, the second one is read."""
    path = scratch_dir(spark, "available")
    _write_lines(_published(spark, sf), f"{path}/lines")
    _write_arrays(spark, sf, f"{path}/arrays")
    sources = [("lines", f"{path}/none"), ("array", f"{path}/arrays/day=*"), ("lines", f"{path}/lines")]
    return readers.read_first_available(spark, sources, TICK_LINE, PUBLISHED, position="place")


@query
def feed_items(spark, sf):
    """Pages as items of feed files; those without a link are skipped."""
    path = scratch_dir(spark, "feed")
    stamp = F.date_format(F.timestamp_seconds(F.col("id") * 3600), "EEE, dd MMM yyyy HH:mm:ss")
    pages = b.page_items(spark, sf).select(
        "title",
        F.when(F.col("id") % 5 == 0, F.lit("  ")).otherwise(F.col("link")).alias("link"),
        F.col("summary").alias("description"),
        F.concat(stamp, F.lit(" +0000")).alias("pubDate"),
    )
    pages.write.format("xml").option("rowTag", "item").option("rootTag", "rss").save(path)
    items = readers.read_feed_items(spark, path, source="feed")
    return plain_ts(items.select("link", "published", "source", F.length("summary").alias("n_chars")), "published")


def _versions(spark, sf):
    """A table of three versions: as loaded, a floor for one entity, without another."""
    path = scratch_dir(spark, "versions")
    versions.commit(b.event_ticks(spark, sf), path)
    low = (F.col("entity") == "view") & (F.col("price") < 5)
    versions.update_table(spark, path, low, {"price": F.lit(5.0)})
    versions.commit(versions.as_of(spark, path).where("entity <> 'signup'"), path, "DELETE")
    return path


@query
def version_history(spark, sf):
    """Every version with its operation and what it holds."""
    path = _versions(spark, sf)
    rows = [
        versions.as_of(spark, path, v).agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total")).withColumn("version", F.lit(v).cast("long"))
        for v in range(3)
    ]
    held = rows[0].unionByName(rows[1]).unionByName(rows[2])
    found = versions.history(spark, path).join(held, "version").select("version", "operation", "n", "total")
    return rounded(found, "total")


@query
def version_as_of(spark, sf):
    return versions.as_of(spark, _versions(spark, sf), 1)


@query
def price_floor_stored(spark, sf):
    """A stored table by day, corrected twice; only days with such rows are written."""
    path = scratch_dir(spark, "corrected")
    ticks = b.event_ticks(spark, sf).withColumn("date", F.to_date("ts"))
    versions.commit(ticks, path, partition_by=["date"])
    low = (F.col("entity") == "view") & (F.col("price") < 5)
    versions.update_table(spark, path, low, {"price": F.lit(5.0)})
    first_day = F.col("date") == ticks.agg(F.min("date")).scalar()
    versions.update_table(spark, path, first_day & (F.col("entity") == "click"), {"price": F.lit(0.5)})
    return versions.as_of(spark, path)


@query
def appended_batches(spark, sf):
    """Batches by month with load metadata; the second one came three times, at last without rows of one type."""
    path = scratch_dir(spark, "appended")
    ticks = clean.with_ingest_meta(b.event_ticks(spark, sf), "api")
    for day in (0, 1, 1):
        sinks.append_table(ticks.where(F.col("id") % 2 == day), path, f"batch {day}")
    sinks.append_table(ticks.where("id % 2 = 1 AND entity <> 'signup'"), path, "batch 1")
    rows = spark.read.parquet(path).where(F.col("_ingested_at").isNotNull())
    return rows.groupBy("entity", F.col("_source").alias("origin"), F.col(sinks.BATCH).alias("batch")).agg(F.count(F.lit(1)).alias("n"))


@query
def overwritten_table(spark, sf):
    """A table by date that replaces another one."""
    path = scratch_dir(spark, "overwritten")
    ticks = b.event_ticks(spark, sf).withColumn("date", F.to_date("ts"))
    sinks.overwrite_table(ticks.where("entity = 'view'"), path, ["date"])
    sinks.overwrite_table(ticks.where("entity <> 'view'"), path, ["date"])
    return readers.read_table(spark, path)


@query
def report_rounding(spark, sf):
    """Published figures: half-even rounding and the local clock."""
    vol = aggregate.volatility(b.event_ticks(spark, sf, "user_id"))
    digits = {"price_max": 0, "price_min": 0, "volatility_pct": 2}
    return numbers.round_for_report(vol, digits).select("entity", *digits)


@query
def local_hours(spark, sf):
    """Events by hour of the local clock."""
    local = times.local_time("ts")
    ticks = b.event_ticks(spark, sf)
    return ticks.groupBy(F.hour(local).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query
def trend_lines(spark, sf):
    """Places of the trend's items in the written report, in the order of its periods."""
    path = scratch_dir(spark, "report-order")
    trend = aggregate.trend(b.event_ticks(spark, sf), "hour")
    rows = sinks.report_rows({"trend": trend}, local_names=True)
    lines = sinks.report_document(rows, [schemas.REPORT_FIELDS["trend"][0]])
    lines.write.text(path)
    files = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place")
    )
    item = F.from_json(F.regexp_extract("value", r'^,?(\{"komoditas".*\})$', 1), "komoditas string, periode string")
    found = files.withColumn("i", item).where("i.komoditas is not null")
    nth = F.row_number().over(Window.partitionBy("i.komoditas").orderBy("file", "place"))
    return found.select("i.komoditas", "i.periode", nth.alias("nth"))


# Topics and streams


@query
def topic_roundtrip(spark, sf):
    ticks = b.event_ticks(spark, sf)
    return readers.decode_topic(sinks.encode_topic(ticks, "entity"), EVENT_TOPIC)


def _arrivals(spark, rows, keys, path, batches):
    """A table that arrives in so many batches, its rows dealt over files by their keys.

    A larger table fills more files, not larger ones; each batch takes an equal number.
    """
    source = f"{path}/source"
    files = batches * max(1, math.ceil(input_bytes(rows) / (batches * FILE_BYTES)))
    rows.repartition(files, F.xxhash64(*keys)).write.parquet(source)
    written = len(spark.read.parquet(source).inputFiles())  # those without rows are missing
    return readers.stream_table(spark, source, max_files=math.ceil(written / batches))


def _late_events(spark, sf, path, batches=4):
    """All events, dealt over batches without regard to time."""
    return _arrivals(spark, b.table(spark, sf, "events"), ["event_id"], path, batches)


@query
def stream_dedupe(spark, sf):
    # The same text again is the same article; its arrival time is the clock.
    path = scratch_dir(spark, "stream-dedupe")
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    docs = _arrivals(spark, docs, docs.columns, path, batches=3).select(
        F.sha2("text", 256).alias("link"), F.current_timestamp().alias("fetched_at")
    )
    first = streams.first_seen(docs, "link", "fetched_at").select("link")
    out = first.writeStream.format("parquet").option("checkpointLocation", f"{path}/ckpt")
    out.trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return spark.read.parquet(f"{path}/out")


def _ingested(spark, sf, name):
    path = scratch_dir(spark, name)
    ticks = b.as_ticks(_late_events(spark, sf, path)).withColumn("entity", F.upper("entity"))
    streams.ingest_stream(
        sinks.encode_topic(ticks, "entity"),
        EVENT_TOPIC,
        b.event_aliases(spark),
        f"{path}/archive",
        f"{path}/view",
        f"{path}/ckpt",
        order=("ts", "id"),
    ).awaitTermination()
    return path


@query
def stream_ingest(spark, sf):
    path = _ingested(spark, sf, "stream-ingest")
    return readers.read_table(spark, f"{path}/archive").drop(sinks.BATCH)


@query
def stream_view(spark, sf):
    """The newest 200 ticks after several batches that are not in the order of time."""
    path = _ingested(spark, sf, "stream-view")
    return streams.read_view(spark, f"{path}/view", order=("ts", "id"))


@query
def stream_alerts(spark, sf):
    path = scratch_dir(spark, "stream-alerts")
    streams.stream_changes(
        b.as_ticks(_late_events(spark, sf, path, batches=8), "user_id"),
        f"{path}/out",
        f"{path}/archive",
        f"{path}/ckpt",
        threshold=5.0,
    ).awaitTermination()
    return streams.read_changes(spark, f"{path}/out")


@query
def stream_refresh(spark, sf):
    """An analysis of the whole archive whenever enough rows have come in."""
    path = scratch_dir(spark, "stream-refresh")
    events = b.table(spark, sf, "events")
    for part in range(5):
        events.where(F.col("event_id") % 5 == part).coalesce(1).write.mode("append").parquet(f"{path}/source")

    def analyse(rows):
        counts = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("append").parquet(f"{path}/analyses")

    least = events.count() // 3
    step = streams.refresh_after(f"{path}/archive", f"{path}/done", analyse, min_rows=least)
    source = readers.stream_table(spark, f"{path}/source", max_files=1)
    streams.run_batches(source, step, f"{path}/ckpt").awaitTermination()
    return spark.read.parquet(f"{path}/analyses").select(F.col("event_type").alias("entity"), "n")


@query
def stream_lines(spark, sf):
    """A stream archived as JSON lines and read back."""
    path = scratch_dir(spark, "stream-lines")
    ticks = b.as_ticks(_late_events(spark, sf, path)).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    sinks.stream_to_jsonl(ticks, f"{path}/out", f"{path}/ckpt").awaitTermination()
    return readers.read_jsonl(spark, f"{path}/out", TICK_LINE)


@query
def stream_trend(spark, sf):
    path = scratch_dir(spark, "stream-trend")
    streams.stream_trend(
        b.as_ticks(_late_events(spark, sf, path)), f"{path}/out", f"{path}/ckpt", width="1 hour"
    ).awaitTermination()
    found = streams.read_trend(spark, f"{path}/out")
    return rounded(plain_ts(found, "period"), "price_avg")
