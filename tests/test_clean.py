from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickloom import dimensions, schemas
from tickloom.functions.numbers import pct_change, r2_band, round_for_report, trend_band
from tickloom.functions.times import local_time, parse_feed_time, parse_time, with_date_parts
from tickloom.operators import clean, dedupe

T1 = "2026-05-07T11:36:12.000001"


def ticks(spark, rows):
    return spark.createDataFrame(rows, "entity string, price string, ts string, id long")


def test_clean_ticks_edge_rows(spark):
    raw = ticks(
        spark,
        [
            ("Beras", "13500", T1, 1),
            ("Beras", "13500", T1, 2),  # copy
            ("Beras Medium", "13500", T1, 3),  # same tick, other spelling
            ("  beras   MEDIUM ", "14000", T1, 4),
            ("Jagung", None, T1, 5),
            ("Jagung", "0", T1, 6),
            ("Jagung", "-1", T1, 7),
            ("Jagung", "n/a", T1, 8),
            ("Kopi", "9.5", "", 9),  # unknown entity, unreadable time
        ],
    )
    aliases = dimensions.alias_table(spark)
    rows = {r.id: r for r in clean.clean_ticks(raw, aliases).collect()}
    assert set(rows) == {1, 3, 4, 9}
    assert {rows[i].entity for i in (1, 3, 4)} == {"Beras"}
    assert rows[1].ts == dt.datetime(2026, 5, 7, 11, 36, 12, 1)
    assert (rows[1].hour, rows[1].date) == (11, dt.date(2026, 5, 7))
    assert rows[9].entity == "Kopi" and rows[9].ts is None and rows[9].hour is None

    unified = clean.clean_ticks(raw, aliases, canonicalize_first=True)
    assert sorted(r.id for r in unified.collect()) == [1, 4, 9]


def test_cleaning_twice_changes_nothing(spark):
    raw = ticks(spark, [("a", "1", T1, 1), ("a", "1", T1, 2), ("b", "2", T1, 3)])
    once = clean.clean_ticks(raw).select("entity", "price", "ts", "id")
    twice = clean.clean_ticks(once).select("entity", "price", "ts", "id")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_clean_news(spark):
    rows = [
        ("t", "2026-05-11T02:55:31", "site.com", 1),
        ("t", "2026-05-11T02:55:31", "site.com", 2),
        ("t", None, "x", 3),
        ("t", None, "x", 4),
        ("", None, "x", 5),
        (None, None, "x", 6),
        ("u", "soon", "x", 7),
    ]
    df = spark.createDataFrame(rows, "title string, published string, source string, id long")
    out = {r.id: r for r in clean.clean_news(df).collect()}
    assert set(out) == {1, 3, 7}
    assert out[1].source == "SITE.COM"
    assert out[1].published_ts == dt.datetime(2026, 5, 11, 2, 55, 31)
    assert out[7].published_ts is None


def test_canonical_names(spark):
    names = ["BERAS", "beras medium", " minyak\tGORENG ", " Kopi  Susu ", "", None]
    df = spark.createDataFrame([(n,) for n in names], "entity string")
    got = clean.canonicalize(df, dimensions.alias_table(spark)).collect()
    assert sorted(r.entity for r in got) == sorted(
        ["Beras", "Beras", "Minyak Goreng", "Kopi  Susu", "", ""]
    )


def test_dedupe_is_deterministic_and_keeps_null_keys(spark):
    rows = [("a", None, 3, "z"), ("a", None, 2, "y"), ("a", 1, 5, "x"), (None, None, 9, "w")]
    df = spark.createDataFrame(rows, "k string, v int, id int, rest string")
    got = dedupe.dedupe(df, ["k", "v"], ["id"]).collect()
    assert {tuple(r) for r in got} == {("a", None, 2, "y"), ("a", 1, 5, "x"), (None, None, 9, "w")}
    newest = dedupe.dedupe(df, ["k", "v"], [-F.col("id")]).collect()
    assert ("a", None, 3, "z") in {tuple(r) for r in newest}


def test_quality_audit(spark):
    raw = ticks(
        spark,
        [("a", "1", T1, 1), ("a", "1", T1, 2), ("a", None, T1, 3), ("a", "-4", T1, 4)]
        + [("b", "0", T1, i) for i in range(5, 8)],
    )
    got = dedupe.quality_audit(raw, ["ts", "entity", "price"]).first()
    assert tuple(got) == (7, 1, 4, 1, 1)
    empty = dedupe.quality_audit(raw.where("false"), ["ts", "entity", "price"]).first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


def test_times(spark):
    df = spark.createDataFrame(
        [
            ("Mon, 11 May 2026 09:33:44 +0700", "2026-05-11T16:40:19.388313+07:00"),
            ("11 May 2026 02:33:44 GMT", "2026-05-11T09:40:19.388313"),
            ("never", ""),
        ],
        "feed string, iso string",
    )
    rows = df.select(parse_feed_time("feed").alias("f"), parse_time("iso").alias("i")).collect()
    feed = dt.datetime(2026, 5, 11, 2, 33, 44)
    iso = dt.datetime(2026, 5, 11, 9, 40, 19, 388313)
    assert [tuple(r) for r in rows] == [(feed, iso), (feed, iso), (None, None)]
    shown = df.limit(1).select(local_time(F.lit("2026-05-11 02:33:44")).alias("t")).first()
    assert shown.t == dt.datetime(2026, 5, 11, 9, 33, 44)
    parts = with_date_parts(df.select(parse_time("iso").alias("ts"))).collect()
    assert parts[1].hour == 9 and parts[2].hour is None


def test_numbers(spark):
    df = spark.createDataFrame(
        [(105.0, 100.0), (1.0, 0.0), (1.0, None)], "new double, old double"
    )
    pct = [r[0] for r in df.select(pct_change("new", "old")).collect()]
    assert pct == [5.0, 0.0, None]
    bands = spark.createDataFrame([(0.3,), (0.31,), (-0.31,), (None,)], "p double")
    assert [r[0] for r in bands.select(trend_band("p")).collect()] == ["flat", "up", "down", "flat"]
    scores = spark.createDataFrame([(0.7,), (0.4,), (0.39,), (float("nan"),), (None,)], "r double")
    assert [r[0] for r in scores.select(r2_band("r")).collect()] == [
        "good",
        "medium",
        "low",
        "low",
        "low",
    ]
    half = spark.createDataFrame([(2.5,), (3.5,)], "x double")
    assert [r.x for r in round_for_report(half, {"x": 0}).collect()] == [2.0, 4.0]


def test_ingest_meta(spark):
    row = clean.with_ingest_meta(spark.range(1), "api").first()
    assert row["_source"] == "api" and row["_ingested_at"] is not None


def test_known_tables_agree():
    assert set(dimensions.BASELINES) == set(dimensions.ENTITY_KEYWORDS)
    assert len(dimensions.TOPIC_KEYWORDS) == 19
    assert schemas.json_schema(schemas.RAW_TICK, schemas.TICK_FIELDS).names == list(
        schemas.TICK_FIELDS
    )


def test_observed_quality(spark):
    raw = ticks(spark, [("a", "1", T1, 1), ("a", None, T1, 2), ("a", "-4", T1, 3)])
    seen = Observation("quality")
    dedupe.observe_quality(raw, seen).count()
    assert seen.get == {"rows_read": 3, "null_price": 1, "non_positive": 1}
