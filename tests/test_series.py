from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import aggregate, combine, ranges, series, skew

START = dt.datetime(2024, 1, 1)
SCHEMA = "entity string, ts timestamp, id long, price double, baseline double"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def ticks(spark, rows):
    return spark.createDataFrame([(*r, 100.0) if len(r) == 4 else r for r in rows], SCHEMA)


def skewed(spark, n=3000, seed=5, burst=False):
    """A third or more of the rows has one entity; equal times and unknown times occur."""
    rng = np.random.default_rng(seed)
    entity = np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abcdefgh"), n))
    minute = np.where(rng.random(n) < (0.6 if burst else 0.02), 77, rng.integers(0, 500, n))
    rows = []
    for i in range(n):
        ts = None if rng.random() < 0.01 else at(int(minute[i]))
        price = None if rng.random() < 0.02 else float(rng.integers(1, 50))
        rows.append((str(entity[i]), ts, int(i), price))
    return ticks(spark, rows)


def pandas_sorted(df):
    pdf = df.toPandas()
    pdf["_null_first"] = pdf.ts.notna()
    return pdf.sort_values(["entity", "_null_first", "ts", "id"]).reset_index(drop=True)


@pytest.mark.parametrize("burst", [False, True])
@pytest.mark.parametrize("n", [1, 2])
@pytest.mark.parametrize("chunks", [2, 7, 40])
def test_split_lag_equals_plain_lag(spark, burst, n, chunks):
    df = skewed(spark, burst=burst)
    want = pandas_sorted(df)
    want["prev"] = want.groupby("entity").price.shift(n)
    got = ranges.previous_value(df, "price", "prev", n, chunks=chunks).toPandas()
    merged = want.merge(got, on="id", suffixes=("", "_got"))
    assert len(got) == len(want) == len(merged)
    pd.testing.assert_series_equal(merged.prev, merged.prev_got, check_names=False)


@pytest.mark.parametrize("burst", [False, True])
def test_split_position_equals_plain_position(spark, burst):
    df = skewed(spark, burst=burst)
    want = pandas_sorted(df)
    want["idx"] = want.groupby("entity").cumcount()
    want["total"] = want.groupby("entity").id.transform("count")
    got = skew.position(df, chunks=9).toPandas().merge(want[["id", "idx", "total"]], on="id")
    assert (got.time_idx == got.idx).all() and (got.n_total == got.total).all()


def test_unknown_times_and_text_ids_are_split_too(spark):
    no_time = skewed(spark).withColumn("ts", F.lit(None).cast("timestamp"))
    cut, hot = skew.with_chunks(no_time, "entity", ["ts", "id"], 10)
    assert "hot" in hot
    sizes = cut.where("entity = 'hot'").groupBy(skew.CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] < no_time.count() / 5
    for df in (no_time, skewed(spark, burst=True).withColumn("id", F.format_string("%05d", "id"))):
        want = pandas_sorted(df)
        want["prev"] = want.groupby("entity").price.shift(1)
        got = ranges.previous_value(df, "price", "prev", 1, chunks=10).toPandas()
        merged = want.merge(got, on="id", suffixes=("", "_got"))
        pd.testing.assert_series_equal(merged.prev, merged.prev_got, check_names=False)


def test_chunks_are_small_and_ordered(spark):
    df = skewed(spark, burst=True)
    cut, hot = skew.with_chunks(df, "entity", ["ts", "id"], 20)
    assert "hot" in hot
    sizes = cut.where("entity = 'hot'").groupBy(skew.CHUNK).count().toPandas()
    assert sizes["count"].max() < df.where("entity = 'hot'").count() / 5
    pdf = pandas_sorted(cut)
    assert (pdf[pdf.entity == "hot"][skew.CHUNK].diff().dropna() >= 0).all()


def test_default_plan_splits_hot_keys_at_any_size(spark):
    df = spark.range(100).select(
        F.lit("a").alias("entity"),
        F.timestamp_seconds("id").alias("ts"),
        "id",
        F.col("id").cast("double").alias("price"),
    )
    cut, hot = skew.with_chunks(df, "entity", ["ts", "id"])
    assert hot == ["a"] and cut.select(skew.CHUNK).distinct().count() > 1


def test_hot_keys(spark):
    rows = [("a",)] * 60 + [("b",)] * 30 + [(f"k{i}",) for i in range(9)] + [(None,)]
    df = spark.createDataFrame(rows, "entity string")
    assert set(skew.key_and_time(df, "entity", F.lit(1.0), 4, 1000)[0]) == {"a", "b"}
    assert skew.key_and_time(df.where("false"), "entity", F.lit(1.0), 4, 0) == ([], [])


def test_unknown_entity_is_split_too(spark):
    df = skewed(spark).withColumn("entity", F.when(F.col("entity") != "hot", F.col("entity")))
    cut, hot = skew.with_chunks(df, "entity", ["ts", "id"], 10)
    assert None in hot
    sizes = cut.where("entity is null").groupBy(skew.CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] < df.count() / 5
    want = pandas_sorted(df)
    groups = want.groupby("entity", dropna=False)
    want["prev"], want["idx"] = groups.price.shift(1), groups.cumcount()
    got = skew.position(ranges.previous_value(df, "price", "prev", 1, chunks=10), chunks=10)
    merged = want.merge(got.toPandas(), on="id", suffixes=("", "_got"))
    pd.testing.assert_series_equal(merged.prev, merged.prev_got, check_names=False)
    assert (merged.idx == merged.time_idx).all()


def test_more_chunks_than_borders(spark, monkeypatch):
    monkeypatch.setattr(skew, "BORDERS", 8)
    df = skewed(spark, burst=True)
    cut, _ = skew.with_chunks(df, "entity", ["ts", "id"], 40)
    pdf = pandas_sorted(cut)
    chunks = pdf[pdf.entity == "hot"][skew.CHUNK]
    assert (chunks.diff().dropna() >= 0).all() and chunks.nunique() > 16
    want = pandas_sorted(df)
    want["prev"] = want.groupby("entity").price.shift(2)
    got = ranges.previous_value(df, "price", "prev", 2, chunks=40).toPandas()
    merged = want.merge(got, on="id", suffixes=("", "_got"))
    pd.testing.assert_series_equal(merged.prev, merged.prev_got, check_names=False)


def test_sampled_borders_give_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLE_PER_CHUNK", 10)
    monkeypatch.setattr(ranges, "input_bytes", lambda df: 50_000)
    df = skewed(spark, burst=True)
    want = pandas_sorted(df)
    want["prev"] = want.groupby("entity").price.shift(1)
    got = ranges.previous_value(df, "price", "prev", 1, chunks=25).toPandas()
    merged = want.merge(got, on="id", suffixes=("", "_got"))
    pd.testing.assert_series_equal(merged.prev, merged.prev_got, check_names=False)
    sizes = skew.with_chunks(df, "entity", ["ts", "id"], 25)[0].groupBy("entity", skew.CHUNK)
    assert sizes.count().agg(F.max("count")).first()[0] < df.count() / 5


def test_alert_edges(spark):
    df = ticks(
        spark,
        [
            ("a", at(0), 1, 100.0),
            ("a", at(1), 2, 105.0),  # exactly +5
            ("a", at(2), 3, 99.75),  # exactly -5
            ("a", at(3), 4, 104.75),  # +5.01
            ("a", at(3), 5, 90.0),  # equal time, later id
            ("b", at(0), 6, 1.0),  # first of its entity
        ],
    )
    got = {r.id: (r.alert, r.prev_price) for r in series.alerts(df).collect()}
    assert got == {4: ("up", 99.75), 5: ("down", 104.75)}
    assert aggregate.alert_summary(series.alerts(df)).count() == 2
    changes = series.price_changes(df)
    assert changes.count() == df.count()
    assert changes.where("id in (1, 6) and pct_change is null").count() == 2


def test_two_back_starts_from_baseline(spark):
    df = ticks(spark, [("a", at(i), i, p, 50.0) for i, p in enumerate([60.0, 80.0, 90.0, 40.0])])
    got = [r.prev_price for r in series.two_back_changes(df).orderBy("id").collect()]
    assert got == [50.0, 50.0, 60.0, 80.0]
    split = series.two_back_changes(df, chunks=3).orderBy("id").collect()
    assert [r.prev_price for r in split] == got


def test_trend_filled_covers_every_entity_and_period(spark):
    rows = [
        ("a", at(1), 1, 10.0),
        ("a", at(1), 2, 20.0),
        ("a", at(60 * 30), 3, 40.0),
        ("b", at(60 * 24), 4, 7.0),
        ("x", at(5), 5, 1.0),  # not a known entity: adds no period
        ("a", None, 6, 99.0),  # no time: no period
    ]
    dim = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "entity string, baseline double")
    filled = series.trend_filled(aggregate.trend(ticks(spark, rows)), dim)
    got = {(r.entity, r.period): r.price_avg for r in filled.collect()}
    p1, p2, p3 = at(1), at(60 * 24), at(60 * 30)
    assert got == {
        ("a", p1): 15.0,
        ("a", p2): 15.0,
        ("a", p3): 40.0,
        ("b", p1): 2.0,
        ("b", p2): 7.0,
        ("b", p3): 7.0,
        ("c", p1): 3.0,
        ("c", p2): 3.0,
        ("c", p3): 3.0,
    }
    assert filled.count() == 9


def test_trend_filled_equals_pandas(spark):
    df = skewed(spark, 800).where("ts is not null and price is not null")
    tr = aggregate.trend(df)
    dim = df.groupBy("entity").agg(F.max("price").alias("baseline"))
    wide = tr.toPandas().pivot(index="period", columns="entity", values="price_avg").ffill()
    base = dim.toPandas().set_index("entity").baseline
    want = wide.fillna(base).stack()
    got = series.trend_filled(tr, dim).toPandas().set_index(["period", "entity"]).price_avg
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False)


def test_volatility_rules(spark):
    df = ticks(
        spark, [("a", at(0), 1, 10.0), ("a", at(1), 2, 15.0), ("b", at(0), 3, 4.0), ("z", at(0), 4, 0.0)]
    )
    got = {r.entity: r.volatility_pct for r in aggregate.volatility(df).collect()}
    assert got == {"a": 50.0, "b": 0.0, "z": 0.0}
    shares = aggregate.volatility_share(aggregate.volatility(df)).collect()
    assert {r.entity: r.share_pct for r in shares} == {"a": 100.0, "b": 0.0, "z": 0.0}
    flat = aggregate.volatility_share(aggregate.volatility(df.where("entity = 'b'")))
    assert flat.first().share_pct == 0.0
    assert [r.entity for r in aggregate.ranked(aggregate.volatility(df)).collect()] == ["a", "b", "z"]


def test_latest_prices(spark):
    df = ticks(spark, [("a", at(0), 1, 10.0), ("a", at(5), 2, 12.0), ("new", at(1), 3, 9.0)])
    df = df.withColumns({"pct_change": F.lit(0.31), "region": F.lit("Kota")})
    dim = spark.createDataFrame([("a", 1.0), ("c", 3.0)], "entity string, baseline double")
    got = {r.entity: r for r in aggregate.latest_prices(df, dim).collect()}
    assert (got["a"].price, got["a"].trend, got["a"].region) == (12.0, "up", "Kota")
    assert got["new"].price == 9.0 and got["new"].baseline == 100.0
    c = got["c"]
    assert (c.price, c.pct_change, c.trend, c.region, c.ts) == (3.0, 0.0, "flat", "Nasional", None)
    by_arrival = aggregate.latest_prices(df.withColumn("n", -F.col("id")), dim, ["n"])
    assert {r.entity: r.price for r in by_arrival.collect()}["a"] == 10.0


def test_price_flash(spark):
    schema = "entity string, price double"
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("z", 0.0)], schema)
    new = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 3.0), ("d", 4.0), ("z", 1.0)], schema)
    got = {r.entity: r.flash for r in aggregate.price_flash(old, new).collect()}
    assert got == {"a": "up", "b": "down", "c": "", "d": "", "z": ""}


def test_trend_matrix(spark):
    rows = [("a", at(i), i, float(i)) for i in range(20)] + [("b", at(18), 99, 5.0)]
    matrix = aggregate.trend_matrix(aggregate.trend(ticks(spark, rows)), ["a", "b"], 12)
    got = {r.period: (r.a, r.b) for r in matrix.collect()}
    assert sorted(got) == [at(i) for i in range(8, 20)]
    assert got[at(18)] == (18.0, 5.0) and got[at(19)] == (19.0, None)


def test_trend_matrix_has_the_entities_that_occur(spark):
    tr = aggregate.trend(ticks(spark, [("a", at(0), 1, 1.0), ("new", at(0), 2, 2.0)]))
    assert aggregate.trend_matrix(tr).columns == ["period", "a", "new"]


def test_compare_versions_with_repeated_keys(spark):
    schema = "entity string, ts int, price double"
    a = spark.createDataFrame([("x", 1, 5.0), ("x", 1, 4.0), ("x", 1, 9.0), ("y", 1, 1.0)], schema)
    b = spark.createDataFrame([("x", 1, 6.0), ("x", 1, 6.0), ("x", 1, 9.0), ("y", 1, 1.0)], schema)
    found = combine.compare_versions(a, b, ["entity", "ts"], ["price"]).collect()
    assert sorted((r.price_before, r.price_after, r.change) for r in found) == [
        (4.0, 6.0, "changed"),
        (5.0, 6.0, "changed"),
    ]


def test_known_entities_without_news(spark):
    df = ticks(spark, [("Beras", at(0), 1, 1.0)]).withColumn("pct_change", F.lit(2.0))
    got = aggregate.keyword_correlation(df, None, {"Beras": ["beras"], "Jagung": ["jagung"]})
    assert sorted(map(tuple, got.collect())) == [("Beras", 0, 2.0), ("Jagung", 0, 0.0)]


def test_recent(spark):
    df = ticks(spark, [("a" if i % 3 else "b", at(i), i, float(i)) for i in range(30)])
    assert [r.id for r in series.recent(df, 3).collect()] == [29, 28, 27]
    per = series.recent_per_entity(df, 2).collect()
    assert sorted(r.id for r in per) == [24, 27, 28, 29]


def test_merge_priority(spark):
    schema = "entity string, ts timestamp, price double, arrival long"
    live = spark.createDataFrame([("a", at(0), 1.0, 1), ("a", at(0), 2.0, 2)], schema)
    past = spark.createDataFrame(
        [("a", at(0), 9.0, 1), ("a", at(1), 3.0, 1), ("a", at(1), 4.0, 2)], schema
    )
    got = combine.merge_priority(live, past).collect()
    assert sorted((r.ts, r.price) for r in got) == [(at(0), 2.0), (at(1), 3.0)]


def test_compare_versions(spark):
    schema = "id int, price double, note string"
    a = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "x"), (3, None, "y"), (4, 4.0, "q")], schema)
    b = spark.createDataFrame([(1, 1.0, None), (2, 5.0, "x"), (3, 3.0, "y"), (9, 9.0, None)], schema)
    got = {r.id: r.change for r in combine.compare_versions(a, b, ["id"], ["price", "note"]).collect()}
    assert got == {2: "changed", 3: "changed", 4: "removed", 9: "added"}
    assert combine.compare_versions(a, a, ["id"], ["price", "note"]).isEmpty()


def test_split_by_time(spark):
    rows = [(e, at(i), i, 1.0) for e, n in (("four", 4), ("five", 5), ("ten", 10)) for i in range(n)]
    out = series.split_by_time(series.ml_features(ticks(spark, rows)))
    got = {r.entity: (r.n_train, r.n_total) for r in out.collect()}
    assert got == {"five": (4, 5), "ten": (8, 10)}
    assert out.where("is_train").groupBy("entity").count().orderBy("entity").collect()[0]["count"] == 4


def test_unreadable_time_is_hour_zero(spark):
    out = series.ml_features(ticks(spark, [("a", None, 1, 1.0), ("a", at(180), 2, 1.0)])).orderBy("id")
    assert [(r.time_idx, r.hour) for r in out.collect()] == [(0, 0), (1, 3)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_lag_of_short_entities_over_many_ranges(spark, n):
    """Entities that span several ranges, end inside one or are shorter than the lag."""
    sizes = {"a": 1, "b": 2, "c": 5, "d": 40, None: 3, "e": 1, "f": 17}
    rows = [(e, None if i == 0 else i, i, float(i)) for e, size in sizes.items() for i in range(size)]
    df = spark.createDataFrame(rows, "entity string, ts int, id int, price double").repartition(3)
    for parts in (1, 4, 30, 200):
        found = ranges.previous_value(df, "price", "prev", n, chunks=parts).collect()
        assert len(found) == len(rows)
        assert all(r.prev == (r.price - n if r.price >= n else None) for r in found)
    both = ranges.previous_value(df, "price", "prev", n, chunks=5)
    twice = both.unionByName(both).collect()
    assert all(r.prev == (r.price - n if r.price >= n else None) for r in twice)
    assert ranges.previous_value(df.limit(0), "price", "prev", n).count() == 0


def test_lag_reads_one_exchange_of_the_rows(spark):
    df = ranges.previous_value(skewed(spark), "price", "prev", 2, chunks=6)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    # The second one is the same exchange, used again.
    assert final.count("Exchange rangepartitioning") == 2 and final.count("ReusedExchange") == 1


def test_latest_row_by_hash(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        ts = None if rng.random() < 0.1 else at(int(rng.integers(0, 5)) - 2)
        ident = None if rng.random() < 0.1 else int(rng.integers(-3, 3))
        rows.append((rng.choice(["a", "b", None]), ts, ident, int(rng.integers(-2, 2)), int(rng.integers(0, 9)), float(i)))
    df = spark.createDataFrame(rows, "entity string, ts timestamp, id long, line int, supplier long, price double")
    order = ["ts", "id", "line", "supplier"]
    got = aggregate.newest(df, order)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    least = dt.datetime.min

    def key(r):
        return (r[1] is not None, r[1] or least, r[2] is not None, r[2] or 0, r[3], r[4])

    for entity, *found in got.select("entity", *order, "price").collect():
        mine = [r for r in rows if r[0] == entity]
        top = max(map(key, mine))
        assert tuple(found) in {r[1:] for r in mine if key(r) == top}
    assert got.count() == 3
    text = aggregate.newest(df.withColumn("note", F.lit("x")), order)
    assert text.count() == 3 and "note" in text.columns


def test_gap_filling_splits_a_hot_entity(spark):
    periods = [dt.datetime(2026, 1, 1) + dt.timedelta(minutes=i) for i in range(600)]
    hot = [("hot", p, float(i)) for i, p in enumerate(periods) if i % 3]
    rare = [("rare", periods[i], 1000.0 + i) for i in (7, 300)]
    tr = spark.createDataFrame([*hot, *rare, (None, periods[0], 5.0)], "entity string, period timestamp_ntz, price_avg double")
    dim = spark.createDataFrame([("hot", -1.0), ("rare", -2.0), ("none", -3.0), (None, -4.0)], "entity string, baseline double")
    want = {}
    for name, baseline in (("hot", -1.0), ("rare", -2.0), ("none", -3.0), (None, -4.0)):
        known, price = {p: x for e, p, x in [*hot, *rare] if e == name}, baseline
        for p in sorted({p for _, p, _ in [*hot, *rare]} | {periods[0]}):
            price = known.get(p, price)
            want[name, p] = price
    for chunks in (None, 1, 16):
        filled = series.trend_filled(tr, dim, chunks=chunks)
        # A null entity of the trend joins none of the dimension, so its period is not one.
        got = {(r.entity, r.period): r.price_avg for r in filled.collect()}
        assert got == {k: v for k, v in want.items() if k[1] != periods[0]}
    spread = filled.where("entity = 'hot'").select(F.spark_partition_id().alias("task"))
    assert spread.distinct().count() > 1


def test_blocks_of_more_entities_than_a_pivot_can_hold(spark):
    hour = lambda h: dt.datetime(2026, 1, 1, h)
    many = spark.range(10_500).select(
        F.format_string("e%06d", "id").alias("entity"), F.lit(hour(5)).cast("timestamp_ntz").alias("period"), F.col("id").cast("double").alias("price_avg")
    )
    few = spark.createDataFrame(
        [(None, hour(4), 1.5), ("e000000", hour(4), 2.5), ("old", hour(1), 9.0)],
        "entity string, period timestamp_ntz, price_avg double",
    )
    blocks = aggregate.trend_blocks(many.unionByName(few), n=2, width=100).orderBy("block", "period").collect()
    assert len(blocks) == 212 and [len(r.entities) for r in blocks[-2:]] == [1, 1]
    assert all(len(r.entities) == len(r.prices) == 100 for r in blocks[:-2])
    first, second = blocks[:2]
    assert first.entities[:3] == [None, "e000000", "e000001"] and first.period == hour(4)
    assert first.prices[:3] == [1.5, 2.5, None] and second.prices[:3] == [None, 0.0, 1.0]
    names = [e for r in blocks if r.period == hour(5) for e in r.entities]
    assert names == [None, *[f"e{i:06d}" for i in range(10_500)]]
    assert aggregate.trend_blocks(few.limit(0)).isEmpty()
