from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom import dimensions, schemas
from tickloom.operators import aggregate, series
from tickloom.plans import bindings, queries
from tickloom.sources import readers, sinks
from tickloom.streaming import jobs, levels

ONE_FILE = {"max_files": 1}


@pytest.fixture(scope="module")
def tick_files(spark, sf_dir, tmp_path_factory):
    """The events in four files of consecutive time, written one after the other."""
    path = str(tmp_path_factory.mktemp("stream") / "ticks")
    ticks = bindings.event_ticks(spark, sf_dir)
    edges = [0, 8, 15, 23, 99]
    for lo, hi in zip(edges, edges[1:], strict=False):
        part = ticks.where((F.dayofmonth("ts") > lo) & (F.dayofmonth("ts") <= hi))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def late_files(spark, sf_dir, tmp_path_factory):
    """The events in five files without regard to time."""
    path = str(tmp_path_factory.mktemp("stream") / "late")
    bindings.event_ticks(spark, sf_dir).repartition(5, F.xxhash64("id")).write.parquet(path)
    return path


def test_late_files_lose_nothing(spark, late_files, tmp_path):
    ticks = spark.read.parquet(late_files)
    source = readers.stream_table(spark, late_files, **ONE_FILE)
    out = {n: str(tmp_path / n) for n in ("trend", "changes", "archive", "c1", "c2")}
    query = jobs.stream_trend(source, out["trend"], out["c1"], "1 day")
    query.awaitTermination()
    assert levels.current(spark, out["trend"]) == [(1, 0), (0, 4)]
    assert jobs.read_trend(spark, out["trend"]).agg(F.sum("n")).first()[0] == ticks.count()
    jobs.stream_changes(source, out["changes"], out["archive"], out["c2"]).awaitTermination()
    want = series.price_changes(ticks)
    got = jobs.read_changes(spark, out["changes"]).select(want.columns)
    assert rows(got) == rows(want)


def test_late_ticks_repair_only_their_neighbours(spark, sf_dir, tmp_path):
    """Each tick is written once, and again only if its previous one is new."""
    path = str(tmp_path / "ticks")
    ticks = bindings.event_ticks(spark, sf_dir, "user_id")
    ticks.repartition(8, F.xxhash64("id")).write.parquet(path)
    out, archive = str(tmp_path / "out"), str(tmp_path / "archive")
    source = readers.stream_table(spark, path, **ONE_FILE)
    jobs.stream_changes(source, out, archive, str(tmp_path / "ckpt"), threshold=5.0).awaitTermination()
    want = series.alerts(ticks)
    assert rows(jobs.read_changes(spark, out).select(want.columns)) == rows(want)
    written, received = spark.read.parquet(out), spark.read.parquet(f"{archive}/ticks")
    per_batch = written.groupBy("batch").count().join(
        received.groupBy("batch").agg(F.count("*").alias("n")), "batch"
    )
    assert per_batch.count() == 8 and per_batch.where("count > 2 * n").isEmpty()


def test_ticks_that_come_twice_or_without_time(spark, tmp_path):
    path = str(tmp_path / "ticks")
    schema = "entity string, ts timestamp, id long, price double"
    t = dt.datetime(2026, 5, 11, 9)
    for part in ([("a", t, 1, 10.0)], [("a", t, 1, 10.0), ("a", None, 2, 5.0)], [("a", None, 1, 4.0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    out = str(tmp_path / "out")
    source = readers.stream_table(spark, path, **ONE_FILE)
    jobs.stream_changes(source, out, str(tmp_path / "a"), str(tmp_path / "c")).awaitTermination()
    want = series.price_changes(spark.read.parquet(path))
    assert sorted(map(repr, rows(jobs.read_changes(spark, out).select(want.columns), key=repr))) == sorted(
        map(repr, rows(want, key=repr))
    )


def rows(df, key=None):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_changes_equal_the_batch_answer(spark, tick_files, tmp_path):
    out, state, ckpt = (str(tmp_path / n) for n in ("out", "state", "ckpt"))
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        source = readers.stream_table(spark, tick_files, **ONE_FILE)
        jobs.stream_changes(source, out, state, ckpt, chunks=3).awaitTermination()
        got = jobs.read_changes(spark, out)
        want = series.price_changes(spark.read.parquet(tick_files))
        assert rows(got.select(want.columns)) == rows(want)
    assert spark.read.parquet(out).select("batch").distinct().count() == 4


def test_entities_pause_and_return(spark, tmp_path):
    path = str(tmp_path / "ticks")
    schema = "entity string, ts timestamp, id long, price double"
    t = [dt.datetime(2026, 5, 11, 9, m) for m in range(3)]
    for part in (
        [("a", t[0], 1, 100.0), ("b", t[0], 2, 50.0), (None, t[0], 3, 1.0)],
        [("b", t[1], 4, 60.0)],
        [("a", t[2], 5, 90.0), ("c", t[2], 6, 7.0), (None, t[2], 7, 2.0)],
    ):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    out, state, ckpt = (str(tmp_path / n) for n in ("out", "state", "ckpt"))
    source = readers.stream_table(spark, path, **ONE_FILE)
    jobs.stream_changes(source, out, state, ckpt).awaitTermination()
    got = {r.id: r.prev_price for r in jobs.read_changes(spark, out).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 50.0, 5: 100.0, 6: None, 7: 1.0}


def test_replayed_batch_replaces_itself(spark, tick_files, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    steps = []
    source = readers.stream_table(spark, tick_files, **ONE_FILE)
    original = jobs.run_batches

    def twice(sdf, step, checkpoint, mode="append", trigger=None):
        def replay(batch, batch_id):
            step(batch, batch_id)
            step(batch, batch_id)
            steps.append(batch_id)

        return original(sdf, replay, checkpoint, mode, trigger)

    jobs.run_batches = twice
    try:
        jobs.stream_changes(source, out, state, str(tmp_path / "ckpt")).awaitTermination()
    finally:
        jobs.run_batches = original
    assert steps == [0, 1, 2, 3]
    want = series.price_changes(spark.read.parquet(tick_files))
    assert rows(jobs.read_changes(spark, out).select(want.columns)) == rows(want)


def test_trend_equals_the_batch_answer(spark, tick_files, tmp_path):
    source = readers.stream_table(spark, tick_files, **ONE_FILE)
    out = str(tmp_path / "out")
    jobs.stream_trend(source, out, str(tmp_path / "ckpt"), "1 day").awaitTermination()
    got = jobs.read_trend(spark, out)
    ticks = spark.read.parquet(tick_files)
    want = aggregate.trend(ticks, "day").select(
        "entity", F.col("period").cast("timestamp").alias("period"), F.round("price_avg", 8)
    )
    assert rows(got.select("entity", "period", F.round("price_avg", 8))) == rows(want)
    assert got.agg(F.sum("n")).first()[0] == ticks.count()


def test_append_mode_emits_closed_windows_only(spark, tick_files, tmp_path):
    source = readers.stream_table(spark, tick_files, **ONE_FILE)
    out = str(tmp_path / "out")
    stats = jobs.window_stats(source, "1 day", "1 hour")
    query = (
        stats.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    got = spark.read.parquet(out)
    last_day = spark.read.parquet(tick_files).agg(F.max(F.to_date("ts"))).first()[0]
    assert got.where(F.to_date("period") >= F.lit(last_day)).isEmpty()
    full = aggregate.trend(spark.read.parquet(tick_files), "day")
    closed = full.where(F.to_date("period") < F.lit(last_day))
    assert got.count() == closed.count()


def test_first_seen(spark, tmp_path):
    path = str(tmp_path / "links")
    day = dt.datetime(2026, 5, 11)
    first = [("a", day, i) for i in range(50)] + [("b", day, 1)]
    later = [("a", day + dt.timedelta(hours=1), 99), ("c", day, 2)]
    for part in (first, later):
        df = spark.createDataFrame(part, "link string, fetched_at timestamp, n int")
        df.coalesce(1).write.mode("append").parquet(path)
    for salts in (1, 4):
        source = readers.stream_table(spark, path, **ONE_FILE)
        out = str(tmp_path / f"out{salts}")
        query = (
            jobs.first_seen(source, "link", "fetched_at", "1 day", salts)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / f"ckpt{salts}"))
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination()
        got = spark.read.parquet(out)
        assert sorted(r.link for r in got.collect()) == ["a", "b", "c"]
        assert got.columns == ["link", "fetched_at", "n"]
        assert got.where("link = 'a'").first().n < 50


def test_large_tables_arrive_in_more_files(spark, tmp_path, monkeypatch):
    """No task that deals a table out gets a share of it that grows with the table."""
    texts = F.when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.sha2((F.col("id") % 700).cast("string"), 512))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), texts.alias("text"))
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet"))
    monkeypatch.setattr(queries, "FILE_BYTES", size // 14, raising=False)
    monkeypatch.setattr(queries, "scratch_dir", lambda _, name: str(tmp_path / name))
    got = queries.stream_dedupe(spark, str(tmp_path))
    want = docs.select(F.sha2("text", 256)).distinct()
    assert rows(got, key=repr) == rows(want, key=repr)
    out = tmp_path / "stream-dedupe"
    files = [str(f) for f in (out / "source").glob("*.parquet")]
    assert len(files) == 15
    assert max(spark.read.parquet(f).count() for f in files) < 3000 / 5
    offsets = [p.read_text() for p in (out / "ckpt" / "sources" / "0").iterdir() if p.suffix != ".crc"]
    assert sorted(text.count('"path"') for text in offsets) == [5, 5, 5]


def test_ingest_normalises_archives_and_keeps_the_newest(spark, tmp_path):
    source = tmp_path / "topic"
    for i in range(3):
        values = [
            {
                "komoditas": " beras  MEDIUM" if j % 2 else "Jagung",
                "harga": 100.0 + j,
                "timestamp": f"2026-05-0{i + 1}T10:{j:02d}:00",
            }
            for j in range(10)
        ]
        lines = [{"key": v["komoditas"], "value": json.dumps(v)} for v in values]
        df = spark.createDataFrame(lines, "key string, value string")
        df.coalesce(1).write.mode("append").parquet(str(source))
    names = {n: str(tmp_path / n) for n in ("archive", "view", "ckpt")}
    query = jobs.ingest_stream(
        readers.stream_table(spark, str(source), **ONE_FILE),
        schemas.RAW_TICK,
        dimensions.alias_table(spark),
        names["archive"],
        names["view"],
        names["ckpt"],
        fields=schemas.TICK_FIELDS,
        n_recent=12,
    )
    query.awaitTermination()
    archive = spark.read.parquet(names["archive"])
    assert archive.count() == 30
    assert {r.entity for r in archive.select("entity").distinct().collect()} == {"Beras", "Jagung"}
    view = jobs.read_view(spark, names["view"], 12)
    assert view.count() == 12
    assert sorted({r.ts[:10] for r in view.collect()}) == ["2026-05-02", "2026-05-03"]


def test_jsonl_archive_is_exactly_once(spark, tick_files, tmp_path):
    out, ckpt = str(tmp_path / "json"), str(tmp_path / "ckpt")
    for _ in range(2):
        source = readers.stream_table(spark, tick_files, **ONE_FILE)
        sinks.stream_to_jsonl(source, out, ckpt).awaitTermination()
    assert spark.read.json(out).count() == spark.read.parquet(tick_files).count()


def test_refresh_runs_after_enough_rows(spark, tick_files, tmp_path):
    sizes = []
    step = jobs.refresh_after(
        str(tmp_path / "archive"),
        str(tmp_path / "done"),
        lambda rows: sizes.append(rows.count()),
        min_rows=400,
    )
    source = readers.stream_table(spark, tick_files, **ONE_FILE)
    jobs.run_batches(source, step, str(tmp_path / "ckpt")).awaitTermination()
    counts = []
    for lo, hi in ((0, 8), (8, 15), (15, 23), (23, 99)):
        day = F.dayofmonth("ts")
        part = spark.read.parquet(tick_files).where((day > lo) & (day <= hi))
        counts.append(part.count())
    want, total, pending = [], 0, 0
    for n in counts:
        total, pending = total + n, pending + n
        if pending >= 400:
            want.append(total)
            pending = 0
    assert sizes == want and len(want) >= 1


def test_levels_merge_and_replay(spark, tmp_path):
    path = str(tmp_path / "sums")

    def merge(df):
        return df.groupBy("k").agg(F.sum("n").alias("n"))

    def batch(i):
        return spark.createDataFrame([("a", 1), (f"b{i % 3}", 10)], "k string, n long")

    for i in range(33):
        for _ in range(2 if i in (3, 15, 20, 31) else 1):  # some batches run twice
            levels.add(batch(i), path, i, merge)
        total = {r.k: r.n for r in merge(levels.read(spark, path)).collect()}
        assert total["a"] == i + 1 and sum(total.values()) == 11 * (i + 1)
    assert levels.current(spark, path) == [(2, 0), (2, 16), (0, 32)]
    assert len(levels.complete(spark, path)) <= 8
    levels.add(batch(0).where("false"), path, 33, merge)
    assert sum(r.n for r in levels.read(spark, path).collect()) == 11 * 33
