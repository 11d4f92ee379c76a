from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import versions
from tickloom.sources import readers, sinks

TICK = {
    "komoditas": "Beras",
    "harga": 13500.0,
    "harga_sebelumnya": 13400,
    "perubahan_persen": 0.7463,
    "harga_baseline": 13500,
    "unit": "kg",
    "timestamp": "2026-05-07T11:36:12.000001",
    "sumber": "x",
    "kota": "Nasional",
}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_lines(spark, tmp_path):
    write(tmp_path / "a" / "1.json", json.dumps(TICK) + "\nnot json\n")
    write(tmp_path / "a" / "2.json", json.dumps({**TICK, "harga": "12"}) + "\n")
    df = readers.read_jsonl(spark, str(tmp_path / "a"), schemas.RAW_TICK, schemas.TICK_FIELDS)
    assert df.columns == schemas.RAW_TICK.names
    assert sorted(r.price for r in df.collect()) == ["12", "13500.0"]
    kept = readers.read_jsonl(
        spark, str(tmp_path / "a"), schemas.RAW_TICK, schemas.TICK_FIELDS, bad_rows="bad"
    )
    assert [r.bad for r in kept.where("bad is not null").collect()] == ["not json"]


def test_json_arrays(spark, tmp_path):
    def read(text):
        path = write(tmp_path / str(len(list(tmp_path.iterdir()))) / "x.json", text)
        return readers.read_json_array(
            spark, path, schemas.RAW_TICK, schemas.TICK_FIELDS, position="n"
        ).collect()

    rows = read(json.dumps([TICK, 5, "text", None, {**TICK, "komoditas": "Jagung"}], indent=2))
    assert [(r.entity, r.n) for r in rows] == [("Beras", 0), ("Jagung", 4)]
    assert read("[{broken") == [] and read(json.dumps(TICK)) == [] and read("") == []
    missing = readers.read_json_array(spark, str(tmp_path / "no.json"), schemas.RAW_NEWS)
    assert missing.isEmpty() and missing.columns == schemas.RAW_NEWS.names


def test_arrays_with_an_object_a_line(spark, tmp_path):
    def read(name, text, position="n"):
        path = write(tmp_path / name / "x [1].json", text)
        del path
        return readers.read_json_array(
            spark, str(tmp_path / name), schemas.RAW_TICK, schemas.TICK_FIELDS, position=position
        )

    objects = [json.dumps({**TICK, "komoditas": f"e{i}"}) for i in range(3000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        for name, text in (
            ("a", "[" + ",\n".join(objects) + "]"),
            ("b", "[\n" + " ,\r\n  ".join(objects) + "\n]\n\n"),
        ):
            df = read(name, text)
            assert df.where("entity is not null").rdd.getNumPartitions() > 4
            assert {r.n: r.entity for r in df.collect()} == {i: f"e{i}" for i in range(3000)}
        assert read("c", "[" + ",\n".join(objects) + "]", None).count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    one, two = objects[:2]

    def entities(name, text):
        return [(r.entity, r.n) for r in read(name, text).collect()]

    # Read as a whole: several objects on a line, other elements between.
    assert sorted(entities("d", f"[{one}, {two},\n{one}]")) == [("e0", 0), ("e0", 2), ("e1", 1)]
    assert sorted(entities("e", f"[{one},\n[{two}],\n5,\n{two}]")) == [("e0", 0), ("e1", 3)]
    # Broken files give no rows.
    for i, text in enumerate(
        (f"[{one}\n{two}]", f"[{one},\n{two}", f"{one},\n{two}]", f"[{one},\n,\n{two}]", f"[{one},\n{two[:-3]}]")
    ):
        assert entities(f"broken{i}", text) == []
    assert entities("f", "[\n]") == [] and entities("g", f"\n[{one}]") == [("e0", 0)]


def test_first_available(spark, tmp_path):
    array = write(tmp_path / "live.json", json.dumps([TICK]))
    write(tmp_path / "store" / "1.json", json.dumps({**TICK, "komoditas": "Kedelai"}) + "\n")
    lines = ("lines", str(tmp_path / "store"))

    def first(sources):
        df = readers.read_first_available(spark, sources, schemas.RAW_TICK, schemas.TICK_FIELDS)
        return [r.entity for r in df.collect()]

    assert first([lines, ("array", array)]) == ["Kedelai"]
    assert first([("lines", str(tmp_path / "gone")), ("array", array)]) == ["Beras"]
    assert first([("lines", str(tmp_path / "gone"))]) == []


def test_feed_items(spark, tmp_path):
    feed = """<rss><channel><title>c</title>
    <item><title>A &amp; B</title><link> https://x/1 </link>
      <description>&lt;p&gt;Beras&lt;/p&gt;</description>
      <pubDate>Mon, 11 May 2026 09:33:44 +0700</pubDate></item>
    <item><title>no link</title></item>
    <item><link>https://x/2</link></item></channel></rss>"""
    path = write(tmp_path / "feed.xml", feed)
    rows = {r.link: r for r in readers.read_feed_items(spark, path, "x").collect()}
    assert set(rows) == {"https://x/1", "https://x/2"}
    one = rows["https://x/1"]
    assert (one.title, one.summary, one.source) == ("A & B", "<p>Beras</p>", "x")
    assert one.published == dt.datetime(2026, 5, 11, 2, 33, 44)
    two = rows["https://x/2"]
    assert two.title == "" and two.published == two.fetched_at


def test_freshness(spark, tmp_path):
    path = write(tmp_path / "d" / "x.json", "x" * 2048)
    got = readers.file_freshness(spark, {"live": path, "gone": str(tmp_path / "gone")}).collect()
    by = {r.dataset: r for r in got}
    assert by["live"].exists and by["live"].size_kb == 2.0 and by["live"].modified is not None
    assert not by["gone"].exists and by["gone"].size_kb is None


def test_topic_roundtrip_with_field_names(spark):
    df = spark.createDataFrame([tuple(str(v) for v in TICK.values())], schemas.RAW_TICK)
    sent = sinks.encode_topic(df, "entity", schemas.TICK_FIELDS)
    row = sent.first()
    assert row.key == "Beras" and json.loads(row.value)["komoditas"] == "Beras"
    raw = sent.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    back = readers.decode_topic(raw, schemas.RAW_TICK, schemas.TICK_FIELDS)
    assert back.drop("_key").collect() == df.collect()
    assert back.first()["_key"] == "Beras"


def test_count_trigger():
    assert readers.count_trigger(8, "30s") == {
        "minOffsetsPerTrigger": "8",
        "maxTriggerDelay": "30s",
    }


def test_append_is_idempotent_per_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10)
    sinks.append_table(df, path, "b1")
    sinks.append_table(df, path, "b2")
    sinks.append_table(df, path, "b2")
    assert readers.read_table(spark, path).count() == 20
    plain = str(tmp_path / "p")
    sinks.append_table(df.where("false"), path, "b2")
    assert spark.read.parquet(path).count() == df.count()
    sinks.append_table(df, path, "b2")
    sinks.append_table(df, plain)
    sinks.append_table(df, plain)
    assert readers.read_table(spark, plain).count() == 20


def test_overwrite_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).withColumn("d", F.col("id") % 3)
    sinks.overwrite_table(df, path, ["d"])
    sinks.overwrite_table(df.where("d < 2"), path, ["d"])
    assert readers.read_table(spark, path).count() == 67


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "entity string, price double"
    df = spark.createDataFrame([("Jagung", 5500.0), ("Jagung", 7000.0), (None, 1.0)], schema)
    with pytest.raises(ValueError):
        versions.as_of(spark, path)
    assert versions.commit(df, path) == 0
    low = (F.col("entity") == "Jagung") & (F.col("price") < 6000)
    assert versions.update_table(spark, path, low, {"price": F.lit(6000.0)}) == 1
    assert sorted(r.price for r in versions.as_of(spark, path).collect()) == [1.0, 6000.0, 7000.0]
    assert sorted(r.price for r in versions.as_of(spark, path, 0).collect()) == [1.0, 5500.0, 7000.0]
    log = versions.history(spark, path).collect()
    assert [(r.version, r.operation) for r in log] == [(1, "UPDATE"), (0, "WRITE")]
    assert all(r.user and r.ts for r in log)
    with pytest.raises(ValueError):
        versions.as_of(spark, path, 7)


def test_uncommitted_version_is_invisible(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.commit(spark.range(3), path)
    spark.range(99).write.parquet(f"{path}/_version=1")  # a run that died before its commit row
    spark.range(99).write.parquet(f"{path}/_parts/n=1")
    assert versions.as_of(spark, path).count() == 3
    assert versions.commit(spark.range(4), path) == 1
    assert versions.as_of(spark, path).count() == 4


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_update_writes_only_parts_with_matches(spark, tmp_path):
    table = tmp_path / "t"
    path = str(table)
    rows = [("01", 1, 1.0), ("01", 2, 9.0), ("1", 3, 9.0), (None, 4, 1.0), ("", 5, 9.0), ("a/b c", 6, 9.0)]
    df = spark.createDataFrame(rows, "part string, id int, price double")
    assert versions.commit(df, path, partition_by=["part"]) == 0
    before = files_of(table / "_version=0")
    low = F.col("price") < 5
    assert versions.update_table(spark, path, low, {"price": F.lit(5.0)}) == 1
    # Null and empty are one part of a stored table.
    assert {p.name for p in (table / "_version=1").iterdir() if p.is_dir()} == {
        "part=01", "part=__HIVE_DEFAULT_PARTITION__"
    }
    stored_rows = [(p or None, i, x) for p, i, x in rows]
    floored = sorted((p or None, i, max(x, 5.0)) for p, i, x in rows if p) + [(None, 4, 5.0), (None, 5, 9.0)]

    def held(version=None):
        found = versions.as_of(spark, path, version)
        assert found.columns == df.columns and found.schema["part"].dataType == df.schema["part"].dataType
        return sorted(map(tuple, found.collect()), key=lambda r: r[1])

    assert held() == sorted(floored, key=lambda r: r[1])
    assert held(0) == stored_rows
    # Rows move between parts: one part empties, another one gets rows, a new one appears.
    to = F.when(F.col("id") == 3, "01").otherwise("new")
    assert versions.update_table(spark, path, F.col("id").isin(3, 6), {"part": to}) == 2
    moved = {i: (p, x) for p, i, x in held()}
    assert len(moved) == 6 and moved[3] == ("01", 9.0) and moved[6] == ("new", 9.0) and moved[1] == ("01", 5.0)
    parts = {r.part: r._holder for r in versions.parts_of(spark, path, 2).collect()}
    assert parts == {"01": 2, "new": 2, None: 1}
    # Nothing matches: the version shares all parts.
    assert versions.update_table(spark, path, F.lit(None).cast("boolean"), {"price": F.lit(0.0)}) == 3
    assert {i: (p, x) for p, i, x in held(3)} == moved
    assert held(1) == sorted(floored, key=lambda r: r[1])
    # All rows of the last part written go elsewhere; what is left is in older folders.
    assert versions.update_table(spark, path, F.col("part") != "01", {"part": F.lit("01")}) == 4
    assert versions.update_table(spark, path, F.col("part").isNull(), {"price": F.lit(7.0)}) == 5
    assert {(p, i) for p, i, _ in held()} == {("01", 1), ("01", 2), ("01", 3), (None, 4), (None, 5), ("01", 6)}
    assert files_of(table / "_version=0") == before


def test_update_of_tables_without_rows_or_parts(spark, tmp_path):
    empty = spark.createDataFrame([], "d date, v int")
    path = str(tmp_path / "empty")
    versions.commit(empty, path, partition_by=["d"])
    assert versions.update_table(spark, path, F.col("v") > 0, {"v": F.lit(1)}) == 1
    assert versions.as_of(spark, path).schema == empty.schema and versions.as_of(spark, path).isEmpty()
    # A new layout and a new type are written as a whole.
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    path = str(tmp_path / "relaid")
    versions.commit(df, path)
    assert versions.update_table(spark, path, F.col("id") == 4, {"id": F.lit(40).cast("long")}, ["k"]) == 1
    assert versions.update_table(spark, path, F.col("id") == 5, {"id": F.lit(50.5)}) == 2
    assert sorted(r.id for r in versions.as_of(spark, path, 1).collect()) == [0, 1, 2, 3, 5, 6, 7, 8, 9, 40]
    assert 50.5 in {r.id for r in versions.as_of(spark, path).collect()}
    with pytest.raises(ValueError):
        versions.commit(df.withColumnRenamed("k", "_version"), path)


def test_report(spark):
    vol = spark.createDataFrame(
        [("a", 1.0, 2.0), ("b", 9.0, 3.0)], "entity string, volatility_pct double, price_max double"
    )
    trend = spark.createDataFrame(
        [("a", dt.datetime(2026, 1, 2, 3, 4), 5.0), ("a", dt.datetime(2026, 1, 1), 4.0)],
        "entity string, period timestamp, price_avg double",
    )
    rows = sinks.report_rows({"volatility": vol, "trend": trend}, local_names=True)
    labels = ["volatilitas", "tren_harga", "prediksi_mlllib"]
    doc = json.loads("".join(r.line for r in sinks.report_document(rows, labels).collect()))
    assert [v["komoditas"] for v in doc["volatilitas"]] == ["b", "a"]
    assert [t["periode"] for t in doc["tren_harga"]] == ["2026-01-01 00:00", "2026-01-02 03:04"]
    assert doc["prediksi_mlllib"] == [] and doc["generated_at"]
    new = sinks.report_rows({"trend": trend.limit(1)}, local_names=True)
    merged = sinks.merge_report(new, rows, ["tren_harga"])
    assert merged.groupBy("section").count().count() == 2 and merged.count() == 3
    many = spark.range(5000).select(
        F.lit("a").alias("entity"), F.timestamp_seconds("id").alias("period"), F.lit(1.5).alias("price_avg")
    )
    twice = sinks.report_rows({"trend": many.union(many)}, local_names=True)
    doc = json.loads("".join(r.line for r in sinks.report_document(twice, labels).collect()))
    shown = [t["periode"] for t in doc["tren_harga"]]
    assert len(shown) == 10_000 and shown == sorted(shown) and doc["volatilitas"] == []
