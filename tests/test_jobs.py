"""The layers from raw files to the report."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from tickloom import dimensions
from tickloom.__main__ import main as cli
from tickloom.operators import versions
from tickloom.plans import jobs

SECTIONS = ["volatilitas", "tren_harga", "korelasi_berita", "prediksi_mlllib"]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    ticks = []
    for i in range(12):
        for k, (entity, price) in enumerate(dimensions.BASELINES.items()):
            name = "Beras Medium" if entity == "Beras" and i % 2 else entity
            jump = 0.2 if entity == "Cabai Merah" and i == 6 else 0
            move = 1 + ((i * 7 + k) % 5 - 2) / 100 + jump
            ticks.append(
                {
                    "komoditas": name,
                    "harga": round(price * move),
                    "perubahan_persen": (move - 1) * 100,
                    "harga_baseline": price,
                    "unit": "kg",
                    "timestamp": f"2026-05-11T{9 + i // 6:02d}:{i * 7 % 60:02d}:00",
                    "sumber": f"s{i}",
                    "kota": "Nasional",
                }
            )
    news = [
        {"title": "Harga beras", "summary": "naik", "published": "2026-05-11T02:00:00",
         "source": "x", "link": "l1", "timestamp": "2026-05-11T09:00:00+07:00"},
        {"title": "Produk unggulan", "summary": None, "published": "2026-05-11T02:00:00",
         "source": "x", "link": "l2", "timestamp": "2026-05-11T09:00:00+07:00"},
    ]
    (root / "ticks.json").write_text(json.dumps(ticks))
    (root / "news.json").write_text(json.dumps(news))
    base = str(root / "lake")
    for _ in range(2):  # loading a batch twice leaves one copy
        jobs.ingest_raw(
            spark,
            [("lines", str(root / "absent")), ("array", str(root / "ticks.json"))],
            [("array", str(root / "news.json"))],
            base,
            batch_id="2026-05-11",
        )
    jobs.build_clean(spark, base)
    jobs.build_analysis(spark, base)
    jobs.build_models(spark, base)
    return base


def test_a_batch_without_news_runs_through(spark, tmp_path):
    tick = {"komoditas": "Beras", "harga": 1.0, "timestamp": "2026-05-11T02:00:00", "sumber": "s"}
    (tmp_path / "ticks.json").write_text(json.dumps([tick]))
    base = str(tmp_path / "lake")
    jobs.ingest_raw(spark, [("array", str(tmp_path / "ticks.json"))], [], base, batch_id="b")
    jobs.build_clean(spark, base)
    jobs.build_analysis(spark, base, known_only=True)
    found = spark.read.parquet(f"{base}/analysis/correlation")
    assert found.count() == len(dimensions.BASELINES)


def test_clean_layer(spark, base):
    ticks = versions.as_of(spark, f"{base}/clean/ticks")
    assert ticks.count() == 96
    assert {r.entity for r in ticks.select("entity").distinct().collect()} == set(
        dimensions.BASELINES
    )


def test_analysis_layer(spark, base):
    alerts = spark.read.parquet(f"{base}/analysis/alerts").collect()
    assert {a.entity for a in alerts} == {"Cabai Merah"}
    assert [a.alert for a in sorted(alerts, key=lambda a: a.ts)] == ["up", "down"]
    counts = {r.entity: r.n_news for r in spark.read.parquet(f"{base}/analysis/correlation").collect()}
    assert counts["Beras"] == 1 and counts["Gula Pasir"] == 1 and counts["Jagung"] == 0


def document(folder):
    return json.loads("".join(p.read_text() for p in sorted(Path(folder).glob("part-*"))))


def test_report_document(spark, base, tmp_path):
    out = str(tmp_path / "doc")
    jobs.export_report(spark, base, out)
    doc = document(out)
    assert [s for s in doc if s in SECTIONS] == SECTIONS
    assert len(doc["volatilitas"]) == 8 and len(doc["prediksi_mlllib"]) == 8
    widths = [v["volatilitas_pct"] for v in doc["volatilitas"]]
    assert widths == sorted(widths, reverse=True)
    assert set(doc["prediksi_mlllib"][0]) == {
        "komoditas", "n_total", "n_train", "n_test", "koefisien_waktu", "koefisien_jam",
        "intercept", "r2_train", "rmse_train", "mae_train", "r2_test", "rmse_test", "mae_test",
        "tren", "prediksi_5_step", "interpretasi",
    }
    assert [p["step"] for p in doc["prediksi_mlllib"][0]["prediksi_5_step"]] == [1, 2, 3, 4, 5]
    # Rebuilding one part keeps the other.
    jobs.build_analysis(spark, base)
    jobs.export_report(spark, base, out + "2")
    again = document(out + "2")
    assert again["prediksi_mlllib"] == doc["prediksi_mlllib"]


def test_floor_correction(spark, base):
    before = versions.as_of(spark, f"{base}/clean/ticks").where("entity = 'Jagung' and price < 6450")
    n = before.count()
    changed = jobs.correct_floor(spark, base, "Jagung", 6450.0).collect()
    assert len(changed) == n > 0
    assert {(r.change, r.price_after) for r in changed} == {("changed", 6450.0)}
    log = versions.history(spark, f"{base}/clean/ticks").collect()
    assert [r.operation for r in log] == ["UPDATE", "WRITE"]


def test_known_entities_only(spark, base):
    ticks = versions.as_of(spark, f"{base}/clean/ticks")
    news = versions.as_of(spark, f"{base}/clean/news")
    extra = ticks.limit(1).withColumn("entity", F.lit("Kopi"))
    known = dimensions.baseline_table(spark)
    tables = jobs.analyse(ticks.unionByName(extra), news, known=known)
    periods = ticks.select(F.date_trunc("minute", "ts")).distinct().count()
    assert tables["trend"].count() == 8 * periods
    assert tables["volatility"].count() == 8
    counts = {r.entity: r.n_news for r in tables["correlation"].collect()}
    assert set(counts) == set(dimensions.ENTITY_KEYWORDS)
    assert counts["Beras"] == 0  # named in a title only


def test_command_line(spark, base, tmp_path, capsys):
    cli(["--base", base, "analyse", "--known-only"])
    cli(["--base", base, "model", "--penalty", "ridge_sum"])
    cli(["--base", base, "report", str(tmp_path / "doc")])
    cli(["--base", base, "summary"])
    shown = capsys.readouterr().out
    assert "most volatile" in shown and "Cabai Merah" in shown
    doc = document(tmp_path / "doc")
    assert len(doc["korelasi_berita"]) == 8 and len(doc["prediksi_mlllib"]) == 8
    with pytest.raises(SystemExit):
        cli(["--base", base, "ingest", "--ticks", "csv=x"])


def test_without_news(spark, base):
    ticks = versions.as_of(spark, f"{base}/clean/ticks")
    tables = jobs.analyse(ticks, None)
    assert tables["correlation"].isEmpty()
    stored = jobs.model_input(ticks, tables["trend"])
    # Trend rows on the minute of a tick are the tick's own, so none is counted twice.
    assert stored.count() == ticks.select("entity", "ts").distinct().count()


def test_last_record_of_an_array_wins(spark, tmp_path):
    def tick(price, minute=0):
        return {"komoditas": "Beras", "harga": price, "timestamp": f"2026-05-11T09:{minute:02d}:00"}

    records = [tick(14000), tick(15000), tick(13000), tick(14000), tick(12000, 1), tick(12500, 1)]
    (tmp_path / "ticks.json").write_text(json.dumps(records))
    lake = str(tmp_path / "lake")
    jobs.ingest_raw(spark, [("array", str(tmp_path / "ticks.json"))], [], lake, batch_id="b")
    jobs.build_clean(spark, lake)
    ticks = versions.as_of(spark, f"{lake}/clean/ticks")
    assert ticks.count() == 5
    rows = jobs.model_input(ticks).orderBy("ts").collect()
    assert [r.price for r in rows] == [14000.0, 12500.0]
