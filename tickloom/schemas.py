"""Row types of the two event streams and the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


# Field names of the JSON messages and the report document.
TICK_FIELDS = {
    "komoditas": "entity",
    "harga": "price",
    "harga_sebelumnya": "prev_price",
    "perubahan_persen": "pct_change",
    "harga_baseline": "baseline",
    "unit": "unit",
    "timestamp": "ts",
    "sumber": "source",
    "kota": "region",
}
NEWS_FIELDS = {
    "title": "title",
    "link": "link",
    "summary": "summary",
    "published": "published",
    "source": "source",
    "timestamp": "fetched_at",
}
REPORT_FIELDS = {
    "volatility": (
        "volatilitas",
        {
            "entity": "komoditas",
            "price_max": "harga_max",
            "price_min": "harga_min",
            "price_avg": "harga_avg",
            "n": "jumlah_data",
            "volatility_pct": "volatilitas_pct",
        },
    ),
    "trend": (
        "tren_harga",
        {"entity": "komoditas", "period": "periode", "price_avg": "harga_rata"},
    ),
    "correlation": (
        "korelasi_berita",
        {
            "entity": "komoditas",
            "n_news": "frekuensi_berita",
            "avg_change_pct": "avg_perubahan_persen",
        },
    ),
    "models": (
        "prediksi_mlllib",
        {
            "entity": "komoditas",
            "n_total": "n_total",
            "n_train": "n_train",
            "n_test": "n_test",
            "coef_time": "koefisien_waktu",
            "coef_hour": "koefisien_jam",
            "intercept": "intercept",
            "r2_train": "r2_train",
            "rmse_train": "rmse_train",
            "mae_train": "mae_train",
            "r2_test": "r2_test",
            "rmse_test": "rmse_test",
            "mae_test": "mae_test",
            "direction": "tren",
            "forecast": "prediksi_5_step",
            "text": "interpretasi",
        },
    ),
}

# Prices and times arrive as text or numbers; the silver job types them.
RAW_TICK = struct(
    entity="string",
    price="string",
    prev_price="string",
    pct_change="string",
    baseline="string",
    unit="string",
    ts="string",
    source="string",
    region="string",
)
RAW_NEWS = struct(
    title="string",
    link="string",
    summary="string",
    published="string",
    source="string",
    fetched_at="string",
)
ALIAS = struct(alias="string", entity="string")
BASELINE = struct(entity="string", baseline="double")
KEYWORD = struct(entity="string", keyword="string")
LINK_RULE = struct(
    source="string",
    host_suffix="string",
    deny_prefix="array<string>",
    deny_segment="array<string>",
)
COMMIT = struct(version="bigint", ts="timestamp", operation="string", user="string")


def json_schema(schema: T.StructType, fields: dict[str, str]) -> T.StructType:
    """The schema under its JSON field names."""
    wire = {ours: theirs for theirs, ours in fields.items()}
    return T.StructType([T.StructField(wire.get(f.name, f.name), f.dataType) for f in schema])
FILE = struct(length="bigint", modificationTime="timestamp")
