"""Small reference tables: entities, keywords, aliases and link rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom import schemas

# Baseline price per entity.
BASELINES = {
    "Beras": 13500.0,
    "Jagung": 6500.0,
    "Kedelai": 14000.0,
    "Gula Pasir": 16500.0,
    "Minyak Goreng": 19000.0,
    "Cabai Merah": 45000.0,
    "Bawang Merah": 38000.0,
    "Telur Ayam": 29000.0,
}

# Keywords that mention an entity.
ENTITY_KEYWORDS = {
    "Beras": ["beras"],
    "Jagung": ["jagung"],
    "Kedelai": ["kedelai"],
    "Gula Pasir": ["gula", "gula pasir"],
    "Minyak Goreng": ["minyak goreng", "minyak"],
    "Cabai Merah": ["cabai", "cabai merah"],
    "Bawang Merah": ["bawang merah", "bawang"],
    "Telur Ayam": ["telur", "telur ayam"],
}

# Other spellings of an entity.
ALIASES = {"beras medium": "Beras", "beras": "Beras"}

# An article is on topic if it holds one of these.
TOPIC_KEYWORDS = [
    "pangan",
    "sembako",
    "beras",
    "padi",
    "gabah",
    "bulog",
    "gula",
    "minyak goreng",
    "cabai",
    "cabe",
    "bawang",
    "telur",
    "ayam",
    "daging",
    "sapi",
    "ikan",
    "kedelai",
    "jagung",
    "pupuk",
]

# Source, host suffix, denied host prefixes, denied path segments.
LINK_RULES = [
    ("cnnindonesia.com", "cnnindonesia.com", [], []),
    ("antaranews.com", "antaranews.com", ["otomotif."], []),
    (
        "bisnis.com",
        "bisnis.com",
        ["bola.", "sport.", "otomotif.", "tekno.", "travel.", "lifestyle."],
        ["/bola/", "/otomotif/", "/sport/", "/tekno/", "/travel/", "/lifestyle/"],
    ),
]


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """Rows held in the plan itself.

    Through Arrow Spark keeps them as a local relation, whose exact size it
    knows, so its own threshold decides on a broadcast.
    """
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def alias_table(
    spark: SparkSession,
    aliases: Mapping[str, str] = ALIASES,
    entities: Iterable[str] = tuple(BASELINES),
) -> DataFrame:
    """alias -> entity; every entity is also its own lower-case alias."""
    rows = {name.lower(): name for name in entities}
    rows.update({alias: rows.get(target.lower(), target) for alias, target in aliases.items()})
    return literal_table(spark, sorted(rows.items()), schemas.ALIAS)


def baseline_table(spark: SparkSession, baselines: Mapping[str, float] = BASELINES) -> DataFrame:
    rows = [(name, float(price)) for name, price in baselines.items()]
    return literal_table(spark, rows, schemas.BASELINE)


def keyword_table(
    spark: SparkSession, keywords: Mapping[str, Iterable[str]] = ENTITY_KEYWORDS
) -> DataFrame:
    rows = [(entity, word) for entity, words in keywords.items() for word in words]
    return literal_table(spark, rows, schemas.KEYWORD)


def link_rule_table(spark: SparkSession, rules: Iterable[tuple] = tuple(LINK_RULES)) -> DataFrame:
    return literal_table(spark, rules, schemas.LINK_RULE)
