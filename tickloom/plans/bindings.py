"""The driver tables in the shape of ticks, articles and feed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.dimensions import alias_table
from tickloom.sources.readers import read_table

# Words of the invented prose that stand for the event types.
EVENT_KEYWORDS = {
    "view": ["eaux"],
    "click": ["tion"],
    "purchase": ["und"],
    "error": ["lich"],
    "signup": ["ment", "the", "of the"],
}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
TYPE_KEYWORDS = {"medium or promo": ["ediu", "omo"], "small": ["small", "eaux"], "none": ["zzz"]}
TOPIC_WORDS = ["tion", "eaux", "schen", "mente"]
WHOLE_WORDS = ["tion", "that", "oure", "nicht"]
PAGE_RULES = [
    ("com", "example.com", ["blog.", "m."], ["/fr/", "/de/"]),
    ("net", "example.net", ["www."], ["/es/"]),
]
PAGE_SOURCE = r"^[a-z]+://[^/?#]*\.([a-z]+)(?:[/?#]|$)"
LINEITEM_ORDER = ("ts", "id", "line", "supplier")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def event_ticks(spark: SparkSession, sf: str, entity: str = "event_type") -> DataFrame:
    return as_ticks(table(spark, sf, "events"), entity)


def as_ticks(events: DataFrame, entity: str = "event_type") -> DataFrame:
    return events.select(
        F.col(entity).alias("entity"),
        F.col("value").alias("price"),
        "ts",
        F.col("event_id").alias("id"),
    )


def raw_event_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Events as received: loaded twice, in odd spellings, with unusable prices."""
    ticks = event_ticks(spark, sf).select(
        F.col("entity"),
        F.col("price").cast("string").alias("price"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        "id",
    )
    spelled = F.when(F.col("entity") == "view", "Page   VIEW").otherwise(F.upper("entity"))
    variants = F.explode(
        F.array(
            F.struct("entity", "price"),
            F.struct("entity", "price"),
            F.struct(F.concat(F.lit("  "), spelled, F.lit(" ")).alias("entity"), F.col("price")),
            F.struct("entity", F.concat(F.lit("-"), F.col("price")).alias("price")),
            F.struct("entity", F.lit("0").alias("price")),
            F.struct("entity", F.lit(None).cast("string").alias("price")),
        )
    )
    return ticks.select(variants.alias("v"), "ts", "id").select("v.*", "ts", "id")


def event_aliases(spark: SparkSession) -> DataFrame:
    return alias_table(spark, {"page view": "view"}, EVENT_TYPES)


def lineitem_ticks(spark: SparkSession, sf: str, entity: str = "l_partkey") -> DataFrame:
    """Unit prices with the part's list price as baseline."""
    items, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col(entity).alias("entity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("p_retailprice").alias("baseline"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supplier"),
    )


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text", "source", "n_chars"
    )


def raw_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles, with untitled copies that cleaning drops."""
    day = F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0")
    docs = documents(spark, sf).withColumn(
        "published", F.concat(F.lit("2024-01-"), day, F.lit("T06:30:00"))
    )
    titles = F.explode(F.array(F.col("text"), F.lit(""), F.lit(None).cast("string")))
    return docs.select("id", titles.alias("title"), "published", "source")


def page_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.col("url").alias("link"),
        F.col("html").alias("summary"),
        F.regexp_extract(F.lower("url"), PAGE_SOURCE, 1).alias("source"),
    )
