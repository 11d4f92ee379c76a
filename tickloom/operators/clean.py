"""Typing, filtering and naming of raw ticks and articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.text import collapse_space
from tickloom.functions.times import parse_time, with_date_parts
from tickloom.operators.dedupe import dedupe


# Place of a record in the array that it came in.
POSITION = "_position"


def with_ingest_meta(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source": F.lit(source)})


def with_meta(schema: T.StructType) -> T.StructType:
    """A raw schema with the columns that ``with_ingest_meta`` adds."""
    meta = T.StructType(list(schema.fields)).add(POSITION, "long")
    return meta.add("_ingested_at", "timestamp").add("_source", "string")


def arrival(df: DataFrame) -> Column:
    """A number that grows with load time and place in the loaded file; else with the event time."""
    if POSITION not in df.columns:
        return F.unix_micros("ts").cast("decimal(38,0)")
    loaded = F.unix_micros("_ingested_at").cast("decimal(20,0)")
    place = F.coalesce(POSITION, F.lit(0)).cast("decimal(18,0)")
    return (loaded * F.lit(10**15).cast("decimal(16,0)") + place).cast("decimal(38,0)")


def filter_valid_price(df: DataFrame, price: str = "price") -> DataFrame:
    """Price present and above zero; a price that is no number counts as absent."""
    return df.where(F.col(price).try_cast("double") > 0)


def canonicalize(df: DataFrame, aliases: DataFrame, column: str = "entity") -> DataFrame:
    """Replace known spellings, whatever their case and spacing.

    Unknown names are kept without outer white space, a missing one becomes ''.
    The alias table is literal or small, so Spark broadcasts it after checking
    its size; a large one is joined by a skew-aware shuffle.
    """
    name = F.coalesce(F.col(column), F.lit(""))
    trimmed = F.regexp_replace(name, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    lookup = aliases.select(F.col("alias").alias("_alias"), F.col("entity").alias("_entity"))
    keyed = df.withColumns({"_trimmed": trimmed, "_key": F.lower(collapse_space(name))})
    joined = keyed.join(lookup, F.col("_key") == F.col("_alias"), "left")
    return joined.withColumn(column, F.coalesce("_entity", "_trimmed")).select(*df.columns)


def clean_ticks(
    raw: DataFrame, aliases: DataFrame | None = None, canonicalize_first: bool = False
) -> DataFrame:
    """Raw ticks to typed, deduplicated ticks with hour and date.

    Copies are recognised by time text, entity and price as received. By
    default names are unified afterwards, so the same tick under two spellings
    stays twice; ``canonicalize_first`` merges those too.
    """
    df = filter_valid_price(raw)
    if aliases is not None and canonicalize_first:
        df = canonicalize(df, aliases)
    order = [c for c in ("id", "_ingested_at") if c in raw.columns]
    if POSITION in raw.columns:  # of copies the last one that arrived, so that it can win
        order = [-arrival(raw)]
    df = dedupe(df, ["ts", "entity", "price"], order)
    numbers = [c for c in ("price", "prev_price", "pct_change", "baseline") if c in df.columns]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in numbers})
    if dict(df.dtypes)["ts"] == "string":
        df = df.withColumn("ts", parse_time("ts"))
    df = with_date_parts(df)
    if aliases is not None and not canonicalize_first:
        df = canonicalize(df, aliases)
    return df


def clean_news(raw: DataFrame) -> DataFrame:
    """Articles with a title, one per title and publication time."""
    df = raw.where(F.col("title") != "")
    order = [c for c in ("id", "_ingested_at") if c in raw.columns]
    df = dedupe(df, ["title", "published"], order)
    return df.withColumns({"published_ts": parse_time("published"), "source": F.upper("source")})
