"""Time parsing and date parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_time(text: Column | str) -> Column:
    """ISO text to timestamp, null if it cannot be read."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def parse_feed_time(text: Column | str) -> Column:
    """RFC 822 feed dates, with or without weekday, zone name or offset."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]+,\s*", "")
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss xx")),
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(text),
    )


def with_date_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns({"hour": F.hour(ts), "date": F.to_date(ts)})


def truncate_time(df: DataFrame, unit: str, ts: str = "ts") -> Column:
    """``date_trunc`` that keeps the column's own timestamp type."""
    return F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)


def local_time(ts: Column | str, zone: str = "Asia/Jakarta") -> Column:
    """UTC time shown on the local clock."""
    return F.from_utc_timestamp(ts, zone)


def micros(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))
