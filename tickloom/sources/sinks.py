"""Writers: tables, topics, JSON-line streams and the report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas
from tickloom.functions.text import stable_key

BATCH = "_batch_id"


def append_table(df: DataFrame, path: str, batch_id: str | int | None = None) -> None:
    """Append rows as they are.

    With a batch id, writing the same batch again replaces it instead of
    doubling its rows, also if it has none any more.
    """
    if batch_id is None:
        df.write.mode("append").parquet(path)
        return
    # The batch's own folder, which a batch without rows replaces as well.
    df.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def batch_folder(path: str, batch_id: str | int) -> str:
    return f"{path}/{BATCH}={quote(str(batch_id), safe='')}"


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table, laid out by the partition columns.

    The rebalance hint lets adaptive execution merge small and split large
    output partitions, so a heavy date neither makes one huge file nor one slow
    task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def encode_topic(
    df: DataFrame, key: str, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """(key, value) rows with the whole row as JSON."""
    wire = {ours: theirs for theirs, ours in (fields or {}).items()}
    row = F.struct(*[F.col(c).alias(wire.get(c, c)) for c in df.columns])
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(row, options).alias("value"))


def write_topic(df: DataFrame, key: str, options: Mapping[str, str]) -> None:
    """Send rows to Kafka, acknowledged by all replicas; needs Spark's Kafka package."""
    encode_topic(df, key).write.format("kafka").option("kafka.acks", "all").options(
        **dict(options)
    ).save()


def news_payload(df: DataFrame) -> DataFrame:
    """Message fields of an article: stable key and a summary of 500 characters."""
    return df.withColumns(
        {"key": stable_key("link"), "summary": F.left(F.col("summary"), F.lit(500))}
    )


def stream_to_jsonl(sdf: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Archive a stream as JSON lines, each row exactly once."""
    return (
        sdf.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _report_position(df: DataFrame, section: str) -> Column:
    """Place of an item within its section; equal places are sorted by item."""
    if section == "volatility":
        return -F.col("volatility_pct")
    if section == "trend":
        return F.unix_seconds(F.col("period").cast("timestamp"))
    return F.lit(0)


def _local_item(df: DataFrame, section: str) -> tuple[str, list[Column]]:
    """Published section name and fields."""
    label, names = schemas.REPORT_FIELDS[section]
    shown = {c: F.col(c) for c in names if c in df.columns}
    if section == "trend":
        shown["period"] = F.date_format("period", "yyyy-MM-dd HH:mm")
    if "forecast" in shown:
        shown["forecast"] = F.transform(
            "forecast",
            lambda p: F.struct(
                p["step"].alias("step"),
                p["time_idx"].alias("time_idx"),
                p["hour"].alias("jam"),
                F.bround(p["price_pred"], 0).alias("harga_pred"),
            ),
        )
    return label, [value.alias(names[c]) for c, value in shown.items()]


def report_rows(sections: Mapping[str, DataFrame], local_names: bool = False) -> DataFrame:
    """All report sections as (section, pos, item) rows, one JSON object per item.

    A section can grow without limit (the trend has a row per entity and
    period), so the report stays a distributed table. ``local_names`` uses the
    published section and field names.
    """
    out = None
    for name, df in sections.items():
        label, item = name, [F.col(c) for c in df.columns]
        if local_names and name in schemas.REPORT_FIELDS:
            label, item = _local_item(df, name)
        rows = df.select(
            F.lit(label).alias("section"),
            _report_position(df, name).cast("double").alias("pos"),
            F.to_json(F.struct(*item)).alias("item"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def merge_report(new: DataFrame, previous: DataFrame, replaced: Sequence[str]) -> DataFrame:
    """The new rows plus the previous rows of all sections that were not rebuilt."""
    kept = previous.where(~F.col("section").isin(list(replaced)))
    return new.unionByName(kept)


def report_document(rows: DataFrame, sections: Sequence[str]) -> DataFrame:
    """The report as ordered lines that together are one JSON document.

    Each item is a line, equal items share one. The lines are sorted over range
    partitions and written as files that follow each other, so no section is ever
    in one row or task.
    """
    spark = rows.sparkSession
    items = rows.where(F.col("section").isin(list(sections)))
    items = items.groupBy("section", "pos", "item").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    # One item per section: the only one without a comma before it.
    heads = items.groupBy("section").agg(F.min(F.struct("pos", "item")).alias("_head")).collect()
    is_head = F.lit(False)
    for r in heads:
        pos, item = r["_head"]
        here = F.col("pos").eqNullSafe(F.lit(pos)) & (F.col("item") == item)
        is_head = is_head | ((F.col("section") == r["section"]) & here)
    text = F.array_join(F.array_repeat("item", F.col("_n")), ",")
    body = items.select(
        F.array_position(F.lit(list(sections)), F.col("section")).cast("int").alias("_place"),
        F.lit(1).alias("_part"),
        "pos",
        F.when(is_head, text).otherwise(F.concat(F.lit(","), text)).alias("line"),
    )
    frame = [(len(sections) + 1, 0, None, "}")]
    for place, name in enumerate(sections, 1):
        frame += [(place, 0, None, f',"{name}":['), (place, 2, None, "]")]
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    opening = F.concat(F.lit('{"generated_at":"'), now, F.lit('"'))
    schema = "_place int, _part int, pos double, line string"
    first = spark.createDataFrame([(0, 0, None, None)], schema).withColumn("line", opening)
    lines = body.unionByName(spark.createDataFrame(frame, schema)).unionByName(first)
    # Items of one place are in the order of their text, the one without a comma first.
    key = [F.col("_place"), F.col("_part"), F.col("pos"), F.ltrim(F.col("line"), F.lit(","))]
    return lines.orderBy(*key).select("line")
