"""Scans: JSON lines, JSON arrays, feed files, topics and tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.functions.times import parse_feed_time


# Blanks that JSON allows.
JSON_BLANKS = " \t\r\n"


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _rename(df: DataFrame, fields: Mapping[str, str] | None) -> DataFrame:
    return df.withColumnsRenamed(dict(fields)) if fields else df


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fields: Mapping[str, str] | None = None,
    bad_rows: str | None = None,
) -> DataFrame:
    """One JSON object per line, all files below ``path``.

    ``fields`` renames JSON fields to columns. Lines that are no JSON are
    dropped, or kept as text in the column ``bad_rows``.
    """
    wire = schemas.json_schema(schema, fields or {})
    bad = bad_rows or "_bad_row"
    with_bad = T.StructType([*wire.fields, T.StructField(bad, T.StringType())])
    df = spark.read.schema(with_bad).option("columnNameOfCorruptRecord", bad).json(path)
    if bad_rows is None:
        df = df.where(F.col(bad).isNull()).drop(bad)
    return _rename(df, fields)


def _array_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of array files that are not blank, and the one element that each may hold.

    ``fits`` tells whether a line is a bracket or an object, with a comma after it at most.
    """
    read = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        F.btrim("value", F.lit(JSON_BLANKS)).alias("line"),
    )
    core = F.regexp_replace("line", r"^\[[ \t]*|[ \t]*\]$", "")
    body = F.regexp_replace("core", r"[ \t]*,$", "")
    # An array of one, so that a second object on the line is not lost.
    items = F.from_json(F.concat(F.lit("["), "body", F.lit("]")), "array<string>")
    lines = read.where("line <> ''").withColumn("core", core).withColumn("body", body)
    one = F.col("body").startswith("{") & (F.size("items") == 1)
    return lines.withColumn("items", F.when(F.col("body").startswith("{"), items)).select(
        "file",
        "block",
        "nth",
        F.col("line").startswith("[").alias("opens"),
        F.col("line").endswith("]").alias("closes"),
        F.col("core").endswith(",").alias("comma"),
        F.when(one, F.get("items", F.lit(0))).alias("item"),
        ((F.col("core") == "") | F.coalesce(one, F.lit(False))).alias("fits"),
    )


def _array_shapes(lines: DataFrame) -> DataFrame:
    """Whether a file is one array with an object a line: file, lined."""
    place = F.struct("block", "nth")
    element = F.col("item").isNotNull()
    marks = lines.groupBy("file").agg(
        F.every("fits").alias("fits"),
        F.count_if("opens").alias("opens"),
        F.count_if("closes").alias("closes"),
        F.count_if("comma").alias("commas"),
        F.count("item").alias("elements"),
        (F.min(place) == F.min(F.when(F.col("opens"), place))).alias("first"),
        (F.max(place) == F.max(F.when(F.col("closes"), place))).alias("last"),
        (F.max(F.when(F.col("comma"), place)) < F.max(F.when(element, place))).alias("ends"),
    )
    lined = (
        F.expr("fits and opens = 1 and closes = 1 and first and last")
        & F.expr("commas = greatest(elements - 1, 0)")
        & F.expr("coalesce(ends, true)")
    )
    return marks.select("file", F.coalesce(lined, F.lit(False)).alias("lined"))


def _plain_path(file: str) -> str:
    """A listed file as a path to read: not encoded, no character read as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def _numbered(items: DataFrame) -> DataFrame:
    """Place of each element in its file; a window sees one block, or one row a block."""
    counts = items.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("nth"))
    placed = items.withColumn("_nth", within).join(starts, ["file", "block"])
    return placed.select(F.col("item").alias("_item"), (F.col("_start") + F.col("_nth") - 1).alias("_at"))


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fields: Mapping[str, str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """Files that each hold one JSON array of objects.

    A missing file, broken JSON or anything but an array gives no rows;
    elements that are no objects are left out. ``position`` names a column for
    the place in the array, which is the arrival order.

    Files with one object a line are found by a pass over the lines and read by as
    many tasks as they have blocks; a task reads any other file as a whole.
    """
    wire = schemas.json_schema(schema, fields or {})
    out = T.StructType(wire.fields + ([T.StructField(position, T.LongType())] if position else []))
    try:
        shapes = _array_shapes(_array_lines(spark, path)).collect()  # a row a file
    except AnalysisException:
        return _rename(empty_like(spark, out), fields)
    lined = [_plain_path(r["file"]) for r in shapes if r["lined"]]
    others = [_plain_path(r["file"]) for r in shapes if not r["lined"]]
    items = empty_like(spark, T.StructType.fromDDL("_at bigint, _item string"))
    if lined:
        elements = _array_lines(spark, lined).where(F.col("item").isNotNull())
        no_place = elements.select(F.lit(None).cast("long").alias("_at"), F.col("item").alias("_item"))
        items = items.unionByName(_numbered(elements) if position else no_place)
    if others:
        # The elements are cut out as text first, so one odd element spoils no other.
        text = spark.read.text(others, wholetext=True)
        elements = F.posexplode(F.from_json("value", "array<string>")).alias("_at", "_item")
        items = items.unionByName(text.where(F.ltrim("value").startswith("[")).select(elements))
    rows = items.where(F.ltrim("_item").startswith("{")).select(
        F.from_json("_item", wire).alias("_row"), "_at"
    )
    place = [F.col("_at").cast("long").alias(position)] if position else []
    return _rename(rows.select("_row.*", *place), fields)


def read_first_available(
    spark: SparkSession,
    sources: Iterable[tuple[str, str]],
    schema: T.StructType,
    fields: Mapping[str, str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """The first source that can be reached; ``sources`` are (kind, path) pairs.

    The kind is ``lines`` or ``array``. Without any, the result is empty.
    ``position`` names a column for the place in an array, null for lines.
    """
    extra = [T.StructField(position, T.LongType())] if position else []
    for kind, path in sources:
        try:
            spark.read.text(path)  # lists the files, reads none
            if kind == "array":
                return read_json_array(spark, path, schema, fields, position)
            lines = {"lines": read_jsonl}[kind](spark, path, schema, fields)
            return lines.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra})
        except (AnalysisException, Py4JJavaError):
            continue
    return empty_like(spark, T.StructType(schema.fields + extra))


def count_trigger(rows: int, longest_wait: str = "1 minute") -> dict[str, str]:
    """Topic options for a batch per so many new messages, or after the wait."""
    return {"minOffsetsPerTrigger": str(rows), "maxTriggerDelay": longest_wait}


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A Kafka topic from its first offset; needs Spark's Kafka package."""
    return (
        spark.readStream.format("kafka")
        .option("startingOffsets", "earliest")
        .options(**dict(options))
        .load()
    )


def decode_topic(
    df: DataFrame, schema: T.StructType, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """JSON values (and utf-8 keys as ``_key``) of a key/value frame to columns."""
    wire = schemas.json_schema(schema, fields or {})
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    value = F.from_json(F.col("value").cast("string"), wire, options)
    rows = df.select(F.col("key").cast("string").alias("_key"), value.alias("_v"))
    return _rename(rows.select("_key", "_v.*"), fields)


def read_feed_items(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Items of landed RSS files; items without a link are skipped."""
    schema = "title string, link string, description string, pubDate string"
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("title", "link", "description")}
    return items.where(F.trim("link") != "").select(
        text["title"].alias("title"),
        F.trim(text["link"]).alias("link"),
        text["description"].alias("summary"),
        F.coalesce(parse_feed_time("pubDate"), F.current_timestamp()).alias("published"),
        F.lit(source).cast("string").alias("source"),
        F.current_timestamp().alias("fetched_at"),
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stream_table(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """A Parquet table as a stream, whether it is a folder or a single file."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A pattern for the last letter matches the same path and also allows a
    # single file, which a plain streaming path does not.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def file_freshness(spark: SparkSession, datasets: Mapping[str, str]) -> DataFrame:
    """Per dataset: whether it exists, its size in KB and its local change time."""
    frames = []
    for name, path in datasets.items():
        try:
            files = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .load(path)
                .select("length", "modificationTime")
            )
        except AnalysisException:
            files = empty_like(spark, schemas.FILE)
        frames.append(
            files.agg(
                (F.count(F.lit(1)) > 0).alias("exists"),
                F.round(F.sum("length") / 1024, 1).alias("size_kb"),
                F.from_utc_timestamp(F.max("modificationTime"), "Asia/Jakarta").alias("modified"),
            ).select(F.lit(name).alias("dataset"), "*")
        )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
