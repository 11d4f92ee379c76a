"""Ingest, first-seen links, window statistics and change alerts on streams.

Outputs of ``foreachBatch`` go to a folder per batch id. A batch that is
replayed after a failure replaces its own folder, so every row counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.numbers import alert_class, pct_change
from tickloom.operators.clean import canonicalize
from tickloom.operators.ranges import previous_value
from tickloom.operators.series import recent
from tickloom.sources.readers import decode_topic
from tickloom.sources.sinks import BATCH, append_table, batch_folder
from tickloom.streaming import levels

AVAILABLE_NOW = {"availableNow": True}


def run_batches(
    sdf: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    return (
        sdf.writeStream.foreachBatch(step)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows written by a stream's batches."""
    return spark.read.parquet(path).drop("batch")


def merge_sums(sums: DataFrame) -> DataFrame:
    """Sums per entity and window of several batches to one."""
    return sums.groupBy("entity", "period").agg(
        F.sum("total").alias("total"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
        F.sum("n").alias("n"),
    )


def read_trend(spark: SparkSession, path: str) -> DataFrame:
    """The statistics of every window, merged from all batches that had ticks of it."""
    merged = merge_sums(levels.read(spark, path))
    mean = F.try_divide(F.col("total"), F.col("n")).alias("price_avg")
    return merged.select("entity", "period", mean, "price_min", "price_max", "n")


def first_seen(
    sdf: DataFrame, key: str, time: str, delay: str = "7 days", salts: int = 16
) -> DataFrame:
    """One row per key within the delay.

    The first stage spreads the copies of a key over ``salts`` tasks and passes
    on at most that many, so one heavily repeated key does not fill one task.
    State older than the delay is dropped. The salt is the task that read the row,
    so exact copies from different files are spread as well.
    """
    marked = sdf.withWatermark(time, delay)
    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        marked = marked.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"])
    return marked.dropDuplicatesWithinWatermark([key]).drop("_salt")


def window_stats(sdf: DataFrame, width: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Average, range and count per entity and time window, kept incrementally."""
    # Watermarks need a time-zone aware timestamp.
    timed = sdf.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    stats = timed.groupBy("entity", F.window("ts", width).alias("w")).agg(
        F.avg("price").alias("price_avg"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.count("price").alias("n"),
    )
    return stats.select(
        "entity", F.col("w.start").alias("period"), "price_avg", "price_min", "price_max", "n"
    )


def stream_trend(
    sdf: DataFrame,
    out: str,
    checkpoint: str,
    width: str = "1 minute",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each batch's sums per entity and window; read them with ``read_trend``.

    Sums of batches add up in any order, so late ticks count whenever they arrive.
    Batches are merged level by level.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("ts", F.col("ts").cast("timestamp"))
        sums = timed.groupBy("entity", F.window("ts", width).alias("w")).agg(
            F.sum("price").alias("total"),
            F.min("price").alias("price_min"),
            F.max("price").alias("price_max"),
            F.count("price").alias("n"),
        )
        sums = sums.withColumn("period", F.col("w.start")).drop("w")
        levels.add(sums, out, batch_id, merge_sums)

    return run_batches(sdf, step, checkpoint, trigger=trigger)


def stream_changes(
    sdf: DataFrame,
    out: str,
    archive: str,
    checkpoint: str,
    threshold: float | None = None,
    chunks: int | None = None,
    trigger: dict | None = None,
    cell: str = "day",
) -> StreamingQuery:
    """Change against the previous tick of the entity, across batches; late ticks repair.

    The archive holds the ticks by cells of (entity, period ``cell``) and, for each batch
    and cell, its first and last tick. A new tick's neighbours are in its own cell or at
    the end of another cell of the entity, so a batch reads the cells that it has ticks
    of and, beside them, only such end ticks. It writes its own ticks and the rows whose
    previous tick is now one of them: at most two rows for each new tick. Read the result
    with ``read_changes``, which takes the latest row of every tick.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cells = Observation()
        own = archived(spark, batch, archive, batch_id, cell, cells)
        span = cells.get
        if not span["n"]:
            return
        earlier = F.col("batch") < batch_id
        in_span = F.col("period").isNull() | F.col("period").between(span["first"], span["last"])
        ticks = spark.read.schema(own.schema).parquet(f"{archive}/ticks").where(earlier)
        ends = spark.read.schema(own.schema).parquet(f"{archive}/ends").where(earlier)
        # Hashes tell cells and entities; one that is met by chance only adds a candidate.
        near = ticks.where(in_span).join(own.select("cell").distinct(), "cell", "left_semi")
        aside = ends.join(own.select("who").distinct(), "who", "left_semi").join(
            own.select("cell").distinct(), "cell", "left_anti"
        )
        candidates = near.unionByName(aside).withColumn("_new", F.lit(False))
        candidates = candidates.unionByName(own.withColumn("_new", F.lit(True)))
        candidates = candidates.select(*TICK, F.struct("price", "_new").alias("_tick"))
        found = previous_value(
            candidates, "_tick", "_previous", order=["ts", "id", "batch", "nth"], chunks=chunks
        )
        changed = F.col("_tick._new") | F.coalesce("_previous._new", F.lit(False))
        found = found.where(changed).withColumn("prev_price", F.col("_previous.price"))
        changes = found.withColumn("pct_change", pct_change("price", "prev_price", zero=None))
        if threshold is not None:
            changes = changes.withColumn("alert", alert_class("pct_change", threshold))
        changes = changes.drop("_tick", "_previous").withColumnRenamed("batch", "tick_batch")
        changes.write.mode("overwrite").parquet(_batch_folder(out, batch_id))

    return run_batches(sdf, step, checkpoint, trigger=trigger)


# A tick is told apart from all others by its batch and its number there.
TICK = ["entity", "ts", "id", "price", "batch", "nth"]


def archived(
    spark: SparkSession, batch: DataFrame, archive: str, batch_id: int, cell: str, cells: Observation
) -> DataFrame:
    """Write a batch's ticks by cell, and each cell's first and last one; give the ticks back."""
    period = F.date_trunc(cell, F.col("ts").cast("timestamp")).alias("period")
    ticks = batch.select(
        "entity",
        "ts",
        "id",
        "price",
        F.monotonically_increasing_id().alias("nth"),
        F.xxhash64("entity").alias("who"),
        F.xxhash64("entity", period).alias("cell"),
        period,
    )
    ticks = ticks.observe(
        cells,
        F.count(F.lit(1)).alias("n"),
        F.min("period").alias("first"),
        F.max("period").alias("last"),
    )
    # Sorted by period, so that a reader of a span of time skips the other row groups.
    folder = _batch_folder(f"{archive}/ticks", batch_id)
    ticks.sortWithinPartitions("period", "who").write.mode("overwrite").parquet(folder)
    own = spark.read.schema(ticks.schema).parquet(folder)
    own = own.withColumn("batch", F.lit(batch_id).cast("long"))
    place = F.struct("ts", "id", "nth")
    ends = own.groupBy("cell").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    ends = ends.select(F.explode(F.array_distinct(F.array("first.nth", "last.nth"))).alias("nth"))
    at_ends = own.drop("batch").join(ends, "nth", "left_semi")
    at_ends.write.mode("overwrite").parquet(_batch_folder(f"{archive}/ends", batch_id))
    return own


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every tick; with a threshold, those that are alerts."""
    rows = spark.read.parquet(path)
    tick = ["tick_batch", "nth"]
    # Only ticks that were written again have older rows; numbers are compared, not rows.
    last = rows.groupBy(*tick).agg(F.max("batch").alias("batch"))
    latest = rows.join(last, [*tick, "batch"], "left_semi").drop(*tick, "batch")
    return latest.where(F.col("alert").isNotNull()) if "alert" in rows.columns else latest


def ingest_stream(
    sdf: DataFrame,
    schema: T.StructType,
    aliases: DataFrame,
    archive: str,
    view: str,
    checkpoint: str,
    fields: dict[str, str] | None = None,
    n_recent: int = 200,
    order: Sequence[str] = ("ts",),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Decode a topic, unify names, archive all rows and keep the newest ones.

    The archive has a folder per batch, and so has the view: the newest rows of a batch.
    No batch depends on what an earlier one left; the newest rows of all are among the
    newest of each. Batches of the view are merged level by level. Read it with
    ``read_view``.
    """
    newest = partial(recent, n=n_recent, order=order)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = canonicalize(decode_topic(batch, schema, fields).drop("_key"), aliases)
        append_table(rows, archive, batch_id)
        own = batch.sparkSession.read.schema(rows.schema).parquet(batch_folder(archive, batch_id))
        levels.add(newest(own), view, batch_id, newest)

    return run_batches(sdf, step, checkpoint, trigger=trigger)


def read_view(
    spark: SparkSession, view: str, n_recent: int = 200, order: Sequence[str] = ("ts",)
) -> DataFrame:
    """The newest rows of all batches."""
    return recent(levels.read(spark, view), n_recent, order)


def refresh_after(
    archive: str, done: str, refresh: Callable[[DataFrame], None], min_rows: int = 100
) -> Callable[[DataFrame, int], None]:
    """A batch step that archives rows and reruns an analysis now and then.

    ``refresh`` gets the whole archive once at least ``min_rows`` rows came in
    since it last ran; ``done`` records the batch of that run, and only batches
    after it are counted. Batches run one after the other, so analyses never
    overlap; the pause between them is the trigger's interval.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_table(batch, archive, batch_id)
        rows = spark.read.parquet(archive)
        try:
            last = spark.read.parquet(done).agg(F.max("batch")).first()[0]
        except AnalysisException:
            last = -1
        pending = rows.where(F.col(BATCH).cast("long") > last).count()
        if pending >= min_rows:
            refresh(rows.drop(BATCH))
            marker = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"))
            marker.write.mode("append").parquet(done)

    return step
