"""Positions within an entity that do not put a hot entity into one task.

A window over ``entity`` sorts each entity in a single task. That is fine for
many small entities, not for one that holds a third of 100 TB. Hot entities are
therefore cut along the order columns into chunks of about equal size, the
window runs per (entity, chunk), and what a chunk needs from the chunks before
it comes from a carry table with one row per chunk. Rows without an entity are
an entity of their own, split like any other.

The cut points are approximate quantiles of the time column over all rows: what
an entity has between two of them is at most what all entities have there. A
burst within one day or one second is cut as well; an instant that is itself hot
is cut along the next order column. Between neighbouring cut points chunks may
be narrower still, in equal steps of time. The chunk number never decreases
along the order, which is all that exactness needs: the approximation moves rows
between chunks but never changes a result.

Hot entities and cut points come from one pass over the key and the time. The
plan is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import micros
from tickloom.operators.ranges import ROW_BYTES, size_of

CHUNK = "_chunk"
CHUNK_BYTES = 256 * 1024 * 1024
# Borders that the driver holds; more chunks than this divide the time between borders.
BORDERS = 4096
# Items of the sketch of hot keys; it misses no key with more than 4 / TRACKED of the rows.
TRACKED = 1 << 18
# Stands for an unknown value in an order column; below any time in microseconds.
BEFORE_ALL = -float(2**62)
# Rows looked at per chunk to find hot keys and borders.
SAMPLE_PER_CHUNK = 200


def default_chunks(df: DataFrame, size: int) -> int:
    """Chunks of about 256 MB of input, at least one per shuffle partition."""
    at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, at_least, size // CHUNK_BYTES)


def sampled(df: DataFrame, chunks: int, size: int) -> DataFrame:
    """All rows of a small input, and some rows per chunk of a large one.

    What is looked at only affects the sizes of chunks, never a result.
    """
    fraction = SAMPLE_PER_CHUNK * chunks * ROW_BYTES / max(1, size)
    return df.sample(fraction, seed=1) if fraction < 1 else df


def key_and_time(
    df: DataFrame, by: str, time: Column, chunks: int, size: int
) -> tuple[list, list[float]]:
    """Keys with more than ``1 / chunks`` of the rows (null among them), and time quantiles."""
    borders = min(chunks, BORDERS)
    sketch = F.call_function(
        "approx_top_k", F.col("k"), F.lit(min(chunks, TRACKED)), F.lit(min(TRACKED, 64 * chunks))
    )
    found = sampled(df.select(F.col(by).alias("k"), time.alias("t")), chunks, size).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("k").isNull()).alias("unknown"),
        sketch.alias("top"),
        F.percentile_approx(
            "t", F.lit([i / borders for i in range(1, borders)]), F.lit(4 * borders)
        ).alias("borders"),
    )
    row = found.first()
    floor = row["n"] / chunks
    hot = [i["item"] for i in row["top"] or [] if i["item"] is not None and i["count"] > floor]
    return hot + [None] * (row["unknown"] > floor), list(row["borders"] or [])


def one_of(by: str, keys: Sequence) -> Column:
    """Whether the key is in the list, which may hold null."""
    known = [k for k in keys if k is not None]
    found = F.coalesce(F.col(by).isin(known), F.lit(False)) if known else F.lit(False)
    return found | F.col(by).isNull() if None in keys else found


def _number(value: Column) -> Column:
    """As a double that sorts like the value; nulls come first."""
    return F.coalesce(value.cast("double"), F.lit(BEFORE_ALL))


def _cut(df: DataFrame, value: Column, splits: Sequence[float], out: str) -> DataFrame:
    """Number of the bucket between the split points."""
    raw, inf = f"{out}_in", float("inf")
    bucketizer = Bucketizer(
        splits=[-inf, *splits, inf], inputCol=raw, outputCol=out, handleInvalid="keep"
    )
    cut = bucketizer.transform(df.withColumn(raw, value)).drop(raw)
    return cut.withColumn(out, F.col(out).cast("long"))


def _between(time: Column, borders: Sequence[float], bucket: Column, parts: int) -> Column:
    """Equal steps of time between the borders on both sides of a bucket; 0 at its ends."""
    sides = F.lit([math.nan, *borders, math.nan])
    low, high = (F.element_at(sides, (bucket + i).cast("int")) for i in (1, 2))
    step = F.floor(F.try_divide(time - low, high - low) * parts)
    inner = ~F.isnan(low) & ~F.isnan(high)
    return F.when(inner, F.least(F.greatest(step, F.lit(0)), F.lit(parts - 1))).otherwise(0)


def with_chunks(
    df: DataFrame, by: str, order: Sequence[str], chunks: int | None = None
) -> tuple[DataFrame, list]:
    """Add a chunk number and return it with the list of split entities.

    Entities with more than ``1 / chunks`` of all rows are split. ``None`` takes
    the number from the input size.
    """
    size = size_of(df)
    chunks = default_chunks(df, size) if chunks is None else max(2, chunks)
    time = _number(micros(order[0]))
    hot, edges = key_and_time(df, by, time, chunks, size)
    if not hot:
        return df.withColumn(CHUNK, F.lit(0).cast("long")), []

    is_hot = one_of(by, hot)
    # A quantile that shows up twice is an instant with many rows: give it a
    # bucket of its own and cut that one along the next order column.
    instants = sorted({a for a, b in zip(edges, edges[1:], strict=False) if a == b})
    edges = sorted({*edges, *(math.nextafter(t, math.inf) for t in instants)})
    out = _cut(df, time, edges, "_time_cut")
    width, tie = 1, F.lit(0)
    if instants and len(order) > 1 and isinstance(df.schema[order[1]].dataType, T.NumericType):
        in_instant = time.isin(instants)
        place = _number(F.col(order[1]))
        borders = min(chunks, BORDERS)
        ties = sampled(df.where(is_hot & in_instant).select(place.alias("v")), chunks, size).agg(
            F.percentile_approx(
                "v", F.lit([i / borders for i in range(1, borders)]), F.lit(4 * borders)
            )
        )
        ties = sorted(set(ties.first()[0] or []))
        out = _cut(out, place, ties, "_tie_cut")
        width, tie = len(ties) + 1, F.when(in_instant, F.col("_tie_cut")).otherwise(0)
    number, finer = F.col("_time_cut"), math.ceil(chunks / BORDERS)
    if finer > 1:
        number = number * finer + _between(time, edges, F.col("_time_cut"), finer)
    chunk = F.when(is_hot, number * width + tie).otherwise(0).cast("long")
    return out.withColumn(CHUNK, chunk).drop("_time_cut", "_tie_cut"), hot


def with_carry(rows: DataFrame, carry: DataFrame, by: str) -> DataFrame:
    """Rows with what their (entity, chunk) carries; an unknown entity is one too."""
    carry = carry.withColumnsRenamed({by: "_by", CHUNK: "_of"})
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col(CHUNK) == F.col("_of"))
    return rows.join(carry, same, "left")


def position(
    df: DataFrame,
    out: str = "time_idx",
    total: str = "n_total",
    by: str = "entity",
    order: Sequence[str] = ("ts", "id"),
    chunks: int | None = None,
) -> DataFrame:
    """0-based row index and row count per entity."""
    cut, hot = with_chunks(df, by, order, chunks)
    local = W.partitionBy(by, CHUNK)
    rows = cut.withColumns(
        {
            out: (F.row_number().over(local.orderBy(*order)) - 1).cast("long"),
            total: F.count(F.lit(1)).over(local),
        }
    )
    if not hot:
        return rows.drop(CHUNK)
    sizes = cut.where(one_of(by, hot)).groupBy(by, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(by).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        by,
        CHUNK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(W.partitionBy(by)).alias("_total"),
    )
    rows = with_carry(rows, offsets, by)
    return rows.select(
        *df.columns,
        (F.col(out) + F.coalesce("_offset", F.lit(0))).alias(out),
        F.coalesce("_total", total).alias(total),
    )
