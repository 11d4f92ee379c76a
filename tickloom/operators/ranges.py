"""The value some rows earlier in the same entity, by one range exchange.

Rows are dealt over ranges of (entity, order columns) and sorted there, so a range holds
many small entities or a piece of a hot one, and no task has to sort a whole hot entity.
A task shifts the values along its rows. What it cannot know are the first ``n`` rows of
its first entity; their values come from the ranges before. The first and last ``n`` rows
of every range are a small table, at most ``2 * n`` rows a range: a window over it gives
the missing values, which are broadcast back. Both the rows and that table are read from
the same exchange.

Rows that are equal in entity and all order columns are in one range, in any order. Rows
without an entity are an entity of their own; unknown times come first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import input_bytes

# Input of one range.
RANGE_BYTES = 256 * 1024 * 1024
# From here on the optimizer's size says that it knows none.
UNKNOWN = 1 << 62
ROW_BYTES = 100
# Number of a row among the first ones of its range, null for all others.
HEAD = "_head"
MISSING = "ranges were dealt anew between two reads; set spark.sql.exchange.reuse to true"


def size_of(df: DataFrame) -> int:
    """Bytes of the input; rows of a source of unknown size are counted."""
    size = input_bytes(df)
    return size if size < UNKNOWN else df.count() * ROW_BYTES


def number_of_ranges(df: DataFrame) -> int:
    """Ranges of about 256 MB of input, at least one per shuffle partition."""
    at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(at_least, size_of(df) // RANGE_BYTES)


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """Equal or both null."""
    equal = pc.fill_null(pc.equal(a, b), False)
    return pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b)))


def _prefix(keys: pa.Array, first: pa.Scalar, start: int, n: int) -> int:
    """How many of the rows from position ``start`` on are first rows of the first entity."""
    some = keys.slice(0, max(0, n - start))
    if not len(some):
        return 0
    same = _same(some, pa.array([first.as_py()] * len(some), some.type)).to_numpy(False)
    return len(same) if same.all() else int(np.argmin(same))


def _shifted(n: int, by: str, value: str, names: list[str]):
    """Task: a sorted range to its rows with the value ``n`` rows earlier."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, before, done = None, None, 0
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            key, val = batch.column(by), batch.column(value)
            if first is None:
                first = key[0]
            # The rows before this batch, up to n of them.
            keys = key if before is None else pa.concat_arrays([before[0], key])
            vals = val if before is None else pa.concat_arrays([before[1], val])
            lead = len(keys) - rows
            blank = min(rows, n - lead)
            known = rows - blank
            start = max(0, lead + blank - n)
            same = _same(keys.slice(start, known), key.slice(blank))
            lagged = pc.if_else(same, vals.slice(start, known), pa.scalar(None, val.type))
            if blank:
                lagged = pa.concat_arrays([pa.nulls(blank, val.type), lagged])
            heads = _prefix(key, first, done, n)
            head = pa.array(
                np.arange(done, done + rows, dtype=np.int32), pa.int32(), mask=np.arange(rows) >= heads
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lagged, head], names=names)
            done += rows
            before = keys.slice(max(0, len(keys) - n)), vals.slice(max(0, len(keys) - n))

    return task


def _ends(n: int, by: str, columns: list[str]):
    """Task: a sorted range to its first and last ``n`` rows, with their numbers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done, last = None, 0, None
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            if first is None:
                first = batch.column(by)[0]
            heads = _prefix(batch.column(by), first, done, n)
            place = np.arange(done, done + rows, dtype=np.int64)
            head = pa.array(place.astype(np.int32), pa.int32(), mask=np.arange(rows) >= heads)
            arrays = [*[batch.column(c) for c in columns], pa.array(place), head]
            some = pa.Table.from_arrays(arrays, names=[*columns, "_place", HEAD])
            # First rows go out at once; the last ones are known at the end of the range.
            yield from some.slice(0, heads).to_batches()
            rest = some.slice(heads)
            last = rest if last is None else pa.concat_tables([last, rest])
            last = last.slice(max(0, last.num_rows - n))
            done += rows
        if last is not None:
            yield from last.combine_chunks().to_batches()

    return task


def previous_value(
    df: DataFrame,
    value: str,
    out: str,
    n: int = 1,
    by: str = "entity",
    order: Sequence[str] = ("ts", "id"),
    chunks: int | None = None,
) -> DataFrame:
    """``value`` of the row ``n`` steps earlier within the same entity.

    ``chunks`` is the number of ranges; by default it follows from the input's size. The
    new column comes last and replaces one of its name.
    """
    if out != value:
        df = df.drop(out)  # a column of that name is replaced
    ranges = chunks or number_of_ranges(df)
    sorted_ranges = df.repartitionByRange(ranges, by, *order).sortWithinPartitions(by, *order)
    shifted_schema = T.StructType(
        [*df.schema.fields, T.StructField(out, df.schema[value].dataType), T.StructField(HEAD, T.IntegerType())]
    )
    rows = sorted_ranges.mapInArrow(_shifted(n, by, value, shifted_schema.names), shifted_schema)

    columns = list(dict.fromkeys([by, *order, value]))
    ends_schema = T.StructType([df.schema[c] for c in columns]).add("_place", T.LongType())
    ends_schema = ends_schema.add(HEAD, T.IntegerType())
    ends = sorted_ranges.mapInArrow(_ends(n, by, columns), ends_schema)
    along = W.partitionBy(by).orderBy(*order, "_place")
    missing = ends.withColumn("_carried", F.lag(value, n).over(along)).where(F.col(HEAD).isNotNull())
    # A first row is told apart by its key and number: equal keys never lie in two ranges.
    keys = [by, *order, HEAD]
    missing = missing.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_carried")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = rows.join(F.broadcast(missing), same, "left")
    found = F.col(f"_k{len(keys) - 1}").isNotNull()
    result = (
        F.when(F.col(HEAD).isNull(), F.col(out))
        .when(found, F.col("_carried"))
        .otherwise(F.raise_error(F.lit(MISSING)).cast(df.schema[value].dataType))
    )
    return joined.select(*df.columns, result.alias(out))
