"""One row per key by hash aggregation.

A maximum over a struct of order columns makes Spark sort the rows. Here the order
columns are packed into whole numbers of fixed width, which a hash aggregate can keep
in place; the other columns are picked by the same number, each in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import micros

# Bits of the order columns that can be packed. Times of the years 0 to 9999 in
# microseconds need 59 bits and a sign.
BITS: dict[type, int] = {
    T.BooleanType: 1,
    T.ByteType: 8,
    T.ShortType: 16,
    T.IntegerType: 32,
    T.DateType: 32,
    T.LongType: 64,
    T.TimestampType: 60,
    T.TimestampNTZType: 60,
}
# Columns that a hash aggregate can keep in place.
IN_PLACE = (*BITS, T.FloatType, T.DoubleType, T.DecimalType)
# Bits that fit a decimal of 38 digits.
WIDTH = 126


def place(value: Column, kind: T.DataType) -> Column:
    """A value's place among all of its type, from 1 on; null is 0, before all others."""
    if isinstance(kind, T.DateType):
        number = F.unix_date(value)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = micros(value)
    else:
        number = value.cast("long")
    moved = number.cast("decimal(20,0)") + F.lit(Decimal(2 ** (BITS[type(kind)] - 1) + 1))
    return F.coalesce(moved, F.lit(Decimal(0)))


def packed(columns: Sequence[tuple[Column, T.DataType]]) -> list[Column] | None:
    """Numbers that order rows as the columns do, as few as hold them; None if a type does not fit."""
    keys: list[Column] = []
    left = 0
    for value, kind in columns:
        if type(kind) not in BITS:
            return None
        width = BITS[type(kind)] + 1
        if width > left:
            keys.append(place(value, kind))
            left = WIDTH - width
        else:
            keys[-1] = keys[-1] * F.lit(Decimal(2**width)) + place(value, kind)
            left -= width
    return [k.cast("decimal(38,0)") for k in keys]


def in_place(df: DataFrame, columns: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, IN_PLACE) for c in columns)


def with_types(df: DataFrame, order: Sequence[str | Column]) -> list[tuple[Column, T.DataType]]:
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    return list(zip(columns, [f.dataType for f in df.select(*columns).schema.fields], strict=True))


def extreme(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool
) -> DataFrame | None:
    """The first or last row of every key (nulls are equal); None where it cannot be packed.

    Order columns that need several numbers are taken one number after the other: rows
    that do not reach the first one are left out before the next.
    """
    rest = [c for c in df.columns if c not in keys]
    numbers = packed(with_types(df, order))
    if not numbers or not in_place(df, rest):
        return None
    rows = df.withColumns({f"_n{i}": n for i, n in enumerate(numbers)})
    best, pick = (F.max, F.max_by) if last else (F.min, F.min_by)
    for i in range(len(numbers) - 1):
        reached = rows.groupBy(*keys).agg(best(f"_n{i}").alias("_best"))
        reached = reached.select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)], "_best")
        same = F.col(f"_n{i}") == F.col("_best")
        for j, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{j}"))
        rows = rows.join(reached, same, "left_semi")
    number = f"_n{len(numbers) - 1}"
    found = rows.groupBy(*keys).agg(*[pick(c, number).alias(c) for c in rest])
    return found.select(*df.columns)
