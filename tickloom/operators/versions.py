"""Versioned snapshots in plain Parquet, of which a correction rewrites only some parts.

A commit writes the folder ``_version=<n>``, laid out by the partition columns, and the
table of parts ``_parts/n=<n>``: for every value of the partition columns, the version
whose folder holds its rows. A full write holds all parts itself. A correction writes only
the parts that have matching rows, and its table names older folders for the others. Both
are plain Parquet tables, and so is ``_schemas/n=<n>``, an empty table with the columns.

A version counts only once its row in ``_commits`` is written, so a run that dies half way
leaves nothing visible and the next run replaces its files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.session import stored
from tickloom.sources.readers import empty_like
from tickloom.sources.sinks import overwrite_table

VERSION = "_version"
HOLDER = "_holder"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(schemas.COMMIT).parquet(f"{path}/_commits")
    except AnalysisException:
        return empty_like(spark, schemas.COMMIT)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Version, time, operation and user, newest first."""
    return _commits(spark, path).orderBy(F.desc("version"))


def latest_version(spark: SparkSession, path: str) -> int | None:
    return _commits(spark, path).agg(F.max("version")).first()[0]


def _next(spark: SparkSession, path: str) -> int:
    last = latest_version(spark, path)
    return 0 if last is None else last + 1


def _same_part(keys: Sequence[str], renamed: Sequence[str]) -> Column:
    """Equal in all partition columns; nulls are equal."""
    same = F.lit(True)
    for key, other in zip(keys, renamed, strict=True):
        same = same & F.col(key).eqNullSafe(F.col(other))
    return same


def _renamed(parts: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_part{i}" for i in range(len(keys))]
    return parts.withColumnsRenamed(dict(zip(keys, names, strict=True))), names


def _read_folders(
    spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[int]
) -> DataFrame:
    """Rows of the folders, with the version that wrote them."""
    with_version = T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])
    if not folders:
        return empty_like(spark, with_version)
    reader = spark.read.schema(with_version).option("basePath", path)
    return reader.parquet(*[f"{path}/{VERSION}={v}" for v in folders]).select(*with_version.names)


def _write_folder(df: DataFrame, path: str, version: int, keys: Sequence[str]) -> DataFrame:
    """Write a version's folder and return its parts, as they are read back."""
    spark = df.sparkSession
    if VERSION in df.columns or HOLDER in df.columns:
        raise ValueError(f"{VERSION} and {HOLDER} are no column names for a versioned table")
    overwrite_table(df, f"{path}/{VERSION}={version}", keys)
    holder = F.lit(version).cast("long").alias(HOLDER)
    if not keys:
        return spark.range(1).select(holder)
    rows = _read_folders(spark, path, df.schema, [version])
    return rows.select(*keys).distinct().select(*keys, holder)


def _finish(
    spark: SparkSession, path: str, version: int, schema: T.StructType, parts: DataFrame, operation: str
) -> int:
    empty_like(spark, schema).write.mode("overwrite").parquet(f"{path}/_schemas/n={version}")
    parts.write.mode("overwrite").parquet(f"{path}/_parts/n={version}")
    row = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.current_timestamp().alias("ts"),
        F.lit(operation).alias("operation"),
        F.lit(spark.sparkContext.sparkUser()).alias("user"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{path}/_commits")
    return version


def commit(
    df: DataFrame, path: str, operation: str = "WRITE", partition_by: Sequence[str] = ()
) -> int:
    """Write the next version of a table and return its number."""
    spark = df.sparkSession
    version = _next(spark, path)
    parts = _write_folder(df, path, version, partition_by)
    return _finish(spark, path, version, df.schema, parts, operation)


def parts_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Partition columns and the version whose folder holds the part's rows."""
    return spark.read.parquet(f"{path}/_parts/n={version}")


def _holders(parts: DataFrame) -> list[int]:
    """Versions whose folders are read: at most one for each commit since the last full one."""
    return sorted(r[0] for r in parts.select(HOLDER).distinct().collect())


def as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A table as it was in a version, by default the latest one."""
    if version is None:
        version = latest_version(spark, path)
        if version is None:
            raise ValueError(f"no version of {path}")
    elif _commits(spark, path).where(F.col("version") == version).isEmpty():
        raise ValueError(f"no version {version} of {path}")
    schema = spark.read.parquet(f"{path}/_schemas/n={version}").schema
    parts = parts_of(spark, path, version)
    holders = _holders(parts)
    rows = _read_folders(spark, path, schema, holders)
    if len(holders) > 1:
        # Of every part only the rows in its holder's folder.
        keys = [c for c in parts.columns if c != HOLDER]
        held, names = _renamed(parts, keys)
        there = (F.col(VERSION) == F.col(HOLDER)) & _same_part(keys, names)
        rows = rows.join(held, there, "left_semi")
    elif holders and version not in holders:
        # Parts that an update has emptied are still in the older folder.
        keys = [c for c in parts.columns if c != HOLDER]
        held, names = _renamed(parts, keys)
        rows = rows.join(held, _same_part(keys, names), "left_semi") if keys else rows
    return rows.select(*schema.names)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the condition is true; all other rows stay as they are."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}
    ).select(*df.columns)


def update_table(
    spark: SparkSession,
    path: str,
    condition: Column,
    values: dict[str, Column],
    partition_by: Sequence[str] | None = None,
) -> int:
    """Correct the rows that match and return the number of the new version.

    Only parts that hold such rows, or get some by the correction, are written; the new
    version shares all others with the versions before. ``condition`` and ``values`` must
    give the same on every read. Another ``partition_by`` than the table has, or a table
    without partitions, is written as a whole.
    """
    last = latest_version(spark, path)
    before = as_of(spark, path, last)
    parts = parts_of(spark, path, last)
    keys = [c for c in parts.columns if c != HOLDER]
    after = update_where(before, condition, values)
    asked = keys if partition_by is None else list(partition_by)
    if not keys or asked != keys or after.schema.simpleString() != before.schema.simpleString():
        return commit(after, path, "UPDATE", asked)
    matched = before.where(condition)
    moved = update_where(matched, F.lit(True), values)
    touched = matched.select(*keys).unionByName(moved.select(*keys)).distinct()
    touched, names = _renamed(stored(touched, "touched-parts"), keys)
    version = last + 1
    # A row of a touched part before the correction is in a touched part after it.
    same = _same_part(keys, names)
    written = update_where(before.join(touched, same, "left_semi"), condition, values)
    new = _write_folder(written, path, version, keys)
    kept = parts.join(touched, same, "left_anti")
    return _finish(spark, path, version, before.schema, kept.unionByName(new), "UPDATE")
