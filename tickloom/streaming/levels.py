"""Results of a stream's batches, merged level by level.

Every batch writes a folder of its own. Each time ``FAN`` folders of a level are
complete, one of the next level takes their place, so a reader opens a number of folders
that grows with the logarithm of the batches. Which folders stand for a batch follows
from their names alone: the highest level that is complete. A folder is complete with
Spark's mark of a finished job, so a reader sees either the parts or their merger; parts
are removed by a later batch. A replayed batch writes and merges the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FAN = 4
Merge = Callable[[DataFrame], DataFrame]


def _folder(path: str, level: int, first: int) -> str:
    return f"{path}/level={level}/first={first}"


def complete(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Level and first batch of every finished folder, highest level first."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/level=*/first=*/_SUCCESS")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(pattern) or []:
        folder = status.getPath().getParent()
        level, first = folder.getParent().getName(), folder.getName()
        found.append((int(level.split("=")[1]), int(first.split("=")[1])))
    return sorted(found, key=lambda f: (-f[0], f[1]))


def _covers(outer: tuple[int, int], inner: tuple[int, int]) -> bool:
    return outer[0] > inner[0] and outer[1] <= inner[1] < outer[1] + FAN ** outer[0]


def current(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The folders that together stand for every batch once."""
    chosen: list[tuple[int, int]] = []
    for folder in complete(spark, path):
        if not any(_covers(c, folder) for c in chosen):
            chosen.append(folder)
    return chosen


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches as far as they are merged; the reader merges the rest."""
    folders = [_folder(path, *f) for f in current(spark, path)]
    return spark.read.parquet(*folders)


def add(df: DataFrame, path: str, batch_id: int, merge: Merge) -> None:
    """Write a batch's rows, and merge the levels that they complete."""
    spark = df.sparkSession
    _remove_merged(spark, path, batch_id)
    df.write.mode("overwrite").parquet(_folder(path, 0, batch_id))
    level, size = 1, FAN
    while (batch_id + 1) % size == 0:
        first, part = batch_id + 1 - size, size // FAN
        parts = [(level - 1, first + i * part) for i in range(FAN)]
        if not set(parts) <= set(complete(spark, path)):
            break  # a replay whose parts a later level already holds
        rows = spark.read.schema(df.schema).parquet(*[_folder(path, *p) for p in parts])
        merge(rows).select(*df.columns).write.mode("overwrite").parquet(_folder(path, level, first))
        level, size = level + 1, size * FAN


def _remove_merged(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove parts of mergers that an earlier batch has finished."""
    folders = complete(spark, path)
    for folder in folders:
        covering = [c for c in folders if _covers(c, folder) and c[1] + FAN ** c[0] <= batch_id]
        if covering:
            target = spark._jvm.org.apache.hadoop.fs.Path(_folder(path, *folder))
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
