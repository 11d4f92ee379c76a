"""Line dedup with a pair of Bloom filters.

One pass puts the key hash of every long line into a filter of hashes seen once,
and into a second one what was there before: its bits hold every hash that occurs
twice. Partitions build their own pair; pairs merge by OR, and what is in both
first filters joins the second. Only keys that the second filter suspects are
shuffled and counted exactly, by 128-bit key, and only texts of documents that
may lose a line are joined with what they lose; a filter of their ids tells them.

Defined cases: a null or empty text is one empty line; rows that share a doc_id
are one document, also those of null doc_id, which is below all others; lines of
repeated rows count once; an empty table gives an empty result. All columns of
the input are kept; the added ones must not be among them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.tables import BLANK_CHARS, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 40
MIN_DOCS = 5
# Bits for each long line, and the most bits that a filter may have (32 MiB). A
# fuller filter suspects more lines, which are then counted exactly all the same.
BITS_PER_LINE = 16
MAX_BITS = 1 << 28
HASHES = 3
# The filters are merged in pieces of this many bytes.
SEGMENT = 1 << 18


def key(line: Column) -> Column:
    """Blanks stripped at both ends, ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANK_CHARS)), UPPER, LOWER)


def long_keys(text: Column, least: int = MIN_LENGTH) -> Column:
    """Different keys of at least ``least`` code points."""
    keys = F.transform(split_lines(text), key)
    return F.array_distinct(F.filter(keys, lambda k: F.length(k) >= least))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each hash: a row per hash function."""
    low = hashes.view(np.uint64) & np.uint64(0xFFFFFFFF)
    high = (hashes.view(np.uint64) >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (low + steps * high) & np.uint64(bits - 1)


def has(filter_bytes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all bits of a hash are set."""
    found = (filter_bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return found.all(axis=0)


def put(filter_bytes: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    bit = np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))
    np.bitwise_or.at(filter_bytes, (at >> np.uint64(3)).astype(np.int64), bit)


def _build(bits: int):
    """Task: hashes of one partition to the pieces of its two filters."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False)
            hashes, counts = np.unique(hashes, return_counts=True)
            at = positions(hashes, bits)
            again = has(once, at) | (counts > 1)
            put(twice, at[:, again])
            put(once, at)
        for start in range(0, len(once), SEGMENT):
            a, b = once[start : start + SEGMENT], twice[start : start + SEGMENT]
            if a.any():
                packed = [[start], [zlib.compress(a.tobytes(), 1)], [zlib.compress(b.tobytes(), 1)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(packed[0], pa.int64()), *[pa.array(p, pa.binary()) for p in packed[1:]]],
                    names=["start", "once", "twice"],
                )

    return build


def _merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: pieces sorted by start to one merged pair per start."""
    start, once, twice = None, None, None

    def result() -> pa.RecordBatch:
        packed = [pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in (once, twice)]
        return pa.RecordBatch.from_arrays(
            [pa.array([start], pa.int64()), *packed], names=["start", "once", "twice"]
        )

    for batch in rows:
        for at, a, b in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
            if at != start:
                if start is not None:
                    yield result()
                start, once, twice = at, a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if start is not None:
        yield result()


def filter_bits(n: int) -> int:
    """Size of a filter for n hashes, a power of two and at most ``MAX_BITS``."""
    bits = 1 << 16
    while bits < min(MAX_BITS, n * BITS_PER_LINE):
        bits *= 2
    return bits


def merged_filter(hashes: DataFrame, bits: int, part: str):
    """One filter ("once" or "twice") over a column of hashes, compressed, as a broadcast.

    Its size is bounded by ``MAX_BITS``, whatever the number of hashes.
    """
    pieces = hashes.mapInArrow(_build(bits), "start long, once binary, twice binary")
    merged = (
        pieces.repartition("start")
        .sortWithinPartitions("start")
        .mapInArrow(_merge, "start long, once binary, twice binary")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.select("start", part).collect():
        piece = np.frombuffer(zlib.decompress(row[part]), np.uint8)
        out[row["start"] : row["start"] + len(piece)] = piece
    return hashes.sparkSession.sparkContext.broadcast(zlib.compress(out.tobytes(), 1))


def holds(shared, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    """A function for tasks: which of the hashes the filter may hold."""
    cache: dict[str, np.ndarray] = {}

    def check(hashes: np.ndarray) -> np.ndarray:
        if "filter" not in cache:
            cache["filter"] = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        return has(cache["filter"], positions(np.array(hashes, np.int64), bits))

    return check


def maybe_in(shared, bits: int):
    """A column function: whether the filter holds a hash."""
    held = holds(shared, bits)

    @F.pandas_udf("boolean")
    def check(hashes: pd.Series) -> pd.Series:
        return pd.Series(held(hashes.to_numpy(np.int64)))

    return check


def repeated(
    docs: DataFrame, id: str, text: str, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The keys to drop from each document: doc, keys (as 128-bit hashes)."""
    keys = F.explode(long_keys(F.col(text), min_length)).alias("key")
    rows = docs.select(F.col(id).alias("doc"), keys).select(
        "doc", F.xxhash64("key").alias("hash"), F.unhex(F.md5("key")).alias("key")
    )
    rows = stored(rows, "line-keys")
    bits = filter_bits(rows.count())
    twice = merged_filter(rows.select("hash"), bits, "twice")
    suspects = rows.where(maybe_in(twice, bits)("hash")).select("doc", "key")
    suspects = stored(suspects.distinct(), "line-suspects")
    # Few rows per key reach one task: counts and the largest id are combined before the shuffle.
    often = suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
    often = stored(often.where(F.col("n") >= min_docs).drop("n"), "lines-often")
    losing = suspects.join(often, "key").where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return losing.groupBy("doc").agg(F.collect_list("key").alias("keys"))


def without_lost(min_length: int):
    """A column function: a text without the long lines whose key is lost, and how many went."""
    lower = str.maketrans(UPPER, LOWER)

    def digest(line: str) -> bytes:
        return hashlib.md5(line.strip(BLANK_CHARS).translate(lower).encode()).digest()

    @F.pandas_udf("text string, dropped long")
    def cut(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
        rows = []
        for text, keys in zip(texts, lost, strict=True):
            if keys is None:
                rows.append((text, 0))
                continue
            # One look-up per line, whatever the number of keys.
            gone, found = {bytes(k) for k in keys}, (text or "").split("\n")
            kept = [x for x in found if len(x) < min_length or digest(x) not in gone]
            rows.append(("\n".join(kept), len(found) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "dropped"])

    return cut


def dedup(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The input with its text replaced by the kept lines, n_lines and n_dropped added."""
    losing = repeated(docs, id, text, min_length, min_docs)
    losing = losing.withColumnRenamed("doc", "_doc").withColumnRenamed("keys", "_keys")
    losing = stored(losing, "line-losers")
    bits = filter_bits(losing.count())
    ids = merged_filter(losing.select(F.xxhash64("_doc")), bits, "once")
    may_lose = maybe_in(ids, bits)(F.xxhash64(id))
    # The same join at every size; texts need no sorting for it.
    lost = losing.hint("shuffle_hash")
    joined = docs.where(may_lose).join(lost, F.col(id).eqNullSafe(F.col("_doc")), "left")
    joined = joined.withColumn("_kept", without_lost(min_length)(text, "_keys"))

    def result(rows: DataFrame, new_text: Column, dropped: Column) -> DataFrame:
        columns = [new_text.alias(c) if c == text else F.col(c) for c in docs.columns]
        n_lines = F.size(split_lines(F.col(text))).cast("long").alias("n_lines")
        return rows.select(*columns, n_lines, dropped.cast("long").alias("n_dropped"))

    clean = result(docs.where(~may_lose), F.col(text), F.lit(0))
    return clean.unionByName(result(joined, F.col("_kept.text"), F.col("_kept.dropped")))


def without(docs: DataFrame, id: str, ids: DataFrame) -> DataFrame:
    """Documents whose id is not in a one-column frame of different ids.

    Only rows that a filter of the ids holds are shuffled with them.
    """
    name = ids.columns[0]
    bits = filter_bits(ids.count())
    maybe = maybe_in(merged_filter(ids.select(F.xxhash64(name)), bits, "once"), bits)(F.xxhash64(id))
    checked = docs.where(maybe).join(ids, F.col(id) == F.col(name), "left_anti")
    return docs.where(~maybe).unionByName(checked)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: line dedup of all documents."""
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def kept_sql(documents: str = "documents") -> str:
    """Kept lines as SQL: ``WITH`` clauses that end in ``kept``."""
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    lines AS (
        SELECT doc_id, n, line, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS key
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                     generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
              FROM {documents})
    ),
    often AS (
        SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= {MIN_LENGTH}
        GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
    ),
    kept AS (
        SELECT l.doc_id, count(*) AS n_lines,
            count(*) FILTER (o.key IS NOT NULL AND l.doc_id <> o.keeper) AS n_dropped,
            coalesce(string_agg(line, chr(10) ORDER BY n)
                FILTER (o.key IS NULL OR l.doc_id = o.keeper), '') AS text
        FROM lines l LEFT JOIN often o ON l.key = o.key GROUP BY l.doc_id
    )"""


SQL = f"WITH {kept_sql()} SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept"
