"""Exact dedup with two passes of Bloom filtering, by built-in functions only.

A filter is a table of bitmaps, one bit for each cell of a text's hash that more than
one row falls into. The first pass makes it from the hashes of all rows, the second
one, with another hash, from the rows that the first filter holds. A row that either
filter lacks is the only one of its text and passes straight through; the others are
shuffled by digest and counted exactly. The filters are broadcast: they have at most
``MAX_BITS`` bits whatever the number of rows. A fuller filter suspects more rows,
which costs shuffle and never changes a result.

A group with more than ``1 / HOT`` of the suspected rows is hot. There are fewer than
``HOT`` of them, so they are broadcast to their rows; the rows of other groups meet
theirs in a shuffled join.

Defined cases: a null text is an empty one; of equal texts the row with the largest
id stays, null is below all ids; of rows that share text and largest id exactly one
stays; an empty table gives an empty result. All columns of the input are kept; those
named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, table

# Bits for each row, and the most bits that a filter may have (32 MiB).
BITS_PER_ROW = 16
MAX_BITS = 1 << 28
# Bits of one bitmap of ``bitmap_construct_agg``.
BITMAP = 1 << 15
# A group with more than this part of the suspected rows is broadcast to them.
HOT = 1024
DIGEST = "text_sha256"
ADDED = ("keep_id", "group_size", "kept", DIGEST)


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the digest of its text."""
    return docs.withColumn(DIGEST, F.sha2(F.coalesce(text, F.lit("")), 256))


def filter_bits(n: int) -> int:
    """Size of a filter for n rows: a power of two, at least one bitmap."""
    bits = BITMAP
    while bits < min(MAX_BITS, n * BITS_PER_ROW):
        bits *= 2
    return bits


def cell(digest: Column, bits: int, seed: int) -> Column:
    """A digest's place in a filter, from 1 on, as the bitmap functions count."""
    return F.pmod(F.xxhash64(digest, F.lit(seed)), F.lit(bits)) + 1


def filled_twice(digests: DataFrame, bits: int, seed: int) -> DataFrame:
    """The filter of cells that more than one row falls into: bucket, bitmap.

    Rows of one cell are counted before the shuffle, so a text with very many copies
    sends one row per input task.
    """
    cells = digests.select(cell(F.col(DIGEST), bits, seed).alias("cell"))
    again = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap")
    return again.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(bitmap)


def with_verdict(rows: DataFrame, found: DataFrame, bits: int, seed: int, name: str) -> DataFrame:
    """Rows with a column that says whether the filter holds their digest."""
    place = cell(F.col(DIGEST), bits, seed)
    at = F.bitmap_bit_position(place)
    # A byte as a number; the lowest bit of a byte is its first position.
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    is_set = F.getbit(byte.cast("long"), F.pmod(at, F.lit(8)).cast("int")) == 1
    small = F.broadcast(found.withColumnsRenamed({"bucket": "_bucket", "bitmap": "_bitmap"}))
    joined = rows.join(small, F.bitmap_bucket_number(place) == F.col("_bucket"), "left")
    verdict = F.coalesce(is_set, F.lit(False)).alias(name)
    return joined.select(*rows.columns, verdict)


def suspected(rows: DataFrame) -> DataFrame:
    """Rows with ``_suspect``: whether both filters hold their digest."""
    digests = stored(rows.select(DIGEST), "copies-digests")
    bits = filter_bits(digests.count())
    first = stored(filled_twice(digests, bits, 1), "copies-first")
    some = with_verdict(digests, first, bits, 1, "_first").where("_first").drop("_first")
    some = stored(some, "copies-some")
    second_bits = filter_bits(some.count())
    second = stored(filled_twice(some, second_bits, 2), "copies-second")
    rows = with_verdict(rows, first, bits, 1, "_first")
    rows = with_verdict(rows, second, second_bits, 2, "_second")
    return rows.withColumn("_suspect", F.col("_first") & F.col("_second")).drop("_first", "_second")


def mark_copies(rows: DataFrame, id: str = "doc_id") -> DataFrame:
    """Hashed rows with keep_id, group_size and kept; no row is dropped."""
    columns = [c for c in rows.columns if c not in ADDED]
    inner = {c: f"_c{i}" for i, c in enumerate(columns)}
    plain = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], DIGEST)
    own = inner[id]
    tested = suspected(plain)
    only = tested.where("NOT _suspect").drop("_suspect").withColumns(
        {"keep_id": F.col(own), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    )
    # The mark is written with the row, so it stays what it is if a task runs again.
    suspects = stored(
        tested.where("_suspect").drop("_suspect").withColumn("_mark", F.monotonically_increasing_id()),
        "copies-suspects",
    )
    groups = suspects.groupBy(F.col(DIGEST).alias("_digest")).agg(
        F.count("*").alias("group_size"),
        F.max(own).alias("keep_id"),
        F.coalesce(F.max_by("_mark", own), F.max("_mark")).alias("_stays"),
    )
    groups = stored(groups, "copies-groups")
    floor = suspects.count() // HOT
    hot = F.broadcast(groups.where(F.col("group_size") > floor))
    in_hot = suspects.join(hot, F.col(DIGEST) == F.col("_digest"), "left")
    rest = groups.where(F.col("group_size") <= floor)
    others = suspects.join(hot, F.col(DIGEST) == F.col("_digest"), "left_anti").join(
        rest, F.col(DIGEST) == F.col("_digest")
    )
    confirmed = in_hot.where("_digest IS NOT NULL").unionByName(others)
    confirmed = confirmed.withColumn("kept", F.col("_mark") == F.col("_stays"))
    result = [F.col(n).alias(c) for c, n in inner.items()]
    result += ["keep_id", "group_size", "kept", DIGEST]
    return only.select(*result).unionByName(confirmed.select(*result))


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    marked = mark_copies(hashed(docs, text), id)
    return marked.where("kept").select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: copies among all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The texts are read once; only digests are looked at after that.
    return mark_copies(stored(hashed(docs).drop("text"), "copies-rows"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
