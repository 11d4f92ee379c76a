"""Pack documents into batches of nearly equal length.

A histogram of lengths over all documents is small: lengths up to 65,536 have a bin
each, longer ones 64 bins a doubling. Dynamic programming over its bins chooses the
bucket boundaries with the least padding; above 65,536 a boundary is chosen among the
bins and then lowered to the longest document below it. Within a bucket, documents in
a shuffled order fill batches of at most ``budget``, padding included. The unit is a
parameter; the query counts blank-separated words.

Defined cases: a null text (or length) has length 0; a document above the budget is a
batch of its own, whole; repeated rows are documents of their own; a null id is an id;
an empty table gives an empty result; other columns of the input are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.tables import each_copy, running_total, stored, table, word_count

BUCKETS = 16
BUDGET = 16_384
# Lengths up to EXACT have a bin each; above, STEPS bins a doubling.
EXACT = 1 << 16
STEPS = 64
CHUNK_ROWS = 4096


def bin_top(length: Column) -> Column:
    """The largest length in the bin of a length."""
    long = F.greatest(length, F.lit(EXACT + 1))
    # The bin width is the power of two below the length, divided by STEPS.
    width = F.pow(F.lit(2.0), F.floor(F.log2((long - 1).cast("double")))) / STEPS
    top = (F.ceil(long / width) * width).cast("long")
    return F.when(length <= EXACT, length).otherwise(top)


def histogram(rows: DataFrame) -> list[tuple[int, int]]:
    """Bin and number of documents, ascending; its size grows with log(longest) only."""
    counted = rows.groupBy(bin_top(F.col("length")).alias("top")).agg(F.count("*").alias("n"))
    return sorted((r["top"], r["n"]) for r in counted.collect())


def best_splits(cost: np.ndarray, tops: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each j the i below it with the least ``cost[i] + tops[j - 1] * (upto[j] - upto[i])``.

    The best i never decreases with j, so the middle of a range of j bounds what its
    halves have to look at; all middles of a level are taken at once.
    """
    n = len(tops)
    better, before = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    low, high = np.array([1]), np.array([n])
    least, most = np.array([0]), np.array([n - 1])
    while len(low):
        middle = (low + high) // 2
        ends = np.minimum(most, middle - 1)
        sizes = ends - least + 1
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        which = np.repeat(np.arange(len(middle)), sizes)
        i = np.arange(len(which)) - starts[which] + least[which]
        j = middle[which]
        total = cost[i] + tops[j - 1] * (upto[j] - upto[i])
        found = np.minimum.reduceat(total, starts)
        # The first place of each segment that has its minimum.
        hits = np.flatnonzero(total == found[which])
        chosen = i[hits[np.unique(which[hits], return_index=True)[1]]]
        better[middle], before[middle] = found, chosen
        left, right = low < middle, middle < high
        low, high, least, most = (
            np.concatenate([low[left], middle[right] + 1]),
            np.concatenate([middle[left] - 1, high[right]]),
            np.concatenate([least[left], chosen[right]]),
            np.concatenate([chosen[left], most[right]]),
        )
    return better, before


def boundaries(bins: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total of end times count.

    Padding is that total minus the sum of lengths, which no choice changes.
    """
    if not bins:
        return []
    tops = np.array([t for t, _ in bins], dtype=float)
    upto = np.concatenate([[0.0], np.cumsum([n for _, n in bins], dtype=float)])
    # cost[j]: the first j bins in the buckets so far.
    cost = np.concatenate([[0.0], np.full(len(tops), np.inf)])
    choice = []
    for _ in range(min(buckets, len(tops))):
        cost, before = best_splits(cost, tops, upto)
        choice.append(before)
    ends, j = [], len(tops)
    for before in reversed(choice):
        if j:
            ends.append(int(tops[j - 1]))
            j = int(before[j])
    return ends[::-1]


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    length: Column | None = None,
) -> DataFrame:
    """Bucket and batch of every document.

    ``length`` is what the budget counts, such as a column of token counts; without it,
    blank-separated words. Columns: doc_id, length, bucket (its end: what the document
    is padded to, the longest length in it), padding, batch (number within the bucket,
    from 0), place (in the batch).
    """
    place = F.md5(F.concat_ws("|", F.col(id).cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    size = word_count(text) if length is None else F.coalesce(length.cast("long"), F.lit(0).cast("long"))
    rows = docs.select(F.col(id).alias("doc_id"), size.alias("length"), place.alias("mix"))
    rows = stored(rows, "lengths")
    bins = histogram(rows)
    ends = boundaries(bins, buckets)
    if not ends:
        return rows.select(
            "doc_id",
            "length",
            *[F.lit(0).cast("long").alias(c) for c in ("bucket", "padding", "batch", "place")],
        )
    top = bin_top(F.col("length"))
    bucket = F.element_at(F.filter(F.lit(ends), lambda end: end >= top), 1).cast("long")
    # A bucket ends at its longest document, not at the end of that one's bin.
    if ends[-1] > EXACT:
        longest = rows.groupBy(bucket.alias("end")).agg(F.max("length").alias("longest"))
        ends = sorted(r["longest"] for r in longest.collect())
        bucket = F.element_at(F.filter(F.lit(ends), lambda end: end >= F.col("length")), 1).cast("long")
    # Equal rows are one entry with a number of copies, which lie side by side.
    rows = rows.withColumn("bucket", bucket).groupBy("doc_id", "length", "mix", "bucket")
    rows = rows.agg(F.count("*").alias("copies"))
    n, digits, cells = sum(n for _, n in bins), 1, 16
    while n > cells * CHUNK_ROWS // 4:
        digits, cells = digits + 1, cells * 16
    ranked = running_total(
        rows, ["bucket"], ["mix", "doc_id"], F.col("copies"), "rank", F.substring("mix", 1, digits)
    )
    ranked = each_copy(ranked, "copies", "nth").withColumn("rank", F.col("rank") + F.col("nth"))
    fit = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket"))))
    return ranked.select(
        "doc_id",
        "length",
        "bucket",
        (F.col("bucket") - F.col("length")).alias("padding"),
        F.floor(F.col("rank") / fit).cast("long").alias("batch"),
        (F.col("rank") % fit).cast("long").alias("place"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: length buckets and batches of all documents."""
    return pack(table(spark, sf_dir, "documents"))
