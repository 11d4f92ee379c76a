"""Hard negatives by threshold joins on an inverted index.

An ask is an anchor with a window of scores and the wish for rows of its own label or
of other ones. A threshold join finds, for every ask, the rows that score at least its
threshold: within a block of rows, dimensions are taken from the one with the least
energy up, and a row's first dimensions are left out of the index as long as their
norm alone cannot reach the least threshold of the block's asks. Scores are first
accumulated over the indexed dimensions; a pair goes on only if that and the product
of the two remaining norms reach the ask's threshold, and is then added up in full.

Thresholds start high and are lowered for the asks whose window is not yet filled,
until it is, or until the threshold has come to the window's lower end. A first run
finds the positives of every anchor, a second one the negatives of every (anchor,
positive): its window is a range of scores below the positive's.

Rows are grouped by length and spread over blocks of bounded size, asks likewise; a
task takes a block of each and returns at most k rows an ask. Labels play no part in
the spreading, so a hot label fills all tasks.

Defined cases: rows whose id, label or vector is null, or whose vector holds null or
non-finite components, take no part; vectors are compared with those of the same
dimension only; rows of the anchor's id never count; repeated rows count once; an id
with several rows counts once an ask, by its best score in the window, and each of its
rows is an anchor of its own; ties go to the smaller id; scores beyond 63 bits are an
error; an empty table gives an empty result; other columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, table

K = 5
SCALE = 256
EVERY = 100
LOW, HIGH = 80, 100
# Rows and asks of one task.
BLOCK = 1 << 12
ASKS = 1 << 13
# Anchors whose scores are held at once.
ANCHORS = 64
# Indexed parts of rows begin at a multiple of so many dimensions.
STEP = 8
# Thresholds of positives, as parts of the anchor's length times the greatest length.
COSINES = (0.7, 0.35)
# Thresholds of negatives, as parts of the window below its upper end.
PARTS = (8, 2)
# Products of vectors whose lengths multiply to less are exact in double.
EXACT = 2.0**52
LEAST, MOST = -(1 << 62), 1 << 62


def usable_rows(rows: DataFrame, id: str, vector: str, label: Column, scale: float) -> DataFrame:
    """vec_id, label and whole-number components of the rows that take part, once each."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    known = F.col(id).isNotNull() & F.col(vector).isNotNull() & label.isNotNull() & finite
    return (
        rows.where(known)
        .select(F.col(id).cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("vector"))
        .distinct()
    )


def norm_of(vector: str) -> Column:
    add = F.aggregate(vector, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return F.sqrt(add)


class Index:
    """Rows of a block, indexed for scores of at least some threshold.

    ``least`` is the smallest threshold divided by its anchor's length.
    """

    def __init__(self, vectors: np.ndarray, least: float) -> None:
        energy = (vectors.astype(float) ** 2).sum(0)
        self.order = np.argsort(energy, kind="stable")
        self.vectors = vectors[:, self.order]
        # Norm of each row's first dimensions, from none to all of them.
        squares = np.cumsum(self.vectors.astype(float) ** 2, axis=1)
        self.prefix = np.sqrt(np.concatenate([np.zeros((len(vectors), 1)), squares], axis=1))
        covered = (self.prefix * (1 + 1e-9) < least).sum(1) - 1
        self.first = np.maximum(0, covered) // STEP * STEP

    def pairs(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Positions of anchors and rows, and scores, of all pairs that reach a threshold."""
        anchors = anchors[:, self.order]
        found = []
        squares = np.cumsum(anchors.astype(float) ** 2, axis=1)
        prefix = np.sqrt(np.concatenate([np.zeros((len(anchors), 1)), squares], axis=1))
        for first in np.unique(self.first):
            rows = np.flatnonzero(self.first == first)
            if first >= anchors.shape[1]:
                continue  # even the whole of these rows stays below every threshold
            partial = anchors[:, first:] @ self.vectors[rows, first:].T
            remaining = np.outer(prefix[:, first], self.prefix[rows, first]) * (1 + 1e-9)
            a, r = np.nonzero(partial + remaining >= thresholds[:, None])
            scores = partial[a, r]
            if first:
                left, right = anchors[:, :first], self.vectors[rows, :first]
                for at in range(0, len(a), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    scores[some] += np.einsum("ij,ij->i", left[a[some]], right[r[some]])
            high = scores >= thresholds[a]
            found.append((a[high], rows[r[high]], scores[high]))
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best different ids, ties to the smaller one."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def search(asks: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The first k rows of a block for every ask: ask, vec_id, score."""
    names = ["ask", "vec_id", "score"]
    empty = pa.table({n: pa.array([], pa.int64()) for n in names})
    if not asks.num_rows or not rows.num_rows:
        return empty

    def column(t: pa.Table, name: str) -> np.ndarray:
        return t.column(name).to_numpy()

    def vectors(t: pa.Table) -> np.ndarray:
        flat = t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(t.num_rows, -1)

    # Asks of one anchor lie side by side; its vector is taken once.
    asks = asks.sort_by([("anchor", "ascending"), ("ask", "ascending")])
    anchor = column(asks, "anchor")
    starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    ends = [*starts[1:], len(anchor)]
    low, high = column(asks, "low"), column(asks, "high")
    same, label = column(asks, "same"), column(asks, "label")
    own, ask = column(asks, "vec_id"), column(asks, "ask")
    left, right = vectors(asks)[starts], vectors(rows)
    ids, labels = column(rows, "vec_id"), column(rows, "label")
    lengths = np.sqrt((left.astype(float) ** 2).sum(1))
    longest = np.sqrt((right.astype(float) ** 2).sum(1)).max(initial=0)
    largest = lengths.max(initial=0) * longest
    if largest >= MOST:
        raise OverflowError("a score does not fit 63 bits")
    if largest < EXACT:
        left, right = left.astype(float), right.astype(float)
    least = np.minimum.reduceat(low, starts)
    # Whole blocks are out of reach of the anchors whose threshold no length of them meets.
    reach = np.flatnonzero(lengths * longest * (1 + 1e-9) >= least)
    if not len(reach):
        return empty
    per_length = least[reach] / np.maximum(lengths[reach], 1e-300)
    index = Index(right, float(per_length.min()))
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    for at in range(0, len(reach), ANCHORS):
        chosen = reach[at : at + ANCHORS]
        a, r, scores = index.pairs(left[chosen], least[chosen])
        order = np.argsort(a, kind="stable")
        a, r, scores = a[order], r[order], scores[order].astype(np.int64)
        bounds = np.searchsorted(a, np.arange(len(chosen) + 1))
        for i, place in enumerate(chosen):
            part = slice(bounds[i], bounds[i + 1])
            mine, score = r[part], scores[part]
            for n in range(starts[place], ends[place]):
                fits = (labels[mine] == label[n]) == same[n]
                fits &= (score >= low[n]) & (score <= high[n]) & (ids[mine] != own[n])
                if fits.any():
                    out.append((ask[n], *best(ids[mine[fits]], score[fits], k)))
    if not out:
        return empty
    counts = [len(o[1]) for o in out]
    return pa.table(
        {
            "ask": pa.array(np.repeat([o[0] for o in out], counts), pa.int64()),
            "vec_id": pa.array(np.concatenate([o[1] for o in out]), pa.int64()),
            "score": pa.array(np.concatenate([o[2] for o in out]), pa.int64()),
        }
    )


def threshold_join(rows: DataFrame, plan: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """The first k rows of every ask that score from ``low`` to ``high``: ask, rank, vec_id, score."""
    spread = F.xxhash64("vec_id", "label", "vector")
    asks = asks.withColumn("dim", F.size("vector"))
    parts = asks.groupBy("dim").agg(F.ceil(F.count("*") / ASKS).cast("long").alias("parts"))
    plan = plan.join(parts, "dim")
    keys = ["dim", "length", "block", "part"]
    # A row meets every block of asks, an ask every block of rows.
    left = rows.join(plan, ["dim", "length"]).select(
        "dim",
        "length",
        F.pmod(spread, F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        "vec_id",
        "label",
        "vector",
    )
    right = asks.join(plan, "dim").select(
        "dim",
        "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("anchor"), F.col("parts")).alias("part"),
        "ask",
        "anchor",
        "vec_id",
        "label",
        "vector",
        "same",
        "low",
        "high",
    )

    def task(block: pa.Table, asking: pa.Table) -> pa.Table:
        return search(asking, block, k)

    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(task, "ask long, vec_id long, score long")
    )
    pairs = found.groupBy("ask", "vec_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("ask", "rank", "vec_id", "score")


def filled(
    rows: DataFrame, plan: DataFrame, asks: DataFrame, lows: list[Column], k: int, name: str
) -> DataFrame:
    """Run the join with one threshold after the other until every window is filled.

    The last threshold is a window's lower end, at which its result is complete.
    """
    results = []
    for turn, low in enumerate(lows):
        last = turn == len(lows) - 1
        asking = asks.withColumn("low", low)
        found = stored(threshold_join(rows, plan, asking, k), f"{name}-{turn}")
        if last:
            results.append(found)
            break
        # An ask has its k-th row or none.
        full = found.where(F.col("rank") == k).select("ask")
        results.append(found.join(full, "ask", "left_semi"))
        asks = stored(asks.join(full, "ask", "left_anti"), f"{name}-{turn}-rest")
        if asks.isEmpty():
            break
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def mine(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    k: int = K,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: float = SCALE,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """Negatives of every anchor and positive; ``is_anchor`` is a condition on ``vec_id``.

    A negative scores from ``low`` to ``high`` percent of the positive's score. Columns:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = rows.sparkSession
    points = stored(usable_rows(rows, id, vector, label, scale), "labelled-vectors")
    length = F.floor(F.log2(norm_of("vector") + 1)).cast("int")
    points = points.withColumn("dim", F.size("vector")).withColumn("length", length)
    sizes = points.groupBy("dim", "length").agg(
        F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"),
        F.max(norm_of("vector")).alias("longest"),
    )
    plan = stored(sizes, "row-blocks")
    longest = plan.agg(F.max("longest")).first()[0]
    if longest is None:
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, "
            "positive_score long, negative_score long",
        )
    if longest * longest >= MOST:
        raise OverflowError("a score does not fit 63 bits")
    plan = plan.drop("longest")
    # Numbers of anchors are written with them, so they stay what they are.
    anchors = points.where(is_anchor).drop("dim", "length")
    anchors = stored(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    asks = anchors.withColumns(
        {"ask": F.col("anchor"), "same": F.lit(True), "high": F.lit(MOST)}
    )
    reach = norm_of("vector") * longest
    lows = [F.floor(reach * c).cast("long") for c in COSINES]
    positives = filled(points, plan, asks, [*lows, F.lit(LEAST)], k, "positives")
    positives = positives.select(
        F.col("ask").alias("_anchor"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    # The window as whole numbers; below a score of 0 there is none.
    asked = anchors.join(positives, F.col("anchor") == F.col("_anchor")).where("positive_score >= 0")
    asked = asked.withColumns(
        {
            "ask": F.monotonically_increasing_id(),
            "same": F.lit(False),
            "high": F.expr(f"positive_score * {high} div 100"),
            "bottom": F.expr(f"(positive_score * {low} + 99) div 100"),
        }
    ).drop("_anchor")
    asked = stored(asked, "negative-asks")
    lows = [F.expr(f"high - (high - bottom) div {p}") for p in PARTS]
    keep = ["ask", "anchor", "vec_id", "label", "vector", "same", "high", "bottom"]
    found = filled(points, plan, asked.select(*keep), [*lows, F.col("bottom")], k, "negatives")
    named = asked.select(
        F.col("ask").alias("_ask"), F.col("vec_id").alias("anchor_id"), "positive_id", "positive_score"
    )
    return found.join(named, F.col("ask") == F.col("_ask")).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: negatives of every 100th embedding; every seventh row has a wrong label."""
    rows = table(spark, sf_dir, "embeddings")
    wrong = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, wrong).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % EVERY == 0, label)


SQL = f"""
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(CAST(x AS DOUBLE) * {SCALE}) FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND label IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
        CAST(list_sum([a.e[i] * r.e[i] FOR i IN range(1, len(a.e) + 1)]) AS BIGINT) AS score
    FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % {EVERY} = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {K}
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND {LOW} * p.positive_score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= {K}"""
