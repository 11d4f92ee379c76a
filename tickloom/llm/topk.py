"""Exact top-k by inner product with norm buckets.

Candidates are grouped by length into buckets. A query runs through the buckets of
its share of the candidates from the longest down. Its k-th best score so far,
divided by its own and the bucket's length, is the cosine a candidate of the bucket
must reach: above 1 the bucket is skipped; if high, candidates are first pruned by
the range that a coordinate must lie in; if low, by length. Products of what is left
decide, so results are exact.

Blocks: candidates of a length group are spread over blocks of bounded size, queries
likewise, and a task takes a block of each; results of a query are merged by k rows
a block. Repeated rows count once; shares are by hash of id and vector, so vectors of
one id and equal vectors of many ids spread evenly.

Defined cases: vectors that are null or hold null or non-finite components take no
part; vectors are compared with those of the same dimension only; a candidate with
the query's id never counts; if an id has several vectors, a pair of ids has its best
score; ties go to the smaller id; null ids take no part; if two lengths multiply to
2^63 or more, whose score may not fit, an error is raised; an empty table gives an empty
result; other columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, table

K = 5
SCALE = 256
EVERY = 50
# Candidates and queries of one task.
BLOCK = 1 << 12
QUERIES = 1 << 12
# Candidates of a bucket, and queries that a bucket is multiplied with at once.
BUCKET = 1 << 9
ROWS = 256
# Local cosine from which coordinates prune better than lengths.
COORDINATE_FROM = 0.6
# Products of vectors with shorter lengths than this are exact in double.
EXACT_NORM = 2.0**26
# Products of two lengths must stay below this, less what rounding may hide.
MOST_SCORE = 2.0**63 * (1 - 1e-9)


def vectors(rows: DataFrame, id: str, vector: str, scale: float) -> DataFrame:
    """vec_id and whole-number components, without vectors that take no part."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    )
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return rows.where(F.col(id).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(id).cast("long").alias("vec_id"), whole.alias("vector")
    )


def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a batch of one dimension."""
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), -1) if len(ids) else flat.reshape(0, 0)


class Buckets:
    """Candidates by descending length, cut into buckets."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
        order = np.lexsort((ids, -norms))
        self.ids, self.vectors, self.norms = ids[order], vectors[order], norms[order]
        self.exact = not len(norms) or norms.max() < EXACT_NORM
        if self.exact:
            self.vectors = self.vectors.astype(float)
        self.starts = range(0, len(ids), BUCKET)
        self._units: dict[int, np.ndarray] = {}

    def unit(self, start: int) -> np.ndarray:
        """Directions of a bucket's candidates."""
        if start not in self._units:
            part = slice(start, start + BUCKET)
            norms = np.maximum(self.norms[part], 1e-300)[:, None]
            self._units[start] = self.vectors[part].astype(float) / norms
        return self._units[start]


def by_coordinate(unit: np.ndarray, query: np.ndarray, cosine: float) -> np.ndarray:
    """Candidates whose value in the query's largest coordinates allows the cosine.

    A unit vector p with cosine c or more to unit q has p_f within
    q_f * c -+ sqrt((1 - c*c) * (1 - q_f*q_f)), if that range holds no peak at q_f.
    """
    alive = np.ones(len(unit), bool)
    slack = 1e-9
    for f in np.argsort(-np.abs(query))[:3]:
        q = query[f]
        spread = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - q * q)))
        # Where the peak is inside, the bound on that side is 1.
        low = -1.0 if q < 0 and -q > cosine else q * cosine - spread
        high = 1.0 if q > 0 and q > cosine else q * cosine + spread
        alive &= (unit[:, f] >= low - slack) & (unit[:, f] <= high + slack)
    return np.flatnonzero(alive)


def merge(
    best: tuple[np.ndarray, np.ndarray], ids: np.ndarray, scores: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k best different ids of two lists."""
    ids, scores = np.concatenate([best[0], ids]), np.concatenate([best[1], scores])
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, found: Buckets, k: int = K
) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best k of one block for every query."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    best = [none] * len(query_ids)
    lengths = np.sqrt((queries.astype(float) ** 2).sum(1))
    if lengths.max(initial=0) * found.norms.max(initial=0) >= MOST_SCORE:
        raise OverflowError("vectors are too long: their scores may exceed 63 bits")
    exact = found.exact and (not len(lengths) or lengths.max() < EXACT_NORM)
    left = queries.astype(float) if exact else queries
    right = found.vectors if exact else found.vectors.astype(np.int64)
    for start in found.starts:
        ids, norms = found.ids[start : start + BUCKET], found.norms[start : start + BUCKET]
        pruned, rest = [], []
        for i in range(len(query_ids)):
            if len(best[i][0]) < k:
                rest.append((i, len(ids)))
                continue
            worst = float(best[i][1][-1])
            top = lengths[i] * norms[0]
            cosine = worst / top if top else (2.0 if worst > 0 else 0.0)
            if cosine > 1 + 1e-9:
                continue
            if cosine >= COORDINATE_FROM:
                pruned.append((i, cosine))
            else:
                # Length: later candidates of the bucket are too short.
                reach = len(ids)
                if worst > 0:
                    reach = int(np.searchsorted(-norms, -worst / lengths[i] * (1 - 1e-9), "right"))
                rest.append((i, reach))
        for i, cosine in pruned:
            some = by_coordinate(found.unit(start), queries[i] / lengths[i], cosine * (1 - 1e-9))
            if len(some):
                add(best, i, query_ids[i], ids[some], right[start + some] @ left[i], k)
        for at in range(0, len(rest), ROWS):
            part = rest[at : at + ROWS]
            reach = max(n for _, n in part)
            products = left[[i for i, _ in part]] @ right[start : start + reach].T
            for (i, _), scores in zip(part, products, strict=True):
                add(best, i, query_ids[i], ids[:reach], scores, k)
    return best


def add(best: list, i: int, query_id: int, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    """Merge a query's scores; only those that reach its k-th best are looked at."""
    have = best[i]
    some = np.arange(len(ids))
    if len(have[0]) == k:
        some = np.flatnonzero(scores >= have[1][-1])
    elif len(np.unique(ids)) == len(ids) and len(ids) > k + 1:
        # One more than k, as the query itself may be among them; with all ties.
        least = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        some = np.flatnonzero(scores >= least)
    some = some[ids[some] != query_id]
    if len(some):
        best[i] = merge(have, ids[some], scores[some].astype(np.int64), k)


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = K,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: float = SCALE,
) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score."""
    # Repeated rows change no result; they are merged before the shuffle.
    rows = stored(vectors(candidates, id, vector, scale).distinct(), "vectors")
    asked = stored(vectors(queries, id, vector, scale).distinct(), "queries")
    # Length groups: powers of two, so that a block's buckets are of similar length.
    norm = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    group = F.floor(F.log2(norm + 1)).cast("int")
    rows = rows.withColumn("dim", F.size("vector")).withColumn("length", group)
    # Numbers of blocks: one row per dimension and length group.
    sizes = rows.groupBy("dim", "length").agg(
        F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")
    )
    asked = asked.withColumn("dim", F.size("vector"))
    parts = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERIES).cast("long").alias("parts"))
    plan = stored(sizes.join(parts, "dim"), "blocks")
    spread = F.xxhash64("vec_id", "vector")
    # A candidate meets every query block, a query every candidate block.
    left = rows.join(plan, ["dim", "length"]).select(
        "dim",
        "length",
        F.pmod(spread, F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("asks"),
        "vec_id",
        "vector",
    )
    right = asked.join(plan, "dim").select(
        "dim",
        "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.pmod(spread, F.col("parts")).alias("part"),
        F.lit(True).alias("asks"),
        "vec_id",
        "vector",
    )
    keys = ["dim", "length", "block", "part"]

    def task(key: tuple, batches: Iterator[pa.Table]) -> pa.Table:
        asks = pc.equal(batches.column("asks"), True)
        both = [batches.filter(side).combine_chunks().to_batches() for side in (asks, pc.invert(asks))]
        if not all(both):  # a block that by chance got no row
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        query_ids, queries = arrays(both[0][0])
        ids, found = arrays(both[1][0])
        best = search_block(query_ids, queries, Buckets(ids, found), k)
        counts = [len(b[0]) for b in best]
        return pa.table(
            {
                "query_id": pa.array(np.repeat(query_ids, counts), pa.int64()),
                "vec_id": pa.array(np.concatenate([b[0] for b in best]), pa.int64()),
                "score": pa.array(np.concatenate([b[1] for b in best]), pa.int64()),
            }
        )

    schema = "query_id long, vec_id long, score long"
    found = left.unionByName(right).groupBy(*keys).applyInArrow(task, schema)
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the 5 best partners of every 50th vector."""
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))


SQL = f"""
WITH v AS (
    SELECT vec_id, [floor(CAST(x AS DOUBLE) * {SCALE}) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
