"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are stored in blocks. Each step multiplies them with a vector
(u = X q) and the result with their transpose (w = X'u), both in one pass in which a
task sums its blocks; per task only a number for each dimension is shuffled. A left
vector is never stored: it is u = X p for a short vector p, so its products with all
earlier ones follow from the same sums (U'u = P'w), and full reorthogonalisation on
both sides needs no row of it. The singular values of the small triangular matrix U'XV give the deviations of
the components, its right singular vectors turn V into the components.

With at most ``FULL`` dimensions all steps are taken, so the decomposition is complete
and equal deviations are told apart by restarts from fresh directions. Beyond, steps
end when the wanted components no longer change; a deviation that occurs several
times may then be found once.

Defined cases: vectors that are null, empty or hold null or non-finite components take
no part; the others must have one dimension, else an error is raised; a null id is
kept; repeated rows are rows of their own; components without variance are left out,
so one row or equal rows alone give an empty result, as does an empty table; other
columns of the input are left out. Sums and the deviation of a row are exact; what
does not fit 63 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
# Rows of a stored block.
BLOCK = 1 << 12
# Up to this many dimensions every step is taken.
FULL = 256
# What is this small beside the largest value is taken for rounding.
ROUNDING = 1e-12


def whole_vectors(rows: DataFrame, id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """vec_id and whole-number components of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long") + F.lit(shift))
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & finite
    return rows.where(usable).select(F.col(id).cast("long").alias("vec_id"), whole.alias("x"))


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, dim)


def totals(rows: DataFrame, dim: int) -> list[int]:
    """The exact sum of every dimension; a task sends one row per dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * dim
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                x = matrix(batch.slice(start, BLOCK), dim)
                # Halves of the numbers, so that no sum of a block leaves 64 bits.
                high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
                sums = [s + (int(h) << 32) + int(l) for s, h, l in zip(sums, high, low, strict=True)]
        texts = pa.array([str(s) for s in sums], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), texts], names=["at", "sum"])

    parts = rows.select("x").mapInArrow(task, "at int, sum string")
    sums = parts.groupBy("at").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    return [int(r["sum"]) for r in sums.orderBy("at").collect()]


def exact_offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S as whole numbers."""
    largest = n * max(1, int(np.abs(x).max(initial=0))) + max(abs(s) for s in sums)
    kind = np.int64 if largest < 1 << 62 else object
    return n * x.astype(kind) - np.array(sums, kind)


def deviations(offsets: np.ndarray) -> np.ndarray:
    """Sum of the squared offsets of each row, exact."""
    largest = int(np.abs(offsets).max(initial=0))
    if largest * largest * max(1, offsets.shape[1]) < 1 << 63:
        return (offsets.astype(np.int64) ** 2).sum(1)
    found = [sum(int(v) * int(v) for v in row) for row in offsets]
    if max(found, default=0) >= 1 << 63:
        raise OverflowError("the deviation of a row does not fit 63 bits")
    return np.array(found, np.int64)


def centred_blocks(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Blocks of rows: ids, deviations, centred components as bytes."""
    dim = len(sums)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                offsets = exact_offsets(matrix(piece, dim), n, sums)
                centred = (offsets / n).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([deviations(offsets)], pa.list_(pa.int64())),
                        pa.array([centred.tobytes()], pa.binary()),
                    ],
                    names=["ids", "deviations", "x"],
                )

    return rows.mapInArrow(task, "ids array<long>, deviations array<long>, x binary")


def block_sums(blocks: DataFrame, dim: int, of) -> np.ndarray:
    """Sum over all blocks of ``of(block)``, a vector of bounded length."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("x"):
                found = of(np.frombuffer(data.as_buffer(), float).reshape(-1, dim))
                total = found if total is None else total + found
        if total is not None:
            at = pa.array(np.arange(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array(total, pa.float64())], names=["at", "sum"])

    parts = blocks.select("x").mapInArrow(task, "at int, sum double")
    sums = parts.groupBy("at").agg(F.sum("sum").alias("sum")).collect()
    return np.array([r["sum"] for r in sorted(sums, key=lambda r: r["at"])])


def fresh(v: np.ndarray, dim: int, rng: np.random.Generator) -> np.ndarray:
    """A unit vector at right angles to the given columns."""
    new = rng.normal(size=dim)
    for _ in range(2):
        new -= v @ (v.T @ new)
    return new / np.linalg.norm(new)


def bidiagonalise(blocks: DataFrame, dim: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of the rows, and their right vectors as columns."""
    rng = np.random.default_rng(20)
    v = fresh(np.zeros((dim, 0)), dim, rng)[:, None]
    p, z = np.zeros((dim, 0)), np.zeros((dim, 0))
    t = np.zeros((0, 0))
    scale, q = 0.0, v[:, 0]
    while True:
        j = v.shape[1] - 1
        # u = X q, at right angles to the earlier ones; X'u and all products in one pass.
        upper = t[:, j] if j else np.zeros(0)
        for _ in range(3):
            sums = block_sums(blocks, dim, products(q))
            w, square = sums[:dim], sums[-1]
            c = p.T @ w  # U'u, as U = X P
            size = np.sqrt(max(0.0, square - c @ c))
            q, w, upper = q - p @ c, w - z @ c, upper + c
            if np.linalg.norm(c) <= 1e-8 * size or size <= ROUNDING * scale:
                break
        scale = max(scale, size)
        alone = size > ROUNDING * scale and size > 0
        alpha = size if alone else 0.0
        p = np.column_stack([p, q / size if alone else np.zeros(dim)])
        z = np.column_stack([z, w / size if alone else np.zeros(dim)])
        grown = np.zeros((j + 1, j + 1))
        grown[:j, :j], grown[:j, j], grown[j, j] = t[:j, :j], upper, alpha
        t = grown
        if j + 1 == dim:
            break
        # The next right vector: what X'u has beside all earlier ones.
        rest = z[:, j].copy()
        for _ in range(2):
            rest -= v @ (v.T @ rest)
        beta = float(np.linalg.norm(rest))
        if dim > FULL and j + 1 >= wanted:
            left, values, _ = np.linalg.svd(t)
            if np.all(beta * np.abs(left[j, :wanted]) <= ROUNDING * values[0]):
                break
        if beta > ROUNDING * scale:
            new = rest / beta
        else:
            new = fresh(v, dim, rng)
        coupled = z.T @ new
        v = np.column_stack([v, new])
        # X v is this part of the earlier left vectors, and u for the rest.
        t = np.column_stack([t, coupled])
        q = new - p @ coupled
    _, values, right = np.linalg.svd(t)
    return values, v @ right.T


def products(q: np.ndarray):
    """Sums of a block for u = X q: X'u and the square of u."""

    def of(x: np.ndarray) -> np.ndarray:
        u = x @ q
        return np.concatenate([u @ x, [u @ u]])

    return of


def moments(directions: np.ndarray):
    """Sums of a block's whitened rows and of their products."""

    def of(x: np.ndarray) -> np.ndarray:
        y = x @ directions
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    return of


def identity_error(blocks: DataFrame, dim: int, n: int, directions: np.ndarray) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    k = directions.shape[1]
    sums = block_sums(blocks, dim, moments(directions))
    mean = sums[:k] / n
    covariance = sums[k:].reshape(k, k) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(
    rows: DataFrame,
    components: int = COMPONENTS,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """A row for every vector and component, see the column names of the schema."""
    spark = rows.sparkSession
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    points = stored(whole_vectors(rows, id, vector, scale, shift), "whole-vectors")
    seen = points.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    n, dim = seen[0], seen[1]
    if not n:
        return spark.createDataFrame([], schema)
    if dim != seen[2]:
        raise ValueError(f"vectors of {dim} and of {seen[2]} dimensions have no common covariance")
    blocks = stored(centred_blocks(points, n, totals(points, dim)), "centred-blocks")
    values, right = bidiagonalise(blocks, dim, min(components, dim))
    variances = values**2 / n
    trace = float(block_sums(blocks, dim, lambda x: np.array([(x * x).sum()]))[0]) / n
    k = min(components, int((values > 1e-9 * values[0]).sum())) if values[0] > 0 else 0
    if not k:
        return spark.createDataFrame([], schema)
    directions = right[:, :k] / np.sqrt(variances[:k])
    explained = variances[:k] / trace
    error = identity_error(blocks, dim, n, directions)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                y = np.frombuffer(row["x"], float).reshape(-1, dim) @ directions
                m = len(y)
                ids = pa.array(row["ids"], pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(np.repeat(np.array(row["deviations"], np.int64), k)),
                        pa.array(y.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return blocks.mapInArrow(task, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all embeddings whitened."""
    return whiten(table(spark, sf_dir, "embeddings"))
