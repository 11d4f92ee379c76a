"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A few statistics describe each document. Random Fourier features of the
standardised statistics approximate a Gaussian kernel, so a linear fit on them is
a kernel fit. Partitions sum their part of the normal equations, Spark adds the
sums, and the driver solves one system whose size is the number of features. The
scores of labelled documents that the fit did not see give an isotonic map from
score to probability.

Defined cases: a null text is an empty one; an empty text has statistics (all 0)
and so a score; labels that are null, or whose doc_id is null or unknown, do not
count; a repeated label counts each time; without any usable label every score is
0.5; every row gives one row, repeated rows and null ids too; other columns of the
input are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.lines import filter_bits, holds, merged_filter
from tickloom.llm.tables import stored, table

FEATURES = 256
# Width of the Gaussian kernel, in standard deviations of a statistic.
WIDTH = 3.0
RIDGE = 1e-3
SEED = 7
# Steps of the score histogram that is calibrated.
STEPS = 256
# Of the labelled documents one in this many is kept from the fit, for calibration.
CALIBRATE = 4
STATISTICS = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "symbol_share",
    "upper_share",
    "digit_share",
    "stop_share",
    "bang_share",
    "other_punctuation_share",
    "high_byte_share",
    "line_words",
    "distinct_words",
    "distinct_lines",
    "same_as_previous_word",
    "most_frequent_word",
    "byte_entropy",
)


def _bytes_of(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


SYMBOL, DIGIT, STOP, BANG = (_bytes_of(c) for c in ("#*$%&|<>@~^_=+\\{}[]", "0123456789", ".", "!?"))
OTHER = _bytes_of(",;:'\"()-/")
UPPER = np.arange(ord("A"), ord("Z") + 1)
LETTERS = np.concatenate([UPPER, UPPER + 32])


def statistics(data: bytes) -> list[float]:
    """The numbers that describe a text, all 0 for one without words."""
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, total = len(words), len(data)
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    shares = counts[counts > 0] / total
    return [
        float(np.log1p(total)),
        float(np.log1p(n)),
        float(np.log1p(sum(map(len, words)) / n)),
        *(float(np.sqrt(counts[c].sum() / total)) for c in (SYMBOL,)),
        float(counts[UPPER].sum() / max(1, counts[LETTERS].sum())),
        *(float(np.sqrt(counts[c].sum() / total)) for c in (DIGIT, STOP, BANG, OTHER)),
        float(counts[128:].sum() / total),
        float(np.log1p(n / len(lines))),
        # Longer texts repeat more words: what is left is compared with the square root.
        float(np.log1p(len(tally)) / np.log1p(n)),
        len(set(lines)) / len(lines),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        max(tally.values()) / n,
        float(-(shares * np.log2(shares)).sum()),
    ]


def held_out(id: str) -> Column:
    """Documents that no label is learnt from; a null id is not held out."""
    rest = F.crc32(F.col(id).cast("string")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def hash_of(id: str) -> Column:
    """Of an id as text, which is the same whatever its type."""
    return F.xxhash64(F.col(id).cast("string"))


def describe(docs: DataFrame, id: str, text: str, marked: Callable | None = None) -> DataFrame:
    """doc_id, held_out, fit (whether its label is fitted or calibrated) and its statistics.

    ``marked`` tells by the hashes of ids (``hash_of``) which documents are described. It
    is asked in the same task, because a second Python step would need workers of its own.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if marked is not None:
                batch = batch.filter(pa.array(marked(batch.column("_hash").to_numpy())))
            rows = [
                np.array(statistics((t or "").encode("utf-8", "surrogatepass"))).tobytes()
                for t in batch.column("_text").to_pylist()
            ]
            kept = [batch.column(c) for c in ("doc_id", "held_out", "fit")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(rows, pa.binary())], names=["doc_id", "held_out", "fit", "stats"]
            )

    fit = F.coalesce(F.crc32(F.reverse(F.col(id).cast("string"))) % CALIBRATE != 0, F.lit(False))
    rows = docs.select(
        F.col(id).alias("doc_id"),
        held_out(id).alias("held_out"),
        fit.alias("fit"),
        F.col(text).alias("_text"),
        *([] if marked is None else [hash_of(id).alias("_hash")]),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, held_out boolean, fit boolean, stats binary")


def matrix(column: pa.Array) -> np.ndarray:
    """Statistics of a batch, a row per document."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.float64).reshape(-1, len(STATISTICS))


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return features(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.levels):
            return np.full(len(stats), 0.5)
        return np.interp(self.raw(stats), self.edges, self.levels)


def features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant; the same for one seed."""
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    cosines = np.sqrt(2 / FEATURES) * np.cos(((stats - mean) / scale) @ directions + phases)
    return np.hstack([cosines, np.ones((len(stats), 1))])


def added(rows: DataFrame, partial, width: int) -> np.ndarray:
    """Sum over all partitions of ``partial(batch)``, matrices of ``width`` columns.

    A partition sends one row per matrix row; Spark adds equal ones, and the
    driver gets a matrix whose size does not depend on the data.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int64()), pa.array([r.tobytes() for r in total], pa.binary())],
                names=["row", "sums"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sums[row] = sums.get(row, 0) + np.frombuffer(data, np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                names=["row", "sums"],
            )

    schema = "row long, sums binary"
    merged = rows.mapInArrow(task, schema).repartition("row").mapInArrow(add, schema).collect()
    out = [np.frombuffer(r["sums"], np.float64) for r in sorted(merged, key=lambda r: r["row"])]
    return np.array(out).reshape(-1, width)


def isotonic(counts: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """Non-decreasing rates of neighbouring pools, each with one extra half success of two."""
    pools: list[list[float]] = []
    for n, p in zip(counts, positives, strict=True):
        pools.append([float(n), float(p), 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), (p + 0.5) / (n + 1)) for n, p, k in pools])


def fit(labelled: DataFrame) -> Model:
    """Model of rows with stats, fit and label (0 or 1)."""
    width = len(STATISTICS)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("stats"))
        return np.array([np.full(width, len(x)), x.sum(0), (x * x).sum(0)], float)

    none = np.zeros(0)
    sums = added(labelled.select("stats"), moments, width)
    if not len(sums):
        return Model(none, none, none, none, none)
    n, mean = sums[0][0], sums[1] / sums[0][0]
    scale = np.sqrt(np.maximum(sums[2] / n - mean**2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)

    def normal(batch: pa.RecordBatch) -> np.ndarray:
        x = features(matrix(batch.column("stats")), mean, scale)
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.hstack([x.T @ x, (x.T @ y)[:, None]])

    size = FEATURES + 1
    system = added(labelled.where("fit").select("stats", "label"), normal, size + 1)
    if not len(system):
        system = np.zeros((size, size + 1))
    penalty = RIDGE * max(1.0, system[-1, -2]) * np.eye(size)
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(system[:, :-1] + penalty, system[:, -1])
    model = Model(mean, scale, weights, none, none)

    def histogram(batch: pa.RecordBatch) -> np.ndarray:
        # Scores of a 0-or-1 fit lie around that range; the ends take what is beyond.
        at = np.clip(model.raw(matrix(batch.column("stats"))), -0.5, 1.5)
        step = np.minimum(((at + 0.5) / 2 * STEPS).astype(int), STEPS - 1)
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.array([np.bincount(step, minlength=STEPS), np.bincount(step, y, STEPS)], float)

    tally = added(labelled.where("not fit").select("stats", "label"), histogram, STEPS)
    if not len(tally):  # too few labels to keep some back
        tally = added(labelled.select("stats", "label"), histogram, STEPS)
    used = tally[0] > 0
    middles = (np.arange(STEPS) + 0.5) / STEPS * 2 - 0.5
    levels = isotonic(tally[0][used], tally[1][used])
    return model._replace(edges=middles[used], levels=levels)


def scored(described: DataFrame, model: Model) -> DataFrame:
    kind = described.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(matrix(batch.column("stats"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= 0.5).astype(np.int32), pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return described.mapInArrow(
        task, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def learn(described: DataFrame, labels: DataFrame, id: str, label: str) -> Model:
    """A model from the labels of documents that are not held out."""
    marks = labels.select(F.col(id).alias("doc_id"), F.col(label).alias("label"))
    marks = marks.where(F.col("label").isin(0, 1))
    usable = described.where(~F.col("held_out")).select("doc_id", "fit", "stats")
    return fit(stored(usable.join(marks, "doc_id").select("fit", "stats", "label"), "labelled"))


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """The model of ``classify``; only documents that have a label are read for their statistics."""
    marks = labels.where(F.col(label).isin(0, 1)).select(hash_of(id).alias("hash"))
    marks = stored(marks, "marked")
    bits = filter_bits(marks.count())
    marked = holds(merged_filter(marks, bits, "once"), bits)
    described = describe(docs.where(~held_out(id)), id, text, marked)
    return learn(stored(described, "statistics"), labels, id, label)


def accepts(model: Model):
    """A column function: whether a text scores 0.5 or more. The model's size is fixed."""

    @F.pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        rows = [statistics(t.encode("utf-8", "surrogatepass")) for t in texts]
        return pd.Series(model.score(np.array(rows).reshape(-1, len(STATISTICS))) >= 0.5)

    return check


def classify(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """Score of every document: doc_id, held_out, score, predicted."""
    described = stored(describe(docs, id, text), "statistics")
    return scored(described, learn(described, labels, id, label))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: quality of every document."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
