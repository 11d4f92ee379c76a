"""Exact dedup, hard negatives and whitening against plain versions."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import copies, negatives, whitening


def plain_copies(rows):
    """Per (id, text): keep_id, size and how many of its rows stay."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1 << 28, copies.BITMAP])
def test_exact_copies(spark, monkeypatch, bits):
    monkeypatch.setattr(copies, "MAX_BITS", bits)
    docs = fixtures.frame(spark)
    marked = copies.mark_copies(copies.hashed(docs))
    assert marked.columns == [*docs.columns, "keep_id", "group_size", "kept", "text_sha256"]
    got = marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    want = plain_copies([r[:2] for r in fixtures.documents()])
    assert sorted(map(tuple, got.collect()), key=repr) == want
    kept = copies.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == sum(w[3] for w in want)
    assert copies.dedup(fixtures.empty(spark)).count() == 0


def test_clashing_columns_are_replaced(spark):
    df = spark.createDataFrame(
        [(1, "a", 9, "x", "y"), (2, "a", 9, "x", "y"), (3, "b", 9, "x", "y")],
        "doc_id long, text string, keep_id int, text_sha256 string, `a.b` string",
    )
    got = copies.mark_copies(copies.hashed(df))
    assert got.columns == ["doc_id", "text", "a.b", "keep_id", "group_size", "kept", "text_sha256"]
    assert {(r.doc_id, r.keep_id, r.kept) for r in got.collect()} == {(1, 2, False), (2, 2, True), (3, 3, True)}


def test_a_hot_group_and_a_hot_row(spark):
    rows = [(i, "hot") for i in range(3000)] + [(7, "row")] * 3000 + [(i, f"t{i}") for i in range(3000)]
    rows += [(i, f"t{i % 50}") for i in range(5000, 5100)] + [(None, "none")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = copies.mark_copies(copies.hashed(df)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        (w if w[1] is not None else w for w in plain_copies(rows)), key=repr
    )


def test_rows_that_are_alone_pass_without_a_shuffle(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    tested = copies.suspected(copies.hashed(df))
    # Nearly all rows are alone, and the two filters together say so.
    assert tested.where("_suspect").count() < 200


def plain_negatives(rows, k=5):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else tuple(math.floor(256 * x) for x in v)

    usable = set()
    for i, v, label in rows:
        if i is not None and label is not None and whole(v) is not None:
            usable.add((i, (label + 1) % 10 if i % 7 == 0 else label, whole(v)))
    out = []
    for i, label, a in usable:
        if i % 100:
            continue
        same, other = defaultdict(list), defaultdict(list)
        for j, m, b in usable:
            if j != i and len(a) == len(b):
                (same if m == label else other)[j].append(sum(x * y for x, y in zip(a, b, strict=True)))
        for s, p in sorted((-max(x), j) for j, x in same.items())[:k]:
            fits = {j: [x for x in scores if -80 * s <= 100 * x <= -100 * s] for j, scores in other.items()}
            found = sorted((-max(x), j) for j, x in fits.items() if x)[:k]
            out += [(i, p, rank, j, -s, -x) for rank, (x, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_negatives(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 64), ("ASKS", 8), ("ANCHORS", 3), ("STEP", 1)):
            monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6))
    rows = []
    for i in range(700):
        label = i % 4
        v = centres[label] * rng.choice([0.2, 1, 3]) + rng.normal(size=6) * 0.4
        rows.append((i, v.tolist(), label))
    rows += [(700 + i, [0.5] * 6, i % 3) for i in range(150)]  # ties
    rows += [(900, None, 1), (1000, [1.0] * 6, None), (1100, [float("nan")] * 6, 1), (1200, [None] * 6, 1)]
    rows += [(1300, [], 1), (1301, [], 2), (1400, [1.0, 2.0], 1), (1401, [2.0, 1.0], 2), (None, [1.0] * 6, 1)]
    rows += [(1500, [0.0] * 6, 1), (1600, [-4.0] * 6, 8), (200, [0.3] * 6, 2), rows[3], rows[100], rows[100]]
    df = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, rank string, ask int"
    )
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(df, F.col("vec_id") % 100 == 0, label)
    # An id with two rows is two anchors; the order of equal rows is theirs.
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0, label).count() == 0


def test_scores_beyond_63_bits_are_an_error(spark):
    df = spark.createDataFrame([(100, [1e12], 1), (1, [1e12], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(OverflowError):
        negatives.mine(df, F.col("vec_id") % 100 == 0, F.col("label"))


def test_index_loses_no_pair():
    rng = np.random.default_rng(6)
    rows = np.floor(rng.normal(size=(500, 24)) * rng.choice([1, 30, 200], size=24))
    anchors = np.floor(rng.normal(size=(40, 24)) * rng.choice([1, 30, 200], size=24))
    scores = anchors @ rows.T
    lengths = np.linalg.norm(anchors, axis=1)
    for share in (0.0, 0.2, 0.6):
        thresholds = share * lengths * np.linalg.norm(rows, axis=1).max()
        index = negatives.Index(rows, float((thresholds / lengths).min()))
        a, r, found = index.pairs(anchors, thresholds)
        assert set(zip(a.tolist(), r.tolist(), strict=True)) == set(
            zip(*map(np.ndarray.tolist, np.nonzero(scores >= thresholds[:, None])), strict=True)
        )
        assert (found == scores[a, r]).all()
    assert index.first.max() > 0  # some dimensions are left out of the index


def plain_whitening(x, components):
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    order = np.argsort(-values)[:components]
    return centred, values[order], vectors[:, order], values.sum()


def whitened(spark, vectors, **options):
    rows = [(i, list(map(float, v)), "x", 1) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, component int")
    return whitening.whiten(df.repartition(3), **options)


@pytest.mark.parametrize("full", [256, 8])
def test_whitening(spark, monkeypatch, full):
    monkeypatch.setattr(whitening, "BLOCK", 50)
    monkeypatch.setattr(whitening, "FULL", full)
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(400, 24)) @ np.diag(0.8 ** np.arange(24)) @ rng.normal(size=(24, 24))
    got = whitened(spark, vectors, components=6).collect()
    x = np.floor(64 * vectors) + 1_000_000
    centred, values, directions, trace = plain_whitening(x, 6)
    found = np.zeros((400, 6))
    for r in got:
        found[r.vec_id, r.component - 1] = r.whitened
        assert r.n == 400 and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-10
        total = x.astype(int).sum(0)
        assert r.deviation == sum(int(400 * a - s) ** 2 for a, s in zip(x[r.vec_id], total, strict=True))
    assert len(got) == 400 * 6
    want = centred @ directions / np.sqrt(values)
    for k in range(6):
        sign = np.sign(found[0, k] * want[0, k])
        assert np.abs(found[:, k] * sign - want[:, k]).max() < 1e-7


def test_equal_deviations_and_few_dimensions(spark):
    corners = [[s if i == d else 0.0 for i in range(5)] for d in range(5) for s in (-2.0, 2.0)]
    got = whitened(spark, corners).collect()
    assert len(got) == 50 and {r.component for r in got} == set(range(1, 6))
    assert all(abs(r.explained - 0.2) < 1e-12 and r.identity_error < 1e-9 for r in got)


def test_components_without_variance_are_left_out(spark):
    flat = [[float(i), 2.0 * i, 5.0] for i in range(40)]
    got = whitened(spark, flat).collect()
    assert {r.component for r in got} == {1} and len(got) == 40
    assert whitened(spark, [[1.0, 2.0]] * 5).count() == 0
    assert whitened(spark, [[1.0, 2.0]]).count() == 0


def test_vectors_that_take_no_part(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [1.0, 2.0], 1), (2, [3.0, 1.0], None), (None, [0.0, -1.0], 2), (3, None, 1), (4, [], 1)]
    rows += [(5, [1.0, None], 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (1, [1.0, 2.0], 1)]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert sorted([r.vec_id for r in got if r.component == 1], key=repr) == sorted([1, 1, 2, None], key=repr)
    assert {r.n for r in got} == {4}
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 1), (2, [1.0, 2.0], 1)], schema))


def test_registered_whitening_equals_a_full_decomposition(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float)) + 1_000_000
    _, values, _, trace = plain_whitening(x, 32)
    got = whitening.query(spark, sf_dir).select("component", "explained", "identity_error").distinct().collect()
    assert len(got) == 32
    for r in got:
        assert abs(r.explained * trace / values[r.component - 1] - 1) < 1e-10 and r.identity_error < 1e-9
