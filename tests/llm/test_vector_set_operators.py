"""Top-k, joins, classifier, mixing, packing and the pipeline against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import corpus_pipeline
import fixtures
import numpy as np
import pytest

from tickloom.llm import classifier, components, jaccard, mixing, packing, topk

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_top(rows, queries, k):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v]

    usable = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    best: dict = {}
    for q, a in usable:
        if q in queries:
            for c, b in usable:
                if c != q and len(a) == len(b):
                    score = sum(x * y for x, y in zip(a, b, strict=True))
                    best[q, c] = max(best.get((q, c), score), score)
    out = []
    for q in queries:
        found = sorted((-s, c) for (x, c), s in best.items() if x == q)[:k]
        out += [(q, rank, c, -s) for rank, (s, c) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 64), ("QUERIES", 8), ("BUCKET", 16), ("ROWS", 4)):
            monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * rng.choice([0.1, 1, 30])).tolist()) for i in range(400)]
    rows += [(400 + i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(60)]  # ties
    rows += [(500, None), (501, [1.0, None] * 3), (502, [float("nan")] * 6), (503, [float("inf")] * 6)]
    rows += [(504, []), (550, []), (505, [1.0, 2.0]), (600, [2.0, 1.0]), (None, [1.0] * 6)]
    rows += [rows[3], (50, [9.0] * 6), (650, [0.0] * 6), (700, [-1.0] * 6), (7, [-8.0] * 6)]
    schema = "vec_id long, embedding array<double>, score int, rank string"
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], schema)
    got = topk.top_k(df, df.where("vec_id % 50 = 0"))
    want = plain_top(rows, {i for i, _ in rows if i is not None and i % 50 == 0}, topk.K)
    assert sorted(map(tuple, got.collect())) == want
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_refuses_scores_beyond_63_bits(spark):
    rows = [(50, [1e30, 1.0]), (51, [2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="63 bits"):
        topk.top_k(df, df.where("vec_id = 50")).collect()


def test_top_k_of_one_hot_id(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rows = [(7, [1.0, float(i % 2)]) for i in range(300)] + [(50, [1.0, 1.0])] * 90
    rows += [(50, [2.0, float(i)]) for i in range(40)] + [(i, [0.5, i / 9]) for i in range(51, 90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id = 50"))
    assert sorted(map(tuple, got.collect())) == plain_top(sorted(set((i, tuple(v)) for i, v in rows)), {50}, topk.K)


def test_coordinates_never_lose_a_candidate():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(4000, 5))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for q in unit[:60]:
        for cosine in (0.6, 0.8, 0.95, 1.0):
            near = set(np.flatnonzero(unit @ q >= cosine).tolist())
            assert near <= set(topk.by_coordinate(unit, q, cosine * (1 - 1e-9)).tolist())


def shingle_set(text):
    found = WORD.findall(text or "")
    if len(found) < 5:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def plain_join(docs):
    sets = [(d[0], shingle_set(d[1])) for d in docs]
    links, parent = Counter(), {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if a is not None and b is not None and x and y and len(x & y) >= 0.8 * len(x | y):
            links[a] += 1
            links[b] += 1
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {d: (root(d), links[d]) for d, _ in sets}


@pytest.mark.parametrize(("split", "block"), [(jaccard.SPLIT, jaccard.BLOCK), (4, 3)])
def test_chosen_paths_find_every_pair(spark, split, block):
    docs = [d for d in fixtures.documents() if d[0] != 79]
    df = spark.createDataFrame(docs, fixtures.SCHEMA)
    rows = jaccard.join(df, split=split, block=block).collect()
    want = plain_join(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.class_id, r.n_links) == ((None, 0) if r.doc_id is None else want[r.doc_id])
    assert jaccard.join(fixtures.empty(spark)).count() == 0
    twice = spark.createDataFrame([d for d in fixtures.documents() if d[0] == 79], fixtures.SCHEMA)
    assert [r.class_id for r in jaccard.join(twice).collect()] == [79, 79]


def plain_rows(docs):
    sets = [(i, shingle_set(text)) for i, text in docs]
    near = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    for i, x in sets:
        members = {x}
        while more := {y for _, y in sets if y not in members and any(near(y, z) for z in members)}:
            members |= more
        yield (
            i,
            min(j for j, y in sets if y in members),
            min(j for j, y in sets if y == x),
            sum(near(x, y) for _, y in sets) - 1,
            len({y for _, y in sets if y != x and near(x, y)}),
        )


def changed(text, at):
    found = text.split(" ")
    found[at] = "other"
    return " ".join(found)


@pytest.mark.parametrize(("split", "block"), [(jaccard.SPLIT, jaccard.BLOCK), (2, 1)])
def test_join_of_repeated_rows_and_reused_ids(spark, split, block):
    rng = random.Random(8)
    one, two, three = (fixtures.words(rng, 100) for _ in range(3))
    docs = [(20, one), (20, one), (20, one), (30, changed(one, 50)), (31, changed(one, 10))]  # repeated
    docs += [(40, two), (40, three), (10, changed(two, 5)), (50, changed(three, 7)), (50, three)]  # reused
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, jaccard.join(df, split=split, block=block).collect()))
    assert got == Counter(plain_rows(docs))


def test_near_copies_keep_a_text_of_every_class(spark):
    rng = random.Random(8)
    one, two = (fixtures.words(rng, 100) for _ in range(2))
    docs = [(3, one), (5, changed(one, 9)), (5, two), (5, two), (9, two), (None, two)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter(map(tuple, corpus_pipeline.near_copies(spark, df, "").collect()))
    assert got == Counter([(3, one), (5, two), (5, two), (None, two)])


def test_join_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = plain_join([tuple(r) for r in docs.collect()])
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(docs).collect()} == want


def test_runs_reach_the_target():
    rng, missed = random.Random(4), 0
    for _ in range(20_000):
        union = list(range(100))
        rng.shuffle(union)
        a = [x for x in union if x < 90][:2]
        b = [x for x in union if x < 80 or x >= 90][:2]
        missed += not set(a) & set(b)
    assert abs(1 - missed / 20_000 - jaccard.step_recall()) < 0.01
    once = jaccard.step_recall() ** jaccard.LEVELS
    assert (1 - once) ** jaccard.runs_for() <= 1 - jaccard.RECALL


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, 200: 0, 101: 100, 102: 100}


def test_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    again = classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_fit_against_one_plain_solve(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in quality]
    stats, marks, kept = [], [], []
    for doc_id, text in rows:
        name = str(doc_id)
        if zlib.crc32(name.encode()) % 3 != 1:
            stats.append(classifier.statistics((text or "").encode()))
            marks.append(quality[doc_id])
            kept.append(zlib.crc32(name[::-1].encode()) % classifier.CALIBRATE == 0)
    x, y, kept = np.array(stats), np.array(marks, float), np.array(kept)
    scale = np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = classifier.features(x, x.mean(0), scale)
    fitted = z[~kept]
    penalty = classifier.RIDGE * max(1, len(fitted)) * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-9
    weights = np.linalg.lstsq(fitted.T @ fitted + penalty, fitted.T @ y[~kept], rcond=None)[0]
    model = classifier.train(docs, labels)
    assert np.allclose(model.raw(x), z @ weights, atol=1e-6)
    # Calibrated scores rise with the raw ones.
    order = np.argsort(model.raw(x))
    assert (np.diff(model.score(x)[order]) >= -1e-12).all()
    described = classifier.describe(docs, "doc_id", "text")
    whole = classifier.learn(described, labels, "doc_id", "quality")
    assert np.allclose(model.weights, whole.weights) and np.allclose(model.levels, whole.levels)


def test_classifier_special_rows(spark):
    docs = fixtures.frame(spark)
    labels = spark.createDataFrame(
        [(i, int(i < 40), 9) for i in range(50)] + [(None, 1, 9), (3, None, 9), (999, 0, 9)],
        "doc_id long, quality int, score int",
    )
    rows = classifier.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in classifier.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert classifier.classify(fixtures.empty(spark), labels).count() == 0


def test_isotonic():
    rates = classifier.isotonic(np.array([4, 4, 4, 4]), np.array([0, 3, 1, 4]))
    assert list(rates) == sorted(rates) and rates[1] == rates[2] == 4.5 / 9


def plain_targets(sizes):
    """Share by weight, cut at twice the size, share again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in capped and target[s] > 2 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mix(spark):
    docs = fixtures.frame(spark)
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for _, text, _, source, *_ in fixtures.documents():
        sizes[source] += len(WORD.findall(text or ""))
    target = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-6)
        taken[r.source] += r.taken
    block = max(1, sum(sizes.values()) // len(rows) // mixing.BLOCKS_PER_DOC)
    for source, words in target.items():
        assert abs(taken[source] - words) <= 2 * block + 1
    key = lambda r: (r.doc_id is None, r.doc_id, r.taken)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(key, again)) == sorted(map(key, rows))
    assert mixing.mix(fixtures.empty(spark)).count() == 0


def test_mix_reaches_every_target(spark):
    rng = random.Random(9)
    docs = [("hot", 300)] * 110 + [(f"mid{i}", rng.randint(200, 400)) for i in range(5) for _ in range(30)]
    docs += [(f"tiny{i}", rng.randint(20, 80)) for i in range(200)] + [("one", 1), ("none", 0), (None, 7)]
    rows = [(i, " ".join(f"w{i}" for _ in range(n)), source) for i, (source, n) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = Counter()
    for source, n in docs:
        sizes[source] += n
    taken, target = Counter(), {}
    for r in mixing.mix(df).collect():
        taken[r.source] += r.taken
        target[r.source] = math.floor(r.target + 0.5)
    assert {s: taken[s] for s in target} == target
    found = plain_targets(sizes)
    assert all(abs(target[s] - found[s]) <= 0.5 + 1e-6 for s in target)
    rows = mixing.mix(df.limit(0)).count() + mixing.mix(df.where("source = 'none'")).count()
    assert rows == 1
    plan = mixing.slots(mixing.targets(mixing.sized(df))).collect()
    assert len({r.slot for r in plan}) == len(plan)
    ranks: dict = {}
    for r in plan:
        ranks.setdefault(r.idx, []).append((r.slot, r["rank"]))
    # In the order of the slots, a source's ranks go up by one from 0.
    assert all([k for _, k in sorted(v)] == list(range(len(v))) for v in ranks.values())


def test_best_boundaries():
    rng = random.Random(6)
    for _ in range(60):
        bins = sorted({rng.randrange(0, 60): rng.randrange(1, 9) for _ in range(rng.randrange(1, 8))}.items())
        k = rng.randrange(1, 5)
        tops = [t for t, _ in bins]

        def cost(ends, bins=bins):
            return sum(n * min(e for e in ends if e >= t) for t, n in bins)

        best = min(
            cost([*c, tops[-1]]) for m in range(min(k, len(tops))) for c in combinations(tops[:-1], m)
        )
        ends = packing.boundaries(bins, k)
        assert len(ends) <= k and cost(ends) == best


def test_boundaries_of_many_lengths():
    rng = np.random.default_rng(8)
    lengths, counts = np.unique(np.floor(np.exp(rng.normal(6, 1.5, 3000))).astype(int), return_counts=True)
    bins = list(zip(lengths.tolist(), counts.tolist(), strict=True))
    upto = np.concatenate([[0], np.cumsum(counts)])
    cost = np.concatenate([[0.0], np.full(len(bins), np.inf)])
    for _ in range(7):  # every split is tried
        cost = np.array([0.0] + [
            (cost[:j] + lengths[j - 1] * (upto[j] - upto[:j])).min() for j in range(1, len(bins) + 1)
        ])
    ends = np.array(packing.boundaries(bins, 7))
    assert (ends[np.searchsorted(ends, lengths)] * counts).sum() == cost[-1]


def test_copies_of_one_row_are_mixed_and_packed(spark, monkeypatch):
    from tickloom.llm import tables

    monkeypatch.setattr(tables, "COPIES", 16)
    rows = [(1, "a b c", "s")] * 500 + [(i, "x " * (i % 9 + 1), f"s{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(df).collect()
    assert Counter(r.doc_id for r in mixed) == Counter(r[0] for r in rows)
    assert len({(r.source, r.offset) for r in mixed}) == len(mixed)
    assert all(r.taken <= 2 * r.size for r in mixed)
    packed = packing.pack(df, budget=64).collect()
    assert Counter(r.doc_id for r in packed) == Counter(r[0] for r in rows)
    assert len({(r.bucket, r.batch, r.place) for r in packed}) == len(packed)


def test_padding_of_long_documents_is_least(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "EXACT", 32)
    lengths = [5, 30, 33, 70, 71, 1000, 1001, 5000, 5001, 5002]
    df = spark.createDataFrame([(i, "t", n) for i, n in enumerate(lengths)], "doc_id long, text string, tokens int")
    found = packing.pack(df, buckets=4, length=F.col("tokens")).collect()
    assert {r.length: r.bucket for r in found} == {
        5: 33, 30: 33, 33: 33, 70: 71, 71: 71, 1000: 1001, 1001: 1001, 5000: 5002, 5001: 5002, 5002: 5002,
    }


def test_packing(spark):
    rows = packing.pack(fixtures.frame(spark), budget=1000).collect()
    lengths = Counter((d[0], len(WORD.findall(d[1] or ""))) for d in fixtures.documents())
    assert Counter((r.doc_id, r.length) for r in rows) == lengths
    batches: dict = {}
    for r in rows:
        assert r.padding == r.bucket - r.length >= 0
        batches.setdefault((r.bucket, r.batch), []).append(r.place)
    fill = Counter()
    for (bucket, batch), places in batches.items():
        most = max(1, 1000 // max(1, bucket))
        assert sorted(places) == list(range(len(places))) and len(places) <= most
        fill[bucket] += len(places) < most
    assert max(fill.values()) <= 1  # only a bucket's last batch is not full
    assert packing.pack(fixtures.empty(spark)).count() == 0


def test_bins_hold_their_lengths(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 200_000, 7).select("id", packing.bin_top(F.col("id")).alias("top")).collect()
    tops = [r.top for r in rows]
    assert tops == sorted(tops)
    assert all(r.id <= r.top <= max(r.id, packing.EXACT) * 1.04 for r in rows)


def test_pipeline_stages(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    sf_dir = str(tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = corpus_pipeline.quality(spark, docs, sf_dir)
    scores = {r.doc_id: r.predicted for r in classifier.classify(docs, labels).collect()}
    assert {r.doc_id for r in good.collect()} == {d for d, p in scores.items() if p}
    assert good.columns == docs.columns
    lined = corpus_pipeline.line_dedup(spark, good, sf_dir)
    assert all(r.n_chars == len(r.text) for r in lined.collect())
    single = corpus_pipeline.near_copies(spark, lined, sf_dir)
    want = plain_join([(r.doc_id, r.text) for r in lined.collect()])
    assert {r.doc_id for r in single.collect()} == {d for d, (c, _) in want.items() if c == d}
    mixed = corpus_pipeline.mix(spark, single, sf_dir)
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(single).collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert times == Counter({d: math.ceil(t / s) for d, (t, s) in taken.items() if t})
    packed = corpus_pipeline.pack(spark, mixed, sf_dir)
    assert packed.count() == mixed.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


def test_pipeline_special_rows(spark, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (fixtures.frame(spark), fixtures.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, str(tmp_path))
            assert stage is corpus_pipeline.pack or docs.columns == columns
        assert docs.count() >= 0
