"""Jaccard join of word shingle sets by chosen paths.

Texts with the same shingle set are one record, numbered when records are stored;
its own number, not a doc_id, names it until the end. In every run a record chooses the
two shingles of its set that come first in the run's order, and goes to the bucket
of each. Buckets above a size are split again by the next order's two first
shingles, so a record's place is a path of chosen shingles that similar records
share with high probability. In a small bucket all records are compared: a sketch
of 128 bytes drops clearly different ones, and the sets of the rest are intersected
exactly. A pair that shares several buckets counts in the least of them only. Runs
are repeated until the miss probability at the threshold is below the target's.

Buckets that stay large, such as many near copies of one text, are compared in
pairs of blocks, a task for each; nothing is capped. Pairs are not given out:
records get their number of links and the least record that a block links them to,
and connected components of records make the classes.

Defined cases: texts without words are in no pair and a class of their own, null
texts likewise; texts of one to four words have one shingle; rows of null doc_id
have a null class and no links; rows of one doc_id count as copies or near copies
of each other like any, and different texts of one doc_id have a class each; an empty table gives an empty result; other columns of the
input are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import shingles
from tickloom.llm.components import components
from tickloom.llm.tables import stored, table

SIMILARITY = 0.8
RECALL = 0.99999
# Orders that a path can use, and shingles chosen at each step.
LEVELS = 3
CHOICES = 2
# Buckets above SPLIT records are split; records of one block of a comparison.
SPLIT = 4096
BLOCK = 512
# Sketch: least shingle of each of so many ranges, one byte of it; and how far the
# estimate may be below the threshold (more than five standard deviations).
SKETCH = 128
MARGIN = 0.2
SEED = 0x5851F42D4C957F2D
RECORD = "mark bigint, a bigint, b bigint, n int, sketch binary, picks array<bigint>"


def step_recall(similarity: float = SIMILARITY) -> float:
    """Probability that a pair at the threshold shares one of its two first shingles.

    Go through the union in order: with probability J an element is shared, then
    both have chosen it; otherwise it uses up a choice of one of the two.
    """

    def hit(left: int, right: int) -> float:
        if not left or not right:
            return 0.0
        missed = 0.5 * hit(left - 1, right) + 0.5 * hit(left, right - 1)
        return similarity + (1 - similarity) * missed

    return hit(CHOICES, CHOICES)


def runs_for(recall: float = RECALL, similarity: float = SIMILARITY) -> int:
    """Runs after which a pair at the threshold is missed with 1 - recall at most.

    A run finds it if it stays together in all steps of a path, the longest one here.
    """
    once = step_recall(similarity) ** LEVELS
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - once)))


def order_of(items: np.ndarray, orders: int) -> np.ndarray:
    """Every order's numbers of the shingles, a row per order."""
    seeds = shingles.mix(np.arange(1, orders + 1, dtype=np.uint64) * np.uint64(SEED))
    mixed = (items[None, :] ^ seeds[:, None]) * (seeds[:, None] | np.uint64(1))
    return (mixed ^ (mixed >> np.uint64(29))) * shingles.MIX_1


def chosen(items: np.ndarray, orders: int) -> np.ndarray:
    """The first shingles of each order; a set of one has one choice, given twice."""
    numbers = order_of(items, orders)
    if len(items) <= CHOICES:
        numbers = np.sort(numbers, axis=1)
        return np.hstack([numbers] + [numbers[:, -1:]] * (CHOICES - len(items)))
    return np.sort(np.partition(numbers, CHOICES - 1, axis=1)[:, :CHOICES], axis=1)


def sketch(items: np.ndarray) -> bytes:
    """A byte of the least shingle in each range of the numbers; 0 where there is none."""
    out = np.zeros(SKETCH, np.uint8)
    # Sorted shingles: the first of each range is its least.
    ranges = (items >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)
    used, first = np.unique(ranges, return_index=True)
    out[used] = (items[first] & np.uint64(0xFF)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def name(items: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    whole = np.array(
        [shingles.mix(items).sum(dtype=np.uint64), shingles.mix(items ^ np.uint64(SEED)).sum(dtype=np.uint64)],
        np.uint64,
    )
    both = (shingles.mix(whole + np.uint64(len(items)))).view(np.int64)
    return int(both[0]), int(both[1])


def mark_of(text: str) -> Column:
    """A number that tells different texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def describe(docs: DataFrame, id: str, text: str, runs: int) -> DataFrame:
    """Mark, set name, size, sketch and choices of every document that has a word."""
    orders = runs * LEVELS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"doc_id": [], "mark": [], "a": [], "b": [], "n": [], "sketch": [], "picks": []}
            ids, marks = (batch.column(k).to_pylist() for k in ("doc_id", "mark"))
            for doc_id, mark, items in zip(ids, marks, shingles.sets(batch.column("text")), strict=True):
                if len(items):
                    a, b = name(items)
                    picks = chosen(items, orders).ravel().view(np.int64)
                    for k, v in zip(rows, (doc_id, mark, a, b, len(items), sketch(items), picks), strict=True):
                        rows[k].append(v)
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            columns = [pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=list(rows))

    rows = docs.where(F.col(id).isNotNull()).select(
        F.col(id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), mark_of(text).alias("mark")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, {RECORD}")


def buckets(records: DataFrame, runs: int, split: int = SPLIT) -> DataFrame:
    """Final buckets of every record: rec, leaf, m (records in it). Lone ones are left out."""

    def children(run: Column, path: Column, level: int) -> Column:
        first = (run * LEVELS + level) * CHOICES + 1
        keys = [
            F.xxhash64(path, F.element_at("picks", (first + c).cast("int"))) for c in range(CHOICES)
        ]
        return F.array_distinct(F.array(*keys))

    runs_of = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    nodes = records.select("rec", "picks", runs_of)
    nodes = nodes.select("rec", "run", F.explode(children(F.col("run"), F.col("run"), 0)).alias("node"))
    leaves = None
    for level in range(1, LEVELS + 1):
        sizes = nodes.groupBy("node").agg(F.count("*").alias("m")).where("m > 1")
        # From a table: Spark splits a hot bucket in a join of two plain shuffles only.
        nodes = nodes.join(stored(sizes, "node-sizes"), "node")
        if level < LEVELS:
            nodes = stored(nodes, "nodes")
            done = nodes.where(F.col("m") <= split)
            large = nodes.where(F.col("m") > split).join(records.select("rec", "picks"), "rec")
            path = children(F.col("run"), F.col("node"), level)
            nodes = large.select("rec", "run", F.explode(path).alias("node"))
        else:
            done = nodes
        done = done.select("rec", F.col("node").alias("leaf"), "m")
        leaves = done if leaves is None else leaves.unionByName(done)
    return leaves


def blocks(leaves: DataFrame, records: DataFrame, block: int = BLOCK) -> DataFrame:
    """Records with all their leaves, once for every pair of blocks to compare them in."""
    own = leaves.groupBy("rec").agg(F.collect_set(F.struct("leaf", "m")).alias("places"))
    rows = records.select("rec", "copies", "n", "sketch").join(own, "rec")
    rows = rows.withColumn("leaves", F.col("places.leaf")).withColumn("place", F.explode("places"))
    parts = F.ceil(F.col("place.m") / block).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("rec"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select(
        F.col("place.leaf").alias("leaf"),
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        "own",
        *["rec", "copies", "n", "sketch", "leaves"],
    )


GROUP = ("leaf", "one", "two")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by group, many small ones at once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy() for k in GROUP]
        same = np.ones(batch.num_rows - 1, bool)
        for k in keys:
            same &= k[1:] == k[:-1]
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        joins = held and all(held[-1].column(k)[-1].as_py() == keys[i][0] for i, k in enumerate(GROUP))
        if held and not joins:
            yield pa.Table.from_batches(held)
            held = []
        if last:
            held.append(batch.slice(0, last))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(rows: pa.Table) -> np.ndarray:
    keys = [rows.column(k).to_numpy() for k in GROUP]
    change = np.zeros(rows.num_rows - 1, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [rows.num_rows]])


def owned(leaves: list[np.ndarray], leaf: int) -> np.ndarray:
    """Pairs (a matrix) that share no leaf below this one, so that they count here."""
    earlier = [x[x < leaf] for x in leaves]
    return ~shared(earlier)[0].astype(bool)


def shared(items: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """How many items each two of the lists have in common."""
    sizes = [len(x) for x in items]
    joined = np.concatenate(items) if sum(sizes) else np.zeros(0, np.int64)
    _, number, counts = np.unique(joined, return_inverse=True, return_counts=True)
    often = counts > 1
    total = int(often.sum())
    counts_of = np.zeros((len(items), len(items)), np.float32)
    row = np.repeat(np.arange(len(items)), sizes)
    use = often[number]
    row, column = row[use], (np.cumsum(often) - 1)[number[use]]
    # A slice of the columns at a time bounds the memory.
    step = max(1, (1 << 23) // max(1, len(items)))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, total, step):
        a, b = np.searchsorted(column, [low, low + step])
        present = np.zeros((len(items), min(step, total - low)), np.float32)
        present[row[a:b], column[a:b] - low] = 1
        counts_of += present @ present.T
    return counts_of, total


def allowed(one: int, two: int, own: np.ndarray) -> np.ndarray:
    """Pairs that a group compares: across its two blocks, or within its only one."""
    if one == two:
        pairs = np.ones((len(own), len(own)), bool)
    else:
        pairs = own[:, None] != own[None, :]
    np.fill_diagonal(pairs, False)
    return pairs


def likely(sketches: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs whose sizes and sketches allow the similarity."""
    n = len(sizes)
    out = np.minimum(sizes[:, None], sizes[None, :]) >= similarity * np.maximum(sizes[:, None], sizes[None, :])
    used = sketches > 0
    for low in range(0, n, 64):
        part = slice(low, low + 64)
        same = ((sketches[part, None, :] == sketches[None]) & used[None]).sum(2)
        either = (used[part, None, :] | used[None]).sum(2)
        out[part] &= same >= (similarity - MARGIN) * either
    return out


def candidates(rows: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``blocks`` that have a likely partner in their group, without sketches."""
    kept = [f for f in rows.schema.fields if f.name != "sketch"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches):
            n = part.num_rows
            sizes = part.column("n").to_numpy()
            own, one, two, leaf = (part.column(k).to_numpy() for k in ("own", "one", "two", "leaf"))
            marks = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(n, -1)
            bounds, keep = group_bounds(part), np.zeros(n, bool)
            counts = np.diff(bounds)
            # Pairs are by far the most frequent groups, and are compared all at once.
            pair = bounds[:-1][counts == 2]
            if len(pair):
                x, y = marks[pair], marks[pair + 1]
                same = ((x == y) & (x > 0)).sum(1)
                fits = same >= (similarity - MARGIN) * ((x > 0) | (y > 0)).sum(1)
                small, large = np.minimum(sizes[pair], sizes[pair + 1]), np.maximum(sizes[pair], sizes[pair + 1])
                fits &= small >= similarity * large
                fits &= (one[pair] == two[pair]) | (own[pair] != own[pair + 1])
                keep[pair[fits]] = keep[pair[fits] + 1] = True
            lists = part.column("leaves")
            for low, high in zip(bounds[:-1][counts > 2], bounds[1:][counts > 2], strict=True):
                group = slice(low, high)
                pairs = likely(marks[group], sizes[group], similarity) & allowed(one[low], two[low], own[group])
                if pairs.any():
                    some = np.flatnonzero(pairs.any(1))
                    lists_of = [np.array(lists[int(low + i)].as_py()) for i in some]
                    pairs = pairs[np.ix_(some, some)] & owned(lists_of, leaf[low])
                    keep[low + some[pairs.any(1)]] = True
            yield from part.drop_columns(["sketch"]).filter(pa.array(keep)).to_batches()

    schema = rows.select(*[f.name for f in kept]).schema
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(task, schema)


def with_sets(rows: DataFrame, records: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """Candidate rows with their record's shingles, made again from one of its texts.

    A record's text is that of its least (doc_id, mark). Where that row is repeated,
    a task keeps the first it meets; ``verified`` drops repeats of several tasks.
    """
    places = rows.groupBy("rec", "copies", "leaves").agg(
        F.collect_list(F.struct(*GROUP, "own")).alias("places")
    )
    places = places.join(records.select("rec", "copy_id", "mark", "a", "b"), "rec")
    texts = docs.where(F.col(text).isNotNull()).select(
        F.col(id).alias("copy_id"), mark_of(text).alias("mark"), F.col(text).alias("text")
    )
    joined = texts.join(places.hint("shuffle_hash"), ["copy_id", "mark"]).drop("copy_id", "mark")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            found = shingles.sets(batch.column("text"))
            rest = batch.drop_columns(["text"]).to_pylist()
            for row, items in zip(rest, found, strict=True):
                # Another text of the same id may have the same mark.
                if row["rec"] in done or not len(items) or name(items) != (row["a"], row["b"]):
                    continue
                done.add(row["rec"])
                n, data = len(row["places"]), items.tobytes()
                columns = {
                    **{k: [p[k] for p in row["places"]] for k in (*GROUP, "own")},
                    **{k: [row[k]] * n for k in ("rec", "copies", "leaves")},
                    "items": [data] * n,
                }
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    schema = (
        "leaf bigint, one int, two int, own int, rec bigint, copies bigint, "
        "leaves array<bigint>, items binary"
    )
    arrow = pa.schema(
        [
            ("leaf", pa.int64()), ("one", pa.int32()), ("two", pa.int32()), ("own", pa.int32()),
            ("rec", pa.int64()), ("copies", pa.int64()), ("leaves", pa.list_(pa.int64())),
            ("items", pa.binary()),
        ]
    )
    return joined.mapInArrow(task, schema)


def least_linked(pairs: np.ndarray) -> np.ndarray:
    """The least row of each row's connected component."""
    label = np.arange(len(pairs))
    while True:
        near = np.where(pairs, label[None, :], len(pairs)).min(1)
        now = np.minimum(label, near)
        now = now[now]
        if (now == label).all():
            return label
        label = now


def verified(rows: DataFrame, similarity: float) -> DataFrame:
    """Exact links of every group: rec, texts and docs it links to, least record linked."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches):
            rec, copies = part.column("rec"), part.column("copies").to_numpy()
            own, one, two, leaf = (part.column(k).to_numpy() for k in ("own", "one", "two", "leaf"))
            lists, items = part.column("leaves"), part.column("items")
            out: dict[str, list] = {"rec": [], "texts": [], "docs": [], "least": []}
            bounds = group_bounds(part)
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if high - low < 2:
                    continue
                # Ascending records, each once, so that the least row is the least record.
                ids = rec.slice(low, high - low).to_pylist()
                order = [i for _, i in sorted({r: i for i, r in enumerate(ids)}.items())]
                at = [low + i for i in order]
                found = [np.frombuffer(items[i].as_py(), np.uint64) for i in at]
                sizes = np.array([len(x) for x in found], float)
                common = shared(found)[0]
                union = sizes[:, None] + sizes[None, :] - common
                pairs = (common >= similarity * union - 1e-6) & allowed(one[low], two[low], own[at])
                if pairs.any():
                    pairs &= owned([np.array(lists[i].as_py()) for i in at], leaf[low])
                label = least_linked(pairs)
                for i in np.flatnonzero(pairs.any(1)).tolist():
                    out["rec"].append(ids[order[i]])
                    out["texts"].append(int(pairs[i].sum()))
                    out["docs"].append(int(copies[at][pairs[i]].sum()))
                    out["least"].append(ids[order[label[i]]])
            types = [rec.type, pa.int64(), pa.int64(), rec.type]
            columns = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=list(out))

    schema = "rec bigint, texts bigint, docs bigint, least bigint"
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(task, schema)


def class_ids(links: DataFrame, records: DataFrame) -> DataFrame:
    """The least doc_id of each linked record's connected class: rec, class_id."""
    found = stored(components(links.select(F.col("rec").alias("a"), F.col("least").alias("b"))), "components")
    # The least record of a component has no row of its own.
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    members = found.unionByName(roots).select(F.col("node").alias("rec"), "component")
    members = stored(members.join(records.select("rec", "copy_id"), "rec"), "members")
    least = members.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    return members.join(stored(least, "classes"), "component").select("rec", "class_id")


def rows_of(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    split: int = SPLIT,
    block: int = BLOCK,
) -> DataFrame:
    """Classes and links of every row: the columns of ``join``, and its text's mark."""
    runs = runs_for(recall, similarity)
    described = stored(describe(docs, id, text, runs), "sets")
    same = described.groupBy("a", "b").agg(
        F.min(F.struct("doc_id", "mark")).alias("least"),
        F.count("*").alias("copies"),
        *[F.first(c).alias(c) for c in ("n", "sketch", "picks")],
    )
    same = same.select(
        F.col("least.doc_id").alias("copy_id"), F.col("least.mark").alias("mark"),
        *["a", "b", "copies", "n", "sketch", "picks"],
    )
    # The numbers are those that this write stores.
    records = stored(same.withColumn("rec", F.monotonically_increasing_id()), "records")
    leaves = stored(buckets(records, runs, split), "leaves")
    likely_rows = stored(candidates(blocks(leaves, records, block), similarity), "candidates")
    links = stored(verified(with_sets(likely_rows, records, docs, id, text), similarity), "links")
    totals = links.groupBy("rec").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    known = (
        records.select("a", "b", "rec", "copy_id", "copies")
        .join(totals, "rec", "left")
        .join(class_ids(links, records), "rec", "left")
        .select(
            "a",
            "b",
            "copy_id",
            F.coalesce("class_id", "copy_id").alias("class_id"),
            (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
        )
    )
    found = described.select("doc_id", "mark", "a", "b").join(known, ["a", "b"]).drop("a", "b")
    has_word = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rest = docs.where(F.col(id).isNull() | ~has_word).select(
        F.col(id).alias("doc_id"),
        F.col(id).alias("class_id"),
        F.col(id).alias("copy_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_text_links"),
        mark_of(text).alias("mark"),
    )
    return found.select(*rest.columns).unionByName(rest)


def join(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    split: int = SPLIT,
    block: int = BLOCK,
) -> DataFrame:
    """Classes and links of every document.

    Columns: doc_id, class_id (least doc_id of its connected class), copy_id (least
    doc_id with the same shingle set), n_links (other documents at the similarity or
    above, copies included), n_text_links (different sets among them).
    """
    return rows_of(docs, id, text, similarity, recall, split, block).drop("mark")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: near copies among all documents."""
    return join(table(spark, sf_dir, "documents"))
