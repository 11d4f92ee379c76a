"""Mix sources to target weights by a low-discrepancy schedule.

Slot ``i`` of the mix gets the point ``frac((i + 1) * golden ratio)``, which the
cumulative shares map to a source; a source's slots are ranked. Its documents,
in a shuffled order, are laid end to end as one line of words and cut into equal
blocks. Rank ``r`` takes block ``r`` of the line, again from its start once the
line ends. The slot that reaches the source's target is cut there. Sources that the
golden-ratio slots leave short, such as those smaller than a block, get the slots
that they lack in rounds after them, so every source reaches its target.

Targets: the sources share ``total`` of all sizes by weight; no target is above
``most`` times its source's size, and what is cut off is shared again by weight.

Defined cases: a null text has size 0; null is a source of its own, the last;
documents of size 0 are never taken; repeated rows are documents of their own
(equal rows tie, whichever comes first gets the same total); more than
``MAX_SOURCES`` sources are an error; an empty table gives
an empty result; other columns of the input are left out.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import each_copy, running_total, stored, table, word_count

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)
TOTAL = Fraction(3, 2)
MOST = 2
GOLDEN = 0.6180339887498949
# Blocks for a document of average size: finer blocks come nearer to the targets.
BLOCKS_PER_DOC = 4
# Cells of the line that points and sources meet in, at least.
CELLS = 1 << 12
# Golden-ratio slots beyond the mix's size, as a part of it, so that few sources lack some.
SPARE = 0.02
# Rows that one window sorts.
CHUNK_ROWS = 4096
# Sources are ordered by one task, which is checked against this bound.
MAX_SOURCES = 1 << 20


def place_of(id: str, text: str) -> Column:
    """A shuffled position that depends on id and text only."""
    return F.md5(F.concat_ws("|", F.col(id).cast("string"), F.md5(F.coalesce(text, F.lit("")))))


def sized(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size and shuffled position of every document."""
    return docs.select(
        F.col(id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        place_of(id, text).alias("place"),
    )


def targets(docs: DataFrame) -> DataFrame:
    """One row per source: rank, weight, size, target and block length.

    The capped sources are those with the smallest size per weight: with the
    sources in that order, the first ``k`` are capped where the share of the
    others, ``(total - capped) / weights left``, stays below the next cap.
    """
    # Windows without partitions: these are rows of sources, at most MAX_SOURCES.
    per = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("idx") % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("idx", F.row_number().over(order) - 1).withColumn("weight", weight.cast("long"))
    everything = Window.partitionBy(F.lit(1))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), "idx")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    # Whole numbers: the total times the denominator, caps likewise.
    wanted = total * TOTAL.numerator - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * MOST * TOTAL.denominator
    per = per.withColumn("wanted", wanted).withColumn("left", F.sum("weight").over(from_here))
    cap = F.col("source_size") * MOST
    # Row k: would it exceed its cap if all before it are capped?
    level = F.when(
        F.col("wanted") * F.col("weight") <= cap * TOTAL.denominator * F.col("left"),
        F.col("wanted") / (F.col("left") * TOTAL.denominator),
    )
    per = (
        per.withColumn("level", level)
        .withColumn("order", F.row_number().over(by_cap))
        .withColumn("first", F.min(F.when(F.col("level").isNotNull(), F.struct("order", "level"))).over(everything))
    )
    target = F.when(
        F.col("order") >= F.col("first.order"), F.col("first.level") * F.col("weight")
    ).otherwise(cap.cast("double"))
    mean = F.sum("source_size").over(everything) / F.sum("n").over(everything)
    block = F.greatest(F.lit(1), F.floor(mean / BLOCKS_PER_DOC)).cast("long")
    return per.select("source", "idx", "weight", "source_size", target.alias("target"), block.alias("block"))


def lacking(ranked: DataFrame, shares: DataFrame, count: int) -> DataFrame:
    """The slots, from ``count`` on, that sources lack for their targets.

    Every round gives a slot to each source that is still short. A source lacks as
    many slots as its passes over its line have short last blocks, and the few by
    which golden-ratio slots differ from its share.
    """
    got = ranked.groupBy("idx").agg(F.count("*").alias("got"))
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    blocks = F.ceil(F.col("source_size") / F.col("block"))
    needed = F.floor(wanted / F.col("source_size")) * blocks + F.ceil(
        wanted % F.col("source_size") / F.col("block")
    )
    short = shares.join(got, "idx", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    short = short.withColumn("needed", needed).where("needed > got")
    rows = short.withColumn("rank", F.explode(F.sequence(F.col("got"), F.col("needed") - 1)))
    # Window without partitions: these are a few rows per source.
    order = Window.orderBy(F.col("rank") - F.col("got"), "idx")
    slot = F.row_number().over(order) + F.lit(count - 1).cast("long")
    return rows.withColumn("slot", slot).select(*ranked.columns)


def slots(sources: DataFrame) -> DataFrame:
    """The schedule: slot, idx, rank of the slot within its source, block, take.

    ``take`` is how many words the slot takes from its block's start.
    """
    spark = sources.sparkSession
    shares = sources.where("target > 0")
    ends = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = shares.withColumn("high", F.sum("target").over(ends))
    shares = stored(shares.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("idx")), F.lit(0.0))), "shares")
    last = shares.agg(F.max("high"), F.max("block"), F.count("*")).first()
    total, block, n_sources = last
    if not n_sources:
        return spark.createDataFrame([], "slot long, idx int, rank long, nth long, start long, take long")
    count = int(total / block * (1 + SPARE)) + 1
    point = (F.col("slot") + 1) * F.lit(GOLDEN)
    points = spark.range(count).withColumnRenamed("id", "slot")
    points = points.withColumn("at", (point - F.floor(point)) * F.lit(total))
    # Points meet sources in cells of the line from 0 to the total. A source lies in
    # the cells that its share covers, so the slots of a hot source spread over many.
    cells = max(CELLS, n_sources)

    def cell(at: str) -> Column:
        return F.floor(F.col(at) / F.lit(total) * F.lit(cells))

    covered = shares.select(
        "idx", "source_size", "target", "block", "low", "high",
        F.explode(F.sequence(cell("low"), cell("high"))).alias("cell"),
    )
    placed = (
        points.withColumn("cell", cell("at"))
        .join(covered, "cell")
        .where((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high")))
        .select("slot", "idx", "source_size", "target", "block")
    )
    ranked = running_total(
        placed, ["idx"], ["slot"], F.lit(1), "rank", F.floor(F.col("slot") / CHUNK_ROWS)
    )
    ranked = stored(ranked, "slots")
    ranked = ranked.unionByName(lacking(ranked, shares, count))
    blocks = F.ceil(F.col("source_size") / F.col("block"))
    ranked = ranked.withColumn("nth", F.col("rank") % blocks)
    start = F.col("nth") * F.col("block")
    length = F.least(F.col("block"), F.col("source_size") - start)
    taken_before = F.floor(F.col("rank") / blocks) * F.col("source_size") + start
    rest = F.floor(F.col("target") + 0.5).cast("long") - taken_before
    take = F.greatest(F.lit(0), F.least(length, rest))
    out = ranked.select("slot", "idx", "rank", "nth", start.alias("start"), take.alias("take"))
    return out.where("take > 0")


def pieces(placed: DataFrame) -> DataFrame:
    """Each document cut at the block borders of its source's line."""
    first = F.floor(F.col("offset") / F.col("block"))
    last = F.floor((F.col("offset") + F.col("size") - 1) / F.col("block"))
    return placed.where("size > 0").select(
        "idx", "offset", "size", "block", F.explode(F.sequence(first, last)).alias("nth")
    )


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """What the mix takes of each document.

    Columns: doc_id, place, source, size, source_size, target, taken, offset.
    """
    rows = stored(sized(docs, id, text, source), "sizes")
    n_sources = rows.select("source").distinct().count()
    if n_sources > MAX_SOURCES:
        raise ValueError(f"{n_sources} sources, at most {MAX_SOURCES} can be mixed")
    sources = stored(targets(rows), "sources")
    # Equal rows are one entry with a number of copies, which lie side by side.
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    known = sources.withColumnRenamed("source", "_source")
    line = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # Chunks of a line: so many digits of the place that a chunk has a few thousand rows.
    n = rows.count()
    digits, cells = 1, 16
    while n > cells * CHUNK_ROWS // 4:
        digits, cells = digits + 1, cells * 16
    line = running_total(
        line,
        ["idx"],
        ["place", "doc_id"],
        F.col("size") * F.col("copies"),
        "offset",
        F.substring("place", 1, digits),
    )
    line = each_copy(line, "copies", "nth").withColumn(
        "offset", F.col("offset") + F.col("nth") * F.col("size")
    )
    line = stored(line.drop("copies", "nth"), "line")
    parts = pieces(line)
    plan = slots(sources).select("idx", "nth", "start", "take")
    low = F.greatest(F.col("offset"), F.col("start"))
    high = F.least(F.col("offset") + F.col("size"), F.col("start") + F.col("take"))
    took = F.greatest(F.lit(0), high - low)
    taken = (
        parts.join(plan, ["idx", "nth"])
        .groupBy("idx", "offset")
        .agg(F.sum(took).alias("taken"))
    )
    # A document's offset in its line is its own; only those of size 0 share one.
    out = line.withColumn("_some", F.col("size") > 0).join(
        taken.withColumn("_some", F.lit(True)), ["idx", "offset", "_some"], "left"
    )
    return out.select(
        "doc_id",
        "place",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "offset",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the mix of all documents."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(documents: str = "documents") -> str:
    """The mix as SQL: ``WITH`` clauses that end in ``mixed``."""
    weight = f"CASE idx % {len(WEIGHTS)} " + " ".join(
        f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS)
    ) + " END"
    return rf"""
    sizes AS (
        SELECT doc_id, source, text,
            CAST(len(regexp_extract_all(coalesce(text, ''), '{r'[^\x20\x09-\x0D]+'}')) AS BIGINT) AS size,
            md5(concat_ws('|', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS place
        FROM {documents}
    ),
    per AS (
        SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
            row_number() OVER (ORDER BY source NULLS LAST) - 1 AS idx
        FROM sizes GROUP BY source
    ),
    weighed AS (SELECT *, {weight} AS weight FROM per),
    ordered AS (
        SELECT *, row_number() OVER c AS ord,
            (sum(source_size) OVER ())::BIGINT * {TOTAL.numerator}
                - coalesce(sum(source_size) OVER (c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
                * {MOST * TOTAL.denominator} AS wanted,
            (sum(weight) OVER (c ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest
        FROM weighed WINDOW c AS (ORDER BY source_size / weight, idx)
    ),
    level AS (
        SELECT ord, wanted / (rest * {TOTAL.denominator}) AS share FROM ordered
        WHERE wanted * weight <= source_size * {MOST * TOTAL.denominator} * rest
        ORDER BY ord LIMIT 1
    ),
    aimed AS (
        SELECT idx, source, source_size,
            CASE WHEN o.ord >= l.ord THEN l.share * weight ELSE CAST(source_size * {MOST} AS DOUBLE) END AS target
        FROM ordered o, level l
    ),
    lines AS (
        SELECT z.doc_id, z.text, z.source, z.size, a.source_size, a.target, floor(a.target + 0.5)::BIGINT AS all_taken,
            coalesce(sum(z.size) OVER (PARTITION BY a.idx ORDER BY z.place, z.doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
        FROM sizes z JOIN aimed a ON z.source IS NOT DISTINCT FROM a.source
    ),
    mixed AS (
        SELECT doc_id, text, source, size, source_size, target,
            CASE WHEN size = 0 THEN 0 ELSE (all_taken // source_size) * size
                + greatest(0, least(size, all_taken % source_size - off)) END::BIGINT AS taken
        FROM lines
    )"""


SQL = f"WITH {mix_sql()} SELECT doc_id, size, source_size, target, taken FROM mixed"
