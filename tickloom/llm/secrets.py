"""Secret scan with an incremental ledger of text versions.

Every text is a blob named by its SHA-256. The ledger keeps which blob was
scanned under which rule version, and what was found. A run hashes all texts,
scans one copy of each blob for the rule versions it lacks, adds the results to
the ledger and joins all findings back to every path that holds the blob.

Defined cases: a null text is an empty one; a null path is a path of its own;
repeated rows get equal results (where such a row is the copy to scan, all its
repeats are read and merge before positions are added up); an empty table gives an
empty result and an empty ledger entry; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored, table
from tickloom.session import scratch_dir


class Rule(NamedTuple):
    """What a finding looks like: the pattern's group must have ``least`` characters.

    ``hint`` is a plain string that every match contains.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str = ""

    @property
    def version(self) -> str:
        """Changes with everything that changes what the rule finds."""
        text = f"{self.pattern}\n{self.group}\n{self.least}\n{self.hint}"
        return f"{self.name}@{hashlib.sha256(text.encode()).hexdigest()[:12]}"


# The base kinds, in the order that they are listed.
BASE = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        8,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    Rule("hex", "[0-9a-f]{32,}", 0, 32),
)
# Published shapes of further credentials.
EXTRA = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "-----BEGIN"),
    Rule("forge_token", "gh[pousr]_[A-Za-z0-9]{36}", 0, 1, "gh"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, "xox"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1, "eyJ"),
)
RULES = BASE + EXTRA
SEEN = "blob binary, rules array<string>"
FINDING = "blob binary, rule string, start int, end int"


def read_ledger(spark: SparkSession, ledger: str, part: str, schema: str) -> DataFrame:
    """One of the ledger's two tables; empty before the first run."""
    try:
        return spark.read.schema(schema).parquet(f"{ledger}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def blobs(docs: DataFrame, path: str, text: str) -> DataFrame:
    """path, text, the text's content address, and a number to choose one path by."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(path).alias("path"),
        content.alias("text"),
        F.unhex(F.sha2(content, 256)).alias("blob"),
        F.xxhash64(path).alias("pick"),
    )


def unseen(versions: DataFrame, seen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The blobs that lack a rule version: blob, the path to scan it from, todo."""
    wanted = F.array(*[F.lit(r.version) for r in rules])
    first = versions.groupBy("blob").agg(F.min("pick").alias("pick"))
    done = seen.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
    todo = first.join(done, "blob", "left").select(
        "blob",
        "pick",
        F.array_except(wanted, F.coalesce("done", F.expr("cast(array() as array<string>)"))).alias(
            "todo"
        ),
    )
    return todo.where(F.size("todo") > 0)


def _lengths(rule: Rule) -> Column:
    """The gap before each match, the match's length and whether it counts."""
    text = F.col("text")
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    piece = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    found = F.struct(
        F.lit(rule.version).alias("rule"),
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gaps"),
        F.transform(whole, F.length).alias("lengths"),
        F.transform(piece, lambda x: F.length(x) >= rule.least).alias("counts"),
    )
    wanted = F.array_contains("todo", rule.version)
    if rule.hint:
        wanted = wanted & text.contains(rule.hint)
    return F.when(wanted & text.rlike(rule.pattern), found)


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of each blob under the rules it lacks: blob, rule, start, end.

    ``split`` gives the text between matches, so a match starts after all gaps
    and matches before it. Positions count code points, the end is exclusive.
    """
    hits = texts.select("blob", F.explode(F.array(*[_lengths(r) for r in rules])).alias("hit"))
    hits = hits.where(F.col("hit").isNotNull())
    # The text after the last match is a gap without a match.
    parts = hits.select(
        "blob",
        "hit.rule",
        F.posexplode(
            F.arrays_zip(
                F.slice("hit.gaps", F.lit(1), F.size("hit.lengths")).alias("gap"),
                F.col("hit.lengths").alias("length"),
                F.col("hit.counts").alias("counts"),
            )
        ).alias("nth", "part"),
    )
    # Repeated rows of a blob give equal parts, which may count once only.
    parts = parts.select("blob", "rule", "nth", "part.gap", "part.length", "part.counts").distinct()
    upto = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    end = F.sum(F.col("gap") + F.col("length")).over(upto)
    placed = parts.select(
        "blob",
        "rule",
        (end - F.col("length")).cast("int").alias("start"),
        end.cast("int").alias("end"),
        "counts",
    )
    return placed.where("counts").drop("counts")


def update(
    docs: DataFrame,
    ledger: str,
    path: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Bring a ledger up to date; returns path and blob of every row.

    Rows of rule versions that are no longer asked for stay in the ledger.
    """
    spark = docs.sparkSession
    versions = blobs(docs, path, text)
    paths = stored(versions.drop("text"), "paths")
    todo = stored(unseen(paths, read_ledger(spark, ledger, "seen", SEEN), rules), "todo")
    # Paths are spread evenly here; sorting whole texts for a merge join is not needed.
    texts = versions.join(todo.hint("shuffle_hash"), ["blob", "pick"])
    # Findings go first: a run lost in between is repeated, and equal rows merge on read.
    scan(texts, rules).write.mode("append").parquet(f"{ledger}/findings")
    marks = todo.select("blob", F.col("todo").alias("rules"))
    marks.write.mode("append").parquet(f"{ledger}/seen")
    return paths.select("path", "blob")


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All findings of the rules' present versions, once each."""
    wanted = [r.version for r in rules]
    rows = read_ledger(spark, ledger, "findings", FINDING).where(F.col("rule").isin(wanted))
    return rows.distinct().withColumn("kind", F.split_part("rule", F.lit("@"), F.lit(1)))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob with findings: counts and joined spans."""
    place = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("kind"))
    rows = found.select("blob", F.struct("start", place.alias("place"), "kind", "end").alias("s"))
    spans = rows.groupBy("blob").agg(F.sort_array(F.collect_list("s")).alias("spans"))

    def joined(items: Column) -> Column:
        text = F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(text, ",")

    base = F.filter("spans", lambda s: s["place"] <= len(BASE))

    def count(rule: Rule) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == rule.name)
        return F.size(own).cast("long").alias(f"n_{rule.name}")

    counts = [count(r) for r in BASE]
    return spans.select(
        "blob", *counts, joined(base).alias("base"), joined(F.col("spans")).alias("spans")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: secrets of every document, from a ledger that starts empty."""
    ledger = scratch_dir(spark, "secrets")
    paths = update(table(spark, sf_dir, "documents"), ledger)
    found = digest(findings(spark, ledger))
    return paths.join(found, "blob", "left").select(
        F.col("path").alias("doc_id"),
        *[F.coalesce(f"n_{r.name}", F.lit(0)).cast("long").alias(f"n_{r.name}") for r in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def _sql() -> str:
    """The same in SQL: matches and the texts between them give the positions."""
    kinds = []
    for place, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        kinds.append(
            f"""SELECT doc_id, {place} AS place, '{rule.name}' AS kind, {rule.least} AS least,
            [length(x) FOR x IN string_split_regex(t, '{pattern}')] AS gaps,
            [length(x) FOR x IN regexp_extract_all(t, '{pattern}')] AS lens,
            [length(x) FOR x IN regexp_extract_all(t, '{pattern}', {rule.group})] AS pieces
            FROM docs"""
        )
    hits = " UNION ALL ".join(kinds)
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    hits AS ({hits}),
    placed AS (
        SELECT doc_id, place, kind, least, pieces[i] AS piece, lens[i] AS len,
            list_sum(gaps[1:i]) + coalesce(list_sum(lens[1:i - 1]), 0) AS s
        FROM (SELECT *, unnest(range(1, len(lens) + 1)) AS i FROM hits)
    ),
    kept AS (
        SELECT doc_id, place, kind, s,
            concat(kind, ':', CAST(s AS BIGINT), ':', CAST(s + len AS BIGINT)) AS span
        FROM placed WHERE piece >= least
    ),
    per AS (
        SELECT doc_id,
            count(*) FILTER (kind = 'assign') AS n_assign,
            count(*) FILTER (kind = 'access') AS n_access,
            count(*) FILTER (kind = 'hex') AS n_hex,
            string_agg(span, ',' ORDER BY s, place) FILTER (place < 3) AS base,
            string_agg(span, ',' ORDER BY s, place) AS spans
        FROM kept GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
        coalesce(spans, '') AS spans
    FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id"""


SQL = _sql()
