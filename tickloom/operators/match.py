"""Finding entities and topics in text, and link rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import (
    bare_text,
    contains_any,
    holds,
    link_host,
    link_path,
    needles,
    plain_text,
    word_text,
)


# Cells of the filter of first words.
FILTER = 1 << 16


def match_entities(
    df: DataFrame,
    text: str,
    keywords: Mapping[str, Iterable[str]],
    mode: str = "substring",
    out: str = "entity",
) -> DataFrame:
    """One row per article and mentioned entity; articles without any are dropped.

    ``text`` is lower-cased already. The keywords become one expression, so the
    articles are neither shuffled nor joined.
    """
    hay = F.col(text) if mode == "substring" else word_text(text)
    df = df.withColumn("_hay", hay)
    tests = {entity: holds("_hay", needles(words, mode)) for entity, words in keywords.items()}
    hits = F.array_compact(F.array(*[F.when(test, F.lit(e)) for e, test in tests.items()]))
    return df.withColumn(out, F.explode(hits)).drop("_hay")


def first_words(keywords: DataFrame) -> Callable[[Column], Column]:
    """Whether a word may be the first one of a keyword.

    The keywords' hashes fill a table of ``FILTER`` cells, whatever their number; a
    fuller table lets more words through to the join.
    """

    def cell(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(FILTER)).cast("int")

    first = F.element_at(F.split(F.trim(word_text(F.lower("keyword"))), " "), 1)
    filled = {r[0] for r in keywords.select(cell(first)).distinct().collect()}
    # One byte a cell, in one literal.
    table = F.lit(bytes(i in filled for i in range(FILTER)))
    return lambda word: F.substring(table, cell(word) + 1, F.lit(1)) == F.lit(b"\x01")


def match_entities_by_join(
    df: DataFrame, text: str, keywords: DataFrame, out: str = "entity"
) -> DataFrame:
    """Word-mode match for keyword tables too long for one expression.

    Runs of words, up to as many as the longest keyword has, are joined to the keyword
    table. They are built only where a word may begin a keyword: a Bloom filter of the
    keywords' first words, of fixed size, is tested on the word array inside its row.
    The result is one (id, entity) row per match; the texts are never shuffled.
    """
    n_words = F.size(F.split(F.trim(word_text("keyword")), " "))
    max_words = keywords.agg(F.max(n_words)).first()[0] or 1
    begins = first_words(keywords)
    word = F.col("_w")
    starts = F.array_compact(F.transform(word, lambda w, i: F.when(begins(w), i + 1)))

    def runs(i: Column) -> Column:
        longest = F.least(F.lit(max_words), F.size(word) - i + 1)
        return F.transform(
            F.sequence(F.lit(1), longest), lambda n: F.array_join(F.slice(word, i, n), " ")
        )

    terms = F.flatten(F.transform(starts, runs))
    lookup = keywords.select(F.lower("keyword").alias("_term"), F.col("entity").alias(out))
    return (
        df.select("id", F.split(F.trim(word_text(text)), " ").alias("_w"))
        .select("id", F.explode(F.array_distinct(terms)).alias("_term"))
        .join(lookup, "_term")
        .select("id", out)
        .distinct()
    )


def filter_relevant(
    df: DataFrame,
    cols: Iterable[str],
    keywords: Iterable[str],
    mode: str = "substring",
) -> DataFrame:
    """Rows whose normalised text holds any topic keyword.

    Runs of white space only matter to keywords that contain a space, and not
    at all in word mode, so that pass over the text is left out otherwise.
    """
    keywords = list(keywords)
    spaced = mode == "substring" and any(" " in k for k in keywords)
    normalise = plain_text if spaced else bare_text
    text = F.concat_ws(" ", *[normalise(c) for c in cols])
    return df.withColumn("_text", text).where(contains_any("_text", keywords, mode)).drop("_text")


def filter_links(
    df: DataFrame, rules: DataFrame, link: str = "link", source: str = "source"
) -> DataFrame:
    """Links on their source's own site and outside its denied sections.

    Sources without a rule are allowed.
    """
    rule = rules.withColumnRenamed("source", "_source")
    parts = df.withColumns({"_host": link_host(link), "_path": link_path(link)})
    joined = parts.join(rule, F.col(source) == F.col("_source"), "left")
    denied = F.exists("deny_prefix", lambda p: F.startswith(F.col("_host"), p)) | F.exists(
        "deny_segment", lambda s: F.contains(F.col("_path"), s)
    )
    on_site = F.endswith(F.col("_host"), F.col("host_suffix"))
    allowed = F.col("_source").isNull() | (on_site & ~denied)
    return joined.where(allowed).select(*df.columns)
