"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared scratch folder and gives what it reads back to the next one.
All stages but the last return the columns of their input.

quality      documents that the classifier rejects go
lines        lines that at least five documents share stay in one of them
near_copies  of texts with the same or nearly the same shingles those of the least
             id stay, all of them; different texts of one doc_id are judged each on
             their own; rows without a doc_id all stay
mix          a document appears as often as the mix takes its words, a last part
             counted as a whole; what the mix does not reach goes; of equal rows
             each appears the same number of times, rounded up
pack         length bucket and batch of every remaining document

Nulls, empty texts and repeated rows are as the operators define them; an empty
table passes through as an empty one. The classifier and the near copies have no
SQL form, so there is no ``ORACLE_SQL``; tests compare with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import classifier, jaccard, lines, mixing, packing
from tickloom.llm.tables import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(classifier.accepts(model)(F.coalesce("text", F.lit(""))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.dedup(docs)
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.rows_of(docs)
    extra = found.where("class_id <> doc_id").select(F.struct("doc_id", "mark").alias("_extra")).distinct()
    named = docs.withColumn("_row", F.struct("doc_id", jaccard.mark_of("text").alias("mark")))
    return lines.without(named, "_row", stored(extra, "near-copies")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.mix(docs)
    times = F.ceil(F.col("taken") / F.col("size"))
    each = taken.where("taken > 0").groupBy("place").agg(
        F.ceil(F.sum(times) / F.count("*")).alias("_times")
    )
    named = docs.withColumn("_place", mixing.place_of("doc_id", "text"))
    repeated = named.join(each, F.col("_place") == F.col("place"))
    return repeated.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).select(
        *docs.columns
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("lines", line_dedup),
    ("near_copies", near_copies),
    ("mix", mix),
    ("pack", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
