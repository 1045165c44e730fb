"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet to the shared folder and gives it to the next stage. All stages but the last return
the columns of ``documents``. What a stage rejects is gone for the later ones.

Extra columns of ``docs`` are passed on. A row without doc_id is of no fold: models never learn
from it, it is judged like any other, and no near-duplicate is found for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.llm import jaccard_join, language, line_dedup, packing, quality
from curbline.llm.common import discard, intermediates, outcome, stored, table, whole_rows

# Languages are kept when the prediction is one of those learned, and as sure as this.
LEAST_LANGUAGE_SCORE = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores ``quality.KEPT_FROM`` or more.

    It learns from the labels of ``sf_dir``; null and empty texts are scored like others.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.scored(docs, model) >= quality.KEPT_FROM)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows. Texts without a letter, null and empty ones
    among them, have none and go. A language that differs from ``lang`` is no reason to reject."""
    model = language.train(docs)
    found = language.predicted(docs, model)
    sure = (found["lang_pred"] != language.UNKNOWN) & (found["score"] >= LEAST_LANGUAGE_SCORE)
    return docs.where(sure)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that resemble an earlier one; a document that loses all goes."""
    return line_dedup.dedup_lines(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest doc_id. Of rows that
    share a doc_id one stays, the first in the order of texts."""
    found = jaccard_join.join(docs).where("doc_id IS NOT NULL").groupBy("doc_id")
    found = found.agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    found = stored(found, "pipeline-components")
    same = F.col("row.doc_id").cast("bigint") == F.col("doc_id")
    joined = whole_rows(docs).join(found, same, "left")
    first = F.col("component_id").isNull() | (F.col("component_id") == F.col("doc_id"))
    kept = joined.where(first)
    if not found.where("rows > 1").isEmpty():
        # Only rows of ids that come several times are numbered.
        again = kept.where("rows > 1")
        number = F.row_number().over(Window.partitionBy("doc_id").orderBy("row.text", F.xxhash64("row")))
        again = again.withColumn("number", number).where("number = 1").drop("number")
        kept = kept.where("rows IS NULL OR rows = 1").unionByName(again)
    return kept.select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all that is left, in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("line_dedup", remove_repeated_lines),
    ("ngram_jaccard_join", ngram_jaccard),
    ("packing", pack),
]

# Classifiers and token ids are beyond SQL; a test compares all stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has stored, and its input, go when its output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with intermediates(spark):
            docs = outcome(stage(spark, before, sf_dir), f"stage-{name}")
        if name != STAGES[0][0]:
            discard(before)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
