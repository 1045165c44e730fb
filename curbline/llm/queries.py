"""The registered queries of the operators. Each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import (
    alignment,
    cover_tree,
    jaccard_join,
    language,
    lattice,
    line_dedup,
    packing,
    quality,
    rules,
    spelling,
    toxicity,
    transducer,
    warc,
)
from curbline.llm.common import documents, table
from curbline.llm.training import held_out


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "source",
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = transducer.transcode(documents(spark, sf_dir))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _held_out() -> Column:
    """Rows without doc_id are of no fold."""
    return F.coalesce(held_out(), F.lit(False)).alias("held_out")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", _held_out(), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", _held_out(), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    kept = (F.col("score") >= quality.KEPT_FROM).cast("int").alias("predicted")
    return found.select("doc_id", _held_out(), "score", kept)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(documents(spark, sf_dir))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select(*(c for c in found.columns if c != "groups"), digest.alias("groups_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The times of the index are those that the query gives the pages, so SQL knows its order.
    return warc.captures(table(spark, sf_dir, "pages")).drop("since_last")


QUERIES = {
    q.__name__: q
    for q in (
        op1_line_dedup,
        op2_packing,
        op3_bpe,
        op4_language_id,
        op5_toxicity,
        op6_quality_rules,
        op7_embedding_near_dedup,
        op8_jaccard_join,
        op9_quality_classifier,
        op10_lm_score,
        op11_token_alignment,
        op12_spelling_variants,
        op13_warc,
    )
}
SQL = {
    op1_line_dedup.__name__: line_dedup.SQL,
    op6_quality_rules.__name__: rules.SQL,
    op13_warc.__name__: warc.SQL,
}
