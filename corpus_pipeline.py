"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm.common import Workspace
from terrafold.llm.language import held_out, predict_language, train_language_model
from terrafold.llm.line_templates import drop_template_lines
from terrafold.llm.mixing import mix_sources
from terrafold.llm.ngram_join import ngram_jaccard_components
from terrafold.llm.packing import pack_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key of id and text: equal where both are (null ids, too)."""
    text = F.col("text").cast("string")
    return docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(17), text).alias("t2"))


KEY = ["id", "t1", "t2"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language (null text, no letter) go; lang is the prediction.

    Where no document has both a language and a letter, nothing can be learned:
    documents with a letter stay as they are.
    """
    model = train_language_model(docs.filter(~held_out("doc_id", 3, 1)).select("text", "lang"))
    if model is None:
        return docs.select(*COLUMNS).filter(F.col("text").rlike(r"\p{L}"))
    found = predict_language(docs.select(*COLUMNS), model).filter("lang_pred <> 'und'")
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; n_chars follows the text; every document stays, also empty and null ones."""
    kept = drop_template_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays (ids before none, then by text hash).

    Rows that repeat an id and its text stay once; documents without words are
    linked with nothing, so each stays.
    """
    groups = ngram_jaccard_components(docs.select("doc_id", "text"), keys=True).withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2", "id")).alias("f")
    stay = groups.filter("component IS NOT NULL").groupBy("component").agg(first).select(*[f"f.{k}" for k in KEY])
    stay = stay.unionByName(groups.filter("component IS NULL").select(*KEY).distinct())
    return _keyed(docs).join(stay, KEY, "left_semi").dropDuplicates(KEY).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document appears as often as the mix takes its words, to the nearest whole number.

    Of rows that repeat an id and its text each appears as often as the one that is taken most.
    """
    docs = _keyed(docs)
    taken = mix_sources(docs, keep=tuple(KEY))
    copies = taken.filter("size > 0").groupBy(*KEY).agg(F.max(F.expr("cast(round(taken / size) AS int)")).alias("copies")).filter("copies > 0")
    return docs.join(copies, KEY).withColumn("play", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens; an empty or null text is the end id alone."""
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        after = ws.save(stage(spark, docs, sf_dir), name)
        if before is not None:
            ws.drop(before)
        docs = before = after
    return STAGES[-1][1](spark, docs, sf_dir)
