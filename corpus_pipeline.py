"""From raw documents to packed training sequences.

Four stages, each an operator of ``pulsekit.llm`` with the parameters of its
query: toxic documents go, one document of each SimHash group stays, byte
strings and passages of over 50 words that occur twice go, and what is left is
packed.  Each stage takes
(spark, docs, sf_dir) and works on all that the stage before it kept; all but
the last return the columns of ``docs``.

Rows with null ids or texts, repeated rows and further columns pass through
each stage as the operator's docstring says; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import simhash, suffix_dedup, toxicity
from pulsekit.llm.common import PREFIX, written
from pulsekit.llm.queries import REPEAT_BYTES, SIMHASH, held_out, packed_documents


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out("doc_id"))
    model = toxicity.fit(docs, labels)
    score = PREFIX + "score"
    return docs.withColumn(score, toxicity.score(F.col("text"), model)).filter(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.representatives(docs, **SIMHASH)


REPEAT_WORDS = 51


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings and the passages of over 50 words that occur elsewhere too; ``n_chars`` follows."""
    out = suffix_dedup.without_repeats(docs, REPEAT_BYTES, words=REPEAT_WORDS)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packed_documents(docs)


STAGES = [("toxicity", clean), ("simhash", distinct), ("suffix_dedup", unrepeated), ("packing", packed)]

#: SQL has neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
