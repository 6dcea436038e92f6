"""The corpus pipeline: quality rules, line dedup, near copies, benchmark decontamination, tokens.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and gives the documents that go on, with
the columns of ``docs``; the last one adds the tokens. ``run`` writes what a stage keeps to the shared folder and
reads it again for the next one, so each stage starts from a table and not from all that came before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import bpe, decontam, jaccard, lines, quality
from sievework.llm.queries import documents, vocabulary
from sievework.llm.shared import written

#: BPE and MinHash candidates have no SQL form; tests compare the pipeline with plain Python.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that near-equal lines elsewhere stand for; n_chars follows the text."""
    out = lines.dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ids, the number of them, and digests of the ids and of the text they decode to."""
    out = bpe.tokenize(docs, vocabulary())
    return out.withColumns(bpe.digests(F.col("ids"), F.col("decoded"))).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
