"""The corpus pipeline: documents in, packed training windows out.

Each stage takes (spark, docs, sf_dir) and all rows its predecessor kept; all but the
last return the columns of ``documents``.  ``run`` writes what each stage returns
as Parquet under the folder named in ``spark.checkpoint.dir`` and reads it
again, so a stage that fails is repeated from its input and lineages stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm import decontam, line_dedup, near_dedup, packing, quality
from scorebook.llm.common import materialise, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose probability of the top grade is below one half."""
    model = quality.fitted(docs, read_table(spark, sf_dir, "labels"))
    return quality.graded(docs, model).where("kept").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated lines out of the texts; every document stays."""
    cleaned = line_dedup.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each component, once; rows
    without a doc_id are in no component and stay."""
    found = near_dedup.near_duplicates(docs).where("kept").select("doc_id").distinct()
    kept = docs.join(materialise(found, "kept"), "doc_id", "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    once = kept.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", "row.*")
    return once.select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the windows."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A fitted classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
