"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Every stage is written to the shared folder and read back before the next one. Stages 1 to 4
return the columns of ``documents``; the last returns token pieces with their places.
The stages read only ``documents``, ``labels`` and ``benchmark``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm import decontaminate, importance, line_spread, lsh_forest, packing
from lakeload.llm.scratch import prepare, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labels draws."""
    prepare(spark)
    return importance.selected_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that spread over many sites; ``n_chars`` follows the text."""
    prepare(spark)
    left = line_spread.without_boilerplate(docs)
    if "n_chars" in docs.columns:
        counted = F.when(F.col("n_removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", counted)
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    prepare(spark)
    return lsh_forest.one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    prepare(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: Sampling, sketches, components and packing have no SQL form. Tests run every stage, but compare none with brute force yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
