"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing of sources, and segmentations of the mix.

Every stage works on all rows the one before it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import line_dedup, lsh_forest, mixing, piece_sampling, quality_rules
from lakeops.session import few_bytes_a_batch, scratch_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned rules keep."""
    return quality_rules.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that no document of smaller id has; their length is told anew."""
    few_bytes_a_batch(spark)
    kept = line_dedup.deduped_documents(docs)
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity 0.8."""
    return lsh_forest.unique_documents(docs, shingle=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of each document of the mix, with their ids, scores, and whether they decode to the text."""
    import public_tokenizers

    few_bytes_a_batch(spark)
    return piece_sampling.segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), samples=2, alpha=0.2, seed=0)


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_repeated_lines),
    ("near-dedup", one_of_each_group),
    ("mixing", mixed),
    ("segmentations", segmented),
]

#: Learned rules and drawn segmentations can't be said in SQL; tests hold the first three stages against plain Python (the rules'
#: list itself is the learner's), the mix against its SQL, and segmentations against the texts that they decode to.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each is written to the scratch folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
