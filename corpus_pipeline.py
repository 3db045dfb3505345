"""The corpus pipeline: documents without toxic, repeated and contaminated ones, mixed to target weights.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet to the shared folder and reads it back for the next stage, so a lost
executor costs a stage at most.  Stage 1 learns from the labels of the documents
it gets, by the rule for held-out rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from stratus.llm.common import table
from stratus.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that had no other line; n_chars follows the text."""
    out = line_dedup.without_repeated_lines(docs)
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return out.withColumn("n_chars", n_chars) if "n_chars" in out.columns else out


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs, shingle=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, and the words the mix takes of it."""
    return mixing.pack(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Stages 1 to 3 and 5 cannot be stated in SQL: a trained model, MinHash with components, XXH64 and keyed permutations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
