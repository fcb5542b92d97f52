"""Corpus pipeline: toxic documents go, one of each near-copy class stays, leaked benchmark
documents go, live secrets are replaced, and what is left is packed into sequences.

Each stage takes the rows that the one before wrote and, but for the last,
returns the columns of ``documents``. Rows with null keys or texts stay as the
stages' modules say; an empty table gives an empty result.
"""

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, near_copies, packing, secrets, toxicity
from corpusloom.llm.queries import importable, table
from corpusloom.llm.word_encoder import tokenizer_path
from corpusloom.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return near_copies.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.packed(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: No SQL can express a trained kernel machine or best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
