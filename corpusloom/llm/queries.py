"""Registered queries of this subpackage: (spark, folder) -> DataFrame, over whole tables."""

import os
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import (
    decontamination,
    derivatives,
    fingerprints,
    lexicon,
    near_copies,
    packing,
    personal_data,
    ranking,
    reputation,
    secrets,
    token_files,
    toxicity,
    variants,
)
from corpusloom.llm.word_encoder import tokenizer_path

QUERIES = {}


def query(name):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return build(spark, folder)

        QUERIES[name] = run
        return build

    return register


def importable(spark: SparkSession) -> None:
    """Let Python workers started from any folder import this package."""
    root, own = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in own.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        own["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_token_files")
def op2_token_files(spark, folder):
    return token_files.coded(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op6_packing")
def op6_packing(spark, folder):
    return packing.packed(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op3_toxicity")
def op3_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query("op5_near_copies")
def op5_near_copies(spark, folder):
    return near_copies.near_classes(table(spark, folder, "documents"))


@query("op9_benchmark_leaks")
def op9_benchmark_leaks(spark, folder):
    return decontamination.leaked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op1_secrets")
def op1_secrets(spark, folder):
    return secrets.report(table(spark, folder, "documents"))


@query("op10_fingerprints")
def op10_fingerprints(spark, folder):
    return fingerprints.fingerprinted(table(spark, folder, "documents"))


@query("op7_host_reputation")
def op7_host_reputation(spark, folder):
    """A page's outcome is the label with its number: bad if of low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))
    return reputation.judged(table(spark, folder, "pages"), outcomes)


@query("op8_derivatives")
def op8_derivatives(spark, folder):
    made = derivatives.built(table(spark, folder, "pages"))
    return made.withColumnRenamed("source_key", "page_id")


@query("op4_personal_data")
def op4_personal_data(spark, folder):
    return personal_data.report(table(spark, folder, "documents"))


@query("op13_variants")
def op13_variants(spark, folder):
    return variants.grouped(table(spark, folder, "documents"))


@query("op11_ranking")
def op11_ranking(spark, folder):
    return ranking.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_lexicon")
def op12_lexicon(spark, folder):
    return lexicon.digests(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))
