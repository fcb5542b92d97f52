"""Inputs of the registered queries, derived by Spark from the given tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

NOT_PLAIN = "application/warc-fields"

# Layout of the registered queries: a table of a few files, which give a few
# tasks, is spread over this many, by key, whatever the session's cores.
FEW_FILES = 8
PARTITIONS = 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def laid_out(df: DataFrame) -> DataFrame:
    return df.repartition(PARTITIONS, "doc_id") if len(df.inputFiles()) < FEW_FILES else df


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, lang, text) of all documents, for work on their text."""
    return laid_out(table(spark, folder, "documents").select("doc_id", "lang", "text"))


def english(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of the English documents."""
    return texts(spark, folder).filter("lang = 'en'").select("doc_id", "text")


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """(file, value): one crawl record per document; every tenth is not plain text."""
    kind = F.when(F.col("doc_id") % 10 == 9, NOT_PLAIN).otherwise("Text/Plain ")
    day = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
    value = F.concat(
        F.lit("WARC/1.0\nWARC-Type: conversion\nWARC-Target-URI: http://"), "source",
        F.lit(".example.com/"), F.col("doc_id").cast("string"),
        F.lit("\nWARC-Date: 2015-07-"), day, F.lit("T17:46:11Z"),
        F.lit("\nWARC-Record-ID: <urn:uuid:"), F.col("doc_id").cast("string"),
        F.lit(">\nContent-Type: "), kind,
        F.lit("\nContent-Length: "), F.octet_length("text").cast("string"),
        F.lit("\n\n"), "text", F.lit("\n"),
    )
    docs = laid_out(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return docs.select(F.col("source").alias("file"), value.alias("value"))


def file_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Backlog from pages: the url is the path, every third is claimed."""
    pages = table(spark, folder, "pages")
    month = F.concat(F.lit("2015-"), F.lpad((F.col("page_id") % 12 + 1).cast("string"), 2, "0"))
    path = F.when(F.col("page_id") % 50 == 49, "").otherwise(F.col("url"))
    job = F.when(F.col("page_id") % 3 == 0, (F.col("page_id") % 5).cast("int"))
    return pages.select(month.alias("year_month"), path.alias("file_path"), job.alias("job_id"))


def job_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of pages claimed by the jobs that sources stand for, most of a job's in one month."""
    pages = table(spark, folder, "pages").filter("page_id % 11 <> 0")
    job = F.col("page_id") % 20
    month = F.when(F.col("page_id") % 3 == 0, F.col("page_id") % 12).otherwise(job % 6) + 1
    year_month = F.concat(F.lit("2015-"), F.lpad(month.cast("string"), 2, "0"))
    return pages.select(year_month.alias("year_month"), F.col("url").alias("file_path"), job.alias("job_id"))


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Two rival claims to every path; the second one in the list came first."""
    paths = file_paths(spark, folder).select("year_month", "file_path")
    bids = F.array(
        F.struct(F.lit(100).alias("job_id"), F.lit(2).alias("claim_no")),
        F.struct(F.lit(200).alias("job_id"), F.lit(1).alias("claim_no")),
    )
    return paths.select("year_month", "file_path", F.inline(bids))


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Run events from the event table: a user is a job."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "ERROR").when(kind == "view", "STARTED").otherwise("COMPLETED")
    error = F.when(kind == "error", F.col("props"))
    return table(spark, folder, "events").select(
        F.col("user_id").alias("job_id"), "ts", "event_id", status.alias("status"), error.alias("err_text")
    )


def periods(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the crawl period, which is the number in their source."""
    period = F.expr("CAST(substring(source, 4) AS INT)")
    return table(spark, folder, "documents").withColumn("period", period)
