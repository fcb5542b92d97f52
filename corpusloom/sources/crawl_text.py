"""Crawl text files: records that start with a ``WARC/1.0`` line."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.text import content_type, header_field

RECORD_START = "WARC/1.0"


def read_records(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    """(file, value) per record; ``value`` is header block, blank line and body.

    The record marker is the line separator, so a file is never read whole and
    uncompressed files split. A gz file is one task; ``partitions`` spreads the
    records of a few such files.
    """
    lines = spark.read.option("lineSep", "\n" + RECORD_START).text(path)
    records = lines.select(F.col("_metadata.file_path").alias("file"), "value")
    return records if partitions is None else records.repartition(partitions)


def parse_records(records: DataFrame) -> DataFrame:
    """Header fields and body of each record.

    Only the header block is searched for fields: a body may hold lines that
    look like one. The body is all up to the next record, whatever length is
    declared, less the line ends that close it.
    """
    parts = F.split(F.regexp_replace("value", f"^{RECORD_START}", ""), "(?<=\n)\r?\n", 2)
    split_up = records.withColumn("_parts", parts).select(
        *[c for c in records.columns if c != "value"],
        F.get("_parts", F.lit(0)).alias("headers"),
        F.coalesce(F.get("_parts", F.lit(1)), F.lit("")).alias("body"),
    )
    headers = F.col("headers")
    return split_up.select(
        *[c for c in records.columns if c != "value"],
        header_field(headers, "WARC-Record-ID").alias("record_id"),
        header_field(headers, "WARC-Target-URI").alias("uri"),
        F.try_to_timestamp(header_field(headers, "WARC-Date")).alias("warc_date"),
        content_type(headers).alias("content_type"),
        "headers",
        F.regexp_replace("body", "[\r\n]+$", "").alias("text"),
    )


def plain_text(parsed: DataFrame) -> DataFrame:
    """Records whose content type is exactly plain text."""
    return parsed.filter(F.col("content_type") == "text/plain")


def read_documents(
    spark: SparkSession, path, include_headers: bool = False, partitions: int | None = None
) -> DataFrame:
    """Plain-text documents of crawl files, keyed by record id.

    ``include_headers`` puts the header block in front of the text, as the
    text of a document once included it.
    """
    parsed = plain_text(parse_records(read_records(spark, path, partitions)))
    text = F.concat("headers", F.lit("\n"), "text") if include_headers else F.col("text")
    key = F.when(F.col("record_id") != "", F.col("record_id")).otherwise(
        F.sha2(F.concat_ws("\n", "file", "headers", "text"), 256)
    )
    return parsed.select(
        key.alias("doc_id"), "file", "uri", "warc_date", "content_type", "headers", text.alias("text")
    )
