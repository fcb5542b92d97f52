"""Crawl files: round trip, last record, line ends, look-alike lines."""

import gzip
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import inputs
from corpusloom.sources import crawl_text

BODIES = {
    "one": "plain body\nsecond line",
    "two": "a mid-line WARC/1.0 stays\nContent-Type: image/png\nContent-Length: 3",
    "three": "first part\n\nafter a blank line",
    "four": "",
    "last": "the last record é",
}


def write_file(end, with_length):
    def record(key, kind, body):
        fields = [
            "WARC/1.0", "WARC-Type: conversion", f"WARC-Target-URI: http://a.example/{key}",
            "WARC-Date: 2015-07-02T17:46:11Z", f"WARC-Record-ID: <urn:uuid:{key}>", f"content-type: {kind}",
        ]
        body = body.replace("\n", end)
        if with_length:
            fields.append(f"Content-Length: {len(body.encode())}")
        return end.join(fields) + end + end + body + end + end

    content = record("info", "application/warc-fields", "software: x")
    content += "".join(record(k, "Text/Plain ", b) for k, b in BODIES.items())
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with gzip.open(f"{folder}/part.warc.wet.gz", "wb") as out:
        out.write(content.encode())
    return folder


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("with_length", [True, False])
def test_documents(spark, end, with_length):
    got = crawl_text.read_documents(spark, write_file(end, with_length)).collect()
    want = {f"<urn:uuid:{k}>": b.replace("\n", end) for k, b in BODIES.items()}
    assert {r.doc_id: r.text for r in got} == want
    assert {r.uri for r in got} == {f"http://a.example/{k}" for k in BODIES}
    assert {r.content_type for r in got} == {"text/plain"}
    assert str(got[0].warc_date) == "2015-07-02 17:46:11"


def test_headers_option(spark):
    rows = crawl_text.read_documents(spark, write_file("\n", True), include_headers=True).collect()
    text = {r.doc_id: r.text for r in rows}["<urn:uuid:one>"]
    assert "WARC-Type: conversion" in text and text.endswith(BODIES["one"])


def test_round_trip_of_documents(spark, folder):
    docs = inputs.table(spark, folder, "documents")
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/crawl"
    inputs.raw_records(spark, folder).select("value").write.option("compression", "gzip").text(path)
    back = crawl_text.read_documents(spark, path).select(
        F.regexp_extract("doc_id", r"(\d+)", 1).cast("bigint").alias("doc_id"), "text"
    )
    want = docs.filter("doc_id % 10 <> 9").select("doc_id", "text")
    assert back.exceptAll(want).count() == 0
    assert want.exceptAll(back).count() == 0


@pytest.mark.parametrize("declared", ["4", "999", "0000000004000", "", "x"])
def test_whole_body_whatever_length_is_declared(spark, declared):
    record = f"WARC/1.0\nContent-Type: text/plain\nContent-Length: {declared}\n\nten é long\n\nmore\n\n\n"
    rows = crawl_text.parse_records(spark.createDataFrame([(record,)], "value string")).collect()
    assert [r.text for r in rows] == ["ten é long\n\nmore"]
