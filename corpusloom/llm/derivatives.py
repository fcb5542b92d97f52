"""Derivatives of web archive responses: linked metadata and plain-text conversion records.

For each response record two records are made: ``metadata`` (title, language,
outgoing links, the source's headers and digest) and ``conversion`` (the plain
text of the page). Both refer to the response's record id and repeat its
target, date and digest. They are written as archive text files, one record
after the other, and read back.

Record ids are made from a hash of the source record and the kind, so a retried
task writes the same ids, and equal source rows give equal records. A null url
or page is the empty one; a page without text has an empty conversion. Line
ends inside blocks are line feeds, so the separator between records, which has
carriage returns, never occurs inside one. Columns of pages other than
``page_id``, ``url`` and ``html`` are not read; an empty table gives no records.

A page is read once from left to right, in time proportional to its length. A
tag goes from ``<`` and a letter or one of ``/!?`` to the first ``>``; without
one it is text. An element whose text is not shown ends at the first closing tag
of its own name; if there is none, only its opening tag is left out. A comment
that is not closed is a tag. A head ends at its closing tag, or where something
begins that cannot be in a head.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.llm.common import slices, strings
from corpusloom.session import scratch_path

VERSION = "WARC/1.0\r\n"
FIXED_DATE = "2015-07-28T17:46:11Z"
HEADERS = ["WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Refers-To-Digest", "WARC-Target-URI", "WARC-Date",
           "WARC-Block-Digest", "WARC-Source-Key", "Content-Type", "Content-Length"]

#: Entities and what they stand for; the ampersand last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
BLOCK_TAGS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table article section nav header footer title body".split())
HIDDEN_TAGS = frozenset("script style noscript template".split())
HEAD_TAGS = HIDDEN_TAGS | frozenset("head title meta link base".split())

NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9]*)")
CLOSING = re.compile(r"</(script|style|noscript|template|title)\s*>", re.IGNORECASE)
LANGUAGE = re.compile(r"""(?:^|[\s"'])lang\s*=\s*["']?([A-Za-z-]+)""", re.IGNORECASE)
TARGET = re.compile(r"""(?:^|[\s"'])href\s*=\s*(?:"([^"]*)|'([^']*)|([^\s"']+))""", re.IGNORECASE)
BLANKS = re.compile(r"[\t\r\n\f ]+")


def digest(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(value.cast("binary"), 256))


def bare_line(text: str) -> str:
    """The text with entities resolved, on one line, with single blanks."""
    if "&" in text:
        for entity, letter in ENTITIES:
            text = text.replace(entity, letter)
    return BLANKS.sub(" ", text).strip(" ")


class Closings:
    """Where closing tags of a name are in a page: looked up with rising places, all found in one pass."""

    def __init__(self, html: str):
        self.html, self.places = html, None

    def after(self, name: str, place: int):
        """(begin, end) of the next closing tag, or None."""
        if self.places is None:
            self.places = {}
            for found in CLOSING.finditer(self.html):
                self.places.setdefault(found[1].lower(), []).append(found.span())
            for spans in self.places.values():
                spans.reverse()
        spans = self.places.get(name, [])
        while spans and spans[-1][0] < place:
            spans.pop()
        return spans[-1] if spans else None


def page_parts(html: str) -> tuple[str, str, list[str], str]:
    """(title, language, targets of links, plain text) of a page.

    The plain text has no scripts, styles, comments or tags, a line for each
    block, and single blanks.
    """
    title, language, targets, lines, line = None, "", [], [], []
    closings, comments, head, at = Closings(html), True, False, 0
    while True:
        low = html.find("<", at)
        high = html.find(">", low) if low >= 0 else -1
        if high < 0:
            line.append(html[at:])
            break
        if head and not html[at:low].isspace() and at < low:
            head = False
        if not head:
            line.append(html[at:low])
        at = high + 1
        if comments and html.startswith("<!--", low):
            end = html.find("-->", low + 4)
            comments = end >= 0
            if comments:
                line.append(" ")
                at = end + 3
            continue
        found = NAME.match(html, low + 1, high)
        if found is None:
            if html[low + 1] not in "/!?":
                line.append("<")
                at = low + 1
            continue
        name, opens = found[1].lower(), html[low + 1] != "/"
        if head and name not in HEAD_TAGS:
            head = False
        if name == "head":
            head = opens
            line.append(" ")
        elif opens and name in HIDDEN_TAGS:
            close = closings.after(name, at)
            if close is not None:
                line.append(" ")
                at = close[1]
        elif opens and name == "title" and (head or title is None):
            close = closings.after(name, at)
            if close is not None:
                title = bare_line(html[at : close[0]]) if title is None else title
                at = close[1] if head else at
        elif opens and name == "a":
            target = TARGET.search(html, found.end(), high)
            if target:
                targets.append(BLANKS.sub(" ", target[1] or target[2] or target[3] or "").strip(" "))
        elif opens and name == "html" and not language:
            named = LANGUAGE.search(html, found.end(), high)
            language = named[1] if named else ""
        if name in BLOCK_TAGS and not head:
            lines.append("".join(line))
            line = []
    lines.append("".join(line))
    return title or "", language, targets, "\n".join(filter(None, map(bare_line, lines)))


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\t\r\n\f ]+", " "))


def responses(pages: DataFrame) -> DataFrame:
    """Response records (source_key, record_id, target_uri, date, headers, payload) of stored pages."""
    url, html = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "html"))
    key = F.col("page_id").cast("long")
    digest_id = F.md5(F.concat_ws("\x01", F.coalesce(key.cast("string"), F.lit("")), url, html))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\nContent-Type: text/html; charset=utf-8\nContent-Length: "), F.octet_length(html))
    return pages.select(
        key.alias("source_key"), digest_id.alias("record_id"), one_line(url).alias("target_uri"),
        F.lit(FIXED_DATE).alias("date"), headers.alias("headers"), html.alias("payload"),
    )


def derived(records: DataFrame) -> DataFrame:
    """(source_key, record_type, record_id, refers_to, refers_to_digest, target_uri, date, content_type, block)."""

    def run(batches):
        for batch in slices(batches, "payload"):
            digests, metadata, conversions = [], [], []
            for html, headers in zip(strings(batch.column("payload")), strings(batch.column("headers"))):
                title, language, targets, text = page_parts(html)
                digests.append("sha256:" + hashlib.sha256(html.encode()).hexdigest())
                fields = [f"title: {title}", f"language: {language}", f"payload-digest: {digests[-1]}"]
                fields += [f"source-header: {BLANKS.sub(' ', h).strip(' ')}" for h in headers.split("\n")]
                metadata.append("\n".join([*fields, *(f"link: {t}" for t in targets), ""]))
                conversions.append(text)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in same), *(pa.array(c, pa.string()) for c in (digests, metadata, conversions))],
                [*same, "payload_digest", "metadata", "conversion"],
            )

    same = ["source_key", "record_id", "target_uri", "date"]
    made = records.select(*same, "headers", "payload").mapInArrow(
        run, "source_key long, record_id string, target_uri string, date string, payload_digest string, metadata string, conversion string"
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), F.col("metadata").alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain").alias("content_type"), F.col("conversion").alias("block")),
    )
    made = made.select("source_key", F.col("record_id").alias("source_id"), "payload_digest", "target_uri", "date", F.inline(kinds))
    return made.select(
        "source_key", "record_type", F.md5(F.concat_ws(" ", "source_id", "record_type")).alias("record_id"),
        F.col("source_id").alias("refers_to"), F.col("payload_digest").alias("refers_to_digest"), "target_uri", "date", "content_type", "block",
    )


def write(records: DataFrame, path: str) -> None:
    """Archive text files of derived records."""
    def uuid(column):
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(column, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))

    values = [
        F.col("record_type"), uuid("record_id"), uuid("refers_to"), F.col("refers_to_digest"), F.col("target_uri"), F.col("date"),
        digest(F.col("block")), F.coalesce(F.col("source_key").cast("string"), F.lit("")), F.col("content_type"), F.octet_length("block").cast("string"),
    ]
    head = F.concat(*[x for name, value in zip(HEADERS, values) for x in (F.lit(f"{name}: "), value, F.lit("\r\n"))])
    record = F.concat(F.lit(VERSION), head, F.lit("\r\n"), "block", F.lit("\r\n\r\n"))
    records.select(record.alias("value")).write.option("compression", "gzip").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of archive text files: header fields, block and whether length and digest hold."""
    lines = spark.read.option("lineSep", VERSION).text(path).filter("length(value) > 0")
    head, body = F.expr("substring_index(value, '\r\n\r\n', 1)"), F.expr("substring(value, instr(value, '\r\n\r\n') + 4)")
    parts = lines.select(F.concat(F.lit("\r\n"), head, F.lit("\r\n")).alias("head"), F.regexp_replace(body, "\r\n\r\n\n?$", "").alias("block"))

    def field(name):
        return F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)", 1)

    def bare(name):
        return F.replace(F.regexp_extract(field(name), "^<urn:uuid:(.*)>$", 1), F.lit("-"), F.lit(""))

    key = field("WARC-Source-Key")
    return parts.select(
        F.when(key != "", key.cast("long")).alias("source_key"),
        field("WARC-Type").alias("record_type"), bare("WARC-Record-ID").alias("record_id"), bare("WARC-Refers-To").alias("refers_to"),
        field("WARC-Refers-To-Digest").alias("refers_to_digest"), field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("date"),
        field("WARC-Block-Digest").alias("block_digest"), field("Content-Length").cast("long").alias("content_length"), "block",
        ((field("Content-Length").cast("long") == F.octet_length("block")) & (field("WARC-Block-Digest") == digest(F.col("block")))).alias("intact"),
    )


def built(pages: DataFrame) -> DataFrame:
    """Derivatives of pages, written to a new folder of the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "derivatives")
    write(derived(responses(pages)), path)
    return read(pages.sparkSession, path)
