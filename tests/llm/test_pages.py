"""Host reputation against its SQL, derivatives against a plain reading, odd pages."""

import hashlib
import re
import time

import pytest

from compare import connect, differences
from corpusloom.llm import derivatives, reputation
from corpusloom.llm.oracle import ORACLE
from corpusloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
PAGES = [
    (1, "HTTP://Ab.Example.NET/en/x?q#f", "<html lang='en'><title>A &amp; B</title><body><p>Hi<br>there</p><script>x</script></html>"),
    (2, "https://example.net", None), (3, None, "plain"), (4, "no scheme", ""), (None, "http://x.org/fr/a", "<p>\r\na</p>\r\n\r\n<p>WARC/1.0\r\nb"),
    (4, "no scheme", ""), (5, "a://b.notexample.com/de/", "x" * 200_000), (6, "http://y.example.com/de/1", "<a href='/q\r\nz'>q</a>"), (7, "http://net/", "<!-- c -->"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "x", "y") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, block string")


def test_reputation_matches_sql(spark):
    assert differences(QUERIES["op7_host_reputation"](spark, SMALL), connect(SMALL), ORACLE["op7_host_reputation"]) == []


def test_rules(spark, pages):
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in reputation.judged(pages, none).collect()}
    assert got[1, "ab.example.net"] == ("/en/x", "example.net/en/", "allow")
    assert got[2, "example.net"] == ("", None, "allow") and got[3, ""] == ("", None, "allow")
    assert got[None, "x.org"] == ("/fr/a", "org/fr/", "allow") and got[5, "b.notexample.com"] == ("/de/", None, "allow")
    assert got[6, "y.example.com"] == ("/de/1", "example.com/de/", "block") and got[7, "net"] == ("/", "net/", "block")
    assert reputation.judged(pages, none).count() == 9
    assert reputation.judged(pages.limit(0), none).collect() == []


def test_hosts_draw_on_their_domain(spark):
    rows = [(i, f"http://h{i % 10}.bad.com/{i}", "") for i in range(400)] + [(1000 + i, f"http://h{i % 10}.good.com/{i}", "") for i in range(400)]
    rows += [(5000, "http://new.bad.com/", ""), (5001, "http://new.good.com/", "")]
    labels = spark.createDataFrame([(i, 1) for i in range(400)] + [(1000 + i, 0) for i in range(400)] + [(None, 1), (3, None)], "page_id long, bad int")
    got = {r.page_id: r for r in reputation.judged(spark.createDataFrame(rows, "page_id long, url string, html string"), labels).collect()}
    assert got[1].verdict == "block" and got[1001].verdict == "allow" and len(got) == 802
    assert got[5000].bad_rate > 0.9 > 0.1 > got[5001].bad_rate


def test_derivatives(spark, pages):
    rows = derivatives.built(pages).collect()
    assert len(rows) == 18 and all(r.intact for r in rows)
    own = {(r.source_key, r.record_type): r for r in rows}
    assert own[1, "conversion"].block == "A & B\nHi\nthere" and own[2, "conversion"].block == ""
    assert own[1, "metadata"].block.startswith("title: A & B\nlanguage: en\n") and "link: /q z\n" in own[6, "metadata"].block
    assert own[None, "conversion"].block == "a\nWARC/1.0 b" and own[5, "conversion"].content_length == 200_000
    for r in rows:
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
    assert own[1, "metadata"].refers_to == own[1, "conversion"].refers_to != own[1, "conversion"].record_id
    assert own[1, "metadata"].refers_to_digest == "sha256:" + hashlib.sha256(PAGES[0][2].encode()).hexdigest()
    assert derivatives.built(pages.limit(0)).collect() == []


def test_derivatives_of_whole_pages(spark):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = QUERIES["op8_derivatives"](spark, SMALL).collect()
    assert len(rows) == 2 * len(html) and all(r.intact for r in rows)
    for r in rows:
        page = html[r.page_id]
        if r.record_type == "metadata":
            assert re.findall(r"\nlink: (.*)", r.block) == re.findall(r'<a\b[^>]*\bhref="([^"]*)', page)
        else:
            left = re.sub(r"(?s)<!--.*?-->|<(script|style|head)\b.*?</\1>", " ", page)
            words = re.sub(r"<[^>]*>", " ", left)
            for entity, letter in derivatives.ENTITIES:
                words = words.replace(entity, letter)
            assert "".join(r.block.split()) == "".join(words.split())


@pytest.mark.parametrize(
    "html, text",
    [
        ("<html><head><title>T</title><p>kept text</p><script>x</script>more", "kept text\nmore"),
        ("<head><title>T</title>kept <b>text</b>", "kept text"),
        ("<head><title>T</title><style>a</style><script>'</head>'</script></head>body", "body"),
        ("<script>if (a < b) {}</script>a<SCRIPT>x</Script >b<style>never closed", "a b never closed".replace(" n", "n")),
        ("a <!-- b --> c <!-- d > e", "a c e"),
        ("1 < 2 and 3 &lt; 4 <b>x</b> y < z", "1 < 2 and 3 < 4 x y < z"),
        ("a<b", "a<b"), ("<", "<"), (">", ">"), ("<>", "<>"), ("a<br/>b<BR>c</p >d", "a\nb\nc\nd"),
        ("&amp;lt; &nbsp; x", "&lt; x"), ("日<i>本</i>", "日本"), ("", ""),
    ],
)
def test_plain_text(html, text):
    assert derivatives.page_parts(html)[3] == text


def test_fields_of_a_page():
    title, language, targets, _ = derivatives.page_parts(
        "<HTML class=x lang='pt-BR'><title>a &amp; <b>b</title><title>c</title><a class=y href=z>1</a><a data-href='n'>2</a><a href='q\r\nr'>3</a><A HREF=\"\">"
    )
    assert (title, language, targets) == ("a & <b>b", "pt-BR", ["z", "q r", ""])


@pytest.mark.parametrize("piece", ["<!--", "<script>", "<head>", "<", "<a href='", "</script", "</script" + " " * 50, "<title>", "&amp;", "<p>", "<!-- <script> -->"])
def test_time_grows_with_the_page(piece):
    begun = time.time()
    derivatives.page_parts(piece * 100_000)
    derivatives.page_parts(piece * 100_000 + ">")
    assert time.time() - begun < 20
