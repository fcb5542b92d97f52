"""Fingerprints: likeness and edited texts against plain sets, peeling, order of documents."""

import hashlib
import random

from corpusloom.llm import fingerprints
from corpusloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def check(rows, got):
    """rows: (doc_id, text) with distinct keys, in descending order."""
    by, seen = {r.doc_id: r for r in got}, {}
    assert len(got) == len(rows)
    for i, (key, text) in enumerate(rows):
        text = text or ""
        after = rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (set(t.split("\n")) for t in (text, edited, after))
        r = by[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - len(a & b) / len(a | b)) < 1e-9 and abs(r.near_next - len(a & c) / len(a | c)) < 1e-9
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(sorted(rows, reverse=True), QUERIES["op10_fingerprints"](spark, SMALL).collect())


def test_sparse_keys_and_large_differences(docs):
    rng = random.Random(4)
    rows = []
    for key in (-700, -3, 0, 511, 512, 1024, 10**6, 10**12, 10**12 + 1):
        rows.append((key, "\n".join(f"line {rng.randrange(3000)} é" for _ in range(rng.choice([1, 3, 40, 900])))))
    check(sorted(rows, reverse=True), fingerprints.fingerprinted(docs(rows)).collect())


def test_differing_digests(spark):
    rows = [(1, [1 << 30, 2 << 30], [2 << 30]), (2, [], []), (3, list(range(1 << 33, (1 << 33) + 400 * (1 << 26), 1 << 26)), [])]
    digest = lambda v: f"shiftleft({v}, 24) | (xxhash64(CAST({v} AS BIGINT)) & 16777215L)"
    sets = spark.createDataFrame(rows, "id long, a array<long>, b array<long>")
    sets = sets.selectExpr("id", f"transform(a, v -> {digest('v')}) AS a", f"transform(b, v -> {digest('v')}) AS b")
    want = {r.id: set(r.a) ^ set(r.b) for r in sets.collect()}
    got = {r.id: (set(r.found), r.n_differing) for r in fingerprints.differing(sets).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_main_path_has_no_python(docs):
    plan = fingerprints.fingerprinted(docs([(1, "a\nb"), (2, "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(docs, odd, empty):
    rows = fingerprints.fingerprinted(odd).collect()
    assert len(rows) == 9 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.fingerprinted(empty).collect() == []
    (one,) = fingerprints.fingerprinted(docs([(7, "ab\ncd")])).collect()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"ab\nab").hexdigest()


def test_a_key_of_many_rows_and_no_key_fill_several_groups(spark, docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "GROUP_ROWS", 8)
    monkeypatch.setattr(fingerprints, "COPIES", 3)
    rng = random.Random(6)
    line = lambda: "\n".join(f"line {rng.randrange(40)} é" for _ in range(rng.choice([1, 2, 5])))
    rows = [(None, line()) for _ in range(60)] + [(None, "a copy\nof one")] * 25 + [(None, None)] * 2
    rows += [(5, line()) for _ in range(40)] + [(5, "same")] * 10 + [(6, "x\ny")] * 2 + [(7, line())]
    rows += [(9000, line()), (-9000, line())] + [(-9000, "z")] * 30 + [(10**12, line()) for _ in range(4)]
    table = docs(rows)
    ties = {r.text: r.tie for r in table.selectExpr("coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS tie").distinct().collect()}
    texts = [(key, text or "") for key, text in rows]
    texts.sort(key=lambda r: (r[0] is None, -(r[0] or 0), ties[r[1]]))
    want = []
    for i, (key, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, c = set(text.split("\n")), set(after.split("\n"))
        want.append((str(key), len(text), hashlib.sha256(edited.encode()).hexdigest(), round(len(a & c) / len(a | c), 9)))
    got = fingerprints.fingerprinted(table).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_next, 9)) for r in got) == sorted(want)
    placed, copied = fingerprints._grouped(table.selectExpr("doc_id", "coalesce(text, '') AS text"))
    assert placed.groupBy(*fingerprints.GROUP).count().selectExpr("max(count)").first()[0] <= 16
    assert copied.agg({"n": "max"}).first()[0] == 30
