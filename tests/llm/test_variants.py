"""Spelling variants against brute force over all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpusloom.llm import variants
from corpusloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(variants.UPPER, variants.LOWER)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_of(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute(counts):
    near = {w: [] for w in counts}
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    for size, own in by_size.items():
        for i, a in enumerate(own):
            for b in own[i + 1 :] + by_size.get(size + 1, []):
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def result(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute(words_of(map(tuple, rows)))
    assert any(w[4] for w in want) and any(w[1] for w in want)
    df = QUERIES["op13_variants"](spark, SMALL)
    assert df.columns[:3] == ["word", "form", "root"]
    assert result(df) == want


def planted():
    """A hot prefix, a hot suffix, all letters at one place, repeated letters and a chain of forms."""
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèé"
    lines = {f"prefixprefix{a}{b}": 5 + (i * 7 + j) % 40 for i, a in enumerate(letters) for j, b in enumerate(letters)}
    lines |= {f"{a}{b}suffixsuffix": 5 + (i + j) % 3 for i, a in enumerate(letters) for j, b in enumerate(letters[:9])}
    lines |= {"aaaaaa": 5, "aaaaaaa": 6, "aaaaaaaa": 40, "aaaaaaab": 300, "abaaaab": 7, "x" * 500: 6, "x" * 499 + "y": 31, "x" * 498: 9}
    lines |= {"chainone": 5, "chaintwo": 25, "chaintwoo": 5, "chainto": 125, "chaino": 700, "untouched": 5, "toorare": 4, "short": 50}
    return [(k, " ".join([w] * n)) for k, (w, n) in enumerate(lines.items())]


def test_hot_buckets_are_split(spark, docs, monkeypatch):
    monkeypatch.setattr(variants, "TILE_STEPS", 50_000)
    rows = planted()
    want = brute(words_of(rows))
    seen = []
    inner = variants._halves
    monkeypatch.setattr(variants, "_halves", lambda r: seen.append(1) or inner(r))
    assert result(variants.grouped(docs(rows))) == want
    assert len(seen) > 2  # the first split and more
    placed = variants.buckets(variants.counted(docs(rows))).groupBy(variants.KEY).count().collect()
    letters = 26 + 64  # a bucket that cannot be split holds one word for each letter, and the word without it
    assert all(r["count"] ** 2 * r.m <= variants.TILE_STEPS or (r.pre + 1 == r.lim and r["count"] <= letters + 1) for r in placed)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=3, max_size=9), min_size=2, max_size=24, unique=True))
def test_tile(words):
    """With nothing shared, one bucket of each length finds all its pairs."""
    for m in {len(w) for w in words}:
        own = [w for w in words if len(w) in (m, m - 1)]
        fixed = [np.full(len(own), v) for v in (m, 0, m)]
        first, second = variants.near_rows(own, *fixed, np.array([0]))
        want = {(a, b) for a in own for b in own if max(len(a), len(b)) == m and one_edit(a, b)}
        assert {(own[i], own[j]) for i, j in zip(first, second)} == want
        assert len(first) == len(want)


def test_odd_rows(spark, odd, empty, docs):
    want = brute(words_of((r.doc_id, r.text) for r in odd.collect()))
    assert result(variants.grouped(odd)) == want
    assert variants.grouped(empty).collect() == []
    rows = [(None, "ABCDEFÀ abcdefÀ abcdefà"), (7, "abcdefÀ " * 9), (7, "abcdefÀ " * 9), (8, "abcdef×÷ " * 5)]
    assert result(variants.grouped(docs(rows))) == brute(words_of(rows))


@pytest.mark.parametrize("key", ["17", "", "-3"])
def test_written(spark, key):
    runs = [f"letters{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrstuvwxyz"]
    df = spark.createDataFrame([(key or None, r) for r in runs], "key string, run string")
    got = {r.run: r.w for r in df.select("run", variants.written(df.key, df.run).alias("w")).collect()}
    for run in runs:
        h = zlib.crc32(f"{key}:{run}".encode())
        assert got[run] == (run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :])
    assert any(g != r for r, g in got.items())
