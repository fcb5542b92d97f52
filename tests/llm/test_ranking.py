"""Ranked search against a plain evaluation of every document for every item."""

import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from compare import connect, differences
from corpusloom.llm import ranking
from corpusloom.llm.oracle import ORACLE
from corpusloom.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items):
    counts = [(key, Counter(terms(text))) for key, text in docs]
    full = [c for _, c in counts if c]
    number, total = len(full), sum(sum(c.values()) for c in full)
    df = Counter(t for c in full for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c in counts:
            m = 75 + (25 * sum(c.values()) * number) // max(1, total)
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        out += [(item, rank, key, -score) for rank, (score, _, key) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:20], 1)]
    return sorted(map(repr, out))


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(repr(tuple(r)) for r in df.collect())


def test_terms():
    for text in ["", "A b-C\x00d\x7fe É日本_x9", "½ª ŉ   a b", "ÀÉ aB\n\tC"]:
        assert [t for t in ranking.terms_of(text) if t] == terms(text)


def test_query(spark, folder):
    df = QUERIES["op11_ranking"](spark, folder)
    assert differences(df, connect(folder), ORACLE["op11_ranking"]) == []
    tables = [spark.read.parquet(f"{folder}/{t}.parquet").select(k, "text").collect() for t, k in (("documents", "doc_id"), ("benchmark", "item_id"))]
    assert result(df) == brute(*tables)


def test_ties_repeats_and_odd_rows(spark, docs, odd, empty):
    many = [(k, "common words here and a rare" + " one" * (k % 3)) for k in range(60)] + [(3, "rare rare"), (3, "rare rare"), (None, "rare words"), (None, None), (99, "other")]
    items = [(1, "rare words"), (1, "rare words"), (2, ""), (3, None), (None, "rare one ONE"), (4, "nowhere"), (5, "two logs 日本 line word17 one")]
    wanted = spark.createDataFrame(items, "item_id long, text string")
    assert result(ranking.ranked(docs(many), wanted)) == brute(many, items)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(ranking.ranked(odd, wanted)) == brute(rows, items)
    assert ranking.ranked(empty, wanted).collect() == []
    assert ranking.ranked(odd, wanted.limit(0)).collect() == []


def test_parts_and_blocks(spark, docs, monkeypatch):
    """Many small blocks, few groups at once and several parts of items give the same."""
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    odds = 1 / np.arange(1, 61)
    rows = [(k, " ".join(random.choice(words, size=int(random.integers(0, 90)), p=odds / odds.sum()))) for k in range(900)]
    items = [(i, " ".join(random.choice(words, size=int(random.integers(1, 70))))) for i in range(30)]
    for name, value in (("BLOCK", 64), ("GROUPS", 4), ("PART_BYTES", 2000)):
        monkeypatch.setattr(ranking, name, value)
    assert result(ranking.ranked(docs(rows), spark.createDataFrame(items, "item_id long, text string"))) == brute(rows, items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdef"), max_size=9), max_size=60), st.lists(st.sampled_from("abcdefz"), min_size=1, max_size=12))
def test_masks(texts, item):
    """One block: the groups that are left out hold no document of the result."""
    import pyarrow as pa

    vocabulary = sorted(set(item))
    number, owner, term, tf = ranking.counted(pa.array([" ".join(t) for t in texts], pa.string()), pa.array(vocabulary, pa.large_string()))
    assert number.tolist() == [len(t) for t in texts]
    m = 75 + number
    repeats = np.array([item.count(t) for t in vocabulary]) * 7
    block = ranking.Block(np.arange(len(texts)), m, owner, term, tf, len(vocabulary))
    heap: list = []
    block.top(ranking.Item(np.arange(len(vocabulary)), repeats), heap)
    want = []
    for k, text in enumerate(texts):
        s = sum(7 * item.count(t) * ((10**9 * text.count(t)) // (1000 * text.count(t) + 12 * int(m[k]))) for t in set(item) if t in text)
        if s:
            want.append((s, -k))
    assert sorted(heap) == sorted(want)[-20:]
