"""Benchmark leaks: exact distances, recall of the embedding, clean texts left alone."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpusloom.llm import decontamination as leaks
from corpusloom.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.1"


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=12), st.text("abc ", max_size=25))
def test_distance_against_dynamic_programming(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    assert leaks.distance_within(item, text) == min(row)


def edited(text, rate, rng):
    letters = list(text)
    for _ in range(int(len(letters) * rate)):
        at, kind = rng.randrange(len(letters)), rng.random()
        if kind < 0.4:
            letters[at] = rng.choice("abcdef ")
        elif kind < 0.7:
            del letters[at]
        else:
            letters.insert(at, rng.choice("abcdef "))
    return "".join(letters)


def test_recall_of_edited_items(spark):
    rng = random.Random(3)
    items = [r.text for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").orderBy("item_id").collect()]
    around = [r.text for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").orderBy("doc_id").limit(300).collect()]
    index = leaks.build(list(range(len(items))), items)
    for rate, least in ((0, 1), (0.05, 0.98), (0.1, 0.95)):
        texts = []
        for item in items:
            text = rng.choice(around)
            at = rng.randrange(len(text))
            texts.append(f"{text[:at]} {edited(item, rate, rng)} {text[at:]}")
        found = leaks.leaks(index, texts)
        assert sum(i in f for i, f in enumerate(found)) >= least * len(items)


def test_recall_at_the_full_distance(spark):
    rng = random.Random(3)
    items = [r.text for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").orderBy("item_id").collect()]
    index = leaks.build(list(range(len(items))), items)
    texts, own = [], []
    for rate in (0.2, 0.22, 0.24, 0.26):
        for i, item in enumerate(items):
            text, whole = edited(item, rate, rng), leaks.plain(item)
            if 0.17 * len(whole) <= leaks.distance_within(whole, leaks.plain(text)) <= leaks.allowed(whole):
                texts.append(f"{items[i - 1]} {text} {items[i - 2]}")
                own.append(i)
    found = leaks.leaks(index, texts)
    assert len(own) > 200 and sum(i in f for i, f in zip(own, found)) >= 0.95 * len(own)


CYRILLIC = {ord(a): chr(0x430 + i) for i, a in enumerate("abcdefghijklmnopqrstuvwxyz")}
HAN = {ord(a): chr(0x4E00 + 31 * i) for i, a in enumerate("abcdefghijklmnopqrstuvwxyz")}


@pytest.mark.parametrize("letters", [CYRILLIC, HAN])
def test_recall_with_letters_of_several_bytes(spark, letters):
    rng = random.Random(4)
    items = [leaks.plain(r.text).translate(letters) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").orderBy("item_id").limit(60).collect()]
    if letters is HAN:
        items = [t.replace(" ", "") for t in items]
    index = leaks.build(list(range(len(items))), items)
    texts, own = [], []
    for rate in (0.18, 0.2, 0.22):
        for i, item in enumerate(items):
            text = edited(item, rate, rng).translate(letters)
            if 0.15 * len(item) <= leaks.distance_within(item, leaks.plain(text)) <= leaks.allowed(item):
                texts.append(f"{items[i - 1]} {text} {items[i - 2]}")
                own.append(i)
    found = leaks.leaks(index, texts)
    assert len(own) > 60 and sum(i in f for i, f in zip(own, found)) >= 0.95 * len(own)


def test_letters_put_in_at_one_place():
    """Slack is counted in letters: 45 letters of three bytes each stand within the item."""
    rng = random.Random(1)
    words = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3)) for _ in range(60)]
    item = " ".join(words)
    for at in (10, 30, 50):
        text = " ".join(words[:at]) + " " + "書" * 44 + " " + " ".join(words[at:])
        assert leaks.leaks(leaks.build([1], [item]), [f"前 {text} 後"]) == [{0: leaks.distance_within(item, text)}]
        assert leaks.distance_within(item, text) > 35 and leaks.allowed(item) == 47


def test_query_against_every_pair(spark, docs, tmp_path):
    rng = random.Random(5)
    folder = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").limit(12).collect()]
    around = [r.text[:600] for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = [(i, t if i % 3 else f"{t[:200]} {edited(rng.choice(items)[1], 0.04, rng)} {t[200:]}") for i, t in enumerate(around)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = set()
    for key, text in rows:
        for number, item in items:
            distance = leaks.distance_within(leaks.plain(item), leaks.plain(text))
            if distance <= leaks.allowed(leaks.plain(item)):
                want.add((key, number, distance))
    assert {tuple(r) for r in QUERIES["op9_benchmark_leaks"](spark, str(tmp_path)).collect()} == want and len(want) > 10


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "word29990 line word29991 line word29992 line word29993"), (2, None), (None, "other text"), (3, ""), (3, "ONE  two\nthree"), (3, "one two three")], "item_id long, text string")
    got = sorted(((str(r.doc_id), str(r.item_id), r.distance) for r in leaks.leaked(odd, items).collect()))
    assert got == [("1", "3", 0)] * 4 + [("1", "None", 0), ("4", "1", 0)]
    left = leaks.without_leaks(odd, items)
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["2", "3", "5", "None", "None"]
    assert leaks.leaked(empty, items).collect() == [] and leaks.leaked(odd, items.limit(0)).collect() == []
    assert leaks.without_leaks(odd, items.limit(0)).count() == 9


def test_least_distances_are_never_over_the_distance():
    random = np.random.default_rng(3)
    letters = list("abcdé 漢字xyz")
    pairs = []
    for number in range(300):
        item = "".join(random.choice(letters, size=random.integers(1, 200)))
        text = "".join(random.choice(letters, size=random.integers(0, 300)))
        if number % 2:
            changed = list(item)
            for at in random.integers(0, len(item), size=len(item) // 6):
                changed[at] = random.choice(letters)
            text = text[:50] + "".join(changed) + text[50:]
        pairs.append((item, text))
    pairs.sort(key=lambda p: len(p[1]))
    exact = np.array([leaks.distance_within(*p) for p in pairs])
    least = leaks.least_distances(pairs)
    assert (least <= exact).all()
    one_piece = np.array([len(item) <= leaks.PIECE for item, _ in pairs])
    assert (least == exact)[one_piece].all() and one_piece.sum() > 50
    assert len(leaks.least_distances([])) == 0


def test_items_near_each_other_and_in_long_parts_are_found():
    items = ["the quick brown fox jumps over the lazy dog near the river bank today", "seven wizards quietly boxed up jars of violet jam for the evening train"]
    index = leaks.build([1, 2], items)
    edited = items[0].replace("brown", "brwn")
    many = " ".join([edited] * 100)
    found = leaks.leaks(index, [edited + " and " + items[0], many, many + " " + items[1], ""])
    assert found == [{0: 0}, {0: 1}, {0: 1, 1: 0}, {}]
