"""Near-copies: shingles, darts and classes against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import near_copies as near


def shingle_set(text):
    words = text.lower().split()
    parts = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
    return Counter(parts)


def alike(a, b):
    x, y = shingle_set(a), shingle_set(b)
    plain = len(x.keys() & y.keys()) / len(x.keys() | y.keys())
    least = sum(min(n, y.get(k, 0)) for k, n in x.items())
    return max(plain, least / (sum(x.values()) + sum(y.values()) - least))


def brute_classes(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(rows[i][1] or "", rows[j][1] or "") >= 0.8:
                parent[root(i)] = root(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(key)
    return sorted(sorted(map(str, g)) for g in groups.values())


def found_classes(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.class_key, []).append(r.doc_id)
    for r in rows:
        assert r.class_id == min((k for k in groups[r.class_key] if k is not None), default=None)
    return sorted(sorted(map(str, g)) for g in groups.values())


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows, key = [], 100
    for group in range(6):
        base = [word() for _ in range(rng.randint(40, 300))]
        for copy in range(rng.choice([1, 3, 12])):
            own = list(base)
            for _ in range(int(len(own) * rng.choice([0, 0, 0.01, 0.015]))):
                own[rng.randrange(len(own))] = word()
            rows.append((key, " ".join(own)))
            key += 1
    line = " ".join(word() for _ in range(30))
    rows += [(key + i, line + " " + " ".join(word() for _ in range(25))) for i in range(25)]  # share a passage only
    return rows + [(1, "a b"), (2, "A  b"), (3, "a c"), (4, ""), (5, None)]


def test_classes_against_brute_force(docs, planted):
    assert found_classes(near.near_classes(docs(planted)).collect()) == brute_classes(planted)


def test_chains_past_a_centre(docs):
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    rows, chains = [], []
    for chain in range(30):
        centre = words(400)
        a = centre[:395] + words(5)  # like the copies and like b
        b = words(41) + a[41:]  # like a only
        copies = [" ".join(centre[:i] + words(1) + centre[i + 1 :]) for i in range(12)]
        a, b = " ".join(a), " ".join(b)
        assert min(alike(a, b), *(alike(a, c) for c in copies)) >= 0.8 > max(alike(b, c) for c in copies)
        chains.append(range(len(rows), len(rows) + 14))
        rows += [(len(rows) + i, t) for i, t in enumerate([a, b, *copies])]
    found = {r.doc_id: r.class_id for r in near.near_classes(docs(rows)).collect()}
    assert [chain for chain in chains if {found[i] for i in chain} != {chain[0]}] == []


def test_a_text_and_itself_repeated(docs):
    rng = random.Random(13)
    rows = []
    for _ in range(12):
        text = " ".join(f"w{rng.randrange(10**7)}" for _ in range(200))
        rows += [(len(rows) + i, " ".join([text] * times)) for i, times in enumerate((1, 2, 3, 9))]
    found = found_classes(near.near_classes(docs(rows)).collect())
    assert found == brute_classes(rows) and len(found) == 12


def test_shingles_against_plain_ones(planted):
    texts = [t or "" for _, t in planted]
    owner, _, count = near.shingles(texts)
    for i, text in enumerate(texts):
        assert sorted(count[owner == i].tolist()) == sorted(shingle_set(text).values())


def test_signatures_agree_as_weighted_likeness():
    rng = np.random.default_rng(0)
    element = rng.integers(1, 1 << 62, 400, dtype=np.int64).astype(np.uint64)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 9, 400)
    shared = []
    for seed in range(12):
        own = near.mixed(element + np.uint64(seed))
        signs = []
        for weight in (a, b):
            keep = weight > 0
            limit = np.array([near.COORDINATES * 12 / weight.sum()])
            o, c, r, d = near.darts(np.zeros(keep.sum(), dtype=np.int64), own[keep], weight[keep].astype(float), limit)
            best = {}
            for coordinate, rank, dart in zip(c.tolist(), r.tolist(), d.tolist()):
                best[coordinate] = min(best.get(coordinate, (9e9, 0)), (rank, dart))
            signs.append(best)
        shared += [signs[0][k] == signs[1][k] for k in signs[0].keys() & signs[1].keys()]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(np.mean(shared) - want) < 0.04


def test_bands_find_likeness_of_08():
    rng = random.Random(7)
    hits = 0
    for trial in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(500)]
        other = list(words)
        for _ in range(11):
            other[rng.randrange(500)] = f"x{rng.randrange(10**6)}"
        a, b = near.bands(near.signatures([" ".join(words), " ".join(other)]))
        hits += bool((a == b).any())
    assert hits >= 59


def test_odd_rows(odd, empty):
    rows = near.near_classes(odd).collect()
    assert found_classes(rows) == brute_classes([(r.doc_id, r.text) for r in odd.collect()])
    kept = near.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((str(r.doc_id), str(r.text)[:20]) for r in kept.collect()) == [
        ("1", "one two three"), ("1", "other text"), ("2", "None"), ("4", "word0 line word1 lin"), ("5", "日本 é \n\n x  y"), ("None", "no key"),
    ]
    assert near.near_classes(empty).collect() == [] and near.one_of_each(empty).collect() == []


def test_many_texts_that_share_most_make_no_pairs(docs, monkeypatch):
    """Alike at about 0.74: pairs that are compared whole grow with the texts, not with their square."""
    rng = random.Random(17)
    words = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    passage = words(178)
    rows = [(i, " ".join(passage + words(31))) for i in range(300)]
    rows += [(1000, rows[7][1] + " end"), (1001, rows[290][1] + " end")]
    assert 0.7 < alike(rows[0][1], rows[1][1]) < 0.78
    made, inner = [], near._verified

    def counted(pairs, texts):
        made.append(pairs.count())
        return inner(pairs, texts)

    monkeypatch.setattr(near, "_verified", counted)
    found = {r.doc_id: r.class_id for r in near.near_classes(docs(rows)).collect()}
    assert found[1000] == 7 and found[1001] == 290 and len(set(found.values())) == 300
    assert sum(made) < 20 * len(rows)


def test_bags(planted):
    texts = [t or "" for _, t in planted][:40] + ["a b c d e f a b c d e f a b c d e f", "a b c d e f a b c d e g"]
    owner, element, count = near.shingles(texts)
    bags = near.Bags([near.bag(element[owner == i], count[owner == i]) for i in range(len(texts))] + [None])
    for i in range(len(texts)):
        got = bags.likeness(i, np.arange(len(texts) + 1))
        assert got[:-1] == pytest.approx([alike(texts[i], t) for t in texts]) and got[-1] == 1


def test_one_of_each_keeps_columns_of_any_name(spark, docs):
    rows = docs([(1, "one two"), (2, "one two"), (None, "one two"), (3, "other")])
    for name in ("__own", "__key", "__id", "id", "row", "with.dot"):
        rows = rows.withColumn(name, F.lit(f"own {name}"))
    left = near.one_of_each(rows)
    assert left.columns == rows.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3] and {r["__own"] for r in left.collect()} == {"own __own"}


def test_powers_for_texts_of_all_sizes_are_kept_once(monkeypatch):
    """Before, a worker kept rows of powers for every size that it met."""
    monkeypatch.setattr(near, "_POWERS", [np.ones(0, dtype=np.uint64)] * 2)
    text = "one two three four five six " * 40_000
    for size in (100, 50_000, 500_000, len(text), 70_000):
        alone = near.shingles([text[:size]])
        after = near.shingles(["x " * 30_000, text[:size]])
        own = after[0] == 1
        assert all(np.array_equal(a, b[own]) for a, b in zip(alone[1:], after[1:]))
    held = sum(p.nbytes for p in near._POWERS)
    assert 16 * len(text) <= held <= 17 * (len(text) + 60_001)
    longest = near._powers(near.POWERS + 1)  # made for one text, not kept
    assert len(longest[0]) > near.POWERS and held == sum(p.nbytes for p in near._POWERS)
    assert all(np.array_equal(a[:1000], b[:1000]) for a, b in zip(longest, near._POWERS))
