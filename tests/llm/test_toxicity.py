"""Toxicity: held-out accuracy, gapped and inserted letters, odd inputs."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa

from corpusloom.llm import toxicity
from corpusloom.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, MEDIUM).collect()
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    own = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    bad = np.array([s for s, t in own if t == 1])
    good = np.array([s for s, t in own if t == 0])
    assert (bad[:, None] > good[None, :]).mean() > 0.93
    assert (bad >= 0.7).mean() > 0.75 and (good >= 0.7).mean() < 0.03


def test_kernel_tolerates_gaps_and_insertions():
    kernel = toxicity.Kernel(["worthless"])
    near, gap, put_in, far = kernel(["worthless", "worthles", "wor-thless", "weather"])[:, 0]
    assert near > 0.99 and gap > 0.4 and put_in > 0.15 and far < 0.05 and min(gap, put_in) > 4 * far


def test_kernel_against_brute_force():
    from itertools import combinations

    def plain(a, b):
        def spans(w):
            out = {}
            for p in combinations(range(len(w)), 3):
                if p[2] - p[0] < toxicity.LONGEST_SPAN:
                    key = tuple(w[i] for i in p)
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (p[2] - p[0] + 1)
            return out

        def size(w):
            return sum(toxicity.DECAY ** (2 * (p[2] - p[0] + 1)) for p in combinations(range(len(w)), 3) if p[2] - p[0] < toxicity.LONGEST_SPAN)

        x, y = spans(a), spans(b)
        return sum(v * y.get(k, 0) for k, v in x.items()) / np.sqrt(size(a) * size(b))

    words = ["idiot", "idiiot", "stupid", "stpid", "thesshe", "abcabcabc"]
    got = toxicity.Kernel(words)(words)
    want = np.array([[plain(a, b) for b in words] for a in words]) ** toxicity.SHARPNESS
    assert np.allclose(got, want, atol=1e-4)


def test_spaced_letters_are_a_word():
    words, code, number, first, total = toxicity.sentences(pa.array(["You i d i o t. Go!", "", None, "x\ny"]))
    assert "idiot" in words and total == 6 and first.tolist() == [0, 2, 3, 4]


def test_odd_rows(spark, docs, odd, empty):
    rows = [(i, "you stupid idiot go away. fine" if i % 2 else "a calm and quiet day. fine") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (1, None, None), (500, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(rows), labels)
    got = toxicity.scored(odd, model).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in toxicity.scored(docs([(7, "what a stupiid idiot")]), model).collect()} == {1}
    assert toxicity.scored(empty, model).collect() == []
    left = toxicity.without_toxic(docs(rows), model)
    assert left.columns == odd.columns and {r.doc_id % 2 for r in left.collect()} == {0}
    assert toxicity.fit(docs(rows), labels.limit(0)).constant == 0.0
    assert toxicity.fit(empty, labels).constant == 0.0


def test_long_words_are_learnt_by_all_their_windows():
    """An insult behind more than a window's letters, run together with others."""
    clean = ["the weather is fine today", "we went for a walk", "notes on a long evening", "a table of results"]
    padding = "abcdefghijklmnopqrstuvwxyzabcd"
    texts = [f"{c} {i}" for i, c in enumerate(clean * 10)] + [f"{c} you worthless idiot" for c in clean * 5]
    texts += [f"{c} {padding}worthless" for c in clean * 5] + [f"{c} {padding}" for c in clean * 10]
    toxic = np.array([False] * 40 + [True] * 40 + [False] * 40)
    scores = toxicity.train(texts, toxic).scorer().scores(pa.array(texts))
    assert scores[toxic].min() > scores[~toxic].max()
    fresh = toxicity.train(texts, toxic).scorer().scores(pa.array([f"a note {padding}worthless", f"a note {padding}"]))
    assert fresh[0] >= toxicity.THRESHOLD > fresh[1]


def test_scoring_holds_little_memory():
    """Many distinct long words: before, their values and the table took over 150 MB of a worker."""
    rng = np.random.default_rng(3)
    landmarks = ["".join(w) for w in rng.choice(list("abcdefghij"), size=(116, 8))]
    model = toxicity.Model(landmarks, np.ones(116), 0.0, np.zeros(5))
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), size=(40_000, 20))]
    texts = pa.array([" ".join(words[i : i + 400]) + "." for i in range(0, len(words), 400)])
    tracemalloc.start()
    scorer = model.scorer()
    scorer.scores(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    assert list(scorer.known) == words


def test_a_table_of_few_subsequences_gives_the_same_values():
    words = ["worthless", "worthles", "wor-thless", "weather", "ab", "", "日本語のテスト", "aaaaaaaaaaaaaaaaaaaa"]
    kernel = toxicity.Kernel(["worthless", "weather", "日本語のテスト"])
    factor = np.arange(6, dtype=np.float64).reshape(3, 2)
    assert np.allclose(kernel.times(words * 3000, factor), np.tile(kernel(words) @ factor, (3000, 1)))
    assert toxicity.Kernel([])(words).shape == (8, 0) and kernel([]).shape == (0, 3)


def test_workers_keep_no_words_after_a_task():
    """A worker goes on to other stages; what scoring needed goes with its task."""
    text = pa.array(["a calm and quiet day", None])
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    model = toxicity.Model(["quiet", "day"], np.ones(2), 0.0, np.ones(5))
    (part, score), = toxicity._score_slices([batch], model)
    assert part.equals(batch) and np.array_equal(score, model.scorer().scores(text))
    assert not any(isinstance(v, (dict, toxicity.Scorer)) and v for k, v in vars(toxicity).items() if not k.startswith("__"))
