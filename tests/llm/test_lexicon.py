"""Encoding by the transducer against the tokenizers library, and the transducer against plain lookup."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import lexicon
from corpusloom.llm.queries import QUERIES
from corpusloom.llm.word_encoder import tokenizer_path

SMALL = "/root/testdata/sf0.001"
WORD = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def want(library, rows):
    out = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed, decoded = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        out.append((key, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(map(repr, out))


def test_query(spark, library):
    rows = map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    df = QUERIES["op12_lexicon"](spark, SMALL)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(repr(tuple(r)) for r in df.collect()) == want(library, rows)


STRANGE = [
    "Hello World's ΣΑΣ İstanbul ½²ª 日本語 don't !!'s 'S 'street '''s a\x00b \x1c\x85x  ́e é",
    "x<|endoftext|>Y <|startoftext|><|endoftext|> <|endoftext| >", "ſŉĿ ĲŸ ×÷ – “quoted” …", "é Å ﬁ Ⅷ ٣ ๑",
    "   　 ", "\r\n\t\x0b\x0c", "🙂🙂👩‍👩‍👧", "a" * 5000, "!" * 3000 + "1" * 200, "ab" * 400 + "'ll've", "µÀÉÎ ñandú" * 50,
]


def test_odd_rows(spark, library, odd, empty, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(repr(tuple(r)) for r in lexicon.digests(odd, WORD).collect()) == want(library, rows)
    strange = [(k, t) for k, t in enumerate(STRANGE * 2)]
    assert sorted(repr(tuple(r)) for r in lexicon.digests(docs(strange), WORD).collect()) == want(library, strange)
    assert lexicon.digests(empty, WORD).collect() == []
    for row in lexicon.coded(docs(strange), WORD).collect():
        assert row.ids == library.encode(STRANGE[row.doc_id % len(STRANGE)], add_special_tokens=False).ids
        assert row.decoded == library.decode(row.ids, skip_special_tokens=False)


def opened(words, folder):
    path = folder / "lexicon"
    path.write_bytes(lexicon.compiled(sorted(words.items())))
    return lexicon.Transducer(str(path))


def looked_up(transducer, words):
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words])
    known, counts, ids = transducer.ids(data, ends - [len(w) for w in words], ends)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    return [tuple(ids[a:b].tolist()) if k else None for k, a, b in zip(known, cuts[:-1], cuts[1:])]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.binary(max_size=5).map(lambda b: bytes(c % 3 for c in b)), st.lists(st.integers(0, 3), max_size=4).map(tuple), max_size=30))
def test_transducer(tmp_path_factory, words):
    transducer = opened(words, tmp_path_factory.mktemp("t"))
    asked = [*words, b"\x00\x01\x02\x00\x01\x02", b"\x09", b""]
    assert looked_up(transducer, asked) == [words.get(w) for w in asked]


def states_needed(words):
    """States of the least transducer: distinct functions from endings to what is left of the ids."""
    from os.path import commonprefix

    kinds = set()
    for begin in {w[:i] for w in words for i in range(len(w) + 1)}:
        own = {w[len(begin) :]: ids for w, ids in words.items() if w.startswith(begin)}
        cut = len(commonprefix(list(own.values()))) if begin else 0
        kinds.add(frozenset((w, ids[cut:]) for w, ids in own.items()))
    return len(kinds)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text("ab", min_size=1, max_size=6).map(str.encode), st.lists(st.integers(0, 2), min_size=1, max_size=3).map(tuple), min_size=1, max_size=20))
def test_transducer_is_minimal(tmp_path_factory, words):
    assert len(opened(words, tmp_path_factory.mktemp("t")).ends) == states_needed(words)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, tmp_path_factory, text):
    words = lexicon.merges(WORD)
    known = {w: words.ids(w) for w in (b"the", b"a", b"'s", b"!")}
    transducer = opened(known, tmp_path_factory.mktemp("t"))
    texts = [text, "the cat's a hat!", text + " the"]
    ids, ends = lexicon.encoded(words, transducer, pa.array(texts))
    for own, one in zip(np.split(ids, ends[:-1]), texts):
        assert own.tolist() == library.encode(one, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text("abcehinorst", min_size=2, max_size=120))
def test_both_ways_to_merge(library, word):
    words = lexicon.merges(WORD)
    parts = [words.inner[b] for b in word.encode()]
    parts[-1] = words.last[ord(word[-1])]
    assert words.short(list(parts)) == words.long(list(parts)) == library.encode(word, add_special_tokens=False).ids


def test_frequent(spark):
    counts = spark.createDataFrame([(bytes([i]), n) for i, n in enumerate([1, 2, 3, 4, 5, 8, 9, 100])], "word binary, n long")
    found = {most: sorted(r.n for r in lexicon.frequent(counts, most).collect()) for most in (0, 1, 3, 4, 5, 8)}
    assert found == {0: [], 1: [100], 3: [8, 9, 100], 4: [5, 8, 9, 100], 5: [4, 5, 8, 9, 100], 8: [1, 2, 3, 4, 5, 8, 9, 100]}
