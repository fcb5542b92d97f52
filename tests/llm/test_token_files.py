"""Token files: exact round trips, codes against a plain Huffman bound, ids against the library."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import token_files
from corpusloom.llm.queries import QUERIES
from corpusloom.llm.word_encoder import WordEncoder, tokenizer_path

SMALL = "/root/testdata/sf0.001"

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module", params=[(BYTE, True), (WORD, False)])
def words(request):
    return WordEncoder(*request.param)


PIECES = st.lists(st.sampled_from([" ", "  ", "\n", "\n\n", "a", "Word", "it's", "'ll", ".", ",", "é", "日", "12", "\t", "\x1c", "_", "<|endoftext|>", "\x01", "\xa0", "?!"]), max_size=12).map("".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(PIECES | st.text(max_size=20), min_size=1, max_size=6))
def test_ids_are_the_librarys(words, texts):
    ids, counts = words.encode(pa.array(texts))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    whole = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [p.tolist() for p in parts] == whole


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 300), st.integers(1, 10**9), min_size=2, max_size=60))
def test_codes_are_prefix_free_and_limited(counts):
    lengths = token_files.code_lengths(counts)
    used = lengths[lengths > 0].astype(int)
    assert set(np.flatnonzero(lengths)) == set(counts) and used.max() <= 16
    assert sum(2.0 ** -int(n) for n in used) == 1


def test_short_codes_cost_what_huffman_does():
    import heapq

    rng = np.random.default_rng(1)
    counts = {i: int(n) for i, n in enumerate(rng.integers(1, 1000, 200))}
    heap, cost = list(counts.values()), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    lengths = token_files.code_lengths(counts)
    assert sum(int(lengths[i]) * n for i, n in counts.items()) == cost


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=1500), min_size=1, max_size=5))
def test_blocks_round_trip(documents):
    ids = np.array([i for d in documents for i in d], dtype=np.uint32)
    counts = np.array([len(d) for d in documents], dtype=np.int64)
    found, n = np.unique(ids, return_counts=True)
    lengths = token_files.code_lengths(dict(zip(found.tolist(), n.tolist())))
    payload, sizes, offsets, marks = token_files.encode_documents(ids, counts, lengths, token_files.canonical_codes(lengths))
    data = token_files.block(np.arange(len(counts)), np.zeros(len(counts), bool), counts, sizes, marks, offsets, payload, 7)
    keys, nulls, got_counts, first, got = token_files.read_block(data, token_files.decoding_table(lengths))
    assert got.tolist() == ids.tolist() and got_counts.tolist() == counts.tolist() and first == 7


def expected(rows):
    tokenizer = Tokenizer.from_file(BYTE)
    at, out = 0, []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_against_the_library(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op2_token_files"](spark, SMALL).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows)


def test_odd_rows(odd, empty):
    got = sorted(map(tuple, token_files.coded(odd, BYTE).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 1, 1, 2, 3, 4, 5]
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist()
    assert sorted((r[2], r[3]) for r in got) == sorted((r[2], r[3]) for r in expected([(r.doc_id, r.text) for r in odd.collect()]))
    assert token_files.coded(empty, BYTE).collect() == []
