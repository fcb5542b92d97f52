"""Packing: pieces exact, places gapless, sequences near the least possible."""

import zlib
from itertools import groupby

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import packing
from corpusloom.llm.queries import QUERIES
from corpusloom.llm.word_encoder import tokenizer_path

SMALL = "/root/testdata/sf0.001"

WORD = tokenizer_path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit(lengths):
    bins = packing.best_fit(lengths, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    fills = [sum(lengths[i] for i in b) for b in bins]
    assert all(f <= 20 for f in fills)
    assert sum(f <= 10 for f in fills) <= 1


def pieces(rows):
    tokenizer = Tokenizer.from_file(WORD)
    out = []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            out.append((key, at // 2048, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check_places(rows):
    for _, own in groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_query(spark):
    rows = QUERIES["op6_packing"](spark, SMALL).collect()
    want = pieces(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    check_places(rows)
    least = -(-sum(r.length for r in rows) // 2048)
    assert len({r.sequence_id for r in rows}) <= least * 1.02 + 1


def test_odd_rows(odd, empty):
    rows = packing.packed(odd, WORD).collect()
    want = pieces((r.doc_id, r.text) for r in odd.collect())
    assert sorted(map(repr, (tuple(r)[:5] for r in rows))) == sorted(map(repr, want))
    check_places(rows)
    assert packing.packed(empty, WORD).collect() == []
