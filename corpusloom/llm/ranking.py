"""Ranked lexical search by presence masks.

Every item of a stated query set is ranked over all documents. Terms are runs
of ASCII letters, digits and all other code points above U+007F, A-Z in lower
case. A document's score for an item is the sum over the item's terms, repeats
included, of ``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` with ``w`` from the
number of documents that hold the term and ``m`` from the document's length
against the average, all in 64-bit integers.

One pass over the texts keeps, for each document, its number of terms and the
items' terms in it with their frequencies; nothing else of a text is stored.
Document frequencies are partial sums. Then each task goes through its share of
these rows in blocks. In a block every term has a bitmap of the documents that
hold it. For an item the bitmaps of its terms, side by side, give each document
a mask of matched terms, and documents of one mask are a group. The most that
any document of a group can score is the sum of the greatest value of each of
its terms in the block; groups are scored in falling order of this and the rest
left out as soon as the task has ``TOP`` documents of more than the next
group can reach. So no candidate is lost and ties are whole. Each task gives at most
``TOP`` rows an item; these meet in salted parts and then per item.

The items come to the driver in parts of at most about ``PART_BYTES`` of text, one
pass over the documents for each part.

A null text has no terms. Documents of a null key rank like others and come
last among equal scores; equal rows are ranked each by itself. An item without
terms has no rows; each row of items is an item of its own, also where ids are
equal or null. Empty tables give an empty result. Other columns are not read.
"""

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.llm.common import kept, slices

TOP = 20
PART_BYTES = 1_000_000
BLOCK, LEAST_BLOCK = 4_096, 64
BLOCK_CELLS = 16_000_000  # documents of a block times terms
GROUPS = 256
SALTS = 32
NO_KEY = (1 << 63) - 1

#: Letters of terms: everything but ASCII marks, A-Z in lower case; the rest becomes a blank.
TERM_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def separated(texts: pa.Array) -> pa.LargeStringArray:
    """The texts with blanks for all but letters of terms; null is the empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = bytes(memoryview(data)[offsets[0] : offsets[-1]]) if data is not None else b""
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(body.translate(TERM_LETTERS)))


def terms_of(text: str | None) -> list[str]:
    return separated(pa.array([text], pa.string()))[0].as_py().split(" ") if text else []


def counted(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of terms of each text; text, term, frequency of every term of the vocabulary in a text)."""
    lists = pc.split_pattern(separated(texts), " ")
    ends = np.asarray(lists.offsets)
    words = lists.values.slice(ends[0], ends[-1] - ends[0])
    ends = ends - ends[0]
    full = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(words)) > 0)])
    number = np.diff(full[ends])
    found = pc.index_in(words, value_set=vocabulary)
    at = np.flatnonzero(np.asarray(found.is_valid()))
    term = np.asarray(found.take(pa.array(at)), dtype=np.int64)
    key, tf = np.unique((np.searchsorted(ends, at, "right") - 1) * len(vocabulary) + term, return_counts=True)
    return number, key // max(1, len(vocabulary)), key % max(1, len(vocabulary)), tf


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: packed numbers of the vocabulary's terms in it, and their frequencies."""

    def run(batches):
        known = pa.array(vocabulary, pa.large_string())
        for batch in slices(batches):
            number, owner, term, tf = counted(batch.column("text"), known)
            cuts = np.searchsorted(owner, np.arange(len(number) + 1)) * 4
            packed = [
                pa.array([data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())
                for data in (term.astype("<u4").tobytes(), tf.astype("<u4").tobytes())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(number, pa.int64()), *packed], ["doc_id", "n", "terms", "tfs"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n long, terms binary, tfs binary")


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term; one row a term reaches the driver."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            packed = b"".join(p for p in batch.column(0).to_pylist() if p)
            total += np.bincount(np.frombuffer(packed, "<u4"), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    for row in rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row.term] = row.df
    return out


@dataclass
class Item:
    """An item's distinct terms, by number, and each one's weight times its repeats."""

    terms: np.ndarray
    weights: np.ndarray


def values(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1_000 * tf + 12 * m)


class Block:
    """Some documents' frequencies of the terms, a row for each term, and bitmaps of the documents that hold it."""

    def __init__(self, keys: np.ndarray, m: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, size: int):
        self.keys, self.m = keys, m
        self.row = np.full(size, -1)
        held = np.unique(term)
        self.row[held] = np.arange(len(held))
        self.tf = np.zeros((len(held), len(keys)), dtype=np.uint32)
        self.tf[self.row[term], owner] = tf
        self.bitmaps = np.packbits(self.tf > 0, axis=1)
        best = np.zeros(len(held), dtype=np.int64)
        np.maximum.at(best, self.row[term], values(tf.astype(np.int64), m[owner]))
        self.best = best

    def top(self, item: Item, heap: list[tuple[int, int]]) -> None:
        """Put the item's best documents of this block into its heap of (score, -key)."""
        rows = self.row[item.terms]
        rows, weights = rows[rows >= 0], item.weights[rows >= 0]
        if not len(rows):
            return
        present = np.unpackbits(self.bitmaps[rows], axis=1, count=len(self.keys))
        masks = np.ascontiguousarray(np.packbits(present, axis=0).T)  # a document's mask of matched terms
        names, group = np.unique(masks.view(np.dtype((np.void, masks.shape[1]))).ravel(), return_inverse=True)
        matched = np.unpackbits(names.view(np.uint8).reshape(len(names), -1), axis=1, count=len(rows))
        most = matched @ (weights * self.best[rows])
        order = np.argsort(-most, kind="stable")
        members = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(names)))
        for low in range(0, len(order), GROUPS):
            part = order[low : low + GROUPS]
            part = part[most[part] > 0]
            if len(heap) == TOP:
                part = part[most[part] >= heap[0][0]]  # a group that only equals the last may win by its keys
            if not len(part):
                return
            own = np.concatenate([members[ends[g - 1] if g else 0 : ends[g]] for g in part.tolist()])
            score = weights @ values(self.tf[np.ix_(rows, own)].astype(np.int64), self.m[own])
            best = np.lexsort((self.keys[own], -score))[:TOP]
            for s, key in zip(score[best].tolist(), self.keys[own[best]].tolist()):
                if s > 0 and (len(heap) < TOP or (s, -key) > heap[0]):
                    (heapq.heappush if len(heap) < TOP else heapq.heapreplace)(heap, (s, -key))


def best_of(batches, items: list[Item], size: int, documents: int, terms: int):
    """(item number, doc_id, score) of the best documents of one task, at most ``TOP`` an item."""
    heaps: list[list] = [[] for _ in items]
    step = max(LEAST_BLOCK, min(BLOCK, BLOCK_CELLS // max(1, size)))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            n = part.column("n").to_numpy(zero_copy_only=False)
            keys = part.column("doc_id").fill_null(NO_KEY).to_numpy(zero_copy_only=False)
            packed = part.column("terms").to_pylist()
            owner = np.repeat(np.arange(len(n)), [len(p) // 4 for p in packed])
            term = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
            tf = np.frombuffer(b"".join(part.column("tfs").to_pylist()), "<u4")
            block = Block(keys, 100 - 25 + (25 * n * documents) // max(1, terms), owner, term, tf, size)
            for item, heap in zip(items, heaps):
                block.top(item, heap)
    return [(number, None if key == -NO_KEY else -key, s) for number, heap in enumerate(heaps) for s, key in heap]


def _parts(items: DataFrame) -> list[pa.Table]:
    """The items in parts of bounded size, each in a fixed order."""
    chosen = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = chosen.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    number = max(1, -(-size // PART_BYTES))
    parts = (chosen.filter(F.pmod(F.hash("item_id", "text"), F.lit(number)) == part) for part in range(number))
    return [p.orderBy("item_id", "text").toArrow() for p in parts]


def ranked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``TOP`` documents of highest score above 0 of every item."""
    out = None
    spark = docs.sparkSession
    for part in _parts(items):
        texts = [[t for t in terms_of(text) if t] for text in part["text"].to_pylist()]
        vocabulary = sorted({t for own in texts for t in own})
        number = {t: i for i, t in enumerate(vocabulary)}
        rows = kept(postings(docs, vocabulary), "postings")
        documents, terms = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = document_frequencies(rows, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], dtype=np.int64)
        queries = []
        for own in texts:
            distinct, repeats = np.unique(np.array([number[t] for t in own], dtype=np.int64), return_counts=True)
            queries.append(Item(distinct, weight[distinct] * repeats))
        made = _best(rows, queries, len(vocabulary), documents, terms)
        ids = pa.table({"item": pa.array(range(part.num_rows), pa.int32()), "item_id": part["item_id"]})
        by_score = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        salted = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))).orderBy(*by_score)
        few = made.withColumn("place", F.row_number().over(salted)).filter(F.col("place") <= TOP)
        ranks = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by_score))).filter(F.col("rank") <= TOP)
        named = ranks.join(F.broadcast(spark.createDataFrame(ids)), "item").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionByName(named)
    return out


def _best(rows: DataFrame, queries: list[Item], size: int, documents: int, terms: int) -> DataFrame:
    """(item, doc_id, score): every task's best documents of each item."""

    def run(batches):
        found = best_of(batches, queries, size, documents, terms)
        columns = list(zip(*found)) or [()] * 3
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, "item int, doc_id long, score long")
