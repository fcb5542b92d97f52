"""Spelling variants: words one edit apart, found by dense tiles of code points.

Words are runs of Latin letters (``RUN``), A-Z in lower case, of at least
``SHORTEST`` code points and at least ``LEAST`` occurrences in all texts. As a
fixed part of the task some occurrences lose a letter first (``written``).

Two words are near if one code point inserted, deleted or replaced makes one
the other. With the longer one of M code points that holds exactly if their
common prefix and common suffix together reach M - 1. So a pair shares the
first half of M - 1 code points or the last, and a word is put into a bucket
for each, once with M its own length and once with M one more. A bucket of more
than ``TILE_STEPS`` comparisons of letters is split again by which half of the rest the common
prefix ends in, until it is small; where all of M - 1 are fixed it holds one
word for each letter at most. A common prefix ends in one place, so nothing is
found twice and no bucket is compared in more than a bounded tile.

Buckets of like size are stacked to padded matrices of code points, and all
rows of a bucket are compared with all others, letter by letter.

A null text is the empty one, a null key the empty one in ``written``. Equal
rows count as often as they occur. An empty table has no words. Ties of n go to
the word that is first in code-point order. Columns beside doc_id and text are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import kept

#: The letters of a run after lower-casing, shortest word, least occurrences.
RUN = "[a-zÀ-ÿ]{6,}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 6
LEAST = 5
DELETED = 199
FORM = 5

TILE_STEPS = 4_000_000
CHUNK_ROWS = 16_384
STACK_CELLS = 1_000_000
KEY = ["m", "pre", "lim", "share"]


def written(key: Column, run: Column) -> Column:
    """The run, or the run without one letter where ``DELETED`` divides crc32 of ``key:run``."""
    digest = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (digest % F.char_length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(digest % DELETED == 0, short).otherwise(run)


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) of all words; only partial counts are shuffled."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.col("doc_id").alias("key"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.select(written(F.col("key"), F.col("run")).alias("word")).filter(F.char_length("word") >= SHORTEST)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST)


def _halves(rows: DataFrame) -> DataFrame:
    """Every row in the two buckets into which its own is split: the edit is in the one part of [pre, lim) or the other."""
    middle = F.expr("(pre + lim) div 2").cast("int")
    sides = F.array(
        F.struct(middle.alias("pre"), F.col("lim").alias("lim")),
        F.struct(F.col("pre").alias("pre"), middle.alias("lim")),
    )
    split = rows.select("word", "n", "m", F.explode(sides).alias("side")).select("word", "n", "m", "side.*")
    suffix = F.col("m") - F.col("lim")
    return split.withColumn("share", F.xxhash64(F.left("word", "pre"), F.when(suffix > 0, F.right("word", suffix))))


def buckets(words: DataFrame) -> DataFrame:
    """(word, n, m, pre, lim, share): rows of buckets of bounded size that hold every near pair once.

    The longer word of a pair has ``m`` code points; its common prefix has from
    ``pre`` to below ``lim`` of them, so the last ``m - lim`` are shared as well.
    ``share`` is a hash of both.
    """
    sizes = F.explode(F.array(F.char_length("word"), F.char_length("word") + 1))
    root = words.select("word", "n", sizes.alias("m")).withColumns({"pre": F.lit(0), "lim": F.col("m")})
    small, rows = None, _halves(root)
    while True:
        several = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("together")).filter("together > 1")
        met = kept(rows.join(several, KEY), "buckets")
        large = f"together * together * m > {TILE_STEPS} AND pre + 1 < lim"
        done = met.filter(f"NOT ({large})").drop("together")
        small = done if small is None else small.unionByName(done)
        rows = met.filter(large).drop("together")
        if rows.isEmpty():
            return small.select("word", "n", *KEY)
        rows = _halves(rows)


def _letters(words: list[str]) -> np.ndarray:
    """Code points of the words, one row each, padded with 0."""
    wide = np.array(words)
    return wide.view(np.uint32).reshape(len(words), -1).astype(np.uint8)


def _common(letters: np.ndarray) -> np.ndarray:
    """(bucket, row, row): how many first letters two rows share."""
    number, size, width = letters.shape
    alike = np.ones((number, size, size), dtype=bool)
    length = np.zeros((number, size, size), dtype=np.int32)
    for k in range(width):
        own = letters[:, :, k]
        alike &= (own[:, :, None] == own[:, None, :]) & (own != 0)[:, :, None]
        if not alike.any():
            break
        length += alike
    return length


def near_rows(words: list[str], m: np.ndarray, pre: np.ndarray, lim: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, near row) of the pairs that count, both ways; a bucket begins at each of ``starts``."""
    sizes = np.diff(np.append(starts, len(words)))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    classes = np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
    first, second = [], []
    for kind in np.unique(classes):
        own = np.flatnonzero(classes == kind)
        side = int(sizes[own].max())
        own = own[np.argsort(m[starts[own]], kind="stable")]
        low = 0
        while low < len(own):
            widths = np.maximum.accumulate(m[starts[own[low:]]])
            cells = np.arange(1, len(widths) + 1) * side * np.maximum(side, widths)
            stack = own[low : low + max(1, int(np.searchsorted(cells, STACK_CELLS)))]
            low += len(stack)
            place = starts[stack][:, None] + np.arange(side)
            real = np.arange(side) < sizes[stack][:, None]
            flat = place[real]
            chosen = [words[i] for i in flat.tolist()]
            matrices = []
            for part in (chosen, [w[::-1] for w in chosen]):
                letters = _letters(part)
                padded = np.zeros((len(stack), side, letters.shape[1]), dtype=np.uint8)
                padded[real] = letters
                matrices.append(_common(padded))
            prefix, suffix = matrices
            size = np.zeros((len(stack), side), dtype=np.int64)
            size[real] = lengths[flat]
            at = starts[stack]
            longest, of_pre, of_lim = (x[at][:, None, None] for x in (m, pre, lim))
            near = (np.maximum(size[:, :, None], size[:, None, :]) == longest) & (prefix + suffix >= longest - 1)
            near &= (np.minimum(size[:, :, None], size[:, None, :]) > 0) & (prefix >= of_pre) & (prefix < of_lim)
            bucket, a, b = np.nonzero(near)
            first.append(place[bucket, a])
            second.append(place[bucket, b])
    nothing = np.zeros(0, dtype=np.int64)
    return np.concatenate([nothing, *first]), np.concatenate([nothing, *second])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole buckets of a partition that is ordered by bucket, with where each begins."""
    waiting: list[pa.RecordBatch] = []
    rest = 0

    def starts(table):
        key = np.stack([table[c].to_numpy() for c in KEY], axis=1)
        return np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1])

    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rest += batch.num_rows
        if rest >= CHUNK_ROWS:
            table = pa.Table.from_batches(waiting).combine_chunks()
            begins = starts(table)
            last = int(begins[-1])
            if last:
                yield table.slice(0, last), begins[:-1]
            waiting, rest = table.slice(last).to_batches(), table.num_rows - last
    if rest:
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield table, starts(table)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of every two near words of words(word, n), both ways, each once."""

    def run(batches):
        for table, starts in _chunks(batches):
            words = table["word"].to_pylist()
            first, second = near_rows(words, *(table[c].to_numpy().astype(np.int64) for c in ("m", "pre", "lim")), starts)
            a, b = table.take(pa.array(first)), table.take(pa.array(second))
            for batch in pa.table({"word": a["word"], "near": b["word"], "near_n": b["n"]}).to_batches():
                yield batch

    placed = buckets(words).repartition(*KEY).sortWithinPartitions(*KEY)
    return placed.mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for forms(word, form): the last word that forms lead to; each round goes twice as far.

    A form is at least ``FORM`` times as frequent as its word, so forms never
    lead back and a path is no longer than the logarithm of the greatest n.
    """
    ends = kept(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        after = kept(ends.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        ends = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return ends


def grouped(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of whole texts."""
    words = kept(counted(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= FORM * F.col("n")
    named = kept(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(named.filter("form IS NOT NULL"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
