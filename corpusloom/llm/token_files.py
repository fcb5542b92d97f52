"""Token ids of documents in Huffman-coded block files.

``write`` stores documents in ascending order of their key as independent
blocks. Each block is one binary value in a Parquet file of the shared folder:

    header   8 x uint64: magic, documents, tokens, checkpoints, payload bytes,
             first token within the bucket, tokens between checkpoints, spare
    keys     int64 per document, then uint8 per document (1: the key is null)
    counts   uint64 per document, number of tokens
    offsets  uint64 per checkpoint, bit offset of every 512th token of a document
    payload  the documents' codes, each document from a byte of its own

Codes are canonical, of at most 16 bits, and built from the counts of all ids
of the corpus; ``codes`` beside the blocks holds one length per id. A block
needs that table and nothing else, so blocks are decoded in any order and a
lost task repeats only its own. Empty documents are kept with 0 tokens. Rows
with equal keys stay separate rows, ordered by content; null keys come first.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.common import kept, slices
from corpusloom.llm.word_encoder import encoder
from corpusloom.session import scratch_path

MAGIC = 0x314B4C4248554646
LONGEST_CODE = 16
CHECKPOINT = 512
BLOCK_TOKENS = 262_144
BUCKET_TOKENS = 1_000_000
MOST_BUCKETS = 10_000
#: Bytes of text, and of ids, that are worked on at once; a longer text comes alone.
TEXT_BYTES = 12_000_000
ID_BYTES = 2_000_000


def tokenized(docs: DataFrame, vocabulary: str, keeps_spaces: bool = True, end_id: int = 0) -> DataFrame:
    """(doc_id, n_tokens, ids): packed ids of each whole text and the end id.

    Ids are little-endian, two bytes each where the vocabulary allows, else four.
    """

    def run(batches):
        words = encoder(vocabulary, keeps_spaces)
        size, end = words.kind.itemsize, np.array([end_id], dtype=words.kind).tobytes()
        for batch in slices(batches, limit=TEXT_BYTES):
            ids, counts = words.encode(batch.column("text"))
            ends = np.cumsum(counts) * size
            data = ids.tobytes()
            packed = [data[a:b] + end for a, b in zip((ends - counts * size).tolist(), ends.tolist())]
            columns = [batch.column("doc_id"), pa.array(counts + 1, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def id_counts(tokens: DataFrame, size: int) -> dict[int, int]:
    """How often each id occurs; at most one row per id of the vocabulary reaches the driver."""

    def run(batches):
        counts = np.zeros(0, dtype=np.int64)
        for batch in slices(batches, "ids", ID_BYTES):
            more = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=f"<u{size}"), minlength=len(counts))
            more[: len(counts)] += counts
            counts = more
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["id", "n"])

    grouped = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {row.id: row.n for row in grouped.collect()}


def code_lengths(counts: dict[int, int], longest: int = LONGEST_CODE) -> np.ndarray:
    """Length of each id's code, 0 for ids that never occur, by package-merge.

    The lengths are the best that no code over ``longest`` bits allows. A lone
    id gets one bit.
    """
    ids = np.array(sorted(counts), dtype=np.int64)
    lengths = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=np.uint8)
    if len(ids) == 0:
        return lengths
    if len(ids) == 1:
        lengths[ids] = 1
        return lengths
    if len(ids) > 1 << longest:
        raise ValueError(f"{len(ids)} ids do not fit in codes of {longest} bits")
    weights = np.array([counts[i] for i in ids.tolist()], dtype=np.float64)
    order = np.argsort(weights, kind="stable")
    leaves = weights[order]
    levels, level = [], leaves
    for _ in range(longest):
        levels.append(level)
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        level = np.sort(np.concatenate([leaves, pairs]), kind="stable")
    take = 2 * len(ids) - 2
    depth = np.zeros(len(ids), dtype=np.uint8)
    for k in range(longest - 1, -1, -1):
        # of the first `take` entries of a level, ties put leaves before packages
        if k == 0:
            from_leaves = min(take, len(ids))
        else:
            below = levels[k - 1]
            packages = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
            kinds = np.argsort(np.concatenate([leaves, packages]), kind="stable")[:take]
            from_leaves = int((kinds < len(ids)).sum())
        depth[:from_leaves] += 1
        take = 2 * (take - from_leaves)
    lengths[ids[order]] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length and then id."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    steps = np.uint64(1) << (np.uint64(LONGEST_CODE) - lengths[order].astype(np.uint64))
    firsts = np.cumsum(steps) - steps
    codes[order] = (firsts >> (np.uint64(LONGEST_CODE) - lengths[order].astype(np.uint64))).astype(np.uint32)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) of the code that begins each 16-bit pattern."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (LONGEST_CODE - lengths[order].astype(np.int64))
    ids = np.zeros(1 << LONGEST_CODE, dtype=np.uint32)
    sizes = np.zeros(1 << LONGEST_CODE, dtype=np.uint8)
    covered = int(spans.sum())
    ids[:covered] = np.repeat(order, spans)
    sizes[:covered] = np.repeat(lengths[order], spans)
    return ids, sizes


def encode_documents(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    """(payload, bytes of each document, bit offset in its document of every checkpoint)."""
    bits = lengths[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(bits)])
    stops = np.cumsum(counts)
    firsts = stops - counts
    sizes = (ends[stops] - ends[firsts] + 7) // 8
    starts = np.cumsum(sizes) - sizes
    at = ends[:-1] + np.repeat(starts * 8 - ends[firsts], counts)
    total = int(sizes.sum())
    # a code of up to 16 bits touches up to three bytes; shifted into 24 bits, every byte is a plain sum
    shifted = codes[ids].astype(np.uint32) << (24 - bits - (at & 7)).astype(np.uint32)
    byte = at >> 3
    payload = np.zeros(total + 3, dtype=np.float64)
    for k in range(3):
        payload += np.bincount(byte + k, weights=(shifted >> np.uint32(16 - 8 * k)) & np.uint32(255), minlength=total + 3)
    marks = (counts + CHECKPOINT - 1) // CHECKPOINT
    nth = np.arange(int(marks.sum())) - np.repeat(np.cumsum(marks) - marks, marks)
    offsets = at[np.repeat(firsts, marks) + nth * CHECKPOINT] - np.repeat(starts * 8, marks)
    return payload[:total].astype(np.uint8).tobytes(), sizes, offsets, marks


def block(keys, nulls, counts, sizes, marks, offsets, payload: bytes, first: int) -> bytes:
    """One block, as the module describes it; offsets count from each document's first byte."""
    starts = np.cumsum(sizes) - sizes
    header = np.array(
        [MAGIC, len(keys), counts.sum(), len(offsets), len(payload), first, CHECKPOINT, 0], dtype="<u8"
    )
    places = offsets + np.repeat(starts * 8, marks)
    parts = [header, keys.astype("<i8"), nulls.astype("u1"), counts.astype("<u8"), places.astype("<u8")]
    return b"".join(p.tobytes() for p in parts) + payload


def read_block(data: bytes, table: tuple[np.ndarray, np.ndarray]):
    """(keys, nulls, counts, first, ids): all checkpoints of a block are decoded side by side."""
    magic, n, tokens, n_marks, n_payload, first, step, _ = (int(x) for x in np.frombuffer(data, "<u8", 8))
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = 64
    keys = np.frombuffer(data, "<i8", n, at)
    nulls = np.frombuffer(data, "u1", n, at + 8 * n).astype(bool)
    counts = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
    marks = np.frombuffer(data, "<u8", n_marks, at + 17 * n).astype(np.int64)
    payload = np.frombuffer(data, "u1", n_payload, at + 17 * n + 8 * n_marks).astype(np.uint32)
    payload = np.concatenate([payload, np.zeros(3, dtype=np.uint32)])
    words = (payload[:-2] << np.uint32(16)) | (payload[1:-1] << np.uint32(8)) | payload[2:]
    lanes = (counts + step - 1) // step
    nth = np.arange(n_marks) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    left = np.minimum(np.repeat(counts, lanes) - nth * step, step)
    out_at = np.repeat(np.cumsum(counts) - counts, lanes) + nth * step
    order = np.argsort(-left, kind="stable")
    left, place, bit = left[order], out_at[order], marks[order]
    ids = np.zeros(tokens, dtype=np.uint32)
    symbols, sizes = table
    sizes = sizes.astype(np.int64)
    alive = np.searchsorted(-left, -np.arange(step), side="left")  # lanes with more than k tokens
    for k in range(int(left[0]) if len(left) else 0):
        m = int(alive[k])
        now = bit[:m]
        pattern = (words[now >> 3] >> (8 - (now & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        ids[place[:m] + k] = symbols[pattern]
        bit[:m] = now + sizes[pattern]
    return keys, nulls, counts, first, ids


def write(docs: DataFrame, path: str, vocabulary: str, keeps_spaces: bool = True, end_id: int = 0) -> None:
    """Write ids of whole texts (null: empty) to ``path``, with an end id after each document.

    Ranges of keys with about a million tokens each are one bucket, ordered by
    ``doc_id`` from bucket to bucket. Only codes, not texts or ids, are shuffled.
    """
    spark = docs.sparkSession
    tokens = kept(tokenized(docs, vocabulary, keeps_spaces, end_id), "ids")
    size = encoder(vocabulary, keeps_spaces).kind.itemsize
    lengths = code_lengths(id_counts(tokens, size))
    codes = canonical_codes(lengths)
    total = tokens.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = int(min(MOST_BUCKETS, max(1, total // BUCKET_TOKENS)))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = np.array(sorted(set(tokens.approxQuantile("doc_id", shares, 0.1 / buckets))), dtype=np.float64) if shares else np.zeros(0)
    shared = spark.sparkContext.broadcast((lengths, codes, bounds))

    def coded(batches):
        lengths, codes, bounds = shared.value
        for batch in slices(batches, "ids", ID_BYTES):
            packed = batch.column("ids").to_pylist()
            counts = np.array([len(p) for p in packed], dtype=np.int64) // size
            ids = np.frombuffer(b"".join(packed), dtype=f"<u{size}")
            payload, sizes, offsets, marks = encode_documents(ids, counts, lengths, codes)
            ends, mark_ends = np.cumsum(sizes), np.cumsum(marks)
            keys = batch.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(bounds, keys.astype(np.float64), side="right")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket, pa.int32()),
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array([payload[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist())], pa.binary()),
                    pa.array(
                        [offsets[e - m : e].astype("<u8").tobytes() for e, m in zip(mark_ends.tolist(), marks.tolist())],
                        pa.binary(),
                    ),
                ],
                ["bucket", "doc_id", "n_tokens", "code", "marks"],
            )

    def blocks(batches):
        bucket, rows, waiting, first, number = None, [], 0, 0, 0

        def finished():
            keys, counts, code, marks = zip(*rows)
            data = block(
                np.array([0 if k is None else k for k in keys], dtype=np.int64),
                np.array([k is None for k in keys]),
                np.array(counts, dtype=np.int64),
                np.array([len(c) for c in code], dtype=np.int64),
                np.array([len(m) // 8 for m in marks], dtype=np.int64),
                np.frombuffer(b"".join(marks), dtype="<u8").astype(np.int64),
                b"".join(code),
                first,
            )
            columns = [pa.array([bucket], pa.int32()), pa.array([number], pa.int32()), pa.array([waiting], pa.int64()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "block", "n_tokens", "data"])

        for batch in batches:
            for b, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "n_tokens", "code", "marks"))):
                if rows and (b != bucket or waiting >= BLOCK_TOKENS):
                    yield finished()
                    first, number, rows, waiting = first + waiting, number + 1, [], 0
                if b != bucket:
                    bucket, first, number = b, 0, 0
                rows.append(row)
                waiting += row[1]
        if rows:
            yield finished()

    schema = "bucket int, doc_id long, n_tokens long, code binary, marks binary"
    ordered = (
        tokens.mapInArrow(coded, schema)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "n_tokens", "code")
    )
    made = ordered.mapInArrow(blocks, "bucket int, block int, n_tokens long, data binary")
    made.write.option("compression", "none").parquet(f"{path}/blocks")
    table = spark.createDataFrame([(lengths.tobytes(),)], "lengths binary")
    table.coalesce(1).write.parquet(f"{path}/codes")
    shared.unpersist()


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, ids decoded block by block.

    ``start`` is the number of ids of all documents before it. Per bucket, of
    which there are at most 10,000, one sum goes through the driver.
    """
    made = spark.read.parquet(f"{path}/blocks")
    sums = {r.bucket: r.n for r in made.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()}
    starts, before = {}, 0
    for bucket in sorted(sums):
        starts[bucket] = before
        before += sums[bucket]
    lengths = np.frombuffer(spark.read.parquet(f"{path}/codes").first()[0], dtype=np.uint8)
    shared = spark.sparkContext.broadcast((starts, decoding_table(lengths)))

    def run(batches):
        starts, table = shared.value
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
                keys, nulls, counts, first, ids = read_block(data.as_buffer(), table)
                ends = np.cumsum(counts)
                begins = ends - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64(), mask=nulls),
                        pa.array(begins + first + starts[bucket], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return made.select("bucket", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def coded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``write`` to a new folder of the shared folder, then ``read``."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, vocabulary)
    return read(docs.sparkSession, path)
