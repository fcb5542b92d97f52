"""Packing of documents into sequences by hierarchical best fit.

A document's ids are cut into pieces of at most the sequence length. Every
partition packs its own pieces best-fit, longest first, and sequences that are
full but for a small slack leave at once. The rest go up a tree: groups of
partitions merge, and each underfull sequence is there one item with all its
pieces, to be packed best-fit again. Groups merge as long as they hold no
more than ``GROUP_ITEMS`` items, beyond which more company no longer helps.

A piece's row carries all that is needed, so equal rows and equal or null keys
need no special care. An empty text is a piece with the end id alone.
"""

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import kept, slices
from corpusloom.llm.token_files import crc32
from corpusloom.llm.word_encoder import encoder

SEQUENCE = 2048
SLACK = 4
FAN_IN = 8
GROUP_ITEMS = 50_000

PIECE = "doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint"
MEMBERS = f"array<struct<{PIECE}>>"
KIND = pa.list_(
    pa.struct(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )
)


def best_fit(lengths: list[int], room: int = SEQUENCE) -> list[list[int]]:
    """Positions of the items of each bin: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(room + 1)]  # bins by the room they have left
    left: list[int] = []  # the rooms for which there are bins, in order
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        at = bisect.bisect_left(left, need)
        if at < len(left):
            space = left[at]
            which = free[space].pop()
            if not free[space]:
                del left[at]
            bins[which].append(i)
        else:
            space, which = room, len(bins)
            bins.append([i])
        space -= need
        if space:
            if not free[space]:
                bisect.insort(left, space)
            free[space].append(which)
    return bins


def _packed(members: list[list[dict]], room: int) -> list[list[dict]]:
    lengths = [sum(m["length"] for m in item) for item in members]
    return [[m for i in chosen for m in members[i]] for chosen in best_fit(lengths, room)]


def _batch(bins: list[list[dict]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([sum(m["length"] for m in b) for b in bins], pa.int64()), pa.array(bins, KIND)], ["fill", "members"]
    )


def local_sequences(docs: DataFrame, vocabulary: str, keeps_spaces: bool, end_id: int, room: int) -> DataFrame:
    """(fill, members): each task's pieces packed among themselves; whole pieces of full length alone."""

    def run(batches):
        words = encoder(vocabulary, keeps_spaces)
        waiting: list[list[dict]] = []
        for batch in slices(batches):
            ids, counts = words.encode(batch.column("text"))
            ends = np.cumsum(counts)
            full = []
            for key, count, stop in zip(batch.column("doc_id").to_pylist(), counts.tolist(), ends.tolist()):
                own = np.append(ids[stop - count : stop], words.kind.type(end_id))
                for piece, start in enumerate(range(0, count + 1, room)):
                    part = own[start : start + room]
                    row = {"doc_id": key, "piece": piece, "start": start, "length": len(part), "ids_crc32": crc32(part)}
                    (full if len(part) == room else waiting).append([row])
            if full:
                yield _batch(full)
            if len(waiting) >= GROUP_ITEMS:
                yield _batch(_packed(waiting, room))
                waiting = []
        if waiting:
            yield _batch(_packed(waiting, room))

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, f"fill long, members {MEMBERS}")


def merged_sequences(bins: DataFrame, room: int) -> DataFrame:
    """Each partition's underfull bins packed again, as items."""

    def run(batches):
        waiting: list[list[dict]] = []
        for batch in batches:
            waiting += batch.column("members").to_pylist()
            if len(waiting) >= 2 * GROUP_ITEMS:
                yield _batch(_packed(waiting, room))
                waiting = []
        if waiting:
            yield _batch(_packed(waiting, room))

    return bins.mapInArrow(run, f"fill long, members {MEMBERS}")


def packed(
    docs: DataFrame, vocabulary: str, keeps_spaces: bool = False, end_id: int = 0, room: int = SEQUENCE
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    tier = kept(local_sequences(docs, vocabulary, keeps_spaces, end_id, room), "sequences")
    done = [tier.filter(F.col("fill") >= room - SLACK)]
    groups = max(1, tier.rdd.getNumPartitions())
    while True:
        open_bins = tier.filter(F.col("fill") < room - SLACK)
        count = open_bins.count()
        least = -(-count // GROUP_ITEMS)
        groups = max(least, groups // FAN_IN, 1)
        tier = kept(merged_sequences(open_bins.repartition(groups, F.hash("members")), room), "sequences")
        if groups == max(least, 1):
            done.append(tier)
            break
        done.append(tier.filter(F.col("fill") >= room - SLACK))
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    # the id of a sequence: its first piece, which is in no other sequence
    numbered = every.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    return numbered.select("sequence_id", _placed("members")).select("sequence_id", F.inline("members")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def _placed(members: str):
    """The members with their offsets: the lengths before them, in order."""
    empty = F.array().cast(f"array<struct<{PIECE}, offset: bigint>>")
    begin = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("rows"))

    def add(state, m):
        row = F.struct(*(m[c].alias(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), state["at"].alias("offset"))
        return F.struct((state["at"] + m["length"]).alias("at"), F.concat(state["rows"], F.array(row)).alias("rows"))

    return F.aggregate(members, begin, add, lambda s: s["rows"]).alias("members")
