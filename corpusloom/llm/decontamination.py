"""Benchmark items inside documents, found by edit distance.

An item leaks into a text if some part of the text is within a fifth of the
item's length of it in edit distance, both in lower case with single blanks.

Candidates: in texts and items alike every word begins a window, the part of an
item from there to its end. A window is embedded by a CGK random walk: at every step the letter under the pointer is written down, and a random
bit of the step and the letter says whether the pointer moves on. Walks over
strings a few edits apart fall into step again soon after each edit, so their
outputs are near in Hamming distance. Each of ``TABLES`` tables has a walk of
its own and samples ``SAMPLES`` of its coordinates; windows that agree with an
item in all of them are candidates. The samples are taken in walking order and
a window is dropped at the first that no item continues, so few windows are
walked far. Items too short for all samples are met by those they have.

The search is to find 0.95 of the items at the full distance, a fifth of the
item; the tests measure it there. So every word begins a window and there are
``TABLES`` tables; with fewer of either, distant items are lost. A walk ends after
``STEPS`` steps: over a whole item a fifth apart no walk stays in step.
Every candidate is then compared exactly, by the bit-parallel edit distance of
the whole item to the best part of the text around the window; candidates of one
item whose surroundings overlap are compared at once. Before that
the distances of the item's pieces of up to ``PIECE`` letters are counted for many
candidates together: their sum is never over the item's own distance, so where it is
over the limit the item need not be compared.

Items are broadcast in parts of at most ``ITEM_BYTES``; more of them take more
passes. Items without words are never found; equal items are all reported. A
null text is the empty text; null keys are kept; equal rows are separate.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import mixed, slices, strings

SHARE = 0.2
STEPS = 40
SAMPLES = 18
TABLES = 6
SLICE = 2_000_000
LANES = 16_384
UNFILTERED = 3
ITEM_BYTES = 2_000_000  # some 100 MB of filters and keys
PIECE = 64  # letters, one for each bit of a number
PAIRS = 512
LONGEST_PART = 4096  # letters; longer parts are compared with the whole item at once
FILTER_SPREAD = 16  # bits of a filter for each window
MIX = np.uint64(0x9E3779B97F4A7C15)
ONES = np.uint64(1) << np.arange(PIECE, dtype=np.uint64)
BIT = np.uint8(1) << np.arange(8, dtype=np.uint8)
LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * MIX)


def plain(text: str | None) -> str:
    """Lower case, single blanks."""
    return " ".join((text or "").lower().split())


def distance_within(item: str, text: str) -> int:
    """Least edit distance between the item and any part of the text."""
    if item in text:
        return 0
    masks: dict[str, int] = {}
    for i, letter in enumerate(item):
        masks[letter] = masks.get(letter, 0) | 1 << i
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for letter in text:
        eq = masks.get(letter, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        up = mh | (full & ~(xv | ph))
        down = ph & xv
    return best


def _codes(text: str) -> np.ndarray:
    """Letters by 8 bits; some that differ are the same here."""
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return ((letters ^ letters >> 8) & 255).astype(np.uint8)


def least_distances(pairs: list[tuple[str, str]]) -> np.ndarray:
    """For pairs of an item and a text, shorter texts first: a number not over their least edit distance.

    The item is cut into pieces and each goes its own way through the text, all
    of them a letter at a time, with the columns of differences as bits.
    """
    pieces, owner = [], []
    for number, (item, _) in enumerate(pairs):
        parts = np.array_split(_codes(item), -(-len(item) // PIECE))
        pieces += parts
        owner += [number] * len(parts)
    if not pieces:
        return np.zeros(0, dtype=np.int64)
    owner, sizes = np.array(owner), np.array([len(p) for p in pieces])
    masks = np.zeros((len(pieces), 256), dtype=np.uint64)
    for lane, piece in enumerate(pieces):
        np.bitwise_or.at(masks[lane], piece, ONES[: len(piece)])
    masks, base = masks.ravel(), np.arange(len(pieces)) * 256
    lengths = np.array([len(text) for _, text in pairs])
    letters = np.zeros((lengths.max(initial=0), len(pairs)), dtype=np.uint8)
    for number, (_, text) in enumerate(pairs):
        letters[: len(text), number] = _codes(text)
    top, one = (sizes - 1).astype(np.uint64), np.uint64(1)
    score, best = sizes.copy(), sizes.copy()
    up, down = np.full(len(pieces), ~np.uint64(0)), np.zeros(len(pieces), dtype=np.uint64)
    begin = np.searchsorted(owner, np.searchsorted(lengths, np.arange(len(letters)), "right"))
    done = 0
    for row, first in zip(letters, begin.tolist()):
        if first > done:  # their texts are over
            up, down, score = up[first - done :], down[first - done :], score[first - done :]
            done = first
        eq = masks.take(base[first:] + row.take(owner[first:]))
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | ~(xh | up)
        mh = up & xh
        score = score + (ph >> top[first:] & one).view(np.int64) - (mh >> top[first:] & one).view(np.int64)
        np.minimum(best[first:], score, out=best[first:])
        ph, mh = ph << one, mh << one
        up, down = mh | ~(xv | ph), ph & xv
    return np.bincount(owner, weights=best, minlength=len(pairs)).astype(np.int64)


def allowed(item: str) -> int:
    return int(len(item) * SHARE)


@dataclass
class Table:
    """A walk's random bits, its sampled steps, and the items' sampled letters."""

    bits: np.ndarray  # of each step and letter
    steps: list[int]
    alive: list[np.ndarray]  # after each sample but the first ``UNFILTERED``: bits of keys that an item may have
    ended: list[np.ndarray]  # after each sample: keys of windows that have no more samples
    where: list[np.ndarray]  # the window of each of these keys


@dataclass
class Index:
    """Tables over the windows of all items."""

    ids: list
    items: list[str]
    item: np.ndarray  # of each window
    offset: np.ndarray  # bytes of the item before the window
    bits: int  # of a filter's addresses
    tables: list[Table]
    sizes: list[int]  # bytes of each item


def _starts(letters: np.ndarray) -> np.ndarray:
    """Places of the first letters of words; blanks and line feeds separate words, and so does every letter from U+3000 on."""
    gap = (letters == 32) | (letters == 10)
    first = ~gap
    first[1:] &= gap[:-1]
    return np.flatnonzero(first | (letters >= 0xE3))


def _step(key: np.ndarray, letter: np.ndarray) -> np.ndarray:
    return (key ^ LETTER.take(letter)) * MIX


def build(ids: list, texts: list[str | None]) -> Index:
    kept = [(i, plain(t)) for i, t in zip(ids, texts) if plain(t)]
    items = [t for _, t in kept]
    coded = [np.frombuffer((t + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8) for t in items]
    item, offset, parts, size, base = [], [], [], 0, []
    for number, data in enumerate(coded):
        chosen = _starts(data)
        chosen = chosen[chosen <= max(0, len(data) - 1 - STEPS // 2)]
        item += [number] * len(chosen)
        offset += chosen.tolist()
        base += (chosen + size).tolist()
        parts += [data[:-1], np.zeros(1, dtype=np.uint8)]
        size += len(data)
    letters = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint8)
    base = np.array(base, dtype=np.int64)
    bits_ = max(10, (FILTER_SPREAD * len(base)).bit_length())
    tables = []
    for number in range(TABLES):
        random = np.random.default_rng([number, 20])
        bits = random.integers(0, 2, size=(STEPS, 256), dtype=np.int64)
        bits[:, 0] = 0  # the end of an item
        steps = sorted(random.choice(STEPS, size=SAMPLES, replace=False).tolist())
        alive, ended, where = [], [], []
        place, key, own = base.copy(), np.zeros(len(base), dtype=np.uint64), np.arange(len(base))
        for step in range(steps[-1] + 1):
            letter = letters[place]
            if step in steps:
                over = letter == 0
                if step == steps[0]:
                    over[:] = False
                if over.any() and ended:
                    ended[-1], where[-1] = _sorted(np.append(ended[-1], key[over]), np.append(where[-1], own[over]))
                    place, key, own, letter = place[~over], key[~over], own[~over], letter[~over]
                key = _step(key, letter)
                if len(ended) >= UNFILTERED:
                    may = np.zeros(1 << bits_, dtype=np.uint8)
                    may[key >> np.uint64(64 - bits_)] = 1
                    alive.append(np.packbits(may, bitorder="little"))
                ended.append(np.zeros(0, dtype=np.uint64))
                where.append(np.zeros(0, dtype=np.int64))
            place = place + bits[step][letter]
        ended[-1], where[-1] = _sorted(key, own)
        tables.append(Table(bits, steps, alive, ended, where))
    sizes = [len(c) - 1 for c in coded]
    return Index([i for i, _ in kept], items, np.array(item, dtype=np.int64), np.array(offset, dtype=np.int64), bits_, tables, sizes)


def _sorted(key, own):
    order = np.argsort(key, kind="stable")
    return key[order], own[order]


def _hits(table: Table, filter_bits: int, letters: np.ndarray, starts: np.ndarray):
    """(place, window) of agreements between windows at ``starts`` and items' windows."""
    out = []
    shift = np.uint64(64 - filter_bits)
    for low in range(0, len(starts), LANES):
        begin = starts[low : low + LANES]
        place, key = begin.copy(), np.zeros(len(begin), dtype=np.uint64)
        sample = 0
        for step in range(table.steps[-1] + 1):
            if not len(place):
                break
            letter = letters.take(place, mode="clip")
            if step == table.steps[sample]:
                key = _step(key, letter)
                if sample >= UNFILTERED:  # nearly every window still goes on before that
                    address = (key >> shift).view(np.int64)
                    near = np.flatnonzero(table.alive[sample - UNFILTERED].take(address >> 3) & BIT.take(address & 7))
                    begin, place, key, letter = begin.take(near), place.take(near), key.take(near), letter.take(near)
                keys = table.ended[sample]
                if len(keys) and len(key):
                    left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                    many = right - left
                    if many.any():
                        at = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                        out.append((np.repeat(begin, many), table.where[sample][at]))
                sample += 1
            place += table.bits[step].take(letter, mode="clip")
    return out


def leaks(index: Index, texts: list[str | None]) -> list[dict[int, int]]:
    """For each text: the items in it, with their least edit distance."""
    found: list[dict[int, int]] = [{} for _ in texts]
    if not index.items or not texts:
        return found
    data = ("\n".join(plain(t) for t in texts) + "\n").encode("utf-8", "surrogatepass")
    letters = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(letters == 10)
    starts = _starts(letters)
    hits = [h for table in index.tables for h in _hits(table, index.bits, letters, starts)]
    if not hits:
        return found
    place, window = (np.concatenate(parts) for parts in zip(*hits))
    item = index.item[window]
    origin = place - index.offset[window]  # where the item would begin
    owner = np.searchsorted(ends, place)
    around: dict[tuple[int, int], list[list[int]]] = {}  # of a text and an item: parts of the text, apart from each other
    for own, number, begin in sorted(set(zip(owner.tolist(), item.tolist(), (origin // 16 * 16).tolist()))):
        limit = allowed(index.items[number])
        first, last = int(ends[own - 1]) + 1 if own else 0, int(ends[own])
        for most in (4, 1):  # bytes of a letter; one is enough where all letters around have one
            slack = (most + 1) * limit + 8
            low, high = max(first, begin - slack), min(last, begin + 16 + index.sizes[number] + slack)
            if not data[low:high].isascii():
                break
        parts = around.setdefault((own, number), [])
        while parts and low <= parts[-1][1]:
            before = parts.pop()
            low, high = min(low, before[0]), max(high, before[1])
        parts.append([low, high])
    near = [(own, number, data[low:high].decode("utf-8", "ignore")) for (own, number), parts in around.items() for low, high in parts]
    near.sort(key=lambda c: len(c[2]))
    for low in range(0, len(near), PAIRS):
        some = near[low : low + PAIRS]
        short = [c for c in some if len(c[2]) <= LONGEST_PART]
        least = least_distances([(index.items[number], part) for _, number, part in short]).tolist()
        for (own, number, part), bound in zip(some, least + [0] * (len(some) - len(short))):
            limit = allowed(index.items[number])
            if bound <= limit:
                distance = distance_within(index.items[number], part)
                if distance <= limit:
                    found[own][number] = min(distance, found[own].get(number, distance))
    return found


def _parts(items: DataFrame) -> list[Index]:
    """Indexes of the items, each of bounded size."""
    chosen = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = chosen.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    number = max(1, -(-size // ITEM_BYTES))
    out = []
    for part in range(number):
        rows = chosen.filter(F.pmod(F.hash("item_id", "text"), F.lit(number)) == part).toArrow().sort_by("item_id")
        out.append(build(rows["item_id"].to_pylist(), rows["text"].to_pylist()))
    return out


def leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance): every item found in every document, whole texts."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in _parts(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for batch in slices(batches, "text", SLICE):
                found = leaks(index, strings(batch.column("text")))
                rows = [(k, index.ids[i], d) for k, own in zip(batch.column("doc_id").to_pylist(), found) for i, d in own.items()]
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32()))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance"])

        made = chosen.mapInArrow(run, "doc_id long, item_id long, distance int")
        out = made if out is None else out.unionByName(made)
    return out


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, with all their columns, in which no item is found."""
    for index in _parts(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in slices(batches, "text", SLICE):
                found = leaks(shared.value, strings(batch.column("text")))
                yield batch.filter(pa.array([not own for own in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
