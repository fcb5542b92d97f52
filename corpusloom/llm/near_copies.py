"""Near-copies by DartMinHash signatures, banded joining and exact verification.

A text is the multiset of its shingles: five consecutive words of the
lower-case text, joined by single blanks; a text with fewer words is one
shingle. Two different texts are linked if the weighted Jaccard likeness of
their multisets, or the plain one of their sets, is 0.8 or more. Linked texts
are one class, and so are texts linked through others; equal texts always are.

Signatures: hashed darts fall on the plane of weight and rank, evenly and the
same for all texts. An element's weight is cut into regions that double in
size; the darts of a region arrive in order of rank, so only as many are made
as the text needs, a few times the number of coordinates whatever its length.
Each dart names a coordinate, and a text keeps its earliest dart for each.
Two texts agree in a coordinate with probability equal to their likeness. A text
with repeated shingles has a second signature, of its set with all weights 1; of
other texts it is the same. Either may bring two texts together.

Joining: bands of ``ROWS`` coordinates are buckets. In each bucket every text
is compared with one other, its centre: the text that meets the most others in
all its buckets. Those that are not like it choose a new centre, until at most
``REST`` are left. This joins most of a group of any size at a comparison per
text; a bucket in which a centre is not like a quarter of the others has no such
group, and no further centre. Then texts of a bucket that are not in one class
yet, of whatever centre, meet in blocks of at most about ``BLOCK`` texts. Those
that agree in enough coordinates are compared there by their shingles in 32 bits,
which travel with them (texts of over ``BAG`` shingles pass by their coordinates
alone), and only pairs that are alike leave the block, to be checked whole: first
the pair of any two classes that agrees in the most, then every pair of classes
that are still apart. So many texts that are alike, but less than ``LIKENESS``,
make no rows for their pairs. ``BANDS`` bands
find two texts of likeness 0.8 with probability 0.999; a pair of such likeness
agrees in under ``AGREE`` of all coordinates once in 30,000.

Equal texts are one text until the end. A null text is the empty one, and all
empty texts are one class. Null keys are kept; a class is named by its least
key that is not null, and by the hash of a text.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import kept, mixed, slices, strings, text_key

SHINGLE = 5
LIKENESS = 0.8
BANDS, ROWS = 24, 6
COORDINATES = BANDS * ROWS
REST = 256
STILL_APART = 0.75
BLOCK = 512
AGREE = 0.66
BAG = 16_384
BAG_SLACK = 0.005
SLICE = 1_000_000
POWERS = 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)
UNIT = 1.0 / (1 << 53)
_POWERS = [np.ones(0, dtype=np.uint64)] * 2


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each; a worker keeps two rows of up to ``POWERS``."""
    if len(_POWERS[0]) >= size:
        return _POWERS
    out = []
    for base in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
        steps = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    if size <= POWERS:  # a longer text comes alone
        _POWERS[:] = out
    return out


LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of every distinct shingle, ordered by text and hash."""
    lines = "\n".join(" ".join(t.lower().split()) for t in texts) + "\n"
    letters = np.frombuffer(lines.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    up, down = _powers(len(letters))
    total = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(LETTER[letters] * up[: len(letters)], out=total[1:])
    ends = np.flatnonzero((letters == 32) | (letters == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    lasts = np.flatnonzero(letters[ends] == 10)  # the last word of each text
    firsts = np.concatenate([[0], lasts[:-1] + 1])
    number = np.maximum(lasts - firsts + 2 - SHINGLE, 1)
    owner = np.repeat(np.arange(len(texts)), number)
    begin = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + firsts[owner]
    stop = np.minimum(begin + SHINGLE - 1, lasts[owner])
    low, high = starts[begin], ends[stop]
    found = mixed((total[high] - total[low]) * down[low] + (high - low).astype(np.uint64))
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]))
    return owner[new], found[new], np.diff(np.append(new, len(found)))


def darts(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, limit: np.ndarray):
    """(owner, coordinate, rank, dart) of all darts under each owner's rank limit and each element's weight.

    Region 0 of an element is the weight up to 1, region v the weight from 2**(v-1) to 2**v.
    """
    regions = [(owner, element, weight, 0.0, 1.0)]
    low = 1.0
    while len(own := np.flatnonzero(weight > low)):
        regions.append((owner[own], mixed(element[own] + np.uint64(int(low))), weight[own], low, low))
        low *= 2
    out = []
    for own, seed, w, low, width in regions:
        rank = np.zeros(len(own))
        seed = mixed(seed ^ BASE)
        nth = 0
        while len(own):
            nth += 1
            dart = mixed(seed + np.uint64(nth * int(BASE) % (1 << 64)))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) * UNIT) / width
            near = rank <= limit[own]
            if not near.all():
                own, seed, w, rank, dart = own[near], seed[near], w[near], rank[near], dart[near]
            second = mixed(dart)
            if width > 1 or low:
                place = low + (second >> np.uint64(40)).astype(np.float64) * (width / (1 << 24))
                hit = place < w
                out.append((own[hit], (second[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(COORDINATES), rank[hit], second[hit]))
            else:
                out.append((own, (second & np.uint64(0xFFFFFFFF)) % np.uint64(COORDINATES), rank, second))
    return [np.concatenate(parts) for parts in zip(*out)]


def signatures(texts: list[str]) -> np.ndarray:
    """A row of ``COORDINATES`` dart numbers for each text."""
    return signature_pairs(texts)[0]


def signature_pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the texts' multisets and of their sets; without repeated shingles they are the same."""
    owner, element, count = shingles(texts)
    weighted = _earliest(owner, element, count.astype(np.float64), len(texts))
    repeats = np.unique(owner[count > 1])
    if not len(repeats):
        return weighted, weighted
    own = np.isin(owner, repeats)
    plain = weighted.copy()
    plain[repeats] = _earliest(np.searchsorted(repeats, owner[own]), element[own], np.ones(own.sum()), len(repeats))
    return weighted, plain


def _earliest(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, number: int) -> np.ndarray:
    """The earliest dart of each coordinate, a row for each owner."""
    total = np.bincount(owner, weights=weight, minlength=number)
    wanted = COORDINATES * np.log(COORDINATES) + 2 * COORDINATES
    limit = wanted / total
    out = np.zeros(number * COORDINATES, dtype=np.uint64)
    best = np.full(len(out), np.inf)
    open_ = np.arange(len(owner))
    while len(open_):
        own, coordinate, rank, dart = darts(owner[open_], element[open_], weight[open_], limit)
        key = own * COORDINATES + coordinate.astype(np.int64)
        np.minimum.at(best, key, rank)
        won = rank == best[key]
        out[key[won]] = dart[won]
        bare = np.isinf(best.reshape(-1, COORDINATES)).any(axis=1)  # a coordinate without a dart: more of them
        open_ = open_[bare[owner[open_]]]
        limit = limit * 2
    return out.reshape(-1, COORDINATES)


def bands(signature: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` bucket numbers for each signature."""
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * BASE, (len(signature), 1))
    for row in range(ROWS):
        out = mixed(out * BASE + signature[:, row::ROWS])
    return out


def likeness(a, b) -> float:
    """The larger of weighted and plain Jaccard likeness of two (hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    plain = len(i) / (len(a[0]) + len(b[0]) - len(i))
    least = np.minimum(a[1][i], b[1][j]).sum()
    return max(plain, least / (a[1].sum() + b[1].sum() - least))


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands, marks) of every row: a text's buckets, and a byte of each coordinate.

    Both are those of the multiset, followed by those of the set where it differs.
    """

    def run(batches):
        for batch in slices(batches, "text", SLICE):
            both = signature_pairs(strings(batch.column("text")))
            twice = (both[0] != both[1]).any(axis=1)
            packed = []
            for first, second in ([bands(s).astype("<u8") for s in both], [s.astype(np.uint8) for s in both]):
                rows = [a.tobytes() + (b.tobytes() if more else b"") for a, b, more in zip(first, second, twice)]
                packed.append(pa.array(rows, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *packed], ["doc_id", "key", "bands", "marks"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, key binary, bands binary, marks binary")


def bag(element: np.ndarray, count: np.ndarray) -> bytes | None:
    """A text's shingles in 32 bits each: size of the set, the set, then the rest of the multiset; None if too long."""
    if count.sum() > BAG:
        return None
    repeats = np.repeat(element, count - 1)
    nth = np.arange(len(repeats)) - np.repeat(np.cumsum(count - 1) - (count - 1), count - 1) + 1
    parts = [np.array([len(element)]), mixed(element) >> np.uint64(32), mixed(repeats + nth.astype(np.uint64) * BASE) >> np.uint64(32)]
    return np.concatenate(parts).astype("<u4").tobytes()


def _bags(texts: DataFrame) -> DataFrame:
    """(key, bag) of texts(key, text)."""

    def run(batches):
        for batch in slices(batches, "text", SLICE):
            own = strings(batch.column("text"))
            owner, element, count = shingles(own)
            cuts = np.searchsorted(owner, np.arange(len(own) + 1))
            made = [bag(element[a:b], count[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.binary())], ["key", "bag"])

    return texts.select("key", "text").mapInArrow(run, "key binary, bag binary")


class Bags:
    """The bags of a block, for the likeness of one text to many."""

    def __init__(self, bags: list[bytes | None]):
        known = [np.frombuffer(b, "<u4") if b else np.zeros(1, "<u4") for b in bags]
        self.short = np.array([b is not None for b in bags])
        self.plain = np.array([int(b[0]) for b in known])
        self.whole = np.array([len(b) - 1 for b in known])
        parts = [b[1:] for b in known]
        self.codes = np.unique(np.concatenate([np.zeros(0, "<u4"), *parts]), return_inverse=True)[1]
        self.ends = np.cumsum(self.whole)
        place = np.arange(len(self.codes)) - np.repeat(self.ends - self.whole, self.whole)
        self.is_plain = place < np.repeat(self.plain, self.whole)
        self.flag = np.zeros(int(self.codes.max()) + 1 if len(self.codes) else 1, dtype=np.int64)

    def likeness(self, i: int, others: np.ndarray) -> np.ndarray:
        """The larger of plain and weighted likeness; 1 where a bag is too long to tell."""
        low, high = self.ends[i] - self.whole[i], self.ends[i]
        at = np.repeat(self.ends[others] - self.whole[others] - np.cumsum(self.whole[others]) + self.whole[others], self.whole[others]) + np.arange(self.whole[others].sum())
        owner = np.repeat(np.arange(len(others)), self.whole[others])
        best = np.zeros(len(others))
        for only_plain, size in ((True, self.plain), (False, self.whole)):
            mine = self.codes[low:high][self.is_plain[low:high]] if only_plain else self.codes[low:high]
            self.flag[mine] = 1
            hit = self.flag[self.codes[at]] * self.is_plain[at] if only_plain else self.flag[self.codes[at]]
            common = np.bincount(owner, weights=hit, minlength=len(others))
            self.flag[mine] = 0
            best = np.maximum(best, common / np.maximum(1, size[i] + size[others] - common))
        return np.where(self.short[others] & self.short[i], best, 1.0)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, other, linked) of pairs of texts, compared whole."""

    def run(batches):
        known: dict[bytes, tuple] = {}

        def shingled(key, text):
            if key not in known:
                if len(known) > 16:
                    known.clear()
                known[key] = shingles([text])[1:]
            return known[key]

        for batch in slices(batches, "text", SLICE):
            columns = [batch.column(c) for c in ("key", "other", "text", "other_text")]
            rows = zip(*(c.to_pylist() for c in columns))
            linked = [likeness(shingles([t or ""])[1:], shingled(o, u or "")) >= LIKENESS for _, o, t, u in rows]
            yield pa.RecordBatch.from_arrays([*columns[:2], pa.array(linked)], ["key", "other", "linked"])

    both = pairs.join(texts, "key").join(
        texts.select(F.col("key").alias("other"), F.col("text").alias("other_text")), "other"
    )
    return both.select("key", "other", "text", "other_text").mapInArrow(run, "key binary, other binary, linked boolean")


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((key, first_id) of every distinct text, (key, label) of those that share a bucket)."""
    signed = kept(_signed(docs), "signatures")
    texts = kept(
        signed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.max("bands").alias("bands"), F.max("marks").alias("marks")), "distinct-texts"
    )
    places = F.expr("array_distinct(transform(sequence(0, length(bands) div 8 - 1), i -> substring(bands, i * 8 + 1, 8)))")
    spread = texts.select(F.explode(places).alias("bucket"), "key")
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = kept(spread.join(shared, "bucket"), "buckets")
    weights = met.groupBy("key").agg(F.sum("n").alias("weight"))
    members = kept(met.select("bucket", "key").join(weights, "key").select("bucket", "key", "weight"), "members")
    wanted = weights.select("key").join(texts.select("key", "first_id"), "key")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text"))
    # by key and id: the copies of one text are many, its rows with one id few
    same = rows.doc_id.eqNullSafe(wanted.first_id) & (rows.key == wanted.key)
    found = rows.join(wanted, same, "left_semi")
    bodies = kept(found.dropDuplicates(["doc_id", "key"]).select("key", "text"), "texts-to-compare")
    every, checks = members.select("bucket", "key"), []

    def compared(pairs):
        checked = kept(_verified(pairs, bodies), "compared")
        checks.append(checked)
        return checked

    while True:
        centre = F.max(F.struct("weight", F.xxhash64("key").alias("h"), "key"))
        met = members.join(members.groupBy("bucket").agg(centre["key"].alias("other")), "bucket").filter("key != other")
        met = kept(met, "met")
        checked = compared(met.select("key", "other").distinct())
        left = met.join(checked, ["key", "other"]).select("bucket", "key", "weight", "linked")
        apart = F.count(F.when(~F.col("linked"), 1))
        sizes = left.groupBy("bucket").agg(apart.alias("n"), F.count("*").alias("before"))
        again = sizes.filter(f"n > {REST} AND n <= before * {STILL_APART}").select("bucket")
        members = kept(left.filter("NOT linked").join(again, "bucket").select("bucket", "key", "weight"), "left")
        if members.isEmpty():
            break
    own = classes(_union(checks).filter("linked"))
    labels = kept(wanted.select("key").join(own, "key", "left").select("key", F.coalesce("label", "key").alias("label")), "labels")
    marks = kept(texts.select("key", "marks").join(_bags(bodies), "key"), "marks")
    for best in (True, False):
        pairs = _apart(every, labels, marks, best)
        done = _union(checks).select(F.least("key", "other").alias("key"), F.greatest("key", "other").alias("other"))
        checked = compared(pairs.join(done, ["key", "other"], "left_anti"))
        named = checked.filter("linked").join(labels, "key").select("other", F.col("label").alias("near"))
        named = named.join(labels.withColumnRenamed("key", "other"), "other").select(F.col("near").alias("key"), F.col("label").alias("other"))
        joined = classes(named).select(F.col("key").alias("label"), F.col("label").alias("first"))
        labels = kept(labels.join(joined, "label", "left").select("key", F.coalesce("first", "label").alias("label")), "labels")
    return texts.select("key", "first_id"), labels


def _union(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def _apart(members: DataFrame, labels: DataFrame, marks: DataFrame, best: bool) -> DataFrame:
    """(key, other), key first, of texts in one bucket and of different labels that agree in enough coordinates.

    With ``best``, only the pair of any two labels that agrees in the most. A
    bucket's most frequent label is dealt into blocks, and so are the other
    texts, by their hash; blocks of the others meet each other and those of the label.
    """
    named = kept(members.join(labels, "key"), "named")
    counts = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "label"))
    mixed_ = counts.groupBy("bucket").agg(most["label"].alias("common"), most["n"].alias("hot"), (F.sum("n") - most["n"]).alias("cold"))
    rows = named.join(mixed_.filter("cold > 0"), "bucket")
    rows = rows.withColumn("hots", F.ceil(F.col("hot") / BLOCK)).withColumn("colds", F.ceil(F.col("cold") / BLOCK))
    part = "if(label = common, -1 - pmod(xxhash64(key), hots), pmod(xxhash64(key), colds))"
    rows = rows.withColumn("part", F.expr(part)).join(marks, "key")
    others = "transform(sequence(0, colds - 1), i -> struct(least(i, part) AS low, greatest(i, part) AS high))"
    common = "transform(sequence(0, hots - 1), p -> struct(-1 - p AS low, part AS high))"
    meet = F.expr(f"if(part < 0, {others}, concat({others}, {common}))")
    dealt = rows.select("bucket", "key", "label", "marks", "bag", "part", F.explode(meet).alias("meet"))
    dealt = dealt.select("bucket", "key", "label", "marks", "bag", "part", "meet.low", "meet.high")

    def run(table: pa.Table) -> pa.Table:
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        part = table["part"].to_numpy()
        key, label = (np.array(table[c].to_pylist(), dtype=object) for c in ("key", "label"))
        marks = table["marks"].to_pylist()
        weighted, plain = (
            np.frombuffer(b"".join(own), dtype=np.uint8).reshape(len(key), COORDINATES)
            for own in ([m[:COORDINATES] for m in marks], [m[-COORDINATES:] for m in marks])
        )
        twice = any(len(m) > COORDINATES for m in marks)
        number = np.unique(label, return_inverse=True)[1]
        bags = None
        right = np.flatnonzero(part == high)
        found: dict[tuple, tuple] = {}
        for i in np.flatnonzero(part == low).tolist():
            agree = (weighted[right] == weighted[i]).sum(axis=1)
            if twice:
                agree = np.maximum(agree, (plain[right] == plain[i]).sum(axis=1))
            close = np.flatnonzero((agree >= AGREE * COORDINATES) & (number[right] != number[i]))
            if not len(close):
                continue
            bags = bags or Bags(table["bag"].to_pylist())
            close = close[bags.likeness(i, right[close]) >= LIKENESS - BAG_SLACK]
            for at in close.tolist():
                j = int(right[at])
                pair = (int(agree[at]), *sorted((key[i], key[j])), *sorted((label[i], label[j])))
                name = pair[3:] if best else pair[1:3]
                found[name] = max(found.get(name, pair), pair)
        columns = list(zip(*found.values())) or [()] * 5
        kinds = (pa.int32(), *[pa.binary()] * 4)
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("agree", "key", "other", "label", "far"), columns, kinds)})

    made = dealt.groupBy("bucket", "low", "high").applyInArrow(run, "agree int, key binary, other binary, label binary, far binary")
    if best:
        top = F.max(F.struct("agree", "key", "other"))
        return made.groupBy("label", "far").agg(top.alias("top")).select("top.key", "top.other").distinct()
    return made.select("key", "other").distinct()


def classes(edges: DataFrame) -> DataFrame:
    """(key, label): for every linked text the first key, by order, of all that it is linked with in any number of steps.

    Labels pass along links and are then followed to their own labels, which
    halves the way each time. A node takes the least of its neighbours' labels,
    which combines before the shuffle, so hubs do no harm.
    """
    both = kept(edges.select("key", "other").unionByName(edges.select(F.col("other").alias("key"), F.col("key").alias("other"))), "links")
    labels = kept(both.groupBy("key").agg(F.least(F.min("other"), F.first("key")).alias("label")), "labels")
    while True:
        passed = both.join(labels.select(F.col("key").alias("other"), "label"), "other").groupBy("key").agg(F.min("label").alias("near"))
        nearer = labels.join(passed, "key").select("key", F.least("label", "near").alias("label"), F.col("label").alias("before"))
        nearer = kept(nearer, "labels")
        jump = nearer.select(F.col("key").alias("label"), F.col("label").alias("far"))
        after = kept(nearer.join(jump, "label").select("key", F.least("label", "far").alias("label"), "before"), "labels")
        if after.filter("label != before").isEmpty():
            return after.select("key", "label")
        labels = after.select("key", "label")


def labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((key, first_id, label) of every distinct text, (label, class_id) of the classes with several texts)."""
    texts, own = links(docs)
    named = kept(texts.join(own, "key", "left").select("key", "first_id", F.coalesce("label", "key").alias("label")), "classes")
    return named, named.groupBy("label").agg(F.min("first_id").alias("class_id"))


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, copy_of, class_key) of every row.

    ``class_id`` is the least key of the near-copy class, ``copy_of`` the least
    key of the rows with the same text, ``class_key`` the hash of one of the
    class's texts.
    """
    named, ids = labelled(docs)
    full = kept(named.join(ids, "label").select("key", "first_id", "class_id", F.lower(F.hex("label")).alias("class_key")), "classes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    return rows.join(full, "key").select("doc_id", "class_id", F.col("first_id").alias("copy_of"), "class_key")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns: the one with the least key."""
    named, _ = labelled(docs)
    best = named.groupBy("label").agg(F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "key")).alias("best"))
    stay = kept(best.select(F.col("best.first_id").alias("id"), F.col("best.key").alias("key")), "kept-ids")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    same = keyed["id"].eqNullSafe(stay["id"]) & (keyed["key"] == stay["key"])
    chosen = keyed.join(stay, same, "left_semi")
    repeated = keyed.groupBy("id", "key").count()
    if not repeated.filter("count > 1").isEmpty():  # equal rows: one of them
        chosen = chosen.dropDuplicates(["id", "key"])
    return chosen.select("row.*")
