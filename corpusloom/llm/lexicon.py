"""Encoding and decoding with a word vocabulary, frequent words by a minimal acyclic transducer.

A text's words are found as the vocabulary's file says: special tokens apart, white
space to single blanks, lower case, then contractions, runs of letters, single
numbers and runs of other marks. Ids of a word depend on that word alone.

Words are counted over all texts. Those that occur at least ``2**(k/4)`` times, with
the least k for which they are at most ``MOST_WORDS``, are merged once and compiled
into a transducer over their bytes. States that accept the same endings with the
same ids are one state, so suffixes are shared; ids stand on the arcs, each as
early as all words through that arc have it in common. The transducer is a flat
file in the shared folder. Spark brings it to every executor, whose workers map it
into memory and step through it with all words of a batch at once.

Words that it does not know are merged by rank, exactly, each distinct word once
while a worker remembers it. So the choice of words changes the time, never the ids.

Decoding takes the ids alone: their tokens with a blank between two, which is
what the file's missing decoder makes of them.

A null text is the empty one and has no ids. Null keys are kept, and equal rows
stay separate rows. An empty table gives an empty result. Other columns are not read.
"""

import hashlib
import heapq
import json
import os
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.common import kept, slices
from corpusloom.llm.word_encoder import pc_quote
from corpusloom.session import scratch_path

MAGIC = 0x31584C4D4F4F4C43
MOST_WORDS = 262_144
REMEMBERED = 300_000
SHORT = 32
END = "</w>"

#: Letters whose case, form and kind are the same to Arrow and to the tokenizers library.
PLAIN = r"\t\n\r -~\x{a1}-\x{12f}\x{131}-\x{17f}\x{2010}-\x{2027}\x{2030}-\x{205e}"
#: Fixed value: the words of the vocabulary's file, in runs without white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\pL\pN]+"

_KNOWN: dict = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if visible, else the next one after 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in visible}
    for number, byte in enumerate(b for b in range(256) if b not in letters):
        letters[byte] = chr(256 + number)
    return [letters[b] for b in range(256)]


@dataclass
class Chunks:
    """Distinct words, and how runs without white space and texts consist of them.

    Odd texts hold letters outside ``PLAIN`` or special tokens. Their words
    stand apart, as (text, words and special ids).
    """

    distinct: pa.Array
    words: np.ndarray  # numbers of the words of each distinct run in turn
    word_ends: np.ndarray  # 0, and where each distinct run ends among them
    runs: np.ndarray  # numbers of the runs of each text in turn
    run_ends: np.ndarray  # 0, and where each text ends among them
    odd: list[tuple[int, list]]

    def counts(self) -> np.ndarray:
        """How often each distinct word occurs, odd texts apart."""
        each = np.bincount(self.runs, minlength=len(self.word_ends) - 1)
        return np.bincount(self.words, weights=np.repeat(each, np.diff(self.word_ends)), minlength=len(self.distinct)).astype(np.int64)


class Merges:
    """The vocabulary's merges by rank, and its words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids = model["vocab"]
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + END] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = [ids[a + b] for a, b in pairs]  # by rank
        self.rank = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}.get
        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.tokens = pa.array([self.library.id_to_token(i) or "" for i in range(size)], pa.large_string())
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.odd = "|".join([f"[^{PLAIN}]", *map(pc_quote, self.special)])
        self.bytes = {letter: byte for byte, letter in enumerate(letters)}
        self.remembered: dict[bytes, tuple[int, ...]] = {}

    def ids(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word, merged by rank."""
        found = self.remembered.get(word)
        if found is None:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            parts = [self.inner[b] for b in word]
            if parts:
                parts[-1] = self.last[word[-1]]
            found = self.remembered[word] = tuple(self.short(parts) if len(parts) <= SHORT else self.long(parts))
        return found

    def short(self, parts: list[int]) -> list[int]:
        rank, never = self.rank, len(self.made)
        ranks = [rank(pair, never) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < never:
            i = ranks.index(least)
            parts[i : i + 2] = [self.made[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), never)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), never)
        return parts

    def long(self, parts: list[int]) -> list[int]:
        """The same with a queue of pairs, for words of any length."""
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        queue = [(found, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (found := self.rank((a, b))) is not None]
        heapq.heapify(queue)
        while queue:
            least, i, a, b = heapq.heappop(queue)
            j = after[i]
            if parts[i] != a or j >= size or parts[j] != b:
                continue  # one of the two has been merged since
            parts[i], parts[j] = self.made[least], -1
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < size and (found := self.rank((parts[left], parts[right]))) is not None:
                    heapq.heappush(queue, (found, left, parts[left], parts[right]))
        return [p for p in parts if p >= 0]

    def chunks(self, texts: pa.Array) -> "Chunks":
        """The texts as runs without white space; words never reach over its ends, so each distinct run is cut up once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.flatnonzero(np.asarray(pc.match_substring_regex(texts, self.odd)))
        plain = texts
        if len(odd):
            mask = np.zeros(len(texts), dtype=bool)
            mask[odd] = True
            plain = pc.if_else(pa.array(mask), "", texts)
        lists = pc.ascii_split_whitespace(pc.utf8_lower(plain))
        ends = np.asarray(lists.offsets)
        runs = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        parts = pc.split_pattern(pc.replace_substring_regex(runs.dictionary, WORDS, "\\0\n"), "\n")  # the last one is empty
        stops = np.asarray(parts.offsets)
        words = parts.values.slice(stops[0], stops[-1] - stops[0]).dictionary_encode()
        return Chunks(
            words.dictionary.cast(pa.large_binary()), np.asarray(words.indices), stops - stops[0], np.asarray(runs.indices), ends - ends[0],
            [(int(i), self.odd_words(texts[i].as_py())) for i in odd],
        )

    def odd_words(self, text: str) -> list:
        """Words and special ids of a text, found by the library itself."""
        out: list = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                out += [bytes(map(self.bytes.__getitem__, word)) for word, _ in found]
        return out


def merges(path: str) -> Merges:
    """The worker's merges for a vocabulary file."""
    if path not in _KNOWN:
        _KNOWN[path] = Merges(path)
    return _KNOWN[path]


def compiled(words: list[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """A minimal acyclic transducer of sorted distinct words with their ids, as a flat file.

        header   8 x uint64: magic, arcs, states, outputs, ids in outputs, spare
        arcs     uint32 each: state * 256 + byte, in order; then targets; then outputs
        states   uint32 each: 0, or 1 + the output at the end of a word
        outputs  uint32 ends of each output among the ids; output 0 is empty
        ids      uint32 each

    Words come in order, so a state is finished as soon as the next word leaves
    it. It is then compared with all finished ones and shared if equal. What the
    ids of all its words begin with moves to the arc before it.
    """
    register: dict = {}
    outputs: dict[tuple[int, ...], int] = {(): 0}
    path: list[list] = [[None, []]]  # (ids at the end of a word, arcs) of the states of the word before
    letters: list[int] = []

    def common(first, second):
        size = 0
        for a, b in zip(first, second):
            if a != b:
                break
            size += 1
        return first[:size]

    def finished(end, arcs):
        begin = end
        for _, _, ids in arcs:
            begin = ids if begin is None else common(begin, ids)
            if not begin:
                break
        cut = len(begin or ())
        state = (None if end is None else end[cut:], tuple((letter, target, ids[cut:]) for letter, target, ids in arcs))
        return register.setdefault(state, len(register)), begin or ()

    def close(depth):
        while len(path) - 1 > depth:
            state, begin = finished(*path.pop())
            path[-1][1].append((letters.pop(), state, begin))

    for word, ids in words:
        shared = len(os.path.commonprefix([word, bytes(letters)]))
        close(shared)
        for letter in word[shared:]:
            path.append([None, []])
            letters.append(letter)
        path[-1][0] = ids
    close(0)
    end, arcs = path[0]  # the root keeps what its words have in common
    root = register.setdefault((end, tuple(arcs)), len(register))
    number = {root: 0}
    for state in range(len(register)):
        if state != root:
            number[state] = len(number)
    key, target, out, ends = [], [], [], [0] * len(register)

    def output(ids):
        return outputs.setdefault(ids, len(outputs))

    for (end, arcs), state in register.items():
        own = number[state]
        ends[own] = 0 if end is None else 1 + output(end)
        for letter, to, ids in arcs:
            key.append(own * 256 + letter)
            target.append(number[to])
            out.append(output(ids))
    order = np.argsort(np.array(key, dtype=np.int64), kind="stable")
    if len(register) >= 1 << 24:
        raise ValueError("too many states for a key of 32 bits")
    pool = [i for ids in outputs for i in ids]
    stops = np.cumsum([len(ids) for ids in outputs])
    header = np.array([MAGIC, len(key), len(register), len(outputs), len(pool), 0, 0, 0], dtype="<u8")
    arrays = [np.array(x, dtype="<u4")[order] for x in (key, target, out)] + [np.array(x, dtype="<u4") for x in (ends, stops, pool)]
    return header.tobytes() + b"".join(a.tobytes() for a in arrays)


class Transducer:
    """A compiled transducer, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype="<u4", mode="r")
        magic, arcs, states, outputs, pool, *_ = data[:16].view("<u8").tolist()
        if magic != MAGIC:
            raise ValueError("not a transducer")
        cuts = np.cumsum([16, arcs, arcs, arcs, states, outputs, pool])
        self.key, self.target, self.out, self.ends, self.stops, self.pool = (data[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
        self.sizes = np.diff(self.stops, prepend=0).astype(np.int64)

    def ids(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, number of ids, all ids in turn) of the words at these places of the bytes; all step at once."""
        number = len(begins)
        known = np.zeros(number, dtype=bool)
        lane, state, at = np.arange(number), np.zeros(number, dtype=np.uint32), begins.astype(np.int64)
        lanes, outs = [], []
        while len(lane):
            over = at == ends[lane]
            if over.any():
                final = self.ends[state[over]]
                stop = final > 0
                known[lane[over][stop]] = True
                lanes.append(lane[over][stop])
                outs.append(final[stop] - 1)
                lane, state, at = lane[~over], state[~over], at[~over]
            key = (state << np.uint32(8)) | data[at]
            place = np.searchsorted(self.key, key)
            place[place == len(self.key)] = 0
            fits = self.key[place] == key if len(self.key) else np.zeros(len(key), dtype=bool)
            lane, at, place = lane[fits], at[fits] + 1, place[fits]
            state = self.target[place]
            out = self.out[place]
            some = out > 0
            lanes.append(lane[some])
            outs.append(out[some])
        lanes, outs = np.concatenate([[], *lanes]).astype(np.int64), np.concatenate([[], *outs]).astype(np.int64)
        mine = known[lanes]
        lanes, outs = lanes[mine], outs[mine]
        order = np.argsort(lanes, kind="stable")
        lanes, outs = lanes[order], outs[order]
        sizes = self.sizes[outs]
        counts = np.bincount(lanes, weights=sizes, minlength=number).astype(np.int64)
        return known, counts, self.pool[_ranges(self.stops[outs].astype(np.int64) - sizes, sizes)]


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of [begin, begin + size) in turn."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def joined(pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray, which: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts of the pool in the order of ``which``, where each group of them ends; ``ends`` begins with 0)."""
    each = sizes[which]
    return pool[_ranges(begins[which], each)], np.concatenate([[0], np.cumsum(each)])[ends]


def encoded(words: Merges, transducer: Transducer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in turn, where each text's end)."""
    chunks = words.chunks(texts)
    distinct = chunks.distinct
    offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    data = np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)
    known, sizes, ids = transducer.ids(data, offsets[:-1], offsets[1:])
    unseen = np.flatnonzero(~known)
    new = [words.ids(w) for w in distinct.take(pa.array(unseen)).to_pylist()]
    begins = np.cumsum(sizes) - sizes
    sizes[unseen] = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
    begins[unseen] = len(ids) + np.cumsum(sizes[unseen]) - sizes[unseen]
    pool = np.concatenate([ids, np.array([i for own in new for i in own], dtype=np.uint32)])
    of_runs, stops = joined(pool, begins, sizes, chunks.words, chunks.word_ends)
    flat, stops = joined(of_runs, stops[:-1], np.diff(stops), chunks.runs, chunks.run_ends)
    if not chunks.odd:
        return flat, stops[1:]
    parts = np.split(flat, stops[1:-1])
    for i, found in chunks.odd:
        parts[i] = np.array([x for w in found for x in ((w,) if isinstance(w, int) else words.ids(w))], dtype=np.uint32)
    return np.concatenate(parts), np.cumsum([len(p) for p in parts])


def decoded(words: Merges, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts of ids: tokens with a blank between two."""
    tokens = words.tokens.take(pa.array(ids))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), tokens), pa.scalar(" ", pa.large_string()))


def word_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(word, n) of all words of whole texts; counted in each task before anything is shuffled."""

    def run(batches):
        words = merges(vocabulary)
        for batch in slices(batches):
            chunks = words.chunks(batch.column("text"))
            odd = Counter(w for _, own in chunks.odd for w in own if isinstance(w, bytes))
            yield pa.RecordBatch.from_arrays([chunks.distinct.cast(pa.binary()), pa.array(chunks.counts())], ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(list(odd), pa.binary()), pa.array(list(odd.values()), pa.int64())], ["word", "n"])

    made = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n long")
    return made.filter("length(word) > 0").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """The words with at least ``2**(k/4)`` occurrences, k the least for which they are at most ``most``."""
    power = F.floor(4 * F.log2("n")).cast("int")
    powers = counts.groupBy(power.alias("power")).count().collect()  # at most 256 rows
    least, room = 256, most
    for row in sorted(powers, key=lambda r: -r.power):
        if row["count"] > room:
            break
        least, room = row.power, room - row["count"]
    return counts.filter(power >= least)


def lexicon(docs: DataFrame, vocabulary: str, most: int = MOST_WORDS) -> bytes:
    """The compiled transducer of the frequent words, at most ``most`` of which come to the driver."""

    def run(batches):
        words = merges(vocabulary)
        for batch in batches:
            ids = [words.ids(w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    counts = kept(word_counts(docs, vocabulary), "word-counts")
    made = frequent(counts, most).select("word").mapInArrow(run, "word binary, ids array<int>").toArrow().sort_by("word")
    return compiled([(w, tuple(ids)) for w, ids in zip(made["word"].to_pylist(), made["ids"].to_pylist())])


def published(spark: SparkSession, data: bytes) -> str:
    """Name under which every executor finds the file, which is written once to the shared folder."""
    path = scratch_path(spark, "lexicon")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        out.write(data)
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def mapped(name: str) -> Transducer:
    """The worker's map of a published file."""
    if name not in _KNOWN:
        _KNOWN[name] = Transducer(SparkFiles.get(name))
    return _KNOWN[name]


def coded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): ids of every whole text, and the text that they decode to."""
    name = published(docs.sparkSession, lexicon(docs, vocabulary))

    def run(batches):
        words, transducer = merges(vocabulary), mapped(name)
        for batch in slices(batches):
            ids, ends = encoded(words, transducer, batch.column("text"))
            lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists.cast(pa.list_(pa.int32())), decoded(words, ids, ends).cast(pa.string())], ["doc_id", "ids", "decoded"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``coded`` gives, taken in the same tasks."""
    name = published(docs.sparkSession, lexicon(docs, vocabulary))

    def run(batches):
        words, transducer = merges(vocabulary), mapped(name)
        for batch in slices(batches):
            ids, ends = encoded(words, transducer, batch.column("text"))
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            packed = memoryview(ids.astype("<u4").tobytes())
            of_ids = [hashlib.sha256(packed[a:b]).hexdigest() for a, b in zip((begins * 4).tolist(), (ends * 4).tolist())]
            of_texts = [hashlib.sha256(t.as_buffer()).hexdigest() for t in decoded(words, ids, ends)]
            columns = [batch.column("doc_id"), pa.array(ends - begins, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
