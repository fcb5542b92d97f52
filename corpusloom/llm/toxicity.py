"""Toxicity by a support vector machine on a subsequence string kernel.

Two strings are alike by the subsequences of three characters that they
share, each weighted by ``DECAY`` to the length it spans, so letters that are
left out, put in or replaced take away only a part. A sentence's kernel with
a landmark is the sum over its words; the power ``SHARPNESS`` keeps unrelated
words near nothing. Landmarks are words of the labelled sentences, the most
telling ones and some common ones, and give the Nyström map in which a linear
machine is trained. As the map is a sum over words, the trained machine is one
number per distinct word, which a task works out once. A task holds little at a
time: slices of ``SLICE_BYTES`` of text, blocks of ``BLOCK`` words, the values of
``CACHED_WORDS`` words and a table of the landmarks' own subsequences. All of
it goes with the task, as a worker lives on into other stages.

A document's label says that one of its sentences is toxic, not which: the
machine is trained on all sentences first and then on the worst sentences of
toxic documents against the worst ones of clean documents. A score is a
logistic curve through the worst margins of a document.

The fit takes at most ``FIT_ROWS`` labelled documents of each class, the first
by a hash of the key, and begins with at most ``FIT_SENTENCES`` of their sentences; every document is scored whole. A null or empty text has
one sentence without words. Without both classes the score is the share of
toxic labels (0 without labels). Repeated rows are scored alike; null labels
and labels with a null key are not used; of rival labels toxic holds.
"""

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import slices

FIT_ROWS = 800
FIT_SENTENCES = 12_000
THRESHOLD = 0.7
LANDMARKS = 112
COMMON_LANDMARKS = 4
DECAY = 0.7
SHARPNESS = 4
LONGEST_SPAN = 8
LONGEST_WORD = 20
ALPHABET = 48
MARKS = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
WORST = 4, 10
TURNS = 4
CACHED_WORDS = 350_000
SLICE_BYTES = 1_000_000
BLOCK = 8192
FEED = "\x01"


def character_classes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(class of every character of all words in turn, length of each word)."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    letters = (points >= 97) & (points <= 122)
    other = np.where(points < 128, 26, 27 + points % (ALPHABET - 27))
    return np.where(letters, points - 97, other), np.array([len(w) for w in words], dtype=np.int64)


@cache
def subsequences(length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights) of the subsequences of three characters of a word."""
    places = [
        (i, j, k)
        for i in range(length)
        for k in range(i + 2, min(length, i + LONGEST_SPAN))
        for j in range(i + 1, k)
    ]
    found = np.array(places, dtype=np.int64).reshape(-1, 3)
    weights = DECAY ** (found[:, 2] - found[:, 0] + 1).astype(np.float64)
    return found, (weights / max(np.sqrt((weights**2).sum()), 1e-12)).astype(np.float32)


def windows(word: str) -> list[str]:
    """A word, or the overlapping windows of one that is too long."""
    if len(word) <= LONGEST_WORD:
        return [word]
    step = LONGEST_WORD // 2
    return [word[i : i + LONGEST_WORD] for i in range(0, len(word) - step, step)]


def _by_length(words: list[str]):
    """Per length: (positions of the words, codes of their subsequences, weights)."""
    classes, lengths = character_classes(words)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths).tolist():
        if length < 3:
            continue
        places, weights = subsequences(length)
        every = np.flatnonzero(lengths == length)
        for low in range(0, len(every), 1024):
            rows = every[low : low + 1024]
            own = classes[starts[rows][:, None] + np.arange(length)]
            codes = (own[:, places[:, 0]] * ALPHABET + own[:, places[:, 1]]) * ALPHABET + own[:, places[:, 2]]
            yield rows, codes, weights


class Kernel:
    """Kernel values of words with the landmarks, by a table over the landmarks' subsequences."""

    def __init__(self, landmarks: list[str]):
        found = list(_by_length(landmarks))
        met = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(codes.ravel() for _, codes, _ in found)]))
        self.row = np.zeros(ALPHABET**3, dtype=np.int32)  # 0: no landmark has it
        self.row[met] = np.arange(1, len(met) + 1)
        self.table = np.zeros((len(met) + 1, len(landmarks)), dtype=np.float32)
        for rows, codes, weights in found:
            for row, own in zip(rows.tolist(), codes):
                np.add.at(self.table[:, row], self.row[own], weights)

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]), dtype=np.float32)
        for rows, codes, weights in _by_length(words):
            total = np.zeros((len(rows), out.shape[1]), dtype=np.float32)
            at = self.row[codes]
            for k, weight in enumerate(weights):
                total += weight * self.table[at[:, k]]
            out[rows] = total**SHARPNESS
        return out

    def times(self, words: list[str], factor: np.ndarray) -> np.ndarray:
        """The words' kernel values multiplied by a matrix or vector, a block of words at a time."""
        kind = np.result_type(np.float32, factor)
        out = np.zeros((len(words), *factor.shape[1:]), dtype=kind)
        for low in range(0, len(words), BLOCK):
            out[low : low + BLOCK] = self(words[low : low + BLOCK]) @ factor
        return out


def sentences(texts: pa.Array):
    """(distinct words, word of each place, sentence of each place, first sentence of each text).

    Sentences end at a full stop, a question or exclamation mark or a line
    feed. Words are in lower case without marks at their ends. A run of three
    or more single letters is also taken as one word.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    joined = pc.replace_substring(pc.utf8_lower(texts), "\n", f" {FEED} ")
    lists = pc.utf8_split_whitespace(joined)
    ends = np.asarray(lists.offsets)
    numbered = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    ends = ends - ends[0]
    codes = np.asarray(numbered.indices)
    raw = numbered.dictionary
    stops = np.asarray(pc.match_substring_regex(raw, f"[.!?{FEED}]$"))
    trimmed = pc.utf8_trim(raw, MARKS + FEED).dictionary_encode()
    words, code = trimmed.dictionary.to_pylist(), np.asarray(trimmed.indices)[codes]
    stop = stops[codes]
    starts = ends[:-1]
    opens = np.zeros(len(codes) + 1, dtype=np.int64)
    opens[1:-1] = stop[:-1] if len(codes) else 0
    opens[starts[starts < len(codes)]] = 1
    # a text without words still has one sentence
    bare = np.diff(ends) == 0
    number = np.cumsum(opens[:-1]) - 1 + np.repeat(np.cumsum(bare), np.diff(ends))
    total = int(opens[:-1].sum() + bare.sum())
    first = np.zeros(len(bare), dtype=np.int64)
    full = np.flatnonzero(~bare)
    first[full] = number[starts[full]]
    rank = np.cumsum(np.concatenate([[0], np.where(bare, 1, 0)]))[:-1]
    before = np.concatenate([[0], np.cumsum(opens[:-1])])[starts] if len(codes) else np.zeros(len(bare), dtype=np.int64)
    first[bare] = (before + rank)[bare]
    single = np.array([len(w) == 1 and w.isalpha() for w in words], dtype=bool)[code] if len(words) else np.zeros(0, dtype=bool)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    code, number = [code], [number]
    for low, high in edges.reshape(-1, 2).tolist():
        if high - low >= 3:
            words.append("".join(words[c] for c in code[0][low:high]))
            code.append(np.array([len(words) - 1]))
            number.append(number[0][low : low + 1])
    return words, np.concatenate(code), np.concatenate(number), first, total


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    curve: np.ndarray
    constant: float | None = None

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Scores texts; keeps the value of each word it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.kernel = Kernel(model.landmarks)
        self.known: dict[str, float] = {}

    def values(self, words: list[str]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            at = [i for i, v in enumerate(found) if v is None]
            fresh = self.fresh([words[i] for i in at]).tolist()
            if len(self.known) + len(at) > CACHED_WORDS:
                self.known.clear()
            for i, value in zip(at, fresh):
                found[i] = self.known[words[i]] = value
        return np.array(found, dtype=np.float64)

    def fresh(self, words: list[str]) -> np.ndarray:
        parts = [windows(w) for w in words]
        if all(len(p) == 1 for p in parts):
            return self.kernel.times(words, self.model.weights)
        flat = self.kernel.times([w for p in parts for w in p], self.model.weights)
        ends = np.cumsum([len(p) for p in parts])
        return np.maximum.reduceat(flat, ends - [len(p) for p in parts])

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        words, code, number, first, total = sentences(texts)
        margins = self.model.bias + np.bincount(number, weights=self.values(words)[code], minlength=total)
        return sigmoid(worst_margins(margins, first) @ self.model.curve)


def worst_margins(margins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: largest and second largest margin of its sentences, their positive excess, log of their number, 1."""
    counts = np.diff(np.append(first, len(margins)))
    owner = np.repeat(np.arange(len(first)), counts)
    order = np.lexsort((-margins, owner))
    top = margins[order[first]]
    second = margins[order[first + np.minimum(1, counts - 1)]]
    excess = np.add.reduceat(np.maximum(margins, 0), first)
    return np.stack([top, second, np.log1p(excess), np.log(counts), np.ones(len(first))], axis=1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _machine(x: np.ndarray, y: np.ndarray, costs: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps; y is 1 or -1."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(rows.shape[1], ridge)
    penalty[-1] = 1e-8
    costs = costs / costs.sum()
    w = np.zeros(rows.shape[1])

    def loss(w):
        return (penalty * w * w).sum() / 2 + (costs * np.maximum(0, 1 - y * (rows @ w)) ** 2).sum() / 2

    for _ in range(30):
        inside = y * (rows @ w) < 1
        own, c = rows[inside], costs[inside]
        gradient = penalty * w + own.T @ (c * (own @ w - y[inside]))
        step = np.linalg.solve((own * c[:, None]).T @ own + np.diag(penalty), gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _calibration(rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve through the worst margins of labelled documents."""
    w = np.zeros(rows.shape[1])
    for _ in range(50):
        p = sigmoid(rows @ w)
        gradient = rows.T @ (p - toxic) + 1e-2 * w
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return w


def _landmarks(words: list[str], per_text: list[np.ndarray], toxic: np.ndarray) -> list[str]:
    """Words most tied to toxic texts and the commonest words of clean ones."""
    counts = np.zeros((2, len(words)))
    for own, label in zip(per_text, toxic.astype(int)):
        counts[label, own] += 1
    n = np.array([(~toxic).sum(), toxic.sum()])
    share = (counts + 0.5) / (n[:, None] + 1)
    pooled = (counts.sum(axis=0) + 1) / (n.sum() + 2)
    telling = (share[1] - share[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    fits = np.array([3 <= len(w) <= LONGEST_WORD for w in words])
    telling = np.where(fits & (counts[1] >= 3), telling, -np.inf)
    order = np.argsort(-telling, kind="stable")[:LANDMARKS]
    chosen = [i for i in order.tolist() if telling[i] > 2]
    common = np.argsort(-np.where(fits, counts[0], -1), kind="stable").tolist()
    chosen += [i for i in common if i not in set(chosen)][:COMMON_LANDMARKS]
    return [words[i] for i in chosen]


def train(texts: list[str], toxic: np.ndarray) -> Model:
    """Fit on labelled texts, which fit in memory by the bound on their number."""
    toxic = np.asarray(toxic, dtype=bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model([], np.zeros(0), 0.0, np.zeros(5), float(toxic.mean()) if len(toxic) else 0.0)
    words, code, number, first, total = sentences(pa.array(texts))
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, total)))
    text_of = owner[number]
    order = np.argsort(text_of, kind="stable")
    per_text = [np.unique(c) for c in np.split(code[order], np.cumsum(np.bincount(text_of, minlength=len(texts)))[:-1])]
    landmarks = _landmarks(words, per_text, toxic)
    kernel = Kernel(landmarks)
    values, vectors = np.linalg.eigh(kernel(landmarks).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    parts = [windows(w) for w in words]
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes) - sizes
    every = kernel.times([w for p in parts for w in p], root.astype(np.float32))
    owners = np.repeat(np.arange(len(words)), sizes)
    shown = begins  # a word's window: the first, and after each turn the one of the greatest value, as in scoring

    def features(chosen: np.ndarray) -> np.ndarray:
        """Sums over the words of the chosen sentences."""
        row = np.full(total, -1)
        row[chosen] = np.arange(len(chosen))
        at = row[number]
        keep = np.flatnonzero(at >= 0)
        keep = keep[np.argsort(at[keep], kind="stable")]
        out = np.zeros((len(chosen), every.shape[1]))
        has, begin = np.unique(at[keep], return_index=True)
        for low in range(0, len(has), 2000):
            high = min(low + 2000, len(has))
            stop = begin[high] if high < len(has) else len(keep)
            block = every[shown[code[keep[begin[low] : stop]]]]
            out[has[low:high]] = np.add.reduceat(block, begin[low:high] - begin[low], axis=0)
        return out

    label = toxic[owner]
    spread = np.argsort((np.arange(total) * 2654435761) % (1 << 32), kind="stable")
    chosen = spread[:FIT_SENTENCES]
    weights, bias = np.zeros(every.shape[1]), 0.0
    for turn in range(TURNS):
        y = np.where(label[chosen], 1.0, -1.0)
        costs = np.where(label[chosen], 1 / max(1, label[chosen].sum()), 1 / max(1, (~label[chosen]).sum()))
        weights, bias = _machine(features(chosen), y, costs)
        values = every @ weights.astype(np.float32)
        shown = np.lexsort((-values, owners))[begins]
        margins = bias + np.bincount(number, weights=np.maximum.reduceat(values, begins)[code], minlength=total)
        # the worst sentences of each toxic and of each clean document
        order = np.lexsort((-margins, owner))
        place = np.arange(total) - np.repeat(first, np.diff(np.append(first, total)))
        chosen = order[place < np.where(label[order], *WORST)]
    curve = _calibration(worst_margins(margins, first), toxic.astype(float))
    return Model(landmarks, root @ weights, bias, curve)


def held_out(key) -> F.col:
    """Whether a row's label is never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on documents (doc_id, text) with labels (doc_id, toxic) outside the held-out third."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    parts = [
        usable.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS) for kind in (0, 1)
    ]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # at most two times FIT_ROWS keys
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(sample, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic").toArrow()
    rows = rows.sort_by("doc_id")
    own, toxic = ["" if t is None else t for t in rows["text"].to_pylist()], rows["toxic"].to_numpy() == 1
    del rows
    pa.default_memory_pool().release_unused()
    model = train(own, toxic)
    pa.default_memory_pool().release_unused()
    return model


def _score_slices(batches, model: Model):
    """(slice, scores of its texts) in turn; what a worker needs for them goes with the task."""
    scorer = model.scorer()
    for batch in slices(batches, limit=SLICE_BYTES):
        yield batch, scorer.scores(batch.column("text"))
    del scorer
    pa.default_memory_pool().release_unused()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, score in _score_slices(batches, shared.value):
            columns = [batch.column("doc_id"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    made = chosen.mapInArrow(run, "doc_id long, score double, predicted int")
    return made.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, whose score is under the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, score in _score_slices(batches, shared.value):
            yield batch.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
