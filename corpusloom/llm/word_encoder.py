"""Token ids of many texts by a public tokenizer, each distinct word encoded once per worker.

The tokenizers never merge over the start of a word, so a text's ids are the
ids of its words in turn. Words are found and numbered by Arrow; only words
that a worker has not met are handed to the tokenizers library. Texts with
runs of white space, other control marks or special tokens go to the library
whole. The result always equals the library's for the whole text.
"""

import string
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARK = "\x01"
SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
PUNCTUATION = string.punctuation.replace("'", "")
ENDS_IN_LETTER = "[A-Za-z0-9À-ÖØ-öø-ɏ]$"
CACHED_WORDS = 700_000

_ENCODERS: dict = {}


def tokenizer_path(name: str, folder: str = "/opt/tokenizers") -> str:
    """Place of a public vocabulary file."""
    if folder not in sys.path:
        sys.path.append(folder)
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, keeps_spaces: bool) -> "WordEncoder":
    """The worker's encoder for a vocabulary file; its words stay known between tasks."""
    key = path, keeps_spaces
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, keeps_spaces)
    return _ENCODERS[key]


class WordEncoder:
    """keeps_spaces: a blank belongs to the word after it and a line feed is a token (byte-level
    vocabularies); otherwise white space has no tokens."""

    def __init__(self, path: str, keeps_spaces: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_spaces = keeps_spaces
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        specials = [pc_quote(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        whole = [MARK, *specials]
        if keeps_spaces:
            whole += [f"[{SPACES}][{SPACES}]", f"^[{SPACES}]", f"[{SPACES}]$"]
        self.whole = "|".join(whole)
        self.between = "\n" if keeps_spaces else f" {MARK} "
        (self.between_id,) = self.library(self.between)
        self.known: dict[str, bytes] = {}

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def words(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct words, which neither start nor end with a line feed."""
        found = list(map(self.known.get, words))
        if None not in found:
            return found
        new = [w for w, ids in zip(words, found) if ids is None]
        ids = dict(zip(new, self.encoded(new)))
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known = {w: f for w, f in zip(words, found) if f is not None}
        self.known.update(ids)
        return [ids[w] if f is None else f for w, f in zip(words, found)]

    def encoded(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for low in range(0, len(words), 20_000):
            part = words[low : low + 20_000]
            ids = np.array(self.library(self.between + self.between.join(part)), dtype=self.kind)
            cuts = np.flatnonzero(ids == self.between_id)
            if len(cuts) != len(part):  # a word that holds the separator's token
                out += [np.array(self.library(w), dtype=self.kind).tobytes() for w in part]
                continue
            size, data = self.kind.itemsize, ids.tobytes()
            starts, ends = ((cuts + 1) * size).tolist(), (np.append(cuts[1:], len(ids)) * size).tolist()
            out += [data[a:b] for a, b in zip(starts, ends)]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, number of ids of each text); null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, self.whole)
        split = pc.if_else(whole, "", texts)
        if self.keeps_spaces:
            split = pc.replace_substring(pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), split, pa.scalar("", pa.large_string())), "\n", " \n")
        else:
            split = pc.replace_substring(split, "\n", " ")
        lists = pc.split_pattern(split, " ")
        ends = np.asarray(lists.offsets)
        numbered = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        codes = np.asarray(numbered.indices)
        ids, each = gathered(*self.units(numbered.dictionary), codes)
        before = np.concatenate([[0], np.cumsum(each)])
        counts = np.diff(before[ends - ends[0]])
        if pc.any(whole).as_py():
            return self.with_whole(texts, np.asarray(whole), ids, counts)
        return ids, counts

    def units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids in turn, number of ids) of distinct pieces of texts between blanks."""
        stems = pc.utf8_rtrim(units, PUNCTUATION)
        cut = np.asarray(pc.binary_length(stems), dtype=np.int64)
        full = np.asarray(pc.binary_length(units), dtype=np.int64)
        fits = np.asarray(pc.match_substring_regex(stems, ENDS_IN_LETTER)) & (full - cut <= 4)
        stems = pc.if_else(pa.array(fits), stems, units)
        tails = np.where(fits, full - cut, 0)
        data = np.frombuffer(units.buffers()[2] or b"", dtype=np.uint8)
        stop = np.frombuffer(units.buffers()[1], dtype=np.int64)[units.offset + 1 :][: len(units)]
        tail_code = np.zeros(len(units), dtype=np.uint32)
        for k in range(4):
            rows = np.flatnonzero(tails > k)
            tail_code[rows] |= data[stop[rows] - k - 1].astype(np.uint32) << np.uint32(8 * k)
        codes, which = np.unique(tail_code, return_inverse=True)
        marks = [bytes(int(c).to_bytes(4, "big").lstrip(b"\0")).decode() for c in codes]
        tail_ids = [np.array(self.library(m) if m else [], dtype=self.kind).tobytes() for m in marks]
        numbered = stems.dictionary_encode()
        stem_ids = self.stems(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        parts = np.stack([np.asarray(numbered.indices, dtype=np.int64), len(stem_ids) + which.reshape(-1)], axis=1)
        pieces = stem_ids + tail_ids
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // self.kind.itemsize
        ids, each = gathered(np.frombuffer(b"".join(pieces), dtype=self.kind), lengths, parts.reshape(-1))
        return ids, each.reshape(-1, 2).sum(axis=1)

    def stems(self, stems: list[str]) -> list[bytes]:
        if not self.keeps_spaces:
            return self.words(stems)
        feed = np.array([self.between_id], dtype=self.kind).tobytes()
        keys = [s[1:] if s[:1] in (MARK, "\n") else " " + s for s in stems]
        found = self.words(keys)
        return [feed + ids if s[:1] == "\n" else ids for s, ids in zip(stems, found)]

    def with_whole(self, texts, whole, ids, counts):
        at = np.concatenate([[0], np.cumsum(counts)])
        parts = [
            np.array(self.library(texts[i].as_py()), dtype=self.kind) if whole[i] else ids[at[i] : at[i + 1]]
            for i in range(len(counts))
        ]
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)


def gathered(flat: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids) of the chosen pieces in turn; ``flat`` has all pieces, of the given lengths."""
    begins = np.cumsum(lengths) - lengths
    each = lengths[chosen]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    places = np.repeat((begins[chosen] - (ends - each)).astype(kind), each)
    places += np.arange(total, dtype=kind)
    return flat[places], each


def pc_quote(text: str) -> str:
    """The text as a regular expression."""
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)
