"""Token counts: byte-pair merges of many pre-tokens at once, as ragged arrays.

The pre-tokens of a batch lie one after another in one array of symbols. In each round every sequence
looks up the ranks of its neighbouring pairs and applies its lowest-rank pair, all sequences at the same
time; a sequence without a mergeable pair leaves, and its surviving symbols are its tokens. Normalising
and splitting follow the vocabulary file; the file is read, the library is not run.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import chunks, texts_of

_NONE = np.int64(2**62)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class MergeTable:
    """Merge ranks of a vocabulary file, and token counts of its pre-tokens.

    Applying all places of a sequence's lowest-rank pair in one round equals merging from the left one by one
    if every token is made before it is used: for each token, the merges that make it rank below those that
    use it. ``in_order`` holds that for each merge; others are applied at their leftmost place only.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.width = max(vocab.values()) + 1
        end = spec["model"].get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + end] for b in range(256)], np.int64)
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * self.width + right
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order, made
        used_from = np.full(self.width, len(pairs), np.int64)
        np.minimum.at(used_from, left, np.arange(len(pairs)))
        np.minimum.at(used_from, right, np.arange(len(pairs)))
        made_by = np.zeros(self.width, np.int64)
        np.maximum.at(made_by, made, np.arange(len(pairs)))
        self.in_order = made_by[made] < used_from[made]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_split = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.pattern = regex.compile(self._pattern(spec))

    @staticmethod
    def _pattern(spec: dict) -> str:
        for step in spec["pre_tokenizer"]["pretokenizers"]:
            if step["type"] == "Split":
                return step["pattern"]["Regex"]
        raise ValueError("the vocabulary has no split pattern")

    @staticmethod
    def normal(text: str) -> str:
        """Composed and lower case, letter by letter: a final sigma gets no form of its own."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pre_tokens(self, text: str) -> list[str]:
        return self.pattern.findall(self.normal(text))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many symbols survive of each sequence; ``sizes`` are at least 1."""
        counts = np.zeros(len(sizes), np.int64)
        seq = np.repeat(np.arange(len(sizes)), sizes)
        while len(symbols):
            rank = np.full(len(symbols), _NONE)
            inside = np.flatnonzero(seq[1:] == seq[:-1])
            rank[inside] = self._rank(symbols[inside], symbols[inside + 1])
            starts = np.flatnonzero(np.diff(seq, prepend=-1))
            size = np.diff(np.append(starts, len(seq)))
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == _NONE
            counts[seq[starts[over]]] = size[over]
            at = np.flatnonzero((rank == np.repeat(lowest, size)) & (rank < _NONE))
            if not len(at):
                break
            # Of places that overlap (x x x), every second one merges, from the left.
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            first = np.diff(seq[at], prepend=-1) != 0
            at = at[(place % 2 == 0) & (self.in_order[rank[at]] | first)]
            symbols[at] = self.made[rank[at]]
            stays = np.repeat(~over, size)
            stays[at + 1] = False
            symbols, seq = symbols[stays], seq[stays]
        return counts

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each whitespace-free piece, special strings counting one each."""
        owners, found, extra = [], [], np.zeros(len(words), np.int64)
        for i, word in enumerate(words):
            parts = [word]
            if self.special_split is not None and "<" in word:
                parts = self.special_split.split(word)
                extra[i] = len(parts) - 1
            for part in parts:
                tokens = self.pre_tokens(part)
                found += tokens
                owners += [i] * len(tokens)
        if not found:
            return extra
        raw = [t.encode() for t in found]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        values = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[values]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[values[ends]]
        return extra + np.bincount(owners, weights=self.merge(symbols, sizes), minlength=len(words)).astype(np.int64)


@cache
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


#: White space to Python that the vocabulary's split may treat as characters.
_CONTROL = re.compile("[\x1c-\x1f]")


class _Counts(dict):
    def __missing__(self, word):
        self.new.append(word)
        return 0

    def __init__(self):
        super().__init__()
        self.new = []


class TokenCounter:
    """Counts of whole texts; at most ``cache_words`` distinct words are remembered, then the memory starts anew."""

    def __init__(self, path: str, cache_words: int = 600_000):
        self.table = merge_table(path)
        self.limit = cache_words
        self.known = _Counts()

    def _words(self, text: str) -> list[str]:
        return [text] if _CONTROL.search(text) else text.split()

    def count(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known = _Counts()
        words, sizes = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self._words(text)
            sizes[i] = len(found)
            words += found
        get = self.known.__getitem__
        counts = np.fromiter(map(get, words), np.int64, len(words))
        if self.known.new:
            new = list(dict.fromkeys(self.known.new))
            self.known.new = []
            learnt = dict(zip(new, self.table.counts(new).tolist(), strict=True))
            self.known.update((w, n) for w, n in learnt.items() if len(w) < 200)
            blank = np.flatnonzero(counts == 0)
            counts[blank] = [learnt.get(words[i], 0) for i in blank]
        upto = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(upto[np.concatenate([[0], np.cumsum(sizes)])])


_COUNTERS: dict[str, TokenCounter] = {}


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (doc_id, text), counted in one scan.

    A null text counts as empty: no bytes, no tokens. A null doc_id stays null; repeated rows are counted
    each. Other columns are not read. An empty table gives no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _COUNTERS:
            _COUNTERS[vocabulary] = TokenCounter(vocabulary)
        for batch in batches:
            for part in chunks(batch, "text"):
                tokens = _COUNTERS[vocabulary].count(texts_of(part))
                size = pc.fill_null(pc.binary_length(part["text"]), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part["doc_id"], size, pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", "text").mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
