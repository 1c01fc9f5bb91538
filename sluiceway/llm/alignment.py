"""Benchmark decontamination: rare n-gram seeds join documents to test items, Smith-Waterman alignment scores them.

A copy that was edited still shares some words at equal distances with its item. Three words in a row and three of four, with a gap, are
seeds: whichever third of the words is replaced, one of them stays. One scan of the documents finds the seeds of all items, counts the
documents that hold each, and cuts out the places where an item would lie by them, if they hold enough of the item's words to reach the
least score at all. A place is aligned to the item word by word; the best local alignment, as a share of the item's perfect score, tells
copies from chance. How rare the rarest seed of a copy is goes with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import chunks, stored, texts_of
from sluiceway.llm.shingles import WordHashes, mixed, normal_words

MATCH, MISMATCH, GAP = 2, -1, -1
#: Places of the words of a seed. An edit of every third word leaves the second or the third whole.
PATTERNS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
#: Cells of one alignment table row that are computed at a time.
_CELLS = 1 << 20


def spaced_hashes(words: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """A hash of the words at the places of ``pattern`` from each word on, another one for each pattern."""
    n = len(words) - pattern[-1]
    if n <= 0:
        return np.zeros(0, np.int64)
    total = np.full(n, sum(1 << at for at in pattern), np.uint64)
    for at in pattern:
        total = mixed(total + words[at : at + n])
    return total.view(np.int64)


def patterns_of(size: int, patterns: tuple) -> list[tuple[int, ...]]:
    """The patterns of seeds of an item of ``size`` words: of a shorter one than a pattern takes, all its words."""
    fitting = [p for p in patterns if p[-1] < size]
    return fitting or ([tuple(range(size))] if size else [])


def _seeds(patterns: tuple):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            items, seeds, places, sizes = [], [], [], []
            for item, text in zip(batch["item_id"].to_pylist(), texts_of(batch, "item_text"), strict=True):
                words = hashes.of(normal_words(text))
                for pattern in patterns_of(len(words), patterns):
                    own = spaced_hashes(words, pattern)
                    items += [item] * len(own)
                    seeds += own.tolist()
                    places += range(len(own))
                    sizes += [len(words)] * len(own)
            columns = [pa.array(c, pa.int64()) for c in (items, seeds, places, sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "seed", "place", "size"])

    return find


class _Finder:
    """Finds seeds in documents. A bitmap of the seeds' last bits tells most other words apart at once."""

    BITS = 20

    def __init__(self, known: np.ndarray, patterns: list[tuple[int, ...]]):
        self.known, self.patterns, self.hashes = known, patterns, WordHashes()
        self.marks = np.zeros(1 << self.BITS, bool)
        self.marks[known & ((1 << self.BITS) - 1)] = True

    def of(self, part: pa.RecordBatch) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of each document, and the hashes of them all; and of every seed in them its document, first word and place
        among the seeds."""
        words = [normal_words(t) for t in texts_of(part)]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        flat = self.hashes.of([w for own in words for w in own])
        docs, starts, seeds = [], [], []
        for pattern in self.patterns:
            values = spaced_hashes(flat, pattern)
            at = np.flatnonzero(self.marks[values & ((1 << self.BITS) - 1)])
            place = np.searchsorted(self.known, values[at])
            same = place < len(self.known)
            same[same] = self.known[place[same]] == values[at[same]]
            at, place = at[same], place[same]
            doc = np.searchsorted(ends, at, "right")
            inside = at + pattern[-1] < ends[doc] if len(at) else at >= 0
            doc, at, place = doc[inside], at[inside], place[inside]
            docs.append(doc)
            starts.append(at - np.where(doc > 0, ends[doc - 1], 0))
            seeds.append(place)
        none = [np.zeros(0, np.int64)]
        return words, flat.view(np.int64), *(np.concatenate(x + none) for x in (docs, starts, seeds))


class _Bags:
    """How often each item holds each of its words: the most that an alignment can match."""

    def __init__(self, items: np.ndarray, words: np.ndarray):
        self.items, number = np.unique(items, return_inverse=True)
        self.words, word = np.unique(words, return_inverse=True)
        self.keys, self.counts = np.unique(number * len(self.words) + word, return_counts=True)

    def shared(self, flat: np.ndarray, begin: np.ndarray, end: np.ndarray, items: np.ndarray) -> np.ndarray:
        """How many words, with repeats, each stretch of ``flat`` has in common with its item."""
        total, widths = np.zeros(len(begin), np.int64), end - begin
        number = np.searchsorted(self.items, items)
        ends = np.cumsum(widths)
        low = 0
        while low < len(begin):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - widths[low] + _CELLS, "right")))
            own = np.repeat(np.arange(low, high), widths[low:high])
            at = begin[own] + np.arange(len(own)) - (ends - widths)[own] + (ends - widths)[low]
            word = np.minimum(np.searchsorted(self.words, flat[at]), len(self.words) - 1)
            key = number[own] * len(self.words) + word
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.words[word] == flat[at]) & (self.keys[place] == key)
            pairs, n = np.unique(own[known] * len(self.keys) + place[known], return_counts=True)
            np.add.at(total, pairs // len(self.keys), np.minimum(n, self.counts[pairs % len(self.keys)]))
            low = high
        return total


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        words = [hashes.of(normal_words(t)).view(np.int64) for t in texts_of(batch, "item_text")]
        items = np.repeat(batch["item_id"].to_numpy(zero_copy_only=False), [len(w) for w in words])
        flat = np.concatenate([np.zeros(0, np.int64), *words])
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(flat)], names=["item_id", "word"])


_PLACES = "doc_id bigint, item_id bigint, word_start bigint, words array<string>, seeds array<bigint>, seed bigint, n bigint"


def _rows(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    """Rows of the two kinds that a scan gives: places of documents, and counts of seeds."""
    kinds = {"doc_id": pa.int64(), "item_id": pa.int64(), "word_start": pa.int64(), "words": pa.list_(pa.string())}
    kinds |= {"seeds": pa.list_(pa.int64()), "seed": pa.int64(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in kinds.items()], names=list(kinds))


def _candidates(
    seeds: np.ndarray, items: np.ndarray, places: np.ndarray, sizes: np.ndarray, patterns: list[tuple[int, ...]], bags: _Bags, least: float
):
    """For each place of a document where an item would lie by its seeds: the words there, with a margin, and the seeds.

    A place needs as many words of the item as an alignment of score ``least`` matches. At the end of a task, the number of
    documents that held each seed.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first, number = np.unique(seeds, return_index=True, return_counts=True)
        finder = _Finder(known, patterns)
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                words, flat, docs, ats, found = finder.of(part)
                total += np.bincount(np.unique(docs * len(known) + found) % max(1, len(known)), minlength=len(known))
                doc_ids = part["doc_id"].to_pylist()
                lengths_of = np.fromiter(map(len, words), np.int64, len(words))
                begins = np.cumsum(lengths_of) - lengths_of
                # Some documents at a time, so that seeds of many items take bounded memory.
                entries = np.bincount(docs, number[found], len(words)).cumsum() // _CELLS
                step = entries.astype(np.int64)[docs]
                for k in np.unique(step).tolist():
                    doc, at, seed = docs[step == k], ats[step == k], found[step == k]
                    n = number[seed]
                    entry = np.repeat(first[seed] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    doc, start = np.repeat(doc, n), np.repeat(at, n) - places[entry]
                    item, size, seed = items[entry], sizes[entry], np.repeat(seed, n)
                    margin = np.maximum(4, size // 4)
                    order = np.lexsort((start, item, doc))
                    doc, start, item, size, margin, seed = (x[order] for x in (doc, start, item, size, margin, seed))
                    new = np.ones(len(start), bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > margin[1:])
                    group = np.flatnonzero(new)
                    last = np.append(group[1:], len(start)) - 1
                    least_size = np.minimum.reduceat(size, group)
                    doc, item, size, margin = (x[group] for x in (doc, item, size, margin))
                    a = np.maximum(0, start[group] - margin)
                    b = np.minimum(lengths_of[doc], start[last] + size + margin)
                    shared = bags.shared(flat, begins[doc] + a, begins[doc] + b, item)
                    good = np.flatnonzero(shared / least_size >= least)
                    rows = [
                        (doc_ids[d], i, x, words[d][x:y], known[np.unique(seed[f : z + 1])].tolist())
                        for d, i, x, y, f, z in zip(*(v[good].tolist() for v in (doc, item, a, b, group, last)), strict=True)
                    ]
                    if rows:
                        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
                        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                        yield _rows(dict(zip(("doc_id", "item_id", "word_start", "words", "seeds"), columns, strict=True)), len(rows))
        seen = np.flatnonzero(total)
        yield _rows({"seed": pa.array(known[seen]), "n": pa.array(total[seen])}, len(seen))

    return find


def best_alignments(lefts: list[np.ndarray], rights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman scores of pairs of word-number arrays, and where in the right one the alignment ends.

    All pairs go forward together, a word of the left ones at a time. With a linear gap, the best of all gaps within a row
    is a running maximum.
    """
    n, height, width = len(lefts), max(map(len, lefts), default=0), max(map(len, rights), default=0)
    left, right = np.full((n, height), -1, np.int64), np.full((n, width), -2, np.int64)
    for i, (a, b) in enumerate(zip(lefts, rights, strict=True)):
        left[i, : len(a)], right[i, : len(b)] = a, b
    slope = -GAP * np.arange(width + 1)
    above = np.zeros((n, width + 1), np.int64)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(height):
        row = np.zeros_like(above)
        row[:, 1:] = np.maximum(0, above[:, :-1] + np.where(right == left[:, i, None], MATCH, MISMATCH))
        row = np.maximum(row, above + GAP)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        most = row.max(1)
        higher = most > best
        end[higher] = row[higher].argmax(1)
        best = np.maximum(best, most)
        above = row
    return best, end


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        lefts = [hashes.of(normal_words(t)).view(np.int64) for t in texts_of(batch, "item_text")]
        rights = [hashes.of(w).view(np.int64) for w in batch["words"].to_pylist()]
        score, end = np.zeros(len(lefts), np.int64), np.zeros(len(lefts), np.int64)
        order = sorted(range(len(lefts)), key=lambda i: len(rights[i]))
        while order:
            longest = max(1, len(rights[order[-1]]))
            some, order = order[-max(1, _CELLS // longest) :], order[: -max(1, _CELLS // longest)]
            score[some], end[some] = best_alignments([lefts[i] for i in some], [rights[i] for i in some])
        whole = np.array([MATCH * max(1, len(x)) for x in lefts])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["item_id"], pa.array(score / whole), pa.array(batch["word_start"].to_numpy() + end), batch["rarest"]],
            names=["doc_id", "item_id", "score", "word_end", "rarest"],
        )


def _passes(table: DataFrame, key: str, at_once: int) -> list[DataFrame]:
    """Parts of about ``at_once`` rows. Seeds of an item stay together, as they make its places; those of a shared phrase do not."""
    n = max(1, math.ceil(table.count() / at_once))
    return [table.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def contaminated(docs: DataFrame, items: DataFrame, least: float = 0.5, patterns: tuple = PATTERNS, seeds_at_once: int = 1_000_000) -> DataFrame:
    """``doc_id, item_id, score, word_end, rarest`` for every document of ``docs`` (doc_id, text) that holds an item (item_id, text).

    ``score`` is the best local alignment of the item to a place in the document, as a share of the perfect score, at least
    ``least``; words are runs of letters, digits and underscores in lower case; ``word_end`` is how many words of the document
    lie before the end of the best place (the first of several). Seeds are the words of an item at the places of each of ``patterns``, or all
    words of an item too short for them; an item is looked for wherever a document holds one. A place is not aligned only if it has
    fewer words in common with the item than a score of ``least`` takes. ``rarest`` is the number of rows that hold the rarest seed of the
    document's copies. Null and empty texts hold nothing and are held nowhere; items without id are left out; documents without id are
    reported as one, under null; repeated rows give one result. Other columns are not read. Empty tables give no rows.

    ``seeds_at_once`` bounds what goes to every task; more seeds go in several passes over ``docs``.
    """
    known = docs.select("doc_id", "text")
    wanted = stored(items.filter("item_id IS NOT NULL").select(F.col("item_id").cast("bigint"), F.col("text").alias("item_text")).distinct())
    seeds = stored(wanted.mapInArrow(_seeds(patterns), "item_id bigint, seed bigint, place bigint, size bigint"))
    short = max(p[-1] for p in patterns)
    sizes = [r["size"] for r in seeds.filter(F.col("size") <= short).select("size").distinct().collect()]
    looked = sorted({*patterns, *(p for size in sizes for p in patterns_of(size, patterns))})
    bag = stored(wanted.mapInArrow(_words, "item_id bigint, word bigint"))
    found = None
    for part in _passes(seeds, "item_id", seeds_at_once):
        own = part.orderBy("seed", "item_id", "place").toPandas()
        arrays = (own[c].to_numpy(np.int64) for c in ("seed", "item_id", "place", "size"))
        held = bag.join(part.select("item_id").distinct(), "item_id", "left_semi").toPandas()
        bags = _Bags(held["item_id"].to_numpy(np.int64), held["word"].to_numpy(np.int64))
        places = known.mapInArrow(_candidates(*arrays, looked, bags, least), _PLACES)
        # A seed of items of several passes is counted in each of them.
        places = places.withColumn("pass", F.lit(int(own["item_id"].iloc[0]) if len(own) else 0))
        found = places if found is None else found.union(places)
    found = stored(found)
    counts = found.filter("n IS NOT NULL").groupBy("pass", "seed").agg(F.sum("n").alias("n")).groupBy("seed").agg(F.max("n").alias("n"))
    # The counts of an item's seeds go with the item, so that no place is joined once for each of its seeds.
    counted = seeds.select("item_id", "seed").distinct().join(counts, "seed")
    counted = counted.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("seed", "n"))).alias("counts"))
    pairs = found.filter("item_id IS NOT NULL").join(stored(wanted.join(counted, "item_id")), "item_id")
    rarest = F.array_min(F.transform("seeds", lambda seed: F.col("counts")[seed]))
    pairs = pairs.select("doc_id", "item_id", "word_start", "words", "item_text", rarest.alias("rarest"))
    aligned = pairs.mapInArrow(_aligned, "doc_id bigint, item_id bigint, score double, word_end bigint, rarest bigint").filter(F.col("score") >= least)
    best = aligned.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("word_end")).alias("end"))).alias("best"), F.min("rarest").alias("rarest"))
    return best.select("doc_id", "item_id", "best.score", (-F.col("best.end")).alias("word_end"), "rarest")
