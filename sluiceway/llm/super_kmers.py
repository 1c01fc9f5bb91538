"""Exact removal of repeated passages: windows of words, partitioned by minimiser as super-k-mers.

A window of ``size`` words goes by its minimiser, the smallest hash of its runs of ``run`` words. Equal windows have equal
minimisers, and consecutive windows mostly share one, so they travel together as one packed string of their words. A bucket sorts its
windows and finds those that occur more than once, comparing words, not hashes.

Two counts come first, of minimisers alone. A minimiser seen once in all data cannot belong to a repeated window, so its string
need not travel: a bitmap of fixed size, ``filter_bits``, tells most of those (it can only let too many pass). And a minimiser of very
many strings, as a passage that stands in a third of all documents has, is hot, told by another such bitmap: its windows travel one by one,
are counted with map-side partial sums, and meet their count by a join that may split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.dataset import dataset
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import chunks, file_system, fresh_folder, stored, texts_of
from sluiceway.llm.shingles import WordHashes, run_hashes

#: A minimiser of more strings than this is hot; no bucket holds more.
HOT = 5_000
_SEGMENT = 1 << 15
_KEY = ["doc_id", "text_hash"]


def split_words(text: str) -> list[bytes]:
    """Runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return, as UTF-8."""
    return text.encode().split()


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:]) if span < len(values) else values[:0]
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def super_kmers(hashes: np.ndarray, counts: np.ndarray, size: int, run: int) -> tuple[np.ndarray, ...]:
    """Of documents whose word hashes lie one after another: document, first window, number of windows and minimiser."""
    none = np.zeros(0, np.int64)
    if len(hashes) < size:
        return none, none, none, np.zeros(0, np.uint64)
    least = sliding_least(run_hashes(hashes, run), size - run + 1)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)[: len(least)]
    inside = np.arange(len(least)) + size <= ends[doc]
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, np.zeros(0, np.uint64)
    least, doc = least[at], doc[at]
    first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (np.diff(at) != 1)]))
    number = np.diff(np.append(first, len(at)))
    return doc[first], at[first] - (ends - counts)[doc[first]], number, least[first]


def minimiser_counts(hashes: np.ndarray, counts: np.ndarray, size: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers, and how many super-k-mers each has; one that stands in its super-k-mer more than once counts twice there."""
    doc, first, number, least = super_kmers(hashes, counts, size, run)
    if not len(least):
        return least, number
    start = first + (np.cumsum(counts) - counts)[doc]
    width = number + size - run
    upto = np.cumsum(width)
    at = np.repeat(start - (upto - width), width) + np.arange(upto[-1])
    times = np.add.reduceat((run_hashes(hashes, run)[at] == np.repeat(least, width)).astype(np.int64), upto - width)
    names, place = np.unique(least, return_inverse=True)
    return names, np.bincount(place, weights=np.minimum(times, 2)).astype(np.int64)


def repeated_windows(strings: list[bytes], size: int) -> list[np.ndarray]:
    """For each packed string, which of its windows occur more than once among all of them.

    Words become numbers; the names of windows of 1, 2, 4 ... words are made from those of their halves by sorting, so equal names are
    equal words.
    """
    words = [s.split() for s in strings]
    number: dict[bytes, int] = {}
    flat = np.fromiter((number.setdefault(w, len(number)) for own in words for w in own), np.int64, sum(map(len, words)))
    span, names = 1, flat
    while span < size:
        step = min(span, size - span)
        pairs = names[: len(names) - step] * (names.max(initial=0) + 1) + names[step:]
        names = np.unique(pairs, return_inverse=True)[1]
        span += step
    found, at = [], 0
    starts = []
    for own in words:
        starts.append((at, at + len(own) - size + 1))
        at += len(own)
    inside = np.concatenate([np.arange(a, b) for a, b in starts]) if starts else np.zeros(0, np.int64)
    often = np.zeros(len(flat), bool)
    often[inside] = np.bincount(names[inside])[names[inside]] > 1 if len(inside) else False
    for a, b in starts:
        found.append(often[a:b])
    return found


def covered(first: int, flags: np.ndarray, size: int) -> tuple[list[int], list[int]]:
    """Spans of words covered by the flagged windows, whose first one starts at word ``first``."""
    at = np.flatnonzero(flags)
    if not len(at):
        return [], []
    cut = np.flatnonzero(np.diff(at) > 1)
    return (at[np.append(0, cut + 1)] + first).tolist(), (at[np.append(cut, len(at) - 1)] + first + size).tolist()


def _hashed(part: pa.RecordBatch, hashes: WordHashes) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    words = [split_words(t) for t in texts_of(part)]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    return words, counts, hashes.of([w for own in words for w in own])


def _minimisers(size: int, run: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in chunks(batch, "text"):
                _, counts, flat = _hashed(part, hashes)
                least, n = minimiser_counts(flat, counts, size, run)
                yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(n)], names=["least", "n"])

    return find


def _write_bitmap(repeated: DataFrame, bits: int) -> str:
    """A bit for each remainder of the repeated minimisers, however many there are: a table of segments in the shared folder.

    Tasks read it there; it does not pass through the driver.
    """

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        marks = np.zeros(_SEGMENT, np.uint8)
        marks[rows["place"].to_numpy() % _SEGMENT] = 1
        return pa.Table.from_pydict({"segment": [key[0].as_py()], "marks": [np.packbits(marks).tobytes()]})

    uri = fresh_folder(repeated.sparkSession)
    places = repeated.select(F.pmod("least", F.lit(bits)).alias("place")).distinct().withColumn("segment", F.expr(f"place div {_SEGMENT}"))
    places.groupBy("segment").applyInArrow(pack, "segment bigint, marks binary").write.parquet(uri)
    return uri


def _read_bitmap(uri: str, bits: int) -> np.ndarray:
    store, path = file_system(uri)
    found = np.zeros((bits // _SEGMENT, _SEGMENT // 8), np.uint8)
    table = dataset(path, filesystem=store, format="parquet").to_table()
    for segment, marks in zip(table["segment"].to_pylist(), table["marks"].to_pylist(), strict=True):
        found[segment] = np.frombuffer(marks, np.uint8)
    return found.ravel()


def _marked(marks: np.ndarray, least: np.ndarray) -> np.ndarray:
    place = least % (len(marks) * 8)
    return (marks[place // 8] >> (7 - place % 8).astype(np.uint8)) & 1 > 0


def _strings(size: int, run: int, bitmap: str, bits: int, hot: str):
    """Packed strings of the super-k-mers that may repeat; those of hot minimisers as single windows with ``least`` null."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, marks, hottest = WordHashes(), _read_bitmap(bitmap, bits), _read_bitmap(hot, bits)
        for batch in batches:
            for part in chunks(batch, "text"):
                words, counts, flat = _hashed(part, hashes)
                doc, first, number, least = super_kmers(flat, counts, size, run)
                least = least.view(np.int64)
                maybe = np.flatnonzero(_marked(marks, least))
                is_hot = _marked(hottest, least[maybe])
                owner, start, packed, key = [], [], [], []
                for i, single in zip(maybe.tolist(), is_hot.tolist(), strict=True):
                    own, d, f, n = words[doc[i]], int(doc[i]), int(first[i]), int(number[i])
                    for a, b in [(f + j, f + j + size) for j in range(n)] if single else [(f, f + n + size - 1)]:
                        owner.append(d)
                        start.append(a)
                        packed.append(b" ".join(own[a:b]))
                        key.append(None if single else int(least[i]))
                rows = part.select(_KEY).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(start, pa.int64()), pa.array(key, pa.int64()), pa.array(packed, pa.binary())],
                    names=[*_KEY, "start", "least", "packed"],
                )

    return find


_SPANS = "doc_id bigint, text_hash bigint, span_start bigint, span_end bigint"


def _count(size: int):
    """Buckets come sorted by minimiser; a bucket that a batch cuts in two waits for its rest."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        packed, start = rows["packed"].to_pylist(), rows["start"].to_pylist()
        owner, froms, tos = [], [], []
        for i, flags in enumerate(repeated_windows(packed, size)):
            a, b = covered(start[i], flags, size)
            owner += [i] * len(a)
            froms += a
            tos += b
        keys = rows.select(_KEY).take(pa.array(owner, pa.int64())).combine_chunks()
        columns = [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], pa.int64()) for c in keys.columns]
        return pa.RecordBatch.from_arrays([*columns, pa.array(froms, pa.int64()), pa.array(tos, pa.int64())], names=[*_KEY, "span_start", "span_end"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in chunks(batch, "packed", 4_000_000):
                least = part["least"].to_numpy()
                last = int(np.searchsorted(least, least[-1]))
                if last or (held and held[-1]["least"][-1].as_py() != least[0]):
                    ready = pa.Table.from_batches([*held, part.slice(0, last)])
                    held = []
                    if len(ready):
                        yield spans(ready)
                held.append(part.slice(last))
        if held:
            yield spans(pa.Table.from_batches(held))

    return count


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            total, removed, digests = [], [], []
            for text, spans in zip(texts_of(part), part["spans"].to_pylist(), strict=True):
                words = split_words(text)
                stays = np.ones(len(words), bool)
                for span in spans or ():
                    stays[span["span_start"] : span["span_end"]] = False
                kept = words if stays.all() else [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                total.append(len(words))
                removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def without_repeats(docs: DataFrame, size: int = 35, run: int = 4, filter_bits: int = 1 << 26) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs`` (doc_id, text), repeated windows of ``size`` words removed.

    Each word goes that a window covers whose words also start anywhere else, in the same row, another row, or an overlapping place.
    Windows are judged on the input. Null, empty and short texts have no window: nothing goes, and the digest is that of their
    words joined by one blank. A null doc_id stays null. Repeated rows are rows: from ``size`` words on, each loses all it has. Other
    columns are not read. An empty table gives no rows.

    Rows are told apart by doc_id and a hash of the text, so the spans of rows that share both are the same.
    """
    known = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = known.mapInArrow(_minimisers(size, run), "least bigint, n bigint")
    counts = stored(found.groupBy("least").agg(F.sum("n").alias("n")).filter("n > 1"))
    hot = counts.filter(F.col("n") > HOT)
    bitmaps = _write_bitmap(counts, filter_bits), filter_bits, _write_bitmap(hot, filter_bits)
    schema = "doc_id bigint, text_hash bigint, start bigint, least bigint, packed binary"
    strings = known.mapInArrow(_strings(size, run, *bitmaps), schema)
    has_hot = not hot.isEmpty()
    strings = stored(strings) if has_hot else strings
    cool = strings.filter("least IS NOT NULL").repartition("least").sortWithinPartitions("least")
    spans = cool.mapInArrow(_count(size), _SPANS)
    if has_hot:
        single = strings.filter("least IS NULL").drop("least")
        often = stored(single.groupBy("packed").agg(F.count("*").alias("n")).filter("n > 1").select("packed"))
        hits = single.join(often, "packed")
        spans = spans.union(hits.select(*_KEY, F.col("start").alias("span_start"), (F.col("start") + size).alias("span_end")))
    spans = stored(spans)
    by_row = spans.distinct().groupBy(*_KEY).agg(F.collect_list(F.struct("span_start", "span_end")).alias("spans"))
    by_row = by_row.select(F.col("doc_id").alias("span_doc"), F.col("text_hash").alias("span_hash"), "spans")
    same = known["doc_id"].eqNullSafe(by_row["span_doc"]) & (known["text_hash"] == by_row["span_hash"])
    joined = known.join(by_row, same, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
