"""Best-fit packing of token sequences by hierarchical merging of underfull bins.

Each scan task packs its own pieces, the longest first, each into the fullest bin that holds it. Bins with at
most ``slack`` free tokens are final. The others travel on as items: groups of them meet, are packed by
best fit once more, and so on up a tree. Only bins travel, never pieces or texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import chunks, stored, texts_of
from sluiceway.llm.tokens import encoder

_PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, offset bigint, settled boolean"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: longest first, each into the bin it fills best."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_free = 0  # bit f is set if a bin has f tokens free
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        fits = open_free >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                open_free ^= 1 << free
        else:
            free, b = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = b, fills[b]
        fills[b] += n
        if free > n:
            by_free[free - n].append(b)
            open_free |= 1 << (free - n)
    return bins, offsets, np.array(fills, np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int) -> Iterator[tuple]:
    """Arrays of (doc_id, piece, start, length, crc) of the pieces of each part of the input."""
    code = encoder(vocabulary, blanks=False)
    for batch in batches:
        for part in chunks(batch, "text"):
            ids, counts = code.encode(texts_of(part))
            own = memoryview(np.insert(ids, np.cumsum(counts), np.uint32(end_id)).astype("<u4")).cast("B")
            rows, at = [], 0
            for doc_id, n in zip(part["doc_id"].to_pylist(), (counts + 1).tolist(), strict=True):
                for number, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    rows.append((doc_id, number, start, length, zlib.crc32(own[4 * (at + start) : 4 * (at + start + length)])))
                at += n
            yield rows


def _local(vocabulary: str, end_id: int, capacity: int, slack: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list = []
        numbers: list[np.ndarray] = []
        for rows in _pieces(batches, vocabulary, end_id, capacity):
            doc_ids += [r[0] for r in rows]
            numbers.append(np.array([r[1:] for r in rows], np.int64).reshape(-1, 4))
        if not doc_ids:
            return
        pieces = np.concatenate(numbers)
        bins, offsets, fills = best_fit(pieces[:, 2], capacity)
        first = TaskContext.get().partitionId() << 33
        settled = fills[bins] >= capacity - slack
        for i in range(0, len(doc_ids), 50_000):
            s = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids[s], pa.int64()), pa.array(pieces[s, 0].astype(np.int32)), pa.array(pieces[s, 1]), pa.array(pieces[s, 2]),
                    pa.array(pieces[s, 3]), pa.array(first + bins[s]), pa.array(offsets[s]), pa.array(settled[s]),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "settled"],
            )

    return pack


def _merged(capacity: int, slack: int, carry: int, last: bool):
    """One node of the tree: bins as items. Passes on at most ``carry`` underfull bins, the emptiest; the others are final."""

    def pack(bins):
        bins = bins.sort_values(["fill", "bin"], ascending=[False, True], ignore_index=True)
        number, offset, fills = best_fit(bins["fill"].to_numpy(), capacity)
        name = np.zeros(len(fills), np.int64)
        name[number[::-1]] = bins["bin"].to_numpy()[::-1]  # a bin goes by its first item
        up = np.zeros(len(fills), bool)
        if not last:
            up[np.argsort(fills, kind="stable")[:carry]] = True
            up &= fills < capacity - slack
        return bins.assign(parent=name[number], shift=offset, parent_fill=fills[number], up=up[number])[["bin", "parent", "shift", "parent_fill", "up"]]

    return pack


def _settle(residual: DataFrame, capacity: int, slack: int, fan_in: int, carry: int) -> DataFrame | None:
    """Where each underfull bin ends up: ``bin, sequence, shift``.

    Groups follow the number of the task that made a bin, so bins meet in the same tree on every run.
    """
    level, total, divisor = residual, None, fan_in
    top = residual.agg(F.max(F.shiftright("bin", 33)).alias("top")).first()["top"]
    if top is None:
        return None
    while True:
        last = top < divisor
        node = F.expr(f"shiftright(bin, 33) div {divisor}")
        packed = stored(
            level.withColumn("node", node).groupBy("node").applyInPandas(
                _merged(capacity, slack, carry, last), "bin bigint, parent bigint, shift bigint, parent_fill bigint, up boolean"
            )
        )
        step = packed.select("bin", "parent", "shift")
        if total is None:
            total = step.select("bin", F.col("parent").alias("sequence"), "shift")
        else:
            moved = step.select(F.col("bin").alias("sequence"), "parent", F.col("shift").alias("more"))
            total = stored(
                total.join(moved, "sequence", "left").select(
                    "bin", F.coalesce("parent", "sequence").alias("sequence"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
                )
            )
        if last:
            return total
        level = packed.filter("up").groupBy(F.col("parent").alias("bin")).agg(F.max("parent_fill").alias("fill"))
        divisor *= fan_in


def packed_sequences(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 0,
    slack: int = 8,
    fan_in: int = 64,
    carry: int = 20_000,
) -> DataFrame:
    """Every piece of every document of ``docs`` (doc_id, text) with its place in a sequence of at most ``capacity`` ids.

    A document is its ids by the vocabulary, then ``end_id``; only longer ones are cut, every ``capacity`` ids.
    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``; the offsets of a sequence run without a
    gap from 0. A null text is empty, so its piece is the end id alone; a null doc_id stays null; repeated rows
    are packed each; other columns are not read; an empty table gives no rows.

    A task holds five numbers for each piece of its own scan partition. A node of the tree holds at most
    ``fan_in * carry`` bins: a node passes on its ``carry`` emptiest bins and settles the others as they are, so the
    bound costs room in sequences but no rows.
    """
    placed = stored(docs.select("doc_id", "text").mapInArrow(_local(vocabulary, end_id, capacity, slack), _PLACED))
    settled = placed.filter("settled").withColumn("sequence_id", F.col("bin"))
    residual = placed.filter("NOT settled")
    level = stored(residual.groupBy("bin").agg(F.sum("length").alias("fill")))
    moves = _settle(level, capacity, slack, fan_in, carry)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    if moves is None:
        return settled.select(columns)
    moved = residual.join(moves, "bin").withColumn("sequence_id", F.col("sequence")).withColumn("offset", F.col("offset") + F.col("shift"))
    return settled.select(columns).unionByName(moved.select(columns))
