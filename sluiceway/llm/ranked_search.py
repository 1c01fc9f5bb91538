"""Ranked lexical search with bag deduplication: documents that look alike to the items are scored once.

A document is restricted to the words of the items; what counts is how often it holds each of them, and its length in steps of
the score's formula. Documents equal in both form a class: rows meet by a hash and are grouped by the whole vector. Only a class's first
members can be among the best, so no class holds more than ``k``. Tasks score blocks of classes against all items of a pass and
keep the best for each item; members are expanded in ascending doc_id at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.arrow_words import worded
from sluiceway.llm.shared import stored

_BAG = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
_ITEM = "item_id bigint, terms array<string>, tfs array<bigint>"
_BEST = "item int, score bigint, members array<struct<unnamed: boolean, doc_id: bigint>>"
_SCALE = 1_000_000_000


def counted_terms(codes: np.ndarray, parents: np.ndarray, width: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each row holds each code: offsets by row, codes, counts."""
    held, tf = np.unique(parents * width + codes, return_counts=True)
    row, code = np.divmod(held, max(1, width))
    return np.searchsorted(row, np.arange(rows + 1)).astype(np.int32), code, tf.astype(np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms, tfs`` of every item: its different words and how often it holds them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, parents in worded(batches):
            coded = pc.dictionary_encode(words)
            codes = coded.indices.to_numpy().astype(np.int64)
            offsets, code, tf = counted_terms(codes, parents, len(coded.dictionary), len(part))
            terms = pa.ListArray.from_arrays(pa.array(offsets), coded.dictionary.take(pa.array(code)))
            yield pa.RecordBatch.from_arrays([part["item_id"], terms, pa.ListArray.from_arrays(pa.array(offsets), pa.array(tf))], ["item_id", "terms", "tfs"])

    return items.select(F.col("item_id").cast("bigint"), "text").mapInArrow(count, _ITEM)


def bags(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``doc_id, n, terms, tfs`` of documents that hold any word: how many, and how often each word of the vocabulary, by its number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, parents in worded(batches):
            n = np.bincount(parents, minlength=len(part))
            number = pc.index_in(words, value_set=vocabulary)
            known = number.is_valid()
            codes = number.filter(known).to_numpy().astype(np.int64)
            offsets, code, tf = counted_terms(codes, parents[known.to_numpy(zero_copy_only=False)], len(vocabulary), len(part))
            lists = [pa.ListArray.from_arrays(pa.array(offsets), v) for v in (pa.array(code, pa.int32()), pa.array(tf))]
            made = pa.RecordBatch.from_arrays([part["doc_id"], pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])
            yield made.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(count, _BAG)


def classes(found: DataFrame, k: int) -> DataFrame:
    """``m, terms, tfs, members``: each different vector and length step once, with its ``k`` first documents by doc_id.

    The hash only brings rows together: they are one class if their whole vectors are equal. Spark keeps ``k`` rows a class in each
    map task, so a class that holds most of all documents crosses the network as ``k`` rows a task.
    """
    key = ["print", "m", "terms", "tfs"]
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    order = Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id"))
    first = found.withColumn("print", F.xxhash64("m", "terms", "tfs")).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return first.groupBy(*key).agg(F.sort_array(F.collect_list(member)).alias("members")).drop("print")


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = pc.list_value_length(column).to_numpy().astype(np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False)


def _kept(item: np.ndarray, score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of each item's ``k`` best, highest score first, then the smaller first doc_id."""
    order = np.lexsort((first, -score, item))
    own = item[order]
    return order[np.arange(len(order)) - np.searchsorted(own, own) < k]


def scored(found: DataFrame, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, k: int, cells: int) -> DataFrame:
    """The ``k`` best classes of each task for each item: ``item, score, members``.

    Items are given as the numbers of their words, one item after the other from ``offsets`` on. ``cells`` bounds a block.
    """
    last = np.iinfo(np.int64).max

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_once = max(1, cells // max(1, len(terms), len(weights)))
        best = [np.zeros(0, np.int64)] * 3
        members = pa.array([], pa.list_(pa.struct([("unnamed", pa.bool_()), ("doc_id", pa.int64())])))
        for batch in batches:
            for i in range(0, len(batch), at_once):
                block = batch.slice(i, at_once)
                lengths, held = _parts(block["terms"])
                tf, m = _parts(block["tfs"])[1].astype(np.int64), np.repeat(block["m"].to_numpy(), lengths)
                dense = np.zeros((len(weights), len(block)), np.int64)
                dense[held, np.repeat(np.arange(len(block)), lengths)] = weights[held] * ((_SCALE * tf) // (1000 * tf + 8 * m))
                total = np.add.reduceat(dense[terms] * tfs[:, None], offsets, axis=0)
                item, row = np.nonzero(total > 0)
                sizes = pc.list_value_length(block["members"]).to_numpy()
                starts = np.cumsum(sizes) - sizes
                ids = pc.struct_field(block["members"].flatten(), 1).take(pa.array(starts)).fill_null(last).to_numpy()
                merged = [np.concatenate(p) for p in zip(best, (item, total[item, row], ids[row]), strict=True)]
                keep = _kept(*merged, k)
                best = [column[keep] for column in merged]
                owner = np.r_[np.arange(len(members)), len(members) + row][keep]
                members = pa.concat_arrays([members, block["members"].cast(members.type)]).take(pa.array(owner))
        yield pa.RecordBatch.from_arrays([pa.array(best[0], pa.int32()), pa.array(best[1]), members], ["item", "score", "members"])

    return found.mapInArrow(score, _BEST)


def _vocabulary(held: list) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a pass's items, and the items as numbers of words: offsets, words, counts."""
    sizes = np.array([len(row["terms"]) for row in held], np.int64)
    coded = pc.dictionary_encode(pa.array([t for row in held for t in row["terms"]], pa.string()))
    tfs = np.array([n for row in held for n in row["tfs"]], np.int64)
    return coded.dictionary, np.cumsum(sizes) - sizes, coded.indices.to_numpy().astype(np.int64), tfs


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, b_percent: int = 75, pairs_at_once: int = 1 << 18, cells: int = 1 << 21
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    ``docs`` holds doc_id and text, ``items`` item_id and text. Words are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count
    as lower case. N counts the documents with a word, L all their words, n one document's, df the documents that hold a word. A word weighs
    floor(1000 ln((2N + 2) / (2 df + 1))); m is 100 - b + (b n N) div L for b percent; a score sums over the item's words, repeats included, weight times
    (10^9 tf) div (1000 tf + 8 m). Scores of 0 are left out; equal scores go to the smaller doc_id.

    A null or empty document or item has no words and gives no rows. A repeated row is a document, or an item, of its own; a document without
    doc_id comes last among equals. Other columns are not read. Empty tables give no rows.

    Items go in passes, each over all documents: a pass takes items of about ``pairs_at_once`` different words in all, at least one item, and
    that is what comes to the driver and goes to every task. ``cells`` bounds the numbers of a block of scores.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items).filter("size(terms) > 0").withColumn("item", F.monotonically_increasing_id()))
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = max(1, math.ceil(pairs / pairs_at_once))
    best = None
    for number in range(passes):
        held = asked.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).orderBy("item").collect() if pairs else []
        if not held:
            continue
        vocabulary, offsets, terms, tfs = _vocabulary(held)
        found = stored(bags(docs, vocabulary))
        n_docs, n_words = found.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a word of the pass
            df[row["term"]] = row["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        step = F.expr(f"{100 - b_percent} + ({b_percent} * n * {n_docs}L) div {n_words}L").alias("m")
        alike = classes(found.filter("size(terms) > 0").select("doc_id", step, "terms", "tfs"), k)
        names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(held)], "item int, item_id bigint")
        top = scored(alike, offsets, terms, tfs, weights, k, cells)
        # One row a document: k classes a task hold k documents each at most.
        each = top.select("item", "score", F.explode("members").alias("d")).select("item", "score", "d.doc_id")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        chosen = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).join(names, "item")
        chosen = chosen.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        best = chosen if best is None else best.unionByName(chosen)
    return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint") if best is None else best
