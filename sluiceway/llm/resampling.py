"""Importance resampling toward a target by hashed n-grams: how much likelier are a document's features in the target?

Texts go through Arrow kernels a batch at a time: lower case, split by a pattern, flatten, dictionary encoding. Shifted dictionary
indices form the n-grams; only distinct ones are hashed, and what is known of them is taken back to all places, where segments of each
document are summed. Two passes over the documents: one counts buckets, the other weighs documents with the counts of both sides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.arrow_words import worded
from sluiceway.llm.shared import stored

_COUNTS = "bucket int, n bigint"


def features(words: pa.Array, parents: np.ndarray, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every length of runs up to ``longest``: the bucket of each run of consecutive words of one text, and the number of its text.

    A run is named by the number of the run without its last word and the number of that word; each distinct pair is hashed once,
    from the checksum of the shorter run on.
    """
    coded = pc.dictionary_encode(words)
    last = coded.indices.to_numpy().astype(np.int64)
    spelled = [w.encode() for w in coded.dictionary.to_pylist()]
    sums = np.fromiter(map(crc32, spelled), np.uint32, len(spelled))
    runs, text = last, parents
    for length in range(1, longest + 1):
        if length > 1:
            together = np.flatnonzero(parents[length - 1 :] == text[: len(parents) - length + 1]) if len(parents) >= length else np.zeros(0, np.int64)
            # Every run of the shorter length stands where it starts; one longer needs the next word of the same text.
            kept = np.searchsorted(starts, together) if len(together) else together
            pairs = pc.dictionary_encode(pa.array(runs[kept] * len(spelled) + last[together + length - 1]))
            shorter, added = np.divmod(pairs.dictionary.to_numpy(), max(1, len(spelled)))
            spaced = map(crc32, [b" "] * len(shorter), sums[shorter].tolist())
            sums = np.fromiter(map(crc32, [spelled[i] for i in added.tolist()], spaced), np.uint32, len(added))
            runs, text_of = pairs.indices.to_numpy().astype(np.int64), parents[together]
            starts = together
        else:
            starts, text_of = np.arange(len(words)), parents
        yield (sums % np.uint32(buckets)).astype(np.int64)[runs], text_of


def bucket_counts(texts: DataFrame, longest: int = 2, buckets: int = 10_000) -> DataFrame:
    """How many features of all texts fall into each bucket: ``bucket, n``, buckets without any left out.

    Each task sums its own first, so no more than ``buckets`` rows leave it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for _, words, parents in worded(batches):
            for found, _ in features(words, parents, longest, buckets):
                seen += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(seen[held], pa.int64())], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, _COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """A bucket's gain in thousandths of a natural logarithm, from both sides' counts; ``buckets`` rows come to the driver."""
    found = source.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full_outer").collect()
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in found:
        s[row["bucket"]], t[row["bucket"]] = row["s"] or 0, row["t"] or 0
    all_s, all_t = s.sum() + buckets, t.sum() + buckets
    ratios = ((t + 1) * all_s) / ((s + 1) * all_t)
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document, and the columns to ``keep``."""
    columns = ["doc_id", *keep]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, parents in worded(batches):
            n, n_features, total = (np.zeros(len(part), np.int64) for _ in range(3))
            n += np.bincount(parents, minlength=len(part))
            for found, text_of in features(words, parents, longest, len(gain)):
                if not len(found):
                    continue
                first = np.flatnonzero(np.r_[True, text_of[1:] != text_of[:-1]])
                total[text_of[first]] += np.add.reduceat(gain[found], first)
                n_features += np.bincount(text_of, minlength=len(part))
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            made = [pa.array(x, pa.int64()) for x in (n, n_features, weight)]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in columns), *made], [*columns, "n_words", "n_features", "weight"])

    wanted = docs.select(*columns, *(["text"] if "text" not in columns else []))
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return wanted.mapInArrow(weigh, f"{kept}, n_words bigint, n_features bigint, weight bigint")


def placed(df: DataFrame, order: Sequence) -> DataFrame:
    """The place of every row in an order over all of them, as ``rank`` from 1.

    Rows are dealt out by ranges of the order; the sizes of the ranges before a row's own, and its place among the rows of its own, make the rank.
    """
    dealt = stored(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return dealt.withColumn("__own", own).join(sizes, "__range").withColumn("rank", F.col("__own") + F.col("__before")).drop("__range", "__own", "__n", "__before")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    longest: int = 2,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: int = 7,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Draw ``percent`` of the documents of at least ``least_words`` words, without replacement, likelier the more they look like ``target``:
    ``doc_id, n_features, weight, score, rank`` and the columns to ``keep``; rank is null for documents that are not drawn.

    ``docs`` holds doc_id and text, ``target`` text. Words are runs of ASCII letters and digits and of all characters beyond ASCII, features all runs
    of 1 to ``longest`` consecutive words, hashed into ``buckets``. The weight is the floored mean gain of a document's features, 0 if it has none.
    The score adds a Gumbel variate from a hash of ``seed`` and doc_id, so the highest scores are a weighted draw; ties go to the smaller doc_id,
    then the smaller weight and number of features.

    A null or empty text has no features and is never drawn. A row without doc_id has the variate of an empty id, and loses ties. A repeated row is a
    document of its own, with the same score. Other columns are not read. No documents give no rows; without a target all counts of it are 0.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))
    # The range partitioning below looks at its input twice; the texts are not read again for that.
    scored = stored(weighed(docs, gain, longest, keep).withColumn("score", score).withColumn("__row", F.monotonically_increasing_id()))
    eligible = scored.filter(F.col("n_words") >= least_words)
    drawn = eligible.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("__row")]
    ranked = placed(eligible, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", F.col("rank").cast("bigint").alias("rank"), *keep)
