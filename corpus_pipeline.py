"""From raw documents to packed training sequences: five stages, each one operator, each on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import alignment, darts, guess_cost, langid, packing
from sluiceway.llm.queries import prepared, table
from sluiceway.llm.shared import stored
from sluiceway.operators.dedup import keep_first
from sluiceway.sources.tables import clear_scratch, scratch, scratch_mark


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: those without a letter, those that every language's regression rejects by a negative decision
    (unless they are short and nearly all their n-grams are known), and those with less than half of their n-grams known."""
    prepared(spark)
    return langid.with_language(docs, least=0.5, known=0.5, short=200, clear=0.85)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest doc_id stays, one row for each of its texts (the least of the others'
    columns); rows without doc_id stay."""
    prepared(spark)
    classes = darts.near_duplicates(docs, threshold=0.8, words=5)
    stays = stored(classes.filter("doc_id = class_id").groupBy("doc_id").agg(F.count("*").alias("n")))
    named = docs.filter("doc_id IS NOT NULL")
    # A merge join whatever the sizes: a short list of documents would be broadcast, a long one not, and the cost would jump.
    single = stays.filter("n = 1").select(F.col("doc_id").alias("__kept")).hint("merge")
    kept = named.join(single, named["doc_id"] == single["__kept"], "left_semi")
    repeated = stays.filter("n > 1").select(F.col("doc_id").alias("__kept"))
    if not repeated.isEmpty():
        rows = named.join(repeated, named["doc_id"] == repeated["__kept"], "left_semi")
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        kept = kept.unionByName(keep_first(rows, ["doc_id", "text"], others or ["doc_id"]))
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go. That is judged, and joined, by the text: other texts under the same doc_id, or
    without one, stay."""
    prepared(spark)
    print_of = F.xxhash64("text")
    found = alignment.contaminated(docs.select(print_of.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = stored(found.select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(gone, print_of == gone["__gone"], "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    prepared(spark)
    return guess_cost.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its place in a sequence of at most 2048 tokens."""
    prepared(spark)
    return packing.packed_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("pack", pack),
]

#: Language, signatures, alignment and tokens are beyond SQL; a test holds the whole run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on the table ``documents``.

    What each other stage keeps is written to the shared folder and read again; what the stage needed itself is deleted then.
    """
    docs, mark = table(prepared(spark), sf_dir, "documents"), scratch_mark()
    for _, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        folder = scratch(spark)
        kept.write.mode("overwrite").parquet(folder)
        clear_scratch(spark, since=mark, keep=[folder])
        docs = spark.read.schema(kept.schema).parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
