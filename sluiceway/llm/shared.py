"""What the operators of this folder share: stored frames, files in the shared folder, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from sluiceway.sources.tables import scratch, store

#: Characters of text that a task turns into Python objects at a time.
CHUNK_CHARS = 2_000_000


def fresh_folder(spark: SparkSession) -> str:
    """A new name in the shared scratch folder; ``tables.clear_scratch`` deletes what was written there."""
    return scratch(spark)


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lost executors cost no recomputation, and its size is known.

    ``compression`` names another codec than the session's, for texts.
    """
    if compression is None:
        return store(df)
    path = scratch(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that a URI or local path names, and the path in it."""
    if uri.startswith("file:"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    elif not re.match(r"[a-z][a-z0-9+.-]*://", uri):
        uri = "file://" + uri
    return fs.FileSystem.from_uri(uri)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n + 64
    if start < len(sizes):
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch[column].to_pylist()]
