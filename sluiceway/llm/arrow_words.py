"""Words of texts by Arrow kernels, whole batches at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sluiceway.llm.shared import chunks

# What stands between words once A-Z are lower case: all of ASCII but digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts, one after the other, and the number of each one's text. Only A-Z become lower case; a null text has none."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), _BETWEEN)
    found, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    keep = pc.greater(pc.binary_length(found), 0)  # a separator at either end leaves an empty piece
    return found.filter(keep), parents.filter(keep).to_numpy().astype(np.int64)


def worded(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Slices of batches that hold a bounded amount of text (or one longer text), with their words."""
    for batch in batches:
        for part in chunks(batch, column):
            yield part, *words_of(part[column])
