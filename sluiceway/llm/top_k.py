"""Exact top-k inner products by tiles: blocks of queries against shards of rows, then merging of top lists up a tree."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import stored

#: Whole numbers that a double holds exactly.
EXACT = 2**53
_FOUND = "query bigint, query_id bigint, node bigint, vec_id bigint, score bigint"


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices: by doubles where those are exact, else by Python integers.

    Sums beyond the range of a long become its nearest bound.
    """
    most = np.abs(left.astype(float)).max(initial=0) * np.abs(right.astype(float)).max(initial=0) * left.shape[1]
    if most < EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    wide = left.astype(object) @ right.astype(object).T
    bounds = np.iinfo(np.int64)
    return np.clip(wide, bounds.min, bounds.max).astype(np.int64)


def best_of_tile(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best of each row, ties to the left; ``own`` marks entries that don't count."""
    lowest = np.iinfo(np.int64).min
    scores = np.where(own, lowest, scores)
    width = scores.shape[1]
    least = np.partition(scores, width - k, axis=1)[:, width - k] if width > k else np.full(len(scores), lowest)
    row, column = np.nonzero((scores >= least[:, None]) & ~own)
    order = np.lexsort((column, -scores[row, column].astype(float), row))
    if np.abs(scores[row, column].astype(float)).max(initial=0) >= EXACT:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], -int(scores[row[i], column[i]]), column[i])), np.int64)
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return row[keep], column[keep]


def _matrix(parts: pa.ChunkedArray) -> np.ndarray:
    values = pa.concat_arrays([chunk.flatten() for chunk in parts.chunks])
    return values.to_numpy(zero_copy_only=False).reshape(len(parts), -1)


def _tile(k: int, cells: int):
    def search(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], [], []]
        if len(queries) and len(rows):
            rows = rows.take(pa.array(np.argsort(rows["vec_id"].to_numpy(), kind="stable")))
            ids, right = rows["vec_id"].to_numpy(), _matrix(rows["parts"])
            numbers, names, left = queries["q_row"].to_numpy(), queries["q_vec_id"].to_numpy(), _matrix(queries["q_parts"])
            rows_at_once = max(1, cells // len(right))  # short vectors make tall tiles: bound the scores as well
            for i in range(0, len(left), rows_at_once):
                part = slice(i, i + rows_at_once)
                scores = products(left[part], right)
                r, c = best_of_tile(scores, names[part, None] == ids[None, :], k)
                shard = np.full(len(r), key[2].as_py())
                for column, values in zip(found, (numbers[part][r], names[part][r], shard, ids[c], scores[r, c]), strict=True):
                    column.append(values)
        merged = [pa.array(np.concatenate(c) if c else np.zeros(0), pa.int64()) for c in found]
        return pa.Table.from_arrays(merged, names=["query", "query_id", "node", "vec_id", "score"])

    return search


def top_k(
    vectors: DataFrame, k: int = 5, query_every: int = 50, scale: float = 256.0, tile_cells: int = 1 << 22, fan_in: int = 64
) -> DataFrame:
    """The ``k`` best rows for each query: ``query_id, rank, vec_id, score``, ties to the smaller vec_id.

    ``vectors`` holds vec_id and embedding. Components become floor(scale * x); the score is their integer inner
    product. Queries are the rows whose vec_id is divisible by ``query_every``; candidates all rows with another vec_id
    and as many components. Vectors that are null or hold null, NaN or infinite components take no part, nor do
    rows without vec_id. A repeated row is a candidate, and a query, of its own. Other columns are not read. No
    vectors, or only one, give no rows.

    A tile is ``tile_cells`` components of queries against as many of rows. Each side is sent once for each block of the
    other, so what crosses the network is the larger the smaller the tiles are: with 768 components a row goes out once for every 5,461 queries.
    A task holds a tile's two sides, about 32 MB each as numbers, and at most as many scores at once; only a single vector longer than the bound goes beyond it.
    """
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    clean = stored(
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
        .select(F.col("vec_id").cast("bigint"), parts.alias("parts"))
        .withColumn("dim", F.size("parts"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    is_query = F.col("vec_id") % query_every == 0
    size = clean.agg(F.count("*").alias("rows"), F.count_if(is_query).alias("queries"), F.max("dim").alias("dim")).first()
    at_once = max(1, tile_cells // max(1, size["dim"] or 1))
    n_shards, n_blocks = max(1, math.ceil(size["rows"] / at_once)), max(1, math.ceil(size["queries"] / at_once))
    shard, block = (F.pmod(F.xxhash64("row"), F.lit(n)) for n in (n_shards, n_blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    rows = clean.withColumn("shard", shard).withColumn("block", every(n_blocks))
    queries = clean.filter(is_query).withColumn("block", block).withColumn("shard", every(n_shards))
    key = ["dim", "block", "shard"]
    queries = queries.toDF(*(f"q_{name}" for name in queries.columns))  # else the two sides share columns
    found = queries.groupBy(*(f"q_{name}" for name in key)).cogroup(rows.groupBy(*key)).applyInArrow(_tile(k, tile_cells), _FOUND)
    order = [F.desc("score"), F.asc("vec_id")]
    while n_shards > 1:
        n_shards = math.ceil(n_shards / fan_in)
        found = found.withColumn("node", F.expr(f"node div {fan_in}"))
        place = F.row_number().over(Window.partitionBy("query", "query_id", "node").orderBy(*order))
        found = found.withColumn("place", place).filter(F.col("place") <= k).drop("place")
    rank = F.row_number().over(Window.partitionBy("query", "query_id").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
