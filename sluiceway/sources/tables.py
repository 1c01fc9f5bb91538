"""Stored tables: scratch copies, overwrites, appends, definitions."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.operators.layout import cluster_rows

_SCRATCH = "spark.checkpoint.dir"
_MADE: list[str] = []


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sluiceway-")


def scratch(spark: SparkSession) -> str:
    """A fresh directory below the folder that the cluster names for checkpoints.

    A local session without that setting gets a temporary folder; a cluster must name one that
    all executors share.
    """
    base = spark.conf.get(_SCRATCH, None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {_SCRATCH} to a folder that all executors share")
        base = _local_folder()
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def store(df: DataFrame, name: str = "part") -> DataFrame:
    """Write a frame to scratch and read it back.

    Cuts the lineage, lets several readers share one computation, and tells Spark the real size,
    from which it decides about broadcasts.
    """
    path = f"{scratch(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of rows of texts and whole numbers, in one partition; a literal of the plan, for which no Python worker is started."""
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(json.dumps(_named(rows, schema))), f"array<struct<{schema}>>")))


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame that the optimizer sees is empty."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).where(F.lit(False))


def _named(rows: Sequence[tuple], schema: str) -> list[dict]:
    names = StructType.fromDDL(schema).names
    return [dict(zip(names, row, strict=True)) for row in rows]


def write_json(spark: SparkSession, folder: str, rows: Sequence[tuple], schema: str) -> None:
    """Replace a folder by one file of a handful of rows as JSON lines, without a job."""
    remove(spark, folder)
    text = "".join(f"{json.dumps(row)}\n" for row in _named(rows, schema))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/rows.json")
    file = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        file.write(bytearray(text.encode()))
    finally:
        file.close()


def store_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Store several independent frames, their jobs side by side."""
    with ThreadPoolExecutor(len(frames)) as pool:
        stored = {name: pool.submit(store, df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in stored.items()}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever the session's file systems find it; nothing if it does not exist."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder within one file system, no row is read; tells whether there was one."""
    start, end = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in (source, target))
    system = start.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(start):
        return False
    system.mkdirs(end.getParent())
    if not system.rename(start, end):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def children(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []


def refuse_other_owner(spark: SparkSession, path: str, streamed: bool) -> None:
    """Stop if a folder belongs to the other kind of writer: a stream's file sink lists its files there, an overwrite would break that list,
    and rows beside it would not be seen."""
    of_a_stream = exists(spark, f"{path}/_spark_metadata")
    if of_a_stream and not streamed:
        raise ValueError(f"{path} is appended to by a stream; write elsewhere")
    if streamed and not of_a_stream and exists(spark, f"{path}/_SUCCESS"):
        raise ValueError(f"{path} is a recomputed table; a stream needs a folder of its own")


def scratch_mark() -> int:
    """How many copies this process has made so far; see ``clear_scratch``."""
    return len(_MADE)


def clear_scratch(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> None:
    """Delete the copies this process has put into scratch since a mark, but for some; call it when what reads them is written."""
    base = (spark.conf.get(_SCRATCH, None) or _local_folder()).rstrip("/")
    for at in range(since, len(_MADE)):
        if _MADE[at].startswith(f"{base}/") and _MADE[at] not in keep:
            remove(spark, _MADE[at])
            _MADE[at] = ""


def overwrite(
    df: DataFrame, path: str, cluster_by: Sequence[str] = (), spread: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace a recomputed table and read it back. ``df`` must not read from ``path``."""
    placed = cluster_rows(df, cluster_by, spread or cluster_by) if cluster_by else df
    placed.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_schema(spark: SparkSession, name: str, location: str, comment: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{comment}' LOCATION '{location}'")


def create_table(spark: SparkSession, name: str, schema: StructType, comment: str) -> None:
    """Create a table with NOT NULL columns and comments unless it exists."""
    columns = []
    for field in schema.fields:
        required = "" if field.nullable else " NOT NULL"
        note = f" COMMENT '{field.metadata['comment']}'" if "comment" in field.metadata else ""
        columns.append(f"`{field.name}` {field.dataType.simpleString()}{required}{note}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet COMMENT '{comment}'")


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def seed_if_empty(spark: SparkSession, table: str, seed: DataFrame) -> bool:
    """Append the founding rows unless the table already holds any; safe to call again."""
    if not spark.read.table(table).isEmpty():
        return False
    append(seed, table)
    return True
