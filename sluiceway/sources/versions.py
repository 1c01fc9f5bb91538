"""The schemas of a table that micro-batches write, kept beside its rows: one small file a batch, so that no reader merges footers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sluiceway.operators.conform import union_all
from sluiceway.operators.widen import as_type
from sluiceway.sources.tables import exists, few_rows

BATCH = "_batch"
_LOG = f"types string, schema string, {BATCH} int"


def _folder(path: str) -> str:
    return f"{path}/_schemas"  # readers of the table skip names that begin so


def log_schema(spark: SparkSession, path: str, batch_id: int, schema: StructType) -> None:
    """Note the schema a batch is written with, before the batch has ended. A batch that is run again notes it again."""
    row = [(json.dumps([(f.name, f.dataType.simpleString()) for f in schema.fields]), schema.json())]
    log = few_rows(spark, row, "types string, schema string")
    log.write.mode("overwrite").parquet(f"{_folder(path)}/{BATCH}={batch_id}")


def versions(spark: SparkSession, path: str) -> list[tuple[int, int, StructType]]:
    """First batch, last batch and newest schema of each version, in order; a version is a list of columns and types.

    The driver gets one row a version, however many batches there are.
    """
    if not exists(spark, _folder(path)):
        return []
    log = spark.read.schema(_LOG).parquet(_folder(path))
    found = log.groupBy("types").agg(F.min(BATCH).alias("a"), F.max(BATCH).alias("z"), F.max_by("schema", BATCH).alias("schema"))
    return sorted(((r["a"], r["z"], StructType.fromJson(json.loads(r["schema"]))) for r in found.collect()), key=lambda v: v[:2])


def newest(spark: SparkSession, path: str) -> StructType | None:
    """The schema of the last batch."""
    return max(versions(spark, path), key=lambda v: v[1], default=(0, 0, None))[2]


def merged(spark: SparkSession, path: str) -> StructType | None:
    """All columns that batches have had, the earlier first; None if a batch has no note. For tables whose types stay."""
    found = versions(spark, path)
    if not found or found[0][0] > 0:
        return None
    fields: dict[str, StructField] = {}
    for _, _, schema in found:
        for field in schema.fields:
            fields.setdefault(field.name, field)
    return StructType(list(fields.values()))


def read_widened(spark: SparkSession, path: str, up_to: int | None = None) -> DataFrame:
    """A table whose types have only widened, every value in the newest type, or as the table stood after batch ``up_to``.

    Each version is read with the types its files have, and only its own batches.
    """
    found = [v for v in versions(spark, path) if up_to is None or v[0] <= up_to]
    if not found:
        raise ValueError(f"{path} holds no batch")
    want = found[-1][2]
    frames = []
    for first, last, schema in found:
        have = {field.name: field.dataType for field in schema.fields}
        rows = spark.read.schema(StructType([*schema.fields, StructField(BATCH, IntegerType())])).parquet(path)
        rows = rows.where(F.col(BATCH).between(first, last if up_to is None else min(last, up_to)))
        columns = [
            (as_type(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        frames.append(rows.select(*columns))
    return union_all(frames)


def version_log(spark: SparkSession, path: str) -> DataFrame:
    """What each version changed: ``version, first_batch, column_name, change, type_before, type_after``; change is new or widened."""
    rows, before = [], {}
    for number, (first, _, schema) in enumerate(versions(spark, path)):
        for field in schema.fields:
            kind = field.dataType.simpleString()
            if before.get(field.name) != kind:
                rows.append((number, first, field.name, "widened" if field.name in before else "new", before.get(field.name), kind))
                before[field.name] = kind
    names = "version int, first_batch int, column_name string, change string, type_before string, type_after string"
    return spark.createDataFrame(rows, names)
