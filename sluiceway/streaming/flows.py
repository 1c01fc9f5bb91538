"""File streams into tables.

Stateless steps (projection, explode, enrichment, rules) are the batch functions of ``plans``;
windows over rows belong after the hand-over to a batch table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.config import Settings
from sluiceway.operators.quarantine import with_verdict
from sluiceway.operators.rules import Rule, metric_rows, observe
from sluiceway.plans import contractors
from sluiceway.sources import versions
from sluiceway.sources.tables import refuse_other_owner, write_json
from sluiceway.sources.versions import BATCH

METRICS = "dataset string, rule string, action string, passed long, failed long"


def append_available(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything that has arrived to a file sink, exactly once; returns the finished query."""
    refuse_other_owner(stream.sparkSession, path, streamed=True)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_available(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``append_available``, then the table as a batch frame."""
    append_available(stream, path, checkpoint, partition_by)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hand every micro-batch to a batch function. It must give the same result if called again."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_table(spark: SparkSession, path: str) -> DataFrame:
    """A table that micro-batches wrote, one directory each; columns that only some of them have are NULL elsewhere."""
    known = versions.merged(spark, path)
    reader = spark.read.schema(known) if known else spark.read.option("mergeSchema", True)  # tables from before schemas were noted
    return reader.parquet(path).drop(BATCH)


def append_counted(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    rule_set: Sequence[Rule],
    dataset: str,
    counts: str,
    read: Callable[[DataFrame], DataFrame] | None = None,
) -> list[int]:
    """Append everything that has arrived, and what its rules count, both kept for every micro-batch.

    ``read`` turns a micro-batch into the rows to write. Each batch overwrites its own directories below
    ``path`` and ``counts``: one that is run twice is there once. A batch's counts hold its number in ``_batch``. Returns the numbers of the batches that ran.
    """
    ran: list[int] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        watched, observation = observe(read(batch) if read else batch, rule_set)
        with ThreadPoolExecutor(1) as pool:  # the note does not keep the rows waiting; both are there before the batch ends
            noted = pool.submit(versions.log_schema, batch.sparkSession, path, batch_id, watched.schema)
            watched.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            noted.result()
        write_json(batch.sparkSession, f"{counts}/{BATCH}={batch_id}", metric_rows(rule_set, dataset, observation.get), METRICS)
        ran.append(batch_id)

    run_batches(stream, checkpoint, each)
    return ran


def once_per_key(stream: DataFrame, key: str, spread: Sequence[str] = (), salts: int = 1) -> DataFrame:
    """The first row seen per key, for the life of the checkpoint; the state holds every key.

    With ``salts`` the copies of a hot key are first thinned out in that many lanes, taken from a
    hash of ``spread``, before the survivors meet in one task. ``spread`` should differ between
    copies, as the file they came from does.
    """
    if salts > 1:
        lane = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
        stream = stream.withColumn("_lane", lane).dropDuplicates([key, "_lane"]).drop("_lane")
    return stream.dropDuplicates([key])


def once_per_key_within(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """The first row per key, forgetting keys that are older than the watermark; bounded state."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def split_stream(
    stream: DataFrame, rule_set: Sequence[Rule], settings: Settings, path: str, checkpoint: str
) -> DataFrame:
    """Good rows and quarantine in one pass: one sink, partitioned by the verdict.

    The source is read once, nothing is cached, and the sink keeps its exactly-once promise. Use
    ``good_rows`` and ``bad_rows`` on the result; each reads its own partition only.
    """
    return run_available(with_verdict(stream, rule_set, settings.processed_at), path, checkpoint, ["_verdict"])


def works_orders_stream(sources: Mapping[str, DataFrame], zones: DataFrame, settings: Settings) -> DataFrame:
    """All contractors' streams as one, conformed and enriched from the stored zone table."""
    return contractors.with_zone_id(contractors.conformed_orders(sources), zones, settings)
