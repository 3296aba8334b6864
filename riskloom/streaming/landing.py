"""Streams into bronze, and deduplication on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.sources import lake

FIRST_STAGE_PARTS = 64


def land_stream(
    stream: DataFrame, root: str, label: str, checkpoint: str,
    users_count: int = 0, merchants_count: int = 0, **trigger,
) -> StreamingQuery:
    """Land every micro-batch as a bronze batch with its own ledger entry.

    Batch ids derive from the stream's batch number, so a batch repeated after
    a failure replaces itself.
    """
    def write(batch: DataFrame, number: int) -> None:
        landed = lake.land_batch(batch, root, f"batch_{label}_{number:012d}", replay=True)
        lake.append_audit(batch.sparkSession, root, landed, users_count, merchants_count)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def deduplicated(stream: DataFrame, key: str = "transaction_id", delay: str = "1 day") -> DataFrame:
    """First arrival per key within the watermark.

    Two stages: copies are first dropped per key and input part, then per key.
    A key delivered very often is thus spread over many tasks, and only one row
    per part goes on to the task that owns the key.
    """
    marked = stream.withWatermark("timestamp", delay).withColumn(
        "_part", F.pmod(F.spark_partition_id(), F.lit(FIRST_STAGE_PARTS))
    )
    return (
        marked.dropDuplicatesWithinWatermark([key, "_part"])
        .drop("_part")
        .dropDuplicatesWithinWatermark([key])
    )
