"""Large work in turns: a table stored by the hash of a key is taken a few slots at a time.

Each turn's shuffle files are removed when it has ended, so the disk holds those
of one turn beside the compressed tables, not those of the whole job. A small
table is one turn.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

SLOTS = 16
TURN_ROWS = 5_000_000  # at least, but in the last turn
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(parts: Iterable[DataFrame], label: str, key: str | None = None) -> DataFrame:
    """The parts, of one layout, as one table below the shared folder; by slots of ``key`` if given, for ``in_turns``."""
    path, schema, spark = None, None, None
    for part in parts:
        spark = part.sparkSession
        path = path or scratch_path(spark, label)
        if key:
            part = part.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int"))
        schema = part.schema
        writer = part.write.mode("append").option("compression", "zstd")
        with shuffles_removed(spark):
            (writer.partitionBy("_slot") if key else writer).parquet(path)
    return spark.read.schema(schema).parquet(path)


def in_turns(table: DataFrame) -> Iterator[DataFrame]:
    """The rows of a table stored by slots, all of a key in one turn; an empty table is one turn."""
    with shuffles_removed(table.sparkSession):
        rows = dict(table.groupBy("_slot").count().collect())  # one row per slot
    first = held = 0
    for slot in range(SLOTS):
        held += rows.get(slot, 0)
        if held >= TURN_ROWS or slot == SLOTS - 1 and (held or not first):
            yield table.where(F.col("_slot").between(first, slot)).drop("_slot")
            first, held = slot + 1, 0
