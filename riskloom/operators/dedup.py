"""Keep-first deduplication and duplicate counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, first_by: list[str] | None = None) -> DataFrame:
    """One row per key (null is a key): the first by ``first_by``, then by all other columns.

    The order is total up to identical rows, so the survivor does not depend on
    partitioning. ``row_number() = 1`` is planned with a group limit on both
    sides of the exchange: each map task forwards at most one row per key, so
    copies of one key, however many, never meet in a single task.
    """
    leading = [c for c in (first_by or []) if c != key]
    order = leading + [c for c in df.columns if c != key and c not in leading]
    # the hash leads the sort: ids that share their first bytes would otherwise
    # all need a full comparison
    window = Window.partitionBy(F.xxhash64(key), key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.select("*", F.row_number().over(window).alias("_rank")).where("_rank = 1").drop("_rank")


def surplus_rows(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows go beyond the first of their key (null is a key)."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus"))
