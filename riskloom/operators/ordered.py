"""Running totals over an ordered column, split into slices of even size.

A running total in one window would send a whole group through one task. Here
the table, one row per distinct value, is range-partitioned by group and value,
so slices are cut by numbers of distinct values whatever the rows behind them.
It is stored once with its slice number; totals run inside each slice, and the
totals of the slices before are added from a small table. As the slices are
stored, they stay the same when a lost executor's work is repeated, and they
only decide which task does what, never the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import scratch_path


def stored_slices(df: DataFrame, group: str, order: str, slices: int | None = None) -> DataFrame:
    """``df`` (one row per group and value) written in ranges, with its ``_slice``.

    This runs the work behind ``df``, once. Without a number of slices their
    size follows the session's partition sizes.
    """
    keys = [group, order]
    ranged = df.repartitionByRange(slices, *keys) if slices else df.repartitionByRange(*keys)
    path = scratch_path(df.sparkSession, "slices")
    ranged.withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running_totals(stored: DataFrame, group: str, order: str, measures: list[str]) -> DataFrame:
    """Add inclusive running totals ``cum_<measure>`` and the next value ``next_<order>`` to stored slices."""
    local = Window.partitionBy(group, "_slice").orderBy(order)
    run = stored.withColumns({
        **{f"cum_{m}": F.sum(m).over(local.rowsBetween(Window.unboundedPreceding, 0)) for m in measures},
        f"next_{order}": F.lead(order).over(local),
    })
    totals = stored.groupBy(group, "_slice").agg(
        *[F.sum(m).alias(m) for m in measures], F.min(order).alias("_first")
    )
    across = Window.partitionBy(group).orderBy("_slice")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        group,
        "_slice",
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        F.lead("_first").over(across).alias("_next_first"),
    )
    # one row per slice and group, so at most as many as slices and groups together
    joined = run.join(F.broadcast(carried), [group, "_slice"])
    return joined.withColumns({
        **{f"cum_{m}": F.col(f"cum_{m}") + F.col(f"_before_{m}") for m in measures},
        f"next_{order}": F.coalesce(F.col(f"next_{order}"), F.col("_next_first")),
    }).drop("_slice", "_next_first", *[f"_before_{m}" for m in measures])
