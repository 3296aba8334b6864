"""Equal-width histograms over the observed range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, bins: int, by: dict[str, Column] | None = None) -> DataFrame:
    """Rows (bin, lower, upper, <by>, n) for non-empty bins 0..bins-1; the last bin is closed.

    The range comes from one aggregate used as a scalar subquery; counting is a
    hash aggregate on the bin, combined before the exchange.
    """
    known = df.where(F.col(value).isNotNull())
    lo = known.agg(F.min(value)).scalar()
    hi = known.agg(F.max(value)).scalar()
    width = (F.col("_hi") - F.col("_lo")) / bins
    spot = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1))
    ).cast("int")
    by = by or {}
    keyed = known.withColumns({"_lo": lo, "_hi": hi})
    return (
        keyed.select(spot.alias("bin"), "_lo", "_hi", *[c.alias(k) for k, c in by.items()])
        .groupBy("bin", "_lo", "_hi", *by)
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (F.col("_lo") + F.col("bin") * width).alias("lower"),
            (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
            *by,
            "n",
        )
    )
