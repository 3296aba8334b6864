"""Drift against a stored profile: quantile sketches stand for the reference, which is not read again.

A profile has one row per feature: how many values, and a KLL sketch of them,
whose size depends on its accuracy and not on the rows. Profiles of batches are
merged, so a reference grows by a batch without its earlier rows. Ranks read off
a sketch are within ``rank_error`` of the true ones with 99 % confidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.drift import BUCKETS, psi

ACCURACY = 400
GRID = 400  # even ranks at which a distribution is read off its sketch
PROFILE = "feature string, n bigint, sketch binary"


def rank_error(accuracy: int = ACCURACY) -> float:
    """Normalised error of a rank, as published for KLL sketches (double-sided): 2.446 / k^0.9433."""
    return 2.446 / accuracy**0.9433


def profile_of(df: DataFrame, features: list[str], accuracy: int = ACCURACY) -> DataFrame:
    """One row per feature: feature, n, sketch. Nulls and NaN are left out; sketches combine before the exchange."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    values = df.select(F.inline(pairs)).where("value is not null and not isnan(value)")
    return values.groupBy("feature").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("value", accuracy).alias("sketch")
    )


def merged_profile(profiles: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """Profiles of several batches as one."""
    return profiles.groupBy("feature").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", accuracy).alias("sketch")
    )


def _below(grid: Column, value: Column, inclusive: bool) -> Column:
    """Share of the values below (or at) ``value``, read off quantiles at even ranks."""
    return F.size(F.filter(grid, lambda q: q <= value if inclusive else q < value)) / F.size(grid)


def profile_drift(reference: DataFrame, current: DataFrame, buckets: int = BUCKETS, grid: int = GRID) -> DataFrame:
    """One row per feature of both profiles: n_ref, n_cur, psi, ks.

    PSI counts both sides in the reference's quantile buckets; KS is the largest
    gap at the quantiles of either side. Both inputs have one row per feature,
    so nothing here grows with the rows that they stand for. ``grid`` adds at
    most 1 / grid to the sketches' error.
    """
    def quantiles(sketch: str, ranks: list[float]) -> Column:
        return F.kll_sketch_get_quantile_double(F.col(sketch), F.array(*map(F.lit, ranks)))

    even = [(i + 0.5) / grid for i in range(grid)]
    r = reference.select("feature", F.col("n").alias("size_ref"), quantiles("sketch", even).alias("ref"),
                         quantiles("sketch", [i / buckets for i in range(1, buckets)]).alias("edges"))
    c = current.select("feature", F.col("n").alias("size_cur"), quantiles("sketch", even).alias("cur"))
    both = r.join(c, "feature")

    def counts(side: str, size: str) -> Column:
        """Rows per bucket: differences of the shares below its edges; a value at an edge lies above it."""
        below = F.transform("edges", lambda e: _below(F.col(side), e, False))
        ends = F.concat(F.array(F.lit(0.0)), below, F.array(F.lit(1.0)))
        return F.transform(
            F.sequence(F.lit(1), F.lit(buckets)), lambda i: (F.element_at(ends, i + 1) - F.element_at(ends, i)) * F.col(size)
        )

    gaps = F.transform(F.concat("ref", "cur"), lambda v: F.abs(_below(F.col("ref"), v, True) - _below(F.col("cur"), v, True)))
    ready = both.withColumns({"ref_counts": counts("ref", "size_ref"), "cur_counts": counts("cur", "size_cur")})
    return ready.select(
        "feature", F.col("size_ref").alias("n_ref"), F.col("size_cur").alias("n_cur"), psi().alias("psi"),
        F.array_max(gaps).alias("ks"),
    )
