"""Deterministic sampling and splitting by hashed id.

Membership depends on the id only: it does not change with partitioning, file
layout or repeated tasks, and any engine with MD5 can name the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_DIGITS = 5  # 16**5 hash buckets


def fixed_size_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows with the smallest salted hash; each task keeps only its own best."""
    return (
        df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))))
        .orderBy("_hash", key)
        .limit(size)
        .drop("_hash")
    )


def _test_size(n: Column, share: float) -> Column:
    return F.floor(n * F.lit(share) + 0.5)


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: an exact per-class test share, by hash order of the unique ``key``.

    Only counts per class and hash bucket are ordered. Whole buckets go to one
    side; just the bucket that holds a class's cut, about 1 / 16**HASH_DIGITS of
    the class, is ranked row by row to find the last test row. The table itself
    is then marked in one pass against that single row per class.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)))
    ids = df.select(F.col(key).alias("_key"), F.col(label).alias("_class"), digest.alias("_hash"))
    ids = ids.withColumn("_bucket", F.substring("_hash", 1, HASH_DIGITS))
    counts = ids.groupBy("_class", "_bucket").agg(F.count("*").alias("n"))
    by_bucket = Window.partitionBy("_class").orderBy("_bucket")
    cut_buckets = (
        counts.withColumns({
            "before": F.sum("n").over(by_bucket) - F.col("n"),
            "wanted": _test_size(F.sum("n").over(Window.partitionBy("_class")), test_share),
        })
        .where((F.col("before") < F.col("wanted")) & (F.col("before") + F.col("n") >= F.col("wanted")))
        .select(F.col("_class").alias("_c"), F.col("_bucket").alias("_b"),
                (F.col("wanted") - F.col("before")).alias("_take"))
    )
    # one row per class that gets test rows at all
    same_bucket = F.col("_class").eqNullSafe(F.col("_c")) & (F.col("_bucket") == F.col("_b"))
    rank = F.row_number().over(Window.partitionBy("_class").orderBy("_hash", "_key"))
    last = (
        ids.join(F.broadcast(cut_buckets), same_bucket)
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("_take"))
        .select(F.col("_c"), F.struct("_hash", "_key").alias("_last"))
    )
    upto_last = F.struct(digest.alias("_hash"), F.col(key).alias("_key")) <= F.col("_last")
    return (
        df.join(F.broadcast(last), F.col(label).eqNullSafe(F.col("_c")), "left")
        .withColumn("is_test", F.coalesce(upto_last, F.lit(False)))
        .drop("_c", "_last")
    )
