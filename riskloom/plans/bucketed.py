"""Fact and user dimension stored in buckets of the user, so that repeated joins move no fact rows.

Both tables are hashed into the same number of buckets and sorted inside them.
A join or an aggregate by user reads bucket beside bucket. A heavy user makes
one bucket large; where that matters the unbucketed fact, whose join adaptive
execution can split, stays available beside it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.money import round_half_up, share
from riskloom.functions.rules import flag, spend_ratio
from riskloom.plans import marts

KEY = "user_id"


@dataclass(frozen=True)
class BucketedTables:
    """Catalog names of the bucketed fact and user dimension."""

    fact: str
    users: str

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.table(self.fact), spark.table(self.users)

    def drop(self, spark: SparkSession) -> None:
        """Forget the names; the files stay where they are."""
        for name in (self.fact, self.users):
            spark.sql(f"drop table if exists {name}")


def store(fact: DataFrame, users: DataFrame, root: str, buckets: int, prefix: str = "riskloom") -> BucketedTables:
    """Write both tables in buckets below ``root``.

    Rows are dealt by the key before they are written, so that a bucket is one
    file however many tasks made the rows.
    """
    made = {}
    for name, df in (("fact", fact), ("users", users)):
        made[name] = f"{prefix}_{name}_{uuid.uuid4().hex[:12]}"
        dealt = df.repartition(buckets, KEY)
        dealt.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{root}/{made[name]}").saveAsTable(made[name])
    return BucketedTables(made["fact"], made["users"])


def spend_profiles(tables: BucketedTables, spark: SparkSession) -> DataFrame:
    """Every transaction beside its user: spend against the user's baseline, and whether it is abroad."""
    fact, users = tables.read(spark)
    home = users.select(KEY, "baseline_spend", F.col("country").alias("home_country"))
    return fact.join(home, KEY).select(
        "transaction_id", KEY, spend_ratio(F.col("amount"), F.col("baseline_spend")).alias("amount_to_baseline_ratio"),
        flag(~F.col("transaction_country").eqNullSafe(F.col("home_country"))).alias("is_cross_border"),
    )


def user_summary(tables: BucketedTables, spark: SparkSession) -> DataFrame:
    """Lifetime metrics per user and the share of fraud, without an exchange of the fact."""
    fact, users = tables.read(spark)
    return marts.users_with(users, marts.user_metrics(fact)).withColumn(
        "fraud_share", round_half_up(share(F.col("total_fraud_incidents"), F.col("total_transactions")), 6))
