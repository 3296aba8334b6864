"""Marts kept up to date batch by batch from mergeable partial states.

A landed batch is read once per side and leaves two small tables: per user and
day, and per merchant and day, with counts, sums as units and millionths, and
the last time, all of which merge exactly. They are stored by date and batch,
so a repeated batch replaces its own states and nothing is counted twice. The
daily mart rewrites only the dates that a batch touches; the dimensions merge
states instead of transactions. Sketches of users and merchants per day unite
to distinct counts of any period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.money import joined, present, round_half_up, share, summed
from riskloom.functions.rules import is_fraud
from riskloom.plans import marts
from riskloom.plans.jobs import side_by_side

SKETCH = 12  # log2 of a sketch's registers
SUMS = ["n", "known", "units", "millionths", "fraud_n", "fraud_units", "fraud_millionths"]


def sketch_error(log_registers: int = SKETCH) -> float:
    """Relative standard error of a distinct count: 1.04 / sqrt(registers)."""
    return 1.04 / 2 ** (log_registers / 2)


def day_states(tx: DataFrame, key: str) -> DataFrame:
    """Partial states per ``key`` and date."""
    units, millionths = summed(F.col("amount"))
    fraud_units, fraud_millionths = summed(F.when(is_fraud(), F.col("amount")).otherwise(F.lit(0.0)))
    return tx.groupBy(key, F.to_date("timestamp").alias("transaction_date")).agg(
        F.count("transaction_id").alias("n"), F.count(present(F.col("amount"))).alias("known"),
        units.alias("units"), millionths.alias("millionths"), F.sum("is_fraud").alias("fraud_n"),
        fraud_units.alias("fraud_units"), fraud_millionths.alias("fraud_millionths"), F.max("timestamp").alias("last"),
    )


def _merged(states: DataFrame, *keys: str) -> DataFrame:
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last").alias("last"))


def _overwritten(df: DataFrame, path: str, *parts: str) -> None:
    """Replace the partitions that ``df`` has rows for, and no other."""
    df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def apply_batch(tx: DataFrame, root: str, batch_id: str) -> list:
    """Store the batch's states and rewrite the daily mart for its dates, which are returned."""
    spark = tx.sparkSession

    def store(side: str, key: str) -> None:
        states = day_states(tx, key).withColumn("batch_id", F.lit(batch_id))
        _overwritten(states, f"{root}/states/{side}", "transaction_date", "batch_id")

    side_by_side(spark, {"users": lambda: store("users", "user_id"), "merchants": lambda: store("merchants", "merchant_id")})
    own = read_states(spark, root, "users").where(F.col("batch_id") == batch_id)
    dates = [r[0] for r in own.select("transaction_date").distinct().collect()]  # a row per day
    touched = F.col("transaction_date").isin([d for d in dates if d is not None])
    if None in dates:
        touched = touched | F.col("transaction_date").isNull()
    _overwritten(day_mart(*[read_states(spark, root, s).where(touched) for s in ("users", "merchants")]), f"{root}/daily", "transaction_date")
    return dates


def read_states(spark: SparkSession, root: str, side: str) -> DataFrame:
    key = {"users": "user_id", "merchants": "merchant_id"}[side]
    sums = ", ".join(f"{c} bigint" for c in SUMS)
    schema = f"{key} string, {sums}, last timestamp, transaction_date date, batch_id string"
    return spark.read.schema(schema).parquet(f"{root}/states/{side}")


def day_mart(users: DataFrame, merchants: DataFrame) -> DataFrame:
    """One row per date from the states of all batches: sums, exact distinct counts and sketches."""
    def sketched(key: str) -> list[Column]:
        return [F.count(key).alias("distinct"), F.hll_sketch_agg(key, SKETCH).alias("sketch")]

    by_user = _merged(users, "transaction_date", "user_id").groupBy("transaction_date").agg(
        *[F.sum(c).alias(c) for c in SUMS], *sketched("user_id"))
    by_merchant = _merged(merchants, "transaction_date", "merchant_id").groupBy("transaction_date").agg(*sketched("merchant_id"))
    m = by_merchant.select(
        F.col("transaction_date").alias("on_date"), F.col("distinct").alias("active_merchants"), F.col("sketch").alias("merchants_sketch"))
    return by_user.join(m, F.col("transaction_date").eqNullSafe(F.col("on_date"))).drop("on_date").withColumnsRenamed(
        {"distinct": "active_transacting_users", "sketch": "users_sketch"})


def read_days(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/daily")


def daily_kpis(days: DataFrame) -> DataFrame:
    """The daily KPIs of the stored mart, as ``marts.daily_kpis`` has them."""
    gmv = joined(F.col("units"), F.col("millionths"))
    return days.select(
        "transaction_date", F.col("n").alias("total_transactions"), gmv.alias("total_gmv"),
        round_half_up(gmv / F.nullif(F.col("known"), F.lit(0)), 2).alias("avg_ticket_size"),
        F.col("fraud_n").alias("fraud_incident_count"), joined(F.col("fraud_units"), F.col("fraud_millionths")).alias("total_fraud_amount"),
        round_half_up(share(F.col("fraud_n"), F.col("n")) * 100, 2).alias("fraud_rate_pct"),
        "active_transacting_users", "active_merchants",
    ).orderBy("transaction_date")


def distinct_over(days: DataFrame, period: str) -> DataFrame:
    """(period_start, users, merchants): approximate distinct counts per ``week``, ``month`` and the like, from stored days."""
    return days.groupBy(F.to_date(F.date_trunc(period, "transaction_date")).alias("period_start")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("users"),
        F.hll_sketch_estimate(F.hll_union_agg("merchants_sketch")).alias("merchants"),
    )


def dim_users(users: DataFrame, states: DataFrame) -> DataFrame:
    """The user dimension from the states of all batches."""
    spend = joined(F.col("units"), F.col("millionths"))
    found = _merged(states, "user_id").select(
        "user_id", F.col("n").alias("total_transactions"), spend.alias("total_lifetime_spend"),
        round_half_up(spend / F.nullif(F.col("known"), F.lit(0)), 2).alias("avg_transaction_spend"),
        F.col("fraud_n").alias("total_fraud_incidents"), F.col("last").alias("last_active_timestamp"),
    )
    return marts.users_with(users, found)


def dim_merchants(merchants: DataFrame, states: DataFrame) -> DataFrame:
    """The merchant dimension from the states of all batches."""
    found = _merged(states, "merchant_id").select(
        "merchant_id", F.col("n").alias("total_processed_tx"), joined(F.col("units"), F.col("millionths")).alias("total_processed_volume"),
        F.col("fraud_n").alias("fraud_tx_count"), joined(F.col("fraud_units"), F.col("fraud_millionths")).alias("total_fraud_volume"),
    )
    return marts.merchants_with(merchants, found)
