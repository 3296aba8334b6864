"""Dashboard queries: filters, KPI cards, breakdowns, queues and the what-if base."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.money import mean, share, total, total_where
from riskloom.functions.rules import is_fraud, kyc_label
from riskloom.operators.histogram import histogram


@dataclass(frozen=True)
class ActivityFilter:
    """Global activity filter. Empty lists and missing bounds do not restrict."""

    start_date: str | None = None
    end_date: str | None = None
    channels: list[str] = field(default_factory=list)
    card_types: list[str] = field(default_factory=list)
    min_amount: float | None = None
    max_amount: float | None = None
    status: str = "all"  # all, fraud or legit


def with_date(fact: DataFrame) -> DataFrame:
    """The fact as dashboards read it: with its calendar date."""
    return fact.withColumn("transaction_date", F.to_date("timestamp"))


def fraud_only(fact: DataFrame) -> DataFrame:
    return fact.where(is_fraud())


def legit_only(fact: DataFrame) -> DataFrame:
    return fact.where("is_fraud = 0")


def filter_activity(fact: DataFrame, chosen: ActivityFilter) -> DataFrame:
    """Inclusive on all bounds; expects ``transaction_date`` (partition-prunable)."""
    if chosen.start_date is not None:
        fact = fact.where(F.col("transaction_date") >= F.lit(chosen.start_date).cast("date"))
    if chosen.end_date is not None:
        fact = fact.where(F.col("transaction_date") <= F.lit(chosen.end_date).cast("date"))
    if chosen.channels:
        fact = fact.where(F.col("channel").isin(chosen.channels))
    if chosen.card_types:
        fact = fact.where(F.col("card_type").isin(chosen.card_types))
    if chosen.min_amount is not None:
        fact = fact.where(F.col("amount") >= chosen.min_amount)
    if chosen.max_amount is not None:
        fact = fact.where(F.col("amount") <= chosen.max_amount)
    if chosen.status == "fraud":
        return fraud_only(fact)
    if chosen.status == "legit":
        return legit_only(fact)
    return fact


def kpi_card(activity: DataFrame) -> DataFrame:
    """One row of headline numbers; rates are 0 on empty input."""
    n = F.greatest(F.count("*"), F.lit(1).cast("bigint"))
    gmv = F.coalesce(total(F.col("amount")), F.lit(0.0))
    frauds = F.coalesce(F.sum("is_fraud"), F.lit(0).cast("bigint"))
    return activity.agg(
        F.count("*").alias("total_tx_count"),
        gmv.alias("total_gmv"),
        frauds.alias("fraud_count"),
        F.coalesce(total_where(is_fraud(), F.col("amount")), F.lit(0.0)).alias("fraud_dollars"),
        (frauds / n * 100).alias("fraud_rate"),
        (gmv / n).alias("avg_ticket"),
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct("merchant_id").alias("active_merchants"),
    )


def daily_trend(activity: DataFrame) -> DataFrame:
    return (
        activity.groupBy("transaction_date")
        .agg(
            total(F.col("amount")).alias("total_gmv"),
            total_where(is_fraud(), F.col("amount")).alias("fraud_gmv"),
            F.count("transaction_id").alias("tx_count"),
        )
        .orderBy("transaction_date")
    )


def channel_share(activity: DataFrame) -> DataFrame:
    """Volume and share of the whole; the window runs over the handful of channel rows."""
    volumes = activity.groupBy("channel").agg(total(F.col("amount")).alias("volume"))
    whole = F.sum(F.col("volume").cast("decimal(28,6)")).over(Window.partitionBy()).cast("double")
    return volumes.withColumn("volume_share", share(F.col("volume"), whole))


def card_type_risk(activity: DataFrame) -> DataFrame:
    """Fraud rate by value: fraud amount over amount (a zero amount divides by 1)."""
    sums = activity.groupBy("card_type").agg(
        total(F.col("amount")).alias("total_gmv"),
        total_where(is_fraud(), F.col("amount")).alias("fraud_gmv"),
    )
    whole = F.when(F.col("total_gmv") == 0, F.lit(1.0)).otherwise(F.col("total_gmv"))
    return sums.withColumn("fraud_rate_pct", F.col("fraud_gmv") / whole * 100)


def device_activity(activity: DataFrame) -> DataFrame:
    return activity.groupBy("device_type").agg(
        F.count("transaction_id").alias("tx_count"), F.sum("is_fraud").alias("fraud_count")
    )


def fraud_type_counts(tx: DataFrame) -> DataFrame:
    return tx.groupBy("fraud_type").agg(F.count("*").alias("n"))


def distance_histogram(activity: DataFrame, bins: int = 35) -> DataFrame:
    return histogram(activity, "distance_from_home_km", bins, {"is_fraud": F.col("is_fraud")})


def incidents_of(incidents: DataFrame, activity: DataFrame) -> DataFrame:
    """Incidents whose transaction is part of the filtered activity, of which only fraud can match."""
    return incidents.join(fraud_only(activity).select("transaction_id"), "transaction_id", "left_semi")


# The columns of the incident queue.
QUEUE_COLUMNS = [
    "transaction_id", "user_name", "merchant_name", "merchant_category", "fraud_amount",
    "fraud_type", "severity_level", "distance_from_home_km", "ops_status",
]


def incident_queue(
    incidents: DataFrame,
    severities: list[str],
    patterns: list[str] | None = None,
    min_loss: float = 100,
) -> DataFrame:
    """Work queue. Unlike the activity filter an empty list selects nothing.

    ``patterns=None`` stands for the full default selection.
    """
    queue = incidents.where(F.col("severity_level").isin(severities))
    if patterns is not None:
        queue = queue.where(F.col("fraud_type").isin(patterns))
    return queue.where(F.col("fraud_amount") >= min_loss).select(*QUEUE_COLUMNS)


def largest_incidents(queue: DataFrame, n: int = 100) -> DataFrame:
    return queue.orderBy(F.desc("fraud_amount"), "transaction_id").limit(n)


def merchant_portfolio(dim_merchants: DataFrame) -> DataFrame:
    return dim_merchants.select(
        "merchant_name", "category", "total_processed_volume", "empirical_fraud_rate", "fraud_tx_count"
    )


def cohort_value(dim_users: DataFrame) -> DataFrame:
    hit = F.sum(F.when(F.col("total_fraud_incidents") > 0, 1).otherwise(0))
    return dim_users.groupBy("user_cohort_tenure").agg(
        F.count("user_id").alias("user_count"),
        mean(F.col("total_lifetime_spend")).alias("avg_lifetime_spend"),
        F.avg("total_transactions").alias("avg_tx_count"),
        hit.alias("fraud_user_count"),
        (share(hit, F.count("user_id")) * 100).alias("compromise_rate_pct"),
    )


def kyc_split(dim_users: DataFrame) -> DataFrame:
    return (
        dim_users.groupBy("kyc_verified")
        .agg(
            F.count("user_id").alias("user_count"),
            mean(F.col("total_lifetime_spend")).alias("avg_spend"),
            F.sum("total_fraud_incidents").alias("total_fraud"),
        )
        .withColumn("status_label", kyc_label(F.col("kyc_verified")))
    )


def filter_domains(fact: DataFrame) -> DataFrame:
    """Rows (domain, value): the choices and ranges a filter panel offers, as text."""
    def choice(name: str) -> Column:
        return F.struct(F.lit(name).alias("domain"), F.col(name).alias("value"))

    choices = fact.select(
        F.inline(F.array(choice("channel"), choice("card_type"), choice("fraud_type")))
    ).distinct()
    ends = fact.agg(
        F.min("transaction_date").cast("string").alias("first"),
        F.max("transaction_date").cast("string").alias("last"),
        F.ceil(F.max("amount")).cast("string").alias("top"),
    )
    ranges = ends.select(F.expr(
        "stack(3, 'min_date', first, 'max_date', last, 'max_amount', top) as (domain, value)"
    ))
    return choices.unionByName(ranges)


def first_by_id(dim: DataFrame, key: str, n: int = 25) -> DataFrame:
    """The first n entries of a picker, in key order."""
    return dim.orderBy(key).limit(n)
