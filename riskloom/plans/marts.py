"""Gold star schema and the views on top of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.money import mean, round_half_up, share, total, total_where
from riskloom.functions.rules import OPS_STATUS, is_fraud, severity, tenure_cohort
from riskloom.operators.dedup import keep_first
from riskloom.operators.slots import in_turns, stored
from riskloom.operators.velocity import with_velocity
from riskloom.plans.silver import staging_transactions


def user_metrics(tx: DataFrame) -> DataFrame:
    """Lifetime metrics per user; map-side combining shrinks heavy users before the exchange."""
    return tx.groupBy("user_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        total(F.col("amount")).alias("total_lifetime_spend"),
        round_half_up(mean(F.col("amount")), 2).alias("avg_transaction_spend"),
        F.sum("is_fraud").alias("total_fraud_incidents"),
        F.max("timestamp").alias("last_active_timestamp"),
    )


def _zero_if_none(name: str, zero: int | float) -> Column:
    return F.coalesce(F.col(name), F.lit(zero)).alias(name)


# The profile columns of the user dimension.
USER_PROFILE = [
    "user_id", "user_name", "email", "country", "account_age_days", "kyc_verified",
    "baseline_spend", "created_at",
]


def dim_users(users: DataFrame, tx: DataFrame) -> DataFrame:
    return users_with(users, user_metrics(tx))


def users_with(users: DataFrame, metrics: DataFrame) -> DataFrame:
    """The user dimension of given metrics per user."""
    return users.join(metrics, "user_id", "left").select(
        *USER_PROFILE,
        _zero_if_none("total_transactions", 0),
        _zero_if_none("total_lifetime_spend", 0.0),
        _zero_if_none("avg_transaction_spend", 0.0),
        _zero_if_none("total_fraud_incidents", 0),
        "last_active_timestamp",
        tenure_cohort(F.col("account_age_days")).alias("user_cohort_tenure"),
    )


def merchant_metrics(tx: DataFrame) -> DataFrame:
    return tx.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("total_processed_tx"),
        total(F.col("amount")).alias("total_processed_volume"),
        F.sum("is_fraud").alias("fraud_tx_count"),
        total_where(is_fraud(), F.col("amount")).alias("total_fraud_volume"),
    )


def dim_merchants(merchants: DataFrame, tx: DataFrame) -> DataFrame:
    return merchants_with(merchants, merchant_metrics(tx))


def merchants_with(merchants: DataFrame, metrics: DataFrame) -> DataFrame:
    """The merchant dimension of given metrics per merchant."""
    rate = round_half_up(share(F.col("fraud_tx_count"), F.col("total_processed_tx")), 4)
    return merchants.join(metrics, "merchant_id", "left").select(
        "merchant_id",
        "merchant_name",
        "category",
        "risk_tier",
        "country",
        "chargeback_history_rate",
        _zero_if_none("total_processed_tx", 0),
        _zero_if_none("total_processed_volume", 0.0),
        _zero_if_none("fraud_tx_count", 0),
        _zero_if_none("total_fraud_volume", 0.0),
        F.coalesce(rate, F.lit(0.0)).alias("empirical_fraud_rate"),
    )


# The columns of the transaction fact.
FACT_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "amount", "currency", "timestamp", "channel",
    "card_type", "device_type", "transaction_country", "distance_from_home_km", "hour_of_day",
    "day_of_week", "is_weekend", "is_night", "is_cross_border", "is_fraud", "fraud_type",
]


def fct_transactions(silver: DataFrame) -> DataFrame:
    return silver.withColumnRenamed("country", "transaction_country").select(*FACT_COLUMNS)


def fct_fraud_incidents(fact: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """Fraud rows with user and merchant names; rows without either are dropped.

    The fraud filter runs before both joins. Join strategy is the optimizer's:
    it broadcasts whichever side is measured small.
    """
    return (
        fact.where(is_fraud())
        .join(users.select("user_id", "user_name"), "user_id")
        .join(merchants.select("merchant_id", "merchant_name", "category"), "merchant_id")
        .select(
            "transaction_id",
            "user_id",
            "user_name",
            "merchant_id",
            "merchant_name",
            F.col("category").alias("merchant_category"),
            F.col("amount").alias("fraud_amount"),
            "timestamp",
            "fraud_type",
            "channel",
            "device_type",
            "distance_from_home_km",
            severity(F.col("amount")).alias("severity_level"),
            F.lit(OPS_STATUS).alias("ops_status"),
        )
    )


def _fraud_rate_pct() -> Column:
    return round_half_up(share(F.sum("is_fraud"), F.count("transaction_id")) * 100, 2)


def daily_kpis(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(F.to_date("timestamp").alias("transaction_date"))
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            total(F.col("amount")).alias("total_gmv"),
            round_half_up(mean(F.col("amount")), 2).alias("avg_ticket_size"),
            F.sum("is_fraud").alias("fraud_incident_count"),
            total_where(is_fraud(), F.col("amount")).alias("total_fraud_amount"),
            _fraud_rate_pct().alias("fraud_rate_pct"),
            F.count_distinct("user_id").alias("active_transacting_users"),
            F.count_distinct("merchant_id").alias("active_merchants"),
        )
        .orderBy("transaction_date")
    )


def merchant_category_risk(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    """Risk per category.

    The fact is first reduced to one row per merchant, so the join moves
    merchants, not transactions, and no busy merchant can skew it.
    """
    per_merchant = fact.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("n"),
        total(F.col("amount")).alias("volume"),
        F.sum("is_fraud").alias("fraud_n"),
        total_where(is_fraud(), F.col("amount")).alias("fraud_volume"),
    )
    return (
        per_merchant.join(merchants.select("merchant_id", "category"), "merchant_id")
        .groupBy("category")
        .agg(
            F.sum("n").alias("total_tx_count"),
            total(F.col("volume")).alias("total_volume"),
            F.sum("fraud_n").alias("total_fraud_count"),
            total(F.col("fraud_volume")).alias("total_fraud_volume"),
            round_half_up(share(F.sum("fraud_n"), F.sum("n")) * 100, 2).alias("fraud_rate_pct"),
        )
        .orderBy(F.desc("total_fraud_volume"), "category")
    )


def channel_metrics(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("channel")
        .agg(
            F.count("transaction_id").alias("total_tx_count"),
            total(F.col("amount")).alias("total_volume"),
            round_half_up(mean(F.col("amount")), 2).alias("avg_transaction_value"),
            F.sum("is_fraud").alias("fraud_count"),
            _fraud_rate_pct().alias("fraud_rate_pct"),
        )
        .orderBy(F.desc("total_volume"), "channel")
    )


def _moving(staged: DataFrame) -> DataFrame:
    moving = with_velocity(staged.withColumnRenamed("transaction_timestamp", "timestamp"))
    return moving.withColumnRenamed("timestamp", "transaction_timestamp").select(
        "transaction_id", "user_id", "merchant_id", "amount", "currency", "transaction_timestamp",
        "transaction_date", "channel", "card_type", "device_type", "transaction_country",
        "distance_from_home_km", "hour_of_day", "is_weekend", "tx_count_last_1h",
        "total_spend_last_24h", "seconds_since_prev_tx", "is_fraud", "fraud_type",
    )


def fact_with_velocity(tx: DataFrame) -> DataFrame:
    """Staging fact with rolling velocity, stored below the shared folder.

    Duplicate ids are resolved first. Both steps move whole rows, so each takes
    a few slots of its key at a time and the disk never holds all their shuffles.
    """
    arrived = stored([tx], "arrived", "transaction_id")
    unique = stored(
        (staging_transactions(keep_first(t, "transaction_id", ["timestamp"])) for t in in_turns(arrived)), "unique", "user_id"
    )
    return stored(map(_moving, in_turns(unique)), "moving")


def dim_users_staged(users: DataFrame, staged: DataFrame) -> DataFrame:
    """User dimension over the staging fact (``fraud_incident_count``, ``last_active_at``)."""
    per_user = staged.groupBy("user_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        total(F.col("amount")).alias("total_lifetime_spend"),
        mean(F.col("amount")).alias("avg_transaction_spend"),
        F.sum("is_fraud").alias("fraud_incident_count"),
        F.max("transaction_timestamp").alias("last_active_at"),
    )
    return users.join(per_user, "user_id", "left").select(
        *USER_PROFILE,
        _zero_if_none("total_transactions", 0),
        _zero_if_none("total_lifetime_spend", 0.0),
        F.coalesce(round_half_up(F.col("avg_transaction_spend"), 2), F.lit(0.0)).alias("avg_transaction_spend"),
        _zero_if_none("fraud_incident_count", 0),
        "last_active_at",
        tenure_cohort(F.col("account_age_days")).alias("user_cohort_tenure"),
    )


def mart_counts(marts: dict[str, DataFrame]) -> DataFrame:
    """Rows (mart, row_count)."""
    counted = None
    for name, mart in marts.items():
        one = mart.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("mart"), "row_count")
        counted = one if counted is None else counted.unionByName(one)
    return counted


VIEWS = {
    "vw_daily_kpis": lambda m: daily_kpis(m["fct_transactions"]),
    "vw_merchant_category_risk": lambda m: merchant_category_risk(m["fct_transactions"], m["dim_merchants"]),
    "vw_channel_metrics": lambda m: channel_metrics(m["fct_transactions"]),
}


def register_views(marts: dict[str, DataFrame]) -> None:
    """Register the marts and the three report views for SQL users."""
    for name, mart in marts.items():
        mart.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(marts).createOrReplaceTempView(name)
