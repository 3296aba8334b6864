"""Silver layer: typed, deduplicated and enriched tables; and the filtering staging variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rules import flag, is_night, is_weekend
from riskloom.operators.dedup import keep_first


def temporal(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add hour_of_day, day_of_week (Monday 0), is_weekend and is_night."""
    when = F.col(ts)
    return df.withColumns({
        "hour_of_day": F.hour(when),
        "day_of_week": F.weekday(when),
        "is_weekend": is_weekend(when),
        "is_night": is_night(F.hour(when)),
    })


def typed_transactions(tx: DataFrame) -> DataFrame:
    return tx.withColumns({
        "timestamp": F.col("timestamp").cast("timestamp"),
        "amount": F.col("amount").cast("double"),
        "distance_from_home_km": F.col("distance_from_home_km").cast("double"),
        "is_fraud": F.col("is_fraud").cast("int"),
    })


def with_cross_border(tx: DataFrame, users: DataFrame) -> DataFrame:
    """1 where the country differs from the user's home; users we do not know give 0.

    ``users`` must be unique by user_id. The join is left to the optimizer:
    broadcast while the users are small, else shuffled with adaptive splitting
    of heavy users.
    """
    homes = users.select("user_id", F.col("country").alias("_home"), F.lit(True).alias("_known"))
    differs = ~F.col("country").eqNullSafe(F.col("_home"))
    return (
        tx.join(homes, "user_id", "left")
        .withColumn("is_cross_border", flag(F.col("_known") & differs))
        .drop("_home", "_known")
    )


def silver_users(users: DataFrame) -> DataFrame:
    return keep_first(users, "user_id").withColumns({
        "created_at": F.col("created_at").cast("timestamp"),
        "account_age_days": F.col("account_age_days").cast("int"),
        "kyc_verified": F.col("kyc_verified").cast("int"),
    })


def silver_merchants(merchants: DataFrame) -> DataFrame:
    return keep_first(merchants, "merchant_id").withColumn(
        "chargeback_history_rate", F.col("chargeback_history_rate").cast("double")
    )


def silver_transactions(tx: DataFrame, users: DataFrame, unique_users: bool = False) -> DataFrame:
    """Deduplicated, typed, with temporal and cross-border columns.

    Set ``unique_users`` when ``users`` holds one row per id; it is
    deduplicated first otherwise. Bad rows are kept: the quality gate stops them.
    """
    columns = [*tx.columns, "hour_of_day", "day_of_week", "is_weekend", "is_night", "is_cross_border"]
    cleaned = temporal(typed_transactions(keep_first(tx, "transaction_id", ["timestamp"])))
    known = users if unique_users else keep_first(users, "user_id")
    return with_cross_border(cleaned, known).select(*columns)


def staging_transactions(tx: DataFrame) -> DataFrame:
    """Staging variant: drops rows without id or positive amount, keeps duplicates."""
    ts = F.col("timestamp").cast("timestamp")
    return tx.where("transaction_id is not null and amount > 0").select(
        "transaction_id",
        "user_id",
        "merchant_id",
        F.col("amount").cast("double").alias("amount"),
        "currency",
        ts.alias("transaction_timestamp"),
        "channel",
        "card_type",
        "device_type",
        F.col("country").alias("transaction_country"),
        F.col("distance_from_home_km").cast("double").alias("distance_from_home_km"),
        F.col("is_fraud").cast("int").alias("is_fraud"),
        "fraud_type",
        F.date_trunc("day", ts).alias("transaction_date"),
        F.hour(ts).alias("hour_of_day"),
        F.weekday(ts).isin(5, 6).alias("is_weekend"),
    )
