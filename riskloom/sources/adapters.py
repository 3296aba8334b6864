"""Card-transaction tables derived from the star-schema test tables.

Every column is a deterministic expression over the given rows, so any engine
can derive the same tables. Nothing here is sampled or generated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Domains of the card-transaction model.
CHANNELS = ["mobile_app", "web", "in_store", "api"]
CARD_TYPES = ["credit", "debit", "virtual_card"]
DEVICES = ["ios", "android", "macos", "windows", "linux"]
FRAUD_PATTERNS = ["VELOCITY_BURST", "IMPOSSIBLE_TRAVEL", "CARD_PROBING", "HIGH_RISK_SURGE"]
CATEGORY_TIERS = {
    "grocery": "Low",
    "subscription": "Low",
    "restaurant": "Low",
    "electronics": "Medium",
    "travel": "Medium",
    "luxury_goods": "High",
    "crypto_exchange": "High",
    "gaming_gambling": "High",
}

TRANSACTION_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "amount", "currency", "timestamp", "channel",
    "card_type", "device_type", "ip_address", "country", "distance_from_home_km", "is_fraud",
    "fraud_type",
]


# Layouts of the star-schema tables; given, so that no job reads footers to infer them.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def padded(prefix: str, number: Column, width: int) -> Column:
    """Prefix plus the number, zero-padded to at least ``width`` digits (never cut)."""
    text = number.cast("string")
    return F.concat(
        F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
    )


def pick(values: list[str], number: Column) -> Column:
    """Element of a fixed list by ``number`` modulo its length."""
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values)).cast("int") + 1)


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    # nation holds 25 rows at every scale of the star schema
    return F.broadcast(table(spark, folder, "nation").select("n_nationkey", "n_name"))


def _from_events(events: DataFrame, n_merchants: Column) -> DataFrame:
    """Transaction columns of event rows, all but the country (``event_id`` kept)."""
    k = F.get_json_object("props", "$.k").cast("int")
    base = events.select(
        "event_id", "ts", "value", "event_type", F.col("user_id").alias("customer"), k.alias("k")
    )
    fraud = F.coalesce((F.col("event_type") == "error") & (F.col("k") < 19), F.lit(False))
    event_id = F.col("event_id")
    return base.select(
        "event_id",
        "customer",
        padded("TX_", event_id, 12).alias("transaction_id"),
        padded("USR_", F.col("customer"), 5).alias("user_id"),
        padded("MER_", F.col("k") % n_merchants, 4).alias("merchant_id"),
        (F.floor(F.col("value") * 1000.0 + 0.5) / F.lit(100.0)).alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        pick(CHANNELS, event_id).alias("channel"),
        pick(CARD_TYPES, event_id).alias("card_type"),
        pick(DEVICES, event_id).alias("device_type"),
        F.concat(F.lit("10.0."), F.col("k").cast("string"), F.lit(".1")).alias("ip_address"),
        (
            (event_id * 37 % 4000) / F.lit(100.0)
            + F.when(fraud, 250.0 * (F.col("k") + 1)).otherwise(0.0)
        ).alias("distance_from_home_km"),
        fraud.cast("int").alias("is_fraud"),
        F.when(fraud, pick(FRAUD_PATTERNS, event_id)).otherwise("NONE").alias("fraud_type"),
    )


def _with_country(spark: SparkSession, folder: str, tx: DataFrame) -> DataFrame:
    homes = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_nationkey")
    )
    abroad = F.col("event_id") % 11 == 0
    nation_key = F.when(abroad, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    return (
        tx.join(homes, "customer", "left")
        .withColumn("n_nationkey", nation_key)
        .join(_nations(spark, folder), "n_nationkey", "left")
        .withColumnRenamed("n_name", "country")
    )


def transactions(spark: SparkSession, folder: str, with_country: bool = True) -> DataFrame:
    """Card transactions from ``events``.

    ``with_country=False`` leaves the country out, and with it the join to the
    customers, for queries that do not look at it.
    """
    n_merchants = table(spark, folder, "supplier").agg(F.count("*")).scalar()
    tx = _from_events(table(spark, folder, "events"), n_merchants)
    if with_country:
        return _with_country(spark, folder, tx).select(*TRANSACTION_COLUMNS)
    return tx.select(*[c for c in TRANSACTION_COLUMNS if c != "country"])


def clean_transactions(spark: SparkSession, folder: str, with_country: bool = True) -> DataFrame:
    """The same transactions with every amount above 0, so that they meet the contracts."""
    amount = F.when(F.col("amount") > 0, F.col("amount")).otherwise(1.0)
    return transactions(spark, folder, with_country).withColumn("amount", amount)


def transaction_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same transactions as a file stream over the events, country included."""
    n_merchants = table(spark, folder, "supplier").count()
    events = (
        spark.readStream.schema(TABLES["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )
    tx = _from_events(events, F.lit(n_merchants))
    return _with_country(spark, folder, tx).select(*TRANSACTION_COLUMNS)


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    age = (5 + key * 37 % 1500).cast("int")
    return (
        table(spark, folder, "customer")
        .join(_nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            padded("USR_", key, 5).alias("user_id"),
            F.col("c_name").alias("user_name"),
            F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("country"),
            age.alias("account_age_days"),
            (key % 7 != 0).alias("kyc_verified"),
            (50.0 + F.abs(F.col("c_acctbal")) / 20.0).alias("baseline_spend"),
            F.date_sub(F.lit("2024-01-31").cast("date"), age).cast("timestamp").alias("created_at"),
        )
    )


def merchants(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        table(spark, folder, "supplier")
        .join(_nations(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            padded("MER_", key, 4).alias("merchant_id"),
            F.col("s_name").alias("merchant_name"),
            pick(list(CATEGORY_TIERS), key).alias("category"),
            pick(list(CATEGORY_TIERS.values()), key).alias("risk_tier"),
            F.col("n_name").alias("country"),
            ((10 + key * 7 % 390) / F.lit(10000.0)).alias("chargeback_history_rate"),
        )
    )


def duplicated_transactions(spark: SparkSession, folder: str, with_parties: bool = True) -> DataFrame:
    """Transactions from ``lineitem``: six times the volume, ids not unique.

    ``with_parties=False`` leaves user and country out, and with them the joins
    to orders and suppliers, which match every line exactly once.
    """
    lines = table(spark, folder, "lineitem")
    if with_parties:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        suppliers = (
            table(spark, folder, "supplier")
            .join(_nations(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("n_name").alias("country"))
        )
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
            suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    fraud = F.col("l_returnflag") == "R"
    columns = {
        "transaction_id": F.concat_ws("_", F.lit("TX"), "l_orderkey", "l_linenumber"),
        "user_id": padded("USR_", F.col("o_custkey"), 5) if with_parties else None,
        "merchant_id": padded("MER_", F.col("l_suppkey"), 4),
        "amount": F.col("l_extendedprice"),
        "currency": F.lit("USD"),
        "timestamp": F.col("l_shipdate").cast("timestamp"),
        "channel": pick(CHANNELS, F.col("l_linenumber")),
        "card_type": F.when(F.col("l_linestatus") == "O", "credit").otherwise("debit"),
        "device_type": pick(DEVICES, F.col("l_partkey")),
        "ip_address": F.lit("10.0.0.1"),
        "country": F.col("country") if with_parties else None,
        "distance_from_home_km": F.col("l_quantity"),
        "is_fraud": fraud.cast("int"),
        "fraud_type": F.when(fraud, "CARD_PROBING").otherwise("NONE"),
    }
    return lines.select(*[c.alias(name) for name, c in columns.items() if c is not None])


def faulty_transactions(spark: SparkSession, folder: str, with_country: bool = True) -> DataFrame:
    """Event transactions with contract violations at fixed event numbers."""
    number = F.expr("cast(substring(transaction_id, 4) as bigint)")
    tx = transactions(spark, folder, with_country).withColumn("event_no", number)
    no = F.col("event_no")
    broken = tx.withColumns({
        "transaction_id": F.when(no % 101 != 0, F.col("transaction_id")),
        "amount": F.when(no % 103 == 0, float("nan")).when(no % 97 == 0, -F.col("amount")).otherwise(F.col("amount")),
        "user_id": F.when(no % 89 == 0, "NON_EXISTENT_USR").otherwise(F.col("user_id")),
        "merchant_id": F.when(no % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("merchant_id")),
        "distance_from_home_km": F.when(no % 79 == 0, -F.col("distance_from_home_km"))
        .otherwise(F.col("distance_from_home_km")),
        "is_fraud": F.when(no % 73 == 0, 2)
        .when(no % 71 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("is_fraud")),
        # rows delivered twice
        "copies": F.when(no % 67 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))),
    })
    return broken.withColumn("copy", F.explode("copies")).drop("event_no", "copies", "copy")


def score_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON scoring request per event transaction, in column ``payload``.

    Optional keys are left out, set to null or put out of bounds at fixed event
    numbers, and some ids are unknown, so every default and contract is met.
    """
    tx = transactions(spark, folder).withColumn(
        "no", F.expr("cast(substring(transaction_id, 4) as bigint)")
    )
    no = F.col("no")

    def unless_every(n: int, value: Column) -> Column:
        return F.when(no % n != 0, value)

    hour = F.when((no % 19 != 0) & (no % 23 != 0), F.when(no % 29 == 0, 25).otherwise(F.hour("timestamp")))
    # null fields are left out of the text
    body = F.to_json(F.struct(
        "transaction_id",
        F.when(no % 31 == 0, "USR_UNKNOWN").otherwise(F.col("user_id")).alias("user_id"),
        F.when(no % 37 == 0, "MER_UNKNOWN").otherwise(F.col("merchant_id")).alias("merchant_id"),
        F.when(no % 97 == 0, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        unless_every(5, F.col("channel")).alias("channel"),
        unless_every(7, F.col("card_type")).alias("card_type"),
        unless_every(9, F.col("device_type")).alias("device_type"),
        unless_every(13, F.col("country")).alias("country"),
        unless_every(17, F.when(no % 79 == 0, F.lit(-1.0)).otherwise(F.col("distance_from_home_km")))
        .alias("distance_from_home_km"),
        hour.alias("hour_of_day"),
    ))
    null_hour = (no % 19 != 0) & (no % 23 == 0)
    with_null = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(', "hour_of_day": null}'))
    return tx.select(F.when(null_hour, with_null).otherwise(body).alias("payload"))
