"""Queries by operator id. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas
from riskloom.functions import rules, times
from riskloom.functions.money import round_half_up
from riskloom.operators import (
    checksum, dedup, drift, histogram, metrics, ordered, profile, quality, sampling, velocity,
)
from riskloom.plans import bucketed, features, incremental, jobs, marts, policy, reports, scoring, silver, training
from riskloom.session import configure, scratch_path
from riskloom.sources import adapters, lake, requests
from riskloom.streaming import landing, live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ACTIVITY = reports.ActivityFilter(
    start_date="2024-01-05", end_date="2024-01-25", channels=["web", "api", "mobile_app"],
    min_amount=50.0, max_amount=1500.0,
)


def _naive(df: DataFrame) -> DataFrame:
    """Times without zone, as the tables hold them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _naive(build(configure(spark), folder))

        QUERIES[name] = run
        return build

    return add


# --- shared inputs -----------------------------------------------------------

def _tx(spark, d):
    return adapters.transactions(spark, d)


def _users(spark, d):
    return adapters.users(spark, d).withColumn("kyc_verified", F.col("kyc_verified").cast("int"))


def _merchants(spark, d):
    return adapters.merchants(spark, d)


def _activity(spark, d):
    """The fact as dashboards read it. Event ids are unique, so nothing needs deduplication."""
    return reports.with_date(silver.temporal(adapters.transactions(spark, d, with_country=False)))


def _filtered(spark, d):
    return reports.filter_activity(_activity(spark, d), ACTIVITY)


def _fact(spark, d):
    return silver.with_cross_border(silver.temporal(_tx(spark, d)), _users(spark, d))


def _incidents(spark, d):
    return marts.fct_fraud_incidents(_activity(spark, d), _users(spark, d), _merchants(spark, d))


def _dim_users(spark, d):
    return marts.dim_users(_users(spark, d), adapters.transactions(spark, d, with_country=False))


def _dim_merchants(spark, d):
    return marts.dim_merchants(_merchants(spark, d), adapters.transactions(spark, d, with_country=False))


def _faulty(spark, d):
    return adapters.faulty_transactions(spark, d)


def _faulty_core(spark, d):
    """Without the country, which no contract looks at."""
    return adapters.faulty_transactions(spark, d, with_country=False)


def _rule_scored(spark, d):
    scored = rules.rule_score(F.col("amount"), F.col("is_cross_border"), F.col("hour_of_day"))
    return _fact(spark, d).withColumn("score", scored)


def _requests(spark, d):
    return requests.accepted(requests.parse_requests(adapters.score_requests(spark, d)))


def _enriched(spark, d):
    return scoring.enrich(_requests(spark, d), _users(spark, d), _merchants(spark, d))


def _features(spark, d):
    return features.compute_features(_fact(spark, d), _users(spark, d), _merchants(spark, d))


# --- A: sources and sinks ----------------------------------------------------

@query("a1_landed_batch")
def _(spark, d):
    root = scratch_path(spark, "bronze")
    lake.land_batch(_tx(spark, d), root, "batch_check")
    return lake.read_batches(spark, root, "batch_check")


query("a3_scan_transactions")(_tx)
query("a3_scan_users")(_users)
query("a3_scan_merchants")(_merchants)


@query("a2_snapshot_replaced")
def _(spark, d):
    root = scratch_path(spark, "bronze")
    lake.write_snapshot(_users(spark, d), root, "users")
    lake.write_snapshot(_users(spark, d), root, "users")
    return lake.current_marts(spark, root)["users"]


@query("a4_silver_written_by_date")
def _(spark, d):
    root = scratch_path(spark, "silver")
    jobs.build_silver(spark, {
        "transactions": _tx(spark, d), "users": _users(spark, d), "merchants": _merchants(spark, d),
    }, root, "v1")
    stored = lake.current_marts(spark, root)["transactions"]
    return stored.groupBy("transaction_date").agg(
        F.count("*").alias("n"), F.sum("is_cross_border").alias("cross_border"), F.sum("is_night").alias("night")
    )


@query("a5_published_marts")
def _(spark, d):
    root = scratch_path(spark, "gold")
    layer = {"transactions": _fact(spark, d), "users": _users(spark, d), "merchants": _merchants(spark, d)}
    jobs.build_gold(spark, layer, root, "v1")
    return marts.mart_counts(lake.current_marts(spark, root))


@query("a6_gold_export")
def _(spark, d):
    """Incidents as stored in the published Parquet mart."""
    root = scratch_path(spark, "gold")
    built = lake.publish(_incidents(spark, d), root, "fct_fraud_incidents", "v1")
    lake.commit_versions(spark, root, "v1", [built])
    return lake.current_marts(spark, root)["fct_fraud_incidents"].drop("version")


def _gold(spark, d):
    """The four marts as published by the gold stage and read back."""
    root = scratch_path(spark, "gold")
    layer = {"transactions": _fact(spark, d), "users": _users(spark, d), "merchants": _merchants(spark, d)}
    jobs.build_gold(spark, layer, root, "v1")
    return lake.current_marts(spark, root)


query("a6_exported_users")(lambda spark, d: _gold(spark, d)["dim_users"])
query("a6_exported_merchants")(lambda spark, d: _gold(spark, d)["dim_merchants"])
query("a6_exported_transactions")(lambda spark, d: _gold(spark, d)["fct_transactions"].drop("transaction_date"))
query("a6_exported_incidents")(lambda spark, d: _gold(spark, d)["fct_fraud_incidents"])


@query("a7_view_sql")
def _(spark, d):
    marts.register_views({
        "fct_transactions": _activity(spark, d), "dim_users": _dim_users(spark, d),
        "dim_merchants": _dim_merchants(spark, d),
    })
    return spark.sql("""
        select k.transaction_date, k.total_transactions, k.fraud_rate_pct, k.active_merchants
        from vw_daily_kpis k where k.fraud_incident_count > 0
    """)


def _view(spark, d, name):
    marts.register_views({
        "fct_transactions": _activity(spark, d), "dim_users": _dim_users(spark, d),
        "dim_merchants": _dim_merchants(spark, d),
    })
    return spark.sql(f"select * from {name}")


query("a7_view_daily")(lambda spark, d: _view(spark, d, "vw_daily_kpis"))
query("a7_view_categories")(lambda spark, d: _view(spark, d, "vw_merchant_category_risk"))
query("a7_view_channels")(lambda spark, d: _view(spark, d, "vw_channel_metrics"))


@query("a8_registered_relations")
def _(spark, d):
    _tx(spark, d).createOrReplaceTempView("stg_tx")
    _users(spark, d).createOrReplaceTempView("stg_users")
    return spark.sql("""
        select u.country, count(*) as n, count(distinct t.user_id) as users
        from stg_tx t join stg_users u on t.user_id = u.user_id group by u.country
    """)


@query("a9_audit_ledger")
def _(spark, d):
    root = scratch_path(spark, "bronze")
    jobs.land(spark, {"transactions": _tx(spark, d), "users": _users(spark, d),
                      "merchants": _merchants(spark, d)}, root, "check")
    return lake.read_audit(spark, root).select(
        "transaction_count", "users_count", "merchants_count", "fraud_count", "status"
    )


@query("a9_audit_checksum")
def _(spark, d):
    """The ledger's checksum of the landed batch, and whether its path names the batch."""
    root = scratch_path(spark, "bronze")
    jobs.land(spark, {"transactions": _tx(spark, d), "users": _users(spark, d),
                      "merchants": _merchants(spark, d)}, root, "check")
    return lake.read_audit(spark, root).select(
        "content_checksum", F.col("tx_path").endswith(F.concat(F.lit("batch_id="), F.col("batch_id"))).alias("path_fits"))


@query("a10_content_checksum")
def _(spark, d):
    return checksum.content_checksum(_tx(spark, d)).withColumn("digest_sum", F.col("digest_sum").cast("string"))


query("a12_activity_scan")(lambda spark, d: _activity(spark, d).select(
    "transaction_id", "user_id", "amount", "timestamp", "transaction_date"))


@query("a13_parsed_requests")
def _(spark, d):
    parsed = requests.parse_requests(adapters.score_requests(spark, d))
    return parsed.withColumn("violations", F.array_join("violations", "; ")).drop("timestamp")


@query("a13_rejected_requests")
def _(spark, d):
    lost = requests.rejected(requests.parse_requests(adapters.score_requests(spark, d)))
    return lost.select(F.explode("violations").alias("violation")).groupBy("violation").agg(
        F.count("*").alias("n"))


# --- B: projections and filters ----------------------------------------------

query("b1_staging")(lambda spark, d: silver.staging_transactions(_tx(spark, d)))


@query("b2_staging_filter")
def _(spark, d):
    kept = silver.staging_transactions(_faulty(spark, d))
    return kept.groupBy("channel").agg(F.count("*").alias("n"))


query("b3_temporal")(lambda spark, d: _activity(spark, d).select(
    "transaction_id", "hour_of_day", "day_of_week", "is_weekend"))


@query("b4_night_flag")
def _(spark, d):
    return _activity(spark, d).groupBy("hour_of_day", "is_night").agg(F.count("*").alias("n"))


query("b5_silver_users")(lambda spark, d: silver.silver_users(adapters.users(spark, d)))
query("b5_silver_merchants")(lambda spark, d: silver.silver_merchants(_merchants(spark, d)))
query("b5_silver_transactions")(lambda spark, d: silver.silver_transactions(_tx(spark, d), _users(spark, d)))
query("b6_fct_transactions")(lambda spark, d: marts.fct_transactions(_fact(spark, d)))


@query("b7_tenure_cohort")
def _(spark, d):
    return _users(spark, d).select(
        "user_id", rules.tenure_cohort(F.col("account_age_days")).alias("user_cohort_tenure"))


@query("b8_severity")
def _(spark, d):
    return _incidents(spark, d).groupBy("severity_level", "ops_status").agg(F.count("*").alias("n"))


query("b9_filtered_activity")(lambda spark, d: _filtered(spark, d).select(
    "transaction_id", "transaction_date", "channel", "card_type", "amount", "is_fraud"))


@query("b10_incident_queue")
def _(spark, d):
    return reports.incident_queue(
        _incidents(spark, d), ["CRITICAL", "HIGH"], ["CARD_PROBING", "VELOCITY_BURST"], 100)


@query("b10_empty_choice_selects_none")
def _(spark, d):
    """Incidents with and without a choice, and with an empty one."""
    incidents = _incidents(spark, d)

    def n(*choice):
        return reports.incident_queue(incidents, *choice).agg(F.count("*")).scalar()

    return incidents.agg(F.count("*").alias("incidents")).withColumns({
        "chosen": n(["CRITICAL"], None, 100), "none_chosen": n([], None, 100)})


query("b11_fraud_subset")(lambda spark, d: reports.fraud_only(_activity(spark, d)).select("transaction_id", "amount"))
query("b11_legit_subset")(lambda spark, d: reports.legit_only(_activity(spark, d)).select("transaction_id", "amount"))
query("b12_merchant_portfolio")(lambda spark, d: reports.merchant_portfolio(_dim_merchants(spark, d)))
query("b13_kyc_labels")(lambda spark, d: _users(spark, d).select(
    "user_id", rules.kyc_label(F.col("kyc_verified")).alias("status_label")))


# --- C: joins ----------------------------------------------------------------

query("c1_dim_users")(_dim_users)
query("c2_dim_merchants")(_dim_merchants)
query("c3_fraud_incidents")(_incidents)


@query("c4_category_join")
def _(spark, d):
    return marts.merchant_category_risk(_activity(spark, d), _merchants(spark, d)).select(
        "category", "total_tx_count", "total_volume")


query("c5_cross_border")(lambda spark, d: silver.with_cross_border(_faulty(spark, d), _users(spark, d)).select(
    "transaction_id", "user_id", "country", "is_cross_border"))


@query("c6_feature_join")
def _(spark, d):
    return features.compute_features(_faulty(spark, d), _users(spark, d), _merchants(spark, d)).select(
        "transaction_id", "user_id", "merchant_id", "account_age_days", "kyc_verified", "baseline_spend",
        "country_user", "risk_tier", "chargeback_history_rate")


query("c7_fact_with_velocity")(lambda spark, d: marts.fact_with_velocity(adapters.duplicated_transactions(spark, d)))
query("c8_incidents_of_activity")(lambda spark, d: reports.incidents_of(_incidents(spark, d), _filtered(spark, d)))
query("c9_orphan_users")(lambda spark, d: quality.orphans(_faulty_core(spark, d), _users(spark, d), "user_id"))
query("c10_orphan_merchants")(lambda spark, d: quality.orphans(_faulty_core(spark, d), _merchants(spark, d), "merchant_id"))
query("c11_profile_lookup")(lambda spark, d: scoring.look_up(
    _requests(spark, d), _users(spark, d), _merchants(spark, d)).select(
    "transaction_id", "account_age_days", "kyc_verified", "baseline_spend", "home_country",
    "risk_tier", "chargeback_history_rate"))


# --- D: aggregations ---------------------------------------------------------

query("d1_user_metrics")(lambda spark, d: marts.user_metrics(_activity(spark, d)))
query("d1_user_metrics_lines")(lambda spark, d: marts.user_metrics(adapters.duplicated_transactions(spark, d)))
query("d2_merchant_metrics")(lambda spark, d: marts.merchant_metrics(_activity(spark, d)))
query("d3_fraud_rate")(lambda spark, d: _dim_merchants(spark, d).select("merchant_id", "empirical_fraud_rate"))
query("d4_daily_kpis")(lambda spark, d: marts.daily_kpis(_activity(spark, d)))
query("d5_category_risk")(lambda spark, d: marts.merchant_category_risk(_activity(spark, d), _merchants(spark, d)))
query("d6_channel_metrics")(lambda spark, d: marts.channel_metrics(_activity(spark, d)))
query("d7_dim_users_staged")(lambda spark, d: marts.dim_users_staged(
    _users(spark, d), silver.staging_transactions(_tx(spark, d))))
query("d8_kpi_card")(lambda spark, d: reports.kpi_card(_filtered(spark, d)))
query("d9_daily_trend")(lambda spark, d: reports.daily_trend(_filtered(spark, d)))
query("d10_channel_share")(lambda spark, d: reports.channel_share(_filtered(spark, d)))
query("d11_card_type_risk")(lambda spark, d: reports.card_type_risk(_filtered(spark, d)))
query("d12_device_activity")(lambda spark, d: reports.device_activity(_filtered(spark, d)))
query("d13_cohort_value")(lambda spark, d: reports.cohort_value(_dim_users(spark, d)))
query("d14_kyc_split")(lambda spark, d: reports.kyc_split(_dim_users(spark, d)))


@query("d15_mart_counts")
def _(spark, d):
    return marts.mart_counts({
        "dim_users": _dim_users(spark, d), "dim_merchants": _dim_merchants(spark, d),
        "fct_transactions": _activity(spark, d), "fct_fraud_incidents": _incidents(spark, d),
    })


query("d16_fraud_type_counts")(lambda spark, d: reports.fraud_type_counts(_activity(spark, d)))
query("d17_distance_histogram")(lambda spark, d: reports.distance_histogram(_activity(spark, d)))


@query("d18_score_histogram")
def _(spark, d):
    return histogram.histogram(_rule_scored(spark, d), "score", 30, {"flagged": F.col("score") >= 0.5})


query("d19_flagging_kpis")(lambda spark, d: scoring.flagging_kpis(scoring.flag_at(_rule_scored(spark, d), 0.5)))


@query("d20_batch_counts")
def _(spark, d):
    return _activity(spark, d).agg(
        F.count("*").alias("transaction_count"), F.sum("is_fraud").alias("fraud_count")
    ).withColumns({
        "users_count": _users(spark, d).agg(F.count("*")).scalar(),
        "merchants_count": _merchants(spark, d).agg(F.count("*")).scalar(),
    })


@cache
def _bucketed(spark, d) -> bucketed.BucketedTables:
    """Stored once per session and folder, joined by each of the queries below."""
    fact = marts.fct_transactions(_fact(spark, d))
    return bucketed.store(fact, _users(spark, d), scratch_path(spark, "buckets"), spark.sparkContext.defaultParallelism)


query("c6_bucketed_profiles")(lambda spark, d: bucketed.spend_profiles(_bucketed(spark, d), spark))
query("c1_bucketed_users")(lambda spark, d: bucketed.user_summary(_bucketed(spark, d), spark).drop("fraud_share"))


@cache
def _batched(spark, d) -> str:
    """Marts built from four batches in turn, the second delivered twice; once per session and folder."""
    root, tx = scratch_path(spark, "incremental"), _activity(spark, d)
    for batch in (0, 1, 1, 2, 3):
        incremental.apply_batch(tx.where(F.pmod(F.xxhash64("transaction_id"), F.lit(4)) == batch), root, f"batch_{batch}")
    return root


query("d1_incremental_users")(lambda spark, d: incremental.dim_users(
    _users(spark, d), incremental.read_states(spark, _batched(spark, d), "users")))
query("d2_incremental_merchants")(lambda spark, d: incremental.dim_merchants(
    _merchants(spark, d), incremental.read_states(spark, _batched(spark, d), "merchants")))
query("d4_incremental_days")(lambda spark, d: incremental.daily_kpis(incremental.read_days(spark, _batched(spark, d))))


@query("d9_weekly_actives")
def _(spark, d):
    """Distinct users and merchants per week from stored daily sketches, beside the exact counts."""
    weeks = incremental.distinct_over(incremental.read_days(spark, _batched(spark, d)), "week")
    exact = _activity(spark, d).groupBy(F.to_date(F.date_trunc("week", "timestamp")).alias("period_start")).agg(
        F.count_distinct("user_id").alias("exact_users"), F.count_distinct("merchant_id").alias("exact_merchants"))

    def close(estimate, count):  # three standard errors, and one for small counts
        return F.abs(F.col(estimate) - F.col(count)) <= 3 * incremental.sketch_error() * F.col(count) + 1

    return weeks.join(exact, "period_start").select(
        "period_start", "exact_users", "exact_merchants", close("users", "exact_users").alias("users_close"),
        close("merchants", "exact_merchants").alias("merchants_close"))


@query("h6_batch_stamps")
def _(spark, d):
    """The names and times that a batch landed at each transaction's instant would have."""
    return _activity(spark, d).select(
        "transaction_id", times.batch_stamp(F.col("timestamp"), F.col("channel")).alias("batch_id"),
        times.iso_text(F.col("timestamp")).alias("landed_at"))


query("d21_filter_domains")(lambda spark, d: reports.filter_domains(_activity(spark, d)))


# --- E: windows --------------------------------------------------------------

def _moving(spark, d):
    return velocity.with_velocity(_activity(spark, d).select("transaction_id", "user_id", "timestamp", "amount"))


query("e1_tx_count_1h")(lambda spark, d: _moving(spark, d).select("transaction_id", "tx_count_last_1h"))
query("e2_spend_24h")(lambda spark, d: _moving(spark, d).select("transaction_id", "total_spend_last_24h"))
query("e3_previous_time")(lambda spark, d: _moving(spark, d).select("transaction_id", "prev_tx_timestamp"))
query("e4_seconds_since")(lambda spark, d: _moving(spark, d).select("transaction_id", "seconds_since_prev_tx"))
query("e_velocity")(_moving)


@query("e_velocity_split_users")
def _(spark, d):
    """The same over rows dealt out anew: the result doesn't depend on where a user's rows lie."""
    narrow = _activity(spark, d).select("transaction_id", "user_id", "timestamp", "amount")
    return velocity.with_velocity(narrow.repartition("transaction_id"))


# --- F: sort, limit, sample --------------------------------------------------

def _positions(view: DataFrame) -> DataFrame:
    """The place of every row in the view's own order; views have few rows."""
    placed = view.withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn("position", F.row_number().over(Window.orderBy("_at"))).drop("_at")


query("f1_ordered_daily")(lambda spark, d: _positions(marts.daily_kpis(_activity(spark, d))).select(
    "position", "transaction_date", "total_gmv"))
query("f1_ordered_categories")(lambda spark, d: _positions(marts.merchant_category_risk(
    _activity(spark, d), _merchants(spark, d))).select("position", "category", "total_fraud_volume"))
query("f1_ordered_channels")(lambda spark, d: _positions(marts.channel_metrics(_activity(spark, d))).select(
    "position", "channel", "total_volume"))
query("f2_largest_incidents")(lambda spark, d: reports.largest_incidents(
    reports.incident_queue(_incidents(spark, d), ["CRITICAL", "HIGH", "MEDIUM"])))
query("f3_highest_scores")(lambda spark, d: scoring.highest_scores(_rule_scored(spark, d)).select(
    "transaction_id", "amount", "score"))
query("f5_fixed_sample")(lambda spark, d: sampling.fixed_size_sample(
    _activity(spark, d), "transaction_id", 1500).select("transaction_id", "amount"))
query("f6_first_users")(lambda spark, d: reports.first_by_id(_users(spark, d), "user_id").select("user_id"))
query("f6_first_merchants")(lambda spark, d: reports.first_by_id(_merchants(spark, d), "merchant_id").select("merchant_id"))


# --- G: distinct -------------------------------------------------------------

query("g1_keep_first")(lambda spark, d: dedup.keep_first(
    adapters.duplicated_transactions(spark, d), "transaction_id", ["timestamp"]))
query("g2_surplus_rows")(lambda spark, d: dedup.surplus_rows(
    adapters.duplicated_transactions(spark, d, with_parties=False).select("transaction_id"), "transaction_id"))


@query("g3_batches_as_one_table")
def _(spark, d):
    root = scratch_path(spark, "bronze")
    lake.land_batch(_tx(spark, d), root, "batch_one")
    lake.land_batch(adapters.duplicated_transactions(spark, d), root, "batch_two")
    return lake.read_batches(spark, root).groupBy("batch_id").agg(
        F.count("*").alias("n"), F.sum("is_fraud").alias("fraud_count"))


# --- I: contracts ------------------------------------------------------------

def _gate(spark, d):
    return quality.gate_checks(_faulty_core(spark, d), _users(spark, d), _merchants(spark, d))


for _no, _name in enumerate(quality.MESSAGES, 1):
    query(f"i{_no}_{_name}")(
        lambda spark, d, n=_name: _gate(spark, d).where(F.col("check_name") == n).select("violations", "passed"))


@query("i2_null_counts")
def _(spark, d):
    return quality.null_counts(_faulty_core(spark, d))


@query("i8_gate_summary")
def _(spark, d):
    summary = quality.gate_summary(_faulty_core(spark, d), _users(spark, d), _merchants(spark, d))
    return summary.withColumn("failures", F.array_join("failures", " / "))


@query("i9_halted_run")
def _(spark, d):
    """A run over faulty transactions: what its record says, and which stages it has."""
    root = scratch_path(spark, "lake")
    try:
        jobs.run_medallion(spark, {"transactions": _faulty(spark, d), "users": adapters.users(spark, d),
                                   "merchants": _merchants(spark, d)}, root)
    except jobs.ContractViolation:
        pass
    runs = lake.read_report(spark, schemas.RUN_TELEMETRY, f"{root}/reports/runs")
    return runs.select(
        F.col("status").alias("run_status"), F.array_join(F.array_sort(F.map_keys("stages")), ", ").alias("stages"),
        F.col("stages.quality_gates.status").alias("gate_status"),
        F.col("stages.quality_gates.counts.failures").alias("failures"))


@query("i8_gate_summary_clean")
def _(spark, d):
    clean = adapters.clean_transactions(spark, d, with_country=False)
    summary = quality.gate_summary(clean, _users(spark, d), _merchants(spark, d))
    return summary.withColumn("failures", F.array_join("failures", " / "))


query("i10_unique")(lambda spark, d: quality.unique_violations(_faulty_core(spark, d), "transaction_id"))
query("i11_not_null")(lambda spark, d: quality.not_null_violations(_faulty_core(spark, d), "merchant_id"))
query("i12_accepted_values")(lambda spark, d: quality.accepted_values_violations(_faulty_core(spark, d), "is_fraud", [0, 1]))
query("i_fact_contract")(lambda spark, d: quality.fact_contract(_faulty_core(spark, d)))
query("i_user_contract")(lambda spark, d: quality.user_contract(_users(spark, d)))


# --- J: features, training, metrics ------------------------------------------

query("j1_features")(lambda spark, d: _features(spark, d).select(
    "transaction_id", *features.NUMERICAL_FEATURES, *features.CATEGORICAL_FEATURES))
query("j2_baseline_ratio")(lambda spark, d: _features(spark, d).select("transaction_id", "amount_to_baseline_ratio"))
query("j3_merchant_risk")(lambda spark, d: features.compute_features(
    _faulty(spark, d), _users(spark, d), _merchants(spark, d)).groupBy("risk_tier", "merchant_risk_score").agg(
    F.count("*").alias("n")))


@query("j5_derived_flags")
def _(spark, d):
    made = features.compute_features(_faulty(spark, d), _users(spark, d), _merchants(spark, d))
    return made.select("transaction_id", "user_id", "hour_of_day", "is_weekend", "is_night", "is_cross_border")


@query("j6_imputed")
def _(spark, d):
    gaps = _faulty(spark, d).withColumn(
        "distance_from_home_km", F.when(F.col("distance_from_home_km") >= 0, F.col("distance_from_home_km")))
    made = features.compute_features(gaps, _users(spark, d), _merchants(spark, d))
    return made.select("transaction_id", "merchant_id", "distance_from_home_km", "chargeback_history_rate")


@query("j7_scaled")
def _(spark, d):
    model = features.fit_feature_model(_features(spark, d))
    scaled = model.stages[0].transform(_features(spark, d))
    return scaled.select("transaction_id", *[
        round_half_up(F.col(f"scaled_{c}"), 6).alias(f"scaled_{c}") for c in features.NUMERICAL_FEATURES])


@query("j8_one_hot")
def _(spark, d):
    base = _features(spark, d)
    model = features.fit_feature_model(base)
    names = features.feature_names(model)
    slots = vector_to_array("features")
    return model.transform(base).select("transaction_id", *[
        slots[i].cast("int").alias(name) for i, name in enumerate(names) if i >= len(features.NUMERICAL_FEATURES)])


@query("j9_feature_matrix")
def _(spark, d):
    base = _features(spark, d)
    made = features.fit_feature_model(base).transform(base)
    return made.select("transaction_id", vector_to_array("features").alias("features"), "is_fraud")


@query("j9_feature_slots")
def _(spark, d):
    """The matrix as one row per transaction and slot."""
    base = _features(spark, d)
    model = features.fit_feature_model(base)
    names = F.array(*map(F.lit, features.feature_names(model)))
    slots = F.arrays_zip(names.alias("slot"), vector_to_array("features").alias("value"))
    made = model.transform(base).select("transaction_id", F.explode(slots).alias("s"))
    return made.select("transaction_id", F.col("s.slot").alias("slot"), round_half_up(F.col("s.value"), 6).alias("value"))


@query("j10_transformed_test_rows")
def _(spark, d):
    """Test rows scaled by what was fitted on the training rows."""
    frame = sampling.stratified_split(_features(spark, d), "transaction_id", "is_fraud")
    model = features.fit_feature_model(frame.where("not is_test"))
    made = features.transform_features(frame.where("is_test"), model)
    return made.select("transaction_id", *[
        round_half_up(F.col(f"scaled_{c}"), 6).alias(f"scaled_{c}") for c in features.NUMERICAL_FEATURES])


query("j11_stratified_split")(lambda spark, d: sampling.stratified_split(
    _activity(spark, d).select("transaction_id", "is_fraud"), "transaction_id", "is_fraud"))
query("j12_class_weight")(lambda spark, d: training.class_weight(_activity(spark, d)))


@cache
def _trained(spark, d) -> tuple[str, dict]:
    """One training run per session and folder, shared by the queries below."""
    gold = {"fct_transactions": marts.fct_transactions(_fact(spark, d)),
            "dim_users": _users(spark, d), "dim_merchants": _merchants(spark, d)}
    root = scratch_path(spark, "training")
    return root, jobs.run_training(spark, gold, root)


def _bundle(spark, d):
    return training.load_bundle(_trained(spark, d)[1]["model_path"], spark)


@query("a14_reloaded_bundle")
def _(spark, d):
    """The bundle as read back from disk: its vector slots and their importances."""
    return training.importances(_bundle(spark, d), spark)


@query("a14_bundle_slots")
def _(spark, d):
    """The reloaded bundle's slots, and whether their importances are a distribution."""
    found = training.importances(_bundle(spark, d), spark)
    total = found.agg(F.sum("importance")).scalar()
    return found.select("feature", (F.col("importance").between(0, 1) & (F.abs(total - 1) < 1e-6)).alias("valid"))


@query("j20_importance_order")
def _(spark, d):
    """Top importances: how many, and whether they come largest first."""
    placed = _positions(training.top_importances(_bundle(spark, d), spark))
    below = F.lead("importance").over(Window.orderBy("position"))
    return placed.withColumn("falls", F.coalesce(F.col("importance") >= below, F.lit(True))).select("position", "falls")


@query("j13_score_checks")
def _(spark, d):
    made = training.predict(_features(spark, d), _bundle(spark, d))
    return made.select(
        "transaction_id", F.col("score").between(0, 1).alias("in_range"),
        ((F.col("score") >= training.THRESHOLD).cast("int") == F.col("predicted_fraud")).alias("label_fits"))


@query("j13_trained_scores")
def _(spark, d):
    return training.predict(_features(spark, d), _bundle(spark, d)).select("transaction_id", "is_fraud", "score")


@query("j14_predicted_labels")
def _(spark, d):
    made = training.predict(_features(spark, d), _bundle(spark, d))
    return made.groupBy("is_fraud", "predicted_fraud").agg(F.count("*").alias("n"))


def _labeled(spark, d):
    return _rule_scored(spark, d).select(F.col("is_fraud").alias("label"), "score")


def _rounded(df, digits=6):
    return df.select(*[round_half_up(F.col(c), digits).alias(c) for c in df.columns])


query("j15_roc_auc")(lambda spark, d: _rounded(
    metrics.ranking_metrics(metrics.score_steps(_labeled(spark, d))).select("roc_auc")))
query("j16_average_precision")(lambda spark, d: _rounded(
    metrics.ranking_metrics(metrics.score_steps(_labeled(spark, d))).select("average_precision")))
query("j17_precision_recall_f1")(lambda spark, d: metrics.threshold_metrics(
    metrics.confusion(_labeled(spark, d), 0.3)))
query("j18_confusion")(lambda spark, d: metrics.confusion(_labeled(spark, d), 0.3))
query("j19_pr_curve")(lambda spark, d: metrics.pr_curve(metrics.score_steps(_labeled(spark, d))))


@query("j19_pr_curve_sliced")
def _(spark, d):
    """Distance as score: thousands of distinct values, cut into many slices."""
    scored = _activity(spark, d).select(
        F.col("is_fraud").alias("label"), F.col("distance_from_home_km").alias("score"))
    return metrics.pr_curve(metrics.score_steps(scored, slices=100))


query("j20_importances")(lambda spark, d: training.top_importances(_bundle(spark, d), spark))


@query("j21_run_ledger")
def _(spark, d):
    root, _ = _trained(spark, d)
    return lake.read_report(spark, schemas.TRAINING_RUN, f"{root}/runs").select(
        "run_id", "train_samples", "test_samples", "fraud_ratio_train", F.explode("metrics").alias("metric", "value"))


@query("j21_run_counts")
def _(spark, d):
    """The ledger's counts, read back."""
    root, _ = _trained(spark, d)
    return lake.read_report(spark, schemas.TRAINING_RUN, f"{root}/runs").select(
        "train_samples", "test_samples", "fraud_ratio_train", F.col("params.pos_weight").cast("double").alias("pos_weight"),
        F.size("top_features").alias("top_features"))


def _tested(spark, d) -> DataFrame:
    """Stored test scores of the training run."""
    root, entry = _trained(spark, d)
    return spark.read.parquet(f"{root}/{entry['run_id']}/test_scores")


@query("p2_metrics_recomputed")
def _(spark, d):
    """The ledger's metrics against another way to work them out from the stored test scores.

    The area comes from the sum of the frauds' ranks, the average precision from
    the precision at every fraud, ties sharing one rank; both from running totals
    over the distinct scores, in slices.
    """
    root, _ = _trained(spark, d)
    stored = lake.read_report(spark, schemas.TRAINING_RUN, f"{root}/runs").select(F.explode("metrics").alias("metric", "value"))
    rows = _tested(spark, d).select(F.lit("all").alias("curve"), (-F.col("score")).alias("falling"), "label")
    counts = rows.groupBy("curve", "falling").agg(F.sum("label").alias("frauds"), F.count("*").alias("n"))
    run = ordered.running_totals(ordered.stored_slices(counts, "curve", "falling"), "curve", "falling", ["frauds", "n"])
    hit = F.col("falling") <= -training.THRESHOLD
    middle = F.col("cum_n") - (F.col("n") - 1) / 2  # rank from the top, shared by equal scores
    n = run.agg(
        F.sum("frauds").alias("pos"), (F.sum("n") - F.sum("frauds")).alias("neg"),
        F.sum(F.col("frauds") * middle).alias("ranks"),
        F.sum(F.col("frauds") * (F.col("cum_frauds") / F.col("cum_n"))).alias("precisions"),
        F.coalesce(F.sum(F.when(hit, F.col("frauds"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("n") - F.col("frauds"))), F.lit(0)).alias("fp"))
    again = n.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("again")) for name, value in {
            "roc_auc": (F.col("pos") * (F.col("neg") + F.col("pos")) + F.col("pos") - F.col("ranks")
                        - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * F.col("neg")),
            "average_precision": F.col("precisions") / F.col("pos"),
            "true_positives": F.col("tp"), "false_positives": F.col("fp"),
            "false_negatives": F.col("pos") - F.col("tp"), "true_negatives": F.col("neg") - F.col("fp"),
            "precision": F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.lit(0.0)),
            "recall": F.coalesce(F.col("tp") / F.nullif(F.col("pos"), F.lit(0)), F.lit(0.0)),
            "f1_score": F.coalesce(2 * F.col("tp") / F.nullif(F.col("tp") + F.col("fp") + F.col("pos"), F.lit(0)), F.lit(0.0)),
        }.items()
    ])))
    return stored.join(again, "metric").select("metric", (F.abs(F.col("value") - F.col("again")) <= 6e-5).alias("agrees"))


@query("p2_quality_bounds")
def _(spark, d):
    """Whether the model separates fraud on test rows that it never saw."""
    least = {"roc_auc": 0.9, "average_precision": 0.8, "f1_score": 0.7, "recall": 0.7, "precision": 0.6}
    found = training.evaluate(_tested(spark, d))
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(v).alias("bound"), (F.col(m) >= v).alias("reached")) for m, v in least.items()
    ])))


@query("p2_tested_rows")
def _(spark, d):
    """The labels of the stored test rows: those of the split, each once."""
    return _tested(spark, d).select("transaction_id", F.col("label").cast("int").alias("is_fraud"))


# --- K: scoring --------------------------------------------------------------

query("k1_enriched_requests")(lambda spark, d: _enriched(spark, d).select(
    "transaction_id", *features.NUMERICAL_FEATURES, "risk_tier", "home_country"))
query("k2_reason_codes")(lambda spark, d: scoring.with_reasons(_enriched(spark, d)).select(
    "transaction_id", F.array_join("factors", "; ").alias("factors")))


@query("k3_decisions")
def _(spark, d):
    banded = scoring.score_by_rules(_enriched(spark, d)).withColumn("r", rules.decision(F.col("score")))
    return banded.select("transaction_id", "score", "r.decision", "r.risk_tier")


@query("k4_model_responses")
def _(spark, d):
    bundle = _bundle(spark, d)
    answers = scoring.responses(scoring.score_by_model(_enriched(spark, d), bundle), bundle.version)
    return answers.withColumn("factors", F.array_join("factors", "; "))


def _answer_checks(answers: DataFrame) -> DataFrame:
    """All of a response but the score itself: it lies in 0..1, and decision and tier fit it.

    The record shows four digits of the score, so at a cut either side fits.
    """
    def fits(score):
        band = rules.decision(score)
        return (band["decision"] == F.col("decision")) & (band["risk_tier"] == F.col("risk_tier"))

    shown = F.col("fraud_probability")
    return answers.select(
        "transaction_id", "factors", F.length("model_version").alias("version_length"),
        shown.between(0, 1).alias("in_range"), (fits(shown - 5e-5) | fits(shown + 5e-5)).alias("decision_fits"))


@query("k4_answer_checks")
def _(spark, d):
    bundle = _bundle(spark, d)
    answers = scoring.responses(scoring.score_by_model(_enriched(spark, d), bundle), bundle.version)
    return _answer_checks(answers).withColumn("factors", F.array_join("factors", "; "))


query("k5_batch_summary")(lambda spark, d: scoring.batch_summary(
    scoring.responses(scoring.score_by_rules(_enriched(spark, d)), "rules")))
query("k5_model_batch_summary")(lambda spark, d: scoring.batch_summary(scoring.responses(
    scoring.score_by_model(_enriched(spark, d), _bundle(spark, d)), _bundle(spark, d).version)))
query("k6_analyst_reasons")(lambda spark, d: scoring.with_analyst_reasons(
    _enriched(spark, d), _merchants(spark, d)).select(
    "transaction_id", F.array_join("factors", "; ").alias("factors")))
query("k7_rule_score")(lambda spark, d: _rule_scored(spark, d).select("transaction_id", "score"))
query("k8_flagged")(lambda spark, d: scoring.flag_at(_rule_scored(spark, d), 0.35).select(
    "transaction_id", "predicted_fraud"))


# --- L: drift ----------------------------------------------------------------

DRIFT_FEATURES = ["amount", "distance_from_home_km", "hour_of_day"]


def _sides(spark, d):
    """Whole event transactions against whole lineitem transactions."""
    return _activity(spark, d), silver.temporal(adapters.duplicated_transactions(spark, d, with_parties=False))


def _distribution(spark, d, **sizing):
    return drift.distribution(*_sides(spark, d), DRIFT_FEATURES, **sizing)


@query("l1_psi")
def _(spark, d):
    counted = drift.bucket_counts(_distribution(spark, d))
    return counted.select("feature", round_half_up(drift.psi(), 4).alias("psi_score"))


@query("l2_quantile_buckets")
def _(spark, d):
    counted = drift.bucket_counts(_distribution(spark, d))
    return counted.select("feature", F.posexplode(F.arrays_zip("ref_counts", "cur_counts")).alias("bucket", "n")).select(
        "feature", "bucket", F.col("n.ref_counts").alias("n_ref"), F.col("n.cur_counts").alias("n_cur"))


query("l2_quantile_edges")(lambda spark, d: drift.feature_statistics(_distribution(spark, d)).select(
    "feature", F.posexplode("edges").alias("edge_no", "edge")))
query("l3_ks_statistic")(lambda spark, d: drift.feature_statistics(_distribution(spark, d)).select(
    "feature", round_half_up(F.col("ks"), 6).alias("ks_statistic")))


@query("l4_ks_p_value")
def _(spark, d):
    """The first half of the month against the second, every row on one side."""
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    activity = _activity(spark, d)
    far = drift.feature_statistics(drift.distribution(activity.where(early), activity.where(~early), DRIFT_FEATURES))
    p = drift.ks_p_value(F.col("ks"), F.col("size_ref"), F.col("size_cur"))
    return far.select("feature", round_half_up(p, 5).alias("p_value"))


query("l5_wasserstein")(lambda spark, d: drift.feature_statistics(_distribution(spark, d)).select(
    "feature", round_half_up(F.col("wasserstein"), 4).alias("wasserstein_distance")))


@query("l5_wasserstein_sliced")
def _(spark, d):
    far = drift.feature_statistics(_distribution(spark, d, slices=12))
    return far.select("feature", round_half_up(F.col("wasserstein"), 4).alias("wasserstein_distance"),
                      round_half_up(F.col("ks"), 6).alias("ks_statistic"))


def _sample_drift(spark, d):
    base = _activity(spark, d)
    return base, drift.perturbed(sampling.fixed_size_sample(base, "transaction_id", 1500))


def _scaled_drift(spark, d):
    """All transactions against all of them with larger amounts, over every default feature; joined once."""
    path = scratch_path(spark, "drift-sides")
    _features(spark, d).select("transaction_id", *drift.DEFAULT_FEATURES).write.parquet(path)
    base = spark.read.parquet(path)
    return base, drift.perturbed(base)


query("l6_verdicts")(lambda spark, d: drift.drift_metrics(*_scaled_drift(spark, d)).select("feature", "drift_detected"))
query("l7_severity")(lambda spark, d: drift.drift_metrics(*_scaled_drift(spark, d)).select("feature", "severity"))


@query("l8_drift_report")
def _(spark, d):
    return drift.drift_report(*_scaled_drift(spark, d)).select(
        "overall_status", "reference_sample_size", "current_sample_size", "drifting_features_count",
        F.array_join("drifting_features", ", ").alias("drifting_features"))


query("l9_shared_features")(lambda spark, d: drift.drift_metrics(
    *_scaled_drift(spark, d), drift.DEFAULT_FEATURES).select("feature"))
query("l10_flat_report")(lambda spark, d: drift.flat_report(drift.drift_report(*_scaled_drift(spark, d))))


@query("l_profile_drift")
def _(spark, d):
    """Stored profiles of ten batches against the other side's, held against the exact PSI and KS."""
    reference, current = _sides(spark, d)
    path, error = scratch_path(spark, "profiles"), profile.rank_error()
    for batch in range(10):  # as they would arrive, without reading the earlier ones again
        part = reference.where(F.pmod(F.xxhash64("transaction_id"), F.lit(10)) == batch)
        profile.profile_of(part, DRIFT_FEATURES).write.parquet(f"{path}/batch={batch}")
    stored = profile.merged_profile(spark.read.parquet(path))
    found = profile.profile_drift(stored, profile.profile_of(current, DRIFT_FEATURES))
    exact = drift.bucket_counts(drift.distribution(reference, current, DRIFT_FEATURES)).select(
        "feature", F.col("ks").alias("exact_ks"), drift.psi().alias("exact_psi"))
    # a rank of either side may be off by the error; a bucket has two edges
    return found.join(exact, "feature").select(
        "feature", "n_ref", "n_cur", (F.abs(F.col("ks") - F.col("exact_ks")) <= 2 * (error + 1 / profile.GRID)).alias("ks_close"),
        ((F.col("psi") > 0.2) == (F.col("exact_psi") > 0.2)).alias("same_verdict"))


query("l11_perturbed_sample")(lambda spark, d: _sample_drift(spark, d)[1].select("transaction_id", "amount"))


# --- M: policies -------------------------------------------------------------

query("m1_policy_response")(lambda spark, d: policy.frontier(_filtered(spark, d)).select(
    "point", policy.recall(F.col("threshold")).alias("recall"),
    policy.false_positive_rate(F.col("threshold")).alias("false_positive_rate")))
query("m2_policy_point")(lambda spark, d: policy.policy_point(_filtered(spark, d)))
query("m3_frontier")(lambda spark, d: policy.frontier(_filtered(spark, d)))
query("m4_named_policies")(lambda spark, d: policy.named_policies(_filtered(spark, d)))


# --- N: streams --------------------------------------------------------------

def _drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream to the end of its input into Parquet and return what it wrote."""
    spark = stream.sparkSession
    out = scratch_path(spark, "stream")
    started = (
        stream.writeStream.outputMode(mode).format("parquet")
        .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query("n1_stream_landing")
def _(spark, d):
    root = scratch_path(spark, "bronze")
    landing.land_stream(
        adapters.transaction_stream(spark, d), root, "live", f"{root}/_checkpoint",
        _users(spark, d).count(), _merchants(spark, d).count(),
    ).awaitTermination()
    return lake.read_audit(spark, root).agg(
        F.sum("transaction_count").alias("transaction_count"), F.sum("fraud_count").alias("fraud_count"),
        F.max("users_count").alias("users_count"), F.max("merchants_count").alias("merchants_count"))


@query("n2_stream_deduplicated")
def _(spark, d):
    source = adapters.transaction_stream(spark, d)
    twice = source.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    return _drained(landing.deduplicated(twice).select("transaction_id", "user_id", "amount", "timestamp"))


@query("n3_stream_daily_kpis")
def _(spark, d):
    """All days, the open ones too; the approximate distinct counts are held against exact ones."""
    out = scratch_path(spark, "stream")
    kpis = live.daily_kpis(adapters.transaction_stream(spark, d))
    live.write_updates(kpis, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    days = live.latest_rows(spark.read.parquet(f"{out}/rows"), "transaction_date")
    exact = marts.daily_kpis(_activity(spark, d)).select(
        "transaction_date", F.col("active_transacting_users").alias("users"), F.col("active_merchants").alias("merchants"))

    def close(estimate, count):  # three standard errors of the sketch, and one for small counts
        return F.abs(F.col(estimate) - F.col(count)) <= 0.15 * F.col(count) + 1

    return days.join(exact, "transaction_date").select(
        "transaction_date", "total_transactions", "total_gmv", "avg_ticket_size", "fraud_incident_count",
        "total_fraud_amount", "fraud_rate_pct", close("active_transacting_users", "users").alias("users_close"),
        close("active_merchants", "merchants").alias("merchants_close"))


@query("n4_stream_scoring")
def _(spark, d):
    tx = adapters.transaction_stream(spark, d)
    payloads = tx.select(F.to_json(F.struct(
        "transaction_id", "user_id", "merchant_id", "amount", "channel", "card_type", "device_type",
        "country", "distance_from_home_km", F.hour("timestamp").alias("hour_of_day"))).alias("payload"))
    answers = _drained(live.scored_requests(payloads, _users(spark, d), _merchants(spark, d)))
    return answers.withColumn("factors", F.array_join("factors", "; "))


@query("n4_current_versions")
def _(spark, d):
    """Requests in two micro-batches, users published anew between them: which baseline each request met."""
    root, files = scratch_path(spark, "lookups"), spark.sparkContext.defaultParallelism
    tx = _tx(spark, d).select("transaction_id", "user_id", "timestamp")
    users = _users(spark, d).select("user_id", "baseline_spend")

    def met(batch, tables):
        return batch.join(tables["users"], "user_id").select("transaction_id", "baseline_spend")

    for factor, days in ((1, (1, 15)), (2, (16, 31))):
        lake.write_snapshot(users.withColumn("baseline_spend", F.col("baseline_spend") * factor), f"{root}/master", "users")
        part = tx.where(F.dayofmonth("timestamp").between(*days))
        part.repartition(files).write.mode("append").parquet(f"{root}/arriving")
        stream = spark.readStream.schema(tx.schema).parquet(f"{root}/arriving")
        live.with_current_tables(stream, f"{root}/master", met, root, f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/rows").drop("epoch")


@query("n5_stream_velocity")
def _(spark, d):
    """The month arriving in five parts, one micro-batch each, a part in as many files as tasks can run."""
    root, files = scratch_path(spark, "velocity"), spark.sparkContext.defaultParallelism
    tx = _tx(spark, d).select("transaction_id", "user_id", "timestamp", "amount")
    for days in [(1, 6), (7, 12), (13, 18), (19, 24), (25, 31)]:
        part = tx.where(F.dayofmonth("timestamp").between(*days))
        part.repartition(files).write.mode("append").parquet(f"{root}/arriving")
    stream = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/arriving")
    live.velocity_stream(stream, root, f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/velocity").select(
        "transaction_id", "tx_count_last_1h", "total_spend_last_24h", "prev_tx_timestamp", "seconds_since_prev_tx")


# --- P: jobs -----------------------------------------------------------------

@query("p1_medallion_job")
def _(spark, d):
    sources = {"transactions": adapters.clean_transactions(spark, d),
               "users": adapters.users(spark, d), "merchants": _merchants(spark, d)}
    root = scratch_path(spark, "lake")
    jobs.run_medallion(spark, sources, root)
    runs = lake.read_report(spark, schemas.RUN_TELEMETRY, f"{root}/reports/runs")
    return runs.select(F.explode("stages").alias("stage", "s"), F.col("status").alias("run_status")).select(
        "run_status", "stage", F.col("s.status").alias("stage_status"), F.explode("s.counts").alias("item", "n"))


@query("p2_training_job")
def _(spark, d):
    """The metrics of the run as the ledger holds them."""
    root, entry = _trained(spark, d)
    runs = lake.read_report(spark, schemas.TRAINING_RUN, f"{root}/runs").where(F.col("run_id") == entry["run_id"])
    return runs.select(F.explode("metrics").alias("metric", "value"))


@query("p3_drift_job")
def _(spark, d):
    stored = jobs.run_drift(spark, *_sample_drift(spark, d), f"{scratch_path(spark, 'drift')}/report")
    return drift.flat_report(stored)


@query("p4_batch_scoring_job")
def _(spark, d):
    path = scratch_path(spark, "scores")
    jobs.run_batch_scoring(spark, _requests(spark, d), _users(spark, d), _merchants(spark, d), _bundle(spark, d), path)
    return spark.read.parquet(path).withColumn("factors", F.array_join("factors", "; "))


@query("p4_stored_answer_checks")
def _(spark, d):
    path = scratch_path(spark, "scores")
    jobs.run_batch_scoring(spark, _requests(spark, d), _users(spark, d), _merchants(spark, d), _bundle(spark, d), path)
    return _answer_checks(spark.read.parquet(path)).withColumn("factors", F.array_join("factors", "; "))
