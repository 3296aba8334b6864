"""Operators against brute force on small frames, skewed ones included."""

import collections
import random
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.functions import money, rules
from riskloom.operators import checksum, dedup, drift, histogram, metrics, ordered, sampling, slots, velocity
from riskloom.plans import marts
from riskloom.plans.silver import staging_transactions

BASE = datetime(2024, 1, 1)


# --- scalar rules

@pytest.mark.parametrize("value,digits,expected", [(1.005, 2, 1.0), (2.5, 0, 3.0), (0.12345, 4, 0.1235)])
def test_round_half_up(spark, value, digits, expected):
    assert spark.range(1).select(money.round_half_up(F.lit(value), digits)).first()[0] == expected


def test_night_weekend_and_tenure(spark):
    hours = {r["id"]: r["n"] for r in spark.range(24).withColumn("n", rules.is_night(F.col("id"))).collect()}
    assert [h for h, n in hours.items() if n] == [0, 1, 2, 3, 4, 5, 23]
    ages = spark.createDataFrame([(29,), (30,), (180,), (181,), (365,), (366,), (None,)], "age int")
    labels = [r[0] for r in ages.select(rules.tenure_cohort(F.col("age"))).collect()]
    new, established, mature = (name for _, name in rules.TENURE_LIMITS)
    veteran = rules.TENURE_REST
    assert labels == [new, established, established, mature, mature, veteran, veteran]


def test_decision_bands_use_unrounded_scores(spark):
    scores = spark.createDataFrame([(0.79999,), (0.8,), (0.5,), (0.49999,), (0.25,), (0.1,)], "p double")
    got = [r[0] for r in scores.select(rules.decision(F.col("p"))["decision"]).collect()]
    assert got == ["MANUAL_REVIEW", "DECLINE_FRAUD", "MANUAL_REVIEW", "APPROVE_WITH_CHALLENGE",
                   "APPROVE_WITH_CHALLENGE", "APPROVE"]


def test_unknown_tiers_take_the_given_score(spark):
    df = spark.createDataFrame([("Low",), ("High",), ("Other",), (None,)], "t string")
    assert [r[0] for r in df.select(rules.risk_score(F.col("t"), 0.2)).collect()] == [0.1, 0.9, 0.2, 0.2]


def test_spend_ratio_keeps_missing_baseline(spark):
    df = spark.createDataFrame([(10.0, 0.5), (10.0, 4.0), (10.0, None)], "a double, b double")
    assert [r[0] for r in df.select(rules.spend_ratio(F.col("a"), F.col("b"))).collect()] == [10.0, 2.5, None]


# --- deduplication

def test_keep_first_is_total_and_treats_null_as_key(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m"), ("b", 1, "q")]
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(4)
    got = {tuple(r) for r in dedup.keep_first(df, "k", ["t"]).collect()}
    assert got == {("a", 1, "y"), (None, 4, "m"), ("b", 1, "q")}
    assert dedup.surplus_rows(df, "k").first()[0] == 3


def test_keep_first_limits_copies_before_the_exchange(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    kept = dedup.keep_first(df, "k", ["id"])
    assert kept.count() == 2001
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# --- velocity

def _velocity_rows(seed, users, n, instants=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = users[0] if rnd.random() < 0.34 else rnd.choice(users)
        second = rnd.choice(instants) if instants else rnd.randrange(3 * 86400)
        micro = rnd.choice([0, 0, 1])
        rows.append((f"T{i:05d}", user, BASE + timedelta(seconds=second, microseconds=micro),
                     rnd.randrange(1, 50000) / 100))
    return rows


def _brute_velocity(rows):
    out = {}
    for i, u, t, _ in rows:
        mine = [r for r in rows if r[1] == u]
        hour = [r for r in mine if t - timedelta(hours=1) <= r[2] <= t]
        day = [r for r in mine if t - timedelta(hours=24) <= r[2] <= t]
        earlier = [r for r in mine if (r[2], r[0]) < (t, i)]
        prev = max(earlier, key=lambda r: (r[2], r[0]))[2] if earlier else None
        out[i] = (len(hour), round(sum(round(r[3] * 100) for r in day) / 100, 2), prev,
                  None if prev is None else (t - prev).total_seconds())
    return out


HOURS = [h * 1800 for h in range(100)]  # gaps of exactly one hour and one day occur


VELOCITY_SCHEMA = "transaction_id string, user_id string, timestamp timestamp, amount double"


@pytest.mark.parametrize("users", [["u1", "u2", "u3", None], ["only"]])
@pytest.mark.parametrize("instants", [None, HOURS, [0, 3600], [0, 9 * 86400, 9 * 86400 + 5]])
def test_velocity_equals_brute_force(spark, users, instants):
    rows = _velocity_rows(7, users, 300, instants)
    df = spark.createDataFrame(rows, VELOCITY_SCHEMA)
    made = velocity.with_velocity(df).collect()
    got = {r["transaction_id"]: (r["tx_count_last_1h"], r["total_spend_last_24h"], r["prev_tx_timestamp"],
                                 r["seconds_since_prev_tx"]) for r in made}
    assert got == _brute_velocity(rows)


def test_one_users_day_of_a_million_instants_is_split(spark, monkeypatch):
    n, rng = 1_000_000, np.random.default_rng(3)
    times = np.sort(rng.choice(86_400_000_000, n, replace=False)) + int(BASE.timestamp()) * 1_000_000
    cents = rng.integers(1, 5_000, n)
    rows = pd.DataFrame({"transaction_id": np.char.zfill(np.arange(n).astype(str), 7), "user_id": "u", "t": times, "amount": cents / 100})
    tx = spark.createDataFrame(pa.Table.from_pandas(rows)).withColumn("timestamp", F.timestamp_micros("t")).drop("t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = tx.withColumns({"_user": F.col("user_id"), "_t": F.unix_micros("timestamp")})
        tasks = velocity.rolling_instants(velocity.instants_of(keyed)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < n / 2  # 144 units over all tasks
    got = velocity.with_velocity(tx).orderBy("transaction_id").toPandas()
    hour, day = (np.searchsorted(times, times - w) for w in (3_600_000_000, 86_400_000_000))
    spent = np.concatenate([[0], np.cumsum(cents)])
    assert (got.tx_count_last_1h == np.arange(1, n + 1) - hour).all()
    assert np.allclose(got.total_spend_last_24h, (spent[1:] - spent[day]) / 100, rtol=0, atol=1e-6)
    assert np.allclose(got.seconds_since_prev_tx[1:], np.diff(times) / 1e6, rtol=0, atol=1e-9) and pd.isna(got.seconds_since_prev_tx[0])


def test_a_window_without_known_amounts_has_no_spend(spark):
    day = timedelta(days=1)
    rows = [("a", "u", BASE, 1.0), ("b", "u", BASE + day, None), ("c", "u", BASE + 2 * day, None),
            ("d", "u", BASE + 2 * day + timedelta(microseconds=1), float("nan")), ("e", "v", BASE, None)]
    got = velocity.with_velocity(spark.createDataFrame(rows, VELOCITY_SCHEMA)).select("transaction_id", "total_spend_last_24h")
    assert dict(got.collect()) == {"a": 1.0, "b": 1.0, "c": None, "d": None, "e": None}


@pytest.mark.parametrize("unit", [velocity.HOUR, velocity.HOUR // 60])
def test_the_unit_changes_no_result(spark, monkeypatch, unit):
    rows = _velocity_rows(9, ["u1", "u2"], 200, HOURS)
    tx = spark.createDataFrame(rows, VELOCITY_SCHEMA).withColumns({"_user": F.col("user_id"), "_t": F.unix_micros("timestamp")})
    instants = velocity.instants_of(tx)
    other = velocity.rolling_instants(instants, unit)
    assert sorted(map(str, other.collect())) == sorted(map(str, velocity.rolling_instants(instants).collect()))
    with pytest.raises(ValueError):
        velocity.rolling_instants(instants, 7)


def test_rows_without_a_time_see_each_other_only(spark):
    rows = [("a", "u", None, 1.5), ("b", "u", None, 2.0), ("c", "u", BASE, 4.0), ("d", None, None, 8.0)]
    got = {r[0]: r[1:] for r in velocity.with_velocity(spark.createDataFrame(rows, VELOCITY_SCHEMA)).select(
        "transaction_id", *velocity.VELOCITY_COLUMNS).collect()}
    assert got == {"a": (2, 3.5, None, None), "b": (2, 3.5, None, None), "c": (1, 4.0, None, None),
                   "d": (1, 8.0, None, None)}


FACT_SCHEMA = (
    "transaction_id string, user_id string, merchant_id string, amount double, currency string, timestamp timestamp, "
    "channel string, card_type string, device_type string, ip_address string, country string, "
    "distance_from_home_km double, is_fraud int, fraud_type string"
)


def _shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(i).isShuffle() for i in range(blocks.size()))


def test_the_fact_is_made_in_turns_and_leaves_no_shuffle_files(spark, monkeypatch):
    rng = random.Random(3)
    users = [None, "", *(f"u{i}" for i in range(30))]
    rows = [
        (
            rng.choice([None, f"t{rng.randrange(250)}"]) if i % 9 == 0 else f"t{rng.randrange(250)}", rng.choice(users), "m",
            rng.choice([None, float("nan"), -1.0, 0.0, 1.25, 10.5]), "USD",
            None if i % 11 == 0 else BASE + timedelta(minutes=rng.randrange(3000)),
            "web", "credit", "ios", "ip", "X", float(i), i % 2, "NONE",
        )
        for i in range(600)
    ]
    tx = spark.createDataFrame([*rows, *rows[:50]], FACT_SCHEMA)
    plain = marts._moving(staging_transactions(dedup.keep_first(tx, "transaction_id", ["timestamp"])))
    expected = collections.Counter(map(str, plain.collect()))
    assert expected.total() > 60
    before, taken = _shuffle_files(spark), []
    monkeypatch.setattr(slots, "TURN_ROWS", 60)
    monkeypatch.setattr(marts, "_moving", lambda part, make=marts._moving: taken.append(part) or make(part))
    made = marts.fact_with_velocity(tx)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert made.schema.simpleString() == plain.schema.simpleString() and len(taken) > 1
    for _ in range(100):  # files are removed in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(slots.CLEANUP) == "false"
    assert collections.Counter(map(str, made.collect())) == expected
    assert marts.fact_with_velocity(tx.where("false")).collect() == []


@pytest.mark.parametrize("turn_rows", [1, 40, 10**6])
def test_turns_hold_every_row_and_whole_keys(spark, monkeypatch, turn_rows):
    monkeypatch.setattr(slots, "TURN_ROWS", turn_rows)
    rows = [(None if i % 7 == 0 else f"k{i % 13}", i) for i in range(200)]
    turns = [t.collect() for t in slots.in_turns(slots.stored([spark.createDataFrame(rows, "k string, i int")], "test", "k"))]
    assert sorted(r.i for t in turns for r in t) == list(range(200))
    keys = [{r.k for r in t} for t in turns]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 14
    assert len(turns) == 1 if turn_rows > 200 else len(turns) > 1


def test_velocity_starts_no_job_while_the_plan_is_built(spark):
    df = spark.createDataFrame(_velocity_rows(1, ["a", "b"], 10), VELOCITY_SCHEMA)
    spark.sparkContext.setJobGroup("plan", "velocity")
    velocity.with_velocity(df)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setJobGroup("tests", "")


# --- running totals

@pytest.mark.parametrize("slices", [None, 4, 60])
def test_running_totals_do_not_depend_on_slices(spark, slices):
    df = spark.range(500).select(
        F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("g"),
        (F.col("id") * 1.5).alias("v"), (F.col("id") % 7).alias("n"))
    stored = ordered.stored_slices(df, "g", "v", slices)
    got = {(r["g"], r["v"]): (r["cum_n"], r["next_v"])
           for r in ordered.running_totals(stored, "g", "v", ["n"]).collect()}
    expected, totals, last = {}, {"a": 0, "b": 0}, {}
    for i in range(500):
        g, v = ("b" if i % 5 == 0 else "a"), i * 1.5
        totals[g] += i % 7
        expected[g, v] = [totals[g], None]
        if g in last:
            expected[g, last[g]][1] = v
        last[g] = v
    assert got == {k: tuple(v) for k, v in expected.items()}


def test_slices_are_even_when_one_value_holds_most_rows(spark):
    rows = spark.range(200_000).select(
        F.lit("f").alias("g"), F.when(F.col("id") % 100 > 0, 10.0).otherwise(F.col("id") * 1.0).alias("v"))
    counts = rows.groupBy("g", "v").agg(F.count("*").alias("n"))
    sizes = [r["count"] for r in ordered.stored_slices(counts, "g", "v", 8).groupBy("_slice").count().collect()]
    assert sum(sizes) == 2001 and max(sizes) < 2 * 2001 / 8


# --- drift

def _sides(spark, ref, cur):
    return (spark.createDataFrame([(float(v),) for v in ref], "amount double"),
            spark.createDataFrame([(float(v),) for v in cur], "amount double"))


def _numpy_psi(ref, cur):
    edges = np.percentile(ref, np.linspace(0, 100, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    e = np.clip(np.histogram(ref, edges)[0] / len(ref), 1e-4, 1)
    a = np.clip(np.histogram(cur, edges)[0] / len(cur), 1e-4, 1)
    return float(np.sum((a - e) * np.log(a / e)))


@pytest.mark.parametrize("slices", [None, 20])
def test_drift_statistics_equal_numpy(spark, slices):
    rng = np.random.default_rng(3)
    ref = np.round(rng.lognormal(3, 1, 400), 2)
    cur = np.concatenate([np.round(rng.lognormal(3.4, 1, 250), 2), np.full(125, 20.0)])  # a third is one value
    got = drift.bucket_counts(drift.distribution(*_sides(spark, ref, cur), ["amount"], slices)).withColumn(
        "psi", drift.psi()).first()
    xs = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), xs, "right") / len(ref)
    g = np.searchsorted(np.sort(cur), xs, "right") / len(cur)
    assert got["ks"] == pytest.approx(np.abs(f - g).max(), abs=1e-12)
    assert got["wasserstein"] == pytest.approx(np.sum(np.abs(f - g)[:-1] * np.diff(xs)), abs=1e-9)
    assert got["psi"] == pytest.approx(_numpy_psi(ref, cur), abs=1e-9)


def test_psi_with_repeated_edges(spark):
    ref, cur = [0.0] * 60 + list(range(40)), [0.0] * 10 + list(range(90))
    counted = drift.bucket_counts(drift.distribution(*_sides(spark, ref, cur), ["amount"]))
    assert counted.select(drift.psi()).first()[0] == pytest.approx(_numpy_psi(np.array(ref, float), np.array(cur, float)))


def test_scaled_amounts_raise_an_alert(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.lognormal(4, 1, 200), 2)
    ref, cur = _sides(spark, values, values * 5)
    report = drift.drift_report(ref, cur, ["amount"], drift.DriftThresholds(psi=0.15)).first()
    assert report["overall_status"] == "DRIFT_ALERT" and report["drifting_features"] == ["amount"]
    same = drift.drift_report(ref, ref, ["amount"]).first()
    assert same["overall_status"] == "STABLE" and same["feature_metrics"]["amount"]["p_value"] == 1.0
    assert (report["reference_sample_size"], report["current_sample_size"]) == (200, 200)


def test_absent_features_are_skipped_and_nulls_dropped(spark):
    ref = spark.createDataFrame([(1.0, 2), (None, 3)], "amount double, hour_of_day int")
    cur = spark.createDataFrame([(1.0,)], "amount double")
    assert drift.shared_features(ref, cur) == ["amount"]
    row = drift.drift_metrics(ref, cur).first()
    assert (row["feature"], row["ks_statistic"]) == ("amount", 0.0)


def test_nan_counts_as_missing_and_no_rows_are_no_data(spark):
    values = [(float(v),) for v in range(50)]
    ref = spark.createDataFrame(values, "amount double")
    cur = spark.createDataFrame([*values, (float("nan"),)], "amount double")
    row = drift.drift_metrics(ref, cur, ["amount"]).first()
    assert (row["ks_statistic"], row["wasserstein_distance"], row["psi_score"]) == (0.0, 0.0, 0.0)
    assert drift.drift_report(ref, cur.limit(0), ["amount"]).first()["overall_status"] == "NO_DATA"


# --- money

def test_sums_keep_parts_of_a_cent_and_skip_nan(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (float("nan"),), (None,)], "amount double")
    got = df.agg(money.total(F.col("amount")), money.mean(F.col("amount")),
                 money.total_where(F.col("amount") > 0, F.col("amount"))).first()
    assert tuple(got)[0] == 0.012 and abs(got[1] - 0.004) < 1e-12
    many = spark.range(100_000).select((F.col("id") % 100 / 100.0 + 1e6).alias("amount"))
    assert many.agg(money.total(F.col("amount"))).first()[0] == 1e11 + 49_500.0


# --- metrics

@pytest.mark.parametrize("slices", [None, 40])
def test_ranking_metrics_equal_brute_force(spark, slices):
    rnd = random.Random(11)
    rows = [(int(rnd.random() < 0.3), round(rnd.random(), 2) if rnd.random() > 0.33 else 0.5) for _ in range(200)]
    scored = spark.createDataFrame(rows, "label int, score double")
    got = metrics.ranking_metrics(metrics.score_steps(scored, slices=slices)).first()
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(s >= t for s in pos)
        ap += (tp - seen) / len(pos) * tp / (tp + sum(s >= t for s in neg))
        seen = tp
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert got["average_precision"] == pytest.approx(ap, abs=1e-12)


def test_threshold_metrics_are_zero_when_undefined(spark):
    scored = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    assert tuple(metrics.threshold_metrics(metrics.confusion(scored)).first()) == (0.0, 0.0, 0.0)


# --- sampling, histogram, checksum

@pytest.mark.parametrize("share,positives", [(0.2, 33), (0.0, 10), (1.0, 5), (0.2, 1)])
def test_split_sizes_are_exact_per_class(spark, share, positives):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") < positives).cast("int").alias("y"))
    made = sampling.stratified_split(df.repartition(5), "k", "y", share)
    got = {r["y"]: (r["n"], r["t"]) for r in made.groupBy("y").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert got == {y: (n, int(n * share + 0.5)) for y, n in ((0, 500 - positives), (1, positives))}
    other = sampling.stratified_split(df.coalesce(1), "k", "y", share)
    assert made.where("is_test").select("k").exceptAll(other.where("is_test").select("k")).isEmpty()


def test_sample_has_fixed_size_and_members(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    one = {r[0] for r in sampling.fixed_size_sample(df.repartition(7), "k", 50).collect()}
    assert one == {r[0] for r in sampling.fixed_size_sample(df.coalesce(1), "k", 50).collect()} and len(one) == 50


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (9.99,), (None,)], "v double")
    assert {r["bin"]: r["n"] for r in histogram.histogram(df, "v", 10).collect()} == {0: 1, 9: 2}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert {r["bin"]: r["n"] for r in histogram.histogram(flat, "v", 10).collect()} == {0: 2}


def test_checksum_ignores_order_and_sees_changes(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("a"), (F.col("id") / 7).alias("b"))
    first = checksum.content_checksum(df).first()["content_checksum"]
    assert checksum.content_checksum(df.repartition(6).orderBy(F.desc("b"))).first()["content_checksum"] == first
    changed = df.withColumn("a", F.when(F.col("a") == "5", None).otherwise(F.col("a")))
    assert checksum.content_checksum(changed).first()["content_checksum"] != first
