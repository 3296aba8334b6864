"""Distribution drift between a reference and a current table.

All measures read one relation: rows per distinct value, feature and side, with
running totals along the value. The raw rows are touched by one pre-aggregation
only, which is combined before the exchange. NaN counts as missing, like null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.money import round_half_up
from riskloom.operators.ordered import running_totals, stored_slices

# The features that are watched.
DEFAULT_FEATURES = [
    "amount", "distance_from_home_km", "hour_of_day", "account_age_days", "baseline_spend",
]
BUCKETS = 10
ALL_ROWS = ""  # stands for the rows themselves, where they are counted along
SERIES_TERMS = 100


@dataclass(frozen=True)
class DriftThresholds:
    psi: float = 0.20
    p_value: float = 0.05


def shared_features(reference: DataFrame, current: DataFrame, wanted: list[str] | None = None) -> list[str]:
    """The wanted features both sides have, in order; others are skipped."""
    both = set(reference.columns) & set(current.columns)
    return [f for f in (wanted or DEFAULT_FEATURES) if f in both]


def melt(reference: DataFrame, current: DataFrame, features: list[str], count_rows: bool = False) -> DataFrame:
    """Values that are neither null nor NaN as rows (feature, value, n_ref, n_cur), one per value and source row.

    With ``count_rows`` a feature named ``ALL_ROWS`` has one value for every row.
    """
    def side(df: DataFrame, ref: int) -> DataFrame:
        values = {f: F.col(f).cast("double") for f in features} | ({ALL_ROWS: F.lit(0.0)} if count_rows else {})
        pairs = F.array(*[F.struct(F.lit(f).alias("feature"), v.alias("value")) for f, v in values.items()])
        return df.select(F.inline(pairs)).where("value is not null and not isnan(value)").select(
            "feature", "value",
            F.lit(ref).cast("bigint").alias("n_ref"), F.lit(1 - ref).cast("bigint").alias("n_cur"),
        )

    return side(reference, 1).unionByName(side(current, 0))


def distribution(
    reference: DataFrame, current: DataFrame, features: list[str], slices: int | None = None, count_rows: bool = False
) -> DataFrame:
    """Rows (feature, value, n_ref, n_cur, cum_ref, cum_cur, next_value, size_ref, size_cur).

    The counts per distinct value are made here, in one pass over the rows, and stored.
    """
    rows = melt(reference, current, features, count_rows)
    counts = rows.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    stored = stored_slices(counts, "feature", "value", slices)
    sizes = stored.groupBy("feature").agg(F.sum("n_ref").alias("size_ref"), F.sum("n_cur").alias("size_cur"))
    run = running_totals(stored, "feature", "value", ["n_ref", "n_cur"])
    return run.withColumnsRenamed({"cum_n_ref": "cum_ref", "cum_n_cur": "cum_cur"}).join(
        F.broadcast(sizes), "feature")  # one row per feature


def feature_statistics(dist: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows (feature, size_ref, size_cur, ks, wasserstein, edges), from one aggregate.

    ``edges`` are the inner quantiles of the reference: linear interpolation
    between the two neighbouring ranks, picked from the running totals, so no
    buffer holds a feature's values.
    """
    gap = "abs(cum_ref / nullif(size_ref, 0) - cum_cur / nullif(size_cur, 0))"
    positions = [f"((size_ref - 1) * {i / buckets!r}D)" for i in range(1, buckets)]

    def at_ranks(ranks: list[str]) -> Column:
        picked = [f"min(if(n_ref > 0 and cum_ref > {rank}, value, null))" for rank in ranks]
        return F.expr(f"array({', '.join(picked)})")

    folded = dist.groupBy("feature", "size_ref", "size_cur").agg(
        F.expr(f"max({gap})").alias("ks"),
        F.expr(f"sum({gap} * (coalesce(next_value, value) - value))").alias("wasserstein"),
        at_ranks([f"floor({p})" for p in positions]).alias("lo"),
        at_ranks([f"least(floor({p}) + 1, size_ref - 1)" for p in positions]).alias("hi"),
    )
    edges = ", ".join(f"lo[{i}] + (hi[{i}] - lo[{i}]) * ({p} - floor({p}))" for i, p in enumerate(positions))
    return folded.select(
        "feature", "size_ref", "size_cur", "ks", "wasserstein", F.expr(f"array({edges})").alias("edges")
    )


def bucket_counts(dist: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The feature statistics plus ``ref_counts`` and ``cur_counts``: rows per quantile bucket.

    A value's bucket is the number of edges at or below it, so repeated edges
    leave empty buckets.
    """
    statistics = feature_statistics(dist, buckets)
    carried = [c for c in statistics.columns if c != "edges"]
    placed = dist.select("feature", "value", "n_ref", "n_cur").join(
        F.broadcast(statistics), "feature"  # one row per feature
    ).withColumn("bucket", F.expr("size(filter(edges, e -> e <= value))"))

    def per_bucket(n: str) -> Column:
        sums = [f"sum(if(bucket = {b}, {n}, 0))" for b in range(buckets)]
        return F.expr(f"array({', '.join(sums)})")

    return placed.groupBy(*carried).agg(
        per_bucket("n_ref").alias("ref_counts"), per_bucket("n_cur").alias("cur_counts")
    )


# over the columns of bucket_counts; proportions are clipped to [1e-4, 1]
_PSI = """
    case when size_ref = 0 or size_cur = 0 then 0D
    else aggregate(
        zip_with(ref_counts, cur_counts, (r, c) -> named_struct(
            'e', greatest(1e-4D, least(1D, r / nullif(size_ref, 0))),
            'a', greatest(1e-4D, least(1D, c / nullif(size_cur, 0))))),
        0D, (total, x) -> total + (x.a - x.e) * ln(x.a / x.e))
    end"""


def psi() -> Column:
    """Population stability index over the columns of ``bucket_counts``."""
    return F.expr(_PSI)


def ks_p_value(ks: Column, size_ref: Column, size_cur: Column) -> Column:
    """Asymptotic p-value: the Kolmogorov series, 1 for small arguments."""
    n, m = size_ref.cast("double"), size_cur.cast("double")
    lam = ks * F.sqrt(n * m / F.nullif(n + m, F.lit(0.0)))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series))
    )


def _judged(dist: DataFrame, names: list[str], thresholds: DriftThresholds) -> DataFrame:
    """One row per feature of the distribution: sizes, statistics, verdict and severity."""
    joined = bucket_counts(dist).withColumns({
        "psi": psi(),
        "p": ks_p_value(F.col("ks"), F.col("size_ref"), F.col("size_cur")),
    })
    drifting = (F.col("psi") > thresholds.psi) | (F.col("p") < thresholds.p_value)
    severity = F.when(F.col("psi") > 0.25, "HIGH").when(F.col("psi") > 0.10, "MODERATE").otherwise("NEGLIGIBLE")
    order = F.array_position(F.array(*map(F.lit, names)).cast("array<string>"), F.col("feature"))
    return joined.select(
        order.alias("feature_no"),
        "feature",
        round_half_up(F.col("ks"), 4).alias("ks_statistic"),
        round_half_up(F.col("p"), 5).alias("p_value"),
        round_half_up(F.col("psi"), 4).alias("psi_score"),
        round_half_up(F.col("wasserstein"), 4).alias("wasserstein_distance"),
        F.coalesce(drifting, F.lit(False)).alias("drift_detected"),
        severity.alias("severity"),
        "size_ref",
        "size_cur",
    )


def drift_metrics(
    reference: DataFrame,
    current: DataFrame,
    features: list[str] | None = None,
    thresholds: DriftThresholds = DriftThresholds(),
    slices: int | None = None,
) -> DataFrame:
    """One row per feature: statistics, verdict and severity.

    Verdict and severity look at the unrounded values.
    """
    names = shared_features(reference, current, features)
    return _judged(distribution(reference, current, names, slices), names, thresholds).drop("size_ref", "size_cur")


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: list[str] | None = None,
    thresholds: DriftThresholds = DriftThresholds(),
) -> DataFrame:
    """One row: overall status, sample sizes, drifting features and a metric struct per feature.

    Each side is read once: its rows are counted in the same pass as its values.
    Without rows on a side nothing can be said, and the status is NO_DATA.
    """
    names = shared_features(reference, current, features)
    judged = _judged(distribution(reference, current, names, count_rows=True), names, thresholds)
    metric = F.struct(
        "ks_statistic", "p_value", "psi_score", "wasserstein_distance", "drift_detected", "severity"
    )
    a_feature = F.col("feature") != ALL_ROWS

    def rows_of(size: str) -> Column:
        return F.coalesce(F.max(F.when(~a_feature, F.col(size))), F.lit(0)).cast("bigint")

    # collects one entry per feature
    folded = judged.agg(
        F.array_sort(F.collect_list(F.when(a_feature, F.struct("feature_no", "feature", metric.alias("metric"))))).alias("all"),
        rows_of("size_ref").alias("n_ref"), rows_of("size_cur").alias("n_cur"),
    )
    drifting = F.transform(
        F.filter("all", lambda e: e["metric"]["drift_detected"]), lambda e: e["feature"]
    )
    return folded.select(
        F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), "NO_DATA")
        .when(F.size(drifting) > 0, "DRIFT_ALERT").otherwise("STABLE").alias("overall_status"),
        F.col("n_ref").alias("reference_sample_size"),
        F.col("n_cur").alias("current_sample_size"),
        F.size(drifting).cast("bigint").alias("drifting_features_count"),
        drifting.alias("drifting_features"),
        F.map_from_entries(
            F.transform("all", lambda e: F.struct(e["feature"], e["metric"]))
        ).alias("feature_metrics"),
    )


def flat_report(report: DataFrame) -> DataFrame:
    """The report as one row per feature, as governance screens list it."""
    return report.select(F.explode("feature_metrics").alias("feature_name", "m")).select(
        "feature_name",
        F.col("m.ks_statistic").alias("ks_statistic"),
        F.col("m.p_value").alias("p_value"),
        F.col("m.psi_score").alias("psi_score"),
        F.when(F.col("m.drift_detected"), "Alert").otherwise("Stable").alias("drift_status"),
        F.col("m.severity").alias("severity_tier"),
    )


def perturbed(df: DataFrame, factor: float = 1.8, column: str = "amount") -> DataFrame:
    """The table with one column scaled, to see the monitor react."""
    return df.withColumn(column, F.col(column) * F.lit(factor))
