"""Scoring requests: enrichment, reason codes, decision bands and responses.

Every function works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.money import round_half_up, total_where
from riskloom.functions.rules import (
    ANALYST_RATIO_CUT, RATIO_CUT, analyst_reason_codes, decision, flag, is_night, reason_codes, risk_score, rule_score, spend_ratio,
)
from riskloom.plans.training import ModelBundle, predict

# What scoring assumes about users and merchants it does not know.
UNKNOWN_USER = {"account_age_days": 180, "kyc_verified": 1, "baseline_spend": 50.0}
UNKNOWN_MERCHANT = {"risk_tier": "Medium", "chargeback_history_rate": 0.015}
NULL_HOUR = 12
UNKNOWN_TIER_SCORE = 0.5


def look_up(requests: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """Attach user and merchant attributes; unknown ids get the default record.

    Both dimensions hold one row per key. The joins carry no broadcast hint:
    the optimizer broadcasts a side it has measured to be small.
    """
    profile = users.select(
        "user_id",
        *[F.col(c).alias(f"u_{c}") for c in UNKNOWN_USER],
        F.col("country").alias("u_country"),
        F.lit(True).alias("u_known"),
    )
    shop = merchants.select(
        "merchant_id",
        *[F.col(c).alias(f"m_{c}") for c in UNKNOWN_MERCHANT],
        F.lit(True).alias("m_known"),
    )

    def known_or(prefix: str, name: str, default: Column) -> Column:
        return F.when(F.col(f"{prefix}_known"), F.col(f"{prefix}_{name}")).otherwise(default)

    joined = requests.join(profile, "user_id", "left").join(shop, "merchant_id", "left")
    return joined.withColumns({
        **{c: known_or("u", c, F.lit(v)) for c, v in UNKNOWN_USER.items()},
        "home_country": known_or("u", "country", F.col("country")),
        **{c: known_or("m", c, F.lit(v)) for c, v in UNKNOWN_MERCHANT.items()},
    }).drop(*[c for c in joined.columns if c.startswith(("u_", "m_"))])


def enrich(requests: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """Requests with every model input. The weekend flag is always 0 online."""
    known = look_up(requests, users, merchants).withColumn(
        "hour_of_day", F.coalesce("hour_of_day", F.lit(NULL_HOUR))
    )
    return known.withColumns({
        "is_weekend": F.lit(0),
        "is_night": is_night(F.col("hour_of_day")),
        "is_cross_border": flag(~F.col("country").eqNullSafe(F.col("home_country"))),
        "amount_to_baseline_ratio": spend_ratio(F.col("amount"), F.col("baseline_spend")),
        "merchant_risk_score": risk_score(F.col("risk_tier"), UNKNOWN_TIER_SCORE),
    })


def score_by_rules(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn(
        "score", rule_score(F.col("amount"), F.col("is_cross_border"), F.col("hour_of_day"))
    )


def score_by_model(enriched: DataFrame, bundle: ModelBundle) -> DataFrame:
    return predict(enriched, bundle)


def with_reasons(enriched: DataFrame, ratio_cut: float = RATIO_CUT) -> DataFrame:
    return enriched.withColumn("factors", reason_codes(ratio_cut))


def with_analyst_reasons(
    enriched: DataFrame, merchants: DataFrame, ratio_cut: float = ANALYST_RATIO_CUT
) -> DataFrame:
    """The analysts' wordier variant; also names the merchant category."""
    named = enriched.join(merchants.select("merchant_id", "category"), "merchant_id", "left")
    return named.withColumn("factors", analyst_reason_codes(ratio_cut))


def responses(scored: DataFrame, model_version: str) -> DataFrame:
    """Response records: the decision looks at the unrounded score, the record shows four digits."""
    return with_reasons(scored).withColumn("_d", decision(F.col("score"))).select(
        "transaction_id",
        round_half_up(F.col("score"), 4).alias("fraud_probability"),
        F.col("_d.decision").alias("decision"),
        F.col("_d.risk_tier").alias("risk_tier"),
        "factors",
        F.lit(model_version).alias("model_version"),
    )


def batch_summary(answers: DataFrame) -> DataFrame:
    """One row: total_processed and flagged_count (declined or sent to review)."""
    flagged = F.col("decision").isin("DECLINE_FRAUD", "MANUAL_REVIEW")
    return answers.agg(
        F.count("*").alias("total_processed"),
        F.coalesce(F.sum(F.when(flagged, 1).otherwise(0)), F.lit(0)).alias("flagged_count"),
    )


def flag_at(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn("predicted_fraud", F.col("score") >= threshold)


def flagging_kpis(flagged: DataFrame) -> DataFrame:
    """One row: transactions, flagged count and share, flagged amount, mean score."""
    hit = F.col("predicted_fraud")
    hits = F.coalesce(F.sum(F.when(hit, 1).otherwise(0)), F.lit(0))
    # scores carry four decimals, so they are averaged as whole ten-thousandths
    units = F.sum(F.floor(F.col("score") * 10000.0 + 0.5))
    return flagged.agg(
        F.count("*").alias("total_transactions"),
        hits.alias("flagged_count"),
        (hits / F.nullif(F.count("*"), F.lit(0)) * 100).alias("flagged_pct"),
        F.coalesce(total_where(hit, F.col("amount")), F.lit(0.0)).alias("flagged_amount"),
        (units / F.nullif(F.count("score"), F.lit(0)) / F.lit(10000.0)).alias("avg_score"),
    )


def highest_scores(scored: DataFrame, n: int = 50) -> DataFrame:
    return scored.orderBy(F.desc("score"), "transaction_id").limit(n)
