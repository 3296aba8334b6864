"""Flags, bands, reason codes and the rule score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.money import round_half_up

# Results must carry exactly these labels, cuts, weights and texts.
TENURE_LIMITS = [(30, "New (<30d)"), (181, "Established (1-6m)"), (366, "Mature (6-12m)")]  # days below
TENURE_REST = "Veteran (>1yr)"
SEVERITY_CUTS = [(2000, "CRITICAL"), (500, "HIGH")]
SEVERITY_REST = "MEDIUM"
RISK_TIER_SCORES = {"Low": 0.1, "Medium": 0.5, "High": 0.9}
KYC_LABELS = {0: "Unverified (No KYC)", 1: "KYC Verified"}
OPS_STATUS = "FLAGGED_FOR_REVIEW"
DECISION_BANDS = [
    (0.80, "DECLINE_FRAUD", "CRITICAL"),
    (0.50, "MANUAL_REVIEW", "HIGH"),
    (0.25, "APPROVE_WITH_CHALLENGE", "ELEVATED"),
]
DECISION_REST = ("APPROVE", "LOW")
RATIO_CUT = 5.0
ANALYST_RATIO_CUT = 4.0
FAR_KM = 2000.0
REASONS = {
    "ratio": "Amount {}x higher than user average spend",
    "distance": "Abnormal distance: {} km",
    "night": "Late-night transaction window",
    "border": "Cross-border country mismatch",
    "tier": "High-risk merchant category (crypto/luxury)",
}
NO_REASON = "Normal transactional pattern"
ANALYST_REASONS = {
    "ratio": "Amount is {}x higher than customer typical spend (${})",
    "distance": "Abnormal distance: {} km away from cardholder registered home",
    "night": "Late-night activity window ({}:00)",
    "border": "Cross-border transaction ({}) does not match home country ({})",
    "tier": "Merchant is high-risk category: {}",
}
RULE_BASE, RULE_LARGE, RULE_BORDER, RULE_SMALL_HOURS, RULE_CAP = 0.05, 0.3, 0.25, 0.2, 0.99
LARGE_AMOUNT = 3000
SMALL_HOURS = [0, 1, 2, 3]


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def is_fraud() -> Column:
    return F.col("is_fraud") == 1


def is_weekend(ts: Column) -> Column:
    return flag(F.weekday(ts).isin(5, 6))


def is_night(hour: Column) -> Column:
    """23:00 to 05:59."""
    return flag((hour < 6) | (hour > 22))


def banded(value: Column, cuts: list[tuple], rest: str, below: bool = False) -> Column:
    """Label of the first cut the value reaches (or stays below); ``rest`` when none, or null."""
    label = F.lit(rest)
    for cut, name in reversed(cuts):
        label = F.when(value < cut if below else value >= cut, F.lit(name)).otherwise(label)
    return label


def tenure_cohort(age_days: Column) -> Column:
    """Account-age bracket in whole days; a missing age falls into the last one."""
    return banded(age_days, TENURE_LIMITS, TENURE_REST, below=True)


def severity(amount: Column) -> Column:
    return banded(amount, SEVERITY_CUTS, SEVERITY_REST)


def mapped(value: Column, table: dict, rest: Column) -> Column:
    """Value looked up in a small fixed table."""
    found = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[value]
    return F.coalesce(found, rest)


def risk_score(tier: Column, unknown: float) -> Column:
    """Merchant tier to number; features and scoring differ in the ``unknown`` value."""
    return mapped(tier, RISK_TIER_SCORES, F.lit(unknown))


def kyc_label(kyc: Column) -> Column:
    return mapped(kyc, KYC_LABELS, F.lit(None).cast("string"))


def spend_ratio(amount: Column, baseline: Column) -> Column:
    """Amount over the user's baseline, which is floored at 1; null baseline gives null."""
    return amount / F.when(baseline < 1.0, F.lit(1.0)).otherwise(baseline)


def fixed(value: Column, digits: int) -> Column:
    """Text with exactly ``digits`` decimals, rounded half up, never in E notation."""
    return round_half_up(value, digits).cast(f"decimal(30,{digits})").cast("string")


def filled(text: str, *values: Column) -> Column:
    """The text with its ``{}`` places filled in order."""
    pieces = text.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        parts += [value, F.lit(piece)]
    return F.concat(*parts)


def _listed(met: dict[str, Column], texts: dict[str, Column]) -> Column:
    """Texts of the met conditions, in the order of the conditions."""
    candidates = F.array(*[F.when(met[key], texts[key]) for key in met])
    return F.filter(candidates, lambda text: text.isNotNull())


def _conditions(ratio_cut: float) -> dict[str, Column]:
    """What stands out in an enriched request."""
    return {
        "ratio": F.col("amount_to_baseline_ratio") > ratio_cut,
        "distance": F.col("distance_from_home_km") > FAR_KM,
        "night": F.col("is_night") == 1,
        "border": F.col("is_cross_border") == 1,
        "tier": F.col("risk_tier") == "High",
    }


def reason_codes(ratio_cut: float = RATIO_CUT) -> Column:
    """Ordered explanations of an enriched request; one neutral entry when nothing stands out."""
    fillings = {
        "ratio": [fixed(F.col("amount_to_baseline_ratio"), 1)],
        "distance": [F.col("distance_from_home_km").cast("string")],
    }
    found = _listed(
        _conditions(ratio_cut), {k: filled(text, *fillings.get(k, [])) for k, text in REASONS.items()}
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(NO_REASON)))


def analyst_reason_codes(ratio_cut: float = ANALYST_RATIO_CUT) -> Column:
    """Wordier variant for analysts, also naming the ``category``; empty when nothing stands out."""
    fillings = {
        "ratio": [fixed(F.col("amount_to_baseline_ratio"), 1), fixed(F.col("baseline_spend"), 2)],
        "distance": [fixed(F.col("distance_from_home_km"), 1)],
        "night": [F.col("hour_of_day").cast("string")],
        "border": [F.col("country"), F.col("home_country")],
        "tier": [F.col("category")],
    }
    return _listed(
        _conditions(ratio_cut), {k: filled(text, *fillings[k]) for k, text in ANALYST_REASONS.items()}
    )


def decision(probability: Column) -> Column:
    """Struct (decision, risk_tier), banded on the unrounded probability."""
    actions = banded(probability, [(cut, action) for cut, action, _ in DECISION_BANDS], DECISION_REST[0])
    tiers = banded(probability, [(cut, tier) for cut, _, tier in DECISION_BANDS], DECISION_REST[1])
    return F.struct(actions.alias("decision"), tiers.alias("risk_tier"))


def rule_score(amount: Column, cross_border: Column, hour: Column) -> Column:
    """Additive score of a large amount, a foreign country and small hours, capped."""
    def points(condition: Column, weight: float) -> Column:
        return F.when(condition, weight).otherwise(0.0)

    raw = (
        F.lit(RULE_BASE)
        + points(amount > LARGE_AMOUNT, RULE_LARGE)
        + points(cross_border == 1, RULE_BORDER)
        + points(hour.isin(SMALL_HOURS), RULE_SMALL_HOURS)
    )
    return round_half_up(F.least(raw, F.lit(RULE_CAP)), 4)
