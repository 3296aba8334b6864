"""What-if analysis of the decision threshold: formulas over two totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.money import total_where

# Named policies, defaults, and the response of recall and false alarms
# to the threshold (slopes, offset and limits).
POLICIES = {"Conservative": 0.30, "Balanced": 0.50, "Growth": 0.70}
DEFAULT_THRESHOLD = 0.50
DEFAULT_FRICTION_COST = 25.0
FRONTIER_POINTS = 25
FRONTIER_RANGE = (0.1, 0.9)
RECALL_OFFSET, RECALL_SLOPE, RECALL_LIMITS = 0.10, 0.5, (0.40, 0.99)
ALARM_SLOPE, ALARM_LIMITS = 0.04, (0.001, 0.08)


def _within(value: Column, limits: tuple[float, float]) -> Column:
    low, high = map(F.lit, limits)
    return F.greatest(low, F.least(high, value))


def recall(threshold: Column) -> Column:
    """Share of fraud caught at a threshold; falls as the threshold rises."""
    return _within(1.0 - (threshold - RECALL_OFFSET) * RECALL_SLOPE, RECALL_LIMITS)


def false_positive_rate(threshold: Column) -> Column:
    """Share of legitimate transactions stopped at a threshold."""
    return _within((1.0 - threshold) * ALARM_SLOPE, ALARM_LIMITS)


def exposure(activity: DataFrame) -> DataFrame:
    """One row: fraud dollars and number of legitimate transactions."""
    return activity.agg(
        F.coalesce(total_where(F.col("is_fraud") == 1, F.col("amount")), F.lit(0.0)).alias("fraud_dollars"),
        F.coalesce(F.sum(F.when(F.col("is_fraud") == 0, 1).otherwise(0)), F.lit(0)).alias("legit_count"),
    )


def _outcome(points: DataFrame, friction_cost: float) -> DataFrame:
    tau, dollars = F.col("threshold"), F.col("fraud_dollars")
    alarms = (F.col("legit_count") * false_positive_rate(tau)).cast("bigint")
    prevented = dollars * recall(tau)
    return points.withColumns({
        "recall": recall(tau),
        "false_positive_rate": false_positive_rate(tau),
        "fraud_prevented": prevented,
        "fraud_leakage": dollars * (1.0 - recall(tau)),
        "fp_count": alarms,
        "friction_total": alarms * F.lit(friction_cost),
        "net_benefit": prevented - alarms * F.lit(friction_cost),
    }).drop("fraud_dollars", "legit_count")


def policy_point(
    activity: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    friction_cost: float = DEFAULT_FRICTION_COST,
) -> DataFrame:
    """Outcome at one threshold; the false-alarm count is cut to whole alarms."""
    return _outcome(exposure(activity).withColumn("threshold", F.lit(threshold)), friction_cost)


def named_policies(activity: DataFrame, friction_cost: float = DEFAULT_FRICTION_COST) -> DataFrame:
    choices = F.array(*[
        F.struct(F.lit(name).alias("policy"), F.lit(tau).alias("threshold"))
        for name, tau in POLICIES.items()
    ])
    points = exposure(activity).select("fraud_dollars", "legit_count", F.inline(choices))
    return _outcome(points, friction_cost)


def frontier(activity: DataFrame, friction_cost: float = DEFAULT_FRICTION_COST) -> DataFrame:
    """Net savings at evenly spaced thresholds 0.1..0.9; false alarms are not cut here."""
    first, last = FRONTIER_RANGE
    step = (last - first) / (FRONTIER_POINTS - 1)
    numbers = F.sequence(F.lit(0), F.lit(FRONTIER_POINTS - 1))
    points = exposure(activity).withColumn("point", F.explode(numbers)).withColumn(
        "threshold", first + F.col("point") * F.lit(step)
    )
    tau = F.col("threshold")
    net = F.col("fraud_dollars") * recall(tau) - (
        F.col("legit_count") * false_positive_rate(tau) * F.lit(friction_cost)
    )
    return points.select("point", "threshold", net.alias("net_savings")).orderBy("point")
