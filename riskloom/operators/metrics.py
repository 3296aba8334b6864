"""Exact ranking and threshold metrics of a scored table (columns label, score).

Rows are first reduced to counts per distinct score; every curve is a running
total over those counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.money import share
from riskloom.operators.ordered import running_totals, stored_slices


def _ratio(part: Column, whole: Column) -> Column:
    """0 when undefined."""
    return F.coalesce(share(part, whole), F.lit(0.0))


def score_steps(
    scored: DataFrame, label: str = "label", score: str = "score", slices: int | None = None
) -> DataFrame:
    """Rows (score, pos, neg, pos_at_or_above, neg_at_or_above, all_pos, all_neg).

    The counts per distinct score are made here, in one pass over the rows, and stored.
    """
    rows = scored.select(
        F.lit("all").alias("curve"),
        F.col(score).cast("double").alias("score"),
        F.when(F.col(label) == 1, 1).otherwise(0).cast("bigint").alias("pos"),
        F.when(F.col(label) == 1, 0).otherwise(1).cast("bigint").alias("neg"),
    )
    counts = rows.groupBy("curve", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    stored = stored_slices(counts, "curve", "score", slices)
    run = running_totals(stored, "curve", "score", ["pos", "neg"]).withColumns({
        f"all_{m}": stored.agg(F.coalesce(F.sum(m), F.lit(0))).scalar() for m in ("pos", "neg")
    })
    all_pos, all_neg = F.col("all_pos"), F.col("all_neg")
    return run.select(
        "score", "pos", "neg",
        (all_pos - F.col("cum_pos") + F.col("pos")).alias("pos_at_or_above"),
        (all_neg - F.col("cum_neg") + F.col("neg")).alias("neg_at_or_above"),
        "all_pos", "all_neg",
    )


def ranking_metrics(steps: DataFrame) -> DataFrame:
    """One row: roc_auc (ties count half) and average_precision (no interpolation)."""
    above = F.col("pos_at_or_above") - F.col("pos")
    half_pairs = (F.col("neg") * (2 * above + F.col("pos"))).cast("decimal(38,0)")
    precision = _ratio(F.col("pos_at_or_above"), F.col("pos_at_or_above") + F.col("neg_at_or_above"))
    return steps.agg(
        share(
            F.sum(half_pairs),
            F.max("all_pos").cast("double") * F.max("all_neg") * 2,
        ).alias("roc_auc"),
        F.sum(_ratio(F.col("pos"), F.col("all_pos")) * precision).alias("average_precision"),
    )


def pr_curve(steps: DataFrame) -> DataFrame:
    """Rows (threshold, precision, recall), one per distinct score, and the end point (null, 1, 0)."""
    points = steps.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("pos_at_or_above"), F.col("pos_at_or_above") + F.col("neg_at_or_above")).alias("precision"),
        _ratio(F.col("pos_at_or_above"), F.col("all_pos")).alias("recall"),
    )
    end = steps.agg(F.max("score")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def confusion(scored: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """One row: true/false positives and negatives at ``score >= threshold``."""
    predicted, actual = F.col(score) >= threshold, F.col(label) == 1

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return scored.agg(
        rows_where(predicted & actual).alias("true_positives"),
        rows_where(predicted & ~actual).alias("false_positives"),
        rows_where(~predicted & ~actual).alias("true_negatives"),
        rows_where(~predicted & actual).alias("false_negatives"),
    )


def threshold_metrics(matrix: DataFrame) -> DataFrame:
    """One row: precision, recall, f1_score; 0 where undefined."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return matrix.select(
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )
