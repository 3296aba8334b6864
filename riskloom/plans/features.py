"""Feature engineering and the fitted feature model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rules import risk_score, spend_ratio
from riskloom.operators.dedup import keep_first
from riskloom.plans.silver import temporal

# Model inputs in matrix order, and the substitutes for missing ones.
NUMERICAL_FEATURES = [
    "amount",
    "distance_from_home_km",
    "hour_of_day",
    "is_weekend",
    "is_night",
    "is_cross_border",
    "account_age_days",
    "kyc_verified",
    "baseline_spend",
    "amount_to_baseline_ratio",
    "chargeback_history_rate",
    "merchant_risk_score",
]
CATEGORICAL_FEATURES = ["channel", "card_type", "device_type"]
UNKNOWN_TIER_SCORE = 0.2
DEFAULT_DISTANCE_KM = 10.0
DEFAULT_CHARGEBACK_RATE = 0.01


def compute_features(
    tx: DataFrame, users: DataFrame, merchants: DataFrame, unique_dims: bool = False
) -> DataFrame:
    """Transactions with profile and merchant signals.

    Temporal and cross-border flags are only derived where the input lacks
    them. Set ``unique_dims`` when both dimensions hold one row per key; they
    are deduplicated first otherwise.
    """
    if not unique_dims:
        users, merchants = keep_first(users, "user_id"), keep_first(merchants, "merchant_id")
    profile = users.select(
        "user_id",
        "account_age_days",
        F.col("kyc_verified").cast("int").alias("kyc_verified"),
        "baseline_spend",
        F.col("country").alias("country_user"),
    )
    shop = merchants.select("merchant_id", "risk_tier", "chargeback_history_rate")
    derived = {
        "amount_to_baseline_ratio": spend_ratio(F.col("amount"), F.col("baseline_spend")),
        "merchant_risk_score": risk_score(F.col("risk_tier"), UNKNOWN_TIER_SCORE),
        "distance_from_home_km": F.coalesce("distance_from_home_km", F.lit(DEFAULT_DISTANCE_KM)),
        "chargeback_history_rate": F.coalesce("chargeback_history_rate", F.lit(DEFAULT_CHARGEBACK_RATE)),
    }
    if "is_cross_border" not in tx.columns:
        # an unknown user's home is null, which differs from any country
        derived["is_cross_border"] = (~F.col("country").eqNullSafe(F.col("country_user"))).cast("int")
    if "hour_of_day" not in tx.columns:
        tx = temporal(tx)
    return (
        tx.join(profile, "user_id", "left").join(shop, "merchant_id", "left").withColumns(derived)
    )


def scaling_statistics(features: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per numeric feature, from one aggregate row."""
    row = features.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in NUMERICAL_FEATURES],
        *[F.stddev_pop(c).alias(f"dev_{c}") for c in NUMERICAL_FEATURES],
    ).first()
    return {c: (row[f"mean_{c}"] or 0.0, row[f"dev_{c}"] or 1.0) for c in NUMERICAL_FEATURES}


def scaling_statement(stats: dict[str, tuple[float, float]]) -> str:
    """Scaled columns as SQL; a missing value becomes the mean."""
    scaled = ", ".join(
        f"coalesce((cast({c} as double) - {mean!r}D) / {dev!r}D, 0D) as scaled_{c}"
        for c, (mean, dev) in stats.items()
    )
    return f"select *, {scaled} from __THIS__"


def fit_feature_model(features: DataFrame) -> PipelineModel:
    """Scaling, one-hot encoding (sorted categories, unseen gives zeros) and assembly.

    Fit it on training rows only. The result is saved and loaded like any
    ``PipelineModel``.
    """
    indexed = [f"index_{c}" for c in CATEGORICAL_FEATURES]
    encoded = [f"onehot_{c}" for c in CATEGORICAL_FEATURES]
    stages = [
        SQLTransformer(statement=scaling_statement(scaling_statistics(features))),
        StringIndexer(
            inputCols=CATEGORICAL_FEATURES, outputCols=indexed,
            stringOrderType="alphabetAsc", handleInvalid="keep",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(
            inputCols=[f"scaled_{c}" for c in NUMERICAL_FEATURES] + encoded, outputCol="features"
        ),
    ]
    return Pipeline(stages=stages).fit(features)


def transform_features(features: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Apply a fitted feature model; without one there is nothing to scale by."""
    if model is None:
        raise ValueError("fit the feature model before transforming")
    return model.transform(features)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector's slots, in order."""
    indexer = model.stages[1]
    slots = [
        f"{column}_{value}"
        for column, values in zip(CATEGORICAL_FEATURES, indexer.labelsArray)
        for value in values
    ]
    return NUMERICAL_FEATURES + slots
