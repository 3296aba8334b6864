"""Training, evaluation, importances and the model bundle."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from math import ceil

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.metrics import (
    confusion, ranking_metrics, score_steps, threshold_metrics,
)
from riskloom.plans.features import feature_names, fit_feature_model, transform_features
from riskloom.session import ensure_checkpoint_dir

THRESHOLD = 0.50
TASK_ROWS = 50_000  # training rows that are worth a task; a hundred rounds run some thousand small jobs
MOST_TASK_ROWS = 1_000_000  # training rows that a task keeps in memory at most
WEIGHT_SHARE = 0.75


@dataclass(frozen=True)
class BoostingParams:
    """Boosted trees; depth 5 allows at most 32 leaves."""

    rounds: int = 120
    learning_rate: float = 0.05
    max_depth: int = 5
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42


@dataclass
class ModelBundle:
    """Fitted feature model and classifier with what serving needs to know."""

    features: PipelineModel
    classifier: GBTClassificationModel
    run_id: str
    metrics: dict[str, float]
    threshold: float = THRESHOLD

    @property
    def version(self) -> str:
        return self.run_id[:8]


def class_weight(train: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: train_samples, fraud_samples, fraud_ratio and the fraud weight."""
    n, fraud = F.count("*"), F.coalesce(F.sum(F.when(F.col(label) == 1, 1)), F.lit(0))
    return train.agg(n.alias("train_samples"), fraud.alias("fraud_samples")).withColumns({
        "fraud_ratio": F.round(F.col("fraud_samples") / F.nullif(F.col("train_samples"), F.lit(0)), 4),
        "pos_weight": F.floor(
            (F.col("train_samples") - F.col("fraud_samples"))
            / F.greatest(F.col("fraud_samples"), F.lit(1)) * WEIGHT_SHARE * 100.0 + 0.5
        ) / F.lit(100.0),
    })


def task_count(rows: int, cores: int) -> int:
    """Tasks for so many training rows: as many as the rows are worth, up to one per core; then whole rounds of the cores.

    Every level of every tree exchanges a block between any two tasks and sends
    each task's result to the driver, so tasks must not grow with the rows.
    """
    worth = max(1, ceil(rows / TASK_ROWS))
    return worth if worth <= cores else cores * ceil(rows / (cores * MOST_TASK_ROWS))


def fit_classifier(
    vectors: DataFrame, pos_weight: float, params: BoostingParams, label: str = "is_fraud", rows: int | None = None
) -> GBTClassificationModel:
    """Boosted trees. With the number of ``rows`` they are dealt to as many tasks as they are worth."""
    ensure_checkpoint_dir(vectors.sparkSession)
    weighted = vectors.select(
        "features",
        F.col(label).cast("double").alias("label"),
        F.when(F.col(label) == 1, F.lit(pos_weight)).otherwise(1.0).alias("weight"),
    )
    if rows is not None:
        weighted = weighted.repartition(task_count(rows, vectors.sparkSession.sparkContext.defaultParallelism))
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=params.rounds,
        stepSize=params.learning_rate,
        maxDepth=params.max_depth,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share),
        seed=params.seed,
        maxMemoryInMB=1024,  # all nodes of a level in one pass
        checkpointInterval=20,
    ).fit(weighted)


def predict(features: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Add ``score`` (fraud probability) and ``predicted_fraud`` at the bundle's threshold."""
    vectors = transform_features(features, bundle.features)
    scored = bundle.classifier.transform(vectors)
    probability = vector_to_array("probability")[1]
    return features_only(scored, features).withColumns({
        "score": probability, "predicted_fraud": (probability >= bundle.threshold).cast("int"),
    }).drop("probability")


def features_only(scored: DataFrame, features: DataFrame) -> DataFrame:
    """The input columns and the probability, without the model's working columns."""
    return scored.select(*features.columns, "probability")


def evaluate(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row with every ranking and threshold metric of (label, score) rows."""
    matrix = confusion(scored, threshold)
    ranking = ranking_metrics(score_steps(scored))
    rates = threshold_metrics(matrix)
    return matrix.withColumns({
        **{c: ranking.select(c).scalar() for c in ranking.columns},
        **{c: rates.select(c).scalar() for c in rates.columns},
    })


def importances(bundle: ModelBundle, spark: SparkSession) -> DataFrame:
    """Rows (feature, importance); one per vector slot."""
    values = bundle.classifier.featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(feature_names(bundle.features), values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_importances(bundle: ModelBundle, spark: SparkSession, n: int = 12) -> DataFrame:
    return importances(bundle, spark).orderBy(F.desc("importance"), "feature").limit(n)


def fit_bundle(train: DataFrame, run_id: str, params: BoostingParams) -> tuple[ModelBundle, dict]:
    """Fit the feature model and the classifier on training rows only."""
    weights = class_weight(train).first().asDict()
    model = fit_feature_model(train)
    vectors = transform_features(train, model)
    classifier = fit_classifier(vectors, weights["pos_weight"], params, rows=weights["train_samples"])
    return ModelBundle(model, classifier, run_id, {}), {**asdict(params), **weights}


def save_bundle(bundle: ModelBundle, path: str, spark: SparkSession) -> None:
    bundle.features.write().overwrite().save(f"{path}/features")
    bundle.classifier.write().overwrite().save(f"{path}/classifier")
    info = spark.createDataFrame(
        [(bundle.run_id, bundle.threshold, bundle.metrics)],
        "run_id string, threshold double, metrics map<string,double>",
    )
    info.coalesce(1).write.mode("overwrite").json(f"{path}/info")


def load_bundle(path: str, spark: SparkSession) -> ModelBundle:
    info = spark.read.schema(
        "run_id string, threshold double, metrics map<string,double>"
    ).json(f"{path}/info").first()
    return ModelBundle(
        PipelineModel.load(f"{path}/features"),
        GBTClassificationModel.load(f"{path}/classifier"),
        info["run_id"], dict(info["metrics"] or {}), info["threshold"],
    )
