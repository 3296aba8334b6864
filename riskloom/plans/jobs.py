"""End-to-end jobs: medallion build, training, drift check and batch scoring."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators.checksum import content_checksum
from riskloom.operators.drift import DriftThresholds, drift_report
from riskloom.operators.quality import ContractViolation, gate_summary, row_flags
from riskloom.operators.sampling import stratified_split
from riskloom.plans import marts, scoring, silver, training
from riskloom.plans.features import compute_features
from riskloom.session import configure
from riskloom.sources import commits, lake


def new_run_id() -> str:
    return f"run_{datetime.now(timezone.utc):%Y%m%d_%H%M%S_%f}"


def side_by_side(spark: SparkSession, tasks: dict[str, Callable]) -> dict:
    """Run independent writes at the same time, so that small ones fill idle executors."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = {n: pool.submit(inheritable_thread_target(spark)(t)) for n, t in tasks.items()}
        return {name: future.result() for name, future in running.items()}


class _Telemetry:
    """Collects stage durations and counts of one run."""

    def __init__(self, run_id: str):
        self.record = {
            "run_id": run_id, "started_at": lake.now_text(), "completed_at": None,
            "total_duration_seconds": None, "status": None, "error": None, "stages": {},
        }
        self._begun = time.monotonic()

    def stage(self, name: str, begun: float, status: str, **counts: int) -> None:
        self.record["stages"][name] = {
            "duration_seconds": round(time.monotonic() - begun, 3), "status": status,
            "counts": {k: int(v) for k, v in counts.items()},
        }

    def finish(self, status: str, error: str | None = None) -> dict:
        self.record.update(
            completed_at=lake.now_text(), status=status, error=error,
            total_duration_seconds=round(time.monotonic() - self._begun, 3),
        )
        return self.record


def land(spark: SparkSession, sources: dict[str, DataFrame], root: str, label: str) -> dict:
    """Bronze stage: one immutable batch, master-data snapshots and a ledger entry."""
    batch_id = lake.new_batch_id(label)
    done = side_by_side(spark, {
        "tx": lambda: lake.land_batch(sources["transactions"], root, batch_id, watched=row_flags(sources["transactions"])),
        "users": lambda: lake.write_snapshot(sources["users"], root, "users"),
        "merchants": lambda: lake.write_snapshot(sources["merchants"], root, "merchants"),
    })
    audit = lake.append_audit(spark, root, done["tx"], done["users"], done["merchants"])
    return {**audit, "observed": done["tx"]["observed"]}


def gate(tx: DataFrame, users: DataFrame, merchants: DataFrame, observed: dict[str, int] | None = None) -> dict:
    """Evaluate the contracts; raise with every failure if any is broken."""
    summary = gate_summary(tx, users, merchants, observed).first().asDict()
    if not summary["passed"]:
        raise ContractViolation(summary["failures"])
    return summary


def build_silver(spark: SparkSession, bronze: dict[str, DataFrame], root: str, version: str) -> dict[str, int]:
    """A new version of the silver tables. Master data first; the transactions then read the deduplicated users back.

    A silver table that another writer commits meanwhile is a ``CommitConflict``.
    """
    base = commits.last_number(spark, root)
    done = side_by_side(spark, {
        "users": lambda: lake.publish(silver.silver_users(bronze["users"]), root, "users", version),
        "merchants": lambda: lake.publish(silver.silver_merchants(bronze["merchants"]), root, "merchants", version),
    })
    tx = silver.silver_transactions(
        bronze["transactions"], spark.read.parquet(done["users"]["path"]), unique_users=True
    ).withColumn("transaction_date", F.to_date("timestamp"))
    done["transactions"] = lake.publish(tx, root, "transactions", version, by_date="transaction_date")
    lake.commit_versions(spark, root, version, list(done.values()), base)
    return {name: built["rows"] for name, built in done.items()}


def build_gold(spark: SparkSession, layer: dict[str, DataFrame], root: str, version: str) -> dict[str, int]:
    """Write the four marts as a new version and make it current, unless another writer was faster."""
    base = commits.last_number(spark, root)
    tx, users, merchants = layer["transactions"], layer["users"], layer["merchants"]
    fact = marts.fct_transactions(tx)
    dated = fact.withColumn("transaction_date", F.to_date("timestamp"))
    plans = {
        "dim_users": (marts.dim_users(users, tx), None, ("user_id",)),
        "dim_merchants": (marts.dim_merchants(merchants, tx), None, ("merchant_id",)),
        "fct_transactions": (dated, "transaction_date", ("user_id", "merchant_id")),
        # names come from silver, whose rows match the dimensions one to one,
        # so this mart need not wait for them
        "fct_fraud_incidents": (marts.fct_fraud_incidents(fact, users, merchants), None, ()),
    }
    built = side_by_side(spark, {
        name: (lambda n=name, p=plan: lake.publish(p[0], root, n, version, *p[1:]))
        for name, plan in plans.items()
    })
    lake.commit_versions(spark, root, version, list(built.values()), base)
    return {name: b["rows"] for name, b in built.items()}


def input_key(sources: dict[str, DataFrame]) -> str:
    """A checksum of the whole input, whatever the order of its rows."""
    parts = [f"{n}={content_checksum(df).first()['content_checksum']}" for n, df in sorted(sources.items())]
    return hashlib.sha256("|".join(parts).encode()).hexdigest()


def run_medallion(
    spark: SparkSession, sources: dict[str, DataFrame], root: str, label: str | None = None, resume: bool = False
) -> dict:
    """Bronze, gate, silver, gold. Returns the telemetry record, which is also kept on failure.

    With ``resume`` the input is checksummed first. Stages that an earlier run
    has committed for the same input are not repeated: their tables are read at
    the paths that the stage ledger names, and the telemetry says RESUMED.
    """
    configure(spark)
    run_id = new_run_id()
    telemetry = _Telemetry(run_id)
    key, done = None, {}

    def stage(name: str, status: str, run: Callable[[], dict], counts: Callable[[dict], dict]) -> dict:
        """Run a stage, or take its result from the ledger."""
        begun = time.monotonic()
        if name in done:
            telemetry.stage(name, begun, "RESUMED", **counts(done[name]))
            return done[name]
        try:
            result = run()
        except ContractViolation as broken:
            telemetry.stage(name, begun, "FAILED", failures=len(broken.failures))
            raise
        if key:
            lake.record_stage(spark, root, key, name, run_id, result)
        telemetry.stage(name, begun, status, **counts(result))
        return result

    def landed() -> dict:
        audit = land(spark, sources, f"{root}/bronze", label or run_id)
        paths = commits.current_paths(spark, f"{root}/bronze")
        return {**audit, "paths": {**{n: paths[n] for n in ("users", "merchants")}, "transactions": audit["tx_path"]}}

    def checked() -> dict:
        return gate(bronze["transactions"], bronze["users"], bronze["merchants"], audit["observed"])

    def cleaned() -> dict:
        counts = build_silver(spark, bronze, f"{root}/silver", run_id)
        return {"counts": counts, "paths": {n: f"{root}/silver/{n}/version={run_id}" for n in counts}}

    def built() -> dict:
        layer = {n: spark.read.parquet(p) for n, p in silver_tables["paths"].items()}
        return {"counts": build_gold(spark, layer, f"{root}/gold", run_id)}

    try:
        if resume:
            key = input_key(sources)
            done = lake.finished_stages(spark, root, key)
        audit = stage("bronze_ingestion", "COMPLETED", landed, lambda r: {
            "records_ingested": r["transaction_count"], "fraud_records": r["fraud_count"]})
        bronze = {n: spark.read.schema(sources[n].schema).parquet(p) for n, p in audit["paths"].items()}
        stage("quality_gates", "PASSED", checked, lambda r: {"checks_run": r["checks_run"]})
        silver_tables = stage("silver_transformation", "COMPLETED", cleaned, lambda r: r["counts"])
        stage("gold_warehouse", "COMPLETED", built, lambda r: r["counts"])
        return telemetry.finish("SUCCESS")
    except Exception as problem:
        telemetry.finish("FAILED", str(problem))
        raise
    finally:
        lake.append_report(spark, telemetry.record, f"{root}/reports/runs")


def run_training(
    spark: SparkSession,
    gold: dict[str, DataFrame],
    root: str,
    params: training.BoostingParams = training.BoostingParams(),
    test_share: float = 0.2,
) -> dict:
    """Features, split, fit, evaluation, bundle and ledger entry. Returns the ledger entry.

    The feature frame and the test scores are written as tables: what follows
    reads them instead of repeating the joins or the model.
    """
    configure(spark)
    run_id = uuid.uuid4().hex
    home = f"{root}/{run_id}"
    features = compute_features(
        gold["fct_transactions"], gold["dim_users"], gold["dim_merchants"], unique_dims=True
    )
    stratified_split(features, "transaction_id", "is_fraud", test_share, params.seed).write.parquet(
        f"{home}/feature_frame")
    frame = spark.read.parquet(f"{home}/feature_frame")
    bundle, used = training.fit_bundle(frame.where("not is_test"), run_id, params)

    scored = training.predict(frame.where("is_test"), bundle).select(
        "transaction_id", F.col("is_fraud").alias("label"), "score")
    scored.write.parquet(f"{home}/test_scores")
    tested = spark.read.parquet(f"{home}/test_scores")
    found = training.evaluate(tested).first().asDict()
    bundle.metrics = {k: round(float(v), 4) for k, v in found.items()}
    training.save_bundle(bundle, f"{home}/bundle", spark)

    entry = {
        "run_id": run_id,
        "finished_at": lake.now_text(),
        "params": {k: str(v) for k, v in used.items()},
        "train_samples": used["train_samples"],
        "test_samples": tested.count(),
        "fraud_ratio_train": used["fraud_ratio"],
        "metrics": bundle.metrics,
        "top_features": [r["feature"] for r in training.top_importances(bundle, spark, 5).collect()],
        "model_path": f"{home}/bundle",
    }
    lake.append_report(spark, entry, f"{root}/runs")
    return entry


def run_drift(
    spark: SparkSession,
    reference: DataFrame,
    current: DataFrame,
    path: str,
    features: list[str] | None = None,
    thresholds: DriftThresholds = DriftThresholds(),
) -> DataFrame:
    """Write the drift report and return it as stored."""
    configure(spark)
    lake.write_report(drift_report(reference, current, features, thresholds), path)
    return lake.read_report(spark, schemas.DRIFT_REPORT, path)


def run_batch_scoring(
    spark: SparkSession,
    requests: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    bundle: training.ModelBundle,
    path: str,
) -> dict:
    """Score requests with the model, write the responses, return the summary."""
    configure(spark)
    enriched = scoring.enrich(requests, users, merchants)
    answers = scoring.responses(scoring.score_by_model(enriched, bundle), bundle.version)
    answers.write.mode("overwrite").parquet(path)
    return scoring.batch_summary(spark.read.parquet(path)).first().asDict()
