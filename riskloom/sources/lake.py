"""Lake tables, the ingestion ledger and JSON reports."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions.times import batch_name
from riskloom.operators.checksum import checksum_of, digest_number
from riskloom.session import local_rows
from riskloom.sources import commits

INGESTED = "INGESTION_SUCCESS"


def now_text() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


def new_batch_id(label: str) -> str:
    return batch_name(datetime.now(timezone.utc), label)


def write_counted(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    by_date: str | None = None,
    sums: dict[str, Column] | None = None,
    find_by: tuple[str, ...] = (),
) -> dict:
    """Write a Parquet table and return counts taken while writing it, without a second pass.

    ``by_date`` partitions the files by that column. Rows are rebalanced on it
    first, so a task writes few dates, and a date too big for one task is split.
    ``sums`` adds totals of expressions to the observed ``rows``. ``find_by``
    names the columns of point reads: files are sorted by them, so a row group
    holds a narrow range of the first, and have Bloom filters for all of them.
    """
    sums = sums or {}
    watched = Observation()
    if by_date is not None:
        df = df.hint("rebalance", by_date)
    # observed directly below the write: each row counts once, in the task that commits it;
    # the expressions are projected first, so that they run in generated code
    df = (
        df.withColumns({f"_sum_{n}": c for n, c in sums.items()})
        .observe(
            watched,
            F.count(F.lit(1)).alias("rows"),
            *[F.coalesce(F.sum(f"_sum_{n}"), F.lit(0)).alias(n) for n in sums],
        )
        .drop(*[f"_sum_{n}" for n in sums])
    )
    if find_by:
        df = df.sortWithinPartitions(*([by_date] if by_date else []), *find_by)
    writer = df.write.mode(mode)
    for column in find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")  # sized by the values of a row group
    if by_date is not None:
        writer = writer.partitionBy(by_date)
    writer.parquet(path)
    return watched.get


def land_batch(
    transactions: DataFrame, root: str, batch_id: str, replay: bool = False, watched: dict[str, Column] | None = None
) -> dict:
    """Write one immutable bronze batch; fails when the batch already exists.

    Sums of the ``watched`` expressions are taken while the rows are written.

    ``replay`` is for streams, whose engine repeats an unfinished batch with the
    same id and the same rows.
    """
    path = f"{root}/transactions/batch_id={batch_id}"
    counts = write_counted(
        transactions, path, "overwrite" if replay else "errorifexists",
        sums={"fraud_count": F.col("is_fraud"), "digest_sum": digest_number(transactions), **(watched or {})},
    )
    observed = {n: counts.pop(n) for n in (watched or {})} | {"total": counts["rows"]}
    return {"batch_id": batch_id, "tx_path": path, "observed": observed, **counts}


def write_snapshot(df: DataFrame, root: str, name: str) -> int:
    """Publish a new version of a master-data table; returns its rows."""
    version = uuid.uuid4().hex[:12]
    built = publish(df, root, name, version)
    commit_versions(df.sparkSession, root, version, [built])
    return built["rows"]


def read_batches(spark: SparkSession, root: str, batch_id: str | None = None) -> DataFrame:
    """All landed batches as one table, or a single batch (by partition pruning)."""
    landed = spark.read.schema(f"{schemas.BRONZE_TRANSACTIONS}, batch_id string").parquet(f"{root}/transactions")
    return landed if batch_id is None else landed.where(F.col("batch_id") == batch_id)


def append_audit(spark: SparkSession, root: str, landed: dict, users: int, merchants: int) -> dict:
    """Add one entry to the ingestion ledger; a repeated batch replaces its own entry."""
    record = {
        "batch_id": landed["batch_id"],
        "timestamp": now_text(),
        "transaction_count": landed["rows"],
        "users_count": users,
        "merchants_count": merchants,
        "fraud_count": landed["fraud_count"],
        "content_checksum": checksum_of(landed["rows"], landed["digest_sum"]),
        "tx_path": landed["tx_path"],
        "status": INGESTED,
    }
    _write_lines(spark, [record], f"{root}/ingestion_audit_log/entry={landed['batch_id']}", "overwrite")
    return record


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.AUDIT_RECORD).json(f"{root}/ingestion_audit_log").drop("entry")


def _write_lines(spark: SparkSession, records: list[dict], path: str, mode: str) -> None:
    """Write a few records as JSON lines, one file."""
    lines = local_rows(spark, {"value": [json.dumps(r) for r in records]})
    lines.coalesce(1).write.mode(mode).text(path)


def append_report(spark: SparkSession, record: dict, path: str) -> None:
    """Append one record to a JSON ledger."""
    _write_lines(spark, [record], path, "append")


def write_report(report: DataFrame, path: str) -> None:
    """Write a one-row report frame as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def publish(
    df: DataFrame, root: str, name: str, version: str, by_date: str | None = None, find_by: tuple[str, ...] = ()
) -> dict:
    """Build a new version of a mart next to the old one; readers switch with the commit.

    Nothing a reader uses is overwritten, so a failed or repeated build leaves
    the current version as it was.
    """
    path = f"{root}/{name}/version={version}"
    return {"name": name, "path": path, **write_counted(df, path, by_date=by_date, find_by=find_by)}


def commit_versions(spark: SparkSession, root: str, version: str, built: list[dict], base: int | None = None) -> int:
    """Make built marts current, all in one commit; see ``commits.commit`` for ``base``."""
    at = now_text()
    records = [
        {"version": version, "published_at": at, "name": b["name"], "path": b["path"], "row_count": b["rows"]}
        for b in built
    ]
    return commits.commit(spark, root, records, base)


def current_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The current version of every mart."""
    return {name: spark.read.parquet(path) for name, path in commits.current_paths(spark, root).items()}


def record_stage(spark: SparkSession, root: str, input_key: str, stage: str, run_id: str, result: dict) -> None:
    """Note that a stage is done for an input; a repeated stage replaces its own entry."""
    record = {"input_key": input_key, "stage": stage, "run_id": run_id, "done_at": now_text(), "result": json.dumps(result)}
    _write_lines(spark, [record], f"{root}/_stages/input={input_key}/entry={stage}", "overwrite")


def finished_stages(spark: SparkSession, root: str, input_key: str) -> dict[str, dict]:
    """Results of the stages that are done for an input, by stage."""
    ledger = spark.read.schema(schemas.STAGE).option("ignoreMissingFiles", "true")
    try:
        rows = ledger.json(f"{root}/_stages/input={input_key}").select("stage", "result").collect()  # a row per stage
    except AnalysisException:  # nothing is done yet
        return {}
    return {r["stage"]: json.loads(r["result"]) for r in rows}
