"""Live reports, scoring and velocity."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.money import mean, round_half_up, share, total, total_where
from riskloom.plans import scoring
from riskloom.plans.training import ModelBundle
from riskloom.sources import commits
from riskloom.sources.requests import accepted, parse_requests
from riskloom.streaming import velocity_state


def daily_kpis(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Daily KPIs as tumbling windows; rows later than the watermark are dropped.

    Distinct counts are approximate: an exact one would keep every id in state.
    """
    fraud = F.col("is_fraud") == 1
    days = stream.withWatermark("timestamp", delay).groupBy(F.window("timestamp", "1 day")).agg(
        F.count("transaction_id").alias("total_transactions"),
        total(F.col("amount")).alias("total_gmv"),
        round_half_up(mean(F.col("amount")), 2).alias("avg_ticket_size"),
        F.sum("is_fraud").alias("fraud_incident_count"),
        total_where(fraud, F.col("amount")).alias("total_fraud_amount"),
        round_half_up(share(F.sum("is_fraud"), F.count("transaction_id")) * 100, 2).alias("fraud_rate_pct"),
        F.approx_count_distinct("user_id").alias("active_transacting_users"),
        F.approx_count_distinct("merchant_id").alias("active_merchants"),
    )
    return days.withColumn("transaction_date", F.to_date("window.start")).drop("window")


def scored_requests(
    payloads: DataFrame, users: DataFrame, merchants: DataFrame, bundle: ModelBundle | None = None
) -> DataFrame:
    """Responses to a stream of JSON requests; the dimensions are static tables.

    Without a bundle the rule score is used.
    """
    enriched = scoring.enrich(accepted(parse_requests(payloads)), users, merchants)
    if bundle is None:
        return scoring.responses(scoring.score_by_rules(enriched), "rules")
    return scoring.responses(scoring.score_by_model(enriched, bundle), bundle.version)


def with_current_tables(
    stream: DataFrame, published: str, build: Callable[[DataFrame, dict[str, DataFrame]], DataFrame], root: str, checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Write ``build(batch, tables)`` of every micro-batch to ``<root>/rows``, with the tables published at that time.

    The commit log below ``published`` is looked up anew for each batch, so a
    version published while the stream runs is used from the next batch on. The
    commit number that a batch uses is claimed once before it is worked on: a
    batch repeated after a failure finds its own number and gives the same rows.
    """

    def process(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        used = {"name": "published", "path": published, "version": str(commits.last_number(spark, published)), "entries": 1}
        commits.claim(spark, f"{root}/lookups", epoch, json.dumps({**used, "number": epoch}) + "\n")
        at = commits.entries(spark, f"{root}/lookups").where(F.col("number") == epoch).first()["version"]
        tables = {n: spark.read.parquet(p) for n, p in commits.current_paths(spark, published, int(at)).items()}
        build(batch, tables).write.mode("overwrite").parquet(f"{root}/rows/epoch={epoch}")

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def scoring_stream(payloads: DataFrame, published: str, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Scored requests with the users and merchants current in each micro-batch; see ``with_current_tables``."""
    def build(batch: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        return scored_requests(batch, tables["users"], tables["merchants"])

    return with_current_tables(payloads, published, build, root, checkpoint, **trigger)


def velocity_stream(
    stream: DataFrame, root: str, checkpoint: str, delay: str = "1 day", groups: int = velocity_state.USER_GROUPS, **trigger
) -> StreamingQuery:
    """Rolling velocity of arriving transactions, written to ``<root>/velocity``.

    State is kept in RocksDB by ``velocity_state``: the instants of a slice of
    time and of the 24 hours before it, until the watermark has passed, and the
    last time of every user. So disk and state are bounded by a day of rows and
    the number of users, however long the stream runs; a restart goes on from
    the checkpoint, with the same number of ``groups`` of users, and a repeated
    batch replaces itself.

    Results equal the batch operator's as long as batches arrive in time order;
    a late row does not change results already written, and rows later than
    ``delay`` are dropped. Rows without a time see those of their own batch only.
    """

    def process(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/velocity/epoch={epoch}")

    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, velocity_state.STORE)  # the query keeps the setting it starts with
    try:
        return (
            velocity_state.moving(stream, delay, groups=groups).writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        conf.set(key, before)


def write_updates(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write an aggregate's changed rows of every micro-batch; a repeated batch replaces itself."""

    def process(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_rows(written: DataFrame, key: str) -> DataFrame:
    """The last written row of every key, days still open included."""
    columns = [c for c in written.columns if c not in (key, "epoch")]
    newest = written.groupBy(key).agg(F.max_by(F.struct(*columns), "epoch").alias("_row"))
    return newest.select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])
