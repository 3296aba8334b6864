"""Data-quality contracts: the transaction gate and the generic declarative rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRITICAL_COLUMNS = ["transaction_id", "user_id", "merchant_id", "amount", "timestamp"]

# Message formats of failed checks; %s is the number of violations.
MESSAGES = {
    "unique_transaction_id": "Primary key violation: %s duplicate transaction_ids found.",
    "not_null_critical": "Null constraint violation in critical columns: {%s}",
    "positive_amount": "Amount domain violation: %s transactions with amount <= 0.",
    "non_negative_distance": "Distance invariant violation: %s rows with negative distance.",
    "known_user": "Referential integrity failure: %s transactions reference non-existent user_ids.",
    "known_merchant": "Referential integrity failure: %s transactions reference non-existent merchant_ids.",
    "binary_label": "Fraud label invalid: %s rows with non-binary values.",
}


def _count_if(condition: Column) -> Column:
    """Rows for which the condition is true; unknown does not count."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def missing(df: DataFrame, column: str) -> Column:
    """Whether a value is null or NaN."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


def null_counts(df: DataFrame, columns: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    """One row with the number of missing values per column."""
    return df.agg(*[_count_if(missing(df, c)).alias(c) for c in columns])


def orphans(tx: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: transactions whose key is not in ``parent``; a missing key is an orphan.

    Counting per key first means the anti join sees each key once, so a key
    holding much of the table costs no more than any other.
    """
    per_key = tx.groupBy(key).agg(F.count("*").alias("n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans"))


def row_flags(tx: DataFrame) -> dict[str, Column]:
    """0 or 1 per row and row-level check; their sums can be observed while a batch lands."""
    broken = {f"null_{c}": missing(tx, c) for c in CRITICAL_COLUMNS}
    broken |= {
        "positive_amount": ~F.isnan("amount") & (F.col("amount") <= 0),
        "non_negative_distance": ~F.isnan("distance_from_home_km") & (F.col("distance_from_home_km") < 0),
        "binary_label": ~F.coalesce(F.col("is_fraud").isin(0, 1), F.lit(False)),
    }
    return {name: F.when(condition, 1).otherwise(0) for name, condition in broken.items()}


def keyed_measurements(tx: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """One row: unique_transaction_id, known_user, known_merchant, from one scan and one exchange.

    The three keys of a row go into one grouping, together with the keys of the
    parents, so orphans need no join. Counts combine before the exchange, so a
    key that holds much of the table costs no more than any other.
    """
    def entry(kind: int, key: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"))

    used = tx.select(F.inline(F.array(entry(0, "transaction_id"), entry(1, "user_id"), entry(2, "merchant_id"))))
    used = used.select("kind", "key", F.lit(1).alias("n"), F.lit(0).alias("parent"))
    for kind, table, key in ((1, users, "user_id"), (2, merchants, "merchant_id")):
        parents = table.where(F.col(key).isNotNull()).select(entry(kind, key).alias("e")).select("e.*", F.lit(0).alias("n"), F.lit(1).alias("parent"))
        used = used.unionByName(parents)
    per_key = used.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))

    def rows(condition: Column, n: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("bigint")

    lost = F.col("parent") == 0
    return per_key.agg(
        rows(F.col("kind") == 0, F.col("n") - 1).alias("unique_transaction_id"),
        rows((F.col("kind") == 1) & lost, F.col("n")).alias("known_user"),
        rows((F.col("kind") == 2) & lost, F.col("n")).alias("known_merchant"),
    )


def gate_measurements(tx: DataFrame, users: DataFrame, merchants: DataFrame, observed: dict[str, int] | None = None) -> DataFrame:
    """One row with every count the gate needs.

    ``observed`` are the sums of ``row_flags`` and the ``total`` of rows as
    they were seen while the batch landed; without them one more pass counts.
    """
    keyed = keyed_measurements(tx, users, merchants)
    names = [*row_flags(tx), "total"]
    if observed is None:
        scanned = tx.agg(
            *[F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias(n) for n, flag in row_flags(tx).items()], F.count("*").alias("total")
        )
        both = keyed.withColumns({n: scanned.select(n).scalar() for n in names})
    else:
        both = keyed.withColumns({n: F.lit(int(observed[n])).cast("bigint") for n in names})
    return both.withColumn("not_null_critical", reduce(lambda a, b: a + b, [F.col(f"null_{c}") for c in CRITICAL_COLUMNS]))


def _null_detail() -> Column:
    named = F.array(*[
        F.when(F.col(f"null_{c}") > 0, F.concat(F.lit(f"{c}: "), F.col(f"null_{c}").cast("string")))
        for c in CRITICAL_COLUMNS
    ])
    return F.array_join(F.filter(named, lambda x: x.isNotNull()), ", ")


def _message(name: str) -> Column:
    """Failure text of a check over the measurements; null when it passes."""
    detail = _null_detail() if name == "not_null_critical" else F.col(name).cast("string")
    before, after = MESSAGES[name].split("%s")
    return F.when(F.col(name) > 0, F.concat(F.lit(before), detail, F.lit(after)))


def gate_checks(tx: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """One row per check: check_no, check_name, violations, passed, total_records, message."""
    checks = F.array(*[
        F.struct(
            F.lit(no).alias("check_no"),
            F.lit(name).alias("check_name"),
            F.col(name).alias("violations"),
            (F.col(name) == 0).alias("passed"),
            F.col("total").alias("total_records"),
            _message(name).alias("message"),
        )
        for no, name in enumerate(MESSAGES, 1)
    ])
    return gate_measurements(tx, users, merchants).select(F.inline(checks))


def gate_summary(
    tx: DataFrame, users: DataFrame, merchants: DataFrame, observed: dict[str, int] | None = None
) -> DataFrame:
    """One row: checks_run, passed, total_records_tested, failures, status; see ``gate_measurements``."""
    failures = F.filter(F.array(*map(_message, MESSAGES)), lambda m: m.isNotNull())
    passed = F.size(failures) == 0
    return gate_measurements(tx, users, merchants, observed).select(
        F.lit(len(MESSAGES)).alias("checks_run"),
        passed.alias("passed"),
        F.col("total").alias("total_records_tested"),
        failures.alias("failures"),
        F.when(passed, "PASSED").otherwise("FAILED").alias("status"),
    )


class ContractViolation(ValueError):
    """Raised by the gate; carries every failure message."""

    def __init__(self, failures: list[str]):
        super().__init__(f"halted by data contract violations: {failures}")
        self.failures = failures


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """One row: number of non-null values that occur more than once."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    return repeated.agg(F.count("*").alias("violations"))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.agg(_count_if(F.col(column).isNull()).alias("violations"))


def accepted_values_violations(df: DataFrame, column: str, values: list) -> DataFrame:
    """One row: number of distinct non-null values outside the list."""
    stray = df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).select(column).distinct()
    return stray.agg(F.count("*").alias("violations"))


def declared_rules(rules: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Rows (rule, subject, violations, passed) of (rule, subject, one-row result) entries."""
    rows = [
        result.select(
            F.lit(rule).alias("rule"), F.lit(subject).alias("subject"), "violations",
            (F.col("violations") == 0).alias("passed"),
        )
        for rule, subject, result in rules
    ]
    return reduce(DataFrame.unionByName, rows)


def fact_contract(fact: DataFrame) -> DataFrame:
    """The declared tests of the transaction fact."""
    return declared_rules([
        ("unique", "transaction_id", unique_violations(fact, "transaction_id")),
        *[("not_null", c, not_null_violations(fact, c)) for c in ("transaction_id", "user_id", "amount")],
        ("accepted_values", "channel", accepted_values_violations(
            fact, "channel", ["mobile_app", "web", "in_store", "api"])),
        ("accepted_values", "is_fraud", accepted_values_violations(fact, "is_fraud", [0, 1])),
    ])


def user_contract(users: DataFrame) -> DataFrame:
    """The declared tests of the user dimension."""
    return declared_rules([
        ("unique", "user_id", unique_violations(users, "user_id")),
        ("not_null", "user_id", not_null_violations(users, "user_id")),
        ("not_null", "email", not_null_violations(users, "email")),
    ])
