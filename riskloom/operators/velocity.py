"""Per-user rolling velocity: 1-hour count, 24-hour spend, gap to the previous transaction.

Frames are RANGE frames over event time: peers at the same instant count, and
so does a transaction exactly one hour (24 hours) earlier.

One way for every user, by sums on two levels. Rows are first reduced to one per
user and instant, and those to totals per user and unit of ten minutes. A unit
opens with the totals of the units that its windows cover, taken from a running
window over the small table of units. Inside a unit only its edge moves: its own
instants enter, and those that lie a whole window earlier leave, at their time
plus the window. Both running sums only grow, so the cost is linear, and however
many rows or distinct instants a user has, a task sees those of ten minutes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.money import MILLION, micros

HOUR = 3_600_000_000  # microseconds
DAY = 24 * HOUR
UNIT = HOUR // 6  # divides the windows
UNTIMED = -(1 << 62)  # stands for a missing time, far from every window

VELOCITY_COLUMNS = [
    "tx_count_last_1h", "total_spend_last_24h", "prev_tx_timestamp", "seconds_since_prev_tx",
]


def _user_key() -> Column:
    """The user as a non-null key; a missing user is a group of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("user_id")), F.lit(""))


def instants_of(tx: DataFrame) -> DataFrame:
    """One row per user and instant: rows, known amounts, millionths spent, smallest id."""
    return tx.groupBy("_user", "_t").agg(
        F.count("transaction_id").alias("n"),
        F.count(micros(F.col("amount"))).alias("known"),
        F.coalesce(F.sum(micros(F.col("amount"))), F.lit(0)).alias("spent"),
        F.min("transaction_id").alias("first_id"),
    )


def _openings(instants: DataFrame, unit: int) -> DataFrame:
    """Per user and unit what its windows hold when it begins: whole units before it, and the last time of all."""
    totals = instants.where(F.col("_t") > UNTIMED).groupBy("_user", F.floor(F.col("_t") / unit).alias("_unit")).agg(
        *[F.sum(c).alias(c) for c in ("n", "known", "spent")], F.max("_t").alias("last_t")
    )
    earlier = Window.partitionBy("_user").orderBy("_unit")

    def covered(measure: str, window: int) -> Column:
        """The difference of two running totals, so that a frame is never added up anew."""
        before = F.sum(measure).over(earlier.rangeBetween(Window.unboundedPreceding, -1))
        gone = F.sum(measure).over(earlier.rangeBetween(Window.unboundedPreceding, -(window // unit) - 1))
        return F.coalesce(before, F.lit(0)) - F.coalesce(gone, F.lit(0))

    return totals.select(
        "_user", "_unit", covered("n", HOUR).alias("n"), covered("known", DAY).alias("known"),
        covered("spent", DAY).alias("spent"),
        F.max("last_t").over(earlier.rangeBetween(Window.unboundedPreceding, -1)).alias("last_t"),
    )


def rolling_instants(instants: DataFrame, unit: int = UNIT) -> DataFrame:
    """Rows (_user, _t, first_id, tx_count_last_1h, known_24h, spent_24h, prev_t) of ``instants``."""
    if HOUR % unit:
        raise ValueError("the unit must divide an hour")
    timed = F.col("_t") > UNTIMED
    measures = ["n", "n_left", "known", "known_left", "spent", "spent_left"]

    def entry(at: Column, **values: Column) -> Column:
        """What enters at a time, or leaves right after it."""
        zero = F.lit(0).cast("bigint")
        return F.struct(
            at.alias("_s"), F.floor(at / unit).alias("_unit"), values.get("own", F.lit(None).cast("bigint")).alias("own"),
            *[values.get(m, zero).alias(m) for m in measures],
        )

    own = entry(F.col("_t"), own=F.col("_t"), **{m: F.col(m) for m in ("n", "known", "spent")})
    edges = [
        entry(F.col("_t") + HOUR, n_left=F.col("n")),
        entry(F.col("_t") + DAY, known_left=F.col("known"), spent_left=F.col("spent")),
    ]
    moving = instants.select("_user", "first_id", F.inline(F.when(timed, F.array(own, *edges)).otherwise(F.array(own))))
    # an opening stands right before its unit
    opening = _openings(instants, unit).select("_user", "_unit", (F.col("_unit") * unit - 1).alias("_s"), F.struct(
        F.lit(None).cast("string").alias("first_id"), F.col("last_t"), *[F.col(m) for m in ("n", "known", "spent")]).alias("o"))
    entries = moving.withColumn("last_t", F.col("own")).unionByName(
        opening.select("_user", "_unit", "_s", "o.*"), allowMissingColumns=True)
    by_time = Window.partitionBy("_user", "_unit").orderBy("_s")
    until_now = by_time.rangeBetween(Window.unboundedPreceding, 0)
    before = by_time.rangeBetween(Window.unboundedPreceding, -1)

    def inside(measure: str) -> Column:
        return F.sum(measure).over(until_now) - F.coalesce(F.sum(f"{measure}_left").over(before), F.lit(0))

    return entries.select(
        "_user", F.col("own").alias("_t"), "first_id", inside("n").alias("tx_count_last_1h"),
        inside("known").alias("known_24h"), inside("spent").alias("spent_24h"), F.max("last_t").over(before).alias("prev_t"),
    ).where(F.col("_t").isNotNull())


def with_velocity(tx: DataFrame) -> DataFrame:
    """Add the velocity columns to transactions with unique ``transaction_id``.

    Rows without a time see each other only and have no previous transaction.
    The spend is null where no amount of the window is known.
    """
    keyed = tx.withColumns({
        "_user": _user_key(), "_t": F.coalesce(F.unix_micros("timestamp"), F.lit(UNTIMED)),
    })
    rolled = rolling_instants(instants_of(keyed))
    # rows of one instant may be many: the small side is unique per key, so the
    # adaptive skew join can split the row side
    back = keyed.join(rolled, ["_user", "_t"])
    own_time = F.when(F.col("_t") > UNTIMED, F.col("_t"))
    previous = F.when(F.col("transaction_id").eqNullSafe(F.col("first_id")), F.col("prev_t")).otherwise(own_time)
    return back.select(
        *tx.columns,
        "tx_count_last_1h",
        F.when(F.col("known_24h") > 0, F.col("spent_24h") / F.lit(float(MILLION))).alias("total_spend_last_24h"),
        F.timestamp_micros(previous).alias("prev_tx_timestamp"),
        ((own_time - previous) / F.lit(1e6)).alias("seconds_since_prev_tx"),
    )
