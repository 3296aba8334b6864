"""Keyed state of the streaming velocity.

Two stateful steps in one query. The first is keyed by a group of users and a
slice of time. It keeps the instants of its own slice and of the 24 hours before,
which are sent to it as background, so a heavy user's rows spread over slices
and the state of a slice is bounded; an event-time timer removes it once the
watermark has passed. The second knows the last time of every user and fills in
a previous time that lies before the slice; only first rows of a slice and one
mark per user and batch need it, all other rows pass through it spread evenly.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from riskloom.functions.money import MILLION, micros
from riskloom.operators.velocity import DAY, HOUR, UNTIMED

# executors need not have the package: the processors travel with the query
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = DAY
USER_GROUPS = 16  # of users; more spread a stream over more tasks; fixed for a checkpoint
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INSTANTS = pa.schema([
    ("user", pa.string()), ("t", pa.int64()), ("n", pa.int64()), ("known", pa.int64()), ("spent", pa.int64()), ("first_id", pa.string()),
])
LAST = pa.schema([("person", pa.string()), ("instant", pa.int64())])
ROW = "transaction_id string, user_id string, timestamp timestamp, amount double"
MOVED = f"{ROW}, person string, mark boolean, instant bigint, tx_count_last_1h bigint, known bigint, spent bigint, prev bigint, open boolean"
RESULT = f"{ROW}, tx_count_last_1h bigint, total_spend_last_24h double, prev_tx_timestamp timestamp, seconds_since_prev_tx double"


def packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    """Rows as one value of state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_table(pa.Table.from_pandas(rows, schema=schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def merged(instants: pd.DataFrame) -> pd.DataFrame:
    """One row per user and instant, sorted by both."""
    return instants.groupby(["user", "t"], sort=True, as_index=False).agg(
        n=("n", "sum"), known=("known", "sum"), spent=("spent", "sum"), first_id=("first_id", "min")
    )


def rolled(instants: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Counts, spend and previous time of ``rows`` among sorted ``instants`` that hold them."""
    codes, users = pd.factorize(instants.user)  # sorted, so codes rise
    low, span = int(instants.t.min()), int(instants.t.max() - instants.t.min()) + DAY + 1
    place = codes.astype(np.int64) * span + (instants.t.to_numpy() - low)
    code = pd.Series(np.arange(len(users)), index=users).loc[rows.person].to_numpy()
    when = code * span + (rows.instant.to_numpy() - low)
    here = np.searchsorted(place, when)
    start = np.searchsorted(codes, code)  # the user's first instant

    def between(measure: str, window: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(instants[measure].to_numpy())])
        return sums[here + 1] - sums[np.maximum(np.searchsorted(place, when - window), start)]

    times, firsts = instants.t.to_numpy(), instants.first_id.to_numpy()
    first = rows.transaction_id.to_numpy() == firsts[here]
    known_before = here > start
    prev = np.where(first, np.where(known_before, times[np.maximum(here - 1, 0)], 0), times[here])
    out = rows.copy()
    out["tx_count_last_1h"], out["known"], out["spent"] = between("n", HOUR), between("known", DAY), between("spent", DAY)
    out["prev"] = pd.array(np.where(first & ~known_before, 0, prev), "Int64")
    out["open"] = first & ~known_before
    out.loc[out.open, "prev"] = pd.NA
    return out


class SliceState(StatefulProcessor):
    """Velocity inside a slice of a group of users."""

    def __init__(self, length: int):
        self.length = length

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("instants", "data binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)
        timed = int(key[1]) != UNTIMED
        arrived["instant"] = arrived.instant.fillna(0).astype("int64")
        fresh = pd.DataFrame({
            "user": arrived.person, "t": arrived.instant, "n": arrived.transaction_id.notna().astype("int64"),
            "known": arrived.paid.notna().astype("int64"), "spent": arrived.paid.fillna(0).astype("int64"),
            "first_id": arrived.transaction_id,
        })
        before = self.kept.get() if timed else None
        if before is not None:
            fresh = pd.concat([unpacked(before[0]), fresh], ignore_index=True)
        instants = merged(fresh)
        if timed:
            self.kept.update((packed(instants, INSTANTS),))
            if before is None:
                self.handle.registerTimer((int(key[1]) + 1) * self.length // 1000)  # in milliseconds
        own = arrived[arrived.own]
        if own.empty:
            return
        out = rolled(instants, own)
        out["mark"] = False
        if not timed:  # rows without a time have no previous one
            out["instant"], out["prev"], out["open"] = pd.NA, pd.array([pd.NA] * len(out), "Int64"), False
        columns = [c.split()[0] for c in MOVED.split(", ")]
        yield out[columns]
        if timed:
            latest = own.groupby("person", as_index=False).instant.max()
            marks = pd.DataFrame({c: pd.Series([None] * len(latest), dtype="object") for c in columns})
            marks["person"], marks["instant"], marks["mark"], marks["open"] = latest.person, latest.instant, True, False
            marks["timestamp"] = pd.to_datetime(latest.instant, unit="us")
            marks["amount"] = np.nan
            yield marks

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.kept.clear()
        return iter([])

    def close(self) -> None:
        pass


class LastTimes(StatefulProcessor):
    """Fills in previous times that lie before a slice, from the last time of every user."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "data binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:  # nothing is open here
            for part in rows:
                yield finished(part)
            return
        arrived = pd.concat(list(rows), ignore_index=True)
        arrived["instant"] = arrived.instant.astype("int64")
        before = self.last.get()
        known = unpacked(before[0]).set_index("person").instant if before is not None else pd.Series(dtype="int64")
        times = arrived[["person", "instant"]].drop_duplicates().sort_values(["person", "instant"])
        stored = times.person.map(known)
        # the latest earlier time: of this batch, or kept from those before
        earlier = pd.concat([times.groupby("person").instant.shift(1), stored.where(stored < times.instant)], axis=1).max(axis=1)
        rest = arrived[~arrived["mark"].astype(bool)]
        if len(rest):
            found = rest.merge(times.assign(earlier=earlier), on=["person", "instant"], how="left")
            yield finished(found.assign(prev=found.earlier.astype("Int64")))
        latest = pd.concat([known.rename_axis("person").reset_index(name="instant"), times]).groupby("person", as_index=False).instant.max()
        self.last.update((packed(latest, LAST),))

    def close(self) -> None:
        pass


def finished(rows: pd.DataFrame) -> pd.DataFrame:
    prev = pd.array(rows.prev, "Int64")
    time = pd.array(rows.instant, "Int64")
    gap = pd.Series(time - prev, index=rows.index).astype("Float64") / 1e6
    spend = (rows.spent.astype("float64") / MILLION).where(rows.known > 0)
    return rows[["transaction_id", "user_id", "timestamp", "amount"]].assign(
        tx_count_last_1h=rows.tx_count_last_1h.astype("int64"), total_spend_last_24h=spend,
        prev_tx_timestamp=pd.to_datetime(pd.Series(prev, index=rows.index), unit="us"),
        seconds_since_prev_tx=gap.astype("float64"),
    )


def moving(stream: DataFrame, delay: str, length: int = SLICE, groups: int = USER_GROUPS) -> DataFrame:
    """``stream`` with its velocity columns; rows later than the watermark are dropped."""
    number = F.floor(F.unix_micros("timestamp") / length)
    back = -(-DAY // length)  # slices that a row is background of
    copies = F.when(F.col("timestamp").isNull(), F.array(F.struct(F.lit(UNTIMED).alias("slice"), F.lit(True).alias("own")))).otherwise(
        F.array(*[F.struct((number + k).alias("slice"), F.lit(k == 0).alias("own")) for k in range(back + 1)])
    )
    user = F.coalesce(F.concat(F.lit("="), F.col("user_id")), F.lit(""))
    rows = stream.withWatermark("timestamp", delay).select(
        "transaction_id", "user_id", "timestamp", "amount", user.alias("person"), F.unix_micros("timestamp").alias("instant"),
        micros(F.col("amount")).alias("paid"), F.pmod(F.xxhash64(user), F.lit(groups)).alias("people"), F.inline(copies),
    )
    sliced = rows.groupBy("people", "slice").transformWithStateInPandas(
        SliceState(length), MOVED, "Append", "EventTime", eventTimeColumnName="timestamp"
    )
    # rows that need no last time pass through keys of their own, below zero
    last = F.when(F.col("open") | F.col("mark"), F.pmod(F.xxhash64("person"), F.lit(groups))).otherwise(
        -1 - F.pmod(F.xxhash64("transaction_id", "instant"), F.lit(groups))
    )
    return sliced.withColumn("last_key", last).groupBy("last_key").transformWithStateInPandas(LastTimes(), RESULT, "Append", "None")
