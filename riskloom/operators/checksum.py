"""Order-independent content checksum of a table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


STEP = 2.0**52


def exact_text(value: Column) -> Column:
    """A double as four whole numbers: every finite value from 2^-104 to 2^115 has a text of its own.

    Scaling by powers of two and taking whole parts is exact in any engine,
    which float formatting is not.
    """
    top = F.floor(value / STEP)
    rest = value - top * STEP
    low = (rest - F.floor(rest)) * STEP
    parts = [top, F.floor(rest), F.floor(low), F.floor((low - F.floor(low)) * STEP)]
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(finite, F.concat_ws(",", *[p.cast("bigint").cast("string") for p in parts])).otherwise(value.cast("string"))


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row: its values as text in column order, each with its length in front, nulls as ``n``."""
    parts = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            text = exact_text(value.cast("double"))
        elif isinstance(field.dataType, T.TimestampType):
            text = F.unix_micros(value).cast("string")
        else:
            text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("n")))
    return F.sha2(F.concat(*parts), 256)


def digest_number(df: DataFrame) -> Column:
    """Low 60 bits of the row digest as a decimal that sums without overflow."""
    return F.conv(F.substring(row_digest(df), 50, 15), 16, 10).cast("decimal(20,0)")


def checksum_text(row_count: Column, digest_sum: Column) -> Column:
    """The folded digests as one SHA-256 text."""
    return F.sha2(F.concat_ws("|", row_count.cast("string"), digest_sum.cast("string")), 256)


def checksum_of(row_count: int, digest_sum: object) -> str:
    """The same text from values already at hand."""
    return hashlib.sha256(f"{row_count}|{digest_sum}".encode()).hexdigest()


def content_checksum(df: DataFrame) -> DataFrame:
    """One row: row_count, digest_sum, content_checksum."""
    return (
        df.select(digest_number(df).alias("d"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.sum("d"), F.lit(0)).cast("decimal(38,0)").alias("digest_sum"),
        )
        .withColumn("content_checksum", checksum_text(F.col("row_count"), F.col("digest_sum")))
    )
