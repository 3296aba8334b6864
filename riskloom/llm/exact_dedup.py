"""Exact deduplication by a two-pass Bloom filter (DataFrame functions only).

Pass one counts how often each Bloom position is taken and keeps the positions
taken at least twice as bitmaps. Pass two tests every text's digest against the
bitmaps: a digest with a position taken once is unique and passes straight
through; only the rest shuffle, by digest, and are grouped exactly. The filter
can only send too many rows to the shuffle, never too few, so results are exact
at any size of the filter.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import ascii_lower
from riskloom.session import scratch_path

BITMAP_BITS = 32_768  # of one bitmap of Spark's bitmap functions, 4 KiB
BITS_PER_ROW = 16
MAX_BITS = 2**31  # the filter is broadcast; at most 256 MiB whatever the input
PROBES = 2


def _position(digest: Column, probe: int, bits: int) -> Column:
    """The probe's Bloom position, from its own 52 bits of the digest."""
    digits = F.substring(digest, 1 + 13 * probe, 13)
    return F.conv(digits, 16, 10).cast("long") % F.lit(bits)


def _bit(bitmap: Column, position: Column) -> Column:
    """Whether the bitmap has the bit of a position; without a bitmap, no."""
    within = (position % BITMAP_BITS).cast("int")
    octet = F.conv(F.hex(F.substring(bitmap, F.shiftright(within, 3) + 1, F.lit(1))), 16, 10).cast("int")
    shifted = F.floor(octet / F.pow(F.lit(2), within % 8)).cast("int")
    return F.coalesce(shifted % 2 == 1, F.lit(False))


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "exact-dedup")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def repeated_positions(digests: DataFrame, bits: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the positions that at least two rows take."""
    positions = F.array(*[_position(F.col("text_sha256"), p, bits) for p in range(PROBES)])
    taken = digests.select(F.explode(F.array_distinct(positions)).alias("position"))
    twice = taken.groupBy("position").count().where("count > 1")
    return twice.groupBy(F.floor(F.col("position") / BITMAP_BITS).alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(position % {BITMAP_BITS})").alias("bitmap")
    )


def mark_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after A-Z are lower-cased; a null
    text counts as empty. Of equal texts the largest key stays (a null key only
    if all are null); rows that repeat both key and text are counted, and
    exactly one of them stays. An empty table gives an empty result; further
    columns of the input are not read.
    """
    source = docs.select(
        F.col(key).alias("doc_id"),
        F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256).alias("text_sha256"),
    )
    digests = _written(source)  # texts are read once; ids and digests are small
    rows = digests.count()
    bits = min(max_bits, max(BITMAP_BITS, 2 ** ceil(log2(max(1, rows * BITS_PER_ROW)))))
    bitmaps = _written(repeated_positions(digests, bits))

    tested = digests
    for p in range(PROBES):
        position = _position(F.col("text_sha256"), p, bits)
        tested = (
            tested.withColumn("position", position)
            .withColumn("bucket", F.floor(F.col("position") / BITMAP_BITS))
            # bounded by max_bits: at most max_bits / 8 bytes
            .join(F.broadcast(bitmaps), "bucket", "left")
            .withColumn(f"hit{p}", _bit(F.col("bitmap"), F.col("position")))
            .drop("position", "bucket", "bitmap")
        )
    both = F.lit(True)
    for p in range(PROBES):
        both = both & F.col(f"hit{p}")
    tested = tested.withColumn("maybe", both).select("doc_id", "text_sha256", "maybe")

    single = tested.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    # rows of one key and text are one entry with a count, so that no group meets in one task
    entries = _written(tested.where("maybe").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies")))
    # a table of its own, so that the join has an exchange on both sides and a hot group can be split
    groups = _written(
        entries.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    )
    grouped = (
        entries.join(groups, "text_sha256")
        .select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
        .select(
            "doc_id", "keep_id", "group_size",
            ((F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256",
        )
    )
    return single.unionByName(grouped)
