"""Sharding by extendible hashing.

A shard is a bucket named by the first bits of a row's hash. Starting from one
bucket of no bits, every bucket over the byte limit, and no other, splits on
its next bit until all fit. Sizes of all prefixes of a level come from one
aggregate of the bytes by a longer prefix; levels are taken several bits at a
time, and only rows of buckets still too large go on to the next ones. The
directory maps each prefix to the depth of its bucket; rows find their bucket
by joining the directory on their prefix.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.llm.text import fresh, row_digest
from riskloom.session import scratch_path

HASH_BITS = 60  # 15 hexadecimal digits of the MD5
SPARE_BITS = 3  # prefix bits beyond those that an even split needs
LIMIT_BYTES = 1 << 20


def row_hash(docs: DataFrame) -> Column:
    """60 hash bits of a whole row; rows equal in all columns cannot be split, and few others share all bits."""
    return F.conv(F.substring(row_digest(docs), 1, 15), 16, 10).cast("long")


def _prefix(value: Column, bits: Column | int, of: int = HASH_BITS) -> Column:
    return F.call_function("shiftright", value, (F.lit(of) - bits).cast("int"))


def _levels(rows: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Split the buckets of ``low`` bits that hold ``rows`` down to at most ``high`` bits.

    Returns the directory (prefix of ``high`` bits, depth; null where the bucket
    is still over the limit) and the shards (depth, shard, rows, bytes).
    """
    fine = rows.groupBy(_prefix(F.col("hash"), high).alias("prefix")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")
    )
    # every shorter prefix of a fine one, with its size; pre-aggregated, so small beside the rows
    sized = (
        fine.select("*", F.explode(F.sequence(F.lit(low + (low > 0)), F.lit(high))).alias("depth"))
        .groupBy("depth", _prefix(F.col("prefix"), F.col("depth"), high).alias("shard"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        # one row alone over the limit cannot be split by any number of bits
        .where((F.col("bytes") <= limit) | (F.col("n") == 1))
    )
    path_rows = fine.select(
        "prefix", F.explode(F.sequence(F.lit(low + (low > 0)), F.lit(high))).alias("depth")
    ).withColumn("shard", _prefix(F.col("prefix"), F.col("depth"), high))
    fits = path_rows.join(sized.select("depth", "shard"), ["depth", "shard"], "left_semi")
    depths = fits.groupBy("prefix").agg(F.min("depth").alias("depth"))
    directory = fine.select("prefix").join(depths, "prefix", "left")
    return directory, sized


def assign_shards(docs: DataFrame, limit_bytes: int = LIMIT_BYTES, text: str = "text") -> DataFrame:
    """The rows with their shard: ``shard`` (hash bits as text), ``shard_page``, ``n_bytes``.

    Every shard holds at most ``limit_bytes`` bytes of text, save a shard of a
    single longer document. Rows that share all hash bits, as rows equal in all
    columns do, are dealt to pages of that shard that fit the limit (``shard_page``
    from 0; 0 for every other row). Null and empty texts have 0 bytes. An empty
    table gives an empty result; clashing columns of the input keep their names
    and the new ones get underscores in front.
    """
    spark = docs.sparkSession
    names = shard_names(docs)
    # the row as one column, so that no name of its columns can clash
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_hash(docs).alias("hash"),
        F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("size"),
    )
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    thin_path = scratch_path(spark, "shard-sizes")
    keyed.select("hash", "size").write.parquet(thin_path)
    thin = spark.read.parquet(thin_path)
    total = thin.agg(F.sum("size")).first()[0] or 0

    low, high = 0, min(HASH_BITS, SPARE_BITS + ceil(log2(max(1.0, total / limit_bytes))))
    parts, rest, open_rows = [], keyed, thin
    while True:
        path = scratch_path(spark, "shard-directory")
        _levels(open_rows, low, high, limit_bytes)[0].write.parquet(path)
        directory = spark.read.parquet(path)
        on = [_prefix(F.col("hash"), high) == F.col("prefix")]
        found = rest.join(directory, on)
        bits = F.lpad(F.conv(_prefix(F.col("hash"), F.col("depth")).cast("string"), 10, 2), F.col("depth"), F.lit("0"))
        parts.append(found.where("depth is not null").select(
            *columns, F.when(F.col("depth") == 0, F.lit("")).otherwise(bits).alias(names[0]),
            F.lit(0).cast("long").alias(names[1]), F.col("size").alias(names[2]),
        ))
        still_open = directory.where("depth is null").select("prefix")
        if still_open.isEmpty():
            break
        rest = rest.join(still_open, on, "left_semi")
        if high == HASH_BITS:
            parts.append(_pages(rest, columns, names, limit_bytes))
            break
        open_rows = open_rows.join(still_open, on, "left_semi")
        low, high = high, min(HASH_BITS, high + 8)
    return reduce(DataFrame.unionByName, parts)


def shard_names(docs: DataFrame) -> list[str]:
    """Names of the new columns beside those of the input."""
    return [fresh(docs, n) for n in ("shard", "shard_page", "n_bytes")]


def _pages(rows: DataFrame, columns: list[Column], names: list[str], limit: int) -> DataFrame:
    """Rows that share all hash bits: equal ones are counted and dealt to pages, others get pages of their own."""
    counted = rows.groupBy("row", "hash", "size").agg(F.count("*").alias("copies"))
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("size"), F.lit(1)))).cast("long")
    paged = counted.withColumn("pages", F.ceil(F.col("copies") / per_page).cast("long"))
    # different rows of one hash, which are few
    before = Window.partitionBy("hash").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = paged.withColumn("first", F.coalesce(F.sum("pages").over(before), F.lit(0)))
    bits = F.lpad(F.conv(F.col("hash").cast("string"), 10, 2), HASH_BITS, "0")
    return placed.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select(
        *columns, bits.alias(names[0]),
        (F.col("first") + F.floor((F.col("copy") - 1) / per_page)).cast("long").alias(names[1]), F.col("size").alias(names[2]),
    )


def write_shards(sharded: DataFrame, path: str, names: tuple[str, str] = ("shard", "shard_page")) -> None:
    """One folder per shard page; each is written by one task, as it fits the limit.

    ``names`` are the columns that ``assign_shards`` added. Folders have a name
    of their own, the undivided bucket ``whole``; all columns stay in the files.
    """
    folders = [fresh(sharded, "in_shard"), fresh(sharded, "in_page")]
    shard, page = (F.col(f"`{n}`") for n in names)
    named = sharded.withColumns({folders[0]: F.when(shard == "", "whole").otherwise(shard), folders[1]: page})
    named.repartition(*folders).write.partitionBy(*folders).parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all shards as they were written; ``schema`` is that of the sharded table."""
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{n}`") for n in schema.names])
