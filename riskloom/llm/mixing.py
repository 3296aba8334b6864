"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Each document of a source is repeated n times, where n is Poisson distributed
with the source's mean target rate. n comes from inverting the distribution at
a number hashed from seed and document, so a repeated run or a lost executor
gives the same copies. The copies are shuffled globally by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import fresh, row_digest
from riskloom.session import scratch_path

# A mean above this is drawn as a sum of equal parts, whose sum is again Poisson.
PART_MEAN = 16.0
# P(n > 80) at mean 16 is below 1e-27, far under the 2^-52 steps of the hash.
MAX_COUNT = 80
TEMPERATURE = 0.7


def hashed_unit(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the parts' MD5."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _cumulative(mean: Column) -> Column:
    """P(n <= k) for k = 0..MAX_COUNT as an array."""
    first = F.exp(-mean)
    start = F.struct(first.alias("term"), first.alias("total"), F.array(first).alias("out"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        total = acc["total"] + term
        return F.struct(term.alias("term"), total.alias("total"), F.concat(acc["out"], F.array(total)).alias("out"))

    counts = F.transform(F.sequence(F.lit(1), F.lit(MAX_COUNT)), lambda k: k.cast("double"))
    return F.aggregate(counts, start, step, lambda acc: acc["out"])


def target_rates(
    docs: DataFrame, source: str = "source", weights: dict[str, float] | None = None,
    epochs: float = 1.0, temperature: float = TEMPERATURE,
) -> DataFrame:
    """One row per source: size, mean rate, parts of the draw and the distribution of a part.

    Without weights a source's share is its number of documents to the power of
    ``temperature``. A source without a weight gets rate 0. The rates keep the
    expected number of documents at ``epochs`` times the input.
    """
    sizes = docs.groupBy(F.col(source).alias("source_key")).agg(F.count("*").alias("size"))
    if weights is None:
        share = F.pow(F.col("size").cast("double"), F.lit(temperature))
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source_key") == name, F.lit(float(weight))).otherwise(share)
    shares = sizes.select("source_key", "size", share.alias("share"))
    totals = {f"all_{c}": shares.agg(F.sum(c)).scalar() for c in ("size", "share")}
    rated = shares.withColumns(totals).select(
        "source_key", "size",
        F.when(
            F.col("all_share") > 0,
            F.lit(epochs) * F.col("all_size") * F.col("share") / F.col("all_share") / F.col("size"),
        ).otherwise(F.lit(0.0)).alias("rate"),
    )
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN).cast("int"))
    return rated.withColumn("parts", parts).withColumn(
        "cumulative", _cumulative(F.col("rate") / F.col("parts"))
    )


def mix_sources(
    docs: DataFrame, key: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
    epochs: float = 1.0, seed: int = 42, temperature: float = TEMPERATURE, copy_column: str = "copy",
    ordered: bool = True,
) -> DataFrame:
    """The documents repeated to their source's target rate, in a global hash order.

    All columns stay; ``copy_column`` (renamed with underscores if taken)
    numbers the copies from 1. Documents drawn 0 times are absent. Seed, key,
    whole row and rate decide the count, so only rows equal in all columns draw
    the same one, also where a key is null or repeated. A null source is a
    source of its own, weighted only by temperature; null keys and texts are
    kept as they are. An empty table stays empty. The order is the same for the
    same input files; equal rows are spread over tasks by their place in them.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "source-rates")
    target_rates(docs, source, weights, epochs, temperature).select("source_key", "parts", "cumulative").write.parquet(path)
    rates = spark.read.parquet(path)  # measured by the optimizer, which broadcasts it only when small
    copy = fresh(docs, copy_column)
    # the row as one column, so that no name of its columns can clash
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("key"),
        F.col(f"`{source}`").alias("source"), row_digest(docs).alias("digest"),
    )

    def drawn(part: Column) -> Column:
        u = hashed_unit(F.lit(seed), F.col("key"), F.col("digest"), part)
        return F.size(F.filter(F.col("cumulative"), lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda acc, part: acc + drawn(part))
    counted = held.join(rates, F.col("source").eqNullSafe(F.col("source_key"))).withColumn("n", count)
    copies = counted.where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    columns = [*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], F.col("copy").alias(copy)]
    if not ordered:
        return copies.select(*columns)
    place = F.monotonically_increasing_id()  # spreads equal rows; a repeated task gives the same numbers
    shuffled = copies.select("row", "copy", F.xxhash64(F.lit(seed), "digest", "copy").alias("order"), place.alias("place"))
    # a hash exchange needs no sample of the keys, for which all texts would be read once more
    return shuffled.repartition("order", "place").sortWithinPartitions("order", "place").select(*columns)
