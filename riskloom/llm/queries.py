"""The operators as queries over whole tables. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    exact_dedup, hmm, line_dedup, merkle, mixing, pieces, pseudonyms, quality, sharding, simhash, topk, warc,
    whitening,
)
from riskloom.llm.shipping import prepare
from riskloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
PSEUDONYM_KEY = "key of the registered query"  # a real run takes its key from a secret store
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[name] = run
        return build

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_sampled_pieces")
def op1(spark, d):
    return pieces.encode_documents(_table(spark, d, "documents"), keep_columns=False)


@query("op2_pairwise_quality")
def op2(spark, d):
    return quality.score_documents(_table(spark, d, "documents"), _table(spark, d, "labels"))


@query("op3_extendible_shards")
def op3(spark, d):
    """The shards are written, and the columns come from reading them back."""
    sharded, path = sharding.assign_shards(_table(spark, d, "documents")), scratch_path(spark, "shards")
    sharding.write_shards(sharded, path)
    return sharding.read_shards(spark, path, sharded.schema).select("doc_id", "shard", "shard_page", "n_bytes")


@query("op4_poisson_mix")
def op4(spark, d):
    return mixing.mix_sources(_table(spark, d, "documents"))


@query("op5_hidden_markov_lm")
def op5(spark, d):
    return hmm.score_documents(_table(spark, d, "documents"), quality.held_out(F.col("doc_id"), 5, 1))


@query("op6_simhash_components")
def op6(spark, d):
    return simhash.near_duplicates(_table(spark, d, "documents"))


@query("op7_feistel_pseudonyms")
def op7(spark, d):
    return pseudonyms.pseudonymise(_table(spark, d, "documents"), PSEUDONYM_KEY).select("doc_id", "n_replaced", "text")


@query("op8_line_dedup")
def op8(spark, d):
    return line_dedup.drop_repeated_lines(_table(spark, d, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


@query("op9_bloom_exact_dedup")
def op9(spark, d):
    return exact_dedup.mark_duplicates(_table(spark, d, "documents"))


@query("op10_branch_and_bound_top_k")
def op10(spark, d):
    vectors = _table(spark, d, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query("op11_merkle_manifest")
def op11(spark, d):
    return merkle.manifest(_table(spark, d, "documents"))


@query("op12_spectrum_whitening")
def op12(spark, d):
    return whitening.whiten(_table(spark, d, "embeddings"))


@query("op13_seekable_warc")
def op13(spark, d):
    return warc.archived(_table(spark, d, "pages"))
