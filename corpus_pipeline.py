"""From raw documents to sampled pieces: the operators in a row, each stage written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. ``run`` applies them to the documents.

Further columns are kept, under their own names. In every stage a null text
counts as empty, and an empty table stays empty; each docstring says what else
becomes of nulls, empty texts and repeated rows, as the operators' own do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import line_dedup, mixing, near_copies, pieces, quality, simhash
from riskloom.llm.shipping import prepare
from riskloom.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Empty texts are scored like any other. A key with several rows stays whole
    if any of them passes; a null key is a key. Without labels all stay.
    """
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.score_documents(docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go from all of them; ``n_chars`` follows the text.

    No document goes: one that loses all its lines, or has none, stays with an
    empty text. Rows that repeat key and text are one document to the count.
    """
    prepare(spark)
    kept = line_dedup.drop_repeated_lines(docs).select(docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, by two kinds of groups: fingerprints within two bits, and near copies.

    Near copies have a Jaccard similarity of 0.8 or more of their five-word
    shingles, which two bits of a fingerprint find only for the closest. Both
    are worked out over all documents, and one that is not the smallest key of
    either group goes. A null key stays only where its group has no other.
    Empty and blank texts are one group. Of rows that repeat the key that
    stays, one stays.
    """
    prepare(spark)
    return simhash.keep_one(docs, simhash.near_duplicates(docs), near_copies.near_copies(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to their source's target rate and shuffled.

    A null source is a source; only rows equal in all columns draw alike.
    """
    prepare(spark)
    return mixing.mix_sources(docs).select(docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become sampled pieces; an empty text has none. Rows that repeat key and text get the same ones."""
    prepare(spark)
    return pieces.encode_documents(docs).drop("text")


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

#: None: sampled pieces and fingerprints are beyond SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
