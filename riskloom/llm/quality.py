"""Quality classifier by Bradley-Terry pairwise ranking.

Labelled documents give preference pairs: a good document is preferred to a bad
one. The chance that it is, is modelled as the logistic function of the
difference of two scores, each linear in the document's features, so logistic
regression without intercept on feature differences learns the scores. The
threshold is a quantile of the scores of the documents it was fitted on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.text import fresh, whole, words
from riskloom.operators.ordered import running_totals, stored_slices
from riskloom.session import scratch_path

FIT_PAIRS = 40_000  # preference pairs at least; more where the labelled rows are more
ROUNDS = 2  # pairs at least that every row of the larger class is in
THRESHOLD = 0.3  # of the score; the quantile is mapped to it
# ASCII punctuation, one feature each.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
NAMES = [
    "log_words", "log_bytes", "word_length", "upper", "digit", "beyond_ascii", "space", "lines",
    "distinct_words", "repeats_previous", "top_word", "odd_ending", "no_letter", "short_lines",
    *[f"punctuation_{ord(c)}" for c in PUNCTUATION],
]


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[ord("A"):ord("Z") + 1] = 1
    table[ord("a"):ord("z") + 1] = 2
    table[ord("0"):ord("9") + 1] = 3
    table[128:] = 4
    return table


_CLASS = _class_table()
_SPACES = [9, 10, 11, 12, 13, 32]


def features(texts: pa.Array) -> np.ndarray:
    """One row of features per whole text, in the order of NAMES; all 0 for an empty text."""
    n = len(texts)
    out = np.zeros((n, len(NAMES)))
    raw = whole(texts).cast(pa.large_binary())
    bytes_of = np.zeros((n, 256))
    for i, text in enumerate(raw):
        bytes_of[i] = np.bincount(np.frombuffer(text.as_buffer(), np.uint8), minlength=256) if len(text.as_buffer()) else 0
    size = bytes_of.sum(axis=1)
    some = np.maximum(size, 1)
    letters = np.maximum(bytes_of[:, _CLASS == 1].sum(axis=1) + bytes_of[:, _CLASS == 2].sum(axis=1), 1)
    out[:, 1] = np.log1p(size)
    out[:, 3] = bytes_of[:, _CLASS == 1].sum(axis=1) / letters
    out[:, 4] = bytes_of[:, _CLASS == 3].sum(axis=1) / some
    out[:, 5] = bytes_of[:, _CLASS == 4].sum(axis=1) / some
    out[:, 6] = bytes_of[:, _SPACES].sum(axis=1) / some
    out[:, 7] = np.log1p(bytes_of[:, 10])
    for k, c in enumerate(PUNCTUATION):
        out[:, len(NAMES) - len(PUNCTUATION) + k] = np.sqrt(bytes_of[:, ord(c)] / some)
    counts, flat = words(texts, lower=False)
    total = np.maximum(counts, 1)
    out[:, 0] = np.log1p(counts)
    out[:, 2] = (size - bytes_of[:, _SPACES].sum(axis=1)) / total
    if not len(flat):
        return out
    owner = np.repeat(np.arange(n), counts)
    encoded = flat.dictionary_encode()
    ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kinds = [word.encode() for word in encoded.dictionary.to_pylist()]
    odd = np.array([_CLASS[w[-1]] == 0 and w[-1:] not in b".,;:?" for w in kinds])
    bare = np.array([not _CLASS[np.frombuffer(w, np.uint8)].any() for w in kinds])
    pairs, times = np.unique(owner * len(kinds) + ids, return_counts=True)
    pair_owner = pairs // len(kinds)
    out[:, 8] = np.log1p(np.bincount(pair_owner, minlength=n)) / np.log1p(total)
    top = np.zeros(n)
    np.maximum.at(top, pair_owner, times)
    out[:, 10] = np.maximum(top - 1, 0) / total
    same = (ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])
    out[:, 9] = np.bincount(owner[1:][same], minlength=n) / total
    out[:, 11] = np.bincount(owner, weights=odd[ids], minlength=n) / total
    out[:, 12] = np.bincount(owner, weights=bare[ids], minlength=n) / total
    out[:, 13] = (bytes_of[:, 10] + 1) / total
    out[counts == 0, 13] = 0
    return out


def text_features(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, features) per row."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column("text"))
            offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))],
                ["key", "features"],
            )

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, features array<double>")


def held_out(key: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the key as text leaves the fold's remainder; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


@dataclass
class PairwiseModel:
    """Weights of the features, the score at the quantile, and the spread of scores."""

    weights: list[float]
    at_quantile: float
    spread: float

    def raw(self, features: Column) -> Column:
        terms = F.zip_with(features, F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w)
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    def score(self, features: Column) -> Column:
        """0 to 1, increasing in the raw score, and THRESHOLD exactly at the quantile."""
        odds = math.log(THRESHOLD / (1 - THRESHOLD))
        z = (self.raw(features) - F.lit(self.at_quantile)) / F.lit(self.spread)
        return F.when(z == 0, F.lit(THRESHOLD)).otherwise(1 / (1 + F.exp(-(z + odds))))


def preference_pairs(rows: DataFrame, good: int, bad: int, pairs: int = FIT_PAIRS) -> DataFrame:
    """(label, difference): good minus bad with label 1, and every other pair turned round with label 0.

    ``rows`` has rank (hash order within its class), quality and features;
    ``good`` and ``bad`` are the sizes of the classes. The larger class is gone through in
    rounds beside the smaller one, never crossed with it: as many pairs as the larger class has rows hold every row.
    """
    # the smaller side moves on by one more after each round through the larger one, so rounds don't repeat pairs
    lead, other = F.col("id") % max(good, bad), (F.col("id") + F.floor(F.col("id") / F.lit(max(good, bad)))) % min(good, bad)
    numbered = rows.sparkSession.range(pairs).select(
        "id", (lead if good >= bad else other).alias("good_rank"), (other if good >= bad else lead).alias("bad_rank"),
    )
    g = rows.where("quality = 1").select(F.col("rank").alias("good_rank"), F.col("features").alias("good"))
    b = rows.where("quality = 0").select(F.col("rank").alias("bad_rank"), F.col("features").alias("bad"))
    turned = F.col("id") % 2 == 1
    return numbered.join(g, "good_rank").join(b, "bad_rank").select(
        F.when(turned, 0.0).otherwise(1.0).alias("label"),
        array_to_vector(F.zip_with("good", "bad", lambda x, y: F.when(turned, y - x).otherwise(x - y))).alias("features"),
    )


def ranked(labelled: DataFrame) -> DataFrame:
    """``labelled`` stored with each row's ``rank`` from 0 in hash order within its class; ranks are counted inside slices."""
    stored = stored_slices(labelled.withColumns({"_hash": F.xxhash64("key"), "n": F.lit(1).cast("long")}), "quality", "_hash")
    totals = stored.groupBy("quality", "_slice").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("quality").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice and class
    carried = totals.select("quality", "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("quality", "_slice").orderBy("_hash", "key", "features"))
    return stored.withColumn("_inside", inside).join(F.broadcast(carried), ["quality", "_slice"]).select(
        "key", "quality", "features", (F.col("_before") + F.col("_inside") - 1).alias("rank"))


def quantile(values: DataFrame, column: str, share: float) -> float:
    """The exact quantile of a column, between two values in proportion, from counts of distinct values in slices."""
    counts = values.groupBy(F.lit("all").alias("curve"), column).agg(F.count("*").alias("n"))
    stored = stored_slices(counts, "curve", column)
    place = share * (stored.agg(F.sum("n")).first()[0] - 1)
    low = math.floor(place)
    reached = running_totals(stored, "curve", column, ["n"]).agg(*[
        F.min(F.when(F.col("cum_n") > F.lit(at), F.col(column))) for at in (low, math.ceil(place))
    ]).first()
    return float(reached[0] + (reached[1] - reached[0]) * (place - low))


def fit(labelled: DataFrame, pairs: int = FIT_PAIRS) -> PairwiseModel:
    """Fit on all rows (key, quality 0 or 1, features); each is in ``ROUNDS`` pairs at least, so pairs grow with the rows.

    The quantile is the share of bad documents, so the threshold passes as many
    as were marked good.
    """
    spark = labelled.sparkSession
    path = scratch_path(spark, "quality-fit")
    ranked(labelled).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    good, bad = sizes.get(1, 0), sizes.get(0, 0)
    if not good or not bad:
        # nothing to prefer: every score is 0.5
        return PairwiseModel([0.0] * len(NAMES), math.log(THRESHOLD / (1 - THRESHOLD)), 1.0)
    learner = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=100, standardization=True)
    made = preference_pairs(rows, good, bad, max(pairs, ROUNDS * max(good, bad)))
    weights = [float(w) for w in learner.fit(made).coefficients]
    raw = rows.select(PairwiseModel(weights, 0.0, 1.0).raw(F.col("features")).alias("raw"))
    spread = raw.agg(F.stddev_pop("raw")).first()[0]
    return PairwiseModel(weights, quantile(raw, "raw", bad / (good + bad)), float(spread) or 1.0)


def score_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality",
    pairs: int = FIT_PAIRS,
) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``.

    Only labelled rows that are not held out teach the model, and all of them do;
    text is its only input. A null text counts as empty; empty texts get a score like any other.
    Labels other than 0 and 1 and null keys teach nothing; a key with labels of
    both kinds teaches with its larger one. Repeated rows are scored each. An
    empty table gives an empty result; without labels of both kinds nothing is
    learnt and every score is 0.5. Other columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "quality-features")
    text_features(docs, key, text).write.parquet(path)  # texts are read once
    marked = spark.read.parquet(path)
    known = labels.where(F.col(key).isNotNull() & F.col(quality).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(
        F.max(quality).cast("int").alias("quality")
    )
    model = fit(marked.join(known.where(~held_out(F.col("key"))), "key"), pairs)
    scored = marked.select(
        F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"), model.score(F.col("features")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, scored: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key is not rejected; a key with several scores stays if any passes."""
    name = fresh(docs, "__key")
    rejected = scored.groupBy(F.col("doc_id").alias(name)).agg(F.max("predicted").alias("__p")).where("__p = 0").drop("__p")
    return docs.join(rejected, F.col(key).eqNullSafe(F.col(name)), "left_anti")
