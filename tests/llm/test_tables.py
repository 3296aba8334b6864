"""Sharding, mixing, quality, language model, top-k search and the pipeline."""
import collections
import hashlib
import math
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import hmm, line_dedup, mixing, pieces, quality, sharding, topk
from riskloom.llm.queries import QUERIES

from .test_texts import lower, plain_lines, plain_near_copies


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# --- sharding ----------------------------------------------------------------

def check_shards(rows, limit):
    sizes, numbers = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.shard, r.shard_page] += r.n_bytes
        numbers[r.shard, r.shard_page] += 1
    assert all(size <= limit or numbers[s] == 1 for s, size in sizes.items())
    names = sorted({s for s, _ in sizes})
    for a, b in zip(names, names[1:]):  # no shard lies inside another
        assert not b.startswith(a)
    # only buckets over the limit were split: a shard's parent would not have fitted
    for name in names:
        if name:
            inside = [r for r in rows if r.shard.startswith(name[:-1])]
            assert sum(r.n_bytes for r in inside) > limit


@pytest.mark.parametrize("limit", [10**9, 20_000, 3_000, 700])
def test_shards_fit_and_split_only_where_needed(spark, folder, limit):
    docs = documents(spark, folder)
    rows = sharding.assign_shards(docs, limit).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    check_shards(rows, limit)


def test_shards_of_equal_rows_get_pages(docs_of, odd_rows):
    docs = docs_of(odd_rows + [(77, "equal rows " * 10, "a")] * 60)
    rows = sharding.assign_shards(docs, 500).collect()
    assert len(rows) == len(odd_rows) + 60
    check_shards(rows, 500)
    pages = collections.Counter(r.shard_page for r in rows if r.doc_id == 77)
    assert set(pages.values()) == {4} and len(pages) == 15
    assert sharding.assign_shards(docs_of([]), 500).count() == 0


@pytest.mark.parametrize("limit", [1_000, 10**9])
def test_shard_files_hold_one_shard_each(spark, docs_of, odd_rows, tmp_path, limit):
    path = str(tmp_path / "shards")
    sharded = sharding.assign_shards(docs_of(odd_rows), limit)
    sharding.write_shards(sharded, path)
    back = sharding.read_shards(spark, path, sharded.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, sharded.collect()))  # the undivided bucket's name, "", too
    files = back.select("shard", "shard_page", F.input_file_name().alias("file")).distinct().collect()
    assert len({r.file for r in files}) == len(files) == sharded.select("shard", "shard_page").distinct().count()


def test_shards_of_clashing_columns(spark, tmp_path):
    names = ["text", "shard", "shard_page", "n_bytes", "hash", "size", "prefix", "depth", "row", "in_shard", "__hash"]
    rows = [tuple(f"{n}{i} " * 40 for n in names) for i in range(60)]
    docs = spark.createDataFrame(rows, [*names])
    sharded = sharding.assign_shards(docs, 900)
    assert sharded.columns == [*names, "_shard", "_shard_page", "_n_bytes"] == [*docs.columns, *sharding.shard_names(docs)]
    assert sorted(map(tuple, sharded.select(names).collect())) == sorted(rows)
    sharding.write_shards(sharded, str(tmp_path / "s"), ("_shard", "_shard_page"))
    back = sharding.read_shards(spark, str(tmp_path / "s"), sharded.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, sharded.collect()))
    assert back.select("_shard").distinct().count() > 10


def test_rows_that_share_all_bits_get_pages_that_fit(docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(sharding, "row_hash", lambda docs: F.lit(5).cast("long") + 0 * F.char_length("keep"))
    rows = odd_rows + [(i, "x" * 600, "a") for i in range(20)] + [(99, "y" * 300, "a")] * 7
    found = sharding.assign_shards(docs_of(rows), 1_000).collect()
    check_shards(found, 1_000)
    assert len(found) == len(rows)


def test_nulls_and_other_columns_tell_rows_apart(spark):
    rows = [("x" * 600, "a", None), ("x" * 600, None, "a"), ("x" * 600, "a", ""), ("x" * 600, "", "a")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    found = sharding.assign_shards(docs, 1_000).collect()
    assert len({r.shard for r in found}) == 4 and all(r.shard_page == 0 for r in found)


# --- mixing ------------------------------------------------------------------

def plain_digest(row):
    values = [None if v is None else str(v) for v in row]
    return hashlib.md5("".join("-" if v is None else f"{len(v)}:{v}" for v in values).encode()).hexdigest()


def plain_count(rate, parts, seed, key, digest):
    n = 0
    for part in range(1, parts + 1):
        name = "null" if key is None else str(key)
        u = int(hashlib.md5(f"{seed}|{name}|{digest}|{part}".encode()).hexdigest()[:13], 16) / 2**52
        term = total = math.exp(-rate / parts)
        k = 0
        while total <= u and k < mixing.MAX_COUNT + 1:
            k += 1
            term *= rate / parts / k
            total += term
        n += k
    return n


def test_mixing_counts_and_columns(docs_of, odd_rows):
    rows = odd_rows + [(1000 + i, f"t{i}", "hot" if i % 3 else "rare") for i in range(900)]
    docs = docs_of(rows)
    weights = {"hot": 1.0, "rare": 3.0}
    mixed = mixing.mix_sources(docs, weights=weights, epochs=2.0)
    assert mixed.columns == [*docs.columns, "copy"]
    got = collections.Counter((r.doc_id, r.source) for r in mixed.collect())
    sizes = collections.Counter(s for _, _, s in rows)
    for source in ("hot", "rare"):
        rate = 2.0 * len(rows) * weights[source] / 4.0 / sizes[source]
        parts = max(1, math.ceil(rate / mixing.PART_MEAN))
        for row in docs.where(F.col("source") == source).collect():
            assert got[row.doc_id, source] == plain_count(rate, parts, 42, row.doc_id, plain_digest(row))
    share = sum(n for (_, s), n in got.items() if s == "rare") / sum(got.values())
    assert abs(share - 0.75) < 0.05
    assert not any(s not in weights for _, s in got)


def test_mixing_defaults(docs_of, odd_rows, spark):
    docs = docs_of(odd_rows)
    assert mixing.mix_sources(docs, epochs=60.0).count() > 400  # large means are drawn in parts
    assert mixing.mix_sources(docs_of([])).count() == 0
    once, again = mixing.mix_sources(docs, seed=7), mixing.mix_sources(docs.repartition(5), seed=7)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    taken = docs.withColumnRenamed("keep", "copy")
    assert "_copy" in mixing.mix_sources(taken).columns


def test_mixing_of_clashing_columns_and_one_key(spark):
    names = ["doc_id", "source", "text", "n", "digest", "parts", "cumulative", "source_key", "row", "key", "order", "place", "__n", "__source"]
    rows = [(None if i % 2 else 7, "s", *[f"{n}{i}" for n in names[2:]]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, " + ", ".join(f"{n} string" for n in names[1:]))
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == [*names, "copy"]
    got = collections.Counter(tuple(r)[:-1] for r in mixed.collect())
    assert set(got) <= set(rows)
    # rows of one key or of none draw on their own
    assert len(set(got.values())) > 2 and 250 < sum(got.values()) < 550 and len(got) < 350
    spread = mixing.mix_sources(docs).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


# --- quality -----------------------------------------------------------------

def test_quality_on_held_out_labels(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")
    rows = QUERIES["op2_pairwise_quality"](spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == documents(spark, folder).count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    pairs = [(g, b) for g, q, _ in held if q == 1 for b, p, _ in held if p == 0]
    assert sum(g > b for g, b in pairs) / len(pairs) > 0.95
    assert sum(p == q for _, q, p in held) / len(held) > 0.9


def test_quality_of_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    schema = "doc_id bigint, quality int, toxic int, text string"
    labels = spark.createDataFrame(
        [(1, 1, 0, "x"), (2, 1, 0, "x"), (6, 0, 0, "x"), (10, 0, 1, "x"), (None, 0, 0, "x"), (7, None, 0, "x"), (1, 0, 0, "x")],
        schema,
    )
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_documents(docs_of([]), labels).count() == 0
    without = quality.score_documents(docs, spark.createDataFrame([], schema)).collect()
    assert all(abs(r.score - 0.5) < 1e-12 and r.predicted == 1 for r in without)
    assert quality.keep_good(docs, quality.score_documents(docs, spark.createDataFrame([], schema))).count() == len(odd_rows)


def plain_features(text):
    """The features of a text by plain Python over its bytes."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(quality.NAMES)
    found = [w.encode() for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    n, size, spaces = max(len(found), 1), len(raw), sum(b in b" \t\n\x0b\x0c\r" for b in raw)
    upper, lowers = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
    times = collections.Counter(found)

    def known(b):
        return chr(b).isalnum() if b < 128 else True

    out = {
        "log_words": math.log1p(len(found)), "log_bytes": math.log1p(size), "word_length": (size - spaces) / n,
        "upper": upper / max(upper + lowers, 1), "digit": sum(48 <= b <= 57 for b in raw) / size,
        "beyond_ascii": sum(b >= 128 for b in raw) / size, "space": spaces / size, "lines": math.log1p(raw.count(b"\n")),
    }
    if found:
        out |= {
            "distinct_words": math.log1p(len(times)) / math.log1p(n),
            "repeats_previous": sum(a == b for a, b in zip(found, found[1:])) / n,
            "top_word": (max(times.values()) - 1) / n,
            "odd_ending": sum(not known(w[-1]) and chr(w[-1]) not in ".,;:?" for w in found) / n,
            "no_letter": sum(not any(known(b) for b in w) for w in found) / n,
            "short_lines": (raw.count(b"\n") + 1) / n,
        }
    out |= {f"punctuation_{ord(c)}": math.sqrt(raw.count(c.encode()) / size) for c in quality.PUNCTUATION}
    return [out.get(name, 0.0) for name in quality.NAMES]


def test_features_equal_plain_python(spark, folder, odd_rows):
    texts = [r.text for r in documents(spark, folder).collect()] + [t for _, t, _ in odd_rows] + ["-" * 64 + "letters", "-" * 70, "=" * 300 + "a b"]
    found = quality.features(pa.array(texts, pa.string()))
    assert np.allclose(found, [plain_features(t) for t in texts])
    bare = quality.NAMES.index("no_letter")
    assert found[-3, bare] == 0 and found[-2, bare] == 1 and found[-1, bare] == 0  # the whole word counts


def test_every_labelled_row_teaches(spark):
    """One feature is known only from the last rows in hash order, beyond the 20,000 that the fit once stopped at."""
    n, width = 20_600, len(quality.NAMES)
    at = F.row_number().over(Window.orderBy(F.xxhash64("key"), "key"))
    rows = spark.range(n).select(F.col("id").alias("key"), (F.col("id") % 3 > 0).cast("int").alias("quality")).withColumn("at", at)
    first = F.xxhash64(F.col("key"), F.lit(1)) % 7 / 7.0 + F.col("quality") * 0.2
    late = F.when(F.col("at") > 20_000, F.xxhash64(F.col("key"), F.lit(2)) % 5 / 5.0 - F.col("quality")).otherwise(0.0)
    table = rows.select("key", "quality", F.concat(F.array(first, late), F.array_repeat(F.lit(0.0), width - 2)).alias("features"))
    model = quality.fit(table)
    assert model.weights[0] > 0.1 and model.weights[1] < -0.1
    raw = [r[0] for r in table.select(model.raw(F.col("features"))).collect()]
    bad = table.where("quality = 0").count() / n
    assert abs(model.at_quantile - np.quantile(raw, bad)) < 1e-9


def test_ranks_quantiles_and_pairs_hold_every_row(spark):
    rows = spark.range(300).select((F.col("id") % 250).alias("key"), (F.col("id") % 250 % 4 == 0).cast("int").alias("quality"))
    table = rows.withColumn("features", F.array_repeat(F.col("key").cast("double"), len(quality.NAMES)))
    ranks = quality.ranked(table)
    window = Window.partitionBy("quality").orderBy(F.xxhash64("key"), "key")
    expected = table.select("quality", "key", (F.row_number().over(window) - 1).alias("rank")).collect()
    assert sorted(map(tuple, ranks.select("quality", "key", "rank").collect())) == sorted(map(tuple, expected))
    sizes = {r.quality: r["count"] for r in table.groupBy("quality").count().collect()}
    assert sizes[0] > sizes[1]  # the bad side leads
    made = quality.preference_pairs(ranks, sizes[1], sizes[0], sizes[0]).collect()
    # every difference counts a good key once and a bad key once
    total = sum((2 * r.label - 1) * r.features[0] for r in made)
    good = [r.key for r in sorted(expected, key=lambda r: r.rank) if r.quality]
    bad = sum(r.key for r in expected if not r.quality)
    assert total == sum(good[i % len(good)] for i in range(sizes[0])) - bad
    for share in (0.0, 0.1, 0.37, 1.0):
        assert abs(quality.quantile(table, "key", share) - np.quantile([r.key for r in expected], share)) < 1e-9


def test_pairs_fit_and_score_equal_plain_python(spark, folder):
    """Preference pairs, their logistic loss and the scores, worked out again from the features."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = {r.doc_id: plain_features(r.text) for r in documents(spark, folder).collect()}
    taught = {k: labels[k] for k in rows if k in labels and zlib.crc32(str(k).encode()) % 5}
    table = spark.createDataFrame([(k, q, rows[k]) for k, q in taught.items()], "key bigint, quality int, features array<double>")
    model = quality.fit(table, pairs=3_000)
    order = {r.key: r.h for r in table.select("key", F.xxhash64("key").alias("h")).collect()}
    good, bad = (sorted((k for k, q in taught.items() if q == side), key=lambda k: order[k]) for side in (1, 0))
    plain = []
    for i in range(3_000):
        g, b = rows[good[i % len(good)]], rows[bad[(i + i // len(good)) % len(bad)]]
        plain.append((float(i % 2 == 0), [(x - y) * (-1 if i % 2 else 1) for x, y in zip(g, b)]))
    ranks = table.withColumn("rank", F.row_number().over(Window.partitionBy("quality").orderBy(F.xxhash64("key"), "key")).cast("long") - 1)
    made = quality.preference_pairs(ranks, len(good), len(bad), 3_000).collect()
    assert sorted((r.label, tuple(np.round(r.features.toArray(), 9))) for r in made) == sorted((y, tuple(np.round(x, 9))) for y, x in plain)

    y, x = np.array([p[0] for p in plain]), np.array([p[1] for p in plain])
    scale = x.std(axis=0, ddof=1)

    def loss(weights):
        return np.logaddexp(0, -(2 * y - 1) * (x @ weights)).mean() + 0.5e-4 * ((weights * scale) ** 2).sum()

    weights = np.array(model.weights)
    best = loss(weights)
    rng = np.random.default_rng(1)
    for size in (1e-2, 1e-1):  # no nearby weights are better
        for _ in range(40):
            assert loss(weights + size * rng.normal(size=len(weights)) / np.maximum(scale, 1e-3)) >= best - 1e-6
    raw = {k: float(np.dot(rows[k], weights)) for k in taught}
    at = np.quantile(list(raw.values()), len(bad) / len(taught))
    assert np.isclose(model.at_quantile, at) and np.isclose(model.spread, np.std(list(raw.values())))
    scored = spark.createDataFrame([(k, f) for k, f in rows.items()], "k bigint, f array<double>")
    for r in scored.select("k", model.score(F.col("f")).alias("s")).collect():
        z = (np.dot(rows[r.k], weights) - at) / model.spread + math.log(0.3 / 0.7)
        assert np.isclose(r.s, 1 / (1 + math.exp(-z)))


def test_threshold_lies_at_the_quantile(spark):
    model = quality.PairwiseModel([1.0], 2.0, 0.5)
    df = spark.createDataFrame([([1.9],), ([2.0],), ([2.1],)], "f array<double>")
    low, at, high = [r[0] for r in df.select(model.score(F.col("f"))).collect()]
    assert low < 0.3 and at == 0.3 and high > 0.3


# --- language model ----------------------------------------------------------

def plain_hmm(model, seq):
    states = len(model.start)
    forward = np.zeros((len(seq), states))
    forward[0] = model.start * model.emit[seq[0]]
    for t in range(1, len(seq)):
        forward[t] = (forward[t - 1] @ model.move) * model.emit[seq[t]]
    backward = np.ones((len(seq), states))
    for t in range(len(seq) - 2, -1, -1):
        backward[t] = model.move @ (model.emit[seq[t + 1]] * backward[t + 1])
    chance = forward[-1].sum()
    gamma = forward * backward / chance
    move = np.zeros((states, states))
    for t in range(len(seq) - 1):
        move += forward[t][:, None] * model.move * (model.emit[seq[t + 1]] * backward[t + 1])[None] / chance
    emit = np.zeros(model.emit.shape)
    np.add.at(emit, seq, gamma)
    return gamma[0], move, emit, math.log10(chance)


@pytest.mark.parametrize("window", [2, 3, 100])
def test_expected_counts_equal_plain_forward_backward(monkeypatch, window):
    monkeypatch.setattr(hmm, "WINDOW", window)
    rng = np.random.default_rng(window)
    model = hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(7), 3).T)
    seqs = [rng.integers(0, 7, n).astype(np.uint16) for n in (5, 1, 8, 3, 11, 2, 8)]
    block = hmm._Block(seqs)
    plain = [plain_hmm(model, s) for s in seqs]
    start, move, emit, total = block.expected(model)
    for got, k in ((start, 0), (move, 1), (emit, 2)):
        assert np.allclose(got, sum(p[k] for p in plain))
    assert np.isclose(total, sum(p[3] for p in plain))
    assert np.allclose(block.likelihood(model), [p[3] for p in plain])


def test_blocks_are_bounded_by_tokens_and_keep_rows(monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", 5_000)
    rng = np.random.default_rng(2)
    seqs = [rng.integers(0, 9, n).astype(np.uint16) for n in [*rng.integers(1, 900, 300), 20_000, 1]]
    batch = pa.RecordBatch.from_arrays([pa.array([s.tobytes() for s in seqs])], ["classes"])
    seen = []
    for rows, found in hmm._blocks(batch):
        assert sum(map(len, found)) <= 5_000 + max(map(len, found))
        assert all((seqs[i] == f).all() for i, f in zip(rows, found))
        seen += rows.tolist()
    assert sorted(seen) == list(range(len(seqs)))
    assert list(hmm._blocks(batch.slice(0, 0))) == []


def test_a_thousand_long_texts_fit_in_memory():
    """1,000 texts of 5,000 tokens, in a process of its own, below 500 MB with all libraries."""
    code = """
import numpy as np, pyarrow as pa, resource
from riskloom.llm import hmm
rng = np.random.default_rng(0)
frequency = np.full(hmm.CLASSES + 1, 1 / (hmm.CLASSES + 1))
model = hmm.Model.untrained(frequency, hmm.STATES)
batch = pa.RecordBatch.from_arrays([pa.array([rng.integers(0, hmm.CLASSES, 5_000).astype(np.uint16).tobytes() for _ in range(1_000)])], ["classes"])
total = 0.0
for k, (_, sequences) in enumerate(hmm._blocks(batch)):
    if k < 3:
        total += hmm._Block(sequences).expected(model)[3]
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    used = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(hmm.__file__).parents[2]).stdout)
    assert used < 500


def test_training_stops_when_it_gains_little(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(rng.integers(0, 4, 200).astype(np.uint16).tobytes(),) for _ in range(8)], "classes binary")
    calls, from_counts = [], hmm.Model.from_counts
    monkeypatch.setattr(hmm.Model, "from_counts", classmethod(lambda cls, *a: calls.append(1) or from_counts(*a)))
    hmm.baum_welch(rows, np.full(4, 0.25), 2, 30)  # nothing to learn from noise
    assert len(calls) < 10


def test_scores_equal_a_plain_model(spark, monkeypatch):
    """score = log10 of the classes' forward probability and of every word in its class."""
    monkeypatch.setattr(hmm, "HEAD_WORDS", 3)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, rng.integers(0, 30)) if x < 60) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    kept = {}
    train = hmm.baum_welch
    monkeypatch.setattr(hmm, "baum_welch", lambda *a: kept.setdefault("model", train(*a)))
    rows = hmm.score_documents(docs, F.col("doc_id") % 4 == 0, iterations=2).collect()
    counts = collections.Counter(w for i, t in enumerate(texts) if i % 4 for w in plain_tokens(t))

    def kind(w):
        return hmm.CLASSES if w == "\n" else int(hmm.classes_of([w])[0])

    mass, distinct = np.zeros(hmm.CLASSES + 1), np.zeros(hmm.CLASSES + 1)
    for w, c in counts.items():
        mass[kind(w)] += c
        distinct[kind(w)] += 1
    for r in rows:
        tokens = plain_tokens(texts[r.doc_id])
        classes = [kind(w) for w in tokens]
        inside = sum(math.log10((counts[w] + 0.5) / (mass[k] + 0.5 * (distinct[k] + 1))) for w, k in zip(tokens, classes))
        assert np.isclose(r.score, plain_hmm(kept["model"], classes)[3] + inside)


def plain_tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text or "")) if w] + ["\n"]


def check_base(rows, texts):
    """The unigram part, token counts and the training sums by plain counting."""
    held = {k: zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1 for k, _ in texts}
    counts = collections.Counter(w for k, t in texts if not held[k] for w in plain_tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    expected = collections.Counter()
    for key, text in texts:
        tokens = plain_tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        expected[key, held[key], len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 3)] += 1
    got = collections.Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in rows
    )
    assert got == expected


def test_language_model_on_documents(spark, folder, monkeypatch):
    monkeypatch.setattr(hmm, "HEAD_WORDS", 200)  # most words go the way of the shuffle
    rows = QUERIES["op5_hidden_markov_lm"](spark, folder).collect()
    check_base(rows, [(r.doc_id, r.text) for r in documents(spark, folder).collect()])


def test_language_model_beats_counting_on_held_out_documents(spark, folder):
    rows = QUERIES["op5_hidden_markov_lm"](spark, folder.replace("sf0.001", "sf0.01")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.9 * len(rows)


def test_language_model_of_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    rows = hmm.score_documents(docs, quality.held_out(F.col("doc_id"), 5, 1), iterations=1).collect()
    check_base(rows, [(k, t) for k, t, _ in odd_rows])
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert hmm.score_documents(docs_of([]), quality.held_out(F.col("doc_id"), 5, 1), iterations=1).count() == 0
    nothing = hmm.score_documents(docs, F.lit(True), iterations=1).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in nothing)


def test_word_parts_sum_to_one(spark):
    """P(word | class) over the known words and one unknown word of every class."""
    counts = spark.createDataFrame([("a", 3), ("b", 1), ("\n", 2), ("c", 9)], "word string, c bigint")
    mass, kinds = hmm._class_totals(counts)
    assert mass.sum() == 15 and kinds.sum() == 4 and mass[hmm.CLASSES] == 2
    below = mass + 0.5 * (kinds + 1)
    parts = sum((r.c + 0.5) / below[hmm.CLASSES if r.word == "\n" else hmm.classes_of([r.word])[0]] for r in counts.collect())
    unknown = (0.5 / below).sum()
    assert np.isclose(parts + unknown, hmm.CLASSES + 1)


# --- top k -------------------------------------------------------------------

def plain_top(vectors, queries, k):
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    def quantised(v):
        return [math.floor(x * 1024) if abs(x) < 2**60 else int(x) * 1024 for x in v]

    out = []
    for q, v in queries:
        if good(v) and q is not None:
            scores = [
                (-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(quantised(v), quantised(w))))), i)
                for i, w in vectors if i is not None and i != q and good(w) and len(w) == len(v)
            ]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 8)
    monkeypatch.setattr(topk, "BLOCK", 2)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=5), 1)]) for i in range(150)]  # rounded: many ties
    rows += [(200, None), (201, [1.0, None, 2.0, 0.0, 1.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5),
             (204, [1.0, 2.0]), (205, [1.0, 2.5]), (206, []), (None, [1.0] * 5), (300, [0.0] * 5), (301, [-1.0] * 5)]
    df = spark.createDataFrame([(i, v, 0.5, 1) for i, v in rows], "vec_id bigint, embedding array<double>, score double, rank int")
    asked = [r for r in rows if r[0] is None or r[0] % 50 == 0 or r[0] > 199]
    got = topk.top_k(df.repartition(4), df.where("vec_id % 50 = 0 or vec_id > 199 or vec_id is null"), 10)
    assert sorted(map(tuple, got.collect())) == plain_top(rows, asked, 10)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_huge_numbers(spark):
    rows = [(1, [1e8, 3.0]), (2, [2e8, -1.0]), (3, [2e8, -1.0 - 2**-10]), (4, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, df, 2).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, rows, 2)


# --- pipeline ----------------------------------------------------------------

def test_pipeline_equals_its_stages_in_plain_python(spark, folder):
    start = documents(spark, folder)
    scored = quality.score_documents(start, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r.doc_id for r in scored.where("predicted = 1").collect()}
    rows = [r for r in start.collect() if r.doc_id in good]
    cut = {k: text for k, text, _, _ in plain_lines([(r.doc_id, r.text) for r in rows], line_dedup.MIN_DOCUMENTS)}
    components = plain_near_copies(list(cut.items()))
    rows = [r for r in rows if components[r.doc_id, cut[r.doc_id]] == r.doc_id]
    sizes = collections.Counter(r.source for r in rows)
    shares = {s: n**mixing.TEMPERATURE for s, n in sizes.items()}
    expected = {}
    for r in rows:
        rate = len(rows) * shares[r.source] / sum(shares.values()) / sizes[r.source]
        text = cut[r.doc_id]
        digest = plain_digest(tuple({**r.asDict(), "text": text, "n_chars": len(text)}.values()))
        n = plain_count(rate, max(1, math.ceil(rate / mixing.PART_MEAN)), 42, r.doc_id, digest)
        if n:
            expected[r.doc_id] = (n, cut[r.doc_id])
    got = corpus_pipeline.run(spark, folder)
    table = pieces.Vocabulary.load().decoder()
    found = collections.defaultdict(list)
    for r in got.collect():
        assert r.lossless
        found[r.doc_id].append(pieces.decode(table, r.pieces))
    assert {k: (len(v), v[0]) for k, v in found.items()} == expected


def test_pipeline_stages_keep_the_columns(spark, docs_of, odd_rows, folder):
    docs = docs_of(odd_rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert out.collect() is not None
        assert stage(spark, docs_of([]), folder).count() == 0
    assert len(corpus_pipeline.STAGES) == 5
    last = corpus_pipeline.STAGES[-1][1]
    made = last(spark, docs, folder)
    assert made.count() == len(odd_rows) and made.where("lossless").count() == len(odd_rows)
    assert last(spark, docs_of([]), folder).count() == 0


def test_every_query_is_registered():
    numbers = {int(m.group(1)) for n in QUERIES if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 14))
