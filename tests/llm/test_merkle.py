"""The Merkle manifest against a plain tree over sorted rows."""
import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import merkle
from riskloom.llm.queries import QUERIES

from .conftest import SCHEMA


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    values = [row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + more, row.text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_paths(leaves):
    """The last node and every leaf's (siblings before, siblings after) by level."""
    paths, at, row = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(row) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 2 * 2
            path.append((row[run:at[i]], row[at[i] + 1:run + 2]))
            at[i] //= 2
        row = [digest(*row[i:i + 2]) for i in range(0, len(row), 2)]
    return row[0], paths


def plain_manifest(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r)))
        trees[g] = plain_paths([plain_leaf(r) for r in groups[g]])
    if not names:
        return collections.Counter()
    root, upper = plain_paths([trees[g][0] for g in names])
    out = collections.Counter()
    for g, above in zip(names, upper):
        for r, inside in zip(groups[g], trees[g][1]):
            path = inside + above
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
            folded = plain_leaf(r, int(tampered))
            for before, after in path:
                folded = digest(*before, folded, *after)
            proof = digest(*[s for before, after in path for s in [*before, *after]])
            out[r.doc_id, plain_leaf(r), trees[g][0], root, proof, folded, folded == root] += 1
            assert (folded == root) != tampered
    return out


def got(df):
    return collections.Counter(map(tuple, df.collect()))


def test_manifest_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert got(QUERIES["op11_merkle_manifest"](spark, folder)) == plain_manifest(docs.collect())


@pytest.mark.parametrize("n", [1, 3, 257, 700])
def test_manifest_over_several_stages_of_blocks(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "BLOCK_BITS", 2 if n < 600 else 3)
    rows = [(i * 37 - 5000, f"t{i}", "big" if i % 3 else f"l{i % 7}", None, i, "", "", "") for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(merkle.manifest(docs)) == plain_manifest(docs.collect())


def test_manifest_of_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    rows = [r for r in docs.collect()]
    assert got(merkle.manifest(docs)) == plain_manifest(rows)
    more = [(5, f"same key {i % 20}", None if i % 2 else "ü", "s", 2**63 - 1, "", "", "") for i in range(90)]
    more += [(-(2**63), "", "", "", None, "", "", ""), (2**63 - 1, None, None, None, 0, "", "", ""), (None, "x", None, "", 1, "", "", "")]
    more += [(i, "t", "ü", None, i, "", "", "") for i in range(64)]
    odd = spark.createDataFrame(more, SCHEMA).unionByName(docs)
    odd = odd.withColumnsRenamed({"keep": "pos", "row": "leaf", "k": "g"})
    assert got(merkle.manifest(odd)) == plain_manifest(odd.collect())
    assert merkle.manifest(docs_of([])).count() == 0


def test_directory_counts_what_lies_before(spark):
    rows = [("=a", i) for i in range(-3, 70_000, 7)] + [("", 5)]
    leaves = spark.createDataFrame(rows, "g string, id bigint").withColumns(
        {"word": F.expr("shiftright(id, 6)"), "bit": F.expr("cast(id & 63 as int)")}
    )
    found = {(r.g, r.word): r for r in merkle.popcount_directory(merkle.bitmap_words(leaves)).collect()}
    ids = sorted(i for g, i in rows if g)
    for r in found.values():
        if r.g:
            assert r.before == sum(i < r.word * 64 for i in ids) and r.n == bin(r.bits % 2**64).count("1")
    assert found["", 0].before == 0 and sum(r.n for r in found.values()) == len(rows)


def test_levels_are_exact_at_powers_of_two(spark):
    sizes = [1, 2, 3, *[2**k + d for k in range(2, 60) for d in (-1, 0, 1)]]
    stages = [merkle._levels(F.col("size"), stage).alias(str(stage)) for stage in range(8)]
    for r in spark.createDataFrame([(n,) for n in sizes], "size bigint").select("size", *stages).collect():
        assert sum(r[str(stage)] for stage in range(8)) == (r["size"] - 1).bit_length()
