"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is mapped to the number of set bits in each of 16
segments. Two fingerprints that differ in d bits differ by at most d in the
Manhattan distance of these counts, so fingerprints within two bits lie within
two steps on the grid of counts. The range join meets in the middle: each
distinct fingerprint enters its own cell and the cells one step away, any pair
within two steps shares a cell, and one of the shared cells is the one where the
pair counts. The join condition then compares all bits, so only true links
leave it; components of the links are the near-duplicate groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import connected_components
from riskloom.llm.text import fresh, whole
from riskloom.session import written

SEED = 42
SHINGLE = 3
MAX_DIFFERENCE = 2
SEGMENTS = 16
SEGMENT_BITS = 64 // SEGMENTS
COUNT_BITS = 3  # of a cell's key per segment; counts are 0..4
SUM_ROWS = 255  # bit rows that an 8-bit counter can add


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, lowest first."""
    sums = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), SUM_ROWS * 1024):
        bits = np.unpackbits(hashes[lo:lo + SUM_ROWS * 1024].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        even = len(bits) // SUM_ROWS * SUM_ROWS
        blocks = np.add.reduce(bits[:even].reshape(-1, SUM_ROWS, 64), axis=1, dtype=np.uint8)
        sums += blocks.sum(axis=0, dtype=np.int64) + np.add.reduce(bits[even:], axis=0, dtype=np.uint8)
    return sums


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of a UTF-8 text over its lower-cased (A-Z) word shingles, repeats included."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(found), seed)], np.uint64)
    else:
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(joined[i:j], seed) for i, j in zip(starts.tolist(), ends[shingle - 1:].tolist())], np.uint64
        )
    over = _bit_sums(hashes) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed long."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = whole(batch.column("text")).cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, fp bigint")


def links_within(distinct: DataFrame, most: int = MAX_DIFFERENCE) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column ``fp``) that differ in at most ``most`` <= 2 bits."""
    if not 0 <= most <= 2:
        raise ValueError("cells one step apart meet for differences of at most two bits")
    mask = (1 << SEGMENT_BITS) - 1
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", i * SEGMENT_BITS).bitwiseAND(F.lit(mask))).cast("long")
        for i in range(SEGMENTS)
    ]
    cell = sum((F.shiftleft(c, i * COUNT_BITS) for i, c in enumerate(counts)), F.lit(0).cast("long"))
    own = F.struct(cell.alias("cell"), F.lit(0).cast("byte").alias("step"))
    steps = [own]
    for i, c in enumerate(counts):
        unit = F.lit(1 << (i * COUNT_BITS))
        steps.append(F.when(c > 0, F.struct((cell - unit).alias("cell"), F.lit(-i - 1).cast("byte").alias("step"))))
        steps.append(F.when(c < SEGMENT_BITS, F.struct((cell + unit).alias("cell"), F.lit(i + 1).cast("byte").alias("step"))))
    spread = distinct.select("fp", F.explode(F.filter(F.array(*steps), lambda s: s.isNotNull())).alias("s")).select(
        "fp", "s.cell", "s.step"
    )
    a, b = spread.alias("a"), spread.alias("b")
    da, db = F.col("a.step"), F.col("b.step")
    # of all cells a pair shares, the one where it counts
    here = ((da == 0)) | ((da != 0) & (db != 0) & ((F.abs(da) < F.abs(db)) | (da == -db)))
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= most
    # the planner sizes an exploded side like its input, a thirtieth of it, and would broadcast it
    return a.join(b.hint("merge"), (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp")) & here & near).select(
        F.col("a.fp").alias("a"), F.col("b.fp").alias("b")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Documents whose fingerprints differ in at most two bits are linked;
    ``component_id`` is the smallest key reachable. A null, empty or blank text
    has fingerprint zero and is linked like any other; fewer words than a
    shingle are one shingle. Repeated rows come out repeated; a null key counts
    only where a component has no other. An empty table gives an empty result.
    Other columns are not read.
    """
    marked = written(fingerprints(docs, key, text), "fingerprints")  # texts are read once
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    members = connected_components(links_within(classes.select("fp")))
    labelled = written(classes.join(members, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    ), "fingerprint-components")
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, *marked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` of one document per component, that with the smallest key.

    ``marked`` is the result of ``near_duplicates`` for these rows, or several
    such results; with several, only a key that is the smallest in each of them
    stays. Of rows that repeat the key that stays, one stays.
    """
    name = fresh(docs, "__key")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    rows = reduce(DataFrame.unionByName, [
        m.select(F.col("doc_id").alias(name), *[(stays if i == k else F.lit(None).cast("boolean")).alias(f"__{i}") for i in range(len(marked))])
        for k, m in enumerate(marked)
    ])
    ids = rows.groupBy(name).agg(*[F.max(f"__{i}").alias(f"__{i}") for i in range(len(marked))], F.count("__0").alias("__n"))
    all_stay = reduce(Column.__and__, [F.col(f"__{i}") for i in range(len(marked))])
    odd = ids.select(name, all_stay.alias("__stays"), "__n").where("not __stays or __n > 1")
    # few ids go or repeat, so these sides are small beside the texts; they are worked out once
    odd = written(odd.select(name, "__stays"), "odd-keys")
    same = F.col(key).eqNullSafe(F.col(name))
    rest = docs.join(odd.drop("__stays"), same, "left_anti")
    repeated = docs.join(odd.where("__stays").drop("__stays"), same, "left_semi")
    return rest.unionByName(repeated.dropDuplicates([key]))
