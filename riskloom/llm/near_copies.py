"""Near copies by the Jaccard similarity of word shingles: MinHash bands for candidates, exact check of each.

Fingerprints a few bits apart find only the closest copies. Here each distinct
set of shingles enters 40 bands of five minima, so a pair of similarity 0.8
shares no band with a chance of 1.3e-7 and one of 0.9 practically never. Pairs
that earlier links already join are not compared. First all members of a band
are compared with its most central member, twice, so that a large group of
copies costs its size. What still lies apart is compared with each other in
bands of a few members. Members of larger bands meet through a prefix filter
instead: sets are sorted rarest shingle first, and two sets of the similarity
must share one of their first shingles at places that leave room for enough
overlap, so documents that share a common passage and little else do not meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import connected_components
from riskloom.llm.exact_dedup import BITMAP_BITS, BITS_PER_ROW, MAX_BITS, _bit
from riskloom.llm.text import mixed, whole
from riskloom.session import written

SEED = 42
SHINGLE = 5
LEAST = 0.8
BANDS = 40
MINIMA = 5  # of a band
STARS = 2  # rounds of comparing a band's members with one of them
FEW = 8  # members apart of a band that are compared with each other at once
RARITIES = 1 << 20  # counters of the order of shingles; any order gives the same links
BLOCK = 512  # shingles whose minima are taken at a time
_DRAWN = mixed(SEED, np.arange(BANDS * MINIMA))
_FACTORS = (_DRAWN >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
_OFFSETS = (_DRAWN & np.uint64(2**32 - 1)).astype(np.uint32)[:, None]


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a UTF-8 text's lower-cased (A-Z) word shingles; fewer words are one shingle."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    last = ends[min(shingle, len(found)) - 1:]
    return np.unique(np.array([digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), last.tolist())], np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """Least value of the set under each of the permutations; of an empty set the largest number."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * MINIMA, 2**32 - 1, np.uint32)
    for lo in range(0, len(low), BLOCK):
        np.minimum(least, (low[None, lo:lo + BLOCK] * _FACTORS + _OFFSETS).min(axis=1), out=least)
    return least


def _marked(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, node, size, bands, text) per row; ``node`` stands for the set, ``size`` is its number of shingles."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = whole(batch.column("text")).cast(pa.large_binary())
            nodes, sizes = [], np.empty(len(texts), np.int32)
            least = np.empty((len(texts), BANDS, MINIMA), np.uint32)
            for i, t in enumerate(texts):
                found = shingle_set(t.as_py(), shingle)
                nodes.append(xxhash.xxh3_128_hexdigest(found.tobytes(), SEED))
                sizes[i] = len(found)
                least[i] = minima(found).reshape(BANDS, MINIMA)
            bands = mixed(np.arange(BANDS)[None, :], *np.moveaxis(least, 2, 0)).view(np.int64)
            offsets = np.arange(0, bands.size + 1, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(nodes), pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel())), batch.column("text"),
                ],
                ["doc_id", "node", "size", "bands", "text"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, node string, size int, bands array<bigint>, text string")


def _sets(marked: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes) of the given nodes and of a few more."""
    bits = min(MAX_BITS, max(BITMAP_BITS, 2 ** ceil(log2(max(1, nodes.count() * BITS_PER_ROW)))))
    position = F.pmod(F.xxhash64("node"), F.lit(bits))
    bitmaps = written(
        nodes.groupBy(F.floor(position / BITMAP_BITS).alias("bucket")).agg(
            F.expr(f"bitmap_construct_agg(pmod(xxhash64(node), {bits}L) % {BITMAP_BITS})").alias("bitmap")
        ),
        "candidates",
    )
    # bounded by MAX_BITS; only texts of candidates shuffle, one per node and task
    asked = marked.withColumn("bucket", F.floor(position / BITMAP_BITS)).join(F.broadcast(bitmaps), "bucket")
    texts = asked.where(_bit(F.col("bitmap"), position)).groupBy("node").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = whole(batch.column("text")).cast(pa.large_binary())
            sets = [shingle_set(t.as_py(), shingle).tobytes() for t in found]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "hashes"])

    return written(texts.select("node", "text").mapInArrow(run, "node string, hashes binary"), "shingle-sets")


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity. ``a`` may be in many pairs: it is joined last."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = both >= least * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a string, b string")


def _alike(a: str, b: str, least: float):
    """Whether sizes allow the similarity."""
    return (F.col(a) >= F.col(b) * least) & (F.col(b) >= F.col(a) * least)


def _joined(members: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) over links and what is joined already; ``members`` stand for all links before."""
    if members is not None:
        links = links.select("a", "b").unionByName(members.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return written(connected_components(links), "star-components")


def _placed(crowded: DataFrame, members: DataFrame) -> DataFrame:
    """The members of bands that are not of one component yet, with their component."""
    placed = written(
        crowded.join(members, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed"
    )
    ends = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return written(placed.join(ends.select("band"), "band"), "apart")


def _centres(apart: DataFrame, before: DataFrame | None) -> DataFrame:
    """Of every band the most central member, other than those centres before."""
    rows = apart if before is None else apart.join(before.select("band", "node"), ["band", "node"], "left_anti")
    best = rows.groupBy("band").agg(F.max(F.struct("central", "node", "size", "component")).alias("c"))
    return written(best.select("band", "c.node", "c.size", "c.component"), "band-centres")


def _spokes(apart: DataFrame, centres: DataFrame, least: float) -> DataFrame:
    c = centres.select("band", F.col("node").alias("a"), F.col("size").alias("s"), F.col("component").alias("ca"))
    found = apart.join(c, "band").where((F.col("component") != F.col("ca")) & _alike("size", "s", least))
    return found.select("a", F.col("node").alias("b")).distinct()


def _without(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs that were not compared before, in either order."""
    both = tried.select(F.least("a", "b").alias("a_"), F.greatest("a", "b").alias("b_")).distinct()
    same = (F.least("a", "b") == F.col("a_")) & (F.greatest("a", "b") == F.col("b_"))
    return pairs.join(both, same, "left_anti")


def _rarities(members: DataFrame) -> np.ndarray:
    """For each counter the number of binary digits of the count of shingles that fall to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(RARITIES, np.int64)
        for batch in batches:
            for x in batch.column("hashes"):
                counts += np.bincount((np.frombuffer(x.as_py(), np.uint64) % np.uint64(RARITIES)).astype(np.int64), minlength=RARITIES)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    counted = members.select("hashes").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    levels = counted.select("at", F.length(F.bin("n")).cast("byte").alias("level")).toArrow()  # at most RARITIES rows
    out = np.zeros(RARITIES, np.int8)
    out[levels.column("at").to_numpy()] = levels.column("level").to_numpy()
    return out


def prefix_lengths(size: int, least: float) -> tuple[int, int]:
    """How many first shingles a set must show to longer sets, and how many to shorter ones."""
    return size - ceil(2 * least / (1 + least) * size - 1e-9) + 1, size - ceil(least * size - 1e-9) + 1


def prefix_pairs(members: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of members (node, size, component, hashes) of different components that can have the similarity.

    An exact prefix filter: sets ordered alike, rarest shingle first, reach the
    similarity only if they share a shingle of their prefixes, and at the first
    one that they share what is left of each must hold the rest of the overlap.
    """
    levels = members.sparkSession.sparkContext.broadcast(_rarities(members))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in enumerate(batch.column("hashes")):
                found = np.frombuffer(x.as_py(), np.uint64)
                to_longer, to_shorter = prefix_lengths(len(found), least)
                rarity = levels.value[(found % np.uint64(RARITIES)).astype(np.int64)]
                first = found[np.lexsort((found, rarity))][:to_shorter].view(np.int64)
                same = pa.array([i] * len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), pa.array(np.arange(len(first), dtype=np.int32)), pa.array(np.arange(len(first)) < to_longer),
                     *[batch.column(c).take(same) for c in ("node", "size", "component")]],
                    ["shingle", "place", "early", "node", "size", "component"],
                )

    kinds = "shingle bigint, place int, early boolean, node string, size int, component string"
    rows = written(members.select("node", "size", "component", "hashes").mapInArrow(run, kinds), "prefixes")
    x = rows.where("early").select("shingle", *[F.col(c).alias(f"{c}_x") for c in ("place", "node", "size", "component")])
    y = rows.select("shingle", *[F.col(c).alias(f"{c}_y") for c in ("place", "node", "size", "component")])
    ordered = (F.col("size_x") < F.col("size_y")) | ((F.col("size_x") == F.col("size_y")) & (F.col("node_x") < F.col("node_y")))
    room = F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y"))
    enough = room >= F.lit(least / (1 + least)) * (F.col("size_x") + F.col("size_y")) - 1e-6
    met = x.join(y, "shingle").where(
        ordered & (F.col("component_x") != F.col("component_y")) & _alike("size_x", "size_y", least) & enough
    )
    return met.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def _rest(apart: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs to compare of the members still apart: in bands of a few each with each, else by the prefix filter."""
    counted = written(apart.groupBy("band").agg(F.count("*").alias("members")), "apart-bands")
    few = apart.join(counted.where(f"members <= {FEW}"), "band")
    p = few.select("band", F.col("node").alias("a"), F.col("size").alias("s"), F.col("component").alias("ca"))
    q = few.select("band", F.col("node").alias("b"), F.col("size").alias("t"), F.col("component").alias("cb"))
    pairs = p.join(q, "band").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _alike("s", "t", least))
    many = apart.join(counted.where(f"members > {FEW}").select("band"), "band", "left_semi").select("node", "size", "component")
    members = written(many.distinct().join(sets, "node"), "prefix-members")
    return pairs.select("a", "b").unionByName(prefix_pairs(members, least)).distinct()


def near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: float = LEAST
) -> DataFrame:
    """One row per document: doc_id, component_id, the smallest key reachable over links of similarity ``least``.

    Linked are documents whose sets of ``shingle`` words have a Jaccard similarity
    of at least ``least``; the bands are made for 0.8 and more. Null, empty and
    blank texts are copies of each other. Rows and keys are treated as in
    ``simhash.near_duplicates``.
    """
    if not LEAST <= least <= 1:
        raise ValueError(f"the bands find similarities of {LEAST} and more")
    marked = written(_marked(docs, key, text, shingle), "shingled")  # texts are hashed once
    distinct = marked.groupBy("node").agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("size", "bands")])
    classes = written(distinct, "shingle-classes")
    rows = classes.select("node", "size", F.explode("bands").alias("band"))
    counted = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = written(rows.join(written(counted, "crowded-bands"), "band"), "band-members")
    central = written(members.groupBy("node").agg(F.sum("n").alias("central")), "band-nodes")
    sets = _sets(marked, central.select("node"), shingle)
    crowded = written(members.join(central, "node").drop("n"), "band-ranks")

    apart, joined, tried, centres = crowded.withColumn("component", F.col("node")), None, None, None
    for _ in range(STARS):
        centres = _centres(apart, centres)
        spokes = _spokes(apart, centres, least)
        spokes = written(spokes if tried is None else _without(spokes, tried), "spokes")
        tried = spokes if tried is None else tried.unionByName(spokes)
        joined = _joined(joined, _similar(spokes, sets, least))
        apart = _placed(crowded, joined)
    rest = written(_without(_rest(apart, sets, least), tried), "rest")
    joined = _joined(joined, _similar(rest, sets, least))
    labelled = written(classes.join(joined, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component")
    ), "copy-components")
    named = labelled.join(labelled.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    return marked.select("doc_id", "node").join(named.select("node", "component_id"), "node").select("doc_id", "component_id")
