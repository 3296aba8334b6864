"""Merkle manifest of a dataset by bitmap ranks.

A leaf's place among its group is a rank query, not a sort: ids are kept as
bitmaps, one row per group and non-empty word of 64 ids, merged by a bitwise or
that combines before its exchange. A directory holds the popcounts before each
chunk of words and each word, so a leaf's place is the directory's count plus
the popcount of its word below its bit. Places are then cut into blocks of 256
slots. Each block is filled as an array keyed by slot and reduced by eight
levels at once; the blocks' nodes are the leaves of the next blocks, until one
node of a group remains. Groups' nodes form one more tree. Proofs go back down
the same blocks: a block knows the siblings above it and adds those inside.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import running_totals, stored_slices
from riskloom.session import scratch_path

BLOCK_BITS = 8
WORD_BITS = 6
CHUNK_BITS = 9  # words of a chunk: 512, or 32,768 ids
NULL_WORD = -(2**57) - 1  # before the words of all ids
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ALONE, RIGHT, LEFT = 0, 1, 2  # whether a node has a sibling, and on which side


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"merkle-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_hash(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _leaves(docs: DataFrame, key: str, group: str, fields: tuple[str, ...], altered: str, tampers: Column) -> DataFrame:
    """(g, id, word, bit, leaf, tampered) per row; ``g`` orders groups by bytes, null first, and joins nulls."""
    columns = {f: F.col(f"`{f}`") for f in fields}
    changed = columns | {altered: columns[altered].cast("decimal(20,0)") + 1}
    at = columns[group].cast("string")
    number = F.col(f"`{key}`").cast("long")
    return docs.select(
        F.when(at.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), at)).alias("g"),
        number.alias("id"),
        F.coalesce(F.shiftright(number, WORD_BITS), F.lit(NULL_WORD)).alias("word"),
        F.coalesce(number.bitwiseAND(2**WORD_BITS - 1), F.lit(0)).cast("int").alias("bit"),
        leaf_hash([columns[f] for f in fields]).alias("leaf"),
        F.when(tampers, leaf_hash([changed[f] for f in fields])).alias("tampered"),
    )


def bitmap_words(leaves: DataFrame) -> DataFrame:
    """(g, word, bits, n): the non-empty words of every group's bitmap and the rows behind each."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    return leaves.groupBy("g", "word").agg(F.bit_or(one).alias("bits"), F.count("*").alias("n"))


def popcount_directory(words: DataFrame) -> DataFrame:
    """``words`` with ``before``, the rows of the group in all words below: counts before the chunk and inside it."""
    chunk = F.shiftright("word", CHUNK_BITS)
    chunks = words.groupBy("g", chunk.alias("chunk")).agg(
        F.sum("n").alias("n"),
        # at most 512 entries
        F.sort_array(F.collect_list(F.struct("word", "bits", "n"))).alias("words"),
    )
    stored = stored_slices(chunks, "g", "chunk")
    based = running_totals(stored, "g", "chunk", ["n"]).select("g", (F.col("cum_n") - F.col("n")).alias("base"), "words")
    sums = F.aggregate(
        "words", F.array(F.col("base")),
        lambda sums, w: F.concat(sums, F.array(F.element_at(sums, -1) + w["n"])),
    )
    placed = based.select("g", "words", sums.alias("sums")).select("g", F.explode(F.arrays_zip("words", "sums")).alias("e"))
    return placed.where("e.words is not null").select("g", "e.words.*", F.col("e.sums").alias("before"))


def _below(bits: Column, bit: Column) -> Column:
    """Popcount of the bits below ``bit``."""
    return F.bit_count(bits.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))))


def _ranked(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with their place ``pos`` in the group (ids ascending, null first, ties by leaf), and group sizes."""
    words = _written(popcount_directory(bitmap_words(leaves)), "words")
    sizes = _written(words.groupBy("g").agg(F.sum("n").alias("size")), "sizes")
    thin = ["g", "id", "word", "bit", "leaf", "tampered"]
    crowded = words.where(F.col("n") > F.bit_count("bits")).select("g", "word")
    if crowded.isEmpty():
        found = leaves.join(words.select("g", "word", "bits", "before"), ["g", "word"])
        return found.withColumn("pos", F.col("before") + _below(F.col("bits"), F.col("bit"))), sizes

    # ids of several rows: their further rows shift what follows in the word
    counted = leaves.join(crowded, ["g", "word"], "left_semi").groupBy("g", "word", "bit").agg(F.count("*").alias("n"))
    repeated = _written(counted.where("n > 1"), "repeated")
    extra = repeated.groupBy("g", "word").agg(F.collect_list(F.struct("bit", "n")).alias("extra"))  # at most 64 entries
    weighted = _written(words.select("g", "word", "bits", "before").join(extra, ["g", "word"], "left"), "weighted")
    single = leaves.join(repeated, ["g", "word", "bit"], "left_anti").select(*thin, F.lit(0).cast("long").alias("tie"))
    entries = leaves.join(repeated.drop("n"), ["g", "word", "bit"], "left_semi").groupBy(*thin).agg(F.count("*").alias("n"))
    same = F.concat_ws(":", F.col("word"), F.col("bit"), F.col("g"))
    runs = running_totals(stored_slices(entries.withColumn("same", same), "same", "leaf"), "same", "leaf", ["n"])
    ties = runs.select(*thin, F.explode(F.expr("sequence(cum_n - n, cum_n - 1)")).alias("tie"))
    shift = F.aggregate(
        F.filter("extra", lambda e: e["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda a, e: a + e["n"] - 1
    )
    found = single.unionByName(ties).join(weighted, ["g", "word"])
    pos = F.col("before") + _below(F.col("bits"), F.col("bit")) + F.coalesce(shift, F.lit(0)) + F.col("tie")
    return found.withColumn("pos", pos), sizes


def node(children: list[bytes]) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


def _tree(slots: list[bytes], levels: int) -> list[list[bytes]]:
    rows = [slots]
    for _ in range(levels):
        last = rows[-1]
        rows.append([node(last[i:i + 2]) for i in range(0, len(last), 2)])
    return rows


def _siblings(rows: list[list[bytes]], slot: int) -> list[tuple[int, bytes]]:
    """(side, hash) on each level above a slot."""
    path = []
    for row in rows[:-1]:
        other = slot ^ 1
        path.append((ALONE, b"") if other >= len(row) else (LEFT if other < slot else RIGHT, row[other]))
        slot >>= 1
    return path


def _packed(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side]) + sibling for side, sibling in path)


def _unpacked(data: bytes) -> list[tuple[int, bytes]]:
    path, i = [], 0
    while i < len(data):
        side = data[i]
        end = i + 1 + 32 * (side != ALONE)
        path.append((side, data[i + 1:end]))
        i = end
    return path


def _folded(start: bytes, path: list[tuple[int, bytes]]) -> bytes:
    for side, sibling in path:
        start = node([start] if side == ALONE else [start, sibling] if side == RIGHT else [sibling, start])
    return start


def _split(data: bytes) -> list[bytes]:
    return [data[i:i + 32] for i in range(0, len(data), 32)]


def _levels(size: Column, stage: int) -> Column:
    """Levels that a stage of blocks reduces in a tree of ``size`` leaves: what is left, at most 8."""
    depth = F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0)  # binary digits of the last place
    return F.greatest(F.lit(0), F.least(F.lit(BLOCK_BITS), depth - BLOCK_BITS * stage))


def _block_table(nodes: DataFrame, sizes: DataFrame, stage: int) -> DataFrame:
    """One row per block of a stage: slot arrays (hashes, ids, tampered leaves), levels reduced and the node they give."""
    keyed = nodes.groupBy("g", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(
        F.collect_list(F.struct(F.col("pos").bitwiseAND(2**BLOCK_BITS - 1).cast("int").alias("slot"), "hash", "id", "tampered")).alias("slots")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids, tampered, made = [], [], [], []
            for slots, levels in zip(batch.column("slots").to_pylist(), batch.column("levels").to_pylist()):
                held: list = [None] * len(slots)
                for s in slots:
                    held[s["slot"]] = s
                leaves = [s["hash"] for s in held]
                hashes.append(b"".join(leaves))
                ids.append([s["id"] for s in held])
                tampered.append([s["tampered"] for s in held])
                made.append(_tree(leaves, levels)[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("g"), batch.column("block"), batch.column("levels"), pa.array(hashes, pa.binary()),
                 pa.array(ids, pa.list_(pa.int64())), pa.array(tampered, pa.list_(pa.binary())), pa.array(made, pa.binary())],
                ["g", "block", "levels", "hashes", "ids", "tampered", "hash"],
            )

    ready = keyed.join(sizes.select("g", _levels(F.col("size"), stage).alias("levels")), "g")
    return _written(
        ready.select("g", "block", "levels", "slots").mapInArrow(
            run, "g string, block bigint, levels int, hashes binary, ids array<bigint>, tampered array<binary>, hash binary"
        ),
        f"blocks-{stage}",
    )


def _reduced(nodes: DataFrame, sizes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The block tables of all stages from the leaves up, and (g, hash) of every group's last node."""
    largest = sizes.agg(F.max("size")).first()[0] or 0
    tables, tops, stage = [], [], 0
    while True:
        tables.append(_block_table(nodes, sizes, stage))
        ended = sizes.where((F.col("size") <= 2 ** (BLOCK_BITS * (stage + 1))) & (F.col("size") > (2 ** (BLOCK_BITS * stage) if stage else 0)))
        tops.append(tables[-1].join(ended.select("g"), "g", "left_semi").select("g", "hash"))
        stage += 1
        if largest <= 2 ** (BLOCK_BITS * stage):
            return tables, reduce(DataFrame.unionByName, tops)
        going = sizes.where(F.col("size") > 2 ** (BLOCK_BITS * stage))
        nodes = tables[-1].join(going.select("g"), "g", "left_semi").select(
            "g", F.col("block").alias("pos"), "hash", F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("tampered")
        )


def _descended(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """The blocks of leaves with the packed ``path`` above each; ``above`` has g, path and what stays with the group."""
    rest = [c for c in above.columns if c not in ("g", "path")]
    kept = ", ".join(f"{c} {above.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (block, levels, hashes, path) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "levels", "hashes", "path")))):
                slots = _split(hashes)
                rows = _tree(slots, levels)
                paths = [_packed(_siblings(rows, s)) + path for s in range(len(slots))]
                same = pa.array([i] * len(slots))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("g").take(same), pa.array([(block << BLOCK_BITS) + s for s in range(len(slots))], pa.int64()),
                     pa.array(paths, pa.binary()), *[batch.column(c).take(same) for c in rest]],
                    ["g", "block", "path", *rest],
                )

    # every group's one block of its last stage gets the group's own path, lower blocks theirs from the stage above
    paths = above.withColumn("block", F.lit(0).cast("long"))
    for stage in range(len(tables) - 1, 0, -1):
        here = tables[stage].join(paths, ["g", "block"]).select("g", "block", "levels", "hashes", "path", *rest)
        found = here.mapInArrow(run, f"g string, block bigint, path binary{', ' if rest else ''}{kept}")
        reached = tables[stage].select("g").distinct()
        paths = _written(found.unionByName(paths.join(reached, "g", "left_anti").select(*found.columns)), "paths")
    return tables[0].join(paths, ["g", "block"])


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, altered: str = "n_chars",
    tampers: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes the row's ``fields``. Leaves of a group ascend by key, a null
    key first; rows of one key ascend by leaf, and equal rows are leaves each.
    Every two neighbours become one node, a last single one too, until one
    remains, the subroot; subroots ascend by group, null first, and give the
    root. ``proof_sha256`` hashes the siblings on the way up. Where ``tampers``
    holds, the folded root starts from a leaf whose ``altered`` field is one
    larger (a null stays null). Null fields differ from empty ones. An empty
    table gives no rows; further columns are not read.
    """
    if tampers is None:
        tampers = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 7 == 0
    leaves = _written(_leaves(docs, key, group, fields, altered, tampers), "leaves")  # texts are hashed once
    ranked, sizes = _ranked(leaves)
    tables, subroots = _reduced(ranked.select("g", "pos", F.col("leaf").alias("hash"), "id", "tampered"), sizes)
    subroots = _written(subroots, "subroots")

    # the tree of the groups: one row each, placed by a running count
    counted = running_totals(stored_slices(subroots.select(F.lit("").alias("one"), "g", F.lit(1).cast("long").alias("n")), "one", "g"), "one", "g", ["n"])
    places = _written(counted.select("g", (F.col("cum_n") - 1).alias("pos")), "places")
    upper = subroots.join(places, "g").select(F.lit("").alias("g"), "pos", "hash", F.col("pos").alias("id"), F.lit(None).cast("binary").alias("tampered"))
    count = _written(places.agg(F.count("*").alias("size")).select(F.lit("").alias("g"), "size").where("size > 0"), "groups")
    upper_tables, root = _reduced(upper, count)
    root = _written(root.select("g", F.col("hash").alias("root"), F.lit("").cast("binary").alias("path")), "root")
    group_paths = _written(_slots(_descended(upper_tables, root)), "group-paths")
    above = places.join(subroots.withColumnRenamed("hash", "subroot"), "g").join(
        group_paths.select(F.col("id").alias("pos"), "path", "root"), "pos"
    ).select("g", "path", "subroot", "root")
    return _proofs(_descended(tables, _written(above, "above")))


def _slots(blocks: DataFrame) -> DataFrame:
    """(id, path, root) of every slot of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, levels, hashes, path, root in zip(*(batch.column(c).to_pylist() for c in ("ids", "levels", "hashes", "path", "root"))):
                slots = _split(hashes)
                rows = _tree(slots, levels)
                paths = [_packed(_siblings(rows, s)) + path for s in range(len(slots))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(paths, pa.binary()), pa.array([root] * len(slots), pa.binary())],
                    ["id", "path", "root"],
                )

    return blocks.select("ids", "levels", "hashes", "path", "root").mapInArrow(run, "id bigint, path binary, root binary")


def _proofs(blocks: DataFrame) -> DataFrame:
    """The manifest's rows of every slot of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = ("ids", "tampered", "levels", "hashes", "path", "subroot", "root")
            for ids, tampered, levels, hashes, path, subroot, root in zip(*(batch.column(c).to_pylist() for c in columns)):
                slots = _split(hashes)
                rows = _tree(slots, levels)
                above = _unpacked(path)
                upper = "".join(sibling.hex() for _, sibling in above).encode()
                ends: dict[bytes, bytes] = {}  # of the nodes that blocks fold to, the root that these fold to
                proofs, folded = [], []
                for s, (leaf, changed) in enumerate(zip(slots, tampered)):
                    inside = _siblings(rows, s)
                    proofs.append(sha256("".join(sibling.hex() for _, sibling in inside).encode() + upper).hexdigest())
                    at = _folded(leaf if changed is None else changed, inside)
                    if at not in ends:
                        ends[at] = _folded(at, above)
                    folded.append(ends[at])
                n = len(slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([s.hex() for s in slots]), pa.array([subroot.hex()] * n),
                     pa.array([root.hex()] * n), pa.array(proofs), pa.array([f.hex() for f in folded]),
                     pa.array([f == root for f in folded])],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return blocks.select("ids", "tampered", "levels", "hashes", "path", "subroot", "root").mapInArrow(
        run,
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
