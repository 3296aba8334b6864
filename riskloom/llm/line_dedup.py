"""Line deduplication over the whole corpus, returning keep bitmaps instead of text.

Every line becomes a 128-bit hash of its key with its document and position.
Lines are range-partitioned by hash and document and sorted by hash, document
and position, so that a task streams the occurrences of a line in order, and a
line that fills many tasks is split between them. A task decides the lines that
lie wholly inside it; the lines at its two borders, at most two per task, are
decided by the sum of their parts. What leaves is a compressed bitmap per
document that loses lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import SPACE, fresh, whole
from riskloom.session import scratch_path

MIN_DOCUMENTS = 10
MIN_LENGTH = 1
DROP, BORDER, PART = 0, 1, 2  # a line to drop, a line of a border run, the size of a border run
_BLANK = SPACE.encode()
_ROW = np.dtype([("hi", "i8"), ("lo", "i8"), ("k", "i8"), ("t", "i8"), ("pos", "i8"), ("n_lines", "i8")])
_SCHEMA = "kind int, docs bigint, " + ", ".join(f"{n} bigint" for n in _ROW.names)


def document_key(key: str, text: str) -> tuple[Column, Column]:
    """A document is a key with a text: rows that repeat both are one document."""
    return F.xxhash64(F.col(key)).alias("k"), F.xxhash64(F.col(text)).alias("t")


def line_hashes(docs: DataFrame, key: str, text: str, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per line whose key has ``min_length`` code points: hash, document, position, lines of the document."""
    source = docs.select(*document_key(key, text), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks = batch.column("k").to_numpy(zero_copy_only=False)
            ts = batch.column("t").to_numpy(zero_copy_only=False)
            hashes, owner, positions, totals = [], [], [], []
            for i, text in enumerate(whole(batch.column("text")).cast(pa.large_binary())):
                lines = [line.strip(_BLANK) for line in text.as_py().lower().split(b"\n")]
                for j, line in enumerate(lines):
                    if line and (min_length <= 1 or len(line.decode()) >= min_length):
                        hashes.append(xxhash.xxh3_128_digest(line))
                        owner.append(i)
                        positions.append(j)
                        totals.append(len(lines))
            halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            owner = np.array(owner, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ks[owner]), pa.array(ts[owner]),
                 pa.array(np.array(positions, np.int64)), pa.array(np.array(totals, np.int64))],
                list(_ROW.names),
            )

    return source.mapInArrow(run, ", ".join(f"{n} bigint" for n in _ROW.names))


def _stream(min_docs: int, keep_first: bool):
    """Decide a task's lines in one pass over its sorted rows."""

    def emit(rows: np.ndarray, kind: int, docs: int = 0) -> pa.RecordBatch:
        columns = [pa.array(np.full(len(rows), kind, np.int32)), pa.array(np.full(len(rows), docs, np.int64))]
        columns += [pa.array(np.ascontiguousarray(rows[n])) for n in _ROW.names]
        return pa.RecordBatch.from_arrays(columns, ["kind", "docs", *_ROW.names])

    def changes(rows: np.ndarray, names: tuple) -> np.ndarray:
        flags = np.zeros(len(rows), bool)
        flags[0] = True
        for n in names:
            flags[1:] |= rows[n][1:] != rows[n][:-1]
        return flags

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, _ROW)  # rows of the open run that are not decided, of less than min_docs documents
        open_run = last = None  # first row and last row of the open run
        count, is_first, runs = 0, True, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.empty(batch.num_rows, _ROW)
            for n in _ROW.names:
                rows[n] = batch.column(n).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(changes(rows, ("hi", "lo")))
            new_doc = changes(rows, ("hi", "lo", "k", "t"))
            for start, end in zip(heads.tolist(), [*heads[1:].tolist(), len(rows)]):
                part = rows[start:end]
                added = int(np.count_nonzero(new_doc[start:end]))
                if open_run is not None and (open_run["hi"], open_run["lo"]) == (part[0]["hi"], part[0]["lo"]):
                    added -= (last["k"], last["t"]) == (part[0]["k"], part[0]["t"]) and bool(new_doc[start])
                else:
                    if open_run is not None and runs == 1:
                        yield emit(open_run.reshape(1), PART, count)
                    held, open_run, count = np.empty(0, _ROW), part[0].copy(), 0
                    runs += 1
                count += int(added)
                last = part[-1].copy()
                if runs == 1:
                    yield emit(part, BORDER)
                    continue
                held = part if not len(held) else np.concatenate([held, part])
                if count >= min_docs:
                    if keep_first and held[0] == open_run:
                        held = held[1:]
                    yield emit(held, DROP)
                    held = np.empty(0, _ROW)
        if open_run is not None:
            yield emit(open_run.reshape(1), PART, count)
            if len(held) and runs > 1:
                yield emit(held, BORDER)

    return run


def keep_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCUMENTS,
    min_length: int = MIN_LENGTH, keep_first: bool = False,
) -> DataFrame:
    """(k, t, keep): compressed bitmaps of the lines that stay, for documents that lose a line.

    ``keep`` is a zlib-compressed bit per line, first line in the lowest bit. A
    line found in ``min_docs`` documents goes from all of them, or from all but
    its first occurrence in hash order of documents with ``keep_first``.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "line-hashes")
    line_hashes(docs, key, text, min_length).write.parquet(path)  # texts are split once
    ordered = (
        spark.read.parquet(path)
        .repartitionByRange("hi", "lo", "k", "t").sortWithinPartitions("hi", "lo", "k", "t", "pos")
    )
    path = scratch_path(spark, "repeated-lines")
    ordered.mapInArrow(_stream(min_docs, keep_first), _SCHEMA).write.parquet(path)
    decided = spark.read.parquet(path)
    totals = (
        decided.where(F.col("kind") == PART).groupBy("hi", "lo")
        .agg(F.sum("docs").alias("total"), F.min(F.struct("k", "t", "pos")).alias("first"))
        .where(F.col("total") >= min_docs)
    )
    # at most two border runs per task of the range exchange
    border = decided.where(F.col("kind") == BORDER).join(F.broadcast(totals), ["hi", "lo"])
    if keep_first:
        border = border.where(F.struct("k", "t", "pos") != F.col("first"))
    dropped = decided.where(F.col("kind") == DROP).select("k", "t", "pos", "n_lines").unionByName(
        border.select("k", "t", "pos", "n_lines")
    )
    grouped = dropped.groupBy("k", "t").agg(F.max("n_lines").alias("n_lines"), F.collect_list("pos").alias("gone"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bitmaps = []
            for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone")):
                keep = np.ones(n, np.uint8)
                keep[gone.values.to_numpy()] = 0
                bitmaps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("t"), pa.array(bitmaps, pa.binary())], ["k", "t", "keep"]
            )

    return grouped.mapInArrow(pack, "k bigint, t bigint, keep binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their text cut to the kept lines, plus ``n_lines`` and ``n_dropped``."""
    names = [fresh(docs, n) for n in ("n_lines", "n_dropped")]
    others = [c for c in docs.columns if c != text]
    k, t, of_k, of_t, keep = (fresh(docs, n) for n in ("__k", "__t", "__of_k", "__of_t", "__keep"))
    marked = docs.withColumns(dict(zip((k, t), document_key(key, text))))
    named = bitmaps.select(F.col("k").alias(of_k), F.col("t").alias(of_t), F.col("keep").alias(keep))
    # a task's bitmaps are a few bytes per document, so the texts need no sort
    joined = marked.join(named.hint("shuffle_hash"), (F.col(k) == F.col(of_k)) & (F.col(t) == F.col(of_t)), "left")
    source = joined.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"), F.col(text).alias("text"),
        F.col(keep).alias("keep"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, n_lines, n_dropped = [], [], []
            for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
                if keep is None:
                    out.append(text or "")
                    n_lines.append((text or "").count("\n") + 1)
                    n_dropped.append(0)
                    continue
                lines = (text or "").split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines), bitorder="little")
                kept = [line for line, bit in zip(lines, bits.tolist()) if bit]
                out.append("\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(out, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())],
                ["row", "text", "n_lines", "n_dropped"],
            )

    row_type = source.schema["row"].dataType.simpleString()
    done = source.mapInArrow(run, f"row {row_type}, text string, n_lines bigint, n_dropped bigint")
    columns = [F.col("text").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return done.select(*columns, F.col("n_lines").alias(names[0]), F.col("n_dropped").alias(names[1]))


def drop_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCUMENTS,
    min_length: int = MIN_LENGTH, keep_first: bool = False,
) -> DataFrame:
    """The rows without the lines that ``min_docs`` documents share, plus ``n_lines`` and ``n_dropped``.

    Lines are compared by their key: white space stripped at both ends, A-Z
    lower-cased; blank lines are never dropped. A null or empty text is one
    empty line and comes out empty; so does a text that loses all lines. Rows
    that repeat key and text are one document. An empty table stays empty;
    other columns are kept, and new ones get underscores where names clash.
    """
    return apply_bitmaps(docs, keep_bitmaps(docs, key, text, min_docs, min_length, keep_first), key, text)
