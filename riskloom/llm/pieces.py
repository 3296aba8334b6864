"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text becomes a lattice: nodes are character positions, edges are vocabulary
pieces. Forward filtering sums, for every position, the weights of all ways to
reach it; backward sampling then walks from the end, choosing each piece with
its share of the sum, which draws a whole segmentation in proportion to its
weight. No piece crosses from a word into the space before the next, so the
lattice falls apart into words; each distinct word of a block of text is
filtered once and sampled for every occurrence. Random numbers are hashed from
seed, row key and place in the text, so a rerun gives the same pieces.

The vocabulary is a given SentencePiece model; nothing is trained. A merge
model has ranks in place of probabilities, so a piece of rank r weighs
(r + 2.7)^-smoothing (Zipf and Mandelbrot's law).
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import fresh, mixed, uniform

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # fixed value: stands for a space in pieces
BREAKS = "\n\t\x00"  # characters that no piece holds beside others
UNITS = re.compile(rf" *[^ {BREAKS}]+| +|[{BREAKS}]")
BLOCK_UNITS = 250_000  # words filtered and sampled at a time, which bounds memory
STORE_EDGES = 16_000_000  # of the words a worker keeps, about 250 MB at most
LONG_UNIT = 100_000  # characters; a longer word is filtered alone, this many positions at a time
SMOOTHING = 0.5


@dataclass
class Vocabulary:
    """Pieces with spaces in place of marks, their weights, and the pieces of single bytes."""

    ids: list[int]
    texts: list[str]
    weights: list[float]
    byte_ids: list[int]
    size: int
    _trie: object = field(default=None, repr=False)

    @classmethod
    def load(cls, model_file: str = DEFAULT_MODEL, smoothing: float = SMOOTHING) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        byte_ids = {model.id_to_piece(i): i for i in range(size) if model.is_byte(i)}
        ids = [
            i for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        texts = [model.id_to_piece(i).replace(MARK, " ") for i in ids]
        bad = [t for t in texts if re.search(r"[^ ] ", t) or (len(t) > 1 and re.search(f"[{BREAKS}]", t))]
        if bad or len(byte_ids) != 256:
            raise ValueError(f"pieces must end before a space, and all bytes must have one: {bad[:3]}")
        ranks = np.arange(len(ids), dtype=np.float64)
        weights = (-smoothing * np.log(ranks + 2.7)).tolist()
        return cls(ids, texts, weights, [byte_ids[f"<0x{b:02X}>"] for b in range(256)], size)

    def __getstate__(self):
        return self.__dict__ | {"_trie": None}

    def __post_init__(self):
        self.table = np.array(self.ids, np.int64), np.array(self.weights)
        if max(map(len, self.texts)) >= 64:
            raise ValueError("pieces of 64 and more characters are not supported")

    def trie(self):
        if self._trie is None:
            trie = ahocorasick.Automaton()
            for i, text in enumerate(self.texts):
                trie.add_word(text, i * 64 + len(text))  # length in the low bits
            trie.make_automaton()
            self._trie = trie
        return self._trie

    def decoder(self) -> list[bytes]:
        table = [b""] * self.size
        for i, text in zip(self.ids, self.texts):
            table[i] = text.encode()
        for b, i in enumerate(self.byte_ids):
            table[i] = bytes([b])
        return table


def units(text: str) -> list[str]:
    """The text, with a space put in front, cut where no piece can cross."""
    return UNITS.findall(" " + text) if text else []


def _edges(vocabulary: Vocabulary, unit: str, low: int, high: int) -> list[list[tuple[int, int, float]]]:
    """(start, piece, weight) of the pieces that end at each position after ``low`` up to ``high``, longest first."""
    ids, gains = vocabulary.table
    base = max(0, low - 63)  # no piece has 64 characters
    found: list[list[tuple[int, int, float]]] = [[] for _ in range(high - low)]
    for last, value in vocabulary.trie().iter(unit[base:high]):
        end, piece = base + last + 1, value // 64
        if end > low:
            found[end - low - 1].append((end - value % 64, int(ids[piece]), float(gains[piece])))
    unknown = float(gains.min()) - 1.0
    for k, edges in enumerate(found):
        end = low + k + 1
        if not edges or edges[-1][0] != end - 1:  # a character without a piece becomes its bytes
            edges.append((end - 1, vocabulary.size + ord(unit[end - 1]), unknown))
    return found


def sample_long(vocabulary: Vocabulary, unit: str, stream: int, block: int) -> np.ndarray:
    """Pieces of one long word, as ``lattice`` and ``_sample_short`` would give, some positions at a time.

    Forward values are kept for all positions, one number each; edges only for
    one block, found once on the way there and once on the way back.
    """
    n = len(unit)
    forward = array("d", bytes(8 * (n + 1)))
    for low in range(0, n, block):
        high = min(n, low + block)
        for k, edges in enumerate(_edges(vocabulary, unit, low, high)):
            values = [forward[start] + gain for start, _, gain in edges]
            top = max(values)
            forward[low + k + 1] = top + math.log(sum(math.exp(v - top) for v in values))
    chosen, at, step, drawn = [], n, 0, iter(())
    for low in range((n - 1) // block * block, -1, -block):
        found = _edges(vocabulary, unit, low, min(n, low + block))
        while at > low:
            u = next(drawn, None)
            if u is None:
                drawn = iter(uniform(stream, np.arange(step, step + 4096)).tolist())
                u = next(drawn)
            so_far = 0.0
            for start, piece, gain in found[at - low - 1]:
                so_far += math.exp(forward[start] + gain - forward[at])
                if so_far > u:
                    break
            chosen.append(piece)
            at, step = start, step + 1
    return np.array(chosen[::-1], np.int64)


def lattice(vocabulary: Vocabulary, distinct: list[str]):
    """Forward-filtered lattice of distinct words.

    Positions of all words lie in one array, word after word. Returns each
    word's first position and length; per edge, in order of its end position
    and longest first, its start, piece and running share of its end's sum; and
    per position its first edge.
    """
    lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
    firsts = np.zeros(len(distinct), np.int64)
    np.cumsum(lengths[:-1] + 1, out=firsts[1:])
    n = int(firsts[-1] + lengths[-1] + 1)
    joined = "\x00".join(distinct)  # a unit of its own where it occurs, so no piece crosses it
    flat = np.fromiter(chain.from_iterable(vocabulary.trie().iter(joined)), np.int64)
    ends, sizes, pieces = flat[::2] + 1, flat[1::2] % 64, flat[1::2] // 64
    starts, out, gain = ends - sizes, vocabulary.table[0][pieces], vocabulary.table[1][pieces]
    # a character without a piece becomes its bytes: an edge marked by the code point
    has = np.zeros(n + 1, bool)
    has[ends[sizes == 1]] = True
    has[firsts] = True
    missing = np.flatnonzero(~has[:n])
    if len(missing):
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        slots = np.searchsorted(ends, missing, side="right")
        ends, starts = np.insert(ends, slots, missing), np.insert(starts, slots, missing - 1)
        out = np.insert(out, slots, vocabulary.size + codes[missing - 1])
        gain = np.insert(gain, slots, vocabulary.table[1].min() - 1.0)

    per_end = np.bincount(ends, minlength=n + 1)
    first_edge = np.zeros(n + 2, np.int64)
    np.cumsum(per_end, out=first_edge[1:])
    depth = ends - np.repeat(np.append(firsts, 0), np.append(lengths + 1, 0))[np.minimum(ends, n - 1)]
    deepest = int(lengths.max())
    order = np.argsort(depth.astype(np.uint16 if deepest < 65_536 else np.int64), kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(depth, minlength=deepest + 1)[1:])])
    by_depth = ends[order]
    heads_all = np.flatnonzero(np.concatenate([[True], by_depth[1:] != by_depth[:-1]]))
    cuts = np.searchsorted(heads_all, bounds)
    starts_by, gain_by = starts[order], gain[order]
    forward = np.zeros(n)
    shares = np.empty(len(ends))
    for k in range(deepest):  # all words' positions of one depth at a time
        lo, hi = bounds[k], bounds[k + 1]
        heads = heads_all[cuts[k]:cuts[k + 1]] - lo
        value = forward[starts_by[lo:hi]] + gain_by[lo:hi]
        spread = np.diff(np.append(heads, hi - lo))
        top = np.maximum.reduceat(value, heads)
        share = np.exp(value - np.repeat(top, spread))
        sums = np.add.reduceat(share, heads)
        forward[by_depth[lo:hi][heads]] = top + np.log(sums)
        shares[order[lo:hi]] = share / np.repeat(sums, spread)
    # running shares end by end, so that they don't depend on the other words
    rank = np.arange(len(ends)) - first_edge[ends]
    for k in range(1, int(per_end.max(initial=0))):
        later = np.flatnonzero(rank == k)
        shares[later] += shares[later - 1]
    return firsts, lengths, starts, out, shares, first_edge[:n + 1]


class Store:
    """Filtered lattices of the words met so far by this worker; starts anew when it is full."""

    def __init__(self, vocabulary: Vocabulary, edges: int = STORE_EDGES):
        self.vocabulary, self.most = vocabulary, edges
        self.clear(edges)

    def clear(self, edges: int) -> None:
        self.index: dict[str, int] = {}
        self.words, self.positions, self.edges = 0, 0, 0
        self.start, self.out, self.within = np.empty(edges, np.int32), np.empty(edges, np.int32), np.empty(edges, np.float32)
        self.first_edge = np.empty(edges + 1, np.int32)  # every position has at least one edge, save a word's first
        self.begin, self.end = np.empty(edges // 2, np.int32), np.empty(edges // 2, np.int32)

    def add(self, distinct: list[str]) -> np.ndarray:
        """The place of every word in the store."""
        found = np.fromiter((self.index.get(u, -1) for u in distinct), np.int64, len(distinct))
        new = np.flatnonzero(found < 0)
        if len(new):
            words = [distinct[i] for i in new]
            firsts, lengths, starts, out, within, first_edge = lattice(self.vocabulary, words)
            if max(self.edges + len(starts), self.positions + len(first_edge), 2 * (self.words + len(words))) > len(self.start):
                if self.words:
                    self.clear(self.most)
                    return self.add(distinct)
                self.clear(2 * max(len(starts), len(first_edge), len(words)))
            e, q, w = self.edges, self.positions, self.words
            self.start[e:e + len(starts)] = starts + q
            self.out[e:e + len(starts)] = out
            self.within[e:e + len(starts)] = within
            self.first_edge[q:q + len(first_edge)] = first_edge + e
            self.begin[w:w + len(words)], self.end[w:w + len(words)] = firsts + q, firsts + lengths + q
            self.index.update(zip(words, range(w, w + len(words))))
            found[new] = np.arange(w, w + len(words))
            self.edges, self.words = e + len(starts), w + len(words)
            self.positions = q + len(first_edge) - 1
        return found


def sample(store: Store, texts: list[str], keys: np.ndarray, seed: int) -> list[np.ndarray]:
    """Piece ids of every text, sampled in proportion to the segmentations' weights."""
    cut = [units(t) for t in texts]
    counts = np.fromiter(map(len, cut), np.int64, len(cut))
    pieces, sizes = [], []
    flat = list(chain.from_iterable(cut))
    owner = np.repeat(np.arange(len(cut)), counts)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    for lo in range(0, len(flat), BLOCK_UNITS):
        block = flat[lo:lo + BLOCK_UNITS]
        row = owner[lo:lo + BLOCK_UNITS]
        p, s = _sample_units(store, block, keys[row], place[lo:lo + BLOCK_UNITS], seed)
        pieces.append(p)
        sizes.append(s)
    if not pieces:
        return [np.empty(0, np.int32) for _ in texts]
    per_text = np.bincount(owner, weights=np.concatenate(sizes), minlength=len(texts)).astype(np.int64)
    return np.split(np.concatenate(pieces), np.cumsum(per_text)[:-1])


def _sample_units(store, block, keys, place, seed):
    """Pieces of all units in order, and how many of each."""
    long = np.flatnonzero(np.fromiter(map(len, block), np.int64, len(block)) > LONG_UNIT)
    if not len(long):
        return _sample_short(store, block, keys, place, seed)
    parts: list = [None] * len(block)
    for i in long.tolist():
        stream = mixed(seed, keys[i:i + 1], place[i:i + 1]).view(np.int64)
        parts[i], _ = _with_bytes(store.vocabulary, sample_long(store.vocabulary, block[i], stream, LONG_UNIT), None)
    rest = np.setdiff1d(np.arange(len(block)), long)
    if len(rest):
        pieces, steps = _sample_short(store, [block[i] for i in rest.tolist()], keys[rest], place[rest], seed)
        for i, part in zip(rest.tolist(), np.split(pieces, np.cumsum(steps)[:-1])):
            parts[i] = part
    return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


def _sample_short(store, block, keys, place, seed):
    encoded = pa.array(block, pa.string()).dictionary_encode()
    which = store.add(encoded.dictionary.to_pylist())[encoded.indices.to_numpy(zero_copy_only=False)]
    vocabulary, first_edge, within, starts, out = (
        store.vocabulary, store.first_edge, store.within, store.start, store.out
    )
    at, begin = store.end[which], store.begin[which]
    stream = mixed(seed, keys, place).view(np.int64)
    active = np.arange(len(block))
    chosen_unit, chosen_piece, step = [], [], 0
    while len(active):
        here = at[active]
        u = uniform(stream[active], step)
        edge, last_edge = first_edge[here], first_edge[here + 1] - 1
        pending = np.flatnonzero((within[edge] <= u) & (edge < last_edge))
        while len(pending):  # on to the edge whose running share passes the number
            edge[pending] += 1
            e = edge[pending]
            pending = pending[(within[e] <= u[pending]) & (e < last_edge[pending])]
        chosen_unit.append(active)
        chosen_piece.append(out[edge])
        at[active] = starts[edge]
        active = active[starts[edge] > begin[active]]
        step += 1
    steps = np.zeros(len(block), np.int64)
    for unit in chosen_unit:
        steps[unit] += 1
    last = np.cumsum(steps) - 1
    result = np.empty(int(steps.sum()), np.int64)
    for k, (unit, piece) in enumerate(zip(chosen_unit, chosen_piece)):
        result[last[unit] - k] = piece
    return _with_bytes(vocabulary, result, steps)


def _with_bytes(vocabulary, result: np.ndarray, steps: np.ndarray | None):
    """Characters without a piece as their byte pieces; ``steps``, the pieces of every unit, grow with them."""
    odd = np.flatnonzero(result >= vocabulary.size)
    if len(odd):
        encoded = [chr(c).encode() for c in result[odd] - vocabulary.size]
        width = np.ones(len(result), np.int64)
        width[odd] = [len(b) for b in encoded]
        slots = np.cumsum(width) - width
        grown = np.repeat(result, width)
        table = np.array(vocabulary.byte_ids, np.int64)
        for slot, b in zip(slots[odd], encoded):
            grown[slot:slot + len(b)] = table[list(b)]
        if steps is not None:
            owner = np.repeat(np.arange(len(steps)), steps)
            steps = np.bincount(owner, weights=width, minlength=len(steps)).astype(np.int64)
        result = grown
    return result.astype(np.int32), steps


def decode(table: list[bytes], ids: list[int]) -> str:
    """The text of piece ids; the space put in front is taken away."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode_documents(
    docs: DataFrame, model_file: str = DEFAULT_MODEL, key: str = "doc_id", text: str = "text", seed: int = 42,
    smoothing: float = SMOOTHING, pieces_column: str = "pieces", keep_columns: bool = True,
) -> DataFrame:
    """The rows with ``pieces`` (array of ids), ``n_pieces`` and ``lossless``.

    ``lossless`` tells that decoding gives the text back; it holds for every
    text, as characters without a piece (and literal marks) become byte pieces.
    A null or empty text has no pieces. Rows that repeat a key and text get
    equal pieces; a null key is hashed like any other. No rows give no rows. New
    columns get underscores in front where the input has their names.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file, smoothing))  # fixed size
    names = [fresh(docs, n) for n in (pieces_column, "n_pieces", "lossless")]
    columns = docs.columns if keep_columns else [key]
    rest = [F.col(f"`{c}`") for c in columns]
    source = docs.select(F.struct(*rest).alias("row"), F.xxhash64(F.col(key)).alias("key"), F.col(text).alias("text"))
    row_type = source.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        table = known.decoder()
        store = Store(known)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = sample(store, texts, batch.column("key").to_numpy(zero_copy_only=False), seed)
            same = [decode(table, i.tolist()) == t for i, t in zip(ids, texts)]
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(ids) if len(ids) else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                 pa.array(sizes), pa.array(same)],
                ["row", "pieces", "n_pieces", "lossless"],
            )

    done = source.mapInArrow(run, f"row {row_type}, pieces array<int>, n_pieces int, lossless boolean")
    return done.select(
        *[F.col(f"row.`{c}`").alias(c) for c in columns], F.col("pieces").alias(names[0]),
        F.col("n_pieces").alias(names[1]), F.col("lossless").alias(names[2]),
    )


def decode_documents(
    encoded: DataFrame, model_file: str = DEFAULT_MODEL, pieces_column: str = "pieces", text_column: str = "decoded",
) -> DataFrame:
    """The rows with the text of their pieces; null pieces give null, no pieces the empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file))

    @F.pandas_udf("string")
    def text_of(ids):
        table = vocabulary.value.decoder()
        return ids.map(lambda one: None if one is None else decode(table, one))

    return encoded.withColumn(fresh(encoded, text_column), text_of(F.col(pieces_column)))
