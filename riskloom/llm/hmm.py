"""Hidden Markov language model trained by Baum-Welch over the whole corpus.

A hidden state emits a word class (a hash of the word), and the class emits the
word: P(word | state) = P(class | state) * P(word | class). So the model has a
fixed number of parameters for its states, while the counts of all words, which
grow with the corpus, stay a distributed table. Baum-Welch runs over class
sequences: every task adds up its documents' expected counts, which are summed
by class across tasks. A text's likelihood is the scaled forward recursion over
its classes plus the word parts, found by a join with the counts: frequent
words, a bounded table, are looked up inside the task, the others by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.text import uniform, words
from riskloom.session import scratch_path

STATES = 8
CLASSES = 1 << 14  # hashed word classes; one more class is the end of a text
ITERATIONS = 3
STAY = 0.95  # chance of staying in a state, before training
PRIOR = 10_000.0  # pseudo-counts of a state's emissions, spread like the class frequencies; less than one a class
WINDOW = 4096  # tokens of a text whose forward values are held at a time
BLOCK_TOKENS = 250_000  # of the texts that are worked on side by side
GAIN = 1e-4  # log10 probability a token; training stops when an iteration gains less
HEAD_WORDS = 1 << 17  # most words looked up inside a task
FLUSH_WORDS = 1_000_000  # distinct words that a task gathers before it passes them on
END = "\n"  # the end token; no word holds white space


def classes_of(distinct: list[str]) -> np.ndarray:
    """The hashed class of every word."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) % CLASSES for w in distinct), np.int64, len(distinct))


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over all tokens of the rows, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("c", "sum")]).rename_columns(["word", "c"])

        for batch in batches:
            _, flat = words(batch.column("text"))
            found = pc.value_counts(flat)
            names = pa.concat_arrays([found.field("values").cast(pa.string()), pa.array([END], pa.string())])
            counts = pa.concat_arrays([found.field("counts").cast(pa.int64()), pa.array([batch.num_rows], pa.int64())])
            held.append(pa.table({"word": names, "c": counts}))
            size += len(names)
            if size > FLUSH_WORDS:
                held = [merged()]
                size = held[0].num_rows
                if size > FLUSH_WORDS // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from merged().to_batches()

    partial = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, c bigint")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def head_words(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent words, cut between two counts so that at most ``most`` remain."""
    by_count = counts.groupBy("c").agg(F.count("*").alias("n"))
    # one row per distinct count, of which a corpus of N tokens has fewer than sqrt(2 N)
    upward = Window.orderBy(F.desc("c"))
    cut = by_count.withColumn("so_far", F.sum("n").over(upward)).where(F.col("so_far") <= most)
    lowest = cut.agg(F.min("c")).first()[0]
    return counts.where(F.lit(False) if lowest is None else F.col("c") >= lowest)


def token_rows(docs: DataFrame, key: str, text: str, held: Column, head: tuple[pa.Array, np.ndarray] | None, spark) -> DataFrame:
    """Per row: uid, doc_id, held_out, classes (16-bit numbers), sums over frequent words, and the other words."""
    sent = spark.sparkContext.broadcast(head)  # HEAD_WORDS words at most
    source = docs.select(F.col(key).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = sent.value
        gain = np.log10(counts + 0.5)
        base = (TaskContext.get().partitionId() << 40) if TaskContext.get() else 0
        row = 0
        for batch in batches:
            n = batch.num_rows
            sizes, flat = words(batch.column("text"))
            encoded = flat.dictionary_encode()
            ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            distinct = encoded.dictionary.cast(pa.string())
            owner = np.repeat(np.arange(n), sizes)
            kinds = classes_of(distinct.to_pylist()).astype(np.uint16)
            # the class sequence of every text with the end put behind it
            ends = np.cumsum(sizes + 1)
            sequence = np.full(int(ends[-1]) if n else 0, CLASSES, np.uint16)
            inside = np.ones(len(sequence), bool)
            inside[ends - 1] = False
            sequence[inside] = kinds[ids]
            raw = sequence.tobytes()
            starts = ends - sizes - 1
            sequences = [raw[2 * a:2 * b] for a, b in zip(starts.tolist(), ends.tolist())]

            place = pc.index_in(distinct, value_set=known)
            place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False)
            at = place[ids] if len(ids) else np.empty(0, np.int64)
            frequent = at >= 0
            sums = np.bincount(owner[frequent], weights=gain[at[frequent]], minlength=n).astype(np.float64)
            hits = np.bincount(owner[frequent], minlength=n)
            rest = owner[~frequent] * max(len(distinct), 1) + ids[~frequent]
            pairs, times = np.unique(rest, return_counts=True)
            pair_owner = pairs // max(len(distinct), 1)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(pair_owner, minlength=n))]).astype(np.int32)
            tail = distinct.take(pa.array(pairs % max(len(distinct), 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(base + row + np.arange(n)), batch.column("doc_id"), batch.column("held_out"),
                 pa.array(sequences, pa.binary()), pa.array(sums), pa.array(hits.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), tail),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(times.astype(np.int64)))],
                ["uid", "doc_id", "held_out", "classes", "head_sum", "head_known", "tail_words", "tail_times"],
            )
            row += n

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"uid bigint, doc_id {kind}, held_out boolean, classes binary, head_sum double, head_known bigint, "
        "tail_words array<string>, tail_times array<bigint>",
    )


@dataclass
class Model:
    """Start, transition and emission probabilities; emission has a row per class."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def untrained(cls, frequency: np.ndarray, states: int, seed: int = 42) -> Model:
        """States that tell apart by hashed noise around the class frequencies."""
        noise = uniform(seed, np.arange(frequency.size)[:, None], np.arange(states)[None, :])
        emit = frequency[:, None] * np.exp(2.0 * noise - 1.0)
        move = np.full((states, states), (1 - STAY) / max(states - 1, 1))
        np.fill_diagonal(move, STAY if states > 1 else 1.0)
        return cls(np.full(states, 1.0 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, frequency: np.ndarray) -> Model:
        emit = emit + PRIOR * frequency[:, None]
        start, move = start + 0.1, move + 0.1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


class _Block:
    """Texts of a batch, longest first, in time-major order: step t holds its texts' classes side by side."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.longest = int(self.lengths[0])
        # texts still going on at each step
        self.active = len(lengths) - np.searchsorted(self.lengths[::-1], np.arange(self.longest), side="right")
        self.offset = np.concatenate([[0], np.cumsum(self.active)])
        flat = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        text = np.repeat(np.arange(len(lengths)), self.lengths)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.classes = np.empty(len(flat), np.int64)
        self.classes[self.offset[step] + text] = flat

    def forward(self, model: Model, alpha, first: int, last: int, keep: bool):
        """Scaled forward values of steps first..last-1; returns the last ones, all of them, and the scales."""
        lo, hi = self.offset[first], self.offset[last]
        emission = model.emit[self.classes[lo:hi]]
        scales = np.empty(hi - lo)
        kept = np.empty((hi - lo, len(model.start))) if keep else None
        for t in range(first, last):
            a, b = self.offset[t] - lo, self.offset[t + 1] - lo
            value = model.start * emission[a:b] if t == 0 else (alpha[:b - a] @ model.move) * emission[a:b]
            scale = value.sum(axis=1)
            value /= scale[:, None]
            scales[a:b] = scale
            if keep:
                kept[a:b] = value
            alpha = value
        return alpha, kept, scales, emission

    def likelihood(self, model: Model) -> np.ndarray:
        """log10 probability of every text's classes, in the given order."""
        sums = np.zeros(len(self.lengths))
        alpha = None
        for first in range(0, self.longest, WINDOW):
            last = min(first + WINDOW, self.longest)
            alpha, _, scales, _ = self.forward(model, alpha, first, last, False)
            logs = np.log10(scales)
            for t in range(first, last):
                a, b = self.offset[t] - self.offset[first], self.offset[t + 1] - self.offset[first]
                sums[:b - a] += logs[a:b]
        out = np.empty(len(sums))
        out[self.order] = sums
        return out

    def expected(self, model: Model):
        """Baum-Welch counts: of first states, of moves, and of emissions by class; and the log10 likelihood.

        Long texts keep forward values only at window borders, and each window's
        are worked out again when the backward values reach it.
        """
        states = len(model.start)
        edges = list(range(0, self.longest, WINDOW))
        entering, alpha, total = [], None, 0.0
        for first in edges:
            entering.append(alpha)
            if first != edges[-1]:
                alpha = self.forward(model, alpha, first, first + WINDOW, False)[0]
        start, move = np.zeros(states), np.zeros((states, states))
        emit = np.zeros((model.emit.shape[0], states))
        following = None  # (move probabilities @ what follows) of the step behind the window, for its active texts
        for first, alpha in zip(reversed(edges), reversed(entering)):
            last = min(first + WINDOW, self.longest)
            lo = self.offset[first]
            _, kept, scales, emission = self.forward(model, alpha, first, last, True)
            total += float(np.log10(scales).sum())
            beta = np.ones_like(kept)
            for t in range(last - 1, first - 1, -1):
                a, b = self.offset[t] - lo, self.offset[t + 1] - lo
                if following is not None:
                    beta[a:a + len(following)] = following
                following = ((emission[a:b] * beta[a:b]) / scales[a:b, None]) @ model.move.T
            gamma = kept * beta
            codes = self.classes[lo:self.offset[last]]
            for s in range(states):
                emit[:, s] += np.bincount(codes, weights=gamma[:, s], minlength=len(emit))
            coming = emission * beta / scales[:, None]
            # a step's forward value sits one step earlier, at the same text
            later = np.arange(self.offset[first + 1], self.offset[last]) - lo
            step = np.searchsorted(self.offset, later + lo, side="right") - 1
            before = later - (self.offset[step] - self.offset[step - 1])
            move += kept[before].T @ coming[later]
            if first == 0:
                start += gamma[:self.active[0]].sum(axis=0)
            else:
                n = self.active[first]
                move += alpha[:n].T @ coming[:n]
        return start, move * model.move, emit, total


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """The batch's class sequences in blocks of texts of similar length, bounded by tokens, with their row numbers."""
    sequences = [np.frombuffer(s, np.uint16) for s in batch.column("classes").to_pylist()]
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    order = np.argsort(-lengths, kind="stable")
    number = (np.cumsum(lengths[order]) - lengths[order]) // BLOCK_TOKENS
    for rows in np.split(order, np.flatnonzero(np.diff(number)) + 1) if len(order) else []:
        yield rows, [sequences[i] for i in rows]


def baum_welch(rows: DataFrame, frequency: np.ndarray, states: int, iterations: int) -> Model:
    """Train on the class sequences of all ``rows``, until an iteration gains less than GAIN or ``iterations`` are done."""
    spark = rows.sparkSession
    model = Model.untrained(frequency, states)
    names = [f"s{i}" for i in range(states)]
    last = -np.inf
    for _ in range(iterations):
        sent = spark.sparkContext.broadcast(model)  # a fixed number of parameters

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            emit = np.zeros(sent.value.emit.shape)
            start, move, reached = np.zeros((1, states)), np.zeros((states, states)), np.zeros((1, states))
            for batch in batches:
                for _, sequences in _blocks(batch):
                    s, m, e, total = _Block(sequences).expected(sent.value)
                    start += s
                    move += m
                    emit += e
                    reached[0, 0] += total
            # slots below the classes hold the likelihood, the moves and the first states
            slots = np.concatenate([np.arange(-states - 2, 0), np.flatnonzero(emit.any(axis=1))])
            values = np.concatenate([reached, move, start, emit[emit.any(axis=1)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots.astype(np.int32)), *[pa.array(np.ascontiguousarray(values[:, i])) for i in range(states)]],
                ["slot", *names],
            )

        parts = rows.select("classes").mapInArrow(run, "slot int, " + ", ".join(f"{n} double" for n in names))
        # one row per class: a fixed number whatever the corpus
        summed = parts.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toPandas().set_index("slot")
        table = np.zeros((states + 2 + frequency.size, states))
        table[summed.index.to_numpy() + states + 2] = summed[names].to_numpy()
        model = Model.from_counts(table[states + 1], table[1:states + 1], table[states + 2:], frequency)
        sent.destroy()
        reached = table[0, 0] / max(table[states + 2:].sum(), 1.0)  # of the model before this step, a token
        if reached - last < GAIN:
            break
        last = reached
    return model


def score_documents(
    docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", states: int = STATES,
    iterations: int = ITERATIONS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    Rows where ``held`` is true don't teach the model. Tokens are the words of
    the whole text, A-Z lower-cased, and one end; a null text is empty and has
    the end only. Repeated rows teach and are scored each; null keys are kept.
    An empty table gives an empty result; with nothing to learn from, all words
    are unknown and every count is 0. Other columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "word-counts")
    word_counts(docs.where(~held), text).write.parquet(path)
    counts = spark.read.parquet(path)
    found = head_words(counts, HEAD_WORDS).toArrow()
    head = (found.column("word").combine_chunks().cast(pa.string()), found.column("c").to_numpy().astype(np.float64))
    path = scratch_path(spark, "token-rows")
    token_rows(docs, key, text, held, head, spark).write.parquet(path)
    rows = spark.read.parquet(path)
    mass, kinds = _class_totals(counts)
    total, distinct = int(mass.sum()), int(kinds.sum())
    frequency = (mass + 0.5 * (kinds + 1)) / (mass + 0.5 * (kinds + 1)).sum()
    model = baum_welch(rows.where("not held_out"), frequency, states, iterations)
    sent = spark.sparkContext.broadcast((model, np.log10(mass + 0.5 * (kinds + 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, below = sent.value
        for batch in batches:
            value, n_tokens = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for at, sequences in _blocks(batch):
                value[at] = _Block(sequences).likelihood(known) - np.array([below[s].sum() for s in sequences])
                n_tokens[at] = [len(s) for s in sequences]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id"), batch.column("held_out"),
                 pa.array(n_tokens), batch.column("head_sum"),
                 batch.column("head_known"), pa.array(value)],
                ["uid", "doc_id", "held_out", "n_tokens", "head_sum", "head_known", "class_score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("uid", "doc_id", "held_out", "classes", "head_sum", "head_known").mapInArrow(
        run, f"uid bigint, doc_id {kind}, held_out boolean, n_tokens bigint, head_sum double, head_known bigint, class_score double"
    )
    tail = rows.select("uid", F.explode(F.arrays_zip("tail_words", "tail_times")).alias("w")).select(
        "uid", F.col("w.tail_words").alias("word"), F.col("w.tail_times").alias("times")
    )
    looked_up = (
        tail.join(counts, "word", "left")
        .groupBy("uid").agg(
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_sum"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        )
    )
    end = counts.where(F.col("word") == END).agg(F.sum("c")).first()[0] or 0
    words_part = F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) + float(np.log10(end + 0.5))
    return scored.join(looked_up, "uid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + int(end > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (words_part - F.col("n_tokens") * float(np.log10(total + 0.5 * (distinct + 1)))).alias("base_score"),
        (words_part + F.col("class_score")).alias("score"),
    )


def _class_totals(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of every class, the end's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, kinds = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
        for batch in batches:
            found = batch.column("word").to_pylist()
            at = classes_of(found)
            at[np.array([w == END for w in found], bool)] = CLASSES
            mass += np.bincount(at, weights=batch.column("c").to_numpy(), minlength=CLASSES + 1).astype(np.int64)
            kinds += np.bincount(at, minlength=CLASSES + 1)
        some = np.flatnonzero(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(mass[some]), pa.array(kinds[some])], ["class", "mass", "kinds"]
        )

    summed = (
        counts.mapInArrow(run, "class int, mass bigint, kinds bigint")
        .groupBy("class").agg(F.sum("mass").alias("mass"), F.sum("kinds").alias("kinds")).toPandas()  # one row per class
    )
    mass, kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    mass[summed["class"]], kinds[summed["class"]] = summed["mass"], summed["kinds"]
    return mass, kinds
