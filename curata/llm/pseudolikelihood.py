"""Masked pseudo-likelihood of documents under a bidirectional window network trained in numpy.

Every word is predicted from the ``REACH`` words before and after it; a document's score is the sum of those conditional
log-probabilities. A word's probability is that of its class, which the network predicts, times that of the word in its class.
Words are counted exactly. The ``OWN`` most frequent have units of their own: the first of them are classes by themselves, the others share classes of about
equal mass in the order of frequency, and their counts tell them apart there. All other words are one class and are spelled, byte after byte, with
probabilities from the exact counts of byte pairs in all of them. So no two words are taken for one, however many there are, and what is sent
to the tasks has a fixed size.

Counting, training and scoring run in tasks. The network is trained by rounds of local descent on every partition; the rounds
share out the positions of every document, so that each position is learned from once. The partitions' weights are averaged by
Spark, so the driver gets as many numbers as there are weights, byte pairs, words with units and different counts of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from curata.llm.pieces import portions
from curata.llm.texts import need, whole_text
from curata.session import settle

#: Words with units of their own, at most; the unit after theirs stands for a spelled word.
OWN = 1 << 14
#: Bytes of text whose words are counted together before they are sent on.
COUNTED = 1 << 23
CLASSES = 128
ALONE = CLASSES // 2
#: The class of spelled words, and the mark before and after their bytes.
SPELLED, EDGE = CLASSES - 1, 256
REACH = 2
WIDTH = 16
HIDDEN = 32
ROUNDS = 2
STEP = 512
RATE = 0.05
AT_ONCE = 512
HELD = 1 << 20
#: Logits within this need no shift before they become exponentials: neither these nor their sums leave a float.
MILD = 60

SHAPES = {
    "embedding": (CLASSES + 1, WIDTH),  # the last row stands for what lies outside a document
    "inner": (2 * REACH * WIDTH, HIDDEN),
    "inner_bias": (HIDDEN,),
    "outer": (HIDDEN, CLASSES),
    "outer_bias": (CLASSES,),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
CELLS = np.arange(SHAPES["embedding"][0] * WIDTH).reshape(-1, WIDTH)
OFFSETS = np.array([*range(-REACH, 0), *range(1, REACH + 1)])
ONES = np.ones(max(CLASSES, STEP), np.float32)


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts after one another, as bytes, and how many each text has; as ``bytes.split`` has them."""
    lists = pa.compute.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat, sizes = lists.flatten(), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    real = pa.compute.greater(pa.compute.binary_length(flat), 0)  # a space at either end of a text leaves an empty one
    if real.true_count == len(flat):
        return flat.cast(pa.large_binary()), sizes
    ends = np.cumsum(sizes)
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[np.concatenate([[0], ends]).astype(np.int64)]
    return flat.filter(real).cast(pa.large_binary()), np.diff(upto)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``word, n`` of every distinct word of all texts, exact; tasks count before anything moves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in portions(pa.compute.binary_length(batch.column(0)).to_pylist(), COUNTED):
                number = words_in(batch.column(0).slice(start, end - start))[0].value_counts()
                yield pa.RecordBatch.from_arrays([number.field(0).cast(pa.binary()), number.field(1)], names=["word", "n"])

    counted = docs.select(whole_text(text).alias("text")).mapInArrow(work, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def byte_pairs_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring bytes of every word, with a mark on either side, as one number each, and the word each pair is in."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    begins = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    sizes = np.diff(begins)
    ends = np.cumsum(sizes + 1)
    line = np.full(int(ends[-1]) + 1, EDGE, np.int64)
    inside = np.ones(len(line), bool)
    inside[0] = False
    inside[ends] = False
    line[inside] = np.frombuffer(data, np.uint8)[begins[0] : begins[-1]]
    return line[:-1] * (EDGE + 1) + line[1:], np.repeat(np.arange(len(sizes)), sizes + 1)


def spelling(rest: DataFrame) -> np.ndarray:
    """Log-probability of each byte after each, from ``word, n``: every pair counts once more than it occurs."""
    size = (EDGE + 1) ** 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            pairs, owner = byte_pairs_of(batch.column(0))
            np.add.at(total, pairs, batch.column(1).to_numpy()[owner])
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], names=["pair", "n"])

    rows = rest.mapInArrow(work, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.ones(size)
    counts[rows.column("pair").to_numpy()] += rows.column("n").to_numpy()
    counts = counts.reshape(EDGE + 1, EDGE + 1)
    return np.log(counts / counts.sum(1, keepdims=True)).ravel()


@dataclass(frozen=True)
class Vocabulary:
    """The words with units, most frequent first, how often each unit occurs (the last: spelled words), and how the others are spelled."""

    words: list[bytes]
    counts: np.ndarray
    pairs: np.ndarray

    @property
    def spelled(self) -> int:
        return len(self.words)

    def log_spelled(self, words: list[bytes] | pa.Array) -> np.ndarray:
        if not len(words):
            return np.zeros(0)
        pairs, owner = byte_pairs_of(words if isinstance(words, pa.Array) else pa.array(words, pa.binary()))
        return np.bincount(owner, self.pairs[pairs], len(words))


def vocabulary(docs: DataFrame, text: str, own: int = OWN) -> Vocabulary:
    """The words more frequent than the one at place ``own`` + 1, so that words of equal counts are all in or all out.

    The driver gets these, and how many words have each count: words of k different counts occur k * (k + 1) / 2 times at least, so that are few.
    """
    counts = settle(word_counts(docs, text))
    alike = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).toArrow().sort_by([("n", "descending")])
    times, words = (alike.column(x).to_numpy() for x in ("n", "words"))
    place = np.searchsorted(np.cumsum(words), own, side="right")  # of the count of the word at place own + 1
    least = int(times[place]) if place < len(times) else 0
    spelled = int(times[place:] @ words[place:])
    rows = sorted((-r.n, bytes(r.word)) for r in counts.where(F.col("n") > least).collect())
    return Vocabulary([w for _, w in rows], np.array([*(-n for n, _ in rows), spelled], np.int64), spelling(counts.where(F.col("n") <= least)))


def in_units(docs: DataFrame, words: Vocabulary, text: str, key: str) -> DataFrame:
    """``key, ids, spelled`` of every text: its words' units, two bytes each, and the log-probability of the spelling of those without."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        units_of = pa.array(known.words, pa.large_binary())
        for batch in batches:
            for start, end in portions(pa.compute.binary_length(batch.column(1)).to_pylist(), HELD):
                part = batch.slice(start, end - start)
                split, sizes = words_in(part.column(1))
                coded = split.dictionary_encode()
                distinct, line = coded.dictionary, coded.indices.to_numpy()
                places = pa.compute.index_in(distinct, value_set=units_of)
                units = places.fill_null(known.spelled).to_numpy(zero_copy_only=False).astype("<u2")
                logs = np.zeros(len(distinct))
                logs[units == known.spelled] = known.log_spelled(distinct.filter(places.is_null()))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                ids = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((ends * 2).astype(np.int32)), pa.py_buffer(units[line])])
                spelled = pa.array(np.bincount(np.repeat(np.arange(len(part)), sizes), logs[line], len(part)), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, spelled], names=["key", "ids", "spelled"])

    rows = docs.select(F.col(key).alias("key"), whole_text(text).alias("__text"))
    return rows.mapInArrow(work, rows.select("key").schema.add("ids", "binary").add("spelled", "double"))


def classed(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and the log-probability of a word in its class (each counted once more than it occurs).

    The last unit, of spelled words, is a class; of the others the most frequent are classes of their own.
    """
    n = len(counts) - 1
    order = np.lexsort((np.arange(n), -counts[:n]))
    rest, smoothed = order[ALONE:], counts + 1.0
    mass = np.cumsum(smoothed[rest])
    classes = np.full(len(counts), SPELLED, np.int16)
    classes[order[:ALONE]] = np.arange(len(order[:ALONE]))
    bands = SPELLED - ALONE
    if len(rest):
        classes[rest] = ALONE + np.minimum((mass - smoothed[rest] / 2) * bands / mass[-1], bands - 1).astype(int)
    totals = np.bincount(classes, smoothed, CLASSES)
    return classes, np.log(smoothed / totals[classes]).astype(np.float32)


def views(weights: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = weights[at : at + size].reshape(shape)
        at += size
    return out


def initial() -> np.ndarray:
    random, weights = np.random.default_rng(1), np.zeros(SIZE, np.float32)
    for name, part in views(weights).items():
        if "bias" not in name:
            part[:] = random.standard_normal(part.shape) / np.sqrt(part.shape[0] if name != "embedding" else WIDTH)
    return weights


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(1, keepdims=True))
    return logits


def mild(parts: dict[str, np.ndarray]) -> bool:
    """Whether no logit of these weights can leave ``MILD``, whatever the context, because no hidden value leaves 1."""
    return bool((np.abs(parts["outer"]).sum(0) + np.abs(parts["outer_bias"])).max() < MILD)


def log_softmax_at(logits: np.ndarray, target: np.ndarray, shifted: bool = True) -> np.ndarray:
    """``log_softmax`` at one place of each row; the logits are used up. ``shifted`` first takes each row's largest from it."""
    if shifted:
        logits -= logits.max(1, keepdims=True)
    picked = logits[np.arange(len(target)), target]
    return picked - np.log(np.exp(logits, out=logits) @ ONES[: logits.shape[1]])


def laid_out(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents' classes after one another with ``REACH`` outside marks around each; places and documents of the real ones."""
    sizes = np.array([len(x) for x in lists])
    starts = np.cumsum(sizes + REACH) - sizes
    line = np.full(int(sizes.sum() + REACH * (len(lists) + 1)), CLASSES, np.int16)
    owner = np.repeat(np.arange(len(lists)), sizes)
    places = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    if len(places):
        line[places] = np.concatenate(lists)
    return line, places, owner


class Trainer:
    """Adagrad on mini-batches, from given weights. Its arrays are made once, because making them costs as much as filling them."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.squares, self.seen = weights.copy(), np.full(SIZE, 1e-6, np.float32), 0
        self.gradient = np.zeros(SIZE, np.float32)
        self.parts, self.parts_of_gradient = views(self.weights), views(self.gradient)
        near = 2 * REACH
        self.x, self.hidden = np.empty((STEP * near, WIDTH), np.float32), np.empty((STEP, HIDDEN), np.float32)
        self.error, self.back = np.empty((STEP, CLASSES), np.float32), np.empty((STEP, HIDDEN), np.float32)
        self.rows = np.arange(STEP) * CLASSES
        self.cells, self.wide = np.empty((STEP * near, WIDTH), np.int64), np.empty((STEP, near * WIDTH))

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        """Learns from at most ``STEP`` positions."""
        w, g, n = self.parts, self.parts_of_gradient, len(target)
        hidden, error, back, cells, wide = self.hidden[:n], self.error[:n], self.back[:n], self.cells[: context.size], self.wide[:n]
        x = np.take(w["embedding"], context.ravel(), 0, out=self.x[: context.size], mode="clip").reshape(n, -1)
        np.matmul(x, w["inner"], out=hidden)
        hidden += w["inner_bias"]
        np.tanh(hidden, out=hidden)
        np.matmul(hidden, w["outer"], out=error)
        error += w["outer_bias"]
        if not mild(w):
            error -= error.max(1, keepdims=True)
        np.exp(error, out=error)
        error *= (1 / (error @ ONES[:CLASSES]) / n)[:, None]
        error.reshape(-1)[self.rows[:n] + target] -= 1 / n
        np.matmul(hidden.T, error, out=g["outer"])
        np.matmul(ONES[:n], error, out=g["outer_bias"])
        np.matmul(error, w["outer"].T, out=back)
        back *= 1 - hidden * hidden
        np.matmul(x.T, back, out=g["inner"])
        back.sum(0, out=g["inner_bias"])
        np.take(CELLS, context.ravel(), 0, out=cells, mode="clip")
        wide[:] = np.matmul(back, w["inner"].T, out=x)
        g["embedding"][:] = np.bincount(cells.ravel(), wide.ravel(), (CLASSES + 1) * WIDTH).reshape(-1, WIDTH)
        self.squares += self.gradient * self.gradient
        self.weights -= RATE * self.gradient / np.sqrt(self.squares)
        self.seen += n

    def learn(self, lists: list[np.ndarray], turn: int, rounds: int) -> None:
        """One pass over every ``rounds``-th position of each document, others in each ``turn``; a step takes them from all over the lists."""
        line, places, _ = laid_out(lists)
        sizes = np.array([len(x) for x in lists])
        first = np.array([(int(x[:64].sum()) + turn) % rounds for x in lists])
        number = np.maximum(-(-(sizes - first) // rounds), 0)
        begins = np.cumsum(sizes) - sizes + first - (np.cumsum(number) - number) * rounds
        chosen = places[np.repeat(begins, number) + np.arange(number.sum()) * rounds]
        steps = -(-len(chosen) // STEP)
        for at in range(steps):
            some = chosen[at::steps]
            self.step(line.take(some[:, None] + OFFSETS), line.take(some))


@dataclass(frozen=True)
class Model:
    classes: np.ndarray  # of each unit
    inside: np.ndarray  # log-probability of a unit's word in its class
    weights: np.ndarray
    words: Vocabulary | None = None

    def tables(self) -> list[np.ndarray]:
        """What each class at each place adds to the hidden layer."""
        w = views(self.weights)
        return [w["embedding"] @ w["inner"][i * WIDTH : (i + 1) * WIDTH] for i in range(2 * REACH)]


def conditional_sums(lists: list[np.ndarray], model: Model, tables: list[np.ndarray]) -> np.ndarray:
    """For documents as units: the sum of log p(word | words around it) over all words."""
    w = views(model.weights)
    line, places, owner = laid_out([model.classes[x] for x in lists])
    logs, shifted = np.empty(len(places)), not mild(w)
    room = [np.empty((AT_ONCE, width), np.float32) for width in (HIDDEN, HIDDEN, CLASSES)]
    for at in range(0, len(places), AT_ONCE):
        some = places[at : at + AT_ONCE]
        hidden, taken, logits = (x[: len(some)] for x in room)
        hidden[:] = w["inner_bias"]
        for table, offset in zip(tables, OFFSETS):
            hidden += np.take(table, line.take(some + offset), 0, out=taken, mode="clip")
        np.matmul(np.tanh(hidden, out=hidden), w["outer"], out=logits)
        logits += w["outer_bias"]
        logs[at : at + AT_ONCE] = log_softmax_at(logits, line.take(some), shifted)
    sums = np.bincount(owner, logs, len(lists))
    return sums + [model.inside[x].sum(dtype=np.float64) for x in lists]


def _lists(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Portions of a batch, with the units of its first column."""
    column = batch.column(0)
    for start, end in portions(pa.compute.binary_length(column).to_pylist(), HELD):
        part = batch.slice(start, end - start)
        yield part, [np.frombuffer(x.as_buffer(), "<u2") for x in part.column(0)]


def trained(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = ROUNDS) -> Model:
    """Counts over all of ``docs`` and a network trained on all their partitions."""
    words = vocabulary(docs, text)
    return descended(settle(in_units(docs, words, text, key)), words, rounds)


def descended(texts: DataFrame, words: Vocabulary, rounds: int) -> Model:
    """The network trained on all partitions of ``texts`` in units; deterministic for given partitions."""
    context = texts.sparkSession.sparkContext
    classes, inside = classed(words.counts)
    weights = initial()
    for turn in range(rounds):
        sent = context.broadcast((classes, weights))

        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, start = sent.value
            trainer = Trainer(start)
            for batch in batches:
                for _, lists in _lists(batch):
                    trainer.learn([of[x] for x in lists], turn, rounds)
            if trainer.seen:
                share = trainer.weights.astype(np.float64) * trainer.seen
                columns = [pa.array(np.arange(SIZE, dtype=np.int32)), pa.array(share), pa.array(np.full(SIZE, trainer.seen))]
                yield pa.RecordBatch.from_arrays(columns, names=["place", "share", "seen"])

        shares = texts.select("ids").mapInArrow(descend, "place int, share double, seen long").groupBy("place")
        rows = shares.agg((F.sum("share") / F.sum("seen")).alias("weight")).toArrow()
        if rows.num_rows:
            weights = np.empty(SIZE, np.float32)
            weights[rows.column("place").to_numpy()] = rows.column("weight").to_numpy()
        sent.unpersist()
    return Model(classes, inside, weights, words)


def scored(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, log_likelihood`` of texts, those of the model or others."""
    return _scored(in_units(docs, model.words, text, key), model)


def _scored(texts: DataFrame, model: Model) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(replace(model, words=None))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value.tables()
        for batch in batches:
            for part, lists in _lists(batch):
                sums = conditional_sums(lists, sent.value, tables) + part.column(2).to_numpy()
                columns = [part.column(1), pa.array([len(x) for x in lists], pa.int64()), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "log_likelihood"])

    schema = texts.select("key").schema.add("n_tokens", "long").add("log_likelihood", "double")
    return texts.select("ids", "key", "spelled").mapInArrow(work, schema)


def pseudo_likelihood(docs: DataFrame, *, text: str = "text", key: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """``key, n_tokens, log_likelihood, per_token, perplexity`` of every row, under a model of ``docs`` itself.

    Runs jobs while it is built. Texts are taken whole; a null, empty or wordless one has 0 tokens, log-likelihood 0 and null for the last
    two. Rows that repeat count as often in the model and score alike. An empty table gives an empty result; other columns are
    not looked at, whatever their names. Texts do not move: what tasks count of their words is shuffled, and the units are written once.
    """
    need(docs, text, key)
    words = vocabulary(docs, text)
    texts = settle(in_units(docs, words, text, key))
    rows = _scored(texts, descended(texts, words, rounds))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return rows.select(F.col("key").alias(key), "n_tokens", "log_likelihood", mean.alias("per_token"), F.exp(-mean).alias("perplexity"))
