"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all its
segmentations into pieces, by the forward algorithm; a text's is the product over its words, and the prediction
is the language with the largest posterior. The probabilities are learned by expectation maximisation on the words of a sample of
labelled documents: tasks run forward and backward and sum expected piece counts, of which the driver gets one number per piece and language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from curata.llm import piece_model
from curata.llm.pieces import portions
from curata.llm.texts import need
from curata.session import settle

UNKNOWN = "und"
#: Expected number of documents learned from per language.
PER_LANGUAGE = 1_500
ROUNDS = 3
#: Count that smoothing spreads over all pieces of a language.
SMOOTHING = 1_000.0
HELD = 1 << 20
CACHED = 300_000
CHUNK = 8_000
#: Longer words are scored one at a time, and learned from in pieces of this length.
LONG = 32
#: Words less probable than this are computed in logs, so that no float gets too small. A float loses nothing of what is above it.
TINY = 1e-200
MARK = "▁"


class Pieces:
    """The vocabulary as a trie over code points, in arrays: sorted (node, code point) keys, the node each leads to, its piece."""

    def __init__(self, path: str):
        texts = piece_model.load(path).texts
        self.size, self.bytes, pieces = len(texts), np.zeros(256, np.int64), {}
        for i, text in enumerate(texts):
            shown = text.decode()
            if shown.startswith("<0x") and shown.endswith(">"):
                self.bytes[int(shown[3:5], 16)] = i
            elif not (shown.startswith("<") and shown.endswith(">") and len(shown) > 2):
                pieces[shown] = i
        nodes: dict[tuple[int, str], int] = {}
        self.ids = pieces
        ends = {}
        for shown, i in pieces.items():
            node = 0
            for character in shown:
                node = nodes.setdefault((node, character), len(nodes) + 1)
            ends[node] = i
        keys = np.array([node << 21 | ord(c) for node, c in nodes])
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order]
        self.piece = np.array([ends.get(n, -1) for n in range(len(nodes) + 1)])
        self.longest = max(map(len, pieces))
        self.single: dict[int, int] = {}  # characters without a piece get rows behind the pieces: their bytes
        self.spelled: list[np.ndarray] = []

    def by_bytes(self, character: int) -> int:
        row = self.single.get(character)
        if row is None:
            row = self.single[character] = self.size + len(self.spelled)
            self.spelled.append(self.bytes[list(chr(character).encode("utf-8", "replace"))])
        return row

    def log_table(self, logs: np.ndarray) -> np.ndarray:
        """Log-probabilities of pieces and of the characters spelled in bytes so far."""
        return np.concatenate([logs, *[logs[s].sum(0, keepdims=True) for s in self.spelled]])

    def table(self, logs: np.ndarray) -> np.ndarray:
        return np.exp(self.log_table(logs))

    def edges(self, words: list[str]) -> np.ndarray:
        """(end, length, word, piece) of every piece that stands in a word, ordered by end and length.

        All places of all words walk down the trie at once. A character that is no piece is spelled in bytes.
        """
        sizes = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        start = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        room = np.repeat(sizes, sizes) - start
        place, node, found = np.arange(len(points)), np.zeros(len(points), np.int64), []
        for length in range(1, self.longest + 1):
            keys = node << 21 | points[place + length - 1]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            node = np.where(hit, self.next[at], 0)
            piece = self.piece[node]
            if length == 1:
                bare = np.flatnonzero(piece < 0)
                piece[bare] = [self.by_bytes(c) for c in points[bare].tolist()]
            stands = piece >= 0
            some = place[stands]
            found.append((start[some] + length, np.full(len(some), length), word[some], piece[stands]))
            on = hit & (room[place] > length)
            place, node = place[on], node[on]
            if not len(place):
                break
        edges = np.stack([np.concatenate(x) for x in zip(*found)], axis=1)
        # found by length, so a stable sort by end leaves lengths in order; small numbers are sorted by digits
        ends = edges[:, 0].astype(np.int16) if sizes.max(initial=0) < 1 << 15 else edges[:, 0]
        return edges[np.argsort(ends, kind="stable")]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def _steps(edges: np.ndarray) -> list[np.ndarray]:
    """Edges of one end and length at a time: no two of them are of one word."""
    if not len(edges):
        return []
    cut = np.flatnonzero((np.diff(edges[:, 0]) != 0) | (np.diff(edges[:, 1]) != 0)) + 1
    return np.split(edges, cut)


def forward(steps: list[np.ndarray], lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability of every beginning of every word: (word, end, language)."""
    alpha = np.zeros((len(lengths), lengths.max() + 1, table.shape[1]))
    alpha[:, 0] = 1
    for step in steps:
        end, size, words = step[0, 0], step[0, 1], step[:, 2]
        alpha[words, end] += alpha[words, end - size] * table[step[:, 3]]
    return alpha


def word_scores(words: list[str], pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """Log-probability of each marked word under each language."""
    out = np.empty((len(words), logs.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= LONG]
    for start in range(0, len(short), CHUNK):
        at = short[start : start + CHUNK]
        some = [words[i] for i in at]
        steps, lengths = _steps(pieces.edges(some)), np.array([len(w) for w in some])
        alpha = forward(steps, lengths, pieces.table(logs))
        found = alpha[np.arange(len(some)), lengths]
        out[at] = np.log(np.maximum(found, TINY))
        for i in np.flatnonzero((found < TINY).any(1)):
            out[at[i]] = _long_score(some[i], pieces, logs)
    for i, word in enumerate(words):
        if len(word) > LONG:
            out[i] = _long_score(word, pieces, logs)
    return out


def _log_sums(edges: np.ndarray, values: np.ndarray, length: int) -> np.ndarray:
    """Log-probability of every beginning of one word, (end, language); ``edges`` by end, ``values`` are their log-probabilities."""
    alpha = np.zeros((length + 1, values.shape[1]))
    at = np.searchsorted(edges[:, 0], np.arange(1, length + 2))
    for end in range(1, length + 1):
        a, b = at[end - 1], at[end]
        alpha[end] = np.logaddexp.reduce(alpha[end - edges[a:b, 1]] + values[a:b], axis=0)
    return alpha


def _long_score(word: str, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """The same for one word of any length and probability."""
    edges = pieces.edges([word])
    known = edges[:, 3] < pieces.size
    values = np.empty((len(edges), logs.shape[1]))
    values[known] = logs[edges[known, 3]]
    for i in np.flatnonzero(~known):
        values[i] = logs[pieces.spelled[edges[i, 3] - pieces.size]].sum(0)
    return _log_sums(edges, values, len(word))[-1]


def _masses(word: str, edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Posterior probability of every edge of one word of any probability, one language."""
    n = len(word)
    alpha = _log_sums(edges, values, n)[:, 0]
    turned = edges.copy()  # the word read from its end: an edge ends where it started
    turned[:, 0] = n - (edges[:, 0] - edges[:, 1])
    order = np.argsort(turned[:, 0], kind="stable")
    beta = _log_sums(turned[order], values[order], n)[::-1, 0]
    return np.exp(alpha[edges[:, 0] - edges[:, 1]] + values[:, 0] + beta[edges[:, 0]] - alpha[n])


def expected_counts(words: list[str], counts: np.ndarray, pieces: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """Expected count of every piece over all segmentations of words that occur ``counts`` times, one language."""
    total = np.zeros(pieces.size)
    for start in range(0, len(words), CHUNK):
        some, n = words[start : start + CHUNK], counts[start : start + CHUNK]
        steps, lengths = _steps(pieces.edges(some)), np.array([len(w) for w in some])
        log_table = pieces.log_table(np.log(probabilities)[:, None])
        table = np.exp(log_table)
        alpha = forward(steps, lengths, table)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[np.arange(len(some)), lengths] = 1
        found = alpha[np.arange(len(some)), lengths]
        weight = np.where(found < TINY, 0, n / np.maximum(found, TINY))
        for step in reversed(steps):
            end, size, at = step[0, 0], step[0, 1], step[:, 2]
            through = beta[at, end] * table[step[:, 3], 0]
            beta[at, end - size] += through
            mass = alpha[at, end - size] * through * weight[at]
            _add(total, step[:, 3], mass, pieces)
        for i in np.flatnonzero(found < TINY):
            edges = pieces.edges([some[i]])
            _add(total, edges[:, 3], n[i] * _masses(some[i], edges, log_table[edges[:, 3]]), pieces)
    return total


def _add(total: np.ndarray, rows: np.ndarray, mass: np.ndarray, pieces: Pieces) -> None:
    """Add the mass of pieces, and that of characters spelled in bytes to each of their bytes."""
    whole = rows < pieces.size
    total += np.bincount(rows[whole], mass[whole], pieces.size)
    for row, value in zip(rows[~whole], mass[~whole]):
        np.add.at(total, pieces.spelled[row - pieces.size], value)


def marked(text: str) -> list[str]:
    return [MARK + w for w in text.split()]


@dataclass(frozen=True)
class Model:
    path: str
    languages: tuple[str, ...]
    logs: np.ndarray  # (piece, language)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is left out of learning; rows without key are never learned from either, and not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def learned(
    docs: DataFrame,
    path: str,
    *,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    rounds: int = ROUNDS,
    smoothing: float = SMOOTHING,
) -> Model:
    """Learn from rows with text, language and key that are not held out.

    ``path`` is a piece model every executor can read; only its vocabulary is used. Of each language, documents are taken
    whole by a hash of their key, ``per_language`` of them on average, all if there are fewer. Without labelled rows the model knows no
    language. The driver gets one row per language, and per language and piece.
    """
    need(docs, text, lang, key)
    spark = docs.sparkSession
    usable = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    have = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}
    languages = tuple(sorted(have))
    if not languages:
        return Model(path, (), np.zeros((vocabulary(path).size, 0)))
    shares = spark.createDataFrame([(k, per_language / n) for k, n in have.items()], "of string, share double")
    drawn = F.pmod(F.xxhash64(F.lit(per_language), F.col(key).cast("string")), F.lit(1 << 40)) / float(1 << 40)
    sample = usable.join(F.broadcast(shares), F.col(lang) == F.col("of")).where(drawn < F.col("share"))  # one row per language

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in portions(pa.compute.binary_length(batch.column(1)).to_pylist(), HELD):
                part = batch.slice(start, end - start)
                found: Counter[tuple[str, str]] = Counter()
                for of, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found.update((of, w[i : i + LONG]) for w in marked(t) for i in range(0, len(w), LONG))
                columns = [pa.array([k[i] for k in found], pa.string()) for i in range(2)] + [pa.array(found.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    counted = sample.select(F.col(lang).alias("lang"), text).mapInArrow(words, "lang string, word string, n long")
    counted = settle(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    size = vocabulary(path).size
    logs = np.full((size, len(languages)), -np.log(size))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(np.exp(logs))  # pieces by languages

        def expectation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces, totals = vocabulary(path), {}
            for batch in batches:
                of, all_words, n = (batch.column(i).to_pylist() for i in range(3))
                for lang_ in set(of):
                    at = [i for i, x in enumerate(of) if x == lang_]
                    probabilities = sent.value[:, languages.index(lang_)]
                    found = expected_counts([all_words[i] for i in at], np.array([n[i] for i in at], float), pieces, probabilities)
                    totals[lang_] = totals.get(lang_, 0) + found
            for lang_, found in totals.items():
                used = np.flatnonzero(found)
                columns = [pa.array([lang_] * len(used), pa.string()), pa.array(used), pa.array(found[used])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "piece", "mass"])

        masses = counted.mapInArrow(expectation, "lang string, piece long, mass double").groupBy("lang", "piece")
        counts = np.zeros((size, len(languages)))
        for r in masses.agg(F.sum("mass").alias("mass")).toLocalIterator():
            counts[r.piece, languages.index(r.lang)] = r.mass
        logs = np.log((counts + smoothing / size) / (counts.sum(0) + smoothing))
        sent.unpersist()
    return Model(path, languages, logs)


class Scorer:
    """Texts to log-probabilities, with the words' scores kept up to a number of words."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, vocabulary(model.path)
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def __call__(self, texts: list[str]) -> np.ndarray:
        split = [t.split() for t in texts]
        words = set().union(*split)
        new = list(words.difference(self.rows))
        if len(self.rows) + len(new) > CACHED:  # words of these texts stay
            kept = list(words.intersection(self.rows))
            self.scores = self.scores[[self.rows[w] for w in kept]]
            self.rows = dict(zip(kept, range(len(kept))))
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            found = word_scores([MARK + w for w in new], self.pieces, self.model.logs)
            self.scores = np.concatenate([self.scores, found])
        out = np.zeros((len(texts), len(self.model.languages)))
        for i, ws in enumerate(split):
            at = np.fromiter(map(self.rows.__getitem__, ws), np.int64, len(ws))
            out[i] = self.scores[at].sum(0)
        return out


def predicted(docs: DataFrame, model: Model, *, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior (all languages equally likely beforehand).

    Only the text counts, all of it, and each row by itself: nothing moves. ``und`` with score 0 stands for a null or empty text, for
    one without a letter, and for all if the model knows no language; of equally likely languages the first by name is taken.
    Columns of ``docs`` named like the two, in whatever case, are replaced; an empty table stays empty.
    """
    need(docs, text)
    kept = [f for f in docs.schema.fields if f.name.lower() not in (pred.lower(), score.lower())]
    names = [f.name for f in kept]
    at = names.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, languages = None, sent.value.languages
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_pylist()
            for start, end in portions(sizes, HELD):
                part = batch.slice(start, end - start)
                scorer = scorer or Scorer(sent.value)
                texts = [t or "" for t in part.column(at).to_pylist()]
                found, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
                known = [i for i, t in enumerate(texts) if languages and any(map(str.isalpha, t))]
                logs = scorer([texts[i] for i in known])
                for i, row in zip(known, logs):
                    best = int(row.argmax())
                    found[i], sure[i] = languages[best], float(1 / np.exp(row - row[best]).sum())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(sure)], names=[*names, pred, score])

    schema = docs.select(*[docs[n] for n in names]).schema.add(pred, "string").add(score, "double")
    return docs.select(*[docs[n] for n in names]).mapInArrow(work, schema)
