"""Byte-level pair merging of whole texts, many pieces at a time, in padded matrices.

A text is split by a pattern; each distinct piece of a portion of texts that is no token of its own becomes a row of byte tokens.
Rows of like length share a padded matrix. In each round every row merges its leftmost pair of least rank; the
ranks of the two new neighbour pairs come from a hash table of all pairs that make a token, finished rows leave the
matrix, and columns no row needs any more are cut off. Pieces too long for a matrix are merged by a heap of (rank, place),
which picks the same pairs.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from curata.llm.pieces import portions
from curata.llm.texts import need, whole_text

#: Bytes of text whose pieces are held at a time (a longer text is held alone).
HELD = 1 << 20
#: Widths of the matrices; longer pieces go to the heap.
WIDTHS = (4, 8, 16, 32, 64, 128, 256)
#: Distinct pieces, and bytes of them, a task remembers from one portion to the next.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 1 << 24

NONE = np.int32(np.iinfo(np.int32).max)
ENCODED = (StructField("ids", ArrayType(IntegerType(), False)), StructField("decoded", BinaryType()))


class PairTable:
    """Rank of the token that two tokens make together, by open addressing in arrays."""

    def __init__(self, lefts: np.ndarray, rights: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(4 * len(ranks)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = (lefts.astype(np.int64) << 32) | rights
        at, rest = self._first(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[at[rest]] < 0]
            self.keys[at[free]] = keys[free]  # of several at one slot the last stays
            rest = rest[self.keys[at[rest]] != keys[rest]]
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
        self.ranks[at] = ranks

    def _first(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of any shape, ``NONE`` where they make no token; negative ids make none."""
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        out = np.full(len(keys), NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        keys, at = keys[todo], self._first(keys[todo])
        while len(todo):
            there = self.keys[at]
            hit = there == keys
            out[todo[hit]] = self.ranks[at[hit]]
            go = ~hit & (there >= 0)
            todo, keys, at = todo[go], keys[go], (at[go] + 1) & ((1 << self.bits) - 1)
        return out.reshape(left.shape)


class ByteVocabulary:
    """A file of ranks: one token a line, in base64, and its rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            lines = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        by_id = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.tokens = pa.array(by_id, pa.large_binary())
        parts = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        left, right, rank = np.array(parts, np.int64).reshape(-1, 3).T
        self.pairs = PairTable(left, right, rank.astype(np.int32))
        self.pair = {(a, b): r for a, b, r in parts}

    def merged(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of a padded matrix (-1 behind a row's end) as they finish: row numbers, and their ids, padded."""
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        rows, everyone = np.arange(len(ids)), np.arange(len(ids))
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            least = ranks[everyone, at] if ranks.shape[1] else np.full(len(rows), NONE)
            done = least == NONE
            if done.any():
                yield rows[done], ids[done]
                rows, ids, ranks, at, least = (x[~done] for x in (rows, ids, ranks, at, least))
                everyone = np.arange(len(rows))
                if not len(rows):
                    return
            width = ids.shape[1]
            place = np.arange(width - 1)
            ids[everyone, at] = least
            ids = np.take_along_axis(ids, place + (place > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, place[:-1] + (place[:-1] >= at[:, None]), axis=1)
            for side in (at - 1, at):  # the pairs the new token is in
                there = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[there, side[there]] = self.pairs(ids[there, side[there]], ids[there, side[there] + 1])
            full = int((ids >= 0).sum(axis=1).max())
            ids, ranks = ids[:, :full], ranks[:, : max(full - 1, 0)]

    def merged_alone(self, piece: bytes) -> list[int]:
        """One piece of any length, in time of n log n."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, pair = len(ids), self.pair
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = [pair.get(p, -1) for p in zip(ids, ids[1:])] + [-1]
        heap = [(r, i) for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r:
                continue
            gone = after[i]
            ids[i], rank[gone], ids[gone] = r, -1, -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            for j in (before[i], i):
                if j < 0:
                    continue
                rank[j] = pair.get((ids[j], ids[after[j]]), -1) if after[j] < n else -1
                if rank[j] >= 0:
                    heapq.heappush(heap, (rank[j], j))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        found: list = [self.ranks.get(p) for p in pieces]
        sizes = np.array([len(p) for p in pieces], np.int64)
        counts = np.ones(len(pieces), np.int64)
        todo = np.array([i for i, x in enumerate(found) if x is None], np.int64)
        results: dict[int, np.ndarray] = {}
        low = 0
        for width in WIDTHS:
            some = todo[(sizes[todo] > low) & (sizes[todo] <= width)]
            low = width
            if not len(some):
                continue
            padded = np.full((len(some), width), -1, np.int32)
            filled = np.arange(width) < sizes[some][:, None]
            padded[filled] = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in some.tolist()]), np.uint8)]
            for rows, ids in self.merged(padded):
                lengths = (ids >= 0).sum(axis=1)
                counts[some[rows]] = lengths
                results.update(zip(some[rows].tolist(), np.split(ids[ids >= 0], np.cumsum(lengths)[:-1])))
        for i in todo[sizes[todo] > low].tolist():
            results[i] = np.array(self.merged_alone(pieces[i]), np.int32)
            counts[i] = len(results[i])
        out = np.empty(int(counts.sum()), np.int32)
        begins = np.cumsum(counts) - counts
        whole = np.array([i for i, x in enumerate(found) if x is not None], np.int64)
        out[begins[whole]] = [found[i] for i in whole.tolist()]
        for i, ids in results.items():
            out[begins[i] : begins[i] + counts[i]] = ids
        return out, counts

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Bytes of runs of ids that end at ``ends`` (0 first)."""
        bytes_ = self.tokens.take(pa.array(ids, pa.int32()))
        at = np.frombuffer(bytes_.buffers()[1], np.int64)[: len(ids) + 1][ends] if len(ids) else np.zeros(len(ends), np.int64)
        data = bytes_.buffers()[2] or pa.py_buffer(b"")
        return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(at.tobytes()), data])


class Memory:
    """Distinct pieces with their ids, kept from portion to portion and forgotten when there are too many."""

    def __init__(self, vocabulary: ByteVocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.counts, self.size = np.empty(0, np.int32), np.empty(0, np.int64), 0

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and where each text's ids end (0 first)."""
        if len(self.places) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self.forget()
        places, found, pieces = self.places, [], []
        for text in texts:
            split = self.vocabulary.split(text)
            pieces.append(len(split))
            found += [places.setdefault(p, len(places)) for p in split]
        new = [p.encode() for p in list(places)[len(self.counts) :]]
        if new:
            ids, counts = self.vocabulary.encode_pieces(new)
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            self.size += sum(map(len, new))
        which = np.array(found, np.int64)
        lengths = self.counts[which]
        begins = (np.cumsum(self.counts) - self.counts)[which]
        upto = np.cumsum(lengths)
        flat = self.ids[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(begins - (upto - lengths), lengths)]
        return flat, np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(pieces, dtype=np.int64)])]


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteVocabulary:
    """The vocabulary, read once per Python worker."""
    return ByteVocabulary(path, pattern)


def encoded(docs: DataFrame, ranks: str, pattern: str, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``ids`` and ``decoded``, the bytes that the ids stand for.

    ``ranks`` is the path of a rank file that every executor can read, ``pattern`` splits a text into pieces that are merged
    for themselves. No special tokens: their strings are ordinary text. Texts are taken whole: a null or empty text has an
    empty array and no bytes; a piece of any length is merged in full. Rows are independent: nothing is shuffled, repeated rows
    come out repeated, an empty table stays empty; columns outside ``keep`` do not matter, whatever their names.
    """
    need(docs, text, *keep)
    fields = [docs.schema[c] for c in keep]
    names = [f.name for f in fields]
    clash = {n.lower() for n in names} & {f.name for f in ENCODED}
    if clash:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(ranks, pattern)
        memory = Memory(vocabulary)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for start, end in portions(pa.compute.binary_length(column).to_pylist(), HELD):
                flat, ends = memory.encode(column.slice(start, end - start).to_pylist())
                ids = pa.ListArray.from_arrays(ends.astype(np.int32), flat)
                back = vocabulary.decode(flat, ends).cast(pa.binary())
                kept = [batch.column(i).slice(start, end - start) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, ids, back], names=[*names, *(f.name for f in ENCODED)])

    rows = docs.select(*[docs[c] for c in keep], whole_text(text).alias("__text"))
    return rows.mapInArrow(work, StructType([*fields, *ENCODED]))


def decoded(rows: DataFrame, ranks: str, pattern: str, *, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``decoded``, the bytes of the ids; null ids give none."""
    need(rows, ids, *keep)
    fields = [rows.schema[c] for c in keep]
    names = [f.name for f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(ranks, pattern)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for start, end in portions(pa.compute.list_value_length(column).to_pylist(), HELD):
                part = column.slice(start, end - start)
                ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(part).to_numpy(zero_copy_only=False), dtype=np.int64)])
                back = vocabulary.decode(part.flatten().to_numpy(zero_copy_only=False), ends).cast(pa.binary())
                kept = [batch.column(i).slice(start, end - start) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, back], names=[*names, "decoded"])

    empty = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>"))
    given = rows.select(*[rows[c] for c in keep], empty.alias("__ids"))
    return given.mapInArrow(work, StructType([*fields, StructField("decoded", BinaryType())]))


def digests(rows: DataFrame) -> dict:
    """Columns that sum up the arrays: counts, SHA-256 of the ids joined by spaces and of the decoded bytes."""
    return {
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    }
