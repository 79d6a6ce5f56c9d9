"""Near-duplicate vectors by iterative quantisation.

Vectors are centred, rotated and cut to their signs. The rotation is learned on a sample so that the signs lose as little as they can, which
balances the bits. Codes are looked up in several tables, each on its own run of bits and all keys within one bit, and
what meets with few differing bits is ranked by the cosine of the original vectors. Only vectors of equal labels meet.

Vectors that are equal make up one class, which takes part once. No pair is ever written: the members of a key are compared
within a task, by blocks of bounded size, and give their numbers of links and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from curata.llm.components import components
from curata.llm.texts import need
from curata.session import settle

COSINE = 0.98
BITS = 64
TABLES = 4
WIDTH = BITS // TABLES
#: Codes further apart than this are not ranked. At a cosine of 0.98, 64 bits differ in 4 on average, and in more than 16 with a probability below 1e-6.
REACH = 16
#: Expected number of vectors the rotation is learned on.
SAMPLE = 20_000
ROUNDS = 50
BLOCK = 1_024


@dataclass(frozen=True)
class Codes:
    """Mean and projection for vectors of one length; other lengths get a random projection drawn from their length."""

    mean: np.ndarray
    projection: np.ndarray  # (length, BITS)

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        length = vectors.shape[1]
        if length == len(self.mean):
            signs = (vectors - self.mean) @ self.projection > 0
        else:
            signs = vectors @ frame(length) > 0
        return np.packbits(signs, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def frame(length: int) -> np.ndarray:
    """``BITS`` random directions; orthogonal ones as far as there is room."""
    random = np.random.default_rng(length).standard_normal((max(length, BITS), max(length, BITS)))
    return np.linalg.qr(random)[0][:length, :BITS]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision, also where squares would overflow or vanish."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def fit(vectors: np.ndarray, rounds: int = ROUNDS) -> Codes:
    """Principal directions of unit vectors, then the rotation that brings them nearest to their signs, alternately with the signs."""
    length = vectors.shape[1]
    mean = vectors.mean(0)
    centred = vectors - mean
    if length >= BITS:
        _, directions = np.linalg.eigh(centred.T @ centred)
        start = directions[:, ::-1][:, :BITS]
    else:
        start = frame(length)
    flat = centred @ start
    rotation = np.linalg.qr(np.random.default_rng(0).standard_normal((BITS, BITS)))[0]
    for _ in range(rounds):
        signs = np.where(flat @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(flat.T @ signs)
        rotation = u @ v
    return Codes(mean, start @ rotation)


def usable(vector: str, label: str, key: str) -> Column:
    """Whether a row can link: key and label there, a vector without null or non-finite components and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(key).isNotNull() & F.col(label).isNotNull() & ~bad & some, F.lit(False))


def learned(classes: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> Codes:
    """Codes for the most frequent length, learned on ``sample`` vectors on average, drawn by the hash of their class."""
    lengths = classes.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    if not lengths:
        return Codes(np.zeros(0), np.zeros((0, BITS)))
    length, n = lengths[0]
    drawn = F.pmod(F.col("c1"), F.lit(1 << 40)) < int(min(1.0, sample / n) * (1 << 40))
    rows = classes.where(F.size("vector") == length).where(drawn).select("c1", "c2", "vector").toArrow()
    if not rows.num_rows:
        return Codes(np.zeros(length), frame(length))
    rows = rows.sort_by([("c1", "ascending"), ("c2", "ascending")])
    return fit(unit(_matrix(rows.column("vector").combine_chunks(), length)), rounds)


def _matrix(column: pa.ListArray, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def coded(classes: DataFrame, codes: Codes) -> DataFrame:
    """``rep, label, length, code``."""
    sent = classes.sparkSession.sparkContext.broadcast(codes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                bits = sent.value(unit(_matrix(part.column(2), int(length))))
                columns = [part.column(0), part.column(1), pa.array([int(length)] * part.num_rows, pa.int32()), pa.array(bits)]
                yield pa.RecordBatch.from_arrays(columns, names=["rep", "label", "length", "code"])

    schema = classes.select("rep", "label").schema.add("length", "integer").add("code", "long")
    return classes.select("rep", "label", "vector").mapInArrow(work, schema)


def _slots(codes: DataFrame, near: bool) -> DataFrame:
    """One row per table, with the run of bits there; ``near``: also with each of its bits turned."""
    pieces = [F.shiftrightunsigned("code", WIDTH * t).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long")) for t in range(TABLES)]
    turned = [0, *(1 << b for b in range(WIDTH))] if near else [0]
    keys = F.array(*[p.bitwiseXOR(F.lit(x).cast("long")) + (t << WIDTH) for t, p in enumerate(pieces) for x in turned])
    return codes.withColumn("slot", F.explode(keys))


KEY = ["label", "length", "slot"]


def _members(codes: DataFrame) -> DataFrame:
    """Rows of the keys under which two codes within ``REACH`` meet: holders of a key, and those within one bit that are near one of them."""
    own, near = _slots(codes, False), _slots(codes, True)
    other = own.select(*KEY, F.col("rep").alias("other"), F.col("code").alias("there"))
    close = F.bit_count(F.col("code").bitwiseXOR(F.col("there"))) <= REACH
    same = (near["label"] == other["label"]) & (near["length"] == other["length"]) & (near["slot"] == other["slot"])
    asking = settle(near.join(other, same & (F.col("rep") != F.col("other")) & close, "left_semi").withColumn("own", F.lit(False)))
    keys = asking.select(*KEY).distinct()
    return asking.unionByName(own.join(keys, KEY, "left_semi").withColumn("own", F.lit(True)))


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """Members with the two blocks they meet in: both sides of a key are cut into blocks, and each two meet once."""
    cuts = members.groupBy(*KEY).agg(
        *[F.greatest(F.ceil(F.count_if(F.col("own") == own) / block), F.lit(1)).alias(n) for n, own in (("holders", True), ("askers", False))]
    )
    met = members.join(cuts, KEY)
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("own"), F.col("holders")).otherwise(F.col("askers")))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("own"), F.col("askers")).otherwise(F.col("holders")) - 1)
    met = met.withColumn("mine", mine).withColumn("theirs", F.explode(others))
    held = F.when(F.col("own"), F.col("mine")).otherwise(F.col("theirs")).alias("holder_block")
    asked = F.when(F.col("own"), F.col("theirs")).otherwise(F.col("mine")).alias("asker_block")
    return met.select(*KEY, "rep", "code", "own", held, asked)


def met_links(table: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(askers, linked vectors), and (member, root) of a spanning forest, among the askers and holders of one key.

    A pair that meets in several tables counts in the first of them.
    """
    own = table.column("own").to_numpy()
    reps, codes = table.column("rep").to_numpy(), table.column("code").to_numpy().view(np.uint64)
    sizes, length = table.column("size").to_numpy(), table.column("length")[0].as_py()
    at = table.column("slot")[0].as_py() >> WIDTH
    vectors = unit(_matrix(table.column("vector").combine_chunks(), length))
    asker, holder = np.flatnonzero(~own), np.flatnonzero(own)
    linked = vectors[asker] @ vectors[holder].T >= cosine
    linked &= reps[asker][:, None] != reps[holder][None, :]
    differ = codes[asker][:, None] ^ codes[holder][None, :]
    for t in range(at):
        bits = differ >> np.uint64(WIDTH * t) & np.uint64((1 << WIDTH) - 1)
        linked &= np.bitwise_count(bits) > 1
    n = linked @ sizes[holder]
    nodes, place = np.unique(reps, return_inverse=True)
    label = np.arange(len(nodes))
    for i, row in zip(asker, linked):
        if row.any():
            met = np.unique(label[np.append(place[holder[row]], place[i])])
            label[np.isin(label, met[1:])] = met[0]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    some = np.flatnonzero(n)
    return reps[asker[some]], n[some], nodes[moved], nodes[label[moved]]


def links(classes: DataFrame, codes: Codes, *, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``a, b, n``: for a class and a key ``n`` vectors linked to it (``b`` null), and edges of spanning forests (``n`` null)."""
    members = _dealt(_members(settle(coded(classes, codes))), block)
    rows = members.join(classes.select(F.col("rep").alias("of"), "size", "vector"), F.col("rep") == F.col("of")).drop("of")

    def work(table: pa.Table) -> pa.Table:
        askers, n, a, b = met_links(table, cosine)
        gap = lambda k: pa.nulls(k, pa.int64())
        counts = pa.table({"a": askers, "b": gap(len(askers)), "n": pa.array(n, pa.int64())})
        return pa.concat_tables([counts, pa.table({"a": a, "b": b, "n": gap(len(a))})])

    return rows.groupBy(*KEY, "holder_block", "asker_block").applyInArrow(work, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, sample: int = SAMPLE
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row.

    Runs jobs while it is built. A row whose vector, label or key is null, or whose vector is empty, zero or holds null or non-finite components links with
    nothing and is its own component. Equal vectors of a label are linked and meet others as one class. Rows that
    repeat a key count as vectors of their own with that key, also if their vectors are unlike. Vectors of different lengths are not linked. An empty
    table gives an empty result; other columns are not looked at.
    """
    need(vectors, key, vector, label)
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    c = [F.xxhash64(F.lit(i), "label", "vector").alias(f"c{i}") for i in (1, 2)]
    able = rows.withColumn("able", usable("vector", "label", "key")).select("*", *c)
    known = settle(able.select("key", "able", "c1", "c2"))
    classes = able.where("able").groupBy("c1", "c2").agg(
        F.min("key").alias("least"), F.count("*").alias("size"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    # A key may repeat with unlike vectors, so classes have numbers of their own, fixed by being written.
    classes = settle(classes.withColumn("rep", F.monotonically_increasing_id()))
    found = settle(links(classes, learned(classes, sample), cosine=cosine))
    counts = found.where("n is not null").groupBy(F.col("a").alias("counted")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    summed = classes.select("c1", "c2", "rep", "size", "least").join(counts, F.col("rep") == F.col("counted"), "left")
    summed = settle(summed.join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep")))
    least = settle(summed.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component")))  # written, so that a large component can be split
    summed = settle(
        summed.join(least, F.col("root") == F.col("of")).select(
            F.col("c1").alias("d1"),
            F.col("c2").alias("d2"),
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("links"),
            "component",
        )
    )
    out = known.join(summed, F.col("able") & (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")), "left")
    component = F.coalesce("component", "key")
    return out.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
