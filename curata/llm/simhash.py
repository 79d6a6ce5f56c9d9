"""SimHash near-dedup through fuzzy keys of the binary Golay code.

A text's fingerprint is the bitwise majority of the hashes of its word shingles. Two texts are linked if their fingerprints
differ in at most three bits. The 64 bits are cut into three segments of at most 23 bits, and three errors leave at
least two segments with at most one error each. The perfect Golay code maps every segment to the index of the codeword within three bits; the segment and its
neighbours at one bit map to one to six indices. So for some pair of segments the index pair of one fingerprint is
among the index pairs of the other: fingerprints are joined on those keys and verified by their bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, functions as F

from curata.llm.components import components
from curata.llm.pieces import portions
from curata.llm.texts import free_name, need, whole_text
from curata.session import settle

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Widths of the segments, from the high bits down.
SEGMENTS = (22, 21, 21)
#: Generator polynomial of the [23, 12, 7] Golay code (fixed value).
GOLAY = 0b110001110101
#: A key with more fingerprints than this is searched within blocks of a bounded size instead of by a join.
COMMON = 16
BLOCK = 2_048
HELD = 1 << 22
VOTES = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash; 0 for a text without words. Equal shingles count as often as they occur."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - [len(w) + 1 for w in words]
    n = max(len(words) - shingle + 1, 1)
    firsts, lasts = starts[:n].tolist(), (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, VOTES):
        some = zip(firsts[at : at + VOTES], lasts[at : at + VOTES])
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in some), np.uint64, min(VOTES, n - at))
        votes += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame, *, text: str = "text", keep: Sequence[str] = ("doc_id",), shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``keep`` columns and ``bits``, the fingerprint as a signed long, of every row. A null text counts as empty."""
    need(docs, text, *keep)
    names = [*keep, "bits"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, end in portions(pa.compute.binary_length(texts).to_pylist(), HELD):
                part = texts.slice(start, end - start)
                bits = np.array([fingerprint(t.as_py(), shingle, seed) for t in part], np.uint64).view(np.int64)
                kept = [batch.column(i).slice(start, end - start) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(bits)], names=names)

    rows = docs.select(*[docs[c] for c in keep], whole_text(text).alias("__text"))
    return rows.mapInArrow(work, docs.select(*[docs[c] for c in keep]).schema.add("bits", "long"))


@lru_cache(maxsize=1)
def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits of a word by the generator, and the error of each remainder."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << bit - 11
        return word

    single = [remainder(1 << bit) for bit in range(23)]

    def table(bits: range) -> np.ndarray:
        out = np.zeros(1 << len(bits), np.int32)
        for i, bit in enumerate(bits):
            out[1 << i : 2 << i] = out[: 1 << i] ^ single[bit]
        return out

    errors = np.zeros(1 << 11, np.int32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            mixed = 0
            for bit in bits:
                mixed ^= single[bit]
            errors[mixed] = sum(1 << bit for bit in bits)
    return table(range(12)), table(range(12, 23)), errors


def codeword(words: np.ndarray) -> np.ndarray:
    """Index, from 0 to 4095, of the only codeword within three bits of each 23-bit word."""
    low, high, errors = _decoder()
    return (words ^ errors[low[words & 4095] ^ high[words >> 12]]) >> 11


def segments(bits: np.ndarray) -> list[np.ndarray]:
    out, shift = [], 64
    for width in SEGMENTS:
        shift -= width
        out.append((bits >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64))
    return out


def near_codewords(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the distinct codeword indices of each segment and of its neighbours at one bit."""
    flips = np.array([0, *(1 << b for b in range(width))])
    found = np.sort(codeword(words[:, None] ^ flips), axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new]


PAIRS = ((0, 1), (0, 2), (1, 2))


def own_keys(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the index pairs of the fingerprints themselves, three each."""
    own = [codeword(s) for s in segments(bits)]
    keys = [n << 24 | own[a] << 12 | own[b] for n, (a, b) in enumerate(PAIRS)]
    return np.tile(np.arange(len(bits)), len(PAIRS)), np.concatenate(keys)


def near_keys(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all index pairs within one bit in either segment, 3 to 108 each."""
    near = [near_codewords(s, w) for s, w in zip(segments(bits), SEGMENTS)]
    rows, keys = [], []
    for n, (a, b) in enumerate(PAIRS):
        (row_a, at_a), (row_b, at_b) = near[a], near[b]
        first = np.searchsorted(row_b, row_a)
        many = np.searchsorted(row_b, row_a, "right") - first
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        rows.append(np.repeat(row_a, many))
        keys.append(n << 24 | np.repeat(at_a, many) << 12 | at_b[np.repeat(first, many) + step])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(codes: DataFrame, keys) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy()
            for at in range(0, len(bits), 4_096):
                some = bits[at : at + 4_096]
                rows, found = keys(some.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(some[rows])], names=["key", "bits"])

    return codes.select("bits").mapInArrow(work, "key long, bits long")


def block_links(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) for fingerprints that links within ``bits`` connect to a smaller one: at most one per member."""
    bits = np.unique(bits)
    label = np.arange(len(bits))
    unsigned = bits.view(np.uint64)
    for at in range(0, len(bits), 256):
        close = np.bitwise_count(unsigned[at : at + 256, None] ^ unsigned[None, :]) <= distance
        for row in close:
            met = np.unique(label[row])
            if len(met) > 1:
                label[np.isin(label, met[1:])] = met[0]
    moved = np.flatnonzero(label != np.arange(len(bits)))
    return bits[moved], bits[label[moved]]


def links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints whose connected components are those of all pairs within ``distance``.

    ``codes``: column ``bits``, distinct. Under a key with up to ``COMMON`` fingerprints every pair that meets is compared and
    kept if it is close, so a row gives a bounded number of pairs. The fingerprints under a more frequent key, as large groups of
    near copies make them, are dealt to blocks, and each two blocks are compared in one task that gives only a spanning forest. The join on keys is
    said to be a merge: Spark takes the keys of a fingerprint, some eighty rows, for one row, and would send them all to the driver as a small table.
    """
    if distance > 3:
        raise ValueError("three segments with one error each guarantee a distance of 3 at most")
    own, near = _keyed(codes, own_keys), _keyed(codes, near_keys)
    common = settle(own.groupBy("key").count().where(F.col("count") > COMMON).select("key"))
    holders = own.join(common, "key", "left_anti").withColumnRenamed("bits", "other")
    holders = holders.union(common.select("key", F.lit(None).cast("long")))  # a null stands for all under a frequent key
    close = F.bit_count(F.col("bits").bitwiseXOR(F.col("other"))) <= distance
    meets = (near["key"] == holders["key"]) & (F.col("other").isNull() | ((F.col("bits") > F.col("other")) & close))
    met = settle(near.join(holders.hint("merge"), meets).select(near["key"], "bits", "other"))
    found = met.where("other is not null").select(F.col("bits").alias("a"), F.col("other").alias("b"))
    if common.limit(1).count():
        found = found.union(_common_links(met.where("other is null").select("key", "bits"), distance))
    return found.distinct()


def _common_links(members: DataFrame, distance: int) -> DataFrame:
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("bits"), F.col("blocks")))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    both = dealt.select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "bits")

    def work(table: pa.Table) -> pa.Table:
        a, b = block_links(table.column("bits").to_numpy(), distance)
        return pa.table({"a": a, "b": b})

    return both.groupBy("key", "low", "high").applyInArrow(work, "a long, b long")


def _rooted(classes: DataFrame, distance: int) -> DataFrame:
    """``classes`` (distinct ``bits``) with ``root``, the smallest fingerprint that links reach."""
    roots = components(settle(links(classes, distance)))  # node, root: classes that have links
    joined = classes.join(roots.hint("merge"), classes["bits"] == roots["node"], "left")  # all three grow with the rows, as below
    return settle(joined.select(*classes.columns, F.coalesce("root", "bits").alias("root")))


def near_duplicates(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE
) -> DataFrame:
    """``key, fingerprint, component_id`` of every row: 16 hex digits, and the smallest key that links reach.

    Runs jobs while it is built. Null, empty and wordless texts have fingerprint zero and are linked like any others; rows with equal
    fingerprints are one class and meet others through it, so copies are never paired. Rows that repeat a key or have none belong to the
    component of their text; a component of rows without key has a null id. An empty table gives an empty result; other columns
    are not looked at.
    """
    need(docs, text, key)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = settle(fingerprints(rows, keep=["key"], shingle=shingle, seed=seed))
    classes = settle(known.groupBy("bits").agg(F.min("key").alias("first")))
    rooted = _rooted(classes, distance)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = settle(rooted.join(smallest.hint("merge"), "root").select(F.col("bits").alias("of"), "component_id"))
    met = known.join(ids.hint("merge"), F.col("bits") == F.col("of"))
    return met.select(F.col("key").alias(key), F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def representatives(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE
) -> DataFrame:
    """The row of each component with the smallest key, and of equal keys the smallest text hash; columns unchanged.

    A null key counts as larger than any other; of rows that repeat key and text one stays. Otherwise as ``near_duplicates``.
    """
    need(docs, text, key)
    mark = lambda: F.xxhash64(whole_text(text))
    rows = docs.select(F.col(key).isNull().alias("last"), F.col(key).alias("key"), mark().alias("mark"), F.col(text).alias("text"))
    known = settle(fingerprints(rows, keep=["last", "key", "mark"], shingle=shingle, seed=seed))
    rooted = _rooted(settle(known.select("bits").distinct()), distance)
    firsts = known.groupBy("bits").agg(F.min(F.struct("last", "key", "mark")).alias("first"))
    chosen = firsts.join(rooted.hint("merge"), "bits").groupBy("root").agg(F.min("first").alias("first")).select("first.key", "first.mark")
    chosen = settle(chosen)
    # merge said to Spark, because what is chosen grows with the rows
    same = docs[key].eqNullSafe(chosen["key"]) & (mark() == chosen["mark"])
    kept = docs.join(chosen.hint("merge"), same, "left_semi")
    if known.groupBy("last", "key", "mark").count().where("count > 1").limit(1).count():
        name = free_name("__mark", docs)
        kept = kept.withColumn(name, mark()).dropDuplicates([key, name]).drop(name)
    return kept
