"""Document fingerprints by winnowing, in DataFrame functions only.

A text becomes a row of tokens, each run of ``k`` tokens a gram with a rolling hash (cyclic polynomial over token hashes), and of each ``w`` grams
in a row the smallest hash is kept with its position, the rightmost of equals. So two texts that share ``k + w - 1``
tokens in a row share a fingerprint there, and one shorter than ``k`` tokens never counts as a match. Texts of fewer tokens have one
gram, of fewer grams one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from curata.llm.texts import bound_once, need, whole_text
from curata.session import settle

K = 4
W = 9

#: Scripts written without spaces: each character is a token (Thai, kana, ideographs).
CHARACTERS = r"฀-๿぀-ヿ㐀-䶿一-鿿豈-﫿\x{20000}-\x{3FFFF}"
TOKEN = rf"[{CHARACTERS}]|[^\x20\x09-\x0D{CHARACTERS}]+"

BITS = 31
LOW = (1 << BITS) - 1


def _rotated(value: Column, by: int) -> Column:
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by)) if by else value


def winnowed(text: Column, k: int = K, w: int = W) -> Column:
    """The kept grams in order, as an array of longs: 31 bits of hash above 31 bits of the position's complement.

    That packing makes the smallest long of a window the smallest hash and, of equals, the rightmost.
    """
    hashes = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))

    def grams(t: Column) -> Column:
        def packed(at: Column) -> Column:
            mixed = None
            for j in range(k):
                # beyond the end of a short text nothing is mixed in
                part = _rotated(F.coalesce(F.get(t, at + j), F.lit(0).cast("long")), k - 1 - j)
                mixed = part if mixed is None else mixed.bitwiseXOR(part)
            hashed = F.shiftrightunsigned(mixed, 64 - BITS)
            return F.shiftleft(hashed, BITS).bitwiseOR(F.lit(LOW).cast("long") - at.cast("long"))

        last = F.greatest(F.size(t) - k, F.lit(0))
        return F.when(F.size(t) > 0, F.transform(F.sequence(F.lit(0), last), packed)).otherwise(F.array().cast("array<bigint>"))

    def minima(g: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(g) - w + 1, F.lit(1)))
        every = F.transform(starts, lambda i: F.array_min(F.slice(g, i, w)))
        return F.when(F.size(g) > 0, F.array_distinct(every)).otherwise(g)

    return bound_once(bound_once(hashes, grams), minima)


def kept_hashes(kept: Column) -> Column:
    return F.transform(kept, lambda v: F.shiftrightunsigned(v, BITS).cast("int"))


def kept_positions(kept: Column) -> Column:
    return F.transform(kept, lambda v: (F.lit(LOW).cast("long") - v.bitwiseAND(F.lit(LOW).cast("long"))).cast("int"))


def as_text(kept: Column) -> Column:
    """The hashes as hex digits, eight each, in the order of their positions."""
    return F.array_join(F.transform(kept, lambda v: F.lpad(F.lower(F.hex(F.shiftrightunsigned(v, BITS))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Shared over all distinct hashes of two fingerprints, from 0 to 1; two empty ones are alike."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)).cast("double") / both)


def neighbours(docs: DataFrame, key: str, size: Column) -> DataFrame:
    """``key, prev, prev_size``: the key before each one in ascending order; before the first comes the last.

    Keys are dealt out by ranges and looked along within each; what crosses a border comes from one row per range.
    Null keys have no place. Of rows with equal keys the largest size counts.
    """
    spark = docs.sparkSession
    keys = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(size).alias("size"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(keys.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()))
    ends = ranged.groupBy("part").agg(F.max(F.struct("key", "size")).alias("tail"))
    order = Window.orderBy("part")
    before = F.lag("tail").over(order)
    last = F.last("tail").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    borders = ends.select("part", F.coalesce(before, last).alias("before"))
    inner = F.lag(F.struct("key", "size")).over(Window.partitionBy("part").orderBy("key"))
    found = ranged.withColumn("inner", inner).join(F.broadcast(borders), "part")  # one row per range
    prev = F.coalesce("inner", "before")
    return found.select("key", prev["key"].alias("prev"), prev["size"].alias("prev_size"))


def fingerprints(docs: DataFrame, *, text: str = "text", key: str = "doc_id", k: int = K, w: int = W) -> DataFrame:
    """``key, n_chars, fingerprint, positions`` of every row, whole texts; no shuffle.

    A null text counts as empty, an empty one or one of white space has an empty fingerprint. Equal texts have equal
    fingerprints; rows that repeat come out repeated, an empty table stays empty, other columns are not looked at.
    """
    need(docs, text, key)
    rows = docs.select(F.col(key).alias("key"), F.char_length(whole_text(text)).cast("long").alias("n_chars"), winnowed(whole_text(text), k, w).alias("kept"))
    return rows.select(F.col("key").alias(key), "n_chars", as_text(F.col("kept")).alias("fingerprint"), kept_positions(F.col("kept")).alias("positions"))


def edited_likeness(docs: DataFrame, *, text: str = "text", key: str = "doc_id", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of texts and of their edited texts, and how alike they are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document's, in ascending order of key; after the last comes the first. Columns: ``key, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, positions``. A null text counts as empty; a row without
    key has no next document, so its edited and near columns are null; rows that repeat a key share their next
    document, and for the one before them the smallest of their texts counts; other columns are not looked at; an empty table gives an empty result.

    A text moves once, with its fingerprint. What a document gives to the one before it, the part of its text
    that is needed there and its hashes, moves a second time.
    """
    need(docs, text, key)
    whole = whole_text(text)
    before = settle(neighbours(docs, key, F.char_length(whole)))
    repeated = docs.groupBy(key).count().where("count > 1").limit(1).count()
    all_rows = docs.select(F.col(key).alias("key"), whole.alias("text"), winnowed(whole, k, w).alias("kept"))
    rows = all_rows.where("key is not null")  # said here for both joins, so that they read one and the same shuffle
    given = rows.join(before.withColumnRenamed("key", "own"), F.col("key") == F.col("own")).select(
        F.col("prev").alias("to"),
        F.substring(F.col("text"), F.lit(1), F.floor(F.col("prev_size") / 2).cast("int")).alias("head"),
        kept_hashes(F.col("kept")).alias("next_hashes"),
    )
    if repeated:
        given = given.groupBy("to").agg(F.min(F.struct("head", "next_hashes")).alias("g")).select("to", "g.*")
    alone = all_rows.where("key is null").withColumns({"head": F.lit(None).cast("string"), "next_hashes": F.lit(None).cast("array<int>")})
    met = rows.join(given, F.col("key") == F.col("to"), "left").drop("to").unionByName(alone)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("head"), F.lit(1), half))
    out = met.select("key", n.cast("long").alias("n_chars"), "kept", "next_hashes", edited.alias("edited"))
    out = out.withColumn("edited_kept", winnowed(F.col("edited"), k, w))
    own = kept_hashes(F.col("kept"))
    return out.select(
        F.col("key").alias(key),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("kept")).alias("fingerprint"),
        as_text(F.col("edited_kept")).alias("edited_fingerprint"),
        F.when(F.col("edited").isNotNull(), likeness(own, kept_hashes(F.col("edited_kept")))).alias("near_edited"),
        F.when(F.col("edited").isNotNull(), likeness(own, F.col("next_hashes"))).alias("near_next"),
        kept_positions(F.col("kept")).alias("positions"),
    )
