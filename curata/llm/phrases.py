"""Collocations: phrases whose words stand together more often than their parts suggest.

All phrases are the nodes of a tree of suffixes: one suffix, up to the longest phrase, begins at each word of a text. The tree
is cut vertically and built part by part. Suffixes are counted first, so that every one is a leaf. A prefix with more leaves
than a group may hold is extended by a word until its parts fit; prefixes that fit are packed into groups of bounded size, and
each group builds its subtree by itself: leaves in order, and a node's count is the total of its leaves. Prefixes that were
extended are the nodes above the subtrees, and their counts are the totals that showed them to be too large.

A suffix is cut where it can no longer be a frequent phrase. Two sketches of fixed size tell: one counter per hash of a word or a
pair of neighbours, then one per hash of a longer run of words whose neighbours may all be frequent pairs. Counters are never too low, so
what they rule out is certain, and what they let through is counted exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from curata.llm.pieces import portions
from curata.llm.texts import need, whole_text
from curata.session import settle

LEAST = 100
LONGEST = 5
#: A phrase is dropped if a longer one has this many hundredths of its occurrences.
SHARE = 100
TOP = 2000
#: Leaves a group may have, up to twice that: a group is filled past its end by one prefix at most.
GROUP = 1 << 18
#: Counters of a sketch, in ranges that are summed by themselves.
SLOTS, RANGES = 1 << 23, 256
#: Words of the corpus for which there is a range of suffixes, and suffixes a task counts before it sends them.
PER_RANGE, HELD_LEAVES = 1 << 20, 1 << 20
#: Bytes of text whose words are held at a time (a longer text is held alone), and distinct words a task remembers.
HELD, REMEMBERED = 1 << 22, 1 << 18

NO_WORD = -1
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_LINES = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))


class Words:
    """Words of texts as numbers, each numbered once; the pieces they stand in are kept apart by ``NO_WORD``."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.hashes = np.empty(0, np.uint64)

    def numbers(self, text: str) -> list[int]:
        places, out = self.places, []
        for piece in text.encode().lower().translate(_LINES).split(b"\n"):
            words = piece.split()
            if words:
                out += [places.setdefault(w, len(places)) for w in words]
                out.append(NO_WORD)
        return out

    def hashed(self) -> np.ndarray:
        new = list(self.places)[len(self.hashes) :]
        if new:
            more = np.fromiter((xxhash.xxh64_intdigest(w) for w in new), np.uint64, len(new))
            self.hashes = np.concatenate([self.hashes, more])
        return self.hashes


def runs(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[tuple[str | None, np.ndarray | None]]:
    """Language and word numbers of portions of texts of that language, and a pair of nothing before ``words`` are forgotten."""
    for batch in batches:
        for start, end in portions(pc.binary_length(batch.column(1)).to_pylist(), HELD):
            held: dict[str, list[int]] = {}
            part = batch.slice(start, end - start)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                numbers = held.setdefault(lang, [])
                numbers += words.numbers(text)
            for lang, numbers in held.items():
                if numbers:
                    yield lang, np.array(numbers, np.int64)
            if len(words.places) > REMEMBERED:
                yield None, None  # what is numbered must be spelled now
                words.forget()


def hashed_runs(lang: str, numbers: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """For 1, 2 ... ``longest`` words a hash of the run that begins at each place; where none does it means nothing."""
    seed = np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed=1))
    own = (hashes[numbers] ^ seed) * np.uint64(0x9E3779B97F4A7C15)
    run = own
    for k in range(longest):
        if k:
            run = ((run >> np.uint64(7)) + np.roll(own, -k)) * np.uint64(0xC2B2AE3D27D4EB4F)
        yield run


class Filter:
    """Which runs of words may be frequent, by the sketches made so far: of words and pairs, and of longer runs."""

    def __init__(self, short: np.ndarray | None = None, long: np.ndarray | None = None):
        self.bits = [None if b is None else np.packbits(b) for b in (short, long)]
        self.slots = [0 if b is None else len(b) for b in (short, long)]

    def __getstate__(self):
        return self.bits, self.slots

    def __setstate__(self, state):
        self.bits, self.slots = state

    @cached_property
    def allowed(self) -> list[np.ndarray | None]:
        return [None if b is None else np.unpackbits(b, count=n).astype(bool) for b, n in zip(self.bits, self.slots)]

    def runs(self, lang: str, numbers: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length the hashes of the runs, and which places begin one that no sketch rules out in any of its parts."""
        fits = numbers != NO_WORD
        for k, hashed in enumerate(hashed_runs(lang, numbers, hashes, longest)):
            if k:
                after = np.roll(fits, -1)
                after[-1:] = False
                fits = fits & after
            bits = self.allowed[0 if k < 2 else 1]
            if bits is not None:
                fits = fits & bits[slot(hashed, len(bits))]
            yield hashed, fits


def slot(hashed: np.ndarray, slots: int) -> np.ndarray:
    return (hashed >> np.uint64(64 - (slots - 1).bit_length())).astype(np.int64)


def counter_type(least: int) -> type:
    """The smallest kind of number that holds twice ``least``."""
    return np.uint8 if 2 * least < 256 else np.uint16


def sketched(texts: DataFrame, known: Filter, lengths: range, least: int, slots: int, ranges: int) -> DataFrame:
    """Of every task of ``lang, text``: the words of each language, and counters of the runs of these lengths, in ranges, stopped at ``least``."""
    size = slots // ranges

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = Words(), Counter()
        counters = np.zeros(slots, np.int32)
        for lang, numbers in runs(batches, words):
            if numbers is None:
                continue
            n[lang] += int((numbers != NO_WORD).sum())
            for k, (hashed, fits) in enumerate(known.runs(lang, numbers, words.hashed(), lengths.stop - 1), 1):
                if k in lengths:
                    np.add.at(counters, slot(hashed[fits], slots), 1)
        stopped = np.minimum(counters, least).astype(counter_type(least))
        rows = [(lang, total, None, None) for lang, total in n.items()]
        for r in range(ranges):
            part = stopped[r * size : (r + 1) * size]
            if part.any():
                rows.append((None, None, r, part.tobytes()))
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int32(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "range", "counters"])

    return texts.mapInArrow(work, "lang string, n long, range int, counters binary")


def summed(sketches: DataFrame, least: int, slots: int, ranges: int) -> np.ndarray:
    """Bits of the counters that reach ``least`` over all tasks; what comes to the driver has ``slots`` bits."""
    size, kind = slots // ranges, counter_type(least)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = totals.setdefault(r, np.zeros(size, kind))
                np.minimum(total + np.frombuffer(data, kind), kind(least), out=total)
        bits = [np.packbits(t >= least).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(bits, pa.binary())], names=["range", "bits"])

    parts = sketches.where("range is not null").select("range", "counters").repartition("range").mapInArrow(add, "range int, bits binary")
    out = np.zeros(slots, bool)
    for row in parts.collect():
        out[row["range"] * size : (row["range"] + 1) * size] = np.unpackbits(np.frombuffer(row.bits, np.uint8), count=size).astype(bool)
    return out


def suffixes(texts: DataFrame, known: Filter, longest: int, ranges: int) -> DataFrame:
    """``lang, leaf, n``: the suffix that begins at each word, cut where ``known`` rules it out, words joined by spaces; every one once.

    A task counts its suffixes in arrays and sends them in blocks, one for each range of their hashes; a range is summed from its blocks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held = Words(), {}

        def spelled() -> Iterator[pa.RecordBatch]:
            spelling = pa.array(list(words.places), pa.large_binary()).cast(pa.large_string())
            for lang, parts in held.items():
                leaf, n, first = distinct_rows(*(np.concatenate(x) for x in list(zip(*parts))[:2]))
                where = (np.concatenate([p[2] for p in parts])[first] % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                block, at = np.unique(where[order], return_index=True)
                ends = pa.array(np.append(at, len(order)), pa.int32())
                leaves = joined_words(leaf[order], spelling).cast(pa.string())
                columns = [pa.array([lang] * len(block), pa.string()), pa.array(block, pa.int64()), pa.ListArray.from_arrays(ends, leaves), pa.ListArray.from_arrays(ends, pa.array(n[order]))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "range", "leaves", "counts"])
            held.clear()

        for lang, numbers in runs(batches, words):
            if numbers is None or sum(len(p[1]) for parts in held.values() for p in parts) > HELD_LEAVES:
                yield from spelled()
            if numbers is None:
                continue
            found = known.runs(lang, numbers, words.hashed(), longest)
            hashed, begins = next(found)
            at = np.flatnonzero(begins)
            leaf = np.full((len(at), longest), NO_WORD, np.int32)
            leaf[:, 0], last = numbers[at], hashed[at]
            for k, (hashed, fits) in enumerate(found, 1):
                on = fits[at]
                leaf[on, k] = numbers[at[on] + k]
                last[on] = hashed[at[on]]
            leaf, n, first = distinct_rows(leaf, np.ones(len(leaf), np.int64))
            held.setdefault(lang, []).append((leaf, n, last[first]))
        yield from spelled()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, Counter()

        def summed_up() -> pa.RecordBatch:
            columns = [pa.array([x[0] for x in total], pa.string()), pa.array([x[1] for x in total], pa.string()), pa.array(list(total.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "leaf", "n"])

        for batch in batches:
            for i, r in enumerate(batch.column(1).to_pylist()):
                if r != current and total:
                    yield summed_up()
                    total.clear()
                current, lang = r, batch.column(0)[i].as_py()
                for leaf, n in zip(batch.column(2)[i].values.to_pylist(), batch.column(3)[i].values.to_pylist()):
                    total[lang, leaf] += n
        yield summed_up()

    blocks = texts.mapInArrow(work, "lang string, range long, leaves array<string>, counts array<long>")
    dealt = blocks.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(add, "lang string, leaf string, n long")


def distinct_rows(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order, each once, with the sums of ``n`` and where a row was first."""
    if not len(rows):
        return rows, n, np.zeros(0, np.int64)
    order = np.lexsort(rows.T[::-1])
    rows, n = rows[order], n[order]
    first = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    return rows[first], np.add.reduceat(n, np.flatnonzero(first)), order[first]


def joined_words(rows: np.ndarray, words: pa.Array) -> pa.Array:
    """The words of each row, up to its first ``NO_WORD``, joined by spaces."""
    sizes = (rows != NO_WORD).sum(axis=1)
    flat = words.take(pa.array(rows[rows != NO_WORD], pa.int64()))
    lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), flat)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def head(leaf: Column | str, n: int) -> Column:
    """The first ``n`` words of a leaf, or all."""
    return F.substring_index(leaf, " ", n)


def partitioned(leaves: DataFrame, longest: int, group: int) -> tuple[DataFrame, DataFrame]:
    """Vertical partitioning: leaves with the number of their group, and the prefixes that had to be extended, with their counts.

    ``leaves`` should be a written table. A prefix of full length is one leaf, so extending always ends. A leaf goes with
    its shortest prefix that has at most ``group`` leaves (``depth`` words). Prefixes are dealt to range partitions, and within one they fill one
    group after the other by the running number of their leaves.
    """
    todo, placed, above = leaves, [], []
    for depth in range(1, longest + 1):
        cut = todo.withColumn("prefix", head("leaf", depth))
        sizes = settle(cut.groupBy("lang", "prefix").agg(F.count(F.lit(1)).alias("leaves"), F.sum("n").alias("n")))
        fits = sizes.where(F.col("leaves") <= group)
        dealt = settle(fits.repartitionByRange("lang", "prefix").withColumn("part", F.spark_partition_id()))
        upto = Window.partitionBy("part").orderBy("lang", "prefix").rowsBetween(Window.unboundedPreceding, -1)
        number = F.floor(F.coalesce(F.sum("leaves").over(upto), F.lit(0)) / F.lit(group)).cast("long")
        groups = dealt.select("lang", "prefix", F.struct(F.lit(depth).alias("depth"), "part", number.alias("number")).alias("group"))
        placed.append(cut.join(groups, ["lang", "prefix"]).select("group", "lang", "leaf", "n"))
        large = sizes.where(F.col("leaves") > group)
        if large.isEmpty():
            break
        above.append(large.select("lang", F.col("prefix").alias("phrase"), F.lit(depth).alias("words"), "n"))
        todo = settle(cut.join(large.select("lang", "prefix"), ["lang", "prefix"], "left_semi").drop("prefix"))
    nothing = leaves.limit(0).select("lang", F.col("leaf").alias("phrase"), F.lit(0).alias("words"), "n")
    return reduce(DataFrame.unionByName, placed), reduce(DataFrame.unionByName, above, nothing)


def subtree(table: pa.Table, least: int) -> pa.Table:
    """Nodes with ``least`` occurrences or more of the subtree of one group's leaves."""
    depth = table.column("group")[0].as_py()["depth"]
    langs = table.column("lang").combine_chunks().dictionary_encode()
    lists = pc.split_pattern(table.column("leaf").combine_chunks().cast(pa.large_string()), " ")
    sizes = pc.list_value_length(lists).to_numpy()
    words = lists.flatten().dictionary_encode()
    longest = int(sizes.max())
    rows = np.full((len(sizes), 1 + longest), NO_WORD, np.int64)
    rows[:, 0] = langs.indices.to_numpy()
    rows[:, 1:][np.arange(longest) < sizes[:, None]] = words.indices.to_numpy()
    rows, n, _ = distinct_rows(rows, table.column("n").to_numpy())
    out, changed = [], np.zeros(len(rows), bool)
    changed[0] = True
    changed[1:] = rows[1:, 0] != rows[:-1, 0]
    for k in range(1, longest + 1):
        changed[1:] |= rows[1:, k] != rows[:-1, k]
        firsts = np.flatnonzero(changed)
        totals = np.add.reduceat(n, firsts)
        nodes = firsts[(totals >= least) & (rows[firsts, k] != NO_WORD)]
        if k < depth or not len(nodes):
            continue
        columns = [
            langs.dictionary.take(pa.array(rows[nodes, 0])),
            joined_words(rows[nodes, 1 : k + 1], words.dictionary).cast(pa.string()),
            pa.array(np.full(len(nodes), k), pa.int32()),
            pa.array(totals[(totals >= least) & (rows[firsts, k] != NO_WORD)]),
        ]
        out.append(pa.table(columns, names=["lang", "phrase", "words", "n"]))
    kinds = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])
    return pa.concat_tables(out) if out else kinds.empty_table()


def frequent(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, group: int = GROUP, slots: int = SLOTS
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of all phrases of 1 to ``longest`` words that occur ``least`` times, and ``lang, n`` of all words.

    Both are written tables; jobs run while they are built. Words are lower-cased (A-Z) runs of anything but space and tab, within
    the pieces that punctuation and line ends leave; a null text is empty, a null language is ``und``.
    """
    need(docs, text, lang)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), whole_text(text).alias("text"))
    stop = min(least, np.iinfo(np.uint16).max // 2)
    ranges = min(RANGES, max(1, slots // 8))
    first = settle(sketched(texts, Filter(), range(1, 3), stop, slots, ranges))
    sizes = settle(first.where("lang is not null").groupBy("lang").agg(F.sum("n").alias("n")))
    known = Filter(summed(first, stop, slots, ranges))
    if longest > 2:
        second = settle(sketched(texts, known, range(3, longest + 1), stop, slots, ranges))
        known = Filter(known.allowed[0], summed(second, stop, slots, ranges))
    n_words = sizes.agg(F.sum("n")).first()[0] or 0
    leaves = settle(suffixes(texts, known, longest, max(RANGES, n_words // PER_RANGE)))
    grouped, above = partitioned(leaves, longest, group)
    nodes = grouped.groupBy("group").applyInArrow(lambda t: subtree(t, least), "lang string, phrase string, words int, n long")
    return settle(nodes.unionByName(above.where(F.col("n") >= least))), sizes


def scored(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of every phrase of two or more words.

    Of all ways to cut a phrase in two, the one with the lowest score counts, and of equal ones the first.
    """
    split = F.split("phrase", " ")
    cuts = nodes.where("words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "words", F.col("n").alias("a"), "k", F.concat_ws(" ", F.slice(split, F.lit(1), F.col("k"))).alias("left"), F.concat_ws(" ", F.slice(split, F.col("k") + 1, F.col("words") - F.col("k"))).alias("right"))
    lefts = nodes.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = nodes.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    full = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(sizes, "lang")
    wide = {c: F.col(c).cast("decimal(38,0)").alias(c) for c in ("a", "n", "l", "r")}
    score = full.select("lang", "phrase", "words", "a", "l", "r", "n", "k", F.struct(*wide.values()).alias("w"))
    score = score.withColumn("score", F.expr("(1000BD * w.a * w.n) div (w.l * w.r)"))
    best = score.groupBy("lang", "phrase").agg(F.min_by(F.struct("words", "a", "l", "r", "n", "score"), F.struct("score", "k")).alias("best"))
    return best.select("lang", "phrase", "best.*")


def free_standing(rows: DataFrame, share: int) -> DataFrame:
    """Rows of ``scored`` without those that a longer phrase stands for.

    A phrase one word longer occurs at least as often as any longer one around it, so the next length decides.
    """
    split = F.split("phrase", " ")
    inner = F.array(F.slice(split, F.lit(1), F.col("words") - 1), F.slice(split, F.lit(2), F.col("words") - 1))
    parts = rows.where("words > 2").select("lang", F.explode(inner).alias("part"), F.col("a").alias("of"))
    most = parts.select("lang", F.concat_ws(" ", "part").alias("phrase"), "of").groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    return rows.join(most, ["lang", "phrase"], "left").where(F.col("of").isNull() | (F.lit(100) * F.col("of") < F.lit(share) * F.col("a"))).drop("of")


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    share: int = SHARE,
    top: int | None = TOP,
    group: int = GROUP,
    slots: int = SLOTS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of every language (all without ``top``).

    The order is by score, then occurrences, both descending, then phrase by its UTF-8 bytes. A null text has no words, a null
    language is ``und``, texts are whole, rows that repeat count as often as they are there; an empty table gives an empty result. Other
    columns are not looked at, whatever their names. Without ``top`` ``rank`` is left out, because ranking all of a language would take one task.
    """
    nodes, sizes = frequent(docs, text=text, lang=lang, least=least, longest=longest, group=group, slots=slots)
    rows = free_standing(settle(scored(nodes, sizes)), share)
    out = ["phrase", "a", "l", "r", "n", "score"]
    if top is None:
        return rows.select("lang", *out)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), *out)


PHRASE_SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), lists as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), sizes as (
  select lang, sum(len(w))::bigint as n from lists group by lang
), grams as (
  select lang, len as words, unnest(list_transform(range(1, len(w) - len + 2), lambda i: list_aggregate(w[i:i + len - 1], 'string_agg', ' '))) as phrase
  from lists, (select unnest(range(1, {LONGEST + 1})) as len)
  where len(w) >= len
), nodes as materialized (
  select lang, words, phrase, count(*)::bigint as a from grams group by all having count(*) >= {LEAST}
), cuts as (
  select lang, phrase, words, a, string_split(phrase, ' ') as w, unnest(range(1, words)) as k from nodes where words > 1
), scored as (
  select c.lang, c.phrase, c.words, c.a, l.a as l, r.a as r, s.n, c.k,
    (1000::hugeint * c.a * s.n // (l.a::hugeint * r.a))::bigint as score
  from cuts c
  join nodes l on l.lang = c.lang and l.phrase = list_aggregate(c.w[1:k], 'string_agg', ' ')
  join nodes r on r.lang = c.lang and r.phrase = list_aggregate(c.w[k + 1:], 'string_agg', ' ')
  join sizes s on s.lang = c.lang
), best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_ as (
  select lang, a, unnest(list_transform(list_filter(list_transform(range(0, words * words), lambda x: [x // words + 1, x % words + 1]),
    lambda p: p[2] > p[1] and p[2] - p[1] + 1 < words), lambda p: list_aggregate(string_split(phrase, ' ')[p[1]:p[2]], 'string_agg', ' '))) as phrase
  from nodes where words > 2
), free as (
  select * from best b where not exists (select 1 from inner_ i where i.lang = b.lang and i.phrase = b.phrase and 100 * i.a >= {SHARE} * b.a)
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from free qualify rank <= {TOP}
"""
