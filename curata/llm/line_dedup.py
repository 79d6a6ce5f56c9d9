"""Line dedup by winnowing over line hashes.

A run of lines of ``least`` words or more that stands earlier too, in another document or the same one, is deleted where it is later. Every line
begins a window: the shortest run from it that has ``least`` words. Of each window the smallest line hash is kept
as a fingerprint (the rightmost of equals), so two documents that share such a run share a fingerprint in it, at the same
place. Only the surroundings of fingerprints that occur more than once are looked at again: matches are extended both
ways over the windows that begin and that end at each line there, each window is linked to its first occurrence (never to all
others), and the windows that are not first make up the later runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from curata.llm.texts import free_name, need, whole_text
from curata.session import settle

LEAST = 50
DIGEST = 16


def sketch(text: str) -> tuple[bytes, list[int]]:
    """The digests of the lines after one another, and the words of each line. White space around a line does not count."""
    lines = text.encode().split(b"\n")
    return b"".join(xxhash.xxh3_128_digest(x.strip()) for x in lines), [len(x.split()) for x in lines]


def windows_from(words: Sequence[int], least: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest run of lines from each line that has ``least`` words."""
    out, end, total = [], 0, 0
    for start in range(len(words)):
        while end < len(words) and total < least:
            total += words[end]
            end += 1
        if total < least:
            break
        out.append((start, end - 1))
        total -= words[start]
    return out


def windows_to(words: Sequence[int], least: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest run of lines up to each line that has ``least`` words."""
    n = len(words)
    return [(n - 1 - b, n - 1 - a) for a, b in windows_from(words[::-1], least)]


def picks(digests: bytes, words: Sequence[int], least: int) -> list[int]:
    """Positions of the smallest line hash of each window, the rightmost of equals."""
    found, queue, done = [], [], 0
    head = 0
    for start, end in windows_from(words, least):
        while done <= end:  # a queue of lines with rising hashes
            mine = digests[done * DIGEST : done * DIGEST + 8]
            while len(queue) > head and queue[-1][0] >= mine:
                queue.pop()
            queue.append((mine, done))
            done += 1
        while queue[head][1] < start:
            head += 1
        if not found or found[-1] != queue[head][1]:
            found.append(queue[head][1])
    return found


def matched_windows(digests: bytes, words: Sequence[int], at: Sequence[int], least: int) -> list[tuple[bytes, int, int]]:
    """(digest, first, last) of the windows from and to each line that hold one of the positions ``at``."""
    held = [0] * (len(words) + 1)
    for p in at:
        held[p + 1] = 1
    for i in range(len(words)):
        held[i + 1] += held[i]
    both = {w for w in windows_from(words, least) + windows_to(words, least) if held[w[1] + 1] > held[w[0]]}
    return [(xxhash.xxh3_128_digest(digests[a * DIGEST : (b + 1) * DIGEST]), a, b) for a, b in sorted(both)]


def merged(runs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that meet or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def later_runs(docs: DataFrame, *, text: str = "text", key: str = "doc_id", least: int = LEAST) -> DataFrame:
    """``k, d, runs``: the runs of lines to delete, ``array<struct<first, last>>``, for documents that have any.

    ``k`` is the place of the key: whether it is null, and the key, of any type that can be ordered; ``d`` is a hash of the text. Documents are in the
    order of ``k, d``; rows equal in both are one document.
    """
    need(docs, text, key)
    place, digest = _place(docs, key).alias("k"), F.xxhash64(whole_text(text)).alias("d")
    kind = docs.select(place).schema["k"].dataType.simpleString()
    rows = docs.select(place, digest, whole_text(text).alias("t"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(2):
                digests, words = sketch(t.as_py())
                kept = picks(digests, words, least)
                hashes = [int.from_bytes(digests[p * DIGEST : p * DIGEST + 8], "big", signed=True) for p in kept]
                out.append((digests, words, kept, hashes) if kept else (b"", [], [], []))
            ints = pa.list_(pa.int32())
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate([pa.binary(), ints, ints, pa.list_(pa.int64())])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["k", "d", "digests", "words", "at", "hashes"])

    known = rows.mapInArrow(lines, f"k {kind}, d long, digests binary, words array<int>, at array<int>, hashes array<long>")
    known = settle(known.where(F.size("at") > 0).dropDuplicates(["k", "d"]))
    picked = known.select("k", "d", F.explode(F.arrays_zip("at", "hashes")).alias("p")).select("k", "d", "p.at", F.col("p.hashes").alias("hash"))
    shared = settle(picked.groupBy("hash").count().where("count > 1").select("hash"))
    places = picked.join(shared, "hash").groupBy("k", "d").agg(F.collect_set("at").alias("places"))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, d, digests, words, at in zip(*(batch.column(i) for i in range(5))):
                found = matched_windows(digests.as_py(), words.as_py(), at.as_py(), least)
                columns = [pa.repeat(x, len(found)) for x in (k, d)]
                columns += [pa.array([w[i] for w in found], kind) for i, kind in enumerate([pa.binary(), pa.int32(), pa.int32()])]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "d", "window", "first", "last"])

    near = known.join(places, ["k", "d"]).select("k", "d", "digests", "words", "places")
    found = settle(near.mapInArrow(around, f"k {kind}, d long, window binary, first int, last int").distinct())
    firsts = found.groupBy("window").agg(F.min(F.struct("k", "d", "first", "last")).alias("source"), F.count("*").alias("n"))
    firsts = settle(firsts.where("n > 1").select("window", "source"))  # so that the join below can split a frequent window
    mine = F.struct("k", "d", "first", "last")
    later = found.join(firsts, "window").where(mine != F.col("source"))
    own = (F.col("k") == F.col("source.k")) & (F.col("d") == F.col("source.d"))
    begin = F.when(own, F.greatest(F.col("first"), F.col("source.last") + 1)).otherwise(F.col("first"))
    spans = later.select("k", "d", begin.alias("first"), "last").where("first <= last")
    gathered = spans.groupBy("k", "d").agg(F.collect_set(F.struct("first", "last")).alias("runs"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [[{"first": a, "last": b} for a, b in merged([(r["first"], r["last"]) for r in x.as_py()])] for x in batch.column(2)]
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, kind)], names=["k", "d", "runs"])

    return gathered.mapInArrow(joined, f"k {kind}, d long, runs array<struct<first: int, last: int>>")


def _place(docs: DataFrame, key: str) -> Column:
    """Null keys are equal and come last, also in a join."""
    kind = docs.schema[key].dataType
    blank = {T.StringType(): F.lit(""), T.BinaryType(): F.lit(b"")}.get(kind, F.lit(0)).cast(kind)
    return F.struct(F.col(key).isNull().alias("none"), F.coalesce(F.col(key), blank).alias("key"))


def deduplicated(docs: DataFrame, *, text: str = "text", key: str = "doc_id", least: int = LEAST) -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``n_lines, n_removed, removed`` (the deleted runs, as line numbers from 0).

    Columns of ``docs`` that have one of the three names, in whatever case, are replaced. Key and text hash order the documents: a null key comes last,
    rows equal in both are one document and lose nothing to each other. A null text stays null and has 0 lines; an empty one has one
    line; a document without ``least`` words keeps all lines, however often they occur. What repeats within one document, also
    overlapping itself, keeps its first occurrence. An empty table stays empty. Runs jobs while it is built. Texts move once, to
    meet the runs.
    """
    need(docs, text, key)
    k, d, r = (free_name(x, docs) for x in ("__k", "__d", "__runs"))
    runs = settle(later_runs(docs, text=text, key=key, least=least)).toDF(k, d, r)
    # said to Spark, because the runs grow with the texts: broadcast on small tables, they would not be on large ones
    met = docs.join(runs.hint("merge"), (_place(docs, key) == F.col(k)) & (F.xxhash64(whole_text(text)) == F.col(d)), "left")
    lines = F.split(docs[text], "\n", -1)
    inside = lambda i: F.exists(r, lambda x: (x["first"] <= i) & (x["last"] >= i))
    rest = F.array_join(F.filter(lines, lambda _, i: ~inside(i)), "\n")
    length = F.aggregate(r, F.lit(0), lambda n, x: n + x["last"] - x["first"] + 1)
    new = {
        "n_lines": F.when(docs[text].isNull(), 0).otherwise(F.char_length(docs[text]) - F.char_length(F.replace(docs[text], F.lit("\n"), F.lit(""))) + 1),
        "n_removed": F.when(F.col(r).isNotNull(), length).otherwise(0),
        "removed": F.coalesce(F.col(r), F.array().cast("array<struct<first: int, last: int>>")),
    }
    kept = [F.when(F.col(r).isNotNull(), rest).otherwise(docs[c]).alias(c) if c == text else docs[c] for c in docs.columns if c.lower() not in new]
    return met.select(*kept, *[c.alias(n) for n, c in new.items()])
