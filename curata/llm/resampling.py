"""Importance resampling towards a target: documents drawn by how much likelier the target makes their word n-grams.

A document's weight is the sum of its n-grams' gains, scored as arrays; noise drawn from its key makes the largest scores a
sample by weight. The cutoff score is found by selection, not by a sort: every task gives the median of the keys it still holds,
the median of those medians, weighted by how many keys each stands for, splits the keys, and at least a fixed share of them
lies on the side that cannot hold the cutoff. Only the rows above the cutoff are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from curata.llm import hashed_ngrams
from curata.llm.texts import need, whole_text
from curata.operators.scan import numbered
from curata.session import settle

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Keys whose median is taken at once; a task's medians are combined to one.
PORTION = 1 << 17
#: So many keys that remain are settled on the driver.
FEW = 4096
#: The keys are written anew when so small a part of them remains.
SHRUNK = 8


def bucket_counts(texts: DataFrame, *, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How often every bucket is hit by the n-grams of all texts; a job whose result has a row for each bucket at most."""
    need(texts, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found, _ in hashed_ngrams.of_texts(batch.column(0), buckets, longest):
                total += np.bincount(found, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    per_task = texts.select(whole_text(text).alias("text")).mapInArrow(work, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log of how much likelier the target makes each bucket, rounded down; every bucket counts one more."""
    n = len(source)
    grown, least = float(int(source.sum()) + n), float(int(target.sum()) + n)
    ratios = ((float(t + 1) * grown) / (float(s + 1) * least) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighed(
    docs: DataFrame, gain: np.ndarray, *, text: str = "text", key: str = "doc_id", longest: int = LONGEST
) -> DataFrame:
    """``key, n_words, n_features, weight`` of every row, whole texts."""
    need(docs, text, key)
    buckets, values = len(gain), gain.astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for first, rows, row, found, per_row in hashed_ngrams.of_texts(batch.column(1), buckets, longest):
                words[first : first + rows] += per_row
                features[first : first + rows] += np.bincount(row, minlength=rows)
                np.add.at(weight, first + row, values[found])
            columns = [batch.column(0), pa.array(words), pa.array(features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "n_features", "weight"])

    given = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return given.mapInArrow(work, f"key {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of a digest of seed and key (a null key is an empty one)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


PLACE = ("down", "unkeyed", "key", "n_features")


def placed(rows: DataFrame) -> DataFrame:
    """Rows with their place in the order of the draw: score descending, key ascending, null keys last."""
    return rows.withColumns({"down": -F.col("score"), "unkeyed": F.col("key").isNull()})


def _weighted_median(sizes: list[int], order: list[int]) -> int:
    """Index of the element at which half of the sizes is reached along ``order``."""
    half, seen = sum(sizes) / 2, 0
    for i in order:
        seen += sizes[i]
        if seen >= half:
            return i
    return order[-1]


def _sorted(table: pa.Table) -> np.ndarray:
    keys = [(name, "ascending") for name in PLACE]
    return pc.sort_indices(table, sort_keys=keys, null_placement="at_end").to_numpy()


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each side of the pivot, how many keys the task holds and a median of the medians of its portions."""
    held: dict[int, list[pa.RecordBatch]] = {}
    count: dict[int, int] = {}
    found: dict[int, list[tuple[int, pa.Table]]] = {}

    def close(side: int) -> None:
        table = pa.Table.from_batches(held.pop(side)).select(list(PLACE))
        middle = _sorted(table)[(table.num_rows - 1) // 2]
        found.setdefault(side, []).append((table.num_rows, table.slice(int(middle), 1)))
        count[side] = 0

    schema = None
    for batch in batches:
        schema = batch.schema
        sides = batch.column("side").to_numpy(zero_copy_only=False)
        for side in np.unique(sides).tolist():
            part = batch.filter(pa.array(sides == side))
            held.setdefault(side, []).append(part)
            count[side] = count.get(side, 0) + part.num_rows
            if count[side] >= PORTION:
                close(side)
    for side in list(held):
        close(side)
    for side, parts in found.items():
        table = pa.concat_tables(x for _, x in parts)
        sizes = [n for n, _ in parts]
        best = table.slice(_weighted_median(sizes, _sorted(table).tolist()), 1).combine_chunks().to_batches()[0]
        head = [pa.array([side], schema.field("side").type), pa.array([sum(sizes)], pa.int64())]
        yield pa.RecordBatch.from_arrays([*head, *best.columns], names=["side", "n", *PLACE])


def cutoff(rows: DataFrame, draw: int):
    """The place of the row at position ``draw`` (from 1), by discarding what cannot hold it; ``None`` if there is none.

    ``rows`` (columns of ``PLACE``) should be a written table: each round reads what remains of it. A round brings one
    row per task and side to the driver. Of the keys at least an eighth goes each time: half of the tasks, by keys, have a median of medians on
    the far side of the pivot, each a quarter of its keys beyond its own. Equal keys are one place.
    """
    if draw < 1:
        return None
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    shape = "side int, n long, " + ", ".join(f"{c} {kinds[c].simpleString()}" for c in PLACE)
    whole = F.struct(*PLACE)

    def at(row) -> Column:
        return F.struct(*[F.lit(row[c]).cast(kinds[c]).alias(c) for c in PLACE])

    left, low, high, pivot, total = rows.select(*PLACE), None, None, None, None
    while True:
        now = left
        if low is not None:
            now = now.where((F.col("down") >= low.down) & (whole > at(low)))
        if high is not None:
            now = now.where((F.col("down") <= high.down) & (whole < at(high)))
        if pivot is None:
            side = F.lit(1)
        else:
            here = at(pivot)
            side = F.when(whole < here, -1).when(whole == here, 0).otherwise(1)
        seen = now.withColumn("side", side.cast("int")).mapInArrow(_medians, shape).collect()
        sizes = {s: sum(r.n for r in seen if r.side == s) for s in (-1, 0, 1)}
        if pivot is None:
            total, remaining, half = sizes[1], sizes[1], 1
            if draw > total:
                return None
        elif draw <= sizes[-1]:
            high, remaining, half = pivot, sizes[-1], -1
        elif draw <= sizes[-1] + sizes[0]:
            return pivot
        else:
            draw -= sizes[-1] + sizes[0]
            low, remaining, half = pivot, sizes[1], 1
        medians = [r for r in seen if r.side == half]
        if remaining <= FEW:
            return _last(left, low, high, whole, at, draw)
        if remaining * SHRUNK <= total:
            kept = left
            if low is not None:
                kept = kept.where(whole > at(low))
            if high is not None:
                kept = kept.where(whole < at(high))
            left, total = settle(kept), remaining
        order = sorted(range(len(medians)), key=lambda i: _order(medians[i]))
        pivot = medians[_weighted_median([m.n for m in medians], order)]


def _order(row) -> tuple:
    return tuple((row[c] is None, 0 if row[c] is None else row[c]) for c in PLACE)


def _last(left: DataFrame, low, high, whole: Column, at, draw: int):
    """Of the at most ``FEW`` keys that remain, the one at ``draw``."""
    if low is not None:
        left = left.where(whole > at(low))
    if high is not None:
        left = left.where(whole < at(high))
    return sorted(left.collect(), key=_order)[draw - 1]


def resampled(
    docs: DataFrame,
    target: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``key, n_features, weight, score, rank`` of every row of ``docs``; runs jobs while it is built.

    ``percent`` of the rows with at least ``least`` words, rounded down, have a rank, from 1 along score descending, then key
    ascending (a null key last), then fewer features; rows equal in all of these take ranks in any order. A null text is an empty one: no
    features, weight 0, never drawn. Texts are whole, very long ones go through memory in slices; rows that repeat a key are
    scored and ranked as rows. An empty ``docs`` gives an empty result, an empty ``target`` weighs every feature by its rarity in
    ``docs``. Other columns are not looked at, whatever their names.
    """
    need(docs, text, key)
    sizes = {"buckets": buckets, "longest": longest}
    gain = gains(bucket_counts(docs, text=text, **sizes), bucket_counts(target, text=text, **sizes))
    scored = weighed(docs, gain, text=text, key=key, longest=longest)
    rows = settle(placed(scored.withColumn("score", F.col("weight") + noise(F.col("key"), seed))))
    long_enough = rows.where(F.col("n_words") >= least)
    draw = percent * long_enough.count() // 100
    last = cutoff(long_enough, draw)
    out = [F.col("key").alias(key), "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    kinds = {c: rows.schema[c].dataType for c in PLACE}
    inside = F.struct(*PLACE) <= F.struct(*[F.lit(last[c]).cast(kinds[c]).alias(c) for c in PLACE])
    won = (F.col("n_words") >= least) & inside
    rank = F.when(F.col("at") < draw, F.col("at") + 1)
    winners = numbered(rows.where(won), list(PLACE), "at").select(*out, rank.alias("rank"))
    return rows.where(~won).select(*out, F.lit(None).cast("long").alias("rank")).unionByName(winners)


RESAMPLING_SQL = rf"""
with tables as materialized (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as tab
), texts as (
  select 0 as side, row_number() over () as row, doc_id as id, text from documents
  union all select 1, row_number() over (), null, text from benchmark
), words as (
  select side, row, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from texts
), grams as (
  select side, row, unnest(list_concat(
    w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as gram
  from words
), counted as materialized (
  select side, row, gram, count(*) as n from grams group by all
), hexed as (
  select gram, hex(encode(gram)) as h from (select distinct gram from counted)
), hashed as materialized (
  select gram, xor(list_reduce(
      list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % {BUCKETS} as bucket
  from hexed, tables
), hits as materialized (
  select side, row, bucket, sum(n)::bigint as n from counted join hashed using (gram) group by all
), sums as (
  select bucket, coalesce(sum(n) filter (side = 0), 0)::bigint as s, coalesce(sum(n) filter (side = 1), 0)::bigint as t
  from hits group by bucket
), gained as (
  select bucket, floor(1000 * ln(((t + 1)::double * ((sum(s) over ())::bigint + {BUCKETS})::double)
    / ((s + 1)::double * ((sum(t) over ())::bigint + {BUCKETS})::double)))::bigint as gain
  from sums
), weighed as (
  select row, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight from hits join gained using (bucket) where side = 0 group by row
), scored as (
  select id as doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from words left join weighed using (row) where side = 0
), ranked as (
  select *, row_number() over (partition by n_words >= {LEAST_WORDS} order by score desc, doc_id nulls last, n_features) as place,
    count(*) filter (n_words >= {LEAST_WORDS}) over () as n
  from scored
)
select doc_id, n_features::bigint as n_features, weight, score,
  case when n_words >= {LEAST_WORDS} and place <= {PERCENT} * n // 100 then place end as rank
from ranked
"""
