"""Mixing sources to target weights by repetition rates.

Words are summed per source, each source gets a target share of all words, and the repetition rate of a source is
target over size. A document comes out floor(rate) times, plus once more if a number drawn from its id by a seeded
hash falls below the fraction of the rate. No document is drawn against another one, so reruns and retried tasks agree
and no order or state is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from curata.llm.texts import free_name, need, word_count
from curata.session import settle

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20240601

_EXACT = "decimal(18,0)"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size`` (one row per source) with ``weight``, ``target`` and ``rate``.

    Weights go round the sources in the order of their code points, null last. Targets share the sum of all sizes by
    weight; one above ``most`` times its source's size stops there and the excess is shared again by weight among the
    rest. Sources in the order of size over weight are stopped one after the other until one is not, which settles the
    rest; comparisons are made in whole numbers. A source without words has target and rate 0. The windows run
    over one row per source.
    """
    unit = 1
    for w in set(weights):
        unit *= w
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")))
    order = Window.orderBy((F.col("source_size") * (F.lit(unit) / F.col("weight")).cast("long")), F.col("source").isNull(), "source")
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    size, weight = F.col("source_size"), F.col("weight")
    total = F.sum("source_size").over(everywhere)
    left = weighed.withColumns(
        {
            "left": total - F.coalesce(F.sum(size * most).over(earlier), F.lit(0)),
            "left_weight": F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)),
        }
    )
    stopped = left.withColumn(
        "stopped",
        (size * most).cast(_EXACT) * F.col("left_weight").cast(_EXACT) <= F.col("left").cast(_EXACT) * weight.cast(_EXACT),
    )
    first = F.first(F.when(~F.col("stopped"), F.struct("left", "left_weight")), ignorenulls=True).over(everywhere)
    shared = stopped.withColumn("first", first)
    target = F.when(F.col("stopped"), (size * most).cast("double")).otherwise(
        weight.cast("double") * F.col("first.left").cast("double") / F.col("first.left_weight").cast("double")
    )
    return shared.select(
        "source",
        "source_size",
        "weight",
        target.alias("target"),
        F.when(size > 0, target / size).otherwise(F.lit(0.0)).alias("rate"),
    )


def draw(key: Column, seed: int = SEED) -> Column:
    """A number from 0 up to 1 that depends on seed and key only: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def copies(rate: Column, key: Column, seed: int = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw(key, seed) < rate - whole, 1).otherwise(0)).cast("long")


def mixture(
    docs: DataFrame,
    *,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``key, size, source_size, target, copies, taken``.

    Sizes are words. A null text has size 0, a null source is a source of its own, rows that repeat a key are drawn
    alike, an empty table gives an empty result; other columns are not looked at. Texts never move: the sizes are
    written once, and the table of sources, written too, is so small that Spark sends it to the rows.
    """
    need(docs, text, source, key)
    sized = settle(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = settle(source_targets(sizes, weights, most)).withColumnRenamed("source", "of")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("of")), "inner")
    n = copies(F.col("rate"), F.col("key"), seed)
    return rows.select(
        F.col("key").alias(key), "size", "source_size", "target", n.alias("copies"), (F.col("size") * n).alias("taken")
    )


def mixed(docs: DataFrame, *, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mixture itself: rows of ``docs`` as often as they are taken, columns unchanged.

    A document with 0 copies is left out. Only the table of sources meets the texts.
    """
    need(docs, text, source, key)
    weights, most, seed = options.get("weights", WEIGHTS), options.get("most", MOST), options.get("seed", SEED)
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(word_count(text)).alias("source_size"))
    of, rate, n = (free_name(x, docs) for x in ("__of", "__rate", "__copy"))
    rates = settle(source_targets(sizes, weights, most).select(F.col("source").alias(of), F.col("rate").alias(rate)))
    rows = docs.join(rates, docs[source].eqNullSafe(F.col(of)), "inner")
    times = F.sequence(F.lit(1).cast("long"), copies(F.col(rate), docs[key], seed))
    taken = rows.where(copies(F.col(rate), docs[key], seed) > 0)
    return taken.withColumn(n, F.explode(times)).select(*[docs[c] for c in docs.columns])


MIXING_SQL = rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from {{documents}}
), per as (select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select *, (array[{", ".join(map(str, WEIGHTS))}])[((row_number() over (order by source is null, source)) - 1) % {len(WEIGHTS)} + 1] as weight
  from per
), ordered as (
  select *,
    (sum(source_size) over ())::hugeint - coalesce(sum(source_size * {MOST}) over earlier, 0)::hugeint as rest,
    (sum(weight) over ())::hugeint - coalesce(sum(weight) over earlier, 0)::hugeint as rest_weight
  from weighed
  window earlier as (order by source_size * (10 // weight), source is null, source rows between unbounded preceding and 1 preceding)
), stopped as (
  select *, source_size::hugeint * {MOST} * rest_weight <= rest * weight as stop from ordered
), level as (select rest, rest_weight from stopped where not stop order by rest_weight desc limit 1
), targets as (
  select source, source_size,
    case when stop then (source_size * {MOST})::double
      else weight::double * (select rest from level)::double / (select rest_weight from level)::double end as target
  from stopped
), rated as (
  select d.doc_id, d.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
    ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::varchar, 'null')), 1, 13))::ubigint::double / 4503599627370496.0 as u
  from sized d join targets t on d.source is not distinct from t.source
)
select doc_id, size::bigint as size, source_size, target,
  (size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end))::bigint as taken
from rated
"""
