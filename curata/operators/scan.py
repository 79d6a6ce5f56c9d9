"""Ordered scans that split hot keys over time.

A window over a whole key puts every row of that key into one task. An ordered scan cuts each
key into chunks along its order (a time bucket, a value bucket), runs the window inside
(key, chunk) and brings over what earlier or later chunks contribute from a summary with one row
per (key, chunk). The summary is pre-aggregated before its shuffle and its size per key is the
number of chunks, not the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from curata.session import dealt, once, settle

CHUNK = "__chunk"
#: A hash of key and chunk: what rows are dealt to tasks by.
SPOT = "__spot"

Exprs = Mapping[str, Column] | None


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    *,
    before: Exprs = None,
    upto: Exprs = None,
    after: Exprs = None,
    onward: Exprs = None,
    running: Exprs = None,
    total: Exprs = None,
) -> DataFrame:
    """Add columns that look along ``order`` within ``keys``.

    ``before`` / ``upto``: the latest non-null value of the expression in earlier rows, without or
    with the current one. ``after`` / ``onward``: the earliest non-null one in later rows.
    ``running``: the sum up to and including the current row; ``total``: the sum over the key. To see
    nulls of a neighbour, pass a struct. ``order`` must be total within a key and ``chunk`` must never fall along it. A null key is a
    key like others; a null place comes before all others, and its chunk must be null. Rows are dealt to tasks by their number, so that a task's
    windows do not grow with the table; runs a job that counts them.
    """
    back = [("before", n, e) for n, e in (before or {}).items()]
    back += [("upto", n, e) for n, e in (upto or {}).items()]
    forth = [("after", n, e) for n, e in (after or {}).items()]
    forth += [("onward", n, e) for n, e in (onward or {}).items()]
    sums = [("running", n, e) for n, e in (running or {}).items()]
    whole = [("total", n, e) for n, e in (total or {}).items()]
    asked = back + forth + sums + whole
    value = {n: f"__v_{n}" for _, n, _ in asked}

    df = once(df)
    rows = df.count()
    work = df.withColumn(CHUNK, chunk)
    work = work.withColumns({value[n]: e for _, n, e in asked})
    spot = F.xxhash64(*keys, CHUNK).alias(SPOT)

    place = F.struct(*order)  # a struct also of one column: a null place is still a place, before all others
    summary = work.groupBy(*keys, CHUNK).agg(
        *[F.max_by(value[n], F.when(F.col(value[n]).isNotNull(), place)).alias(n) for _, n, _ in back],
        *[F.min_by(value[n], F.when(F.col(value[n]).isNotNull(), place)).alias(n) for _, n, _ in forth],
        *[F.sum(value[n]).alias(n) for _, n, _ in sums + whole],
    )
    over_earlier = Window.partitionBy(*keys).orderBy(F.asc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    over_later = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    carry = (dealt(summary, rows, *keys) if keys else summary).select(
        *keys,
        CHUNK,
        spot,
        *[F.last(n, ignorenulls=True).over(over_earlier).alias(f"__c_{n}") for _, n, _ in back],
        *[F.sum(n).over(over_earlier).alias(f"__c_{n}") for _, n, _ in sums],
        *[F.last(n, ignorenulls=True).over(over_later).alias(f"__c_{n}") for _, n, _ in forth],
        *[F.sum(n).over(Window.partitionBy(*keys)).alias(f"__c_{n}") for _, n, _ in whole],
    )

    work = dealt(work.select("*", spot), rows, SPOT)
    forward = Window.partitionBy(SPOT, *keys, CHUNK).orderBy(*[F.asc(o) for o in order])
    backward = Window.partitionBy(SPOT, *keys, CHUNK).orderBy(*[F.desc(o) for o in order])
    local = {}
    for kind, name, _ in back + forth + sums:
        frame = forward if kind in ("before", "upto", "running") else backward
        frame = frame.rowsBetween(Window.unboundedPreceding, -1 if kind in ("before", "after") else 0)
        source = F.col(value[name])
        seen = F.sum(source) if kind == "running" else F.last(source, ignorenulls=True)
        local[name] = seen.over(frame)
    scanned = work.select(*df.columns, CHUNK, SPOT, *[c.alias(f"__l_{n}") for n, c in local.items()])

    # Only the hash is a key of the join, so that the rows stay as they were dealt and sorted; what shares it is told apart by a comparison.
    sides = [*keys, CHUNK]
    carry = carry.withColumnsRenamed({c: f"__r_{c}" for c in (*sides, SPOT)})
    theirs = F.struct(*[F.col(f"__r_{c}") for c in sides])
    same = F.struct(*sides).between(theirs, theirs)
    joined = scanned.join(carry, (F.col(SPOT) == F.col(f"__r_{SPOT}")) & same, "left")
    merged = []
    for kind, name, _ in asked:
        brought = F.col(f"__c_{name}")
        if kind == "total":
            merged.append(brought.alias(name))
            continue
        own = F.col(f"__l_{name}")
        if kind == "running":
            merged.append((F.coalesce(own, F.lit(0)) + F.coalesce(brought, F.lit(0))).alias(name))
        else:
            merged.append(F.coalesce(own, brought).alias(name))
    return joined.select(*df.columns, *merged)


def numbered(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``df`` with its place, from 0, along ``order``, which must be total.

    Rows are sorted in range partitions and written once; a place is that in the partition plus the sizes of the
    partitions before, which are one row each.
    """
    sorted_rows = settle(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    placed = sorted_rows.select(
        *df.columns,
        F.shiftright("__at", 33).alias("__part"),
        F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)).alias("__local"),
    )
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    return placed.join(F.broadcast(offsets), "__part").select(*df.columns, (F.col("__local") + F.col("__offset")).alias(name))
