"""Ordered scans and the joins on them, against brute force in Python."""

import functools
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from curata import session
from curata.functions.clock import Clock
from curata.operators import asof, episodes, fills, grid, intervals, nearest
from curata.operators.scan import ordered_scan

T0 = datetime(2024, 1, 1)


def at(minutes, seconds=0):
    return T0 + timedelta(minutes=minutes, seconds=seconds)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_scan_equals_one_window_per_key(spark, width):
    rng = random.Random(width)
    # One key holds most rows and one instant repeats often.
    rows = [
        ("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 4)}", rng.choice([50, rng.randint(0, 100)]), i,
         rng.choice([None, rng.randint(0, 9)]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, t long, id long, v long")
    got = ordered_scan(
        df, ["k"], ["t", "id"], F.floor(F.col("t") / width).cast("long"),
        before={"b": F.col("v"), "lag": F.struct("v")},
        upto={"u": F.col("v")},
        after={"a": F.col("v")},
        onward={"o": F.col("v")},
        running={"n": F.lit(1), "s": F.coalesce("v", F.lit(0))},
    ).select("id", "b", "lag.v", "u", "a", "o", "n", "s")
    w = Window.partitionBy("k").orderBy("t", "id")
    past, future = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    now, on = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.select(
        "id", F.last("v", True).over(past), F.lag("v").over(w), F.last("v", True).over(now),
        F.first("v", True).over(future), F.first("v", True).over(on), F.count("*").over(now),
        F.sum(F.coalesce("v", F.lit(0))).over(now),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


LEFT = [(1, at(100), 1), (1, at(100), 2), (1, at(10), 3), (2, at(50), 4), (3, at(0), 5), (4, at(190), 6), (4, at(190, 1), 7)]
RIGHT = [
    (1, at(100), 1.0, 1), (1, at(100), 2.0, 2), (1, at(90), 3.0, 3), (2, at(51), 4.0, 4), (9, at(0), 5.0, 5),
    (4, at(100), None, 6),
]


@pytest.mark.parametrize("chunk", [5, 60, 100000])
@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
def test_asof_edges(spark, chunk, direction, exact):
    left = spark.createDataFrame(LEFT, "key long, lts timestamp_ntz, lid long")
    right = spark.createDataFrame(RIGHT, "key long, rts timestamp_ntz, v double, rid long")
    got = asof.asof_join(
        left, right, left_keys=["key"], left_time="lts", right_time="rts", tie="rid", tolerance=90, delta="d",
        direction=direction, exact=exact, chunk_minutes=chunk,
    )
    want = []
    for k, ts, lid in LEFT:
        ok = []
        for rk, rts, v, rid in RIGHT:
            gap = (rts - ts).total_seconds() / 60
            side = gap <= 0 if direction == "backward" else gap >= 0
            if rk == k and side and abs(gap) <= 90 and (exact or gap != 0):
                ok.append((abs(gap), -rid if direction == "backward" else rid, rid, v, gap))
        if ok:
            _, _, rid, v, gap = min(ok, key=lambda x: x[:2])
            want.append((lid, rid, v, gap))
    assert sorted(got.select("lid", "rid", "v", "d").collect(), key=repr) == sorted(want, key=repr)


def test_asof_on_offsets(spark):
    left = spark.createDataFrame([(1, 100), (1, 5)], "k long, t int")
    right = spark.createDataFrame([(1, 95, 7.0), (1, 101, 8.0)], "k long, o long, v double")
    got = asof.asof_join(left, right, left_keys=["k"], left_time="t", right_time="o", tolerance=90, delta="d")
    assert [tuple(r) for r in got.collect()] == [(1, 100, 95, 7.0, -5)]


def test_closest_prior_keeps_one_row_per_instant(spark):
    left = spark.createDataFrame([(1, 100, 1, "a"), (1, 100, 3, "b")], "k long, t long, rev long, x string")
    right = spark.createDataFrame([(1, 99, 1.0), (1, 99, 2.0)], "k long, o long, v double")
    got = asof.closest_prior(
        left, right, keys=["k"], left_time="t", right_time="o", left_pick="rev", tie="v", right_columns=["o", "v"]
    )
    assert [tuple(r) for r in got.collect()] == [(1, 100, 3, "b", 99, 2.0)]


WINDOWS = [(-24, 24), (-24, 0), (0, 24), (-48, -12), (6, 36), (0, 0)]


@pytest.mark.parametrize("wall", [True, False])
@pytest.mark.parametrize("chunk", [60, 1440])
def test_nearest_against_brute_force(spark, wall, chunk):
    rng = random.Random(3)
    anchors = sorted({(rng.randint(0, 2), rng.randint(0, 6000)) for _ in range(40)})
    values = [(rng.randint(0, 2), rng.randint(0, 6000), rng.randint(0, 59), rng.choice([None, rng.random()])) for _ in range(150)]
    values += [(k, t, 0, 0.25) for k, t in anchors[:5]] + [(k, t + 1440, 59, 0.75) for k, t in anchors[5:10]]
    if wall:
        left = spark.createDataFrame([(k, at(t)) for k, t in anchors], "k long, t timestamp_ntz")
        source = spark.createDataFrame([(k, at(t, s), v) for k, t, s, v in values], "k long, o timestamp_ntz, v double")
    else:
        values = [(k, t, 0, v) for k, t, _, v in values]
        left = spark.createDataFrame(anchors, "k long, t long")
        source = spark.createDataFrame([(k, t, v) for k, t, _, v in values], "k long, o long, v double")
    want = [nearest.Covariate(f"w{i}", "v", "s", "k", "o", lo, hi) for i, (lo, hi) in enumerate(WINDOWS)]
    # A copied anchor row must come back twice, an anchor without a key once with nulls.
    got = nearest.attach_covariates(left.unionAll(left.limit(1)), "t", want, {"s": source}, chunk_minutes=chunk)
    assert got.count() == len(anchors) + 1
    found = {(r["k"], r["t"]): r for r in got.collect()}
    for k, t in anchors:
        row = found[k, at(t) if wall else t]
        for i, (lo, hi) in enumerate(WINDOWS):
            best = None
            for vk, vt, s, v in values:
                gap = (vt - t) * 60 + s
                whole = int(gap / 60)
                if vk == k and v is not None and lo * 60 <= whole <= hi * 60:
                    rank = (abs(gap), gap, v)
                    if best is None or rank < best[0]:
                        best = (rank, whole, v)
            assert (row[f"delta_w{i}"], row[f"w{i}"]) == (best[1:] if best else (None, None))


def test_values_of_several_tables_keys_and_types_share_a_scan(spark):
    rng = random.Random(13)
    anchors = sorted({(rng.randint(0, 2), rng.randint(0, 4000)) for _ in range(25)})
    a = [(rng.randint(0, 2), rng.randint(0, 4000), rng.choice([None, rng.random()]), rng.choice([None, "x", "y"])) for _ in range(90)]
    b = [(rng.randint(0, 2), rng.randint(0, 4000), rng.choice([None, rng.randrange(5)])) for _ in range(60)]
    left = spark.createDataFrame([(k, k * 10, t) for k, t in anchors], "k long, k10 long, t long")
    sources = {
        "a": spark.createDataFrame(a, "k long, o long, v double, s string"),
        "b": spark.createDataFrame([(k * 10, t, n) for k, t, n in b], "k10 long, at long, n int"),
        "c": spark.createDataFrame(b, "k long, at int, n int"),
    }
    want = [
        nearest.Covariate("n10", "n", "b", "k10", "at", -10, 10), nearest.Covariate("s", "s", "a", "k", "o", -20, 0),
        nearest.Covariate("v", "v", "a", "k", "o", -6, 30), nearest.Covariate("n", "n", "c", "k", "at", 1, 24),
    ]
    got = nearest.attach_covariates(left, "t", want, sources)
    assert dict(got.dtypes) == {"k": "bigint", "k10": "bigint", "t": "bigint"} | {f"delta_{c.name}": "bigint" for c in want} | {"n10": "int", "s": "string", "v": "double", "n": "int"}
    values = {"n10": b, "n": b, "v": [(k, t, v) for k, t, v, _ in a], "s": [(k, t, s) for k, t, _, s in a]}
    for r in got.collect():
        for c in want:
            near = [(abs(t - r.t), t, x) for k, t, x in values[c.name] if k == r.k and x is not None and c.low_hours * 60 <= t - r.t <= c.high_hours * 60]
            best = min(near) if near else None
            assert (r[f"delta_{c.name}"], r[c.name]) == ((best[1] - r.t, best[2]) if best else (None, None)), (r, c)


def test_nearest_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([(1, at(0)), (None, at(0)), (2, None)], "k long, t timestamp_ntz")
    source = spark.createDataFrame([(9, at(0), 1.0)], "k long, o timestamp_ntz, v double")
    got = nearest.attach_covariates(left, "t", [nearest.Covariate("c", "v", "s", "k", "o", -1, 1)], {"s": source})
    assert got.count() == 3 and got.filter("c is not null").count() == 0


def test_fuzzy_bounds(spark):
    def h(x):
        return at(x * 60)

    rows = [
        (1, 1, h(0), h(10)), (1, 2, h(20), h(30)),  # 10 h apart: cut halfway
        (1, 3, h(54), h(60)),  # exactly 24 h after the second: padded
        (2, 4, h(0), h(10)), (2, 5, h(8), h(20)),  # overlap of 2 h
        (3, 6, h(0), h(1)),
    ]
    df = spark.createDataFrame(rows, "s long, stay long, a timestamp_ntz, b timestamp_ntz")
    for chunk in (60, 10**6):
        got = intervals.fuzzy_bounds(df, subject="s", stay="stay", start="a", end="b", chunk_minutes=chunk)
        out = {r.stay: (r.data_start, r.data_end) for r in got.collect()}
        assert out == {
            1: (h(-12), h(15)), 2: (h(15), h(42)), 3: (h(42), h(72)), 4: (h(-12), h(9)), 5: (h(9), h(32)),
            6: (h(-12), h(13)),
        }


def test_interval_join(spark):
    rows = [(1, t, t) for t in range(0, 100, 5)] + [(2, 10, 10), (1, None, 999)]
    spans = [(1, 10, 30, "a"), (1, 30, 50, "b"), (1, 25, 35, "c"), (1, 60, 60, "d"), (1, 90, 80, "bad")]
    left = spark.createDataFrame(rows, "k long, t long, id long")
    right = spark.createDataFrame(spans, "k long, s long, e long, name string")
    for closed in ("both", "left"):
        got = intervals.interval_join(
            left, right, keys=["k"], time="t", start="s", end="e", right_columns=["name"], closed=closed
        )
        want = []
        for k, t, i in rows:
            hits = [n for sk, s, e, n in spans if t is not None and sk == k and s <= t and (t < e or (closed == "both" and t == e))]
            want += [(i, n) for n in hits] or [(i, None)]
        assert sorted(map(tuple, got.select("id", "name").collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("wall", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_intervals_of_all_lengths_and_kinds(spark, wall, seed):
    rng = random.Random(seed)

    def moment(m):
        return None if m is None else at(m) if wall else m

    rows = [(rng.choice([1, 2, None]), rng.choice([None, *range(-50, 3000, 7)]), i) for i in range(150)]
    a = [(rng.choice([1, 2, 3]), b, b + rng.choice([-1, 0, 1, 2, 60, 64, 1500, 10**7]), f"a{n}") for n, b in enumerate(rng.sample(range(-60, 3000), 12))]
    b = [(rng.choice([1, 2]), s, s + rng.choice([0, 3, 300]), f"b{n}") for n, s in enumerate(rng.sample(range(0, 3000), 9))]
    b += b[:1]
    kind = "timestamp_ntz" if wall else "long"
    left = spark.createDataFrame([(k, moment(t), i) for k, t, i in rows], f"k long, t {kind}, id long")
    frames = [spark.createDataFrame([(k, moment(s), moment(e), n) for k, s, e, n in spans], f"k long, s {kind}, e {kind}, name{i} string") for i, spans in enumerate((a, b))]

    def hits(k, t, spans, half):
        found = [n for sk, s, e, n in spans if k is not None and t is not None and sk == k and s <= t and (t < e if half else t <= e)]
        return found

    kinds = [intervals.Spans(frames[0], "s", "e", ["name0"], "left"), intervals.Spans(frames[1], "s", "e", ["name1"])]
    got = intervals.attach_intervals(left, kinds, keys=["k"], time="t").select("id", "name0", "name1")
    want = [(i, x, y) for k, t, i in rows for x in hits(k, t, a, True) or [None] for y in hits(k, t, b, False) or [None]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    inner = intervals.interval_join(left, frames[0], keys=["k"], time="t", start="s", end="e", right_columns=["name0"], closed="left", how="inner")
    assert sorted((r.id, r.name0) for r in inner.collect()) == sorted((i, x) for k, t, i in rows for x in hits(k, t, a, True))
    none = intervals.interval_join(left, frames[0].limit(0), keys=["k"], time="t", start="s", end="e", right_columns=["name0"])
    assert none.where("name0 is not null").count() == 0 and none.count() == len(rows)


def test_long_intervals_are_copied_twice_at_most(spark):
    rows = [(1, 0, 5_000_000_000, "open"), (1, 7, 7, "point"), (1, 10, 20, "short"), (2, 63, 128, "x")]
    spans = intervals.Spans(spark.createDataFrame(rows, "k long, s long, e long, name string"), "s", "e", ["name"])
    levelled = intervals._levelled([spans], ["k"], Clock(1, False))
    top = max(r[0] for r in levelled.select("__r_level").collect())
    copies = intervals._in_cells(levelled, Clock(1, False), top).groupBy("__in0.name").count().collect()
    assert len(copies) == len(rows) and all(r["count"] <= 2 for r in copies)


STATES = [
    ("p", 10, 1), ("p", 20, 1), ("p", 30, 0),
    ("q", 5, 0), ("q", 10, 1), ("q", 20, 0), ("q", 30, 1),
    ("r", 10, 0), ("s", 10, 1),
]


def states(spark):
    return spark.createDataFrame(STATES, "k string, t long, f int")


@pytest.mark.parametrize("width", [10, 1000])
def test_runs_and_endpoints(spark, width):
    chunk = F.floor(F.col("t") / width).cast("long")
    runs = episodes.run_episodes(states(spark), ["k"], "t", ["t"], chunk, "f")
    assert sorted(map(tuple, runs.select("k", "start", "last_on", "end", "n").collect())) == [
        ("p", 10, 20, 30, 2), ("q", 10, 10, 20, 1), ("q", 30, 30, None, 1), ("s", 10, 10, None, 1),
    ]
    paired = episodes.paired_endpoints(states(spark), ["k"], "t", ["t"], chunk, "f")
    assert sorted(map(tuple, paired.collect())) == [("p", 10, 20), ("q", 10, 20)]
    ranked = episodes.ranked_endpoints(states(spark), ["k"], "t", ["t"], chunk, "f")
    # q: starts 10 and 30, ends 5 and 20, paired from the last
    assert sorted(map(tuple, ranked.collect())) == [("p", 10, 30), ("q", 10, 5), ("q", 30, 20)]
    kept = episodes.from_first_on(states(spark), ["k"], ["t"], chunk, "f")
    assert sorted(r.t for r in kept.filter("k = 'q'").collect()) == [10, 20, 30]
    assert kept.filter("k = 'r'").count() == 0


def test_end_markers(spark):
    got = episodes.with_end_markers(states(spark), ["k"], "t", ["t"], "f", 60)
    added = sorted(map(tuple, got.filter("synthetic = 1").select("k", "t", "f").collect()))
    assert added == [("q", 90, 0), ("s", 70, 0)]
    assert got.count() == len(STATES) + 2


def test_fill(spark):
    rows = [("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 9, 7), ("b", 1, None), ("c", 1, 3), ("c", 8, None)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = fills.carry_fill(df, keys=["k"], order=["t"], chunk=F.floor(F.col("t") / 2).cast("long"), columns={"v": "f"})
    assert sorted(map(tuple, got.select("k", "t", "f").collect()), key=repr) == [
        ("a", 1, 5), ("a", 2, 5), ("a", 3, 5), ("a", 9, 7), ("b", 1, None), ("c", 1, 3), ("c", 8, 3),
    ]


def test_grid(spark):
    stays = spark.createDataFrame([(1, 2.5), (2, 0.0), (3, -30.0), (4, None)], "s long, h double")
    hours = grid.hour_grid(stays, "s", "h")
    sizes = {r.s: r["count"] for r in hours.groupBy("s").count().collect()}
    assert sizes == {1: 28, 2: 25}
    # Every offset belongs to the hour h with 60(h-1) < offset <= 60h.
    offsets = spark.range(-1500, 1501).withColumnRenamed("id", "o").withColumn("s", F.lit(1))
    placed = grid.hourly_signal(offsets, "s", "o", {"o": "o"})
    assert placed.filter(~((60 * (F.col("hr") - 1) < F.col("o")) & (F.col("o") <= 60 * F.col("hr")))).count() == 0
    a = grid.hourly_signal(spark.createDataFrame([(1, 5, 1.0), (1, 6, 2.0), (9, 6, 2.0)], "s long, o long, v double"), "s", "o", {"x": "v"})
    b = grid.hourly_signal(spark.createDataFrame([(1, 7, 4.0), (1, 8, 8.0)], "s long, o long, v double"), "s", "o", {"y": "v"})
    out = grid.on_grid(hours, "s", [a, b], {"x": "sum", "y": "min"}).filter("hr = 1").collect()
    assert [(r.s, r.x, r.y) for r in out] == [(1, 3.0, 4.0)]


def test_clock(spark):
    df = spark.createDataFrame([(at(0), 90)], "a timestamp_ntz, b int")
    wall, offset = Clock.of(df, "a"), Clock.of(df, "b")
    gaps = spark.createDataFrame([(59_999_999,), (-59_999_999,), (-60_000_000,)], "g long")
    assert [r[0] for r in gaps.select(wall.whole_minutes(F.col("g"))).collect()] == [0, 0, -1]
    assert df.select(offset.exact_minutes(offset.axis("b"))).first()[0] == 90
    with pytest.raises(TypeError):
        Clock.of(spark.createDataFrame([("x",)], "a string"), "a")


@pytest.mark.parametrize("rows,blocks", [(1, 1), (3, 1), (4, 2), (24, 30)])
def test_windows_over_blocks_equal_sliding_windows(spark, rows, blocks):
    rng = random.Random(rows)
    data = []
    for key, (first, n) in enumerate([(-24, 90), (0, 1), (5, rows), (-1, 2), (7, 40)]):
        data += [(key, first + i, rng.choice([None, *range(50)]), None if key == 4 else rng.randrange(9)) for i in range(n)]
    df = spark.createDataFrame(data, "k long, p int, v int, u int")
    wanted = {f"{how}_{side}": ("v", how, side) for how in ("max", "min", "sum") for side in ("back", "ahead")} | {"u_sum": ("u", "sum", "back")}
    out = grid.own_rows(grid.rolled(grid.in_chunks(df, ["k"], "p", rows, chunk_blocks=blocks), ["k"], "p", wanted, rows)).collect()
    assert len(out) == len(data)
    pick = {"max": max, "min": min, "sum": sum}
    for r in out:
        for name, (column, how, side) in wanted.items():
            lo, hi = (r.p - rows + 1, r.p) if side == "back" else (r.p, r.p + rows - 1)
            seen = [row[2 if column == "v" else 3] for row in data if row[0] == r.k and lo <= row[1] <= hi]
            seen = [x for x in seen if x is not None]
            assert r[name] == (pick[how](seen) if seen else None), (r, name)


def test_chained_windows_see_far_enough(spark):
    rows = [(1, p, (p * 7) % 11) for p in range(-10, 60)]
    dealt = grid.in_chunks(spark.createDataFrame(rows, "k long, p int, v int"), ["k"], "p", 4, looks=2, chunk_blocks=2)
    sums = grid.rolled(dealt, ["k"], "p", {"s": ("v", "sum", "back")}, 4)
    out = grid.own_rows(grid.rolled(sums, ["k"], "p", {"b": ("s", "max", "back"), "a": ("s", "max", "ahead")}, 4)).collect()
    s = {p: sum(v for _, q, v in rows if p - 4 < q <= p) for _, p, _ in rows}
    assert {(r.p, r.b, r.a) for r in out} == {(p, max(s[q] for q in s if p - 4 < q <= p), max(s[q] for q in s if p <= q < p + 4)) for p in s}


def _most_rows(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_hours_of_stays_are_dealt_by_their_number(spark, monkeypatch):
    """Few short rows that become many: neither all stays nor a long one may lie in one task."""
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    stays = spark.createDataFrame([*[(i, 700.0) for i in range(30)], (99, 20_000.0), (99, 20_000.0), (7, 3.0)], "s long, h double").coalesce(1)
    hours = grid.hour_grid(stays, "s", "h")
    assert hours.count() == 30 * 725 + 2 * 20_025 + 28
    assert _most_rows(hours) < 15 * 500
    assert hours.filter("s = 99").agg(F.min("hr"), F.max("hr"), F.countDistinct("hr")).first()[:] == (-24, 20_000, 20_025)
    empty = grid.hour_grid(stays.filter("s < 0"), "s", "h")
    assert empty.count() == 0


def test_chunks_of_a_grid_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    hours = spark.range(100).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(299))).alias("p")).coalesce(1)
    dealt = grid.in_chunks(hours, ["k"], "p", 4, looks=1, chunk_blocks=10)
    assert dealt.filter("__chunk = __home").count() == 30_000
    assert _most_rows(dealt) < 2_000


def test_covariates_are_dealt_by_their_rows(spark, monkeypatch):
    """An anchor counts for each of its variables."""
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    anchors = spark.range(1_000).select((F.col("id") % 50).alias("k"), (F.col("id") * 60).alias("a"))
    values = spark.range(2_000).select((F.col("id") % 50).alias("k"), (F.col("id") * 30).alias("t"), F.col("id").cast("double").alias("v"))
    wanted = [nearest.Covariate(f"v{i}", "v", "x", "k", "t", -1.0 - i, 1.0) for i in range(4)]
    out = nearest.attach_covariates(anchors, "a", wanted, {"x": values})
    rule = re.search(r"hashpartitioning\(__k#\d+L, __chunk#\d+L, (\d+)\), REPARTITION_BY_NUM", out._jdf.queryExecution().executedPlan().toString())
    assert rule and int(rule[1]) >= (1_000 * 4 + 2_000) // 100
    assert out.count() == 1_000


def test_rows_of_a_scan_are_dealt_by_their_number(spark, monkeypatch):
    """Neither the windows over rows nor those over chunk summaries take what Spark merges by bytes, and the join leaves rows as dealt."""
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    df = spark.range(5_000).select(F.when(F.col("id") % 50 > 0, F.col("id") % 50).alias("k"), F.col("id").alias("t"))
    out = ordered_scan(df, ["k"], ["t"], F.floor(F.col("t") / 10), before={"last": F.col("t")}, after={"next": F.col("t")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\((__spot|k)#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)
    assert {k for k, _ in dealt} == {"__spot", "k"} and all(int(n) >= 50 for _, n in dealt)
    assert _most_rows(out) < 1_000
    for r in out.collect():
        assert (r.last, r.next) == (r.t - 50 if r.t >= 50 else None, r.t + 50 if r.t < 4_950 else None)


def test_aggregates_of_a_grid_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    hours = spark.range(100).select(F.col("id").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(299))).alias("hr")).coalesce(1)
    signal = grid.hourly_signal(hours.select("s", (F.col("hr") * 60).alias("m"), F.lit(2).alias("v")), "s", "m", {"v": "v"})
    out = grid.on_grid(hours, "s", [signal, signal], {"v": "sum"})
    assert _most_rows(out) < 2_000
    assert out.agg(F.count("v"), F.min("v"), F.max("v")).first()[:] == (30_000, 4, 4)
    assert grid.on_grid(hours, "s", [], {}).count() == 30_000


def test_settled_rows_lie_in_files_of_few_rows(spark, monkeypatch):
    """However few bytes they are, so that a task that reads some files and sends their rows on does not hold thousands for every byte."""
    monkeypatch.setattr(session, "FILE_ROWS", 1_000)
    same = spark.range(20_000).select((F.col("id") % 7).alias("k"), "id").repartition(1)
    with session.stages():
        kept = session.once(same)
        assert len(kept.inputFiles()) == 20
        most = kept.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert most <= 1_000
        assert kept.agg(F.count("id"), F.countDistinct("id"), F.sum("id")).first()[:] == (20_000, 20_000, 20_000 * 19_999 // 2)


def test_rows_that_no_anchor_looks_at_do_not_move(spark, monkeypatch):
    """Of hourly rows those move that lie beside an anchor; keys of other types meet as before."""
    moved = []
    monkeypatch.setattr(nearest, "dealt", lambda df, rows, *keys: moved.append(df.count()) or session.dealt(df, rows, *keys))
    anchors = spark.createDataFrame([(k, 60 * (100 + 7 * k) - 10) for k in range(20)] + [(None, 60)], "k int, a long")
    hours = spark.range(20 * 1_000).select((F.col("id") % 20).alias("k"), (F.floor(F.col("id") / 20) * 60 - 1440).cast("long").alias("t"), "id")
    out = nearest.attach_covariates(anchors, "a", [nearest.Covariate("v", "id", "x", "k", "t", 0.0, 1.0)], {"x": hours})
    got = {r.k: (r.delta_v, r.v) for r in out.collect()}
    assert got == {k: (10, (100 + 7 * k + 24) * 20 + k) for k in range(20)} | {None: (None, None)}
    assert len(moved) == 1 and moved[0] < 200


def test_bits_of_a_window_are_taken_together(spark):
    rng = random.Random(31)
    rows = [(k, p, rng.choice([None, 1, 2, 4, 8, 16])) for k in range(3) for p in range(-10, 90)]
    hours = spark.createDataFrame(rows, "k long, p int, x int")
    dealt = grid.in_chunks(hours, ["k"], "p", 4, looks=1, chunk_blocks=3)
    out = grid.own_rows(grid.rolled(dealt, ["k"], "p", {"b": ("x", "or", "back"), "a": ("x", "or", "ahead")}, 4)).collect()
    value = {(k, p): x for k, p, x in rows}
    for r in out:
        for name, places in (("b", range(r.p - 3, r.p + 1)), ("a", range(r.p, r.p + 4))):
            seen = [x for x in (value.get((r.k, p)) for p in places) if x is not None]
            assert r[name] == (functools.reduce(lambda m, n: m | n, seen) if seen else None)
    assert len(out) == len(rows)
