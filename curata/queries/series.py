"""Joins of irregular series, intervals, episodes, fills and grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from curata.functions.clock import Clock
from curata.operators import asof, episodes, fills, grid, intervals, nearest, pick, rules
from curata.queries.registry import Tables, query, rounded

DAY = 1440


def series(t: Tables, kind: str, prefix: str) -> DataFrame:
    """One event type as a measurement series."""
    return t.events.filter(F.col("event_type") == kind).select(
        "user_id",
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("ts").alias(f"{prefix}_ts"),
        F.col("value").alias(f"{prefix}_value"),
    )


def pairs(t: Tables, minutes: float) -> DataFrame:
    """Each purchase with the latest view of its user at or before it."""
    return asof.asof_join(
        series(t, "purchase", "buy"),
        series(t, "view", "view"),
        left_keys=["user_id"],
        left_time="buy_ts",
        right_time="view_ts",
        tie="view_id",
        tolerance=minutes,
        delta="delta",
    )


@query("""
with b as (select user_id, event_id as buy_id, ts as buy_ts, value as buy_value from events where event_type = 'purchase'),
     v as (select user_id, event_id as view_id, ts as view_ts, value as view_value from events where event_type = 'view')
select b.user_id, buy_id, buy_ts, buy_value, view_id, view_ts, view_value,
       round(date_diff('microsecond', buy_ts, view_ts) / 60000000.0, 9) + 0.0 as delta
from b asof join v on b.user_id = v.user_id and b.buy_ts >= v.view_ts
where date_diff('microsecond', view_ts, buy_ts) <= 1440 * 60000000::bigint
""")
def asof_backward_pairs(t: Tables) -> DataFrame:
    return pairs(t, 1440).withColumn("delta", rounded("delta", 9))


@query("""
with b as (select user_id, event_id as buy_id, ts as buy_ts from events where event_type = 'purchase'),
     v as (select user_id, event_id as view_id, ts as view_ts from events where event_type = 'view')
select b.user_id, buy_id, buy_ts, view_id, view_ts,
       round(date_diff('microsecond', buy_ts, view_ts) / 60000000.0, 9) + 0.0 as delta
from b asof join v on b.user_id = v.user_id and b.buy_ts <= v.view_ts
where date_diff('microsecond', buy_ts, view_ts) <= 2880 * 60000000::bigint
""")
def asof_forward_pairs(t: Tables) -> DataFrame:
    return asof.asof_join(
        series(t, "purchase", "buy").drop("buy_value"),
        series(t, "view", "view").drop("view_value"),
        left_keys=["user_id"],
        left_time="buy_ts",
        right_time="view_ts",
        tie="view_id",
        direction="forward",
        tolerance=2880,
        delta="delta",
    ).withColumn("delta", rounded("delta", 9))


@query("""
with b as (select user_id, event_id as buy_id, ts as buy_ts, value as buy_value from events where event_type = 'purchase'),
     v as (select user_id, event_id as view_id, ts as view_ts, value as view_value from events where event_type = 'view'),
     j as (select b.*, view_id, view_ts, view_value,
                  row_number() over (partition by b.user_id, buy_ts order by view_ts desc, buy_id desc, view_id desc) as rn
           from b join v on b.user_id = v.user_id and view_ts <= buy_ts)
select user_id, buy_id, buy_ts, buy_value, view_id, view_ts, view_value,
       round(date_diff('microsecond', buy_ts, view_ts) / 60000000.0, 9) + 0.0 as delta
from j where rn = 1 and date_diff('microsecond', view_ts, buy_ts) <= 1440 * 60000000::bigint
""")
def asof_inequality_join(t: Tables) -> DataFrame:
    return asof.closest_prior(
        series(t, "purchase", "buy"),
        series(t, "view", "view"),
        keys=["user_id"],
        left_time="buy_ts",
        right_time="view_ts",
        left_pick="buy_id",
        tie="view_id",
        tolerance=1440,
        delta="delta",
    ).withColumn("delta", rounded("delta", 9))


@query("""
with b as (select user_id, event_id as buy_id, ts as buy_ts, value as buy_value from events where event_type = 'purchase'),
     v as (select user_id, event_id as view_id, ts as view_ts, value as view_value from events where event_type = 'view'),
     j as (select b.*, view_id, view_ts, view_value,
                  row_number() over (partition by buy_id order by view_ts desc, view_id desc) as rn
           from b join v on b.user_id = v.user_id and view_ts <= buy_ts),
     c as (select *, row_number() over (partition by user_id order by buy_ts, buy_id) as nr
           from j where rn = 1 and date_diff('microsecond', view_ts, buy_ts) <= 720 * 60000000::bigint
             and buy_value between 1 and 200 and view_value between 1 and 200)
select user_id, buy_id, buy_ts, buy_value, view_id, view_ts, view_value,
       round(date_diff('microsecond', buy_ts, view_ts) / 60000000.0, 9) + 0.0 as delta
from c where nr = 1
""")
def pairs_strict_first(t: Tables) -> DataFrame:
    cut = pairs(t, 720).filter(F.col("buy_value").between(1, 200) & F.col("view_value").between(1, 200))
    return pick.first_row(cut, ["user_id"], ["buy_ts", "buy_id"]).withColumn("delta", rounded("delta", 9))


@query("""
with b as (select user_id, event_id, ts, value from events where event_type = 'purchase'),
     c as (select user_id, event_id as cid, ts as cts, value as cvalue from events where event_type = 'click'),
     j as (select b.event_id, cts, cvalue,
                  datesub('minute', b.ts, cts) as d,
                  row_number() over (partition by b.event_id
                      order by abs(date_diff('microsecond', b.ts, cts)), cts, cvalue) as rn
           from b join c on b.user_id = c.user_id
            and datesub('minute', b.ts, cts) between -1440 and 1440)
select b.user_id, b.event_id, b.ts, b.value, d as delta_near_click, cvalue as near_click
from b left join j on b.event_id = j.event_id and rn = 1
""")
def nearest_in_window(t: Tables) -> DataFrame:
    left = t.events.filter("event_type = 'purchase'").select("user_id", "event_id", "ts", "value")
    clicks = t.events.filter("event_type = 'click'").select("user_id", "ts", F.col("value").alias("click_value"))
    want = [nearest.Covariate("near_click", "click_value", "clicks", "user_id", "ts", -24, 24)]
    return nearest.attach_covariates(left, "ts", want, {"clicks": clicks})


# The variable config of covariate_attach: windows before, after and around the anchor, two of
# them leaving the anchor out.
EVENT_COVARIATES = [
    ("past", "view", "view_24h", -24, 0),
    ("future", "click", "click_24h", 0, 24),
    ("around", "error", "error_24h", -24, 24),
    ("earlier", "signup", "signup_12_48h", -48, -12),
    ("later", "purchase", "purchase_6_36h", 6, 36),
]


def _covariate_sql() -> str:
    parts, columns, joins = [], [], []
    for kind, event, name, low, high in EVENT_COVARIATES:
        v = f"{kind}_{name}"
        parts.append(f"""{v} as (
  select b.event_id, datesub('minute', b.ts, e.ts) as d, e.value as x,
         row_number() over (partition by b.event_id
             order by abs(date_diff('microsecond', b.ts, e.ts)), e.ts, e.value) as rn
  from b join events e on e.user_id = b.user_id and e.event_type = '{event}'
   and datesub('minute', b.ts, e.ts) between {low * 60} and {high * 60})""")
        columns.append(f"{v}.d as delta_{v}, {v}.x as {v}")
        joins.append(f"left join {v} on {v}.event_id = b.event_id and {v}.rn = 1")
    return (
        "with b as (select user_id, event_id, ts from events where event_type = 'purchase'),\n"
        + ",\n".join(parts)
        + "\nselect b.*, " + ", ".join(columns) + "\nfrom b " + "\n".join(joins)
    )


@query(_covariate_sql())
def covariate_attach(t: Tables) -> DataFrame:
    left = t.events.filter("event_type = 'purchase'").select("user_id", "event_id", "ts")
    kinds = sorted({c[1] for c in EVENT_COVARIATES})
    wide = t.events.select(
        "user_id", "ts", *[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in kinds]
    )
    want = [
        nearest.Covariate(f"{kind}_{name}", event, "events", "user_id", "ts", low, high)
        for kind, event, name, low, high in EVENT_COVARIATES
    ]
    return nearest.attach_covariates(left, "ts", want, {"events": wide})


def stays(t: Tables) -> DataFrame:
    """Orders as stays of a customer: in on the order date, out 1 to 20 days later."""
    return t.orders.select(
        F.col("o_custkey").alias("subject"),
        F.col("o_orderkey").alias("stay"),
        F.col("o_orderdate").alias("intime"),
        F.timestamp_add("DAY", 1 + F.col("o_orderkey") % 20, F.col("o_orderdate")).alias("outtime"),
    )


STAY_SQL = """
stays as (select o_custkey as subject, o_orderkey as stay, o_orderdate as intime,
                 o_orderdate + to_days(cast(1 + o_orderkey % 20 as integer)) as outtime from orders),
near as (select *, lag(outtime) over w as prev_end, lead(intime) over w as next_start
         from stays window w as (partition by subject order by intime, stay)),
bounds as (select subject, stay, intime, outtime,
    case when prev_end > intime - interval 240 hour
         then intime - to_seconds(cast(round(date_diff('second', prev_end, intime) / 2.0) as bigint))
         else intime - interval 12 hour end as data_start,
    case when next_start < outtime + interval 240 hour
         then outtime + to_seconds(cast(round(date_diff('second', outtime, next_start) / 2.0) as bigint))
         else outtime + interval 12 hour end as data_end
  from near)
"""


def bounds(t: Tables) -> DataFrame:
    return intervals.fuzzy_bounds(
        stays(t), subject="subject", stay="stay", start="intime", end="outtime", near_hours=240, pad_hours=12
    )


@query(f"with {STAY_SQL} select * from bounds")
def fuzzy_stay_bounds(t: Tables) -> DataFrame:
    return bounds(t)


@query(f"""with {STAY_SQL},
m as (select o_custkey as subject, l_orderkey, l_linenumber, l_shipdate, l_quantity
      from lineitem join orders on o_orderkey = l_orderkey)
select m.*, b.stay from m left join bounds b
  on b.subject = m.subject and m.l_shipdate >= b.data_start and m.l_shipdate < b.data_end
""")
def assign_to_stay(t: Tables) -> DataFrame:
    owners = t.orders.select(F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("l_orderkey"))
    measured = (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
        .join(owners, "l_orderkey")
        .select("subject", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    )
    return intervals.interval_join(
        measured,
        bounds(t),
        keys=["subject"],
        time="l_shipdate",
        start="data_start",
        end="data_end",
        closed="left",
        right_columns=["stay"],
    )


_OPEN = "case when o_orderkey % 40 = 0 then timestamp '9999-12-31 00:00:00' else o_orderdate + interval 3 day end"


@query(f"""with s as (select o_custkey as subject, o_orderkey as stay, o_orderdate as intime, {_OPEN} as outtime from orders),
m as (select o_custkey as subject, l_orderkey, l_linenumber, l_shipdate from lineitem join orders on o_orderkey = l_orderkey)
select m.*, s.stay from m left join s on s.subject = m.subject and m.l_shipdate between s.intime and s.outtime
""")
def open_ended_stays(t: Tables) -> DataFrame:
    """Stays that have not ended carry a far date, which must not become a bucket a day until then."""
    far = F.expr("TIMESTAMP_NTZ'9999-12-31 00:00:00'")
    ends = F.when(F.col("o_orderkey") % 40 == 0, far).otherwise(F.timestamp_add("DAY", F.lit(3), F.col("o_orderdate")))
    open_stays = t.orders.select(
        F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("stay"), F.col("o_orderdate").alias("intime"), ends.alias("outtime")
    )
    owners = t.orders.select(F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("l_orderkey"))
    measured = t.lineitem.join(owners, "l_orderkey").select("subject", "l_orderkey", "l_linenumber", "l_shipdate")
    return intervals.interval_join(
        measured, open_stays, keys=["subject"], time="l_shipdate", start="intime", end="outtime", right_columns=["stay"]
    )


def states(t: Tables) -> DataFrame:
    """Events as on/off states: views and clicks are on."""
    return t.events.select(
        "user_id", "ts", "event_id", "value", F.when(F.col("event_type").isin("view", "click"), 1).otherwise(0).alias("flag")
    )


def event_chunk(df: DataFrame, days: float = 2):
    clock = Clock.of(df, "ts")
    return clock.bucket(clock.axis("ts"), days * DAY)


STATE_SQL = """s as (select user_id, ts, event_id, value,
  case when event_type in ('view', 'click') then 1 else 0 end as flag from events)"""
ISLAND_SQL = STATE_SQL + """,
r as (select *, row_number() over (partition by user_id order by ts, event_id)
              - row_number() over (partition by user_id, flag order by ts, event_id) as run,
         min(case when flag = 0 then ts end) over (partition by user_id order by ts, event_id
             rows between 1 following and unbounded following) as closed from s),
ep as (select user_id, min(ts) as start, max(ts) as last_on, min(closed) as "end", count(*) as n
       from r where flag = 1 group by user_id, run)"""


def runs(t: Tables) -> DataFrame:
    s = states(t)
    return episodes.run_episodes(s, ["user_id"], "ts", ["ts", "event_id"], event_chunk(s), "flag")


@query(f"with {ISLAND_SQL} select * from ep")
def episodes_islands(t: Tables) -> DataFrame:
    return runs(t)


@query(f"""with {STATE_SQL},
l as (select *, lead(ts) over (partition by user_id order by ts, event_id) as nx from s),
e as (select distinct user_id, unnest([ts, nx]) as edge from l where flag = 1 and nx is not null),
n as (select user_id, edge as start, lead(edge) over (partition by user_id order by edge) as "end",
             row_number() over (partition by user_id order by edge) as rn from e)
select user_id, start, "end" from n where rn % 2 = 1 and "end" is not null""")
def episodes_endpoint_pairing(t: Tables) -> DataFrame:
    s = states(t)
    return episodes.paired_endpoints(s, ["user_id"], "ts", ["ts", "event_id"], event_chunk(s), "flag")


RANK_SQL = """n as (select *, lag(flag) over w as was, lead(flag) over w as next_flag from s window w as (partition by user_id order by ts, event_id)),
g as (select user_id, flag, ts, event_id from n where (flag = 1 and was is distinct from 1) or (flag = 0 and next_flag is distinct from 0)),
k as (select *, row_number() over (partition by user_id, flag order by ts desc, event_id desc) as rn from g)
select a.user_id, a.ts as start, b.ts as "end" from k a join k b on b.user_id = a.user_id and b.rn = a.rn and a.flag = 1 and b.flag = 0"""


@query(f"with {STATE_SQL}, {RANK_SQL}")
def episodes_rank_pairing(t: Tables) -> DataFrame:
    s = states(t)
    return episodes.ranked_endpoints(s, ["user_id"], "ts", ["ts", "event_id"], event_chunk(s), "flag")


@query(f"""with {STATE_SQL}
select user_id, ts, event_id, flag, flag - lag(flag) over (partition by user_id order by ts, event_id) as change from s""")
def state_change_detection(t: Tables) -> DataFrame:
    s = states(t).drop("value")
    return episodes.state_changes(s, ["user_id"], ["ts", "event_id"], event_chunk(s), "flag")


@query(f"""with {STATE_SQL}, a as (select user_id, min(ts) as first_on from s where flag = 1 group by user_id)
select s.user_id, ts, event_id, flag from s join a on a.user_id = s.user_id and ts >= first_on""")
def anchor_from_first_on(t: Tables) -> DataFrame:
    s = states(t).drop("value")
    return episodes.from_first_on(s, ["user_id"], ["ts", "event_id"], event_chunk(s), "flag")


@query("""
select e.user_id, ts, event_id, value from events e
join (select user_id, max(ts) as last_buy from events where event_type = 'purchase' group by 1) b on b.user_id = e.user_id
where event_type = 'view' and ts < last_buy
""")
def rows_before_event(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "ts", "event_id", "value", "event_type")
    return episodes.rows_before_event(
        rows,
        ["user_id"],
        ["ts", "event_id"],
        event_chunk(rows),
        F.col("event_type") == "view",
        F.col("event_type") == "purchase",
    ).drop("event_type")


@query(f"""with {STATE_SQL},
z as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from s)
select user_id, ts, event_id, flag, 0 as synthetic from s
union all
select user_id, ts + interval 60 minute, event_id, 0, 1 from z where rn = 1 and flag = 1""")
def synthetic_end_rows(t: Tables) -> DataFrame:
    s = states(t).drop("value")
    return episodes.with_end_markers(s, ["user_id"], "ts", ["ts", "event_id"], "flag", 60)


@query(f"""with {ISLAND_SQL},
p as (select user_id, event_id, ts, value from events where event_type = 'purchase')
select p.*, case when ep.user_id is null then value end as value_outside,
            case when ep.user_id is not null then value end as value_inside
from p left join ep on ep.user_id = p.user_id and p.ts >= ep.start and p.ts <= ep."end" """)
def interval_flag_split(t: Tables) -> DataFrame:
    bought = t.events.filter("event_type = 'purchase'").select("user_id", "event_id", "ts", "value")
    return intervals.split_by_interval(
        bought,
        runs(t),
        "value",
        "value_inside",
        "value_outside",
        keys=["user_id"],
        time="ts",
        start="start",
        end="end",
    )


@query("""
with o as (select user_id, event_id as order_id, ts as starts, ts + interval 12 hour as stops
           from events where event_type = 'signup')
select e.user_id, e.event_id, e.ts, e.value, o.order_id
from events e join o on o.user_id = e.user_id and e.ts >= o.starts and e.ts <= o.stops
where e.event_type <> 'signup'
""")
def infusion_order_join(t: Tables) -> DataFrame:
    windows = t.events.filter("event_type = 'signup'").select(
        "user_id",
        F.col("event_id").alias("order_id"),
        F.col("ts").alias("starts"),
        F.timestamp_add("HOUR", F.lit(12), F.col("ts")).alias("stops"),
    )
    given = t.events.filter("event_type <> 'signup'").select("user_id", "event_id", "ts", "value")
    return intervals.interval_join(
        given,
        windows,
        keys=["user_id"],
        time="ts",
        start="starts",
        end="stops",
        right_columns=["order_id"],
        how="inner",
    )


@query("""
with k as (select user_id, ts, event_id, case when event_type = 'purchase' then value end as seen from events)
select user_id, ts, event_id, seen,
  coalesce(last_value(seen ignore nulls) over (partition by user_id order by ts, event_id
             rows between unbounded preceding and current row),
           first_value(seen ignore nulls) over (partition by user_id order by ts, event_id
             rows between current row and unbounded following)) as filled
from k
""")
def locf_nocb_fill(t: Tables) -> DataFrame:
    known = t.events.select(
        "user_id", "ts", "event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("seen")
    )
    return fills.carry_fill(
        known, keys=["user_id"], order=["ts", "event_id"], chunk=event_chunk(known), columns={"seen": "filled"}
    )


# Bands of the fixture score: (comparison, bound, points), first match wins.
LOW_VIEW = [("<", 2.0, 4), ("<", 5.0, 3), ("<", 10.0, 2), ("<", 20.0, 1)]
HIGH_CLICK = [(">=", 40.0, 4), (">=", 25.0, 3), (">=", 15.0, 2), (">=", 8.0, 1)]
LOW_ERRORS = [("<", 10.0, 4), ("<", 30.0, 3)]


@query("""
with s as (select user_id, cast(floor(date_diff('microsecond', timestamp '2024-01-01', ts) / 60000000.0) as bigint) as off,
                  event_type, value from events),
los as (select user_id, max(off) / 60.0 as hours from s group by user_id),
g as (select user_id, unnest(generate_series(-24, cast(ceil(hours) as bigint))) as hr from los),
h as (select user_id, cast(ceil(off / 60.0) as bigint) as hr,
        min(case when event_type = 'view' then value end) as view_min,
        max(case when event_type = 'click' then value end) as click_max,
        sum(case when event_type = 'error' then value end) as error_sum
      from s group by 1, 2),
x as (select g.user_id, g.hr, view_min, click_max, error_sum,
        sum(error_sum) over w as error_24 from g left join h on h.user_id = g.user_id and h.hr = g.hr
      window w as (partition by g.user_id order by g.hr rows between 23 preceding and current row)),
c as (select *,
  case when view_min < 2 then 4 when view_min < 5 then 3 when view_min < 10 then 2 when view_min < 20 then 1
       when view_min is null then null else 0 end as a,
  case when click_max >= 40 then 4 when click_max >= 25 then 3 when click_max >= 15 then 2 when click_max >= 8 then 1
       when click_max is null then null else 0 end as b,
  case when error_24 < 10 then 4 when error_24 < 30 then 3 when error_24 is null then null else 0 end as e
  from x),
f as (select *, coalesce(max(a) over w, 0) as a_24, coalesce(max(b) over w, 0) as b_24, coalesce(max(e) over w, 0) as e_24
      from c window w as (partition by user_id order by hr rows between 23 preceding and current row))
select user_id, cast(hr as integer) as hr, view_min, click_max, round(error_sum, 6) as error_sum,
       round(error_24, 6) as error_24, cast(a as integer) as a, cast(b as integer) as b, cast(e as integer) as e,
       cast(a_24 as integer) as a_24, cast(b_24 as integer) as b_24, cast(e_24 as integer) as e_24,
       cast(a_24 + b_24 + e_24 as integer) as total_24
from f where hr >= 0
""")
def hourly_grid_score(t: Tables) -> DataFrame:
    clock = Clock.of(t.events, "ts")
    start = clock.axis(F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    minutes = F.floor((clock.axis("ts") - start) / F.lit(float(clock.units_per_minute))).cast("long")
    placed = t.events.select("user_id", minutes.alias("off"), "event_type", "value")
    los = placed.groupBy("user_id").agg((F.max("off") / 60.0).alias("hours"))
    signals = grid.hourly_signal(
        placed,
        "user_id",
        "off",
        {
            "view_min": F.when(F.col("event_type") == "view", F.col("value")),
            "click_max": F.when(F.col("event_type") == "click", F.col("value")),
            "error_sum": F.when(F.col("event_type") == "error", F.col("value")),
        },
    )
    hourly = grid.on_grid(
        grid.hour_grid(los, "user_id", "hours"),
        "user_id",
        [signals],
        {"view_min": "min", "click_max": "max", "error_sum": "sum"},
    )
    dealt = grid.in_chunks(hourly, ["user_id"], "hr", looks=2)
    scored = grid.rolled(dealt, ["user_id"], "hr", {"error_24": ("error_sum", "sum", "back")}).select(
        "*",
        rules.bands(F.col("view_min"), LOW_VIEW).alias("a"),
        rules.bands(F.col("click_max"), HIGH_CLICK).alias("b"),
        rules.bands(F.col("error_24"), LOW_ERRORS).alias("e"),
    )
    worst = grid.own_rows(grid.rolled(scored, ["user_id"], "hr", {f"{c}_24": (c, "max", "back") for c in ("a", "b", "e")}))
    return worst.filter("hr >= 0").withColumns({f"{c}_24": F.coalesce(f"{c}_24", F.lit(0)) for c in ("a", "b", "e")}).withColumns(
        {
            "error_sum": rounded("error_sum"),
            "error_24": rounded("error_24"),
            "total_24": F.col("a_24") + F.col("b_24") + F.col("e_24"),
        }
    )
