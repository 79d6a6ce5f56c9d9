"""Pivots, validity rules, picks, unit conversion, scores and harmonising."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.functions.clock import minutes_to_timestamp
from curata.operators import harmonise, pick, pivot, rules
from curata.operators.pivot import Measure, Range
from curata.queries.registry import Tables, query, rounded

EVENT_MEASURES = [
    Measure("views", ("view",), Range(above=0, at_most=100)),
    Measure("clicks", ("click",), Range(at_least=1, at_most=80)),
    Measure("errors", ("error",), Range(above=5)),
    Measure("purchases", ("purchase",), Range(above=0, below=300)),
    Measure("heat", ("signup",), Range(above=32, below=120), scale=1.8, shift=32),
    Measure("heat", ("error",), Range(above=10, below=32)),
    Measure("touch", ("view", "click")),
]

_EVENT_VALUES = """
  case when event_type = 'view' and value > 0 and value <= 100 then value end as views,
  case when event_type = 'click' and value >= 1 and value <= 80 then value end as clicks,
  case when event_type = 'error' and value > 5 then value end as errors,
  case when event_type = 'purchase' and value > 0 and value < 300 then value end as purchases,
  case when event_type = 'signup' and value > 32 and value < 120 then (value - 32) / 1.8
       when event_type = 'error' and value > 10 and value < 32 then value end as heat,
  case when event_type in ('view', 'click') then value end as touch
"""
_NAMES = ["views", "clicks", "errors", "purchases", "heat", "touch"]


def _pivot_sql(how: str) -> str:
    aggregates = ", ".join(f"round({how}({c}), 6) as {c}" for c in _NAMES)
    return (
        f"with v as (select user_id, cast(ts as date) as day, {_EVENT_VALUES} from events) "
        f"select user_id, day, {aggregates} from v group by user_id, day"
    )


def daily(t: Tables) -> DataFrame:
    return t.events.withColumn("day", F.col("ts").cast("date"))


@query(_pivot_sql("avg"))
def pivot_avg_daily(t: Tables) -> DataFrame:
    return pivot.pivot_measures(daily(t), ["user_id", "day"], "event_type", "value", EVENT_MEASURES, "avg", 6)


@query(_pivot_sql("max"))
def pivot_max_rules(t: Tables) -> DataFrame:
    return pivot.pivot_measures(daily(t), ["user_id", "day"], "event_type", "value", EVENT_MEASURES, "max", 6)


@query("""
select user_id, cast(ts as date) as day,
  min(case when event_type = 'view' then props end) as view_props,
  min(case when event_type = 'purchase' then props end) as purchase_props,
  min(case when event_type = 'click' then props end) as click_props
from events group by 1, 2
""")
def pivot_any_value(t: Tables) -> DataFrame:
    return pivot.pivot_labels(
        daily(t),
        ["user_id", "day"],
        "event_type",
        "props",
        {"view": "view_props", "purchase": "purchase_props", "click": "click_props"},
    )


@query("""
select user_id, cast(ts as date) as day, max(case when event_type = 'error' then props end) as site
from events group by 1, 2
""")
def pivot_max_text(t: Tables) -> DataFrame:
    return pivot.pivot_labels(daily(t), ["user_id", "day"], "event_type", "props", {"error": "site"}, "max")


_SHARED = [
    Measure("either", ("view", "click"), Range(above=10)),
    Measure("view_id", ("view",)),
    Measure("scaled", ("view", "error"), scale=2.0),
    Measure("either", ("view",), Range(above=500)),  # a second rule of one column for one item does not count
]
_SHARED_SQL = """
select user_id, cast(ts as date) as day, max(case when event_type in ('view', 'click') and event_id > 10 then event_id end) as either,
  max(case when event_type = 'view' then event_id end) as view_id,
  max(case when event_type in ('view', 'error') then event_id / 2.0 end) as scaled{more} from events group by 1, 2
"""


@query(_SHARED_SQL.format(more=""))
def pivot_shared_items(t: Tables) -> DataFrame:
    """Columns that share items, and whole numbers that stay whole unless they are scaled."""
    return pivot.pivot_measures(daily(t), ["user_id", "day"], "event_type", "event_id", _SHARED, "max")


@query(_SHARED_SQL.format(more="".join(f", max(case when event_type = 'click' and event_id >= {i} then event_id end) as from_{i}" for i in range(20))))
def pivot_shared_items_wide(t: Tables) -> DataFrame:
    more = [Measure(f"from_{i}", ("click",), Range(at_least=i)) for i in range(20)]
    return pivot.pivot_measures(daily(t), ["user_id", "day"], "event_type", "event_id", [*_SHARED, *more], "max")


@query("select * from events where (event_type = 'view' and value > 20) or (event_type = 'click' and (value < 5 or value > 90))")
def valid_rows_shared(t: Tables) -> DataFrame:
    """An item in several measures keeps each row once."""
    rules = [Measure("a", ("view", "click"), Range(above=90)), Measure("b", ("view",), Range(above=20)), Measure("c", ("click",), Range(below=5))]
    return pivot.valid_rows(t.events, "event_type", "value", rules)


@query("""
select * from events where
   (event_type = 'view' and value > 0 and value <= 100) or (event_type = 'click' and value >= 1 and value <= 80)
or (event_type = 'error' and value > 5)
""")
def valid_label_rows(t: Tables) -> DataFrame:
    return pivot.valid_rows(t.events, "event_type", "value", EVENT_MEASURES[:3])


# One rule per line number, as for labs of one name: (number, column, range).
LINE_RULES = [
    Measure("line_1", (1,), Range(at_least=2, at_most=45)),
    Measure("line_2", (2,), Range(above=0, at_most=40)),
    Measure("line_3", (3,), Range(at_least=5)),
    Measure("line_4", (4,), Range(above=3, below=48)),
    Measure("line_5", (5,)),
    Measure("line_67", (6, 7), Range(above=0)),
]


@query("""
with ok as (select l_orderkey, l_linenumber, l_shipdate, min(l_quantity) as q from lineitem
            group by 1, 2, 3 having count(distinct l_quantity) <= 1),
     v as (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc) as rn
           from ok where (l_linenumber = 1 and q between 2 and 45) or (l_linenumber = 2 and q > 0 and q <= 40)
              or (l_linenumber = 3 and q >= 5) or (l_linenumber = 4 and q > 3 and q < 48)
              or (l_linenumber = 5 and q is not null) or (l_linenumber in (6, 7) and q > 0))
select l_orderkey, max(case when l_linenumber = 1 then q end) as line_1,
  max(case when l_linenumber = 2 then q end) as line_2, max(case when l_linenumber = 3 then q end) as line_3,
  max(case when l_linenumber = 4 then q end) as line_4, max(case when l_linenumber = 5 then q end) as line_5,
  max(case when l_linenumber in (6, 7) then q end) as line_67
from v where rn = 1 group by 1
""")
def lab_last_revision(t: Tables) -> DataFrame:
    labs = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    agreed = pick.consistent_values(labs, ["l_orderkey", "l_linenumber", "l_shipdate"], "l_quantity")
    valid = pivot.valid_rows(agreed, "l_linenumber", "l_quantity", LINE_RULES)
    newest = pick.last_row(valid, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return pivot.pivot_measures(
        newest, ["l_orderkey"], "l_linenumber", "l_quantity", [Measure(m.name, m.items) for m in LINE_RULES], "max"
    )


@query("""
with k as (select user_id, ts, event_id, case when event_type = 'view' then value end as view_value,
   case when event_type = 'click' then value end as click_value, case when value > 50 then props end as big_props from events)
select user_id,
  arg_min(view_value, event_id) filter (view_value is not null) as view_value,
  arg_min(click_value, event_id) filter (click_value is not null) as click_value,
  arg_min(big_props, event_id) filter (big_props is not null) as big_props
from (select user_id, row_number() over (partition by user_id order by ts, event_id) as event_id,
             view_value, click_value, big_props from k) group by user_id
""")
def first_nonnull_per_group(t: Tables) -> DataFrame:
    seen = t.events.select(
        "user_id",
        "ts",
        "event_id",
        F.when(F.col("event_type") == "view", F.col("value")).alias("view_value"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("click_value"),
        F.when(F.col("value") > 50, F.col("props")).alias("big_props"),
    )
    return pick.first_nonnull(seen, ["user_id"], ["ts", "event_id"], ["view_value", "click_value", "big_props"])


@query("""
with r as (select user_id, date_trunc('hour', ts) as hour, value,
   case event_type when 'purchase' then 1 when 'view' then 2 when 'click' then 3 else 4 end as src from events),
 m as (select user_id, hour, src, value as high, value / 3 as low, round(value / 3 + (value - value / 3) / 3, 0) as mid from r),
 k as (select distinct user_id, hour from m),
 h as (select user_id, hour, high, row_number() over (partition by user_id, hour order by src, high) rn from m where high > 5 and high < 60),
 l as (select user_id, hour, low, row_number() over (partition by user_id, hour order by src, low) rn from m where low > 1 and low < 30),
 c as (select user_id, hour, mid, row_number() over (partition by user_id, hour order by src, mid) rn from m where mid > 2 and mid < 40)
select k.user_id, k.hour, h.high, round(l.low, 6) as low, c.mid from k
left join h on h.user_id = k.user_id and h.hour = k.hour and h.rn = 1
left join l on l.user_id = k.user_id and l.hour = k.hour and l.rn = 1
left join c on c.user_id = k.user_id and c.hour = k.hour and c.rn = 1
""")
def source_priority_merge(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    rank = F.when(kind == "purchase", 1).when(kind == "view", 2).when(kind == "click", 3).otherwise(4)
    low = F.col("value") / 3
    measured = t.events.select(
        "user_id",
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        rank.alias("src"),
        F.col("value").alias("high"),
        low.alias("low"),
        F.round(low + (F.col("value") - low) / 3, 0).alias("mid"),
    )
    return pick.by_priority(
        measured,
        ["user_id", "hour"],
        "src",
        {
            "high": (F.col("high") > 5) & (F.col("high") < 60),
            "low": (F.col("low") > 1) & (F.col("low") < 30),
            "mid": (F.col("mid") > 2) & (F.col("mid") < 40),
        },
    ).withColumn("low", rounded("low"))


# Unit of each part type as (numerator factor, divided by weight, per hour).
UNIT_SQL = """case p_type when 'STANDARD' then q when 'SMALL' then q / w when 'MEDIUM' then q / (60 * w)
 when 'LARGE' then q / 60 when 'ECONOMY' then 1000 * q / (60 * w) when 'PROMO' then 1000 * q end"""


@query(f"""
with r as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, p_type, try_cast(l_quantity as double) as q,
                  coalesce(case when p_size >= 3 then p_size end, 25) as w
           from lineitem join part on p_partkey = l_partkey where l_returnflag not in ('A'))
select l_orderkey, l_partkey, l_suppkey, l_linenumber, p_type, round({UNIT_SQL}, 4) as rate from r
""")
def rate_unit_normalise(t: Tables) -> DataFrame:
    from curata.plans.infusions import UnitRule, convert_rates

    units = {
        "STANDARD": UnitRule(1.0),
        "SMALL": UnitRule(1.0, by_weight=True),
        "MEDIUM": UnitRule(1.0, by_weight=True, per_hour=True),
        "LARGE": UnitRule(1.0, per_hour=True),
        "ECONOMY": UnitRule(1000.0, by_weight=True, per_hour=True),
        "PROMO": UnitRule(1000.0),
    }
    sizes = t.part.select("p_partkey", "p_type", "p_size")
    given = (
        t.lineitem.filter(~F.col("l_returnflag").isin("A"))
        .join(sizes, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "p_type",
            F.col("l_quantity").cast("string").try_cast("double").alias("q"),
            F.coalesce(F.when(F.col("p_size") >= 3, F.col("p_size")), F.lit(25)).alias("w"),
        )
    )
    rate = convert_rates(F.col("p_type"), F.col("q"), F.col("w"), units)
    return given.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "p_type", F.round(rate, 4).alias("rate")
    )


# Flag weights by the priority of pending orders.
PRIORITY_WEIGHTS = {
    "urgent6": (6, ("1-URGENT/P",)),
    "high3": (3, ("2-HIGH/P",)),
    "medium2": (2, ("3-MEDIUM/P",)),
    "low1": (1, ("4-NOT SPECIFIED/P", "5-LOW/P")),
}
BALANCE_POINTS = [(">=", 8000.0, 4), (">=", 6000.0, 3), (">=", 4000.0, 2), (">=", 2000.0, 1)]


@query("""
with s as (select c_custkey, c_acctbal,
  max(case when o_orderpriority = '1-URGENT' then 6 else 0 end) as urgent6,
  max(case when o_orderpriority = '2-HIGH' then 3 else 0 end) as high3,
  max(case when o_orderpriority = '3-MEDIUM' then 2 else 0 end) as medium2,
  max(case when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 1 else 0 end) as low1
  from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'P' group by 1, 2),
a as (select *, case when c_acctbal >= 8000 then 4 when c_acctbal >= 6000 then 3 when c_acctbal >= 4000 then 2
                     when c_acctbal >= 2000 then 1 else 0 end as age_points from s)
select *, urgent6 + high3 + medium2 + low1 + age_points as score from a
""")
def weighted_flag_score(t: Tables) -> DataFrame:
    fact = F.concat_ws("/", "o_orderpriority", "o_orderstatus")
    facts = t.orders.select(F.col("o_custkey").alias("c_custkey"), fact.alias("o_orderpriority"))
    people = t.customer.select("c_custkey", "c_acctbal")
    flagged = rules.weighted_flags(people, facts, "c_custkey", "o_orderpriority", PRIORITY_WEIGHTS)
    scored = flagged.withColumn("age_points", rules.bands(F.col("c_acctbal"), BALANCE_POINTS))
    return scored.withColumn("score", rules.total([*PRIORITY_WEIGHTS, "age_points"]))


@query("""
select distinct c_custkey as subject_id, n_nationkey as hospitalid, 'tpch' as source_db, true as teachingstatus,
  r_name as region, case when c_acctbal / 100 > 90 then 90 else c_acctbal / 100 end as admission_age,
  case when c_mktsegment = 'BUILDING' then 1 else 0 end as sex_female,
  round((50 + c_custkey % 50) / power((150 + c_custkey % 45) / 100.0, 2), 6) as bmi,
  round((c_custkey % 20000) / 60.0 / 24, 6) as los_hospital
from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey
""")
def patient_characteristics(t: Tables) -> DataFrame:
    from curata.plans.patients import bmi, capped_age, female_flag

    joined = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(
        t.region, F.col("r_regionkey") == F.col("n_regionkey"), "left"
    )
    key = F.col("c_custkey")
    return joined.select(
        key.alias("subject_id"),
        F.col("n_nationkey").alias("hospitalid"),
        F.lit("tpch").alias("source_db"),
        F.lit(True).alias("teachingstatus"),
        F.col("r_name").alias("region"),
        capped_age(F.col("c_acctbal") / 100).alias("admission_age"),
        female_flag(F.col("c_mktsegment"), "BUILDING").alias("sex_female"),
        rounded(bmi(50 + key % 50, 150 + key % 45)).alias("bmi"),
        rounded((key % 20000) / 60.0 / 24).alias("los_hospital"),
    ).distinct()


SEGMENTS = [("AUTOMOBILE", "Goods"), ("BUILDING", "Works"), ("FURNITURE", "Goods"), ("MACHINERY", "Goods")]


@query("""
with m(o, g) as (values ('AUTOMOBILE', 'Goods'), ('BUILDING', 'Works'), ('FURNITURE', 'Goods'), ('MACHINERY', 'Goods'))
select c_custkey, c_name, coalesce(g, 'Unknown') as c_mktsegment from customer left join m on o = c_mktsegment
""")
def category_map(t: Tables) -> DataFrame:
    mapping = t.spark.createDataFrame(SEGMENTS, "original string, mapping string")
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return harmonise.map_category(people, "c_mktsegment", mapping, "original", "mapping", "Unknown")


@query("""
with m(o, g) as (values ('AUTOMOBILE', 'Goods'), ('BUILDING', 'Works'), ('FURNITURE', 'Goods'), ('MACHINERY', 'Goods'))
select c_custkey, g as c_mktsegment from customer left join m on o = c_mktsegment
""")
def category_map_unmatched_null(t: Tables) -> DataFrame:
    mapping = t.spark.createDataFrame(SEGMENTS, "original string, mapping string")
    people = t.customer.select("c_custkey", "c_mktsegment")
    return harmonise.map_category(people, "c_mktsegment", mapping, "original", "mapping")


@query("""
select 'events' as source_db, cast(user_id as varchar) as subject_id, ts as at, cast(value as double) as reading,
       case when event_type not in ('error') then event_type end as label, cast(null as bigint) as rank from events
union all
select 'orders', cast(o_custkey as varchar), timestamp '2014-01-01' + to_minutes(o_orderkey * 7), o_totalprice,
       case when o_orderstatus not in ('P') then o_orderstatus end, cast(split_part(o_orderpriority, '-', 1) as bigint) from orders
union all
select 'suppliers', cast(s_suppkey as varchar), timestamp '2014-01-01' + to_minutes(s_nationkey * 60), s_acctbal, s_name, null from supplier
""")
def harmonised_union(t: Tables) -> DataFrame:
    first = harmonise.blank_to_null(
        t.events.select(
            F.lit("events").alias("source_db"),
            F.col("user_id").cast("string").alias("subject_id"),
            F.col("ts").alias("at"),
            F.col("value").cast("string").alias("reading"),
            F.col("event_type").alias("label"),
        ),
        ["error"],
    )
    second = harmonise.blank_to_null(
        t.orders.select(
            F.lit("orders").alias("source_db"),
            F.col("o_custkey").cast("string").alias("subject_id"),
            minutes_to_timestamp(F.col("o_orderkey") * 7).alias("at"),
            F.col("o_totalprice").cast("string").alias("reading"),
            F.col("o_orderstatus").alias("label"),
            F.substring_index("o_orderpriority", "-", 1).alias("rank"),
        ),
        ["P"],
    )
    third = harmonise.rename_by_lists(
        t.supplier.select(
            F.lit("suppliers").alias("source_db"),
            F.col("s_suppkey").cast("string").alias("s_suppkey"),
            minutes_to_timestamp(F.col("s_nationkey") * 60).alias("at"),
            F.col("s_acctbal").cast("string").alias("s_acctbal"),
            "s_name",
        ),
        ["s_suppkey", "s_acctbal", "s_name"],
        ["subject_id", "reading", "label"],
    )
    stacked = harmonise.harmonised_union([first, second, third])
    return harmonise.cast_columns(stacked, {"reading": "double", "rank": "bigint"})


_SURROGATE = """
with u as (select 'events' as source_db, user_id as subject_id, event_id as admission from events
           union all select 'orders', o_custkey, o_orderkey from orders),
k as (select source_db, cast(subject_id as varchar) as s, min(admission) as a from u group by all)
select u.source_db, u.subject_id, u.admission, {code} as unique_subject_id
from u join (select source_db, s, row_number() over (order by source_db, s) - 1 as code from k) c
  on c.source_db = u.source_db and c.s = cast(u.subject_id as varchar)
"""


@query(_SURROGATE.format(code="c.code"))
def surrogate_ids(t: Tables) -> DataFrame:
    return _numbered_subjects(t, None)


@query(_SURROGATE.format(code="c.code % 1000"))
def surrogate_ids_wrapped(t: Tables) -> DataFrame:
    return _numbered_subjects(t, 1000)


def _numbered_subjects(t: Tables, modulo: int | None) -> DataFrame:
    rows = t.events.select(
        F.lit("events").alias("source_db"), F.col("user_id").alias("subject_id"), F.col("event_id").alias("admission")
    ).union(t.orders.select(F.lit("orders"), "o_custkey", "o_orderkey"))
    keyed = rows.withColumn("__text", F.col("subject_id").cast("string"))
    return harmonise.dense_ids(
        keyed, ["source_db", "subject_id"], ["source_db", "__text", "admission"], "unique_subject_id", modulo
    ).drop("__text")


@query("select * from customer where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')")
def semi_filter(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return harmonise.members_of(t.customer, urgent, {"c_custkey": "o_custkey"})


@query("select * from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')")
def anti_filter(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return harmonise.not_members_of(t.customer, urgent, {"c_custkey": "o_custkey"})


@query("""
select distinct l.l_orderkey, l.l_linenumber, o.o_custkey, o.o_orderstatus, c_name
from lineitem l left join orders o on o.o_orderkey = l.l_orderkey left join customer on c_custkey = o_custkey
""")
def merge_attributes(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber")
    heads = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "c_name"
    )
    return harmonise.attach_attributes(rows, heads, ["l_orderkey"])
