"""Sources and sinks as checked steps: written to the session's shared folder, read back, used."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.operators import config, harmonise, nearest
from curata.operators.nearest import CONFIG_SCHEMA, Covariate
from curata.queries.registry import Tables, query
from curata.queries.series import EVENT_COVARIATES, _covariate_sql
from curata.reports import crosstab
from curata.session import own_folder
from curata.sources import tables


def _folder(t: Tables) -> str:
    return own_folder(t.spark, "storage")


@query(_covariate_sql())
def covariates_from_config(t: Tables) -> DataFrame:
    """The variable config is a CSV file: written, read with its declared schema, and turned into the query."""
    path = f"{_folder(t)}/variables"
    rows = [(kind, event, name, float(low), float(high), "events", "user_id", "ts") for kind, event, name, low, high in EVENT_COVARIATES]
    tables.write_csv(t.spark.createDataFrame(rows, CONFIG_SCHEMA).coalesce(1), path)
    read = tables.read_csv(t.spark, path, CONFIG_SCHEMA).collect()  # one row per variable
    given = {(r.var_type, r.var_new_name): Covariate.from_config(r) for r in read}
    want = [given[kind, name] for kind, _, name, _, _ in EVENT_COVARIATES]
    kinds = sorted({c.column for c in want})
    wide = t.events.select("user_id", "ts", *[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in kinds])
    left = t.events.filter("event_type = 'purchase'").select("user_id", "event_id", "ts")
    return nearest.attach_covariates(left, "ts", want, {"events": wide})


# Lines of a config over events and orders: type, column, name, window, source, key, time. About half of them are wrong.
_LINES = [
    ("near", "value", "any", -24.0, 24.0, "events", "user_id", "ts"),
    ("near", "event_id", "id", -12.0, 0.0, "events", "user_id", "ts"),
    ("near", "valeu", "typo", -24.0, 24.0, "events", "user_id", "ts"),
    ("near", "value", "late", 24.0, -24.0, "events", "user_id", "ts"),
    ("near", "value", "open", None, 24.0, "events", "user_id", "ts"),
    ("near", "value", "twice", -1.0, 1.0, "events", "user_id", "ts"),
    ("near", "event_id", "twice", -2.0, 2.0, "events", "user_id", "ts"),
    ("near", "value", "clock", -24.0, 24.0, "events", "user_id", "event_id"),
    ("near", "value", "nowhere", -24.0, 24.0, "visits", "user_id", "ts"),
    ("near", "o_totalprice", "price", 30.0, -30.0, "orders", "customer", "o_orderdate"),
]


def _checked_config(t: Tables) -> DataFrame:
    path = f"{_folder(t)}/variables"
    tables.write_csv(t.spark.createDataFrame(_LINES, CONFIG_SCHEMA).coalesce(1), path)
    sources = {"events": t.events, "orders": t.orders}
    return config.checked(tables.read_csv(t.spark, path, CONFIG_SCHEMA), sources, t.events.schema["ts"].dataType)


@query("""
with f(name, var_source_table, var_name, reason) as (values
  ('near_typo', 'events', 'valeu', 'unknown column'), ('near_late', 'events', 'value', 'reversed window'), ('near_open', 'events', 'value', 'no window'),
  ('near_twice', 'events', 'value', 'repeated name'), ('near_twice', 'events', 'event_id', 'repeated name'),
  ('near_clock', 'events', 'value', 'time on another clock'), ('near_nowhere', 'visits', 'value', 'unknown source'),
  ('near_price', 'orders', 'o_totalprice', 'unknown key'), ('near_price', 'orders', 'o_totalprice', 'reversed window')),
n as (select 'events' as s, count(*) as n from events union all select 'orders', count(*) from orders)
select f.*, coalesce(n, 0) as source_rows from f left join n on s = var_source_table
""")
def config_findings(t: Tables) -> DataFrame:
    """What is wrong with the lines of a config, each with the size of the source it is about."""
    sizes = [df.agg(F.lit(name).alias("s"), F.count(F.lit(1)).alias("n")) for name, df in {"events": t.events, "orders": t.orders}.items()]
    found = config.findings(_checked_config(t)).join(sizes[0].union(sizes[1]), F.col("var_source_table") == F.col("s"), "left")
    return found.select("name", "var_source_table", "var_name", "reason", F.coalesce("n", F.lit(0)).alias("source_rows"))


@query("""
with p as (select distinct user_id, ts from events where event_type = 'purchase'),
c as (select p.user_id, p.ts, datesub('minute', p.ts, e.ts) as d, abs(date_diff('microsecond', p.ts, e.ts)) as far, e.ts as t, value, e.event_id
  from p join events e on e.user_id = p.user_id),
a as (select *, row_number() over (partition by user_id, ts order by far, t, value) as rn from c where value is not null and d between -1440 and 1440),
i as (select *, row_number() over (partition by user_id, ts order by far, t, event_id) as rn from c where d between -720 and 0)
select e.user_id, e.event_id, e.ts, a.d as delta_near_any, a.value as near_any, i.d as delta_near_id, i.event_id as near_id
from events e left join a on a.user_id = e.user_id and a.ts = e.ts and a.rn = 1 left join i on i.user_id = e.user_id and i.ts = e.ts and i.rn = 1
where e.event_type = 'purchase'
""")
def config_good_lines(t: Tables) -> DataFrame:
    """The same config's good lines attached; a number and an id, of two types, by one scan."""
    want = config.covariates(_checked_config(t))
    left = t.events.filter("event_type = 'purchase'").select("user_id", "event_id", "ts")
    return nearest.attach_covariates(left, "ts", want, {"events": t.events})


@query("select * from orders where o_totalprice > 100000")
def table_sink(t: Tables) -> DataFrame:
    """A table replaced by a second write holds the second."""
    path = tables.table_path(_folder(t), "set", "orders")
    tables.write_table(t.orders, path)
    return tables.write_table(t.orders.filter("o_totalprice > 100000"), path)


@query("""
select 'customer' as name, count(*) as n, cast(sum(c_custkey) as bigint) as keys, 5 as width from customer
union all select 'supplier', count(*), cast(sum(s_suppkey) as bigint), 4 from supplier
""")
def table_set_sink(t: Tables) -> DataFrame:
    """A set of tables by name, and what is read back from each."""
    paths = tables.write_tables({"customer": t.customer, "supplier": t.supplier}, _folder(t), "set")
    parts = []
    for name, key in (("customer", "c_custkey"), ("supplier", "s_suppkey")):
        back = t.spark.read.parquet(paths[name])
        parts.append(back.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(key).alias("keys"), F.lit(len(back.columns)).alias("width")))
    return parts[0].union(parts[1])


@query("""
with c as (select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2)
select *, round_even(n * 100.0 / sum(n) over (), 2) as pct from c
""")
def report_sink(t: Tables) -> DataFrame:
    """A report as CSV, read back with its schema."""
    path = f"{_folder(t)}/report"
    tables.write_csv(crosstab.crosstab_percent(t.orders, "o_orderpriority", "o_orderstatus"), path)
    return tables.read_csv(t.spark, path, "o_orderpriority string, o_orderstatus string, n long, pct double")


@query("""
select 'customer' as source, c_custkey as key, c_name as name, c_acctbal as balance, c_nationkey as nation from customer
union all select 'supplier', s_suppkey, s_name, s_acctbal, s_nationkey from supplier
""")
def strict_union(t: Tables) -> DataFrame:
    """Two tables whose column lists must be equal before they are stacked."""
    names = ["key", "name", "balance", "nation"]
    parts = [
        harmonise.rename_by_lists(t.customer, ["c_custkey", "c_name", "c_acctbal", "c_nationkey"], names).select(F.lit("customer").alias("source"), *names),
        harmonise.rename_by_lists(t.supplier, ["s_suppkey", "s_name", "s_acctbal", "s_nationkey"], names).select(F.lit("supplier").alias("source"), *names),
    ]
    return harmonise.harmonised_union(parts, strict=True)


@query("""
select o_orderstatus as first, cast(o_orderdate as date) as second, o_orderkey as third, o_totalprice as last from orders
""")
def moved_columns(t: Tables) -> DataFrame:
    """Columns moved to their places, written, and read back by place: the names do not come along."""
    slim = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderstatus")
    moved = harmonise.move_columns(slim, {"o_totalprice": 3, "o_orderstatus": 0, "o_orderdate": 1})
    path = f"{_folder(t)}/moved"
    tables.write_csv(moved, path)
    return tables.read_csv(t.spark, path, "first string, second date, third long, last double")


@query("select o_orderkey, o_orderdate, o_totalprice from orders order by o_orderdate, o_orderkey limit 20")
def first_rows(t: Tables) -> DataFrame:
    """The head of a sorted table."""
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy("o_orderdate", "o_orderkey").limit(20)
