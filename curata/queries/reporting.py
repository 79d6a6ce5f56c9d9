"""Funnels, crosstabs, completeness, descriptive tables and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.operators import pick
from curata.queries.registry import Tables, query, rounded
from curata.queries.series import pairs
from curata.queries.shape import pivot_avg_daily
from curata.reports import completeness as present
from curata.reports import crosstab, tableone

# Stages of the fixture funnel, each inside the one before.
STAGES = {
    "pairs_lenient": "delta >= -4320",
    "pairs_strict": "delta >= -720",
    "pairs_cut": "delta >= -720 and buy_value between 1 and 200 and view_value between 1 and 200",
}

_STAGED = """
with b as (select user_id, event_id as buy_id, ts as buy_ts, value as buy_value from events where event_type = 'purchase'),
     v as (select user_id, ts as view_ts, value as view_value from events where event_type = 'view'),
     p as (select b.*, view_value, date_diff('microsecond', buy_ts, view_ts) / 60000000.0 as delta
           from b asof join v on b.user_id = v.user_id and b.buy_ts >= v.view_ts
           where date_diff('microsecond', view_ts, buy_ts) <= 4320 * 60000000::bigint),
     g as (select *, case when user_id % 7 = 0 then 'Unknown' when user_id % 7 < 3 then 'A' else 'B' end as race,
                  user_id % 2 as sex from p),
     s as (select 0 as step, 'pairs_lenient' as stage, * from g
           union all select 1, 'pairs_strict', * from g where delta >= -720
           union all select 2, 'pairs_cut', * from g where delta >= -720 and buy_value between 1 and 200 and view_value between 1 and 200)
"""


def staged(t: Tables) -> DataFrame:
    race = F.when(F.col("user_id") % 7 == 0, "Unknown").when(F.col("user_id") % 7 < 3, "A").otherwise("B")
    return pairs(t, 4320).withColumns({"race": race, "sex": F.col("user_id") % 2})


@query(_STAGED + """
select cast(step as integer) as step, stage, count(*) as p_rows, count(distinct user_id) as n_subjects from s group by 1, 2
""")
def funnel_counts(t: Tables) -> DataFrame:
    return crosstab.funnel_counts(staged(t), "user_id", {s: F.expr(e) for s, e in STAGES.items()})


@query(_STAGED + """,
 c as (select stage, race, sex, count(distinct user_id) as n from s group by 1, 2, 3)
select stage, race, sex, n, round_even(n * 100.0 / sum(n) over (partition by stage), 2) as pct from c
""")
def funnel_shares(t: Tables) -> DataFrame:
    return crosstab.funnel_shares(
        staged(t), "user_id", {s: F.expr(e) for s, e in STAGES.items()}, ["buy_ts", "buy_id"], "race", "sex"
    )


@query("""
with c as (select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2)
select *, round_even(n * 100.0 / sum(n) over (), 2) as pct from c
""")
def crosstab_pct(t: Tables) -> DataFrame:
    return crosstab.crosstab_percent(t.orders, "o_orderpriority", "o_orderstatus")


_LABELLED = """with l as (select case o_orderpriority when '5-LOW' then 'Unknown' else o_orderpriority end as level,
  o_orderstatus as status from orders)"""


def labelled(t: Tables) -> DataFrame:
    level = F.when(F.col("o_orderpriority") == "5-LOW", "Unknown").otherwise(F.col("o_orderpriority"))
    return t.orders.select(level.alias("level"), F.col("o_orderstatus").alias("status"))


@query(_LABELLED + """,
 c as (select level, count(*) as n, sum(case when status = 'F' then 1 else 0 end) as f,
              sum(case when status = 'O' then 1 else 0 end) as o, sum(case when status = 'P' then 1 else 0 end) as p
       from l group by 1)
select level, round_even(f * 100.0 / sum(n) over (), 2) as "pct_F", round_even(o * 100.0 / sum(n) over (), 2) as "pct_O",
  round_even(p * 100.0 / sum(n) over (), 2) as "pct_P", 0.0 as pct_other,
  cast(row_number() over (order by case when level = 'Unknown' then 1 else 0 end, n desc, level) as integer) as place
from c
""")
def crosstab_table(t: Tables) -> DataFrame:
    return crosstab.crosstab_wide(labelled(t), "level", "status", ["F", "O", "P"])


@query(_LABELLED + """,
 c as (select level, count(*) as n, sum(case when status = 'P' then 1 else 0 end) as p from l group by 1)
select level, round_even(p * 100.0 / sum(n) over (), 2) as "pct_P", round_even((n - p) * 100.0 / sum(n) over (), 2) as pct_other,
  cast(row_number() over (order by case when level = 'Unknown' then 1 else 0 end, n desc, level) as integer) as place
from c
""")
def crosstab_other(t: Tables) -> DataFrame:
    """Categories that are not named keep their share."""
    return crosstab.crosstab_wide(labelled(t), "level", "status", ["P"])


@query(_LABELLED + " select status, cast(count(*) as bigint) as total_n from l group by 1")
def crosstab_totals(t: Tables) -> DataFrame:
    return crosstab.cell_totals(crosstab.crosstab_percent(labelled(t), "level", "status"), ["status"], "n")


@query("""
with u as (select o_orderstatus as status, o_orderpriority as level from orders),
 a as (select level, count(*) as n from u where status = 'F' group by 1),
 b as (select level, count(*) as n from u where status = 'P' and level <> '5-LOW' group by 1)
select coalesce(a.level, b.level) as level, coalesce(a.n, 0) as closed_n, coalesce(b.n, 0) as pending_n
from a full join b on a.level = b.level
""")
def crosstab_alignment(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("level"))
    closed = rows.filter("status = 'F'").groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    pending = rows.filter("status = 'P' and level <> '5-LOW'").groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    return crosstab.align_on_label({"closed": closed, "pending": pending}, "level", ["n"])


_WIDE = """with w as (select user_id, cast(ts as date) as day,
  avg(case when event_type = 'view' and value > 0 and value <= 100 then value end) as views,
  avg(case when event_type = 'click' and value between 1 and 80 then value end) as clicks,
  avg(case when event_type = 'error' and value > 5 then value end) as errors,
  avg(case when event_type = 'purchase' and value > 0 and value < 300 then value end) as purchases
  from events group by 1, 2)"""
_COLS = ["views", "clicks", "errors", "purchases"]


def _complete_sql(group: str) -> str:
    lead = f"{group}, " if group else ""
    by = f"group by {group}" if group else ""
    picks = " union all ".join(
        f"select {lead}'{c}' as \"column\", count(*) as n, count({c}) as present, count(*) - count({c}) as missing, "
        f"round(count({c}) / nullif(count(*), 0), 6) as share from w {by}"
        for c in _COLS
    )
    return f"{_WIDE} {picks}"


@query(_complete_sql(""))
def completeness(t: Tables) -> DataFrame:
    return present.completeness(pivot_avg_daily(t), _COLS).withColumn("share", rounded("share"))


@query(_complete_sql("day"))
def completeness_by_group(t: Tables) -> DataFrame:
    return present.completeness(pivot_avg_daily(t), _COLS, ["day"]).withColumn("share", rounded("share"))


@query(_WIDE + """ select user_id, day, cast((views is not null)::int + (clicks is not null)::int + (errors is not null)::int
  + (purchases is not null)::int as integer) as present from w""")
def row_completeness(t: Tables) -> DataFrame:
    wide = pivot_avg_daily(t).select("user_id", "day", *_COLS)
    return present.with_present_count(wide, _COLS).select("user_id", "day", "present").orderBy(
        F.desc("present"), "user_id", "day"
    )


_ORDERS_WIDE = """with w as (select o_orderstatus, o_totalprice,
   case when o_orderpriority <> '5-LOW' then o_totalprice / 7 end as scaled, o_custkey % 100 as c100 from orders)"""


def order_measures(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderstatus",
        "o_totalprice",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 7).alias("scaled"),
        (F.col("o_custkey") % 100).alias("c100"),
    )


_MEASURES = ["o_totalprice", "scaled", "c100"]


@query(_ORDERS_WIDE + " " + " union all ".join(
    f"""select '{c}' as variable, o_orderstatus, count(*) as "rows", count(*) - count({c}) as missing,
    round(quantile_cont({c}::double, 0.25), 4) as q1, round(quantile_cont({c}::double, 0.5), 4) as median,
    round(quantile_cont({c}::double, 0.75), 4) as q3 from w group by o_orderstatus""" for c in _MEASURES))
def tableone_continuous(t: Tables) -> DataFrame:
    out = tableone.describe_continuous(order_measures(t), "o_orderstatus", _MEASURES)
    return out.withColumns({c: rounded(c, 4) for c in tableone.QUARTILES})


@query("""
with l as (select o_orderstatus, 'o_orderpriority' as variable, o_orderpriority as level from orders
  union all select o_orderstatus, 'big', case when o_totalprice > 200000 then '1' when o_totalprice > 50000 then '0' end from orders),
c as (select variable, o_orderstatus, level, count(*) as n from l where level is not null group by 1, 2, 3)
select *, round(n * 100.0 / sum(n) over (partition by variable, o_orderstatus), 6) as pct from c
""")
def tableone_categorical(t: Tables) -> DataFrame:
    big = F.when(F.col("o_totalprice") > 200000, 1).when(F.col("o_totalprice") > 50000, 0)
    out = tableone.describe_categorical(t.orders.withColumn("big", big), "o_orderstatus", ["o_orderpriority", "big"])
    return out.withColumn("pct", rounded("pct"))


@query("""
with o as (select o_orderstatus, o_totalprice, o_orderpriority,
   case when o_totalprice > 200000 then '1' when o_totalprice > 50000 then '0' end as big from orders),
l as (select o_orderstatus, 'o_orderpriority' as variable, o_orderpriority as level from o union all select o_orderstatus, 'big', big from o),
m as (select variable, o_orderstatus, count(*) - count(level) as missing from l group by 1, 2),
c as (select variable, o_orderstatus, level, count(*) as n from l where level is not null group by 1, 2, 3)
select c.*, missing, round(n * 100.0 / sum(n) over (partition by variable, o_orderstatus), 6) as pct,
  null::double as q1, null::double as median, null::double as q3 from c join m using (variable, o_orderstatus)
union all by name
select 'o_totalprice' as variable, o_orderstatus, null as level, count(o_totalprice) as n, count(*) - count(o_totalprice) as missing,
  round(quantile_cont(o_totalprice, 0.25), 4) as q1, round(quantile_cont(o_totalprice, 0.5), 4) as median,
  round(quantile_cont(o_totalprice, 0.75), 4) as q3 from o group by o_orderstatus
""")
def table_one(t: Tables) -> DataFrame:
    big = F.when(F.col("o_totalprice") > 200000, 1).when(F.col("o_totalprice") > 50000, 0)
    out = tableone.table_one(
        t.orders.withColumn("big", big), "o_orderstatus", ["o_orderpriority", "big"], ["o_totalprice"]
    )
    return out.withColumns({c: rounded(c, 4) for c in tableone.QUARTILES}).withColumn("pct", rounded("pct"))


@query(_ORDERS_WIDE + " " + " union all ".join(
    f"""select '{c}' as variable, count({c}) as "count", round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
    min({c})::double as "min", max({c})::double as "max",
    round(quantile_cont({c}::double, 0.25), 4) as q1, round(quantile_cont({c}::double, 0.5), 4) as median,
    round(quantile_cont({c}::double, 0.75), 4) as q3 from w""" for c in _MEASURES))
def describe_columns(t: Tables) -> DataFrame:
    out = tableone.describe_numbers(order_measures(t), _MEASURES)
    return out.withColumns({c: rounded(c, 4) for c in ("mean", "std", "q1", "median", "q3")})


@query("""
with l as (select 'o_orderpriority' as variable, o_orderstatus as g, o_orderpriority as v from orders
           union all select 'ring', o_orderstatus, cast(o_custkey % 4 as varchar) from orders),
c as (select variable, g, v, count(*)::double as n from l group by 1, 2, 3),
e as (select variable, g, v, r.n * k.n / a.n as expected
      from (select variable, g, sum(n) as n from c group by 1, 2) r join (select variable, v, sum(n) as n from c group by 1, 2) k using (variable)
      join (select variable, sum(n) as n from c group by 1) a using (variable))
select variable, round(sum(power(coalesce(c.n, 0) - expected, 2) / expected), 6) as chi2,
  (count(distinct v) - 1) * (count(distinct g) - 1) as dof
from e left join c using (variable, g, v) group by variable
""")
def chi_square_stat(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("ring", F.col("o_custkey") % 4)
    tested = tableone.chi_square(rows, "o_orderstatus", ["o_orderpriority", "ring"])
    return tested.select("variable", rounded("chi2").alias("chi2"), "dof")


_KW = """
with l as (select 'o_totalprice' as variable, o_orderstatus as g, o_totalprice as v from orders
           union all select 'c100', o_orderstatus, o_custkey % 100 from orders),
r as (select *, rank() over (partition by variable order by v) + (count(*) over (partition by variable, v) - 1) / 2.0 as rk,
             count(*) over (partition by variable, v) as t, count(*) over (partition by variable) as n_all from l),
s as (select variable, g, count(*)::double as n, sum(rk) as rs, any_value(n_all)::double as n_all from r group by 1, 2),
h as (select variable, 12.0 / (any_value(n_all) * (any_value(n_all) + 1)) * sum(rs * rs / n) - 3 * (any_value(n_all) + 1) as raw,
             any_value(n_all) as n_all, count(*) - 1 as dof from s group by 1),
c as (select variable, sum(t::double * t - 1) as ties from r group by 1)
select variable, round(raw / (1 - ties / (n_all * n_all * n_all - n_all)), 6) as h, dof from h join c using (variable)
"""


@query(_KW)
def kruskal_wallis_h(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("c100", F.col("o_custkey") % 100)
    tested = tableone.kruskal_wallis(rows, "o_orderstatus", ["o_totalprice", "c100"])
    return tested.select("variable", rounded("h").alias("h"), "dof")


# Upper tail of chi-square for an even number of degrees of freedom, a finite sum.
_TAIL = """select test, variable, round((select sum(exp(-s / 2 + i * ln(s / 2) - lgamma(i + 1)))
   from range(cast(dof // 2 as bigint)) as t(i)), 9) as p_value from stats"""

_CHI = """
l as (select 'o_orderpriority' as variable, o_orderstatus as g, o_orderpriority as v from orders
      union all select 'ring', o_orderstatus, cast(o_custkey % 4 as varchar) from orders
      union all select 'many', o_orderstatus, cast(o_custkey % 700 as varchar) from orders),
cc as (select variable, g, v, count(*)::double as n from l group by 1, 2, 3),
cr as (select variable, g, sum(n) as rn from cc group by 1, 2),
ck as (select variable, v, sum(n) as kn from cc group by 1, 2),
chi as (select variable, sum(n) * (sum(n * n / (rn * kn)) - 1) as s,
          (count(distinct v) - 1) * (count(distinct g) - 1) as dof
        from cc join cr using (variable, g) join ck using (variable, v) group by 1)"""


@query("with " + _CHI + ", kw as (" + _KW.replace("round(raw / (1 - ties / (n_all * n_all * n_all - n_all)), 6)", "raw / (1 - ties / (n_all * n_all * n_all - n_all))") + """),
stats as (select 'Chi-squared' as test, variable, s, dof from chi
          union all select 'Kruskal-Wallis', variable, h, dof from kw where variable = 'o_totalprice')
""" + _TAIL)
def group_test_p_values(t: Tables) -> DataFrame:
    """The tail probabilities beside both statistics, one of them with over a thousand degrees of freedom."""
    rows = t.orders.withColumns({"ring": F.col("o_custkey") % 4, "many": F.col("o_custkey") % 700})
    chi = tableone.chi_square(rows, "o_orderstatus", ["o_orderpriority", "ring", "many"])
    ranks = tableone.kruskal_wallis(rows, "o_orderstatus", ["o_totalprice"])
    both = chi.select(F.lit("Chi-squared").alias("test"), "variable", "p_value").unionByName(
        ranks.select(F.lit("Kruskal-Wallis").alias("test"), "variable", "p_value")
    )
    return both.withColumn("p_value", rounded("p_value", 9))


_RARE = {"rare": "c_custkey % 400 = 7", "rarer": "c_custkey % 700 = 3", "common": "c_custkey % 3 = 1", "debt": "c_acctbal < -990"}


@query("""with r as (select * from customer where c_mktsegment in ('BUILDING', 'MACHINERY')),
l as (""" + " union all ".join(f"select '{n}' as variable, c_mktsegment as g, {e} as v from r" for n, e in _RARE.items()) + """),
c as (select variable, count(*) filter (not v and g = 'BUILDING')::double as a, count(*) filter (not v)::double as r,
        count(*) filter (g = 'BUILDING')::double as c, count(*)::double as n, count(distinct v) as levels, count(distinct g) as strata from l group by 1),
e as (select *, least(r, n - r) * least(c, n - c) / n as small, (levels - 1) * (strata - 1) as dof,
        n * power(a * (n - r - c + a) - (r - a) * (c - a), 2) / nullif(r * (n - r) * c * (n - c), 0) as chi2 from c),
h as (select variable, k, lgamma(r + 1) + lgamma(n - r + 1) + lgamma(c + 1) + lgamma(n - c + 1) - lgamma(n + 1)
        - lgamma(k + 1) - lgamma(r - k + 1) - lgamma(c - k + 1) - lgamma(n - r - c + k + 1) as p, a
      from (select *, unnest(range(greatest(0, r + c - n)::bigint, least(r, c)::bigint + 1)) as k from e where dof = 1)),
f as (select variable, sum(exp(p)) filter (p <= own + 1e-7) as p from (select *, max(p) filter (k = a) over (partition by variable) as own from h) group by 1)
select variable, case when dof = 1 and small < 5 then 'Fisher''s exact' else 'Chi-squared' end as test,
  case when dof = 1 and small < 5 then round(least(f.p, 1), 6)
    when dof = 1 then round(1 - erf_, 6) end as p_value
from e left join f using (variable), lateral (select 2 / sqrt(pi()) * (select sum(power(-1, i) * exp((2 * i + 1) * ln(greatest(sqrt(chi2 / 2), 1e-300)) - lgamma(i + 1)) / (2 * i + 1))
  from range(80) as t(i)) as erf_)
""")
def small_table_tests(t: Tables) -> DataFrame:
    """Flags of customers against two market segments: rare ones get the exact test, and the name of the test stands in the row."""
    two = t.customer.filter("c_mktsegment in ('BUILDING', 'MACHINERY')")
    rows = two.select("c_mktsegment", *[F.expr(e).alias(n) for n, e in _RARE.items()])
    return tableone.association(rows, "c_mktsegment", list(_RARE)).withColumn("p_value", rounded("p_value", 6))


@query("""
select 'o_orderkey' as variable, count(*) as "count", round(quantile_cont((1000000000 + o_orderkey)::double, 0.5), 4) as median,
  round(quantile_cont((1000000000 + o_orderkey)::double, 0.25), 4) as q1 from orders
""")
def narrow_range_quantiles(t: Tables) -> DataFrame:
    """A column whose values all lie within a millionth of each other."""
    out = tableone.describe_numbers(t.orders.select((F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey")), ["o_orderkey"])
    return out.select("variable", "count", rounded("median", 4).alias("median"), rounded("q1", 4).alias("q1"))


@query("""select o_orderkey, o_custkey, count(*) over (partition by o_custkey) as n_pairs from orders""")
def group_size(t: Tables) -> DataFrame:
    return pick.with_group_size(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "n_pairs").select(
        "o_orderkey", "o_custkey", "n_pairs"
    )


@query("""
select o_orderkey, case when o_orderstatus = 'F' then o_totalprice end as price_closed,
  case when o_orderstatus = 'O' then o_totalprice end as price_open from orders
""")
def outcome_columns(t: Tables) -> DataFrame:
    from curata.plans.patients import by_outcome

    return t.orders.select(
        "o_orderkey",
        *by_outcome("o_totalprice", F.col("o_orderstatus"), {"price_closed": "F", "price_open": "O"}),
    )


@query(_STAGED + """ select buy_id, case when view_value >= 20 and buy_value < 20 then 1 else 0 end as hidden,
   case when race = 'A' then 'A' else 'Other' end as race_two from g""")
def hidden_flag(t: Tables) -> DataFrame:
    from curata.plans.patients import hidden_low, two_levels

    return staged(t).select(
        "buy_id",
        hidden_low(F.col("view_value"), F.col("buy_value"), 20).alias("hidden"),
        two_levels(F.col("race"), "A", "Other").alias("race_two"),
    )


@query("""
select 'orders' as source, (select count(*) from (select distinct o_custkey, o_orderdate from orders)) = (select count(*) from orders) as one_row_per_key,
  (select count(*) - count(o_custkey) from orders) as null_keys
union all
select 'lineitem', (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) = (select count(*) from lineitem),
  (select count(*) - count(l_orderkey) from lineitem)
""")
def quality_checks(t: Tables) -> DataFrame:
    from curata.reports.checks import key_check

    return key_check(t.orders, ["o_custkey", "o_orderdate"], "orders").unionByName(
        key_check(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")
    )


@query("""select event_type, count(*) as "rows", count(distinct user_id) as n_user_id from events group by 1""")
def distinct_counts(t: Tables) -> DataFrame:
    from curata.reports.checks import distinct_counts as counted

    return counted(t.events, ["user_id"], ["event_type"])


@query(_WIDE + " select " + ", ".join(f"count(*) - count({c}) as {c}" for c in _COLS) + " from w")
def null_counts(t: Tables) -> DataFrame:
    from curata.reports.checks import null_counts as counted

    return counted(pivot_avg_daily(t), _COLS)


@query(_WIDE + """ select user_id, day, 'all' as rule from w where views is not null and clicks is not null
union all select user_id, day, 'any' from w where views is not null or clicks is not null""")
def null_filters(t: Tables) -> DataFrame:
    wide = pivot_avg_daily(t)
    complete = wide.dropna(how="any", subset=["views", "clicks"])
    partial = wide.dropna(how="all", subset=["views", "clicks"])
    return complete.select("user_id", "day", F.lit("all").alias("rule")).union(
        partial.select("user_id", "day", F.lit("any").alias("rule"))
    )
