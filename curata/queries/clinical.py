"""The clinical plans on derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.operators.pivot import Measure, Range
from curata.operators import harmonise
from curata.plans import (
    comorbidity, dataset, funnel, gases, infusions, labs, patients, pressure, severity, ventilation, vitals, weights,
)
from curata.queries.derived import ctes, derived
from curata.queries.registry import Tables, query, rounded
from curata.session import settle


def _holds(r: Range, v: str) -> str:
    tests = [f"{v} is not null"]
    for sign, bound in ((">", r.above), (">=", r.at_least), ("<", r.below), ("<=", r.at_most)):
        if bound is not None:
            tests.append(f"{v} {sign} {bound}")
    return " and ".join(tests)


def _text(x) -> str:
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


def _pivot_columns(measures: list[Measure], item: str, value: str, how: str, digits: int = 6) -> str:
    arms: dict[str, list[str]] = {}
    for m in measures:
        got = f"({value} - {m.shift}) / {m.scale}" if m.shift or m.scale != 1 else value
        items = ", ".join(_text(i) for i in m.items) or "null"
        arms.setdefault(m.name, []).append(f"when {item} in ({items}) and {_holds(m.valid, value)} then {got}")
    return ", ".join(
        f"round({how}(case {' '.join(a)} end), {2 if n == 'temperature' else digits}) as {n}" for n, a in arms.items()
    )


def six_digits(df: DataFrame, keep: set[str]) -> DataFrame:
    return df.withColumns({c: rounded(c) for c, kind in df.dtypes if kind == "double" and c not in keep})


_VITAL_ITEMS = ", ".join(str(i) for m in vitals.VITALS for i in m.items) + f", {vitals.TEMPERATURE_SITE}"


@query(f"""with {ctes('chart_events')}
select subject_id, stay_id, charttime, {_pivot_columns(vitals.VITALS, 'itemid', 'valuenum', 'avg')},
  max(case when itemid = 224642 then value end) as temperature_site
from chart_events where stay_id is not null and itemid in ({_VITAL_ITEMS}) group by 1, 2, 3""")
def vital_signs(t: Tables) -> DataFrame:
    return six_digits(vitals.vital_signs(derived(t, "chart_events")), {"temperature"})


_PRESSURE_ITEMS = ", ".join(str(i) for m in vitals.PRESSURES for i in m.items)


@query(f"""with {ctes('chart_events')}
select icustay_id, charttime, {_pivot_columns(vitals.PRESSURES, 'older_item', 'valuenum', 'avg')}
from chart_events where (error is null or error <> 1) and icustay_id is not null and older_item in ({_PRESSURE_ITEMS})
group by 1, 2""")
def blood_pressures(t: Tables) -> DataFrame:
    events = derived(t, "chart_events").drop("itemid").withColumnRenamed("older_item", "itemid")
    return six_digits(vitals.blood_pressures(events), set())


_LAB_NAMES = ", ".join(_text(n) for m in labs.REVISED_LABS for n in m.items)
_LAB_RULES = " or ".join(
    f"(labname in ({', '.join(_text(n) for n in m.items)}) and {_holds(m.valid, 'v')})" for m in labs.REVISED_LABS
)


@query(f"""with {ctes('lab_revisions')},
ok as (select patientunitstayid, labname, labresultoffset, labresultrevisedoffset, min(labresult) as v
       from lab_revisions where labname in ({_LAB_NAMES}) group by 1, 2, 3, 4 having count(distinct labresult) <= 1),
r as (select *, row_number() over (partition by patientunitstayid, labname, labresultoffset
                                   order by labresultrevisedoffset desc) as rn from ok where {_LAB_RULES})
select patientunitstayid, labresultoffset as chartoffset,
  {_pivot_columns([Measure(m.name, m.items) for m in labs.REVISED_LABS], 'labname', 'v', 'max')}
from r where rn = 1 group by 1, 2""")
def revised_labs(t: Tables) -> DataFrame:
    return labs.revised_labs(derived(t, "lab_revisions"))


def _fuzzy(name: str, table: str, stay: str, start: str, end: str) -> str:
    return f"""{name}_n as (select subject_id, {stay}, {start} as s, {end} as e, lag({end}) over w as pe, lead({start}) over w as ns
  from {table} window w as (partition by subject_id order by {start}, {stay})),
{name} as (select subject_id, {stay},
  case when pe > s - interval 24 hour then s - to_seconds(cast(round(date_diff('second', pe, s) / 2.0) as bigint))
       else s - interval 12 hour end as ds,
  case when ns < e + interval 24 hour then e + to_seconds(cast(round(date_diff('second', e, ns) / 2.0) as bigint))
       else e + interval 12 hour end as de from {name}_n)"""


_TIMED_ITEMS = ", ".join(str(i) for m in labs.TIMED_LABS for i in m.items) + ", 51297"


@query(f"""with {ctes('timed_lab_events', 'admissions', 'icu_stays')},
{_fuzzy('adm', 'admissions', 'hadm_id', 'admittime', 'dischtime')},
{_fuzzy('iid', 'icu_stays', 'icustay_id', 'intime', 'outtime')},
le as (select subject_id, charttime, {_pivot_columns(labs.TIMED_LABS, 'itemid', 'valuenum', 'avg')}
       from timed_lab_events where itemid in ({_TIMED_ITEMS}) and valuenum > 0 group by 1, 2)
select iid.icustay_id, adm.hadm_id, le.* from le
left join adm on adm.subject_id = le.subject_id and le.charttime >= adm.ds and le.charttime < adm.de
left join iid on iid.subject_id = le.subject_id and le.charttime >= iid.ds and le.charttime < iid.de""")
def timed_labs(t: Tables) -> DataFrame:
    wide = labs.timed_labs(derived(t, "timed_lab_events"), derived(t, "icu_stays"), derived(t, "admissions"))
    return six_digits(wide, set())


@query(f"""with {ctes('charted_vitals', 'vital_aperiodic', 'vital_periodic')},
b as (
  select patientunitstayid, chartoffset as observationoffset, nibp_systolic as sbp, nibp_diastolic as dbp,
    round(coalesce(nibp_mean, nibp_diastolic + (nibp_systolic - nibp_diastolic) / 3), 0) as map, 4 as src
  from charted_vitals where coalesce(nibp_systolic, 0) + coalesce(nibp_diastolic, 0) + coalesce(nibp_mean, 0) <> 0
  union all select patientunitstayid, chartoffset, ibp_systolic, ibp_diastolic,
    round(coalesce(ibp_mean, ibp_diastolic + (ibp_systolic - ibp_diastolic) / 3), 0), 2
  from charted_vitals where coalesce(ibp_systolic, 0) + coalesce(ibp_diastolic, 0) + coalesce(ibp_mean, 0) <> 0
  union all select patientunitstayid, observationoffset, noninvasivesystolic, noninvasivediastolic,
    round(coalesce(noninvasivemean, noninvasivediastolic + (noninvasivesystolic - noninvasivediastolic) / 3), 0), 3
  from vital_aperiodic where coalesce(noninvasivesystolic, 0) + coalesce(noninvasivesystolic, 0) + coalesce(noninvasivemean, 0) <> 0
  union all select patientunitstayid, observationoffset, systemicsystolic, systemicdiastolic,
    round(coalesce(systemicmean, systemicdiastolic + (systemicsystolic - systemicdiastolic) / 3), 0), 1
  from vital_periodic where coalesce(systemicsystolic, 0) + coalesce(systemicdiastolic, 0) + coalesce(systemicmean, 0) <> 0),
k as (select distinct patientunitstayid, observationoffset from b),
s as (select *, row_number() over (partition by patientunitstayid, observationoffset order by src, sbp) rn from b where sbp > 0 and sbp < 400),
d as (select *, row_number() over (partition by patientunitstayid, observationoffset order by src, dbp) rn from b where dbp > 0 and dbp < 300),
m as (select *, row_number() over (partition by patientunitstayid, observationoffset order by src, map) rn from b where map > 0 and map < 300)
select k.*, s.sbp, d.dbp, m.map from k
left join s on s.patientunitstayid = k.patientunitstayid and s.observationoffset = k.observationoffset and s.rn = 1
left join d on d.patientunitstayid = k.patientunitstayid and d.observationoffset = k.observationoffset and d.rn = 1
left join m on m.patientunitstayid = k.patientunitstayid and m.observationoffset = k.observationoffset and m.rn = 1""")
def merged_blood_pressure(t: Tables) -> DataFrame:
    return pressure.merged_pressure(
        derived(t, "charted_vitals"), derived(t, "vital_aperiodic"), derived(t, "vital_periodic")
    )


_WEIGHT_RULES = """
  case when a <= 20 and a > 1 and ratio <= 0.15 then a * 10 when a <= 1 and ratio <= 0.15 then a * 100
       when a >= 300 and ratio > 6.9 then a / 10 else a end as a2,
  case when d >= 300 and ratio <= 0.15 then d / 10 when d <= 20 and ratio > 6.9 then null else d end as d2"""


def _weights_sql(source: str, swapped: str = "1355321, 2387379") -> str:
    return f"""
w as (select k, a, d, case when d > 0 then round(a / d, 2) end as ratio from {source}
      where (a > 0 and d > 0) or a is null or d is null),
f as (select k, {_WEIGHT_RULES} from w)
select distinct k, round(case when k in ({swapped}) then d2 when a2 < 2.5 then null else a2 end, 6) as a,
  round(d2, 6) as d from f"""


@query(f"""with x as (select o_orderkey as k, o_totalprice / 1000 as a, sum(l_extendedprice) / 100 as d
   from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_totalprice),
{_weights_sql('x')}""")
def weight_ratio_cleaning(t: Tables) -> DataFrame:
    spent = t.lineitem.groupBy("l_orderkey").agg((F.sum("l_extendedprice") / 100).alias("d"))
    rows = t.orders.join(spent, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("o_orderkey").alias("k"), (F.col("o_totalprice") / 1000).alias("a"), "d"
    )
    return six_digits(weights.clean_weights(rows, "k", "a", "d"), set())


@query(f"""with {ctes('stay_weights')},
x as (select patientunitstayid as k, admissionweight as a, dischargeweight as d from stay_weights),
g as ({'with ' + _weights_sql('x').lstrip()})
select k as patientunitstayid, a as admissionweight, d as dischargeweight from g""")
def stay_weights_repaired(t: Tables) -> DataFrame:
    return six_digits(weights.clean_weights(derived(t, "stay_weights")), set())


_SWAPPED = (4, 5, 17, 32)


@query(f"""with {ctes('stay_weights')},
x as (select patientunitstayid as k, admissionweight as a, dischargeweight as d from stay_weights),
g as ({'with ' + _weights_sql('x', ', '.join(map(str, _SWAPPED))).lstrip()})
select k as patientunitstayid, a as admissionweight, d as dischargeweight from g""")
def stay_weights_swapped(t: Tables) -> DataFrame:
    """Named stays, all of them in the fixture, get their discharge weight as admission weight."""
    return six_digits(weights.clean_weights(derived(t, "stay_weights"), swapped=_SWAPPED), {"patientunitstayid"})


def _unit_sql(drug: infusions.Drug) -> str:
    arms = []
    for name, u in drug.units.items():
        by = " * ".join((["60"] if u.per_hour else []) + (["w"] if u.by_weight else [])) or "1"
        arms.append(f"when {_text(name)} then {u.factor} * r / ({by})")
    return f"case drugname {' '.join(arms)} end"


def _infusion_sql(drug: infusions.Drug) -> str:
    likes = " or ".join(f"drugname like {_text(p)}" for p in drug.names_like)
    not_in = ", ".join(_text(x) for x in drug.not_rates)
    not_like = " ".join(f"and drugrate not like {_text(p)}" for p in drug.not_rates_like)
    known = " ".join(f"when drugname = {_text(k)} then {_text(v)}" for k, v in drug.known.items())
    known += "".join(f" when drugname like {_text(k)} then {_text(v)}" for k, v in drug.known_like.items())
    imputed = " or ".join(f"drugname like {_text(p)}" for p in drug.imputed_like)
    plain = " or ".join(f"drugname like {_text(p)}" for p in drug.plain_like)
    volume = ", ".join(_text(v) for v in drug.volume_names)
    tables = ["infusion_log", "user_weights"] + (["drug_orders"] if drug.order_like else [])
    if drug.order_like:
        arms = []
        for o in drug.orders:
            test = f"m.drugname in ({', '.join(_text(n) for n in o.names) or 'null'})"
            if o.pattern:
                test = f"({test} or m.drugname like {_text(o.pattern)})"
            if o.dosage:
                test += f" and m.dosage = {_text(o.dosage)}"
            arms.append(f"when {test} then {o.constant if o.rule is None else f'{o.rule.factor} * r / (60 * w)'}")
        vol = f"""select distinct i.infusiondrugid, i.patientunitstayid, infusionoffset, i.drugname, case {' '.join(arms)} end as rate,
   infusionrate, drugamount, volumeoffluid, patientweight
 from g i join drug_orders m on m.patientunitstayid = i.patientunitstayid and m.drugordercancelled = 'No'
  and m.drugname like {_text(drug.order_like)} and infusionoffset between drugstartoffset and drugstopoffset
 where i.drugname in ({volume})"""
    else:
        vol = f"""select infusiondrugid, patientunitstayid, infusionoffset, drugname, {drug.volume_rule.factor} * r / (60 * w),
   infusionrate, drugamount, volumeoffluid, patientweight from g where drugname in ({volume})"""
    return f"""with {ctes(*tables)},
i0 as (select * exclude (drugrate), try_cast(drugrate as double) as r from infusion_log
       where ({likes}) and drugrate not in ({not_in}) {not_like}),
bl as (select distinct patientunitstayid from i0 where drugname = {_text(drug.blank)}),
c as (select i0.*, case {known} end as code from i0 semi join bl using (patientunitstayid) where {imputed}),
f as (select * exclude (code, drugname), coalesce(
    last_value(code ignore nulls) over (partition by patientunitstayid order by infusionoffset, code is null, infusiondrugid
       rows between unbounded preceding and current row),
    first_value(code ignore nulls) over (partition by patientunitstayid order by infusionoffset, code is null, infusiondrugid
       rows between current row and unbounded following)) as drugname from c),
g0 as (select distinct * from (select * from f union all by name
       select * from i0 anti join bl using (patientunitstayid) where {plain})),
wc as (with {_weights_sql('(select patientunitstayid as k, admissionweight as a, dischargeweight as d from user_weights)').lstrip()}),
g as (select g0.*, coalesce(a, d, 80) as w from g0 left join wc on k = patientunitstayid),
u as (select infusiondrugid, patientunitstayid, infusionoffset, drugname, {_unit_sql(drug)} as rate,
   infusionrate, drugamount, volumeoffluid, patientweight from g where drugname in ({', '.join(_text(n) for n in drug.units)})
  union all {vol})
select distinct infusiondrugid, patientunitstayid, infusionoffset, drugname, cast(round(cast(rate as decimal(38, 9)), 4) as double) as {drug.rate},
  infusionrate, drugamount, volumeoffluid, patientweight from u"""


def _infusions(t: Tables, drug: infusions.Drug) -> DataFrame:
    cleaned = weights.clean_weights(derived(t, "user_weights"))
    orders = derived(t, "drug_orders") if drug.order_like else None
    return infusions.infusion_rates(derived(t, "infusion_log"), cleaned, drug, orders)


@query(_infusion_sql(infusions.NOREPINEPHRINE))
def norepinephrine_rates(t: Tables) -> DataFrame:
    return _infusions(t, infusions.NOREPINEPHRINE)


@query(_infusion_sql(infusions.EPINEPHRINE))
def epinephrine_rates(t: Tables) -> DataFrame:
    return _infusions(t, infusions.EPINEPHRINE)


@query(_infusion_sql(infusions.DOPAMINE))
def dopamine_rates(t: Tables) -> DataFrame:
    return _infusions(t, infusions.DOPAMINE)


@query(f"""with {ctes('infusion_log')}
select infusiondrugid, patientunitstayid, infusionoffset, drugname, cast(round(cast(try_cast(drugrate as double) as decimal(38, 9)), 4) as double) as rate_dobutamine,
  infusionrate, drugamount, volumeoffluid, patientweight from infusion_log
where (drugname like '%Dobutamine%' or drugname like '%DOBUTamine%') and drugrate <> ''""")
def dobutamine_rates(t: Tables) -> DataFrame:
    return infusions.dobutamine_rates(derived(t, "infusion_log"))


def _nested(name: str) -> str:
    from curata.queries.registry import SQL

    return SQL[name]


@query(" union all ".join(
    f"""select '{d.rate}' as drug, infusiondrugid, patientunitstayid, infusionoffset, drugname, {d.rate} as rate, infusionrate, drugamount, volumeoffluid,
  patientweight from ({_nested(d.rate.removeprefix('rate_') + '_rates')})""" for d in infusions.VASOACTIVE))
def vasoactive_rates(t: Tables) -> DataFrame:
    """The rates of all drugs from one reading of the log."""
    cleaned = weights.clean_weights(derived(t, "user_weights"))
    return infusions.rates_of(derived(t, "infusion_log"), cleaned, infusions.VASOACTIVE, derived(t, "drug_orders"))


_ON = """cplitemvalue like 'Intubated%' or cplitemvalue in ('Ventilated - chronic dependency',
  'Ventilated - with daily extubation evaluation', 'Ventilated - with no daily extubation trial', 'Non-invasive ventilation')"""
_VENT_STATES = f"""
e as (select *, case when {_ON} then 1 else 0 end as flag from careplan
      where cplgroup in ('Airway', 'Ventilation') and cplitemvalue <> ''),
p as (select *, row_number() over (partition by patientunitstayid, cplitemoffset
        order by flag desc, case when flag = 1 then cplitemvalue end, case when flag = 1 then cplgeneralid end,
                 cplitemvalue desc, cplgeneralid desc) as rn from e),
st as (select patientunitstayid as k, cplitemoffset as at0, flag, activeupondischarge as active from p where rn = 1),
la as (select *, row_number() over (partition by k order by at0 desc) as rn from st),
al as (select k, at0, flag from st union all
       select k, case when active then unitdischargeoffset else at0 + 60 end, 0
       from la join unit_stays on patientunitstayid = k where rn = 1 and flag = 1)"""
_VENT_RUNS = f"""{_VENT_STATES},
vr as (select *, sum(1 - flag) over (partition by k order by at0, 1 - flag rows between unbounded preceding and 1 preceding) as grp,
         min(case when flag = 0 then at0 end) over (partition by k order by at0, 1 - flag
             rows between 1 following and unbounded following) as closed from al),
ve as (select k as patientunitstayid, min(at0) as starttime, min(closed) as endtime from vr where flag = 1
       group by k, coalesce(grp, 0) having min(closed) is not null)"""


@query(f"with {ctes('careplan', 'unit_stays')}, {_VENT_RUNS} select * from ve")
def ventilation_runs(t: Tables) -> DataFrame:
    return ventilation.ventilation_episodes(derived(t, "careplan"), derived(t, "unit_stays"))


@query(f"""with {ctes('careplan', 'unit_stays')}, {_VENT_STATES},
l as (select *, lead(at0) over (partition by k order by at0, 1 - flag) as nx from al),
g as (select distinct k, unnest([at0, nx]) as edge from l where flag = 1 and nx is not null),
n as (select k, edge, lead(edge) over w as e, row_number() over w as rn from g window w as (partition by k order by edge))
select k as patientunitstayid, edge as starttime, e as endtime from n where rn % 2 = 1 and e is not null""")
def ventilation_endpoints(t: Tables) -> DataFrame:
    return ventilation.ventilation_episodes(derived(t, "careplan"), derived(t, "unit_stays"), pairing="endpoints")


@query(f"""with {ctes('careplan', 'unit_stays')}, {_VENT_STATES},
n as (select *, lag(flag) over w as was, lead(flag) over w as next_flag from al window w as (partition by k order by at0, 1 - flag)),
g as (select k, flag, at0 from n where (flag = 1 and was is distinct from 1) or (flag = 0 and next_flag is distinct from 0)),
r as (select *, row_number() over (partition by k, flag order by at0 desc) as rn from g)
select a.k as patientunitstayid, a.at0 as starttime, b.at0 as endtime from r a join r b on b.k = a.k and b.rn = a.rn and a.flag = 1 and b.flag = 0""")
def ventilation_ranked(t: Tables) -> DataFrame:
    return ventilation.ventilation_episodes(derived(t, "careplan"), derived(t, "unit_stays"), pairing="ranks")


def _severity_inputs(t: Tables) -> dict:
    return {
        "stays": derived(t, "unit_stays"),
        "pressure": merged_blood_pressure(t),
        "gases": derived(t, "gas_panel"),
        "ventilation": ventilation_runs(t),
        "scores": derived(t, "coma_scores"),
        "labs": derived(t, "narrow_labs"),
        "urine": derived(t, "urine"),
        "infusions": vasoactive_rates(t),
    }


_SIGNALS = f"""
sg as (select patientunitstayid as k, cast(ceil(observationoffset / 60.0) as bigint) as hr, min(map) as meanbp_min from bp0
       where map > 0 and map < 300 group by 1, 2),
gc as (select patientunitstayid as k, cast(ceil(chartoffset / 60.0) as bigint) as hr, min(gcs) as gcs_min from coma_scores group by 1, 2),
lb as (select patientunitstayid as k, cast(ceil(chartoffset / 60.0) as bigint) as hr, max(bilirubin) as bilirubin_max,
         max(creatinine) as creatinine_max, min(platelets) as platelet_min from narrow_labs group by 1, 2),
pr as (select g.patientunitstayid, chartoffset, round(pao2 / fio2, 0) as ratio, ve0.patientunitstayid as v
       from gas_panel g left join ve0 on ve0.patientunitstayid = g.patientunitstayid and chartoffset >= starttime and chartoffset <= endtime
       where fio2 is not null and pao2 is not null),
pf as (select patientunitstayid as k, cast(ceil(chartoffset / 60.0) as bigint) as hr,
         min(case when v is null then ratio end) as pao2fio2_novent, min(case when v is not null then ratio end) as pao2fio2_vent
       from pr group by 1, 2),
uo as (select patientunitstayid as k, cast(ceil(chartoffset / 60.0) as bigint) as hr, sum(urineoutput) as urineoutput from urine group by 1, 2),
""" + ",\n".join(
    f"""{a} as (select patientunitstayid as k, cast(ceil(infusionoffset / 60.0) as bigint) as hr, max(rate_{d}) as rate_{d}
     from {a}0 where rate_{d} > 0 group by 1, 2)"""
    for a, d in (("ne", "norepinephrine"), ("ep", "epinephrine"), ("dp", "dopamine"), ("db", "dobutamine"))
)


def severity_ctes() -> str:
    """The hours of each stay with points, in ``wo``: worst of the 24 hours up to each, and of the 24 from it on."""
    nested = ",\n".join(
        f"{alias} as ({_nested(name)})"
        for alias, name in (
            ("bp0", "merged_blood_pressure"), ("ve0", "ventilation_runs"), ("ne0", "norepinephrine_rates"),
            ("ep0", "epinephrine_rates"), ("dp0", "dopamine_rates"), ("db0", "dobutamine_rates"),
        )
    )
    joins = " ".join(f"left join {s} on {s}.k = gr.k and {s}.hr = gr.hr" for s in "sg gc lb pf uo ne ep dp db".split())
    worst = ", ".join(
        f"coalesce(max({c}) over w, 0) as {c}_24hours, coalesce(max({c}) over f, 0) as {c}_next24" for c in severity.COMPONENTS
    )
    return f"""with {ctes('unit_stays', 'gas_panel', 'coma_scores', 'narrow_labs', 'urine')},
{nested}, {_SIGNALS},
gr as (select patientunitstayid as k, unnest(generate_series(-24, cast(ceil(unitdischargeoffset / 60.0) as bigint))) as hr
       from unit_stays where age <> ''),
hx as (select gr.k, gr.hr, meanbp_min, gcs_min, bilirubin_max, creatinine_max, platelet_min, pao2fio2_novent, pao2fio2_vent,
         rate_norepinephrine, rate_epinephrine, rate_dopamine, rate_dobutamine, urineoutput,
         sum(urineoutput) over (partition by gr.k order by gr.hr rows between 23 preceding and current row) as u24
       from gr {joins}),
sc as (select *,
  case when pao2fio2_vent < 100 then 4 when pao2fio2_vent < 200 then 3 when pao2fio2_novent < 300 then 2
       when pao2fio2_novent < 400 then 1 when coalesce(pao2fio2_vent, pao2fio2_novent) is null then null else 0 end as respiration,
  case when platelet_min < 20 then 4 when platelet_min < 50 then 3 when platelet_min < 100 then 2 when platelet_min < 150 then 1
       when platelet_min is null then null else 0 end as coagulation,
  case when bilirubin_max >= 12 then 4 when bilirubin_max >= 6 then 3 when bilirubin_max >= 2 then 2 when bilirubin_max >= 1.2 then 1
       when bilirubin_max is null then null else 0 end as liver,
  case when rate_dopamine > 15 or rate_epinephrine > 0.1 or rate_norepinephrine > 0.1 then 4
       when rate_dopamine > 5 or rate_epinephrine <= 0.1 or rate_norepinephrine <= 0.1 then 3
       when rate_dopamine > 0 or rate_dobutamine > 0 then 2 when meanbp_min < 70 then 1
       when coalesce(meanbp_min, rate_dopamine, rate_dobutamine, rate_epinephrine, rate_norepinephrine) is null then null else 0 end as cardiovascular,
  case when gcs_min >= 13 and gcs_min <= 14 then 1 when gcs_min >= 10 and gcs_min <= 12 then 2 when gcs_min >= 6 and gcs_min <= 9 then 3
       when gcs_min < 6 then 4 when gcs_min is null then null else 0 end as cns,
  case when creatinine_max >= 5 then 4 when u24 < 200 then 4 when creatinine_max >= 3.5 and creatinine_max < 5 then 3 when u24 < 500 then 3
       when creatinine_max >= 2 and creatinine_max < 3.5 then 2 when creatinine_max >= 1.2 and creatinine_max < 2 then 1
       when coalesce(u24, creatinine_max) is null then null else 0 end as renal from hx),
wo as (select *, {worst} from sc window w as (partition by k order by hr rows between 23 preceding and current row),
  f as (partition by k order by hr rows between current row and 23 following))"""


def _severity_sql() -> str:
    total = " + ".join(f"{c}_24hours" for c in severity.COMPONENTS)
    ints = ", ".join(f"cast({c} as integer) as {c}, cast({c}_24hours as integer) as {c}_24hours" for c in severity.COMPONENTS)
    return f"""{severity_ctes()}
select k as patientunitstayid, cast(hr as integer) as hr, meanbp_min, gcs_min, bilirubin_max, creatinine_max, platelet_min,
  pao2fio2_novent, pao2fio2_vent, rate_norepinephrine, rate_epinephrine, rate_dopamine, rate_dobutamine,
  round(urineoutput, 6) as urineoutput, {ints}, cast({total} as integer) as sofa_24hours
from wo where hr >= 0"""


@query(_severity_sql())
def severity_score(t: Tables) -> DataFrame:
    hourly = severity.hourly_inputs(**_severity_inputs(t))
    return severity.severity_scores(hourly).withColumn("urineoutput", rounded("urineoutput"))


_FLAGS = ", ".join(
    f"max(case when pasthistorypath in ({', '.join(_text(p) for p in paths)}) then {weight} else 0 end) as {name}"
    for name, (weight, paths) in comorbidity.CATEGORIES.items()
)


@query(f"""with {ctes('aged_patients', 'past_history')},
x as (select s.patientunitstayid, {_FLAGS},
  case when s.age like '>%89' then 5 when s.age = '' then 0 when try_cast(s.age as double) between 80 and 89 then 4
       when try_cast(s.age as double) between 70 and 79 then 3 when try_cast(s.age as double) between 60 and 69 then 2
       when try_cast(s.age as double) between 50 and 59 then 1 else 0 end as age_score_charlson
  from aged_patients s left join past_history h on h.patientunitstayid = s.patientunitstayid group by s.patientunitstayid, s.age)
select *, {' + '.join(comorbidity.CATEGORIES)} + age_score_charlson as charlson_score from x""")
def comorbidity_score(t: Tables) -> DataFrame:
    return comorbidity.comorbidity_scores(derived(t, "aged_patients"), derived(t, "past_history"))


_GAS_SQL = f"""gx as (select subject_id, hadm_id, charttime, min(case when label = 'pH' then value end) as ph0,
   min(case when label = 'pCO2' then value end) as pc0, min(case when label = 'pO2' then value end) as po0,
   min(case when label = 'Oxygen Saturation' then value end) as sa0,
   min(case when label = 'Carboxyhemoglobin' then value end) as "Carboxyhemoglobin",
   min(case when label = 'Methemoglobin' then value end) as "Methemoglobin",
   min(case when label = 'Specimen Type' then value end) as sp
  from gas_lab_events e join gas_lab_items i on i.itemid = e.itemid where category = 'Blood Gas' group by 1, 2, 3),
tg as (select subject_id, hadm_id, charttime, try_cast(ph0 as double) as "pH", try_cast(pc0 as double) as "pCO2",
   try_cast(po0 as double) as "pO2", try_cast(sa0 as double) as "SaO2", "Carboxyhemoglobin", "Methemoglobin"
  from gx where hadm_id is not null and sp = 'ART.' and try_cast(ph0 as double) is not null and try_cast(pc0 as double) is not null
   and try_cast(po0 as double) is not null and try_cast(sa0 as double) is not null)"""
_OXI_SQL = """ox as (select subject_id, hadm_id, stay_id, charttime, avg(valuenum) as "SpO2" from oximetry_events
   where itemid in (select itemid from oximetry_items where linksto = 'chartevents' and label = 'O2 saturation pulseoxymetry'
                     and category in ('Respiratory', 'Routine Vital Signs'))
   group by 1, 2, 3, 4 having avg(valuenum) is not null and hadm_id is not null)"""
_GAS_TABLES = ("gas_lab_events", "gas_lab_items", "oximetry_events", "oximetry_items")


@query(f"with {ctes('gas_lab_events', 'gas_lab_items')}, {_GAS_SQL} select * from tg")
def timed_gas_panel(t: Tables) -> DataFrame:
    return gases.timed_gases(derived(t, "gas_lab_events"), derived(t, "gas_lab_items"), **gases.FIRST_SOURCE)


@query(f"with {ctes('oximetry_events', 'oximetry_items')}, {_OXI_SQL} select * from ox")
def timed_oximetry_series(t: Tables) -> DataFrame:
    return gases.timed_oximetry(derived(t, "oximetry_events"), derived(t, "oximetry_items"), "stay_id")


_TIMED_PAIRS = f"""{_GAS_SQL}, {_OXI_SQL},
tp as (select tg.subject_id, tg.hadm_id, tg.charttime as "SaO2_timestamp", "pH", "pCO2", "pO2", "SaO2", "Carboxyhemoglobin",
   "Methemoglobin", ox.stay_id, ox."SpO2", ox.charttime as "SpO2_timestamp",
   date_diff('microsecond', tg.charttime, ox.charttime) / 60000000.0 as "delta_SpO2"
  from tg asof join (select * from ox where subject_id in (select subject_id from tg)) ox
    on ox.hadm_id = tg.hadm_id and tg.charttime >= ox.charttime
  where date_diff('microsecond', ox.charttime, tg.charttime) <= 90 * 60000000::bigint)"""


def _timed_pairs(t: Tables, panel: DataFrame | None = None) -> DataFrame:
    return gases.timed_pairs(timed_gas_panel(t) if panel is None else panel, timed_oximetry_series(t), "stay_id")


# The second source: the same steps with its spellings, its own identifiers and what it asks of a gas.
_GAS_SQL_B = """gxb as (select subject_id, hadm_id, charttime, min(case when label = 'pH' then value end) as ph0,
   min(case when label = 'pCO2' then value end) as pc0, min(case when label = 'pO2' then value end) as po0,
   min(case when label = 'Oxygen Saturation' then value end) as sa0,
   min(case when label = 'Carboxyhemoglobin' then value end) as "Carboxyhemoglobin",
   min(case when label = 'Methemoglobin' then value end) as "Methemoglobin",
   min(case when label = 'SPECIMEN TYPE' then value end) as sp
  from gas_lab_events_b e join gas_lab_items_b i on i.itemid = e.itemid where category in ('Blood Gas', 'BLOOD GAS') group by 1, 2, 3),
tgb as (select subject_id, hadm_id, charttime, try_cast(ph0 as double) as "pH", try_cast(pc0 as double) as "pCO2",
   try_cast(po0 as double) as "pO2", try_cast(sa0 as double) as "SaO2", "Carboxyhemoglobin", "Methemoglobin"
  from gxb where hadm_id is not null and sp = 'ART' and try_cast(ph0 as double) is not null and pc0 is not null
   and try_cast(po0 as double) is not null and try_cast(sa0 as double) is not null)"""
_OXI_SQL_B = _OXI_SQL.replace("ox as", "oxb as").replace("stay_id", "icustay_id").replace("oximetry_events", "oximetry_events_b")
_GAS_TABLES_B = ("gas_lab_events_b", "gas_lab_items_b", "oximetry_events_b")
_TIMED_PAIRS_B = f"""{_GAS_SQL_B}, {_OXI_SQL_B},
tpb as (select tgb.subject_id, tgb.hadm_id, tgb.charttime as "SaO2_timestamp", "pH", "pCO2", "pO2", "SaO2", "Carboxyhemoglobin",
   "Methemoglobin", o.icustay_id, o."SpO2", o.charttime as "SpO2_timestamp",
   date_diff('microsecond', tgb.charttime, o.charttime) / 60000000.0 as "delta_SpO2"
  from tgb asof join (select * from oxb where subject_id in (select subject_id from tgb)) o
    on o.hadm_id = tgb.hadm_id and tgb.charttime >= o.charttime
  where date_diff('microsecond', o.charttime, tgb.charttime) <= 90 * 60000000::bigint)"""


@query(f"with {ctes('gas_lab_events_b', 'gas_lab_items_b')}, {_GAS_SQL_B} select * from tgb")
def timed_gas_panel_b(t: Tables) -> DataFrame:
    return gases.timed_gases(derived(t, "gas_lab_events_b"), derived(t, "gas_lab_items_b"), **gases.SECOND_SOURCE)


def _timed_pairs_b(t: Tables, panel: DataFrame | None = None) -> DataFrame:
    series = gases.timed_oximetry(derived(t, "oximetry_events_b"), derived(t, "oximetry_items"), "icustay_id")
    return gases.timed_pairs(timed_gas_panel_b(t) if panel is None else panel, series, "icustay_id")


@query(f"""with {ctes(*_GAS_TABLES, *_GAS_TABLES_B)}, {_OXI_SQL}, {_TIMED_PAIRS_B}
select * replace (round("delta_SpO2", 9) + 0.0 as "delta_SpO2") from tpb""")
def timed_pairs_b(t: Tables) -> DataFrame:
    return _timed_pairs_b(t).withColumn("delta_SpO2", rounded("delta_SpO2", 9))


@query(f"""with {ctes(*_GAS_TABLES)}, {_TIMED_PAIRS}
select * replace (round("delta_SpO2", 9) + 0.0 as "delta_SpO2") from tp""")
def timed_pairs_lenient(t: Tables) -> DataFrame:
    return _timed_pairs(t).withColumn("delta_SpO2", rounded("delta_SpO2", 9))


@query(f"""with {ctes(*_GAS_TABLES)}, {_TIMED_PAIRS},
q as (select *, row_number() over (partition by hadm_id order by "SaO2_timestamp") as rn from tp
      where "delta_SpO2" >= -5 and "SaO2" between 70 and 100 and "SpO2" between 70 and 100)
select hadm_id, count(*) as n, max(case when rn = 1 then subject_id end) as subject_id,
  max(case when rn = 1 then "SaO2" end) as "SaO2", max(case when rn = 1 then "SpO2" end) as "SpO2",
  arg_min("Methemoglobin", rn) filter ("Methemoglobin" is not null) as "Methemoglobin" from q group by 1""")
def timed_pairs_first(t: Tables) -> DataFrame:
    """The first usable pair per admission."""
    cut = gases.usable_pairs(_timed_pairs(t))
    sizes = cut.groupBy("hadm_id").agg(F.count(F.lit(1)).alias("n"))
    firsts = gases.first_pairs(cut, "hadm_id", ["SaO2_timestamp", "SpO2_timestamp"])
    return firsts.join(sizes, "hadm_id").select("hadm_id", "n", "subject_id", "SaO2", "SpO2", "Methemoglobin")


_OFFSET_PAIRS = """og as (select patientunitstayid as k, labresultoffset as o, labresultrevisedoffset as r,
   avg(case when labname = 'pH' then labresult end) as "pH", avg(case when labname = 'paCO2' then labresult end) as "pCO2",
   avg(case when labname = 'paO2' then labresult end) as "pO2", avg(case when labname = 'O2 Sat (%)' then labresult end) as "SaO2",
   avg(case when labname = 'Carboxyhemoglobin' then labresult end) as "Carboxyhemoglobin",
   avg(case when labname = 'Methemoglobin' then labresult end) as "Methemoglobin"
  from offset_lab where labtypeid = 7 group by 1, 2, 3),
oc as (select * from og where "pH" is not null and "pCO2" is not null and "pO2" is not null and "SaO2" is not null),
os as (select patientunitstayid as k, observationoffset as t, sao2 as sat from offset_saturation where sao2 is not null
   and patientunitstayid in (select patientunitstayid from offset_lab where labtypeid = 7 and labname = 'O2 Sat (%)')),
oj as (select oc.*, t, sat, row_number() over (partition by oc.k, o order by t desc, r desc, sat desc) as rn
       from oc join os on os.k = oc.k and t <= o),
op as (select oj.k as patientunitstayid, o as "SaO2_offset", "pH", "pCO2", "pO2", "SaO2", "Carboxyhemoglobin", "Methemoglobin",
   t as "SpO2_offset", sat as "SpO2", t - o as "delta_SpO2", uniquepid, patienthealthsystemstayid
  from oj left join (select distinct patientunitstayid, uniquepid, patienthealthsystemstayid from offset_patients) i
    on i.patientunitstayid = oj.k where rn = 1 and o - t <= 90)"""
_OFFSET_TABLES = ("offset_lab", "offset_saturation", "offset_patients")


def _offset_pairs(t: Tables) -> DataFrame:
    lab = derived(t, "offset_lab")
    return gases.offset_pairs(
        gases.offset_gases(lab), gases.offset_oximetry(derived(t, "offset_saturation"), lab), derived(t, "offset_patients")
    )


@query(f"with {ctes(*_OFFSET_TABLES)}, {_OFFSET_PAIRS} select * from op")
def offset_pairs_lenient(t: Tables) -> DataFrame:
    return _offset_pairs(t)


@query(f"""with {ctes(*_OFFSET_TABLES)}, {_OFFSET_PAIRS}
select patienthealthsystemstayid, patientunitstayid, "SaO2_offset", "SaO2", "SpO2", "delta_SpO2" from (select *, row_number() over
  (partition by patienthealthsystemstayid order by "SaO2_offset", patientunitstayid) as rn from op
  where "delta_SpO2" >= -5 and "SaO2" between 70 and 100 and "SpO2" between 70 and 100) where rn = 1""")
def offset_pairs_strict_first(t: Tables) -> DataFrame:
    cut = gases.usable_pairs(_offset_pairs(t))
    firsts = gases.first_pairs(cut, "patienthealthsystemstayid", ["SaO2_offset", "patientunitstayid"])
    return firsts.select(
        "patienthealthsystemstayid", "patientunitstayid", "SaO2_offset", "SaO2", "SpO2", "delta_SpO2"
    )


_RACES = [("WHITE", "White"), ("BLACK", "Black"), ("ASIAN", "Asian")]
_OFFSET_RACES = [("Caucasian", "White"), ("African American", "Black"), ("Asian", "Asian")]
_RACE_SQL = "case race when 'WHITE' then 'White' when 'BLACK' then 'Black' when 'ASIAN' then 'Asian' end"
_SITE_SQL = "9999 as hospitalid, '>= 500' as numbedscategory, true as teachingstatus, 'Northeast' as region"

_PATIENTS_A = f"""pa as (select distinct subject_id, d.hadm_id as hospital_admission_id, d.stay_id as icustay_id, 'timed_a' as source_db, {_SITE_SQL},
  case when admission_age > 90 then 90 else admission_age end as admission_age, case when gender = 'F' then 1 else 0 end as sex_female,
  weight_admit as weight_admission, height as height_admission, weight_admit / power(height / 100, 2) as "BMI_admission",
  admittime as datetime_hospital_admit, dischtime as datetime_hospital_discharge, icu_intime as datetime_icu_admit,
  icu_outtime as datetime_icu_discharge, los_hospital, los_icu as "los_ICU", 'Charlson' as comorbidity_score_name,
  charlson_comorbidity_index as comorbidity_score_value, s.hospital_expire_flag as in_hospital_mortality, {_RACE_SQL} as race_ethnicity
  from timed_details d left join timed_body b on b.stay_id = d.stay_id left join timed_scores s on s.hadm_id = d.hadm_id)"""
_PATIENTS_B = f"""pb as (select distinct d.subject_id, d.hadm_id as hospital_admission_id, d.icustay_id, 'timed_b' as source_db, {_SITE_SQL},
  case when admission_age > 90 then 90 else admission_age end as admission_age, case when gender = 'F' then 1 else 0 end as sex_female,
  weight_first as weight_admission, height_first as height_admission, weight_first / power(height_first / 100, 2) as "BMI_admission",
  admittime as datetime_hospital_admit, dischtime as datetime_hospital_discharge, intime as datetime_icu_admit,
  outtime as datetime_icu_discharge, los_hospital, los_icu as "los_ICU", 'Elixhauser' as comorbidity_score_name,
  elixhauser_vanwalraven as comorbidity_score_value, d.hospital_expire_flag as in_hospital_mortality, coalesce({_RACE_SQL}, 'Unknown') as race_ethnicity
  from timed_details d left join timed_body b on b.icustay_id = d.icustay_id left join timed_scores s on s.hadm_id = d.hadm_id)"""
_PATIENTS_C = """pc as (select distinct i.uniquepid as subject_id, i.patienthealthsystemstayid as hospital_admission_id, i.patientunitstayid as icustay_id,
  'offset' as source_db, i.hospitalid, numbedscategory, teachingstatus, region, case when age = '> 89' then '90' else age end as admission_age,
  case when p.gender = 'Female' then 1 else 0 end as sex_female, admissionweight as weight_admission, admissionheight as height_admission,
  case when admissionheight > 0 then admissionweight / power(admissionheight / 100, 2) end as "BMI_admission",
  timestamp '2014-01-01' + to_minutes(hospitaladmitoffset) as datetime_hospital_admit,
  timestamp '2014-01-01' + to_minutes(hospitaldischargeoffset) as datetime_hospital_discharge,
  timestamp '2014-01-01' + to_minutes(unitadmitoffset) as datetime_icu_admit,
  timestamp '2014-01-01' + to_minutes(unitdischargeoffset) as datetime_icu_discharge,
  (hospitaldischargeoffset - hospitaladmitoffset) / 60 / 24 as los_hospital, icu_los_hours / 24 as "los_ICU",
  'Charlson' as comorbidity_score_name, charlson_score as comorbidity_score_value, hosp_mort as in_hospital_mortality,
  coalesce(case p.ethnicity when 'Caucasian' then 'White' when 'African American' then 'Black' when 'Asian' then 'Asian' end, 'Unknown') as race_ethnicity
  from offset_details i left join offset_patients p on p.patienthealthsystemstayid = i.patienthealthsystemstayid
  left join hospitals h on h.hospitalid = p.hospitalid left join offset_scores s on s.patientunitstayid = i.patientunitstayid)"""
_PATIENT_TABLES = ("timed_details", "timed_body", "timed_scores")
_OFFSET_PATIENT_TABLES = ("offset_details", "offset_patients", "hospitals", "offset_scores")


def _mapped(t: Tables, df: DataFrame, pairs: list, default: str | None) -> DataFrame:
    mapping = t.spark.createDataFrame(pairs, "original string, mapping string")
    return harmonise.map_category(df, "race_ethnicity", mapping, "original", "mapping", default)


def _patients_a(t: Tables) -> DataFrame:
    body, scores = derived(t, "timed_body"), derived(t, "timed_scores")
    found = patients.patients_by_stay(
        derived(t, "timed_details").drop("hospital_expire_flag"), body, body, scores, scores, "timed_a"
    )
    return _mapped(t, found, _RACES, None)


def _patients_b(t: Tables) -> DataFrame:
    details = derived(t, "timed_details")
    found = patients.patients_by_icustay(
        details.select("subject_id", "hadm_id", "icustay_id"), details.drop("stay_id"), derived(t, "timed_body"),
        derived(t, "timed_scores"), "timed_b",
    )
    return _mapped(t, found, _RACES, patients.UNKNOWN)


def _patients_c(t: Tables) -> DataFrame:
    found = patients.patients_by_offset(
        derived(t, "offset_details"), derived(t, "offset_patients"), derived(t, "hospitals"), derived(t, "offset_scores"), "offset"
    )
    return _mapped(t, found, _OFFSET_RACES, patients.UNKNOWN)


_ROUND_PATIENT = """* replace (round("BMI_admission", 6) as "BMI_admission", round(los_hospital, 6) as los_hospital,
   round("los_ICU", 6) as "los_ICU")"""


@query(f"with {ctes(*_PATIENT_TABLES)}, {_PATIENTS_A} select {_ROUND_PATIENT} from pa")
def patients_by_stay(t: Tables) -> DataFrame:
    return six_digits(_patients_a(t), set())


@query(f"with {ctes(*_PATIENT_TABLES)}, {_PATIENTS_B} select {_ROUND_PATIENT} from pb")
def patients_by_icustay(t: Tables) -> DataFrame:
    return six_digits(_patients_b(t), set())


@query(f"with {ctes(*_OFFSET_PATIENT_TABLES)}, {_PATIENTS_C} select {_ROUND_PATIENT} from pc")
def patients_by_offset(t: Tables) -> DataFrame:
    return six_digits(_patients_c(t), set())


@query(f"""with {ctes(*_GAS_TABLES, *_GAS_TABLES_B, *_OFFSET_TABLES, *_PATIENT_TABLES, 'offset_details', 'hospitals', 'offset_scores')},
{_TIMED_PAIRS}, {_TIMED_PAIRS_B}, {_OFFSET_PAIRS}, {_PATIENTS_A}, {_PATIENTS_B}, {_PATIENTS_C},
ap as (select 'timed_a' as source_db, subject_id, hadm_id as hospital_admission_id, stay_id as icustay_id, "pH", "pCO2", "pO2", "SaO2", "SpO2",
   try_cast("Carboxyhemoglobin" as double) as "Carboxyhemoglobin", try_cast("Methemoglobin" as double) as "Methemoglobin",
   round("delta_SpO2", 9) + 0.0 as "delta_SpO2" from tp
  union all select 'timed_b', subject_id, hadm_id, icustay_id, "pH", "pCO2", "pO2", "SaO2", "SpO2", try_cast("Carboxyhemoglobin" as double),
   try_cast("Methemoglobin" as double), round("delta_SpO2", 9) + 0.0 from tpb
  union all select 'offset', try_cast(replace(uniquepid, '-', '') as bigint), patienthealthsystemstayid, patientunitstayid, "pH", "pCO2", "pO2",
   "SaO2", "SpO2", "Carboxyhemoglobin", "Methemoglobin", "delta_SpO2" from op),
pp as (select source_db, hospital_admission_id, race_ethnicity, sex_female from pa
       union all select source_db, hospital_admission_id, race_ethnicity, sex_female from pb
       union all select source_db, hospital_admission_id, race_ethnicity, sex_female from pc)
select distinct ap.*, race_ethnicity, sex_female from ap left join pp
  on pp.source_db = ap.source_db and pp.hospital_admission_id = ap.hospital_admission_id""")
def all_pairs_dataset(t: Tables) -> DataFrame:
    table = dataset.all_pairs_table(
        {"timed_a": _timed_pairs(t), "timed_b": _timed_pairs_b(t), "offset": _offset_pairs(t)},
        [_patients_a(t), _patients_b(t), _patients_c(t)],
    )
    return table.withColumn("delta_SpO2", rounded("delta_SpO2", 9))


def _stages_sql(source: str, subjects: str, gas: str, pairs: str, admission: str) -> str:
    strict = '"delta_SpO2" >= -5'
    cut = strict + ' and "SaO2" between 70 and 100 and "SpO2" between 70 and 100'
    return f"""select '{source}' as source_db, 'original' as stage, subject_id, null::bigint as r from ({subjects}) group by all
  union all select '{source}', 'abgs', subject_id, count(*) from ({gas}) group by all
  union all select '{source}', 'pairs_lenient', subject_id, count(*) from ({pairs}) group by all
  union all select '{source}', 'pairs_strict', subject_id, count(*) from ({pairs}) where {strict} group by all
  union all select '{source}', 'pairs_cut', subject_id, count(*) from ({pairs}) where {cut} group by all
  union all select '{source}', 'first_pairs', subject_id, count(distinct {admission}) from ({pairs}) where {cut} group by all"""


_SUBJECT = "cast(subject_id as varchar) as subject_id"
_FUNNEL_TABLES = ctes(*_GAS_TABLES, *_GAS_TABLES_B, *_OFFSET_TABLES, *_PATIENT_TABLES, "offset_details", "hospitals", "offset_scores")
_FUNNEL = f"""{_TIMED_PAIRS}, {_TIMED_PAIRS_B}, {_OFFSET_PAIRS}, {_PATIENTS_A}, {_PATIENTS_B}, {_PATIENTS_C},
fs as ({_stages_sql("timed_a", f"select {_SUBJECT} from pa", f"select {_SUBJECT} from tg", f"select * replace ({_SUBJECT}) from tp", "hadm_id")}
  union all {_stages_sql("timed_b", f"select {_SUBJECT} from pb", f"select {_SUBJECT} from tgb", f"select * replace ({_SUBJECT}) from tpb", "hadm_id")}
  union all {_stages_sql("offset", "select subject_id from pc",
    "select uniquepid as subject_id from oc join (select distinct patientunitstayid, uniquepid from offset_patients) i on i.patientunitstayid = oc.k",
    "select *, uniquepid as subject_id from op", "patienthealthsystemstayid")})"""


def _staged(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Stages of all three sources, and their patients; each gas panel is written once."""
    subject = F.col("subject_id").cast("string")
    people, staged = [], []
    for patients_of, panel_of, pairs_of in (
        (_patients_a, timed_gas_panel, _timed_pairs), (_patients_b, timed_gas_panel_b, _timed_pairs_b),
    ):
        panel = settle(panel_of(t))
        people.append(patients_of(t).withColumn("subject_id", subject))
        staged.append(
            funnel.stage_subjects(
                people[-1], panel.withColumn("subject_id", subject), pairs_of(t, panel).withColumn("subject_id", subject), "hadm_id"
            )
        )
    lab = derived(t, "offset_lab")
    panel, ids = settle(gases.offset_gases(lab)), derived(t, "offset_patients")
    pairs = gases.offset_pairs(panel, gases.offset_oximetry(derived(t, "offset_saturation"), lab), ids)
    named = panel.join(ids.select("patientunitstayid", F.col("uniquepid").alias("subject_id")).distinct(), "patientunitstayid")
    people.append(_patients_c(t))
    staged.append(
        funnel.stage_subjects(people[-1], named, pairs.withColumnRenamed("uniquepid", "subject_id"), "patienthealthsystemstayid")
    )
    tags = ("timed_a", "timed_b", "offset")
    stacked = [s.withColumn("source_db", F.lit(tag)) for s, tag in zip(staged, tags)]
    columns = ["source_db", "subject_id", "icustay_id", "race_ethnicity", "sex_female"]
    everyone = [p.select(*columns) for p in people]
    return harmonise.harmonised_union(stacked), harmonise.harmonised_union(everyone)


@query(f"""with {_FUNNEL_TABLES}, {_FUNNEL}
select source_db, stage, cast(sum(r) as bigint) as p_rows, count(*) as n_subjects from fs group by 1, 2""")
def attrition_counts(t: Tables) -> DataFrame:
    return funnel.stage_counts(_staged(t)[0], within=["source_db"])


@query(f"""with {_FUNNEL_TABLES}, {_FUNNEL},
everyone as (select source_db, cast(subject_id as varchar) as subject_id, icustay_id, race_ethnicity, sex_female from pa
  union all select source_db, cast(subject_id as varchar), icustay_id, race_ethnicity, sex_female from pb
  union all select source_db, subject_id, icustay_id, race_ethnicity, sex_female from pc),
fr as (select source_db, subject_id, (min(place) filter (race_ethnicity is not null)).b as race_ethnicity,
         (min(place) filter (sex_female is not null)).c as sex_female
       from (select *, struct_pack(a := icustay_id, b := race_ethnicity, c := sex_female) as place from everyone) group by 1, 2),
fc as (select source_db, stage, race_ethnicity, sex_female, count(*) as n from fs join fr using (source_db, subject_id)
       where race_ethnicity is not null group by all)
select *, round_even(n * 100.0 / sum(n) over (partition by source_db, stage), 2) as pct from fc""")
def attrition_shares(t: Tables) -> DataFrame:
    staged, everyone = _staged(t)
    return funnel.stage_shares(staged, everyone, ["icustay_id", "race_ethnicity", "sex_female"], within=["source_db"])
