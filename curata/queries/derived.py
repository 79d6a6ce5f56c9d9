"""Tables in the shape of the clinical sources, derived from the test tables.

Each is one SQL text that Spark and the checking engine both read, so that a query and its expected
result start from the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from curata.plans import comorbidity, infusions, labs, vitals
from curata.queries.registry import Tables
from curata.sources import tables

BASE = ("events", "orders", "lineitem", "customer", "nation", "region", "part", "supplier")


def choose(selector: str, values: Sequence, text: bool = False) -> str:
    """One of ``values`` by an integer expression."""
    quoted = ["'" + str(v).replace("'", "''") + "'" if text else str(v) for v in values]
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(quoted))
    return f"case {selector} % {len(values)} {arms} end"


# Whole minutes since the start of 2024, months counted as 31 days; the same text in both engines.
MINUTES = (
    "cast(((extract(year from ts) - 2024) * 12 + extract(month from ts) - 1) * 44640 "
    "+ (extract(day from ts) - 1) * 1440 + extract(hour from ts) * 60 + extract(minute from ts) as bigint)"
)
TABLES: dict[str, str] = {}

TABLES["chart_events"] = f"""
select user_id as subject_id, case when event_id % 23 = 0 then null else user_id * 10 end as stay_id,
  user_id * 10 as icustay_id, {{hour_of_ts}} as charttime,
  {choose('event_id', [i for m in vitals.VITALS for i in m.items] + [vitals.TEMPERATURE_SITE, 999])} as itemid,
  {choose('event_id', [i for m in vitals.PRESSURES for i in m.items] + [999])} as older_item,
  value as valuenum, props as value, case event_id % 5 when 0 then 1 when 1 then 0 else null end as error
from {{events}}"""

TABLES["lab_revisions"] = f"""
select l_orderkey as patientunitstayid,
  {choose('l_partkey', [n for m in labs.REVISED_LABS for n in m.items] + ['other'], text=True)} as labname,
  (l_linenumber % 3) * 60 as labresultoffset, (l_suppkey % 4) * 15 as labresultrevisedoffset,
  case when l_suppkey % 13 = 0 then null else l_quantity * 2 end as labresult
from {{lineitem}}"""

TABLES["timed_lab_events"] = f"""
select o_custkey as subject_id, o_orderkey as hadm_id, l_shipdate as charttime,
  {choose('l_partkey', [i for m in labs.TIMED_LABS for i in m.items] + list(labs.UNLABELLED_ITEMS) + [1])} as itemid,
  case when l_suppkey % 17 = 0 then null else l_quantity * 5 - 20 end as valuenum
from {{lineitem}} join {{orders}} on o_orderkey = l_orderkey"""

TABLES["admissions"] = """
select o_custkey as subject_id, o_orderkey as hadm_id, o_orderdate as admittime,
  o_orderdate + interval '36' hour as dischtime from {orders}"""

TABLES["icu_stays"] = """
select o_custkey as subject_id, o_orderkey as hadm_id, o_orderkey * 10 as icustay_id,
  o_orderdate + interval '7' hour as intime, o_orderdate + interval '30' hour as outtime from {orders}"""

TABLES["charted_vitals"] = f"""
select user_id as patientunitstayid, {MINUTES} - {MINUTES} % 60 as chartoffset,
  case when event_type = 'view' then value * 2 end as nibp_systolic,
  case when event_type in ('view', 'error') then value end as nibp_diastolic,
  case when event_type = 'click' then value end as nibp_mean,
  case when event_type = 'purchase' then value * 3 end as ibp_systolic,
  case when event_type = 'purchase' and event_id % 3 > 0 then value end as ibp_diastolic,
  case when event_type = 'error' and event_id % 2 = 0 then value end as ibp_mean
from {{events}}"""
TABLES["vital_aperiodic"] = f"""
select user_id as patientunitstayid, {MINUTES} - {MINUTES} % 60 as observationoffset,
  case when event_type in ('click', 'signup') then value * 2 end as noninvasivesystolic,
  case when event_id % 2 = 0 then value end as noninvasivediastolic,
  case when event_type = 'signup' then value end as noninvasivemean
from {{events}}"""
TABLES["vital_periodic"] = f"""
select user_id as patientunitstayid, {MINUTES} - {MINUTES} % 60 as observationoffset,
  case when event_type = 'error' then value * 2 end as systemicsystolic,
  case when event_type in ('error', 'view') then value end as systemicdiastolic,
  case when event_id % 4 = 0 then value end as systemicmean
from {{events}}"""

TABLES["stay_weights"] = """
select o_orderkey as patientunitstayid,
  case o_orderkey % 11 when 0 then null when 1 then 0.0e0 when 2 then 1.0e0 else o_totalprice / 1000 end as admissionweight,
  case o_orderkey % 13 when 0 then null when 1 then 0.0e0 when 2 then 15.0e0 when 3 then 1200.0e0
    else (o_custkey % 150) * 3.5e0 end as dischargeweight
from {orders}"""

def _names(drug: infusions.Drug) -> str:
    names = [drug.blank, *drug.known, *drug.units, *drug.volume_names, "Saline"]
    return f"case when user_id % 3 > 0 and event_id % {len(names)} = 0 then 'Saline' else {choose('event_id', names, text=True)} end"


# One log for all drugs: every event charts one row of each.
TABLES["infusion_log"] = f"""
select event_id * 8 + item as infusiondrugid, user_id as patientunitstayid, {MINUTES} - {MINUTES} % 30 as infusionoffset,
  case item when 1 then {_names(infusions.NOREPINEPHRINE)} when 2 then {_names(infusions.EPINEPHRINE)} when 3 then {_names(infusions.DOPAMINE)}
    else {choose('event_id', ['DOBUTamine STD 500 mg', 'Dobutamine (mcg/kg/min)', 'Saline'], text=True)} end as drugname,
  case event_id % 19 when 0 then 'OFF' when 1 then 'ERROR' when 2 then '' when 3 then 'UD' when 4 then '12,5'
       else cast(value as string) end as drugrate,
  cast(event_id % 7 as string) as infusionrate, cast(event_id % 5 as string) as drugamount,
  '250' as volumeoffluid, cast(user_id % 90 as string) as patientweight
from {{events}} {{per_item}} where item <= 4"""
_ORDERED = {
    d.rate: [n for o in d.orders for n in o.names] + ["Norepinephrine drip", "Epinephrine drip"]
    for d in (infusions.NOREPINEPHRINE, infusions.EPINEPHRINE)
}
TABLES["drug_orders"] = f"""
select user_id as patientunitstayid,
  case item when 1 then {choose('event_id', _ORDERED['rate_norepinephrine'], text=True)} else {choose('event_id', _ORDERED['rate_epinephrine'], text=True)} end as drugname,
  {choose('event_id', ['4 MG', '8 MG', '16 MG', '2 MG'], text=True)} as dosage,
  case when event_id % 5 = 0 then 'Yes' else 'No' end as drugordercancelled,
  {MINUTES} as drugstartoffset, {MINUTES} + 2880 as drugstopoffset
from {{events}} {{per_item}} where event_type = 'signup' and item <= 2"""
TABLES["user_weights"] = """
select user_id as patientunitstayid, case when user_id % 5 = 0 then null else 50.0e0 + user_id % 60 end as admissionweight,
  case when user_id % 7 = 0 then null else 52.0e0 + user_id % 50 end as dischargeweight
from (select distinct user_id from {events}) u"""

TABLES["careplan"] = f"""
select event_id as cplgeneralid, user_id as patientunitstayid, event_id % 2 = 0 as activeupondischarge,
  {MINUTES} - {MINUTES} % 240 as cplitemoffset,
  case when event_id % 29 = 0 then 'Diet' when event_id % 2 = 0 then 'Airway' else 'Ventilation' end as cplgroup,
  case event_type when 'view' then 'Intubated/oral ETT' when 'click' then 'Ventilated - with daily extubation evaluation'
    when 'error' then '' when 'purchase' then 'Spontaneous - adequate' else 'Not intubated/normal airway' end as cplitemvalue
from {{events}}"""
TABLES["unit_stays"] = f"""
select user_id as patientunitstayid, max({MINUTES}) + 200 as unitdischargeoffset,
  case user_id % 9 when 0 then '> 89' when 1 then '' else cast(20 + user_id % 70 as string) end as age
from {{events}} group by user_id"""

_history = [p for _, paths in comorbidity.CATEGORIES.values() for p in paths] + ["notes/none"]
TABLES["past_history"] = f"""
select o_custkey as patientunitstayid, {choose('o_orderkey', _history, text=True)} as pasthistorypath
from {{orders}}"""
TABLES["aged_patients"] = """
select c_custkey as patientunitstayid,
  case c_custkey % 12 when 0 then '> 89' when 1 then '' when 2 then 'unknown' else cast(c_custkey % 100 as string) end as age
from {customer}"""

TABLES["gas_panel"] = f"""
select user_id as patientunitstayid, {MINUTES} as chartoffset, value * 4 as pao2,
  case when event_id % 10 = 0 then null else 0.2e0 + (event_id % 8) / 10.0e0 end as fio2
from {{events}} where event_type = 'purchase'"""
TABLES["coma_scores"] = f"""
select user_id as patientunitstayid, {MINUTES} as chartoffset, 3 + event_id % 13 as gcs from {{events}} where event_type = 'click'"""
TABLES["narrow_labs"] = f"""
select user_id as patientunitstayid, {MINUTES} as chartoffset,
  case when event_id % 3 = 0 then value / 10 end as bilirubin, case when event_id % 3 = 1 then value / 20 end as creatinine,
  case when event_id % 3 = 2 then value * 3 end as platelets from {{events}} where event_type = 'view'"""
TABLES["urine"] = f"""
select user_id as patientunitstayid, {MINUTES} as chartoffset, value as urineoutput from {{events}} where event_type = 'error'"""

_analytes = ["pH", "pCO2", "pO2", "Oxygen Saturation", "Carboxyhemoglobin", "Methemoglobin", "Specimen Type"]
TABLES["gas_lab_items"] = """
select cast(1 as bigint) as itemid, 'pH' as label, 'Blood Gas' as category
union all select 2, 'pCO2', 'Blood Gas' union all select 3, 'pO2', 'Blood Gas'
union all select 4, 'Oxygen Saturation', 'Blood Gas' union all select 5, 'Carboxyhemoglobin', 'Blood Gas'
union all select 6, 'Methemoglobin', 'Blood Gas' union all select 7, 'Specimen Type', 'Blood Gas'
union all select 8, 'Sodium', 'Chemistry'"""
TABLES["gas_lab_events"] = """
select user_id as subject_id, case when event_id % 31 = 0 then null else user_id * 100 end as hadm_id, ts as charttime,
  item as itemid,
  case item when 1 then cast(7 + (event_id % 6) / 10.0e0 as string)
    when 2 then case when event_id % 17 = 0 then '___' else cast(value as string) end
    when 3 then case when event_id % 13 = 0 then 'None' else cast(value * 2 as string) end
    when 4 then case when event_id % 19 = 0 then null else cast(60 + event_id % 45 as string) end
    when 5 then case when event_id % 2 = 0 then cast(event_id % 4 as string) end
    when 6 then case when event_id % 3 = 0 then cast(event_id % 3 as string) end
    when 7 then case when event_id % 7 = 0 then 'VEN.' else 'ART.' end
    else '140' end as value
from {events} {per_item}
where event_type = 'purchase'"""
TABLES["oximetry_items"] = """
select cast(220277 as bigint) as itemid, 'O2 saturation pulseoxymetry' as label, 'Respiratory' as category, 'chartevents' as linksto
union all select 2, 'O2 saturation pulseoxymetry', 'Alarms', 'chartevents'
union all select 3, 'Heart rate', 'Respiratory', 'chartevents'"""
TABLES["oximetry_events"] = """
select user_id as subject_id, case when event_id % 37 = 0 then null else user_id * 100 end as hadm_id, user_id * 10 as stay_id,
  {minute_of_ts} as charttime, case event_id % 11 when 0 then cast(2 as bigint) when 1 then 3 else 220277 end as itemid,
  case when event_id % 41 = 0 then null else 65.0e0 + event_id % 40 end as valuenum
from {events} where event_type <> 'purchase'
union all select user_id, user_id * 100, user_id * 10, {minutes_back},
  case when event_id % 47 = 0 then cast(2 as bigint) else 220277 end, 65.0e0 + event_id % 40
from {events} where event_type = 'purchase' and event_id % 2 = 0"""

# The second timed source: other spellings, other identifiers, a gas for every error.
TABLES["gas_lab_items_b"] = """
select cast(1 as bigint) as itemid, 'pH' as label, 'Blood Gas' as category
union all select 2, 'pCO2', 'BLOOD GAS' union all select 3, 'pO2', 'BLOOD GAS'
union all select 4, 'Oxygen Saturation', 'Blood Gas' union all select 5, 'Carboxyhemoglobin', 'BLOOD GAS'
union all select 6, 'Methemoglobin', 'Blood Gas' union all select 7, 'SPECIMEN TYPE', 'BLOOD GAS'
union all select 8, 'Sodium', 'Chemistry'"""
TABLES["gas_lab_events_b"] = (
    TABLES["gas_lab_events"].replace("'VEN.'", "'VEN'").replace("'ART.'", "'ART'").replace("event_type = 'purchase'", "event_type = 'error'")
)
TABLES["oximetry_events_b"] = (
    TABLES["oximetry_events"].replace("as stay_id", "as icustay_id").replace("<> 'purchase'", "<> 'error'").replace("= 'purchase'", "= 'error'")
)

TABLES["offset_lab"] = f"""
select user_id as patientunitstayid, {MINUTES} as labresultoffset, {MINUTES} + event_id % 3 * 10 as labresultrevisedoffset,
  case when event_id % 23 = 0 then 3 else 7 end as labtypeid,
  case item when 1 then 'pH' when 2 then 'paCO2' when 3 then 'paO2' when 4 then 'O2 Sat (%)' when 5 then 'Methemoglobin' else 'lactate' end as labname,
  case when item = 2 and event_id % 17 = 0 then null when item = 4 then 60.0e0 + event_id % 45 else value + item end as labresult
from {{events}} {{per_item}}
where event_type = 'purchase'"""
TABLES["offset_saturation"] = f"""
select user_id as patientunitstayid, {MINUTES} as observationoffset,
  case when event_id % 41 = 0 then null else 65.0e0 + event_id % 40 end as sao2
from {{events}} where event_type <> 'purchase'
union all select user_id, {MINUTES} - event_id % 12, 65.0e0 + event_id % 40 from {{events}} where event_type = 'purchase' and event_id % 2 = 0"""
TABLES["offset_patients"] = """
select distinct user_id as patientunitstayid, concat('00-', cast(user_id as string)) as uniquepid,
  user_id - user_id % 2 as patienthealthsystemstayid, user_id % 25 as hospitalid,
  case when user_id % 3 = 0 then 'Female' else 'Male' end as gender,
  case user_id % 4 when 0 then 'Caucasian' when 1 then 'African American' when 2 then 'Asian' else null end as ethnicity
from {events}"""
TABLES["offset_details"] = f"""
select user_id as patientunitstayid, concat('00-', cast(user_id as string)) as uniquepid,
  user_id - user_id % 2 as patienthealthsystemstayid, user_id % 25 as hospitalid, 'Midwest' as region,
  case user_id % 9 when 0 then '> 89' else cast(20 + user_id % 70 as string) end as age,
  50.0e0 + user_id % 60 as admissionweight, case when user_id % 6 = 0 then 0.0e0 else 150.0e0 + user_id % 45 end as admissionheight,
  cast(0 - user_id % 300 as bigint) as hospitaladmitoffset, max({MINUTES}) + 900 as hospitaldischargeoffset,
  cast(0 as bigint) as unitadmitoffset, max({MINUTES}) + 200 as unitdischargeoffset,
  max({MINUTES}) / 60.0e0 as icu_los_hours, user_id % 8 as hosp_mort
from {{events}} group by user_id"""
TABLES["hospitals"] = """
select cast(n_nationkey as bigint) as hospitalid, case n_nationkey % 3 when 0 then '<100' when 1 then '100 - 249' end as numbedscategory,
  n_nationkey % 2 = 0 as teachingstatus from {nation}"""
TABLES["offset_scores"] = "select distinct user_id as patientunitstayid, user_id % 12 as charlson_score from {events}"

TABLES["timed_details"] = """
select user_id as subject_id, user_id * 100 as hadm_id, user_id * 10 as stay_id, user_id * 10 as icustay_id,
  20.0e0 + user_id % 80 as admission_age, case when user_id % 3 = 0 then 'F' else 'M' end as gender,
  min(ts) as admittime, max(ts) as dischtime, min(ts) as icu_intime, max(ts) as icu_outtime,
  min(ts) as intime, max(ts) as outtime, user_id % 30 + 0.5e0 as los_hospital, user_id % 10 + 0.25e0 as los_icu,
  user_id % 8 as hospital_expire_flag,
  case user_id % 5 when 0 then 'WHITE' when 1 then 'BLACK' when 2 then 'ASIAN' when 3 then 'OTHER' end as race,
  case user_id % 5 when 0 then 'WHITE' when 1 then 'BLACK' when 2 then 'ASIAN' when 3 then 'OTHER' end as ethnicity
from {events} group by user_id"""
TABLES["timed_body"] = """
select distinct user_id * 10 as stay_id, user_id * 10 as icustay_id,
  case when user_id % 6 > 0 then 50.0e0 + user_id % 60 end as weight_admit, case when user_id % 8 > 0 then 150.0e0 + user_id % 45 end as height,
  case when user_id % 6 > 0 then 50.0e0 + user_id % 60 end as weight_first, case when user_id % 8 > 0 then 150.0e0 + user_id % 45 end as height_first
from {events}"""
TABLES["timed_scores"] = """
select distinct user_id * 100 as hadm_id, user_id % 15 as charlson_comorbidity_index, user_id % 20 - 3 as elixhauser_vanwalraven,
  user_id % 8 as hospital_expire_flag from {events}"""


# Where the engines spell the same thing differently.
SPARK_WORDS = {
    "hour_of_ts": "cast(date_trunc('hour', ts) as timestamp_ntz)",
    "minute_of_ts": "cast(date_trunc('minute', ts) as timestamp_ntz)",
    "minutes_back": "timestampadd(MINUTE, cast(0 - event_id % 12 as int), ts)",
    "per_item": "lateral view explode(sequence(1, 8)) i as item",
}
DUCK_WORDS = {
    "hour_of_ts": "date_trunc('hour', ts)",
    "minute_of_ts": "date_trunc('minute', ts)",
    "minutes_back": "ts - to_minutes(event_id % 12)",
    "per_item": "cross join (select unnest(range(1, 9)) as item) i",
}


def derived(t: Tables, name: str) -> DataFrame:
    text = TABLES[name]
    used = {b: getattr(t, b) for b in BASE if "{" + b + "}" in text}
    text = text.format(**SPARK_WORDS, **{b: "{" + b + "}" for b in BASE})
    return tables.query(t.spark, text, **used)


def ctes(*names: str) -> str:
    """The named tables as a WITH list for the checking engine."""
    return ",\n".join(f"{n} as ({TABLES[n].format(**DUCK_WORDS, **{b: b for b in BASE})})" for n in names)
