"""Wide laboratory tables of two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.operators import pick
from curata.operators.intervals import Spans, attach_intervals, fuzzy_bounds
from curata.operators.pivot import Measure, Range, known_items, pivot_measures, valid_rows

# Item ids of the timestamped source, the column each feeds and its upper bound.
# 50885 is listed once: of the two labels it carries only the first can apply, so the column
# "bilirubin" stays empty, and so does "thrombin", whose item (51297) carries a label in capitals.
TIMED_LABS = [
    Measure("aniongap", (50868,), Range(at_most=10000)),
    Measure("albumin", (50862,), Range(at_most=10)),
    Measure("rbc", (51279,)),
    Measure("d_dimer", (51196,)),
    Measure("bands", (51144,), Range(at_most=100)),
    Measure("rdw", (51277,)),
    Measure("bicarbonate", (50882,), Range(at_most=10000)),
    Measure("bilirubin", ()),
    Measure("creatinine", (50912,), Range(at_most=150)),
    Measure("chloride", (50902,), Range(at_most=10000)),
    Measure("fibrinogen", (51214,)),
    Measure("glucose", (50931,), Range(at_most=10000)),
    Measure("mchc", (51249,)),
    Measure("hematocrit", (51221,), Range(at_most=100)),
    Measure("hemoglobin", (51222,), Range(at_most=50)),
    Measure("lactate", (50813,), Range(at_most=50)),
    Measure("platelet", (51265,), Range(at_most=10000)),
    Measure("potassium", (50971,), Range(at_most=30)),
    Measure("ptt", (51275,), Range(at_most=150)),
    Measure("inr", (51237,), Range(at_most=50)),
    Measure("pt", (51274,), Range(at_most=150)),
    Measure("mcv", (51250,)),
    Measure("alt", (50861,)),
    Measure("alp", (50863,)),
    Measure("ast", (50878,)),
    Measure("bilirubin_total", (50885,), Range(at_most=150)),
    Measure("bilirubin_direct", (50883,)),
    Measure("bilirubin_indirect", (50884,)),
    Measure("ck_cpk", (50910,)),
    Measure("ck_mb", (50911,)),
    Measure("ggt", (50927,)),
    Measure("ld_ldh", (50954,)),
    Measure("sodium", (50983,), Range(at_most=200)),
    Measure("bun", (51006,), Range(at_most=300)),
    Measure("mch", (51248,)),
    Measure("thrombin", ()),
    Measure("wbc", (51300, 51301), Range(at_most=1000)),
]
UNLABELLED_ITEMS = (51297,)

# Lab names of the offset source, the column each feeds and its validity.
REVISED_LABS = [
    Measure("albumin", ("albumin",), Range(at_least=0.5, at_most=6.5)),
    Measure("bilirubin_total", ("total bilirubin",), Range(at_least=0.2, at_most=100)),
    Measure("bilirubin_direct", ("direct bilirubin",), Range(at_least=0.01, at_most=80)),
    Measure("bun", ("BUN",), Range(at_least=1, at_most=280)),
    Measure("calcium", ("calcium",), Range(above=0, at_most=9999)),
    Measure("chloride", ("chloride",), Range(above=0, at_most=9999)),
    Measure("creatinine", ("creatinine",), Range(at_least=0.1, at_most=28.28)),
    Measure("glucose", ("bedside glucose", "glucose"), Range(at_least=25, at_most=1500)),
    Measure("bicarbonate", ("bicarbonate",), Range(at_least=0, at_most=9999)),
    Measure("totalco2", ("Total CO2",), Range(at_least=0, at_most=9999)),
    Measure("hematocrit", ("Hct",), Range(at_least=5, at_most=75)),
    Measure("hemoglobin", ("Hgb",), Range(above=0, at_most=9999)),
    Measure("inr", ("PT - INR",), Range(at_least=0.5, at_most=15)),
    Measure("lactate", ("lactate",), Range(at_least=0.1, at_most=30)),
    Measure("platelets", ("platelets x 1000",), Range(above=0, at_most=9999)),
    Measure("potassium", ("potassium",), Range(at_least=0.05, at_most=12)),
    Measure("ptt", ("PTT",), Range(above=0, at_most=500)),
    Measure("pt", ("PT",), Range(above=0)),
    Measure("sodium", ("sodium",), Range(at_least=90, at_most=215)),
    Measure("wbc", ("WBC x 1000",), Range(above=0, at_most=100)),
    Measure("bands", ("-bands",), Range(at_least=0, at_most=100)),
    Measure("alt", ("ALT (SGPT)",), Range(above=0)),
    Measure("ast", ("AST (SGOT)",), Range(above=0)),
    Measure("alp", ("alkaline phos.",), Range(above=0)),
    Measure("fibrinogen", ("fibrinogen",)),
    Measure("mch", ("MCH",)),
    Measure("mchc", ("MCHC",)),
    Measure("mcv", ("MCV",)),
    Measure("mpv", ("MPV",)),
    Measure("rdw", ("RDW",)),
    Measure("rbc", ("RBC",)),
    Measure("ck_cpk", ("CPK",), Range(above=0)),
    Measure("ck_mb", ("CPK-MB",), Range(above=0)),
    Measure("ld_ldh", ("LDH",)),
    Measure("aniongap", ("anion gap",)),
]


def timed_labs(lab_events: DataFrame, icu_stays: DataFrame, admissions: DataFrame) -> DataFrame:
    """Mean lab values per subject and time, with the stay and admission whose widened bounds
    contain the time."""
    items = [*known_items(TIMED_LABS), *UNLABELLED_ITEMS]
    wide = pivot_measures(
        lab_events.filter(F.col("itemid").isin(*items) & (F.col("valuenum") > 0)),
        ["subject_id", "charttime"],
        "itemid",
        "valuenum",
        TIMED_LABS,
    )
    hospital = fuzzy_bounds(admissions, subject="subject_id", stay="hadm_id", start="admittime", end="dischtime")
    unit = fuzzy_bounds(icu_stays, subject="subject_id", stay="icustay_id", start="intime", end="outtime")
    stays = [Spans(hospital, "data_start", "data_end", ["hadm_id"], "left"), Spans(unit, "data_start", "data_end", ["icustay_id"], "left")]
    tagged = attach_intervals(wide, stays, keys=["subject_id"], time="charttime")
    return tagged.select("icustay_id", "hadm_id", *wide.columns)


def revised_labs(lab: DataFrame, stay: str = "patientunitstayid") -> DataFrame:
    """One row per stay and result time with the last valid revision of each lab.

    Revisions whose copies contradict each other are dropped first.
    """
    rows = lab.filter(F.col("labname").isin(*known_items(REVISED_LABS))).select(
        stay, "labname", "labresultoffset", "labresultrevisedoffset", "labresult"
    )
    agreed = pick.consistent_values(rows, [stay, "labname", "labresultoffset", "labresultrevisedoffset"], "labresult")
    valid = valid_rows(agreed, "labname", "labresult", REVISED_LABS)
    newest = pick.last_row(valid, [stay, "labname", "labresultoffset"], ["labresultrevisedoffset"])
    plain = [Measure(m.name, m.items) for m in REVISED_LABS]
    wide = pivot_measures(newest, [stay, "labresultoffset"], "labname", "labresult", plain, "max")
    return wide.withColumnRenamed("labresultoffset", "chartoffset")
