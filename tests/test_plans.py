"""Clinical plans on hand-made frames: every rule branch that the test tables rarely reach."""

import pytest
from pyspark.sql import functions as F

from curata.plans import comorbidity, dataset, infusions, labs, patients, pressure, severity, ventilation, vitals, weights


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_weight_branches(spark):
    data = [
        (1, 8.0, 80.0), (2, 0.8, 80.0), (3, 700.0, 70.0), (4, 75.0, 80.0), (5, 70.0, 700.0), (6, 100.0, 1200.0),
        (7, 150.0, 15.0), (8, 2.0, None), (9, None, 60.0), (10, None, None), (11, 0.0, 80.0), (12, 80.0, 0.0),
        (13, 80.0, None), (1355321, 5.0, 66.0), (4, 75.0, 80.0),
    ]
    df = spark.createDataFrame(data, "patientunitstayid long, admissionweight double, dischargeweight double")
    got = {r[0]: tuple(r)[1:] for r in weights.clean_weights(df).collect()}
    assert got == {
        1: (80.0, 80.0), 2: (80.0, 80.0), 3: (70.0, 70.0), 4: (75.0, 80.0), 5: (70.0, 70.0), 6: (100.0, 120.0),
        7: (150.0, None), 8: (None, None), 9: (None, 60.0), 10: (None, None), 13: (80.0, None), 1355321: (66.0, 66.0),
    }


def _infusions(spark, data):
    full = [(i, s, o, n, r, None, None, None, None) for i, s, o, n, r in data]
    schema = (
        "infusiondrugid long, patientunitstayid long, infusionoffset long, drugname string, drugrate string, "
        "infusionrate string, drugamount string, volumeoffluid string, patientweight string"
    )
    return spark.createDataFrame(full, schema)


def _orders(spark, data):
    return spark.createDataFrame(
        data,
        "patientunitstayid long, drugname string, dosage string, drugordercancelled string, "
        "drugstartoffset long, drugstopoffset long",
    )


def test_norepinephrine(spark):
    given = _infusions(spark, [
        (1, 1, 0, "Norepinephrine (mcg/kg/min)", "0.5"), (2, 1, 0, "Norepinephrine (mcg/min)", "16"),
        (3, 1, 0, "Norepinephrine (mg/hr)", "4.8"), (4, 1, 0, "Norepinephrine (mg/kg/min)", "0.002"),
        (5, 1, 0, "Norepinephrine (mcg/kg/hr)", "60"), (6, 1, 0, "Norepinephrine (mcg/hr)", "9600"),
        (7, 1, 0, "Norepinephrine (mg/min)", "0.08"), (8, 1, 0, "Norepinephrine (units/min)", "3"),
        (9, 1, 0, "Norepinephrine (mcg/min)", "OFF-x"), (10, 1, 0, "Norepinephrine (mcg/min)", "ERROR"),
        # stay 2 has blanks: carried forward, then back; an unlisted unit inherits its neighbour's
        (20, 2, 0, "Norepinephrine ()", "7"), (21, 2, 5, "Norepinephrine (mcg/kg/min)", "0.1"),
        (22, 2, 9000, "Norepinephrine ()", "0.2"), (23, 2, 9001, "Norepinephrine (mcg/hr)", "0.3"),
        # stay 3 in ml/hr needs an active order
        (30, 3, 100, "Norepinephrine (ml/hr)", "10"), (31, 3, 5000, "Norepinephrine (ml/hr)", "10"),
    ])
    weight = spark.createDataFrame([(1, 80.0, None), (3, None, 40.0)], "patientunitstayid long, admissionweight double, dischargeweight double")
    orders = _orders(spark, [(3, "Norepinephrine drip", None, "No", 0, 200), (3, "Norepinephrine", None, "Yes", 0, 9999)])
    got = {r.infusiondrugid: r.rate_norepinephrine for r in infusions.infusion_rates(given, weight, infusions.NOREPINEPHRINE, orders).collect()}
    assert got == {1: 0.5, 2: 0.2, 3: 1.0, 4: 2.0, 5: 1.0, 6: 2.0, 7: 1.0, 20: 7.0, 21: 0.1, 22: 0.2, 23: 0.3, 30: None}


def test_order_strengths():
    by_name = {n: o for o in infusions.NOREPINEPHRINE.orders for n in o.names if not o.dosage}
    assert by_name["NOREPINEPHRINE 8 MG in 250mL NS"].rule.factor == 32.0
    assert by_name["NOREPINEPHRINE BITARTRATE 1 MG/ML AMP"].rule.factor == 1000.0
    assert by_name["<<norepinephrine 4 mg/4 mL Inj"].constant == 0.2


def test_epinephrine_and_dopamine_volumes(spark):
    weight = spark.createDataFrame([(9, 1.0, 1.0)], "patientunitstayid long, admissionweight double, dischargeweight double")
    epi = _infusions(spark, [(1, 1, 10, "Epinephrine (ml/hr)", "6"), (2, 1, 900, "Epinephrine (ml/hr)", "6"), (3, 1, 10, "Epinephrine", "6")])
    orders = _orders(spark, [(1, "Epinephrine drip", None, "No", 0, 20)])
    got = infusions.infusion_rates(epi, weight, infusions.EPINEPHRINE, orders)
    assert rows(got.select("infusiondrugid", "rate_epinephrine")) == [(1, 0.02)]
    dopa = _infusions(spark, [
        (1, 1, 0, "Dopamine ()", "3"), (2, 1, 1, "Dopamine (ml/hr)", "6"), (3, 2, 1, "Dopamine (mcg/kg/min)", "5"),
        (4, 3, 1, "dopamine (mcg/kg/min)", "5"), (5, 1, 2, "Dopamine (ml/hr)", "Time Correction"),
    ])
    got = infusions.infusion_rates(dopa, weight, infusions.DOPAMINE)
    # Without a blank row only lower-case names pass, so stay 2 drops out.
    assert rows(got.select("infusiondrugid", "drugname", "rate_dopamine")) == [
        (1, "Dopamine (ml/hr)", 0.01), (2, "Dopamine (ml/hr)", 0.02), (4, "dopamine (mcg/kg/min)", 5.0),
    ]
    dobu = infusions.dobutamine_rates(_infusions(spark, [(1, 1, 0, "DOBUTamine x", "2.00005"), (2, 1, 0, "Dobutamine", ""), (3, 1, 0, "Dobutamine", "OFF")]))
    assert rows(dobu.select("infusiondrugid", "rate_dobutamine")) == [(1, 2.0001), (3, None)]


def test_ventilation(spark):
    data = [
        # on, on, off; both states at one instant
        (1, 1, False, 10, "Airway", "Intubated/oral ETT"), (2, 1, False, 20, "Ventilation", "Non-invasive ventilation"),
        (3, 1, False, 20, "Airway", "Spontaneous - adequate"), (4, 1, False, 30, "Airway", "Spontaneous - adequate"),
        # starts off, ends on and inactive: an hour is added
        (5, 2, True, 5, "Airway", "Not intubated/normal airway"), (6, 2, False, 50, "Airway", "Intubated/nasal ETT"),
        # ends on and active: until discharge
        (7, 3, True, 50, "Airway", "Intubated/nasal ETT"),
        # never on; other group; blank
        (8, 4, True, 5, "Airway", "Spontaneous - adequate"), (9, 4, True, 6, "Diet", "Intubated/nasal ETT"), (10, 4, True, 7, "Airway", ""),
    ]
    plan = spark.createDataFrame(
        data, "cplgeneralid long, patientunitstayid long, activeupondischarge boolean, cplitemoffset int, cplgroup string, cplitemvalue string"
    )
    stays = spark.createDataFrame([(i, 700) for i in range(1, 5)], "patientunitstayid long, unitdischargeoffset int")
    assert rows(ventilation.ventilation_episodes(plan, stays)) == [(1, 10, 30), (2, 50, 110), (3, 50, 700)]
    assert rows(ventilation.ventilation_episodes(plan, stays, "endpoints")) == [(1, 10, 20), (2, 50, 110), (3, 50, 700)]


def test_pressure(spark):
    chart = spark.createDataFrame(
        [(1, 0, 120.0, 60.0, None, None, None, None), (1, 5, 0.0, 0.0, 0.0, 500.0, 50.0, 70.0)],
        "patientunitstayid long, chartoffset long, nibp_systolic double, nibp_diastolic double, nibp_mean double, "
        "ibp_systolic double, ibp_diastolic double, ibp_mean double",
    )
    aper = spark.createDataFrame(
        [(1, 0, 110.0, 55.0, 75.0), (1, 9, None, 55.0, None)],
        "patientunitstayid long, observationoffset long, noninvasivesystolic double, noninvasivediastolic double, noninvasivemean double",
    )
    per = spark.createDataFrame(
        [(1, 0, 100.0, None, None)],
        "patientunitstayid long, observationoffset long, systemicsystolic double, systemicdiastolic double, systemicmean double",
    )
    got = rows(pressure.merged_pressure(chart, aper, per))
    # 500 is out of range; the diastolic-only row is dropped by the presence test
    assert got == [(1, 0, 100.0, 55.0, 75.0), (1, 5, None, 50.0, 70.0)]


@pytest.mark.parametrize(
    "inputs, want",
    [
        ({"pao2fio2_vent": 99}, ("respiration", 4)), ({"pao2fio2_vent": 150}, ("respiration", 3)),
        ({"pao2fio2_novent": 90}, ("respiration", 2)), ({"pao2fio2_novent": 350}, ("respiration", 1)),
        ({"pao2fio2_vent": 500}, ("respiration", 0)), ({}, ("respiration", None)),
        ({"pao2fio2_vent": 250, "pao2fio2_novent": 250}, ("respiration", 2)),
        ({"platelet_min": 149}, ("coagulation", 1)), ({"bilirubin_max": 6}, ("liver", 3)),
        ({"rate_dopamine": 16}, ("cardiovascular", 4)), ({"rate_epinephrine": 0.05}, ("cardiovascular", 3)),
        ({"rate_norepinephrine": 0.2}, ("cardiovascular", 4)), ({"rate_dopamine": 2}, ("cardiovascular", 2)),
        ({"rate_dobutamine": 1}, ("cardiovascular", 2)), ({"meanbp_min": 69}, ("cardiovascular", 1)),
        ({"meanbp_min": 70}, ("cardiovascular", 0)), ({}, ("cardiovascular", None)),
        ({"gcs_min": 15}, ("cns", 0)), ({"gcs_min": 13}, ("cns", 1)), ({"gcs_min": 10}, ("cns", 2)),
        ({"gcs_min": 6}, ("cns", 3)), ({"gcs_min": 3}, ("cns", 4)),
        ({"creatinine_max": 3.5}, ("renal", 3)), ({"urineoutput": 199}, ("renal", 4)), ({"urineoutput": 499}, ("renal", 3)),
        ({"urineoutput": 500, "creatinine_max": 1.2}, ("renal", 1)), ({"urineoutput": 900}, ("renal", 0)), ({}, ("renal", None)),
        ({"urineoutput": 300, "creatinine_max": 5}, ("renal", 4)),
    ],
)
def test_severity_bands(spark, inputs, want):
    columns = {c: float(inputs[c]) if c in inputs else None for c in severity.HOURLY}
    schema = "patientunitstayid long, hr int, " + ", ".join(f"{c} double" for c in columns)
    df = spark.createDataFrame([(1, 0, *columns.values())], schema)
    name, points = want
    row = severity.severity_scores(df).first()
    assert row[name] == points
    assert row[f"{name}_24hours"] == (points or 0)


def test_severity_window_is_24_rows(spark):
    schema = "patientunitstayid long, hr int, " + ", ".join(f"{c} double" for c in severity.HOURLY)
    at = list(severity.HOURLY).index("bilirubin_max")
    data = [(1, h, *[13.0 if i == at and h == 0 else None for i in range(len(severity.HOURLY))]) for h in range(-24, 30)]
    got = {r.hr: r.liver_24hours for r in severity.severity_scores(spark.createDataFrame(data, schema)).collect()}
    assert min(got) == 0 and got[23] == 4 and got[24] == 0


def test_comorbidity(spark):
    assert sum(len(p) for _, p in comorbidity.CATEGORIES.values()) == len({x for _, p in comorbidity.CATEGORIES.values() for x in p})
    people = spark.createDataFrame([(1, "> 89"), (2, ""), (3, "80"), (4, "79"), (5, "62"), (6, "50"), (7, "49"), (8, "?")], "patientunitstayid long, age string")
    first = {c: p[0] for c, (_, p) in comorbidity.CATEGORIES.items()}
    facts = spark.createDataFrame([(1, first["mets6"]), (1, first["mets6"]), (1, first["dm"]), (3, first["liver3"]), (3, "x")], "patientunitstayid long, pasthistorypath string")
    got = {r[0]: (r.age_score_charlson, r.charlson_score) for r in comorbidity.comorbidity_scores(people, facts).collect()}
    assert got == {1: (5, 12), 2: (0, 0), 3: (4, 7), 4: (3, 3), 5: (2, 2), 6: (1, 1), 7: (0, 0), 8: (0, 0)}


def test_revised_labs(spark):
    data = [
        (1, "sodium", 0, 10, 140.0), (1, "sodium", 0, 20, 150.0), (1, "sodium", 0, 20, 150.0),
        (1, "potassium", 0, 10, 4.0), (1, "potassium", 0, 20, 5.0), (1, "potassium", 0, 20, 6.0),  # contradicting: back to 4
        (1, "glucose", 0, 10, 100.0), (1, "bedside glucose", 0, 10, 120.0), (1, "WBC x 1000", 0, 30, 101.0), (1, "odd", 5, 1, 1.0),
    ]
    lab = spark.createDataFrame(data, "patientunitstayid long, labname string, labresultoffset int, labresultrevisedoffset int, labresult double")
    got = labs.revised_labs(lab).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.chartoffset, r.sodium, r.potassium, r.glucose, r.wbc) == (0, 150.0, 4.0, 120.0, None)
    assert len(labs.REVISED_LABS) == 35 and len(labs.TIMED_LABS) == 37


def test_vitals(spark):
    data = [
        (1, 1, 220045, 80.0, None, None), (1, 1, 220045, 300.0, None, None), (1, 1, 223761, 98.6, None, None),
        (1, 1, 224642, None, "Oral", None), (1, None, 220045, 90.0, None, None), (1, 2, 999, 1.0, None, None),
    ]
    df = spark.createDataFrame(data, "subject_id long, stay_id long, itemid int, valuenum double, value string, error int").withColumn("charttime", F.lit("t"))
    r, = vitals.vital_signs(df).collect()
    assert (r.heart_rate, r.temperature, r.temperature_site, r.spo2) == (80.0, 37.0, "Oral", None)
    bp = spark.createDataFrame(
        [(5, 51, 120.0, None), (5, 220050, 130.0, 0), (5, 455, 90.0, 1), (5, 442, 400.0, None)], "icustay_id long, itemid int, valuenum double, error int"
    ).withColumn("charttime", F.lit("t"))
    r, = vitals.blood_pressures(bp).collect()
    assert (r.sysbp_i, r.sysbp_ni) == (125.0, None)


def test_patient_helpers(spark):
    df = spark.createDataFrame([(95.0, "F", 80.0, 200.0, 90.0, 80.0, "White"), (20.0, "M", 80.0, 0.0, None, 80.0, None)], "age double, g string, w double, h double, seen double, true double, race string")
    got = df.select(
        patients.capped_age(F.col("age")), patients.female_flag(F.col("g"), "F"), patients.bmi(F.col("w"), F.col("h")),
        patients.hidden_low(F.col("seen"), F.col("true")), patients.two_levels(F.col("race")),
    )
    assert [tuple(r) for r in got.collect()] == [(90.0, 1, 20.0, 1, "White"), (20.0, 0, None, 0, "Racial-Ethnic Group")]


def test_report_columns(spark):
    df = spark.createDataFrame(
        [(1, "s", "Charlson", "3", 90.0, 80.0, "White", 1, 5.0, 2.0, "4", "<NA>"), (1, "s", "Elixhauser", "x", 80.0, 80.0, "Asian", 0, 6.0, 3.0, "?", "a")],
        "hospital_admission_id long, source_db string, comorbidity_score_name string, comorbidity_score_value string, SpO2 double, SaO2 double, "
        "race_ethnicity string, in_hospital_mortality int, los_hospital double, los_ICU double, sofa_past_overall_24hr string, region string",
    )
    a, b = sorted(dataset.report_columns(df).collect(), key=lambda r: r.comorbidity_score_name)
    assert (a.Charlson, a.Elixhauser, a.hidden_hypoxemia, a.los_hosp_dead, a.los_hosp_surv, a.n_pairs, a.region) == (3.0, None, 1, 5.0, None, 2, None)
    assert (b.Elixhauser, b.sofa_past_overall_24hr, b.race_ethnicity_white, b.los_ICU_surv) == (None, None, "Racial-Ethnic Group", 3.0)
    assert dataset.column_groups(df)["sofa_past"] == ["sofa_past_overall_24hr"]
    assert len(dataset.TITLES) == 85 and set(dataset.COMPLETENESS_COLUMNS) <= set(dataset.TITLES)
    assert not dataset.one_row_per_admission(df).first().ok


def test_second_source_of_gases(spark):
    from curata.plans import gases

    items = spark.createDataFrame(
        [(1, "pH", "Blood Gas"), (2, "pCO2", "BLOOD GAS"), (3, "pO2", "BLOOD GAS"), (4, "Oxygen Saturation", "BLOOD GAS"),
         (5, "SPECIMEN TYPE", "BLOOD GAS"), (6, "Sodium", "CHEMISTRY")],
        "itemid long, label string, category string",
    )
    charted = {1: "7.4", 2: "x", 3: "80", 4: "97", 5: "ART", 6: "140"}
    data = [(1, 10, "2024-01-01 00:00:00", i, v) for i, v in charted.items()]
    data += [(1, 10, "2024-01-01 01:00:00", i, "VEN" if i == 5 else v) for i, v in charted.items()]
    data += [(1, 10, "2024-01-01 02:00:00", i, v) for i, v in charted.items() if i != 3]
    data += [(1, None, "2024-01-01 03:00:00", i, v) for i, v in charted.items()]
    events = spark.createDataFrame(data, "subject_id long, hadm_id long, charttime string, itemid long, value string").withColumn(
        "charttime", F.col("charttime").cast("timestamp_ntz")
    )
    # pCO2 must be charted but need not be a number here; the first source asks for numbers throughout
    got = gases.timed_gases(events, items, **gases.SECOND_SOURCE).collect()
    assert [(r.hadm_id, r.pH, r.pCO2, r.pO2, r.SaO2, r.Methemoglobin) for r in got] == [(10, 7.4, None, 80.0, 97.0, None)]
    first = dict(gases.FIRST_SOURCE, categories=gases.GAS_CATEGORIES, specimen_label="SPECIMEN TYPE", arterial="ART")
    assert gases.timed_gases(events, items, **first).count() == 0


def test_patient_level_mixes_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, None, 5.0), ("a", 1, 1, 7.0, None), ("b", 1, 1, None, None)],
        "subject_id string, hospital_admission_id long, SaO2_timestamp long, x double, y double",
    )
    got = dataset.patient_level(df).select("subject_id", "SaO2_timestamp", "x", "y")
    assert rows(got) == [("a", 1, 7.0, 5.0), ("b", 1, None, None)]


def test_settled_tables_live_in_the_shared_folder(spark):
    from curata.session import ensure_checkpoint_dir, settle

    df = spark.range(5).repartition(2)
    kept = settle(df)
    assert rows(kept) == rows(df)
    assert all(f.startswith("file:") and ensure_checkpoint_dir(spark).removeprefix("file:") in f for f in kept.inputFiles())


def test_wide_rows_are_joined_once_for_their_ids(spark):
    schema = "source_db string, subject_id string, hospital_admission_id long, icustay_id long, x double"
    rows = [("b", "1", 5, 7, 1.0), ("a", "2", 6, 8, 2.0), ("a", "2", 6, 8, 3.0), ("a", None, 6, None, 4.0), ("a", "1", None, 9, 5.0)]
    out = dataset.final_table([spark.createDataFrame(rows, schema)])
    text = out._jdf.queryExecution().executedPlan().toString()
    got = {r.x: (r.unique_subject_id, r.unique_hospital_admission_id, r.unique_icustay_id) for r in out.collect()}
    assert got == {4.0: (0, 0, 0), 5.0: (1, 1, 1), 2.0: (2, 0, 2), 3.0: (2, 0, 2), 1.0: (3, 2, 3)}
    assert sum("Join" in line for line in text.splitlines()) == 1
