"""Patient characteristics of three sources in one schema, and columns derived from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from curata.functions.clock import minutes_to_timestamp

# The age cap, the text for ages above it, the site attributes of the two sources
# that come from one hospital, and the names of the comorbidity scores.
TOP_AGE = 90
TOP_AGE_TEXT = "> 89"
SITE = {"hospitalid": 9999, "numbedscategory": ">= 500", "teachingstatus": True, "region": "Northeast"}
CHARLSON, ELIXHAUSER = "Charlson", "Elixhauser"
UNKNOWN = "Unknown"
HIDDEN_BOUND = 88
WHITE, NOT_WHITE = "White", "Racial-Ethnic Group"


def capped_age(age: Column) -> Column:
    return F.when(age > TOP_AGE, F.lit(TOP_AGE)).otherwise(age)


def female_flag(gender: Column, female: str) -> Column:
    return F.when(gender == female, 1).otherwise(0)


def bmi(weight: Column, height: Column) -> Column:
    """Weight over squared height in metres; null for a height of 0."""
    return F.try_divide(weight, F.pow(height / 100, F.lit(2.0)))


def by_outcome(value: str, outcome: Column, names: Mapping[str, object]) -> list[Column]:
    """One copy of a column per outcome, null for rows of another outcome."""
    return [F.when(outcome == o, F.col(value)).alias(name) for name, o in names.items()]


def hidden_low(seen: Column, true: Column, bound: float = HIDDEN_BOUND) -> Column:
    """1 where the seen value reaches the bound and the true one does not, else 0."""
    return F.when((seen >= bound) & (true < bound), 1).otherwise(0)


def two_levels(category: Column, level: str = WHITE, other: str = NOT_WHITE) -> Column:
    return F.when(category == level, F.lit(level)).otherwise(F.lit(other))


def _site() -> list[Column]:
    return [F.lit(v).alias(k) for k, v in SITE.items()]


def patients_by_stay(
    stays: DataFrame, weights: DataFrame, heights: DataFrame, admissions: DataFrame, scores: DataFrame, tag: str
) -> DataFrame:
    """Timestamped source with first-day weight and height tables."""
    d = (
        stays.join(weights.select("stay_id", "weight_admit"), "stay_id", "left")
        .join(heights.select("stay_id", "height"), "stay_id", "left")
        .join(admissions.select("hadm_id", "hospital_expire_flag"), "hadm_id", "left")
        .join(scores.select("hadm_id", "charlson_comorbidity_index"), "hadm_id", "left")
    )
    return d.select(
        "subject_id",
        F.col("hadm_id").alias("hospital_admission_id"),
        F.col("stay_id").alias("icustay_id"),
        F.lit(tag).alias("source_db"),
        *_site(),
        capped_age(F.col("admission_age")).alias("admission_age"),
        female_flag(F.col("gender"), "F").alias("sex_female"),
        F.col("weight_admit").alias("weight_admission"),
        F.col("height").alias("height_admission"),
        bmi(F.col("weight_admit"), F.col("height")).alias("BMI_admission"),
        F.col("admittime").alias("datetime_hospital_admit"),
        F.col("dischtime").alias("datetime_hospital_discharge"),
        F.col("icu_intime").alias("datetime_icu_admit"),
        F.col("icu_outtime").alias("datetime_icu_discharge"),
        "los_hospital",
        F.col("los_icu").alias("los_ICU"),
        F.lit(CHARLSON).alias("comorbidity_score_name"),
        F.col("charlson_comorbidity_index").alias("comorbidity_score_value"),
        F.col("hospital_expire_flag").alias("in_hospital_mortality"),
        F.col("race").alias("race_ethnicity"),
    ).distinct()


def patients_by_icustay(
    icu_stays: DataFrame, details: DataFrame, body: DataFrame, scores: DataFrame, tag: str
) -> DataFrame:
    """Timestamped source that starts from its stay list and joins details on all three ids."""
    ids = ["subject_id", "hadm_id", "icustay_id"]
    d = (
        icu_stays.select(*ids)
        .join(details.withColumn("__found", F.lit(1)), ids, "left")
        .join(body.select("icustay_id", "weight_first", "height_first"), "icustay_id", "left")
        .join(scores.select("hadm_id", "elixhauser_vanwalraven"), "hadm_id", "left")
    )
    found = F.col("__found").isNotNull()
    return d.select(
        F.when(found, F.col("subject_id")).alias("subject_id"),
        F.when(found, F.col("hadm_id")).alias("hospital_admission_id"),
        F.when(found, F.col("icustay_id")).alias("icustay_id"),
        F.lit(tag).alias("source_db"),
        *_site(),
        capped_age(F.col("admission_age")).alias("admission_age"),
        female_flag(F.col("gender"), "F").alias("sex_female"),
        F.when(found, F.col("weight_first")).alias("weight_admission"),
        F.when(found, F.col("height_first")).alias("height_admission"),
        F.when(found, bmi(F.col("weight_first"), F.col("height_first"))).alias("BMI_admission"),
        F.col("admittime").alias("datetime_hospital_admit"),
        F.col("dischtime").alias("datetime_hospital_discharge"),
        F.col("intime").alias("datetime_icu_admit"),
        F.col("outtime").alias("datetime_icu_discharge"),
        "los_hospital",
        F.col("los_icu").alias("los_ICU"),
        F.lit(ELIXHAUSER).alias("comorbidity_score_name"),
        F.when(found, F.col("elixhauser_vanwalraven")).alias("comorbidity_score_value"),
        F.col("hospital_expire_flag").alias("in_hospital_mortality"),
        F.col("ethnicity").alias("race_ethnicity"),
    ).distinct()


def patients_by_offset(
    details: DataFrame, patients: DataFrame, hospitals: DataFrame, scores: DataFrame, tag: str
) -> DataFrame:
    """Offset source; the patient rows join on the hospital stay, whose copies the distinct absorbs."""
    people = patients.select(
        "patienthealthsystemstayid", F.col("gender").alias("__gender"), F.col("ethnicity").alias("__ethnicity"),
        F.col("hospitalid").alias("__hospitalid"),
    )
    sites = hospitals.select(F.col("hospitalid").alias("__hospitalid"), "numbedscategory", "teachingstatus")
    d = (
        details.join(people, "patienthealthsystemstayid", "left")
        .join(sites, "__hospitalid", "left")
        .join(scores.select("patientunitstayid", "charlson_score"), "patientunitstayid", "left")
    )
    age = F.when(F.col("age") == TOP_AGE_TEXT, F.lit(str(TOP_AGE))).otherwise(F.col("age"))
    height = F.col("admissionheight")
    return d.select(
        F.col("uniquepid").alias("subject_id"),
        F.col("patienthealthsystemstayid").alias("hospital_admission_id"),
        F.col("patientunitstayid").alias("icustay_id"),
        F.lit(tag).alias("source_db"),
        "hospitalid",
        "numbedscategory",
        "teachingstatus",
        "region",
        age.alias("admission_age"),
        female_flag(F.col("__gender"), "Female").alias("sex_female"),
        F.col("admissionweight").alias("weight_admission"),
        height.alias("height_admission"),
        F.when(height > 0, bmi(F.col("admissionweight"), height)).alias("BMI_admission"),
        minutes_to_timestamp("hospitaladmitoffset").alias("datetime_hospital_admit"),
        minutes_to_timestamp("hospitaldischargeoffset").alias("datetime_hospital_discharge"),
        minutes_to_timestamp("unitadmitoffset").alias("datetime_icu_admit"),
        minutes_to_timestamp("unitdischargeoffset").alias("datetime_icu_discharge"),
        ((F.col("hospitaldischargeoffset") - F.col("hospitaladmitoffset")) / 60 / 24).alias("los_hospital"),
        (F.col("icu_los_hours") / 24).alias("los_ICU"),
        F.lit(CHARLSON).alias("comorbidity_score_name"),
        F.col("charlson_score").alias("comorbidity_score_value"),
        F.col("hosp_mort").alias("in_hospital_mortality"),
        F.col("__ethnicity").alias("race_ethnicity"),
    ).distinct()
