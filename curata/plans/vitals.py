"""Vital-sign tables of two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curata.operators.pivot import Measure, Range, known_items, pivot_measures

_SYSTOLIC = Range(above=0, below=400)
_PRESSURE = Range(above=0, below=300)

# Chart items and validity of the vital-sign table.
VITALS = [
    Measure("heart_rate", (220045,), _PRESSURE),
    Measure("sbp", (220179, 220050, 225309), _SYSTOLIC),
    Measure("dbp", (220180, 220051, 225310), _PRESSURE),
    Measure("mbp", (220052, 220181, 225312), _PRESSURE),
    Measure("sbp_i", (220050, 225309), _SYSTOLIC),
    Measure("dbp_i", (220051, 225310), _PRESSURE),
    Measure("mbp_i", (220052, 225312), _PRESSURE),
    Measure("sbp_ni", (220179,), _SYSTOLIC),
    Measure("dbp_ni", (220180,), _PRESSURE),
    Measure("mbp_ni", (220181,), _PRESSURE),
    Measure("resp_rate", (220210, 224690), Range(above=0, below=70)),
    Measure("temperature", (223761,), Range(above=70, below=120), scale=1.8, shift=32),
    Measure("temperature", (223762,), Range(above=10, below=50)),
    Measure("spo2", (220277,), Range(above=0, at_most=100)),
    Measure("glucose", (225664, 220621, 226537), Range(above=0)),
]
TEMPERATURE_SITE = 224642
TEMPERATURE_DIGITS = 2

# Chart items of the older blood-pressure table.
PRESSURES = [
    Measure("sysbp_ni", (442, 455, 220179), _SYSTOLIC),
    Measure("diasbp_ni", (8440, 8441, 220180), _PRESSURE),
    Measure("meanbp_ni", (456, 443, 220181), _PRESSURE),
    Measure("sysbp_i", (51, 6701, 220050), _SYSTOLIC),
    Measure("diasbp_i", (8368, 8555, 220051), _PRESSURE),
    Measure("meanbp_i", (52, 6702, 220052, 225312), _PRESSURE),
]


def vital_signs(chart_events: DataFrame) -> DataFrame:
    """Mean vital signs per subject, stay and time, with the temperature site as text."""
    keys = ["subject_id", "stay_id", "charttime"]
    items = [*known_items(VITALS), TEMPERATURE_SITE]
    rows = chart_events.filter(F.col("stay_id").isNotNull() & F.col("itemid").isin(*items))
    site = {"temperature_site": F.when(F.col("itemid") == TEMPERATURE_SITE, F.col("value"))}
    means = pivot_measures(rows, keys, "itemid", "valuenum", VITALS, largest=site)
    return means.withColumn("temperature", F.round("temperature", TEMPERATURE_DIGITS))


def blood_pressures(chart_events: DataFrame) -> DataFrame:
    """Mean invasive and cuff pressures per stay and time, without rows marked as errors."""
    sound = F.coalesce(F.col("error"), F.lit(0)) != 1
    rows = chart_events.filter(
        sound & F.col("icustay_id").isNotNull() & F.col("itemid").isin(*known_items(PRESSURES))
    )
    return pivot_measures(rows, ["icustay_id", "charttime"], "itemid", "valuenum", PRESSURES)
