"""Blood-gas panels, oximetry series and their pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from curata.operators import harmonise, pick, pivot
from curata.operators.asof import asof_join, closest_prior
from curata.session import FILE_ROWS, settle

# Time windows in minutes and the saturation range of usable pairs.
LENIENT_MINUTES = 90
STRICT_MINUTES = 5
LOWEST_SATURATION, HIGHEST_SATURATION = 70, 100

# Labels of the blood-gas analytes and the columns they become.
TIMED_ANALYTES = {
    "pH": "pH",
    "pCO2": "pCO2",
    "pO2": "pO2",
    "Oxygen Saturation": "SaO2",
    "Carboxyhemoglobin": "Carboxyhemoglobin",
    "Methemoglobin": "Methemoglobin",
}
OFFSET_ANALYTES = {
    "pH": "pH",
    "paCO2": "pCO2",
    "paO2": "pO2",
    "O2 Sat (%)": "SaO2",
    "Carboxyhemoglobin": "Carboxyhemoglobin",
    "Methemoglobin": "Methemoglobin",
}
GAS_LAB_TYPE = 7
SATURATION_LAB = "O2 Sat (%)"
GAS_CATEGORIES = ("Blood Gas", "BLOOD GAS")
OXIMETRY_LABEL = "O2 saturation pulseoxymetry"
OXIMETRY_CATEGORIES = ("Respiratory", "Routine Vital Signs")
CHART_TABLE = "chartevents"

KEY_ANALYTES = ("pH", "pCO2", "pO2", "SaO2")

# How the two timestamped sources spell an arterial gas and what they ask of it.
FIRST_SOURCE = {
    "categories": GAS_CATEGORIES[:1],
    "specimen_label": "Specimen Type",
    "arterial": "ART.",
    "charted": ("pH", "pCO2", "SaO2"),
    "numeric": ("pH", "pCO2", "pO2", "SaO2"),
}
SECOND_SOURCE = {
    "categories": GAS_CATEGORIES,
    "specimen_label": "SPECIMEN TYPE",
    "arterial": "ART",
    "charted": ("pH", "pCO2", "pO2", "SaO2"),
    "numeric": ("pH", "pO2", "SaO2"),
}


def timed_gases(
    lab_events: DataFrame,
    lab_items: DataFrame,
    *,
    categories: Sequence[str],
    specimen_label: str,
    arterial: str,
    charted: Sequence[str],
    numeric: Sequence[str],
) -> DataFrame:
    """One row per subject, admission and time of an arterial gas.

    ``charted`` analytes must be there as text, ``numeric`` ones also as a number; values that are
    no number become null. ``FIRST_SOURCE`` and ``SECOND_SOURCE`` hold the options of two sources.
    """
    gas_items = lab_items.filter(F.col("category").isin(*categories)).select("itemid", "label")
    rows = lab_events.join(gas_items, "itemid")
    wide = pivot.pivot_labels(
        rows,
        ["subject_id", "hadm_id", "charttime"],
        "label",
        "value",
        {**TIMED_ANALYTES, specimen_label: "SpecimenType"},
    )
    keyed = wide.dropna(subset=["subject_id", "hadm_id", "charttime", *charted])
    arterial_rows = keyed.filter(F.col("SpecimenType") == arterial).drop("SpecimenType")
    typed = harmonise.cast_columns(arterial_rows, {c: "double" for c in KEY_ANALYTES})
    return typed.dropna(subset=list(numeric))


def timed_oximetry(
    chart_events: DataFrame, chart_items: DataFrame, stay: str, need: Sequence[str] = ("subject_id", "hadm_id", "charttime")
) -> DataFrame:
    """The oximetry series per stay; ``need`` names identifiers that must be there."""
    wanted = chart_items.filter(
        (F.col("linksto") == CHART_TABLE)
        & F.col("category").isin(*OXIMETRY_CATEGORIES)
        & (F.col("label") == OXIMETRY_LABEL)
    ).select("itemid")
    rows = harmonise.members_of(chart_events, wanted, {"itemid": "itemid"})
    series = rows.groupBy("subject_id", "hadm_id", stay, "charttime").agg(F.avg("valuenum").alias("SpO2"))
    return series.dropna(subset=[*need, "SpO2"])


def offset_gases(lab: DataFrame) -> DataFrame:
    """One row per stay, result time and revision time with the four key analytes."""
    gases = lab.filter(F.col("labtypeid") == GAS_LAB_TYPE)
    wide = pivot.pivot_labels(
        gases,
        ["patientunitstayid", "labresultoffset", "labresultrevisedoffset"],
        "labname",
        "labresult",
        OFFSET_ANALYTES,
        "avg",
    )
    return wide.dropna(subset=list(KEY_ANALYTES))


def offset_oximetry(vital_periodic: DataFrame, lab: DataFrame) -> DataFrame:
    """The monitor's saturation for stays that have a saturation among their gases."""
    with_gas = lab.filter((F.col("labtypeid") == GAS_LAB_TYPE) & (F.col("labname") == SATURATION_LAB))
    series = vital_periodic.filter(F.col("sao2").isNotNull()).select(
        "patientunitstayid", "observationoffset", F.col("sao2").alias("SpO2")
    )
    return harmonise.members_of(series, with_gas, {"patientunitstayid": "patientunitstayid"})


def timed_pairs(gases: DataFrame, oximetry: DataFrame, stay: str, chunk_minutes: float = 1440) -> DataFrame:
    """Every gas with the last saturation of the same admission in the lenient window.

    Both series are written first, so that the event logs behind them are read once.
    """
    gases = settle(gases, FILE_ROWS)
    candidates = settle(
        harmonise.members_of(oximetry, gases, {"subject_id": "subject_id"}).select(
            "hadm_id", stay, F.col("charttime").alias("SpO2_timestamp"), "SpO2"
        ),
        FILE_ROWS,
    )
    return asof_join(
        gases.withColumnRenamed("charttime", "SaO2_timestamp"),
        candidates,
        left_keys=["hadm_id"],
        left_time="SaO2_timestamp",
        right_time="SpO2_timestamp",
        right_columns=[stay, "SpO2", "SpO2_timestamp"],
        tie=stay,
        tolerance=LENIENT_MINUTES,
        delta="delta_SpO2",
        chunk_minutes=chunk_minutes,
    )


def offset_pairs(gases: DataFrame, oximetry: DataFrame, patients: DataFrame, chunk_minutes: float = 1440) -> DataFrame:
    """Per gas time the last saturation of the stay in the lenient window, with patient ids.

    Of several revisions at one gas time the latest stands. Both series are written first, so that the
    event logs behind them are read once.
    """
    found = closest_prior(
        settle(gases, FILE_ROWS),
        settle(oximetry, FILE_ROWS),
        keys=["patientunitstayid"],
        left_time="labresultoffset",
        right_time="observationoffset",
        left_pick="labresultrevisedoffset",
        tie="SpO2",
        right_columns=["observationoffset", "SpO2"],
        tolerance=LENIENT_MINUTES,
        delta="delta_SpO2",
        chunk_minutes=chunk_minutes,
    )
    ids = patients.select("patientunitstayid", "uniquepid", "patienthealthsystemstayid").distinct()
    return (
        found.join(ids, "patientunitstayid", "left")
        .withColumnsRenamed({"labresultoffset": "SaO2_offset", "observationoffset": "SpO2_offset"})
        .drop("labresultrevisedoffset")
    )


def strict_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("delta_SpO2") >= -STRICT_MINUTES)


def usable_pairs(pairs: DataFrame) -> DataFrame:
    """Strict pairs with both saturations in range."""
    cut = strict_pairs(pairs)
    for c in ("SaO2", "SpO2"):
        cut = cut.filter(F.col(c).between(LOWEST_SATURATION, HIGHEST_SATURATION))
    return cut


def first_pairs(pairs: DataFrame, admission: str, order: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Per admission the first non-null value of every column along ``order``."""
    rest = [c for c in pairs.columns if c != admission]
    return pick.first_nonnull(pairs, [admission], order, rest).withColumnsRenamed(dict(rename or {}))
