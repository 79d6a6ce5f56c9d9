"""Repair of admission and discharge weights entered with a slipped unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Weight limits, the ratios of admission to discharge weight that reveal a slip, and
# the two stays whose admission weight is replaced by the discharge weight.
RATIO_LOW = 0.15
RATIO_HIGH = 6.9
SMALLEST_ADMISSION = 2.5
SWAPPED_STAYS = (1355321, 2387379)
FALLBACK_WEIGHT = 80


def repaired_admission(admission: Column, ratio: Column) -> Column:
    too_light, too_heavy = ratio <= RATIO_LOW, ratio > RATIO_HIGH
    return (
        F.when((admission > 1) & (admission <= 20) & too_light, admission * 10)
        .when((admission <= 1) & too_light, admission * 100)
        .when((admission >= 300) & too_heavy, admission / 10)
        .otherwise(admission)
    )


def repaired_discharge(discharge: Column, ratio: Column) -> Column:
    """The rule for 1000 never fires, the one for 300 comes first; it stands as the rules are stated."""
    too_light, too_heavy = ratio <= RATIO_LOW, ratio > RATIO_HIGH
    return (
        F.when((discharge >= 300) & too_light, discharge / 10)
        .when((discharge >= 1000) & too_light, discharge / 100)
        .when((discharge <= 20) & too_heavy, F.lit(None))
        .otherwise(discharge)
    )


def clean_weights(
    stays: DataFrame,
    stay: str = "patientunitstayid",
    admission: str = "admissionweight",
    discharge: str = "dischargeweight",
    swapped: Sequence[int] = SWAPPED_STAYS,
) -> DataFrame:
    """One row per distinct (stay, admission weight, discharge weight) after repair.

    Rows with both weights need both positive; rows missing one weight pass through unchanged.
    """
    adm, dis = F.col(admission), F.col(discharge)
    usable = ((adm > 0) & (dis > 0)) | dis.isNull() | adm.isNull()
    ratio = F.round(F.try_divide(adm, dis), 2)
    repaired = stays.filter(usable).select(
        stay,
        repaired_admission(adm, ratio).alias(admission),
        repaired_discharge(dis, ratio).alias(discharge),
    )
    checked = F.when(F.col(stay).isin(*swapped), F.col(discharge)).when(
        (adm >= SMALLEST_ADMISSION), adm
    )
    return repaired.withColumn(admission, checked).distinct()


def dosing_weight(admission: str = "admissionweight", discharge: str = "dischargeweight") -> Column:
    return F.coalesce(F.col(admission), F.col(discharge), F.lit(FALLBACK_WEIGHT))
