"""Attrition funnels: patients, gases, pairs and the cuts on pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from curata.operators import pick
from curata.plans.gases import HIGHEST_SATURATION, LOWEST_SATURATION, STRICT_MINUTES
from curata.reports.crosstab import crosstab_percent

# Stage names, in order.
STAGES = ("original", "abgs", "pairs_lenient", "pairs_strict", "pairs_cut", "first_pairs")


def stage_subjects(
    patients: DataFrame,
    gases: DataFrame,
    pairs: DataFrame,
    admission: str,
    subject: str = "subject_id",
    strict_minutes: float = STRICT_MINUTES,
) -> DataFrame:
    """``stage``, subject and the number of the subject's rows left at that stage.

    Every stage shrinks to one row per subject before stages are stacked. The original stage counts
    subjects only.
    """
    strict = F.col("delta_SpO2") >= -strict_minutes
    saturations = [F.col(c).between(LOWEST_SATURATION, HIGHEST_SATURATION) for c in ("SaO2", "SpO2")]
    cut = strict & saturations[0] & saturations[1]
    per_admission = pairs.groupBy(subject, admission).agg(
        F.count(F.lit(1)).alias("pairs_lenient"),
        F.count(F.when(strict, 1)).alias("pairs_strict"),
        F.count(F.when(cut, 1)).alias("pairs_cut"),
    )
    paired = per_admission.groupBy(subject).agg(
        *[F.sum(s).alias(s) for s in ("pairs_lenient", "pairs_strict", "pairs_cut")],
        F.count(F.when(F.col("pairs_cut") > 0, 1)).alias("first_pairs"),
    )
    entries = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("rows")) for s in STAGES[2:]])
    return (
        patients.select(subject).distinct().select(F.lit("original").alias("stage"), subject, F.lit(None).cast("long").alias("rows"))
        .unionByName(gases.groupBy(subject).agg(F.count(F.lit(1)).alias("rows")).withColumn("stage", F.lit("abgs")))
        .unionByName(paired.select(subject, F.explode(entries).alias("e")).select("e.stage", subject, "e.rows").filter("rows > 0"))
    )


def stage_counts(staged: DataFrame, subject: str = "subject_id", within: Sequence[str] = ()) -> DataFrame:
    """Rows (``p_rows``, null for the original stage) and subjects (``n_subjects``) per stage, and per source if ``within`` names it."""
    return staged.groupBy(*within, "stage").agg(F.sum("rows").alias("p_rows"), F.count(subject).alias("n_subjects"))


def stage_shares(
    staged: DataFrame,
    patients: DataFrame,
    order: Sequence[str],
    subject: str = "subject_id",
    race: str = "race_ethnicity",
    sex: str = "sex_female",
    within: Sequence[str] = (),
) -> DataFrame:
    """Race by sex in percent of each stage's subjects; subjects without a race do not count."""
    people = pick.first_nonnull(patients, [*within, subject], order, [race, sex])
    return crosstab_percent(staged.join(people, [*within, subject]), race, sex, [*within, "stage"])
