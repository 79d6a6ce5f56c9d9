"""Infusion rates of vasoactive drugs in one unit, mcg/kg/min."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from curata.operators.fills import carry_fill
from curata.operators.intervals import interval_join
from curata.operators.rules import every_match, first_match
from curata.plans.weights import dosing_weight
from curata.session import FILE_ROWS, settle


@dataclass(frozen=True)
class UnitRule:
    """rate * factor, over the weight and over 60 where the unit asks for it."""

    factor: float
    by_weight: bool = False
    per_hour: bool = False

    def convert(self, rate: Column, weight: Column) -> Column:
        divisor = F.lit(60.0 if self.per_hour else 1.0)
        if self.by_weight:
            divisor = divisor * weight
        return rate * F.lit(float(self.factor)) / divisor


def convert_rates(unit: Column, rate: Column, weight: Column, rules: Mapping[str, UnitRule]) -> Column:
    """The converted rate; a unit without a rule gives null. Units of one rule share a branch."""
    by_rule: dict[UnitRule, list[str]] = {}
    for name, rule in rules.items():
        by_rule.setdefault(rule, []).append(name)
    out = F.lit(None).cast("double")
    for rule, names in by_rule.items():
        out = F.when(unit.isin(*names), rule.convert(rate, weight)).otherwise(out)
    return out


MCG_KG_MIN = UnitRule(1.0)
MCG_MIN = UnitRule(1.0, by_weight=True)
MCG_HR = UnitRule(1.0, by_weight=True, per_hour=True)
MCG_KG_HR = UnitRule(1.0, per_hour=True)
MG_HR = UnitRule(1000.0, by_weight=True, per_hour=True)
MG_MIN = UnitRule(1000.0, by_weight=True)
MG_KG_MIN = UnitRule(1000.0)
NG_KG_MIN = UnitRule(0.001)


def ml_per_hour(milligrams: float, millilitres: float) -> UnitRule:
    return UnitRule(1000.0 * milligrams / millilitres, by_weight=True, per_hour=True)


@dataclass(frozen=True)
class Order:
    """What an active drug order says about the strength of a rate given in ml/hr."""

    rule: UnitRule | None = None
    names: tuple[str, ...] = ()
    pattern: str | None = None
    dosage: str | None = None
    constant: float | None = None

    def matches(self, name: Column, dosage: Column) -> Column:
        hit = name.isin(*self.names)
        if self.pattern:
            hit = hit | name.like(self.pattern)
        return hit & (dosage == self.dosage) if self.dosage else hit

    def value(self, rate: Column, weight: Column) -> Column:
        return F.lit(self.constant) if self.rule is None else self.rule.convert(rate, weight)


@dataclass(frozen=True)
class Drug:
    """How one drug is charted.

    ``names_like`` select its rows; rates that are ``not_rates`` texts or match ``not_rates_like``
    are skipped. For patients with a row called ``blank``, names missing from ``known`` take the
    name last known before, else the next known one; other patients keep their names if these
    match ``plain_like``. ``units`` lists the names whose unit is certain; ``volume_names`` are in
    ml/hr and need an order (``orders``, found by ``order_like``) or have one strength
    (``volume_rule``). With ``any_unit`` every rate counts as it is charted, whatever its name says.
    """

    rate: str
    names_like: tuple[str, ...]
    not_rates: tuple[str, ...]
    not_rates_like: tuple[str, ...]
    plain_like: tuple[str, ...]
    blank: str | None = None
    known: Mapping[str, str] = field(default_factory=dict)
    known_like: Mapping[str, str] = field(default_factory=dict)
    imputed_like: tuple[str, ...] = ()
    units: Mapping[str, UnitRule] = field(default_factory=dict)
    volume_names: tuple[str, ...] = ()
    order_like: str | None = None
    orders: Sequence[Order] = field(default_factory=tuple)
    volume_rule: UnitRule | None = None
    any_unit: bool = False


# Drug names, texts that are no rate, units and order strengths as charted.
NOREPINEPHRINE = Drug(
    rate="rate_norepinephrine",
    names_like=("%Norepinephrine%", "%norepinephrine%"),
    not_rates=("Documentation undone", "ERROR", "UD", ""),
    not_rates_like=("%OFF%",),
    blank="Norepinephrine ()",
    known={
        "Norepinephrine (mcg/kg/hr)": "Norepinephrine (mcg/kg/hr)",
        "Norepinephrine (mcg/kg/min)": "Norepinephrine (mcg/kg/min)",
        "Norepinephrine (mcg/min)": "Norepinephrine (mcg/min)",
        "Norepinephrine (mg/hr)": "Norepinephrine (mg/hr)",
        "Norepinephrine (mg/min)": "Norepinephrine (mg/min)",
        "Norepinephrine (ml/hr)": "Norepinephrine (ml/hr)",
        "Norepinephrine": "Norepinephrine",
    },
    known_like={"%norepinephrine%": "Norepinephrine (ml/hr)"},
    imputed_like=("%Norepinephrine%", "%norepinephrine%"),
    plain_like=("%Norepinephrine%",),
    units={
        "Norepinephrine MAX 32 mg Dextrose 5% 250 ml (mcg/min)": MCG_MIN,
        "Norepinephrine STD 4 mg Dextrose 5% 250 ml (mcg/min)": MCG_MIN,
        "Norepinephrine STD 32 mg Dextrose 5% 282 ml (mcg/min)": MCG_MIN,
        "Norepinephrine STD 32 mg Dextrose 5% 500 ml (mcg/min)": MCG_MIN,
        "Norepinephrine STD 8 mg Dextrose 5% 250 ml (mcg/min)": MCG_MIN,
        "Norepinephrine STD 4 mg Dextrose 5% 500 ml (mcg/min)": MCG_MIN,
        "Norepinephrine STD 8 mg Dextrose 5% 500 ml (mcg/min)": MCG_MIN,
        "Norepinephrine MAX 32 mg Dextrose 5% 500 ml (mcg/min)": MCG_MIN,
        "Norepinephrine (mcg/kg/min)": MCG_KG_MIN,
        "Norepinephrine (mcg/min)": MCG_MIN,
        "Norepinephrine (mcg/hr)": MCG_HR,
        "Norepinephrine (mg/hr)": MG_HR,
        "Norepinephrine (mcg/kg/hr)": MCG_KG_HR,
        "Norepinephrine (mg/min)": MG_MIN,
        "Norepinephrine (mg/kg/min)": MG_KG_MIN,
    },
    volume_names=("norepinephrine Volume (ml) (ml/hr)", "Norepinephrine (ml/hr)"),
    order_like="%Norepinephrine%",
    orders=(
        Order(
            ml_per_hour(4, 250),
            names=("PRMX NOREPInephrine 4 mg/250 mL NS Drip", "NOREPINEPHRINE 4 MG/250 ML NS"),
            pattern="NOREPINEPHRINE%4%MG%250%C%REPACKAGE%",
        ),
        Order(
            ml_per_hour(8, 250),
            names=(
                "250 ML PLAS CONT : NOREPINEPHRINE IN D5W 8 MG/250 ML",
                "NOREPINEPHRINE 8 MG in 250mL NS",
            ),
        ),
        Order(
            ml_per_hour(1, 1),
            names=(
                "NOREPINEPHRINE BITARTRATE 1 MG/ML AMP",
                "NOREPINEPHRINE BITARTRATE 1 MG/ML IV : 4 ML",
                "NOREPINEPHRINE BITARTRATE 1 MG/ML IV SOLN",
                "NOREPINEPHRINE BITARTRATE 1 MG/ML IJ SOLN",
            ),
        ),
        Order(names=("<<norepinephrine 4 mg/4 mL Inj",), constant=0.2),
        Order(ml_per_hour(16, 250), names=("NOREPINEPHRINE",), dosage="16 MG"),
        Order(ml_per_hour(4, 250), names=("NOREPINEPHRINE",), dosage="4 MG"),
        Order(ml_per_hour(8, 250), names=("NOREPINEPHRINE",), dosage="8 MG"),
    ),
)

EPINEPHRINE = Drug(
    rate="rate_epinephrine",
    names_like=("Epinephrine%", "EPINEPHrine%"),
    not_rates=("",),
    not_rates_like=("%OFF%", "%50%mcg%", "%br%"),
    blank="Epinephrine ()",
    known={"Epinephrine": "Epinephrine"},
    known_like={},
    imputed_like=("Epinephrine%",),
    plain_like=("Epinephrine%",),
    units={
        "EPINEPHrine(Adrenalin)STD 4 mg Sodium Chloride 0.9% 500 ml (mcg/min)": MCG_MIN,
        "EPINEPHrine(Adrenalin)MAX 30 mg Sodium Chloride 0.9% 250 ml (mcg/min)": MCG_MIN,
        "Epinephrine (mcg/min)": MCG_MIN,
        "EPINEPHrine(Adrenalin)STD 7 mg Sodium Chloride 0.9% 250 ml (mcg/min)": MCG_MIN,
        "Epinephrine (mcg/kg/min)": MCG_KG_MIN,
        "Epinephrine (mcg/hr)": MCG_HR,
        "Epinephrine (mg/kg/min)": MG_KG_MIN,
        "Epinephrine (mg/hr)": MG_HR,
    },
    volume_names=("Epinephrine (ml/hr)",),
    order_like="Epinephrine%",
    orders=(
        Order(ml_per_hour(8, 250), names=("EPINEPHrine 8 MG in 250 mL NS",)),
        Order(ml_per_hour(4, 250), pattern="%"),
    ),
)

DOPAMINE = Drug(
    rate="rate_dopamine",
    names_like=("%dopamine%", "%Dopamine%", "%DOPamine%"),
    not_rates=("OFF", "ERROR", "UD", ""),
    not_rates_like=("%Time Correction%",),
    blank="Dopamine ()",
    known={
        "Dopamine (mcg/kg/hr)": "Dopamine (mcg/kg/hr)",
        "Dopamine (mcg/kg/min)": "Dopamine (mcg/kg/min)",
        "Dopamine (ml/hr)": "Dopamine (ml/hr)",
        "Dopamine": "Dopamine",
    },
    known_like={},
    imputed_like=("%Dopamine%",),
    plain_like=("%dopamine%",),
    units={
        "DOPamine MAX 800 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)": MCG_KG_MIN,
        "dopamine (mcg/kg/min)": MCG_KG_MIN,
        "DOPamine STD 15 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)": MCG_KG_MIN,
        "Dopamine (mcg/kg/min)": MCG_KG_MIN,
        "DOPamine STD 400 mg Dextrose 5% 500 ml  Premix (mcg/kg/min)": MCG_KG_MIN,
        "DOPamine STD 400 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)": MCG_KG_MIN,
        "Dopamine (mcg/kg/hr)": MCG_KG_HR,
        "Dopamine (mcg/hr)": MCG_HR,
        "Dopamine (mcg/min)": MCG_MIN,
        "Dopamine (mg/hr)": MG_HR,
        "Dopamine (nanograms/kg/min)": NG_KG_MIN,
    },
    volume_names=("Dopamine (ml/hr)",),
    volume_rule=ml_per_hour(4, 250),
)

DOBUTAMINE = Drug(
    rate="rate_dobutamine",
    names_like=("%Dobutamine%", "%DOBUTamine%"),
    not_rates=("",),
    not_rates_like=(),
    plain_like=("%",),
    any_unit=True,
)
VASOACTIVE = (NOREPINEPHRINE, EPINEPHRINE, DOPAMINE, DOBUTAMINE)

PAYLOAD = ("infusionrate", "drugamount", "volumeoffluid", "patientweight")
KEYS = ("infusiondrugid", "patientunitstayid", "infusionoffset", "drugname")
STAY_DRUG = ("patientunitstayid", "drug")


def like_any(column: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [column.like(p) for p in patterns], F.lit(False))


def four_digits(rate: Column) -> Column:
    """Rounded as a decimal number with nine places, so that a half always rounds up."""
    return F.round(rate.cast("decimal(38, 9)"), 4).cast("double")


def by_drug(drugs: Sequence[Drug], rule: Callable[[Drug], Column]) -> Column:
    """What the rule says for the row's drug."""
    return F.coalesce(*[F.when(F.col("drug") == d.rate, rule(d)) for d in drugs])


def numeric_rates(infusions: DataFrame, drugs: Sequence[Drug]) -> DataFrame:
    """Rows of the drugs with a charted rate, tagged with their ``drug``; the text is read after its sentinels are out.

    The log is read once for all drugs: one expression tags a row, another tells whether its rate is one for that drug.
    """
    name, rate = F.col("drugname"), F.col("drugrate")
    patterns = [(p, d.rate) for d in drugs for p in d.names_like]
    tagged = infusions.withColumn("drug", F.explode(every_match(name, patterns)))

    def charted(d: Drug) -> Column:
        return reduce(lambda a, p: a & ~rate.like(p), d.not_rates_like, ~rate.isin(*d.not_rates))

    return tagged.filter(by_drug(drugs, charted)).select("drug", *KEYS, rate.try_cast("double").alias("drugrate"), *PAYLOAD)


def named_units(rates: DataFrame, drugs: Sequence[Drug], chunk_minutes: float = 1440) -> DataFrame:
    """Rows with the name whose unit applies, blanks filled from their neighbours in time."""
    name = F.col("drugname")
    is_blank = by_drug(drugs, lambda d: F.lit(False) if d.blank is None else name == d.blank)
    blanks = rates.filter(is_blank).select(*[F.col(c).alias(f"__{c}") for c in STAY_DRUG], F.lit(True).alias("__blank")).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in STAY_DRUG])

    def code(d: Drug) -> Column:
        listed = [F.when(name == text, F.lit(unit)) for text, unit in d.known.items()]
        return F.coalesce(*listed, first_match(name, list(d.known_like.items())))

    blank = F.col("__blank").isNotNull()
    wanted = by_drug(drugs, lambda d: (blank & like_any(name, d.imputed_like)) | (~blank & like_any(name, d.plain_like)))
    coded = (
        rates.join(blanks, same, "left")
        .filter(wanted)
        .withColumn("__code", F.when(blank, by_drug(drugs, code)))
        .withColumn("__unknown", F.when(F.col("__code").isNull(), 1).otherwise(0))
    )
    # At one instant the known rows come first, so an unknown one sees them.
    filled = carry_fill(
        coded,
        keys=list(STAY_DRUG),
        order=["infusionoffset", "__unknown", "infusiondrugid"],
        chunk=F.floor(F.col("infusionoffset") / F.lit(chunk_minutes)).cast("long"),
        columns={"__code": "__name"},
    )
    return filled.withColumn("drugname", F.when(blank, F.col("__name")).otherwise(name)).select(*rates.columns)


def rates_of(
    infusions: DataFrame, weights: DataFrame, drugs: Sequence[Drug], orders: DataFrame | None = None, chunk_minutes: float = 1440
) -> DataFrame:
    """Distinct infusions of the drugs, tagged, with ``rate`` in mcg/kg/min rounded to 4 digits, from one reading of the log.

    ``orders`` is needed if a drug has volumes whose strength an order tells.
    """
    given = named_units(settle(numeric_rates(infusions, drugs), FILE_ROWS), drugs, chunk_minutes)
    weighed = given.join(
        weights.select("patientunitstayid", dosing_weight().alias("__w")), "patientunitstayid", "left"
    ).withColumn("__w", F.coalesce("__w", F.lit(80)))
    name, rate, weight = F.col("drugname"), F.col("drugrate"), F.col("__w")

    is_volume = by_drug(drugs, lambda d: name.isin(*d.volume_names) if d.volume_names else F.lit(False))
    listed = weighed.filter(by_drug(drugs, lambda d: F.lit(True) if d.any_unit else name.isin(*d.units)) | is_volume)
    ordered = [d for d in drugs if d.orders]
    by_order = is_volume & F.col("drug").isin(*[d.rate for d in ordered])
    if ordered:
        # Only rows in ml/hr look for an order: the others have no time to match on.
        active = orders.filter(F.col("drugordercancelled") == "No")
        active = active.withColumn("drug", F.explode(every_match(F.col("drugname"), [(d.order_like, d.rate) for d in ordered])))
        active = active.select(
            *STAY_DRUG, "drugstartoffset", "drugstopoffset", F.col("drugname").alias("__order"), "dosage", F.lit(True).alias("__active")
        )
        listed = interval_join(
            listed.withColumn("__at", F.when(by_order, F.col("infusionoffset"))),
            active,
            keys=list(STAY_DRUG),
            time="__at",
            start="drugstartoffset",
            end="drugstopoffset",
            right_columns=["__order", "dosage", "__active"],
            how="left",
        ).filter(~by_order | F.col("__active"))

    def strength(d: Drug) -> Column:
        if d.volume_rule is not None:
            return d.volume_rule.convert(rate, weight)
        return F.coalesce(*[F.when(o.matches(F.col("__order"), F.col("dosage")), o.value(rate, weight)) for o in d.orders])

    certain = by_drug(drugs, lambda d: rate if d.any_unit else convert_rates(name, rate, weight, d.units))
    with_volumes = [d for d in drugs if d.volume_names]
    value = F.when(is_volume, by_drug(with_volumes, strength)).otherwise(certain) if with_volumes else certain
    return listed.withColumn("rate", four_digits(value)).select("drug", *KEYS, "rate", *PAYLOAD).distinct()


def infusion_rates(
    infusions: DataFrame, weights: DataFrame, drug: Drug, orders: DataFrame | None = None, chunk_minutes: float = 1440
) -> DataFrame:
    """One drug's infusions with their rate in a column of its name."""
    rates = rates_of(infusions, weights, [drug], orders, chunk_minutes)
    return rates.select(*KEYS, F.col("rate").alias(drug.rate), *PAYLOAD)


def dobutamine_rates(infusions: DataFrame) -> DataFrame:
    """Dobutamine counts at any rate, so neither weights nor orders are looked at; rows stay as they are charted."""
    given = numeric_rates(infusions, [DOBUTAMINE])
    return given.select(*KEYS, four_digits(F.col("drugrate")).alias(DOBUTAMINE.rate), *PAYLOAD)
