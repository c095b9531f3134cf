"""Conversions of declared units to canonical ones."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

BOE, USD = "BOE", "USD"
MCF_PER_BOE = 6.0
GAS_NOTE = "six thousand cubic feet of gas count as one barrel of oil equivalent"

# Barrels of a liquid unit, cubic feet of a gas unit.
BARRELS = {
    "boe": 1.0, "Boe": 1.0, "BOE": 1.0, "bbl": 1.0, "bbls": 1.0, "Bbl": 1.0, "Bbls": 1.0, "BBL": 1.0,
    "MBoe": 1e3, "MBbl": 1e3, "MBbls": 1e3, "Mbbls": 1e3, "MMBoe": 1e6, "MMBbl": 1e6, "MMBbls": 1e6, "MMbbls": 1e6,
}
CUBIC_FEET = {"ft3": 1.0, "Mcf": 1e3, "Mcfe": 1e3, "MMcf": 1e6, "MMcfe": 1e6, "Bcf": 1e9, "Bcfe": 1e9, "Tcf": 1e12, "Tcfe": 1e12}

FACTORS = {"USD": 1.0, "usd": 1.0} | BARRELS | {u: f / (MCF_PER_BOE * 1000) for u, f in CUBIC_FEET.items()}


def _lookup(values: dict, unit: Column) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])[unit]


def factor(unit: Column) -> Column:
    """Canonical units per declared unit; null where there is none, as for rates."""
    return _lookup(FACTORS, unit)


def canonical_unit(unit: Column) -> Column:
    return F.when(F.lower(unit) == "usd", F.when(unit.isin("USD", "usd"), USD)).when(factor(unit).isNotNull(), BOE)


def conversion_note(unit: Column) -> Column:
    return F.when(unit.isin(*CUBIC_FEET), GAS_NOTE)


def normalise(value: Column, unit: Column, scale: Column) -> Column:
    """The canonical value of what the filing prints, value / scale; a scale of null or 0 counts as 1."""
    return value / F.when(F.coalesce(scale, F.lit(0.0)) == 0, F.lit(1.0)).otherwise(scale) * factor(unit)


def half_last_place(shown: Column, scale: Column) -> Column:
    """Half a unit of the last printed place times 10^scale; null where nothing numeric is shown."""
    clean = F.regexp_replace(shown, "[,\\s()$-]", "")
    decimals = F.length(F.regexp_extract(clean, r"\.([0-9]*)$", 1))
    return F.when(clean.rlike(r"^[0-9]*\.?[0-9]+$|^[0-9]+\.$"), F.lit(0.5) * F.pow(F.lit(10.0), -decimals) * F.pow(F.lit(10.0), scale))


def is_power_of_ten(ratio: Column) -> Column:
    """A non-zero power of ten, within rounding."""
    log = F.log10(ratio)
    return (ratio > 0) & (F.abs(log - F.round(log)) < 1e-6) & (F.round(log) != 0)
