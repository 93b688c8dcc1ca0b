"""Ratios, conditional aggregates and tier labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capitalized, column

# Sales channels, ticket states and their keys.
CANCELLED = "Cancelado"
CHANNELS = [(1, "Ventanilla", 0), (2, "Telefono", 1), (3, "Web", 1), (4, "Agente", 0)]
GROWTH_GOAL_PCT = 15


def half_up(c: Column, places: int) -> Column:
    """Round half up to ``places``, on decimals so that every engine agrees at ties."""
    digits = 8 if places > 2 else 6
    return F.round(c.cast(f"decimal(38,{digits})"), places).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Floating quotient, null where the divisor is zero or null."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def decimal_ratio(num: Column, den: Column, places: int) -> Column:
    """Decimal quotient of an amount of up to two places and a whole number, null where the
    divisor is zero or null. Digits after ``places``, at most 15, are cut, not rounded, as
    in the declared computed columns. The quotient has 25 places first, so that rounding
    there cannot reach the digits that stay. Amounts of 10^13 and more have no quotient."""
    wide = num.try_cast("decimal(27,14)") / F.nullif(den.cast("decimal(10,0)"), F.lit(0))
    return F.when(wide < 0, F.ceil(wide, F.lit(places))).otherwise(F.floor(wide, F.lit(places)))


def percentage(num: Column, den: Column) -> Column:
    return ratio(num.cast("double") * 100, den)


def zero_safe(den: Column, value: Column) -> Column:
    """0 where the divisor is zero, the value elsewhere."""
    return F.when(den == 0, F.lit(0.0)).otherwise(value)


def sum_when(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(0))


def is_cancelled(state: Column | str) -> Column:
    """0/1; a missing state counts as not cancelled."""
    return F.coalesce((capitalized(state) == CANCELLED).cast("int"), F.lit(0))


def valid_discount(c: Column | str) -> Column:
    """0 where the discount is null or outside 0..100."""
    d = column(c)
    return F.when(d.between(0, 100), d).otherwise(0)


def channel_key(channel: Column | str) -> Column:
    """Key of a known channel, null for any other."""
    pairs = [F.lit(x) for key, name, _ in CHANNELS for x in (name, key)]
    return F.create_map(*pairs)[capitalized(channel)]


def _tier(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    first, *rest = steps
    out = F.when(value >= first[0], first[1])
    for bound, label in rest:
        out = out.when(value >= bound, label)
    return out.otherwise(otherwise)


# Thresholds and labels of the four tiers.
def occupancy_tier(pct: Column) -> Column:
    return _tier(pct, [(75, "Alta"), (40, "Media")], "Baja")


def season_tier(index: Column) -> Column:
    return _tier(index, [(130, "Pico alto"), (100, "Normal alto"), (70, "Normal bajo")], "Valle")


def risk_tier(pct: Column) -> Column:
    return _tier(pct, [(20, "Riesgo Alto"), (10, "Riesgo Medio")], "Riesgo Bajo")


def growth_tier(pct: Column, previous: Column) -> Column:
    label = _tier(pct, [(GROWTH_GOAL_PCT, "OKR Cumplido ✓"), (0, "OKR En progreso")],
                  "OKR No cumplido ✗")
    return F.when(previous.isNotNull(), label)


def reference_label(value: Column, reference: Column) -> Column:
    return F.when(value > reference, "Supera referencia").otherwise("Debajo referencia")
