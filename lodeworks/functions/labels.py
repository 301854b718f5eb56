"""Categories: banding, recoding, and the warehouse's own labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, weights and thresholds that the published tables use.
DAY_SHIFT, NIGHT_SHIFT = "Día", "Noche"
DAY_SHIFT_HOURS = (8, 19)
SITES = ["Andina", "Los Bronces", "El Teniente"]
SEVERITY_POINTS = {"LEVE": 1, "GRAVE": 5, "FATAL": 25}
SERIOUS = ["GRAVE", "FATAL"]
RISK_LEVELS = ["Bajo", "Medio", "Alto", "Crítico"]
RISK_LIMITS = [5, 25]
NORTH_BUSES = ["Crucero", "Cardones", "Pan de Azucar"]
SOUTH_BUSES = ["Quillota", "Charrua", "Puerto Montt"]
SOLAR_HOURS = list(range(10, 17))
NIGHT_HOURS = [20, 21, 22, 23, 0, 1, 2, 3, 4, 5, 6]


def recode(x: Column, mapping: Mapping, default=None) -> Column:
    """Simple CASE: mapping[x], or default."""
    out = None
    for key, value in mapping.items():
        out = F.when(x == key, F.lit(value)) if out is None else out.when(x == key, F.lit(value))
    return out.otherwise(F.lit(default))


def classify(condition: Column, yes: str, no: str) -> Column:
    """Two-way CASE; a null condition counts as no."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def zero_as_null(value: Column, applies: Column) -> Column:
    """Null for a zero that means "not published", where ``applies`` holds."""
    return F.when(applies & (value == 0), F.lit(None)).otherwise(value)


def shift_of_hour(ts: Column) -> Column:
    """Day shift covers hours 8 to 19 of the same calendar day, night shift all others."""
    return classify(F.hour(ts).between(*DAY_SHIFT_HOURS), DAY_SHIFT, NIGHT_SHIFT)


def shift_order(shift: Column) -> Column:
    return F.when(shift == DAY_SHIFT, 0).otherwise(1)


def risk_points(severity: Column) -> Column:
    """Points of one incident; an unknown severity scores 0."""
    return recode(severity, SEVERITY_POINTS, 0)


def risk_band(score: Column) -> Column:
    """Level of a shift's summed points."""
    none, low, high, top = RISK_LEVELS
    return (
        F.when(score == 0, none).when(score < RISK_LIMITS[0], low).when(score < RISK_LIMITS[1], high).otherwise(top)
    )


def bus_zone(bus: Column) -> Column:
    return classify(bus.isin(NORTH_BUSES), "Norte", "Centro-sur")


def local_hour(report_hour: Column) -> Column:
    """Hour h (1-24) of a report is the block that starts at local hour h - 1."""
    return report_hour - 1


def avg_where(x: Column, flag: Column) -> Column:
    """Mean of x over the rows where flag holds."""
    return F.avg(F.when(flag, x))


def max_where(x: Column, flag: Column) -> Column:
    return F.max(F.when(flag, x))


def sum_where(x: Column, flag: Column) -> Column:
    return F.sum(F.when(flag, x))
