from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from lodeworks.functions import labels as lab
from lodeworks.functions import numeric as num
from lodeworks.functions import text


def d(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize("n, den, want", [(6, 4, 1.5), (1, 0, None), (1, None, None), (None, 2, None), (0, 5, 0.0)])
def test_safe_divide(value, n, den, want):
    assert value(num.safe_divide(F.lit(n).cast("int"), F.lit(den).cast("int"))) == want


@pytest.mark.parametrize(
    "feed, conc, tail, want",
    [
        (1.0, 25.0, 0.5, 25 * 0.5 / (1.0 * 24.5) * 100),
        (None, 25.0, 0.5, None),
        (1.0, None, 0.5, None),
        (1.0, 25.0, None, None),
        (0.5, 25.0, 0.5, None),  # feed = tail
        (1.0, 0.5, 0.5, None),  # conc = tail
        (0.0, 25.0, -0.5, None),  # no feed
    ],
)
def test_recovery(value, feed, conc, tail, want):
    assert value(num.recovery(d(feed), d(conc), d(tail))) == pytest.approx(want) if want else value(num.recovery(d(feed), d(conc), d(tail))) is None


def test_recovery_lets_conc_below_feed_exceed_100(value):
    assert value(num.recovery(d(2.0), d(1.0), d(0.5))) > 100


@pytest.mark.parametrize(
    "x, digits, want",
    [(1.005, 2, 1.0), (2.675, 2, 2.68), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.5, 0, 2.0), (0.49999999999999994, 0, 0.0), (-1.2, 0, -1.0)],
)
def test_round_half_up_works_on_the_scaled_double(value, x, digits, want):
    assert value(num.round_half_up(d(x), digits)) == want


@pytest.mark.parametrize("x, digits, want", [(2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (-0.375, 2, -0.38)])
def test_round_half_even(value, x, digits, want):
    assert value(num.round_half_even(d(x), digits)) == want


def test_cap_of_null_is_the_cap(value):
    assert value(num.cap(d(None), 1.0)) == 1.0
    assert value(num.cap(d(1.7), 1.0)) == 1.0
    assert value(num.cap(d(0.7), 1.0)) == 0.7


def test_clip_keeps_null(value):
    assert value(num.clip_lower(d(None), 0.0)) is None
    assert value(num.clip_lower(d(-0.15), 0.0)) == 0.0


def test_units(value):
    assert value(num.tj_to_mwh(d(3.6))) == pytest.approx(1000.0)
    assert value(num.mj_to_kwh(d(3.6))) == 1.0
    assert value(num.kt_to_t(d(2.0))) == 2000.0
    assert value(num.implied_tonnage(d(57449.0), d(21.2))) == pytest.approx(752.7, abs=0.1)


@pytest.mark.parametrize("score, band", [(0, "Bajo"), (1, "Medio"), (4, "Medio"), (5, "Alto"), (24, "Alto"), (25, "Crítico"), (99, "Crítico")])
def test_risk_band(value, score, band):
    assert value(lab.risk_band(F.lit(score))) == band


def test_unknown_severity_scores_nothing(value):
    assert [value(lab.risk_points(F.lit(s))) for s in ("LEVE", "GRAVE", "FATAL", "CASI")] == [1, 5, 25, 0]


@pytest.mark.parametrize("hour, shift", [(0, "Noche"), (7, "Noche"), (8, "Día"), (19, "Día"), (20, "Noche"), (23, "Noche")])
def test_shift_of_hour(value, hour, shift):
    assert value(lab.shift_of_hour(F.lit(f"2024-01-01 {hour:02d}:30:00").cast("timestamp_ntz"))) == shift


def test_clean_label(value):
    assert value(text.clean_label(F.lit("     División  El Teniente (2) / El Teniente Division"))) == "División El Teniente"
    assert value(text.clean_label(F.lit("\xa0\xa0Uno\xa0 dos "))) == "Uno dos"


@pytest.mark.parametrize("label", ["  a", "\xa0\xa0a", " \xa0\ta", "a ", "", "   ", " b", "\x1c c"])
def test_indent_counts_every_blank(value, label):
    assert value(text.indent(F.lit(label))) == len(label) - len(label.lstrip())


@pytest.mark.parametrize(
    "cell", ["10,5", " 3 ", "-", "n.d.", "N.A.", "s.i.", "", "abc", "1e3", "1_000", "-4,25", ".5", "5.", "1.2.3", "inf", "NaN", "1d", "+7"]
)
def test_parse_number_like_a_float_call(value, cell):
    cleaned = cell.strip().lower()
    try:
        want = None if cleaned in text.MISSING_MARKS else float(cleaned.replace(",", "."))
    except ValueError:
        want = None
    got = value(text.parse_number(F.lit(cell)))
    assert got == want or (got is not None and want is not None and math.isnan(got) and math.isnan(want))


def test_numeric_cell_passes_through(value):
    assert value(text.parse_value(d(4.5), F.lit("whatever"))) == 4.5


@pytest.mark.parametrize("line, note", [("(1) Nota", True), ("  Fuente: x", True), ("Elaborado", True), ("n.d.: sin dato", True), ("Total (1)", False), (None, False)])
def test_is_note(value, line, note):
    assert value(text.is_note(F.lit(line).cast("string"))) is note
