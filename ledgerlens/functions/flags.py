"""Classification expressions: ratio flags, degradation flag, display bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label sets and thresholds of the published indicators.
LIQUIDITY_FLAGS = ["LIQUIDE", "TENSION", "RISQUE"]
LIQUIDITY_OK, LIQUIDITY_TENSION = 1.0, 0.8
DEBT_FLAGS = ["SAIN", "ENDETTÉ", "TRES_ENDETTÉ", "CP_NEGATIFS", "SANS_DETTE"]
DEBT_HIGH, DEBT_MID = 2, 1
DEGRADATION_FLAGS = ["ALERTE", "VIGILANCE", "STABLE"]
FILING_TYPES = ["C", "S", "K", "N"]

# Display severity of each flag; any other flag is "warn".
FLAG_SEVERITY = {
    "ALERTE": "danger", "VIGILANCE": "warn", "STABLE": "ok",
    "LIQUIDE": "ok", "TENSION": "warn", "RISQUE": "danger",
    "SAIN": "ok", "ENDETTÉ": "warn", "TRES_ENDETTÉ": "danger",
    "CP_NEGATIFS": "danger", "SANS_DETTE": "ok",
}
UNKNOWN_SEVERITY = "warn"


def liquidity_flag(ratio: Column) -> Column:
    """On the unrounded ratio; a null ratio (no short-term debt) is RISQUE."""
    return (F.when(ratio >= F.lit(LIQUIDITY_OK), F.lit("LIQUIDE"))
            .when(ratio >= F.lit(LIQUIDITY_TENSION), F.lit("TENSION"))
            .otherwise(F.lit("RISQUE")))


def debt_flag(equity: Column, financial_debt: Column, ratio: Column) -> Column:
    """Checked in order: equity <= 0, no financial debt, ratio > 2, ratio > 1."""
    return (F.when(equity <= F.lit(0), F.lit("CP_NEGATIFS"))
            .when(financial_debt == F.lit(0), F.lit("SANS_DETTE"))
            .when(ratio > F.lit(DEBT_HIGH), F.lit("TRES_ENDETTÉ"))
            .when(ratio > F.lit(DEBT_MID), F.lit("ENDETTÉ"))
            .otherwise(F.lit("SAIN")))


def degradation_flag(fall_ca: Column, fall_margin: Column,
                     fall_ca_prev: Column, fall_margin_prev: Column) -> Column:
    """Three-valued: null when either current boolean is unknown; ALERTE
    needs all four booleans true (an unknown previous one is not true)."""
    return (F.when(fall_ca.isNull() | fall_margin.isNull(), F.lit(None).cast("string"))
            .when(F.coalesce(fall_ca & fall_margin & fall_ca_prev & fall_margin_prev, F.lit(False)),
                  F.lit("ALERTE"))
            .when(fall_ca | fall_margin, F.lit("VIGILANCE"))
            .otherwise(F.lit("STABLE")))


def status_band(value: Column, lo: float, hi: float, inverted: bool = False) -> Column:
    """green / yellow / red / muted band of a metric value.

    Normal: >= hi green, >= lo yellow, else red. Inverted: <= lo green,
    <= hi yellow, else red. Null is muted.
    """
    if not inverted:
        band = (F.when(value >= F.lit(hi), F.lit("green"))
                .when(value >= F.lit(lo), F.lit("yellow")).otherwise(F.lit("red")))
    else:
        band = (F.when(value <= F.lit(lo), F.lit("green"))
                .when(value <= F.lit(hi), F.lit("yellow")).otherwise(F.lit("red")))
    return F.when(value.isNull(), F.lit("muted")).otherwise(band)


def flag_severity(flag: Column) -> Column:
    """ok / warn / danger of a flag; unknown flags are warn, null stays null."""
    mapping = F.create_map(*[F.lit(x) for kv in FLAG_SEVERITY.items() for x in kv])
    return F.when(flag.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_element_at(mapping, flag), F.lit(UNKNOWN_SEVERITY)))
