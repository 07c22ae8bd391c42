"""Year-over-year evolution of each company's indicators.

The previous row is the company's previous *available* year (gaps are not
filled). Both lag passes (values, then the "fell" booleans) use the same
window, so Spark plans a single exchange on ``siren`` and one sort for both.
After staging a company has at most one row per fiscal year, so a window
partition holds at most ``max_year - min_year + 1`` rows whatever the data
size.

* ``variation_ca_pct`` / ``variation_ebitda_pct``: 100 * (now - prev) / prev,
  2 decimals, null when prev is null or 0 (sign follows the divisor).
* ``delta_marge_nette`` (2 decimals) and ``delta_bfr_jours`` (1 decimal):
  differences of the rounded values, null without a previous value.
* ``baisse_ca`` / ``baisse_marge``: strictly lower than the previous value,
  null when either side is null.
* ``flag_degradation``: null when either boolean is null; ALERTE when both
  fell this year and both fell in the previous row; VIGILANCE when one fell;
  otherwise STABLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import degradation_flag
from ..functions.numeric import round_half_away, scaled_ratio

# Columns of the mart, in output order.
OUTPUT_COLUMNS = [
    "bilan_key", "siren", "annee_fiscale", "date_cloture", "type_bilan",
    "chiffre_affaires", "ca_n1", "marge_nette_pct", "marge_nette_n1",
    "marge_ebitda_pct", "ebitda", "bfr_jours", "bfr_jours_n1",
    "ratio_endettement", "ratio_liquidite", "flag_endettement", "flag_liquidite",
    "capitaux_propres_negatifs", "effectif_moyen", "effectif_n1",
    "variation_ca_pct", "delta_marge_nette", "delta_bfr_jours", "variation_ebitda_pct",
    "baisse_ca", "baisse_marge", "flag_degradation",
]

# Fixed values: (output name, source column) of the lagged values.
LAGGED = [
    ("ca_n1", "chiffre_affaires"),
    ("marge_nette_n1", "marge_nette_pct"),
    ("marge_ebitda_n1", "marge_ebitda_pct"),
    ("ebitda_n1", "ebitda"),
    ("bfr_jours_n1", "bfr_jours"),
    ("ratio_endettement_n1", "ratio_endettement"),
    ("effectif_n1", "effectif_moyen"),
]


def _pct_change(now: str, prev: str):
    return round_half_away(scaled_ratio(100.0, F.col(now) - F.col(prev), F.col(prev)), 2)


def company_year_window():
    return Window.partitionBy("siren").orderBy("annee_fiscale")


def compute_evolution(ind: DataFrame) -> DataFrame:
    w = company_year_window()
    lagged = ind.select("*", *[F.lag(src, 1).over(w).alias(out) for out, src in LAGGED])

    mn, mn1 = F.col("marge_nette_pct"), F.col("marge_nette_n1")
    bj, bj1 = F.col("bfr_jours"), F.col("bfr_jours_n1")
    changes = lagged.select(
        "*",
        _pct_change("chiffre_affaires", "ca_n1").alias("variation_ca_pct"),
        round_half_away(mn - mn1, 2).alias("delta_marge_nette"),
        round_half_away(bj - bj1, 1).alias("delta_bfr_jours"),
        _pct_change("ebitda", "ebitda_n1").alias("variation_ebitda_pct"),
        (F.col("chiffre_affaires") < F.col("ca_n1")).alias("baisse_ca"),
        (mn < mn1).alias("baisse_marge"),
    )
    flagged = changes.select(
        "*",
        F.lag("baisse_ca", 1).over(w).alias("baisse_ca_n1"),
        F.lag("baisse_marge", 1).over(w).alias("baisse_marge_n1"),
    )
    return flagged.select(
        *OUTPUT_COLUMNS[:-1],
        degradation_flag(F.col("baisse_ca"), F.col("baisse_marge"),
                         F.col("baisse_ca_n1"), F.col("baisse_marge_n1")).alias("flag_degradation"),
    )
