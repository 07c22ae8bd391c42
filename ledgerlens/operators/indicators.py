"""Financial indicators, one row in and one row out of the staged filings.

Row-wise only (a projection): no shuffle, fused into the stage that
produces the staged rows. Conditions stand inside the rounding, so that its parts
are computed once; the JVM only compiles methods of up to 8,000 bytes of code, and
the generated loop of the whole projection must stay below that.

* ``ebitda``            = EBE + depreciation allowances
* ``marge_ebitda_pct``  = 100 * ebitda / revenue, 2 decimals, revenue > 0 only
* ``marge_nette_pct``   = 100 * net result / revenue, 2 decimals, revenue > 0 only
* ``bfr``               = inventories + trade receivables - trade payables
* ``bfr_jours``         = bfr * 365 / revenue, 1 decimal, revenue > 0 only
* ``ratio_liquidite``   = current assets / max(total debt - financial debt, 0),
  3 decimals, null without short-term debt
* ``flag_liquidite``    = LIQUIDE (>= 1) / TENSION (>= 0.8) / RISQUE, on the
  unrounded ratio
* ``ratio_endettement`` = financial debt / equity, 3 decimals, null if equity <= 0
* ``flag_endettement``  = CP_NEGATIFS / SANS_DETTE / TRES_ENDETTÉ (> 2) /
  ENDETTÉ (> 1) / SAIN, on the unrounded ratio

Ratios are computed in double precision with the multiplication done before
the division, and rounded half away from zero on the scaled binary value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import debt_flag, liquidity_flag
from ..functions.numeric import round_half_away, safe_ratio, scaled_ratio

# Columns carried from staging, in output order.
PASS_THROUGH = [
    "bilan_key", "siren", "annee_fiscale", "date_cloture", "type_bilan",
    "capitaux_propres_negatifs", "chiffre_affaires", "resultat_net",
    "capitaux_propres", "total_actif", "dettes_total", "dettes_financieres",
    "effectif_moyen",
]


def compute_indicators(stg: DataFrame) -> DataFrame:
    ca = F.col("chiffre_affaires")
    has_revenue = ca > F.lit(0)
    ebitda = F.col("ebe") + F.col("dotations_amortissements")
    bfr = F.col("stocks_net") + F.col("creances_clients_net") - F.col("dettes_fournisseurs")
    short_term_debt = F.greatest(F.col("dettes_total") - F.col("dettes_financieres"), F.lit(0))
    liquidity = safe_ratio(F.col("actif_circulant_net"), short_term_debt)
    equity = F.col("capitaux_propres")
    leverage = safe_ratio(F.col("dettes_financieres"), equity)

    return stg.select(
        *PASS_THROUGH,
        ebitda.alias("ebitda"),
        round_half_away(F.when(has_revenue, scaled_ratio(100.0, ebitda, ca)), 2).alias("marge_ebitda_pct"),
        round_half_away(F.when(has_revenue, scaled_ratio(100.0, F.col("resultat_net"), ca)), 2)
        .alias("marge_nette_pct"),
        bfr.alias("bfr"),
        round_half_away(F.when(has_revenue, scaled_ratio(365.0, bfr, ca)), 1).alias("bfr_jours"),
        round_half_away(liquidity, 3).alias("ratio_liquidite"),
        liquidity_flag(liquidity).alias("flag_liquidite"),
        round_half_away(F.when(~(equity <= F.lit(0)), leverage), 3).alias("ratio_endettement"),
        debt_flag(equity, F.col("dettes_financieres"), leverage).alias("flag_endettement"),
    )
