"""Sector benchmark: quartiles of six indicators per division, sector and year.

Filings with positive revenue are joined (inner, on ``siren``) with the
staged companies. Per (``naf_division``, ``secteur_macro``,
``annee_fiscale``): number of distinct companies, exact P25/P50/P75 of
revenue in thousands (0 decimals), net margin and EBITDA margin
(2 decimals), working-capital days (1 decimal), debt ratio and liquidity
ratio (3 decimals), each over its own non-null values, and the share of
filings with negative equity (1 decimal). Panels with fewer than
``min_panel`` companies are dropped.

Plan: the join shuffles (or broadcasts, by AQE's runtime size) on ``siren``.
Counts aggregate per (group, company) first, so a hot panel is spread by
company; quartiles come from ``quantiles.exact_percentiles``, which spreads it
by value. Nothing runs while the DataFrame is built. Counts and quartiles both
read the joined base: ``store`` (for instance ``session.materialize``) is the
caller's explicit step to write it once. ``year`` and ``division`` are panel
keys and are applied before the join and before ``store``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_half_away
from .quantiles import exact_percentiles, percentile_column

KEYS = ["naf_division", "secteur_macro", "annee_fiscale"]
PROBS = [0.5, 0.25, 0.75]
# Fixed values: (output stem, indicator column, scale divisor, decimals) of the report.
MEASURES = [
    ("ca_k", "chiffre_affaires", 1000.0, 0),
    ("marge_nette", "marge_nette_pct", None, 2),
    ("marge_ebitda", "marge_ebitda_pct", None, 2),
    ("bfr_jours", "bfr_jours", None, 1),
    ("endettement", "ratio_endettement", None, 3),
    ("liquidite", "ratio_liquidite", None, 3),
]
DEFAULT_MIN_PANEL = 50


def benchmark_base(ind: DataFrame, ent: DataFrame, year: int | None = None,
                   division: str | None = None) -> DataFrame:
    """Filings with positive revenue and their company's panel keys."""
    if year is not None:
        ind = ind.where(F.col("annee_fiscale") == F.lit(year))
    if division is not None:
        ent = ent.where(F.col("naf_division") == F.lit(division))
    return (ind.where(F.col("chiffre_affaires") > F.lit(0))
            .join(ent.select("siren", "code_naf", "naf_division", "secteur_macro"), "siren", "inner"))


def sector_benchmark(ind: DataFrame, ent: DataFrame, min_panel: int = DEFAULT_MIN_PANEL, *,
                     year: int | None = None, division: str | None = None,
                     store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    base = benchmark_base(ind, ent, year, division).select(
        *KEYS, "siren", "capitaux_propres_negatifs", *[src for _, src, _, _ in MEASURES])
    if store is not None:
        base = store(base, "sector-benchmark-base")
    per_company = (base.groupBy(*KEYS, "siren")
                   .agg(F.count(F.lit(1)).alias("_rows"),
                        F.count_if(F.col("capitaux_propres_negatifs")).alias("_neg")))
    counts = (per_company.groupBy(*KEYS)
              .agg(F.count(F.lit(1)).alias("nb_entreprises"),
                   F.sum("_rows").alias("_rows"), F.sum("_neg").alias("_neg"))
              .where(F.col("nb_entreprises") >= F.lit(min_panel)))
    quart = exact_percentiles(base, KEYS, {stem: src for stem, src, _, _ in MEASURES}, PROBS)
    # Keys are never null here (the division comes from a non-null code, the
    # year is range-filtered), so a plain equi-join fits.
    return _report(counts.join(quart, KEYS, "left"))


def _report(joined: DataFrame) -> DataFrame:
    """Output columns from panel keys, counts and raw percentiles."""
    cols = [F.col(k) for k in KEYS] + [F.col("nb_entreprises")]
    for stem, _, divisor, digits in MEASURES:
        for p in PROBS:
            v = F.col(percentile_column(stem, p))
            if divisor:
                v = v / F.lit(divisor)
            cols.append(round_half_away(v, digits).alias(f"p{round(p * 100)}_{stem}"))
    cols.append(round_half_away(F.lit(100.0) * F.col("_neg") / F.col("_rows"), 1)
                .alias("pct_cp_negatifs"))
    return joined.select(*cols)
