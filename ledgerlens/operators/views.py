"""Result views: what the lookup endpoints and the page read, for one
company or for all of them at once.

A company filter is a plain predicate on ``siren`` (a point lookup on a
table bucketed or sorted by ``siren``); an unknown company gives an empty
DataFrame. Per-company aggregates (``company_summary``, ``trend_summary``)
group by ``siren``; after staging a company has at most one row per fiscal
year, so every per-company list or window is bounded by the year range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.flags import flag_severity, status_band
from ..functions.numeric import non_finite_to_null
from .ordering import sort_small

# Columns of the views, in output order.
STATEMENT_COLUMNS = ["siren", "annee_fiscale", "date_cloture", "type_bilan",
                     "chiffre_affaires", "capitaux_propres", "total_actif"]
INDICATOR_COLUMNS = [
    "siren", "annee_fiscale", "date_cloture", "type_bilan", "chiffre_affaires",
    "ebitda", "marge_ebitda_pct", "resultat_net", "marge_nette_pct", "bfr", "bfr_jours",
    "ratio_liquidite", "flag_liquidite", "ratio_endettement", "flag_endettement",
    "capitaux_propres", "total_actif", "dettes_total", "effectif_moyen",
    "capitaux_propres_negatifs",
]
EVOLUTION_COLUMNS = [
    "siren", "annee_fiscale", "chiffre_affaires", "ca_n1", "variation_ca_pct",
    "marge_nette_pct", "marge_nette_n1", "delta_marge_nette",
    "bfr_jours", "bfr_jours_n1", "delta_bfr_jours", "ebitda", "variation_ebitda_pct",
    "ratio_endettement", "flag_endettement", "flag_liquidite", "flag_degradation",
    "baisse_ca", "baisse_marge",
]
ALERT_COLUMNS = ["siren", "chiffre_affaires", "variation_ca_pct", "delta_marge_nette",
                 "flag_endettement", "flag_liquidite"]
MAX_ALERTS = 500

#: Longest list of company ids that is written into a filter.
MAX_LISTED = 10_000

# Display bands (metric column, low, high, inverted).
STATUS_BANDS = [
    ("bande_ca", "chiffre_affaires", 0, 500000, False),
    ("bande_ebitda", "ebitda", 0, 1, False),
    ("bande_marge_nette", "marge_nette_pct", 0, 5, False),
    ("bande_bfr", "bfr_jours", -1, 60, True),
    ("bande_liquidite", "ratio_liquidite", 0.8, 1.2, False),
    ("bande_endettement", "ratio_endettement", 2, 1, True),
]


def clean_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every floating-point column."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(non_finite_to_null(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _for_company(df: DataFrame, siren: str | None) -> DataFrame:
    return df if siren is None else df.where(F.col("siren") == F.lit(siren))


def _newest_first(df: DataFrame, siren: str | None) -> DataFrame:
    """One company's years newest first. For all companies no global sort is
    planned (it would shuffle the whole table for presentation only)."""
    return df if siren is None else sort_small(df, F.desc("annee_fiscale"))


def company_statements(stg: DataFrame, siren: str | None = None) -> DataFrame:
    return clean_non_finite(_newest_first(_for_company(stg, siren).select(*STATEMENT_COLUMNS), siren))


def company_summary(stg: DataFrame, siren: str | None = None, as_text: bool = False) -> DataFrame:
    """Per company: number of filings and the fiscal years, newest first."""
    years = F.sort_array(F.collect_list("annee_fiscale"), asc=False)
    if as_text:
        years = F.array_join(F.transform(years, lambda y: y.cast("string")), ",")
    return (_for_company(stg, siren).groupBy("siren")
            .agg(F.count(F.lit(1)).alias("nb_exercices"), years.alias("annees")))


def company_indicators(ind: DataFrame, siren: str | None = None,
                       year: int | None = None) -> DataFrame:
    """A year of 0 or None means all years."""
    df = _for_company(ind, siren)
    if year:
        df = df.where(F.col("annee_fiscale") == F.lit(year))
    return clean_non_finite(_newest_first(df.select(*INDICATOR_COLUMNS), siren))


def of_companies(stored: DataFrame, companies: list[str] | DataFrame) -> DataFrame:
    """The rows of ``stored`` (statements, indicators or evolution) of many companies:
    a list of ids, or a frame with a column ``siren``.

    Ids of a short list reach the scan as a filter, where they select buckets and,
    by the Bloom filters of the stored tables, row groups. A frame, or a list of
    more than ``MAX_LISTED`` ids, is joined on ``siren``; a stored table is read
    bucket by bucket, without an exchange of its own. Repeated ids count once; null
    and unknown ids give nothing.
    """
    if isinstance(companies, DataFrame):
        wanted = companies.select("siren")
    else:
        ids = sorted({c for c in companies if c is not None})
        if len(ids) <= MAX_LISTED:
            return stored.where(F.col("siren").isin(ids))
        wanted = stored.sparkSession.createDataFrame([(c,) for c in ids], "siren string")
    return stored.join(wanted, "siren", "left_semi").select(*stored.columns)


def company_evolution(evo: DataFrame, siren: str | None = None) -> DataFrame:
    return clean_non_finite(_newest_first(_for_company(evo, siren).select(*EVOLUTION_COLUMNS), siren))


def trend_summary(evo: DataFrame, siren: str | None = None) -> DataFrame:
    """Per company: filings, latest year, its degradation flag (null kept)
    and the number of ALERTE years."""
    return (_for_company(evo, siren).groupBy("siren").agg(
        F.count(F.lit(1)).alias("nb_exercices"),
        F.max("annee_fiscale").alias("derniere_annee"),
        F.max_by("flag_degradation", "annee_fiscale").alias("flag_degradation_actuel"),
        F.count_if(F.col("flag_degradation") == F.lit("ALERTE")).alias("nb_annees_alerte"),
    ))


# Header pill class of the latest degradation flag (others: none).
DEGRADATION_PILL = {"ALERTE": "warn", "VIGILANCE": "warn", "STABLE": "ok"}


def company_header(evo: DataFrame, siren: str | None = None) -> DataFrame:
    """The page header of a company: number of filings, latest year, its
    filing type, its degradation flag and pill class, and whether its equity
    is negative. One aggregation per company (bounded by the year range)."""
    year = "annee_fiscale"
    latest_flag = F.max_by("flag_degradation", year)
    pill = F.create_map(*[F.lit(x) for kv in DEGRADATION_PILL.items() for x in kv])
    return (_for_company(evo, siren).groupBy("siren").agg(
        F.count(F.lit(1)).alias("nb_exercices"),
        F.max(year).alias("derniere_annee"),
        F.max_by("type_bilan", year).alias("type_bilan"),
        latest_flag.alias("flag_degradation"),
        F.max_by("capitaux_propres_negatifs", year).alias("capitaux_propres_negatifs"),
    ).select("*", F.try_element_at(pill, F.col("flag_degradation")).alias("pastille_degradation")))


def degradation_alerts(evo: DataFrame, year: int = 2023, min_ca: int = 500000,
                       limit: int = 50) -> DataFrame:
    """ALERTE filings of ``year`` with revenue >= ``min_ca``; the steepest
    revenue falls first (unknown change last, ties by company); at most
    ``limit`` rows, 0 <= limit <= 500."""
    if not 0 <= limit <= MAX_ALERTS:
        raise ValueError(f"limit must be between 0 and {MAX_ALERTS}")
    return clean_non_finite(
        evo.where((F.col("annee_fiscale") == F.lit(year))
                  & (F.col("flag_degradation") == F.lit("ALERTE"))
                  & (F.col("chiffre_affaires") >= F.lit(min_ca)))
        .orderBy(F.asc_nulls_last("variation_ca_pct"), F.asc("siren"))
        .limit(limit)
        .select(*ALERT_COLUMNS))


def _ranking(bench: DataFrame, year: int, min_companies: int, by: str, cols: list[str],
             limit: int) -> DataFrame:
    return (bench.where((F.col("annee_fiscale") == F.lit(year))
                        & (F.col("nb_entreprises") >= F.lit(min_companies)))
            .orderBy(F.desc_nulls_last(by), F.asc("naf_division"), F.asc("secteur_macro"))
            .limit(limit)
            .select(*cols))


def ranking_margin(bench: DataFrame, year: int = 2023, min_companies: int = 200,
                   limit: int = 15) -> DataFrame:
    """Panels of ``year`` by median net margin, highest first."""
    return _ranking(bench, year, min_companies, "p50_marge_nette",
                    ["naf_division", "secteur_macro", "nb_entreprises", "p25_marge_nette",
                     "p50_marge_nette", "p75_marge_nette", "pct_cp_negatifs"], limit)


def ranking_bfr(bench: DataFrame, year: int = 2023, min_companies: int = 200,
                limit: int = 10) -> DataFrame:
    """Panels of ``year`` by median working-capital days, highest first."""
    return _ranking(bench, year, min_companies, "p50_bfr_jours",
                    ["naf_division", "secteur_macro", "nb_entreprises", "p25_bfr_jours",
                     "p50_bfr_jours", "p75_bfr_jours"], limit)


def benchmark_report(bench: DataFrame) -> DataFrame:
    """The benchmark in presentation order: newest year first, then the
    largest panels (ties by division and sector). Stored tables carry no
    order; this sorts when reading."""
    return sort_small(bench, F.desc("annee_fiscale"), F.desc("nb_entreprises"),
                      F.asc("naf_division"), F.asc("secteur_macro"))


def division_history(bench: DataFrame, division: str = "62", limit: int = 5) -> DataFrame:
    """One division's panels, newest year first (ties by sector label)."""
    return (bench.where(F.col("naf_division") == F.lit(division))
            .orderBy(F.desc("annee_fiscale"), F.asc("secteur_macro"))
            .limit(limit)
            .select("annee_fiscale", "nb_entreprises", "p25_marge_nette", "p50_marge_nette",
                    "p75_marge_nette", "p50_bfr_jours", "p50_endettement", "pct_cp_negatifs"))


def status_bands(ind: DataFrame) -> DataFrame:
    """green / yellow / red / muted band of six metrics for every filing."""
    return ind.select("bilan_key", "siren", "annee_fiscale",
                      *[status_band(F.col(src), lo, hi, inv).alias(name)
                        for name, src, lo, hi, inv in STATUS_BANDS])


def flag_severities(evo: DataFrame) -> DataFrame:
    """ok / warn / danger of the three flags of every filing."""
    return evo.select(
        "bilan_key", "siren", "annee_fiscale",
        "flag_degradation", flag_severity(F.col("flag_degradation")).alias("niveau_degradation"),
        "flag_liquidite", flag_severity(F.col("flag_liquidite")).alias("niveau_liquidite"),
        "flag_endettement", flag_severity(F.col("flag_endettement")).alias("niveau_endettement"),
    )


def evolution_rows(evo: DataFrame, siren: str | None = None) -> DataFrame:
    """Year-over-year table rows: only years with a revenue change, with the
    direction of the change and of the margin delta (null when unknown)."""
    var, dm = F.col("variation_ca_pct"), F.col("delta_marge_nette")
    return clean_non_finite(_newest_first(
        _for_company(evo, siren).where(var.isNotNull()).select(
            "siren", "annee_fiscale", "chiffre_affaires", "variation_ca_pct",
            "marge_nette_pct", "delta_marge_nette", "bfr_jours", "flag_degradation",
            F.when(var > F.lit(0), F.lit("hausse")).otherwise(F.lit("baisse")).alias("sens_ca"),
            F.when(dm.isNull(), F.lit(None).cast("string"))
             .when(dm > F.lit(0), F.lit("hausse")).otherwise(F.lit("baisse")).alias("sens_marge"),
        ), siren))


def revenue_series(ind: DataFrame, siren: str | None = None) -> DataFrame:
    """Positive revenues in year order, each as a share of the company's
    largest one (the bar heights of the revenue chart)."""
    w = Window.partitionBy("siren")
    ca = F.col("chiffre_affaires")
    series = (_for_company(ind, siren).where(ca > F.lit(0))
              .select("siren", "annee_fiscale", "chiffre_affaires",
                      (ca.cast("double") / F.max(ca).over(w).cast("double")).alias("part_du_max")))
    return series if siren is None else sort_small(series, "annee_fiscale")
