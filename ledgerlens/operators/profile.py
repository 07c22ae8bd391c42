"""Profiling reports over the raw accounts (and the company register).

Every report is a DataFrame; nothing reaches the driver before it is used, and
columns are read once per aggregate.
Where the source schema varies, a report takes the first present column of
a candidate list (``first_present``) instead of trying queries in turn.

* ``volume``          – rows and distinct companies.
* ``rows_per_year``   – rows per value of the year column.
* ``top_codes``       – the most frequent activity codes (ties by code).
* ``null_rates_wide`` – null percentage of each present finance column, one row.
* ``null_rates``      – the same for the profiling column list, one row per
  column (a single aggregate unpivoted, not one scan per column).
* ``filing_types``    – per filing type with positive revenue: rows, median
  revenue in thousands, share of rows.
* ``revenue_segments``– seven revenue classes for one year: rows and share.
* ``outliers``        – four counts of implausible values.
* ``duplicate_pairs`` – number of (company, year) pairs filed more than once.
* ``balance_coherence`` – filings whose assets and liabilities differ by more
  than 5 % of assets.
* ``report``          – all of these but the medians from one scan and one count.

Shares of a total are a window over the (few) aggregated rows, never over
the input rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half_away
from .ordering import sort_small
from .quantiles import exact_percentiles, percentile_column

# Candidate column names and column lists of the reports.
YEAR_CANDIDATES = ["annee", "exercice", "date_cloture", "year"]
CODE_CANDIDATES = ["code_naf", "naf", "ape", "code_ape"]
FINANCE_CANDIDATES = ["ca", "chiffre_affaires", "resultat_net", "capitaux_propres",
                      "total_actif", "dettes", "stocks", "amortissements"]
NULL_PROFILE_COLUMNS = [
    "chiffre_affaires", "resultat_net", "resultat_exercice",
    "capitaux_propres", "total_actif", "total_passif",
    "dettes_total", "dettes_fournisseurs", "dettes_financieres",
    "stocks_net", "creances_clients_net",
    "dotations_amortissements", "resultat_exploitation",
    "charges_personnel", "ebe", "effectif_moyen",
    "capacite_autofinancement", "bfr",
]
# Revenue classes (upper bound exclusive, label); a revenue at
# or below zero is the first class, anything not below the last bound
# (including unknown revenue) the last one.
NON_POSITIVE_SEGMENT = "0. Nul/négatif"
REVENUE_SEGMENTS = [
    (500000, "1. Micro <500k"),
    (2000000, "2. TPE 500k-2M"),
    (10000000, "3. PME 2M-10M"),
    (50000000, "4. ETI 10M-50M"),
    (250000000, "5. Grande 50M-250M"),
]
TOP_SEGMENT = "6. >250M"
HUGE_REVENUE = 1000000000
COHERENCE_TOLERANCE = Decimal("0.05")


def first_present(df: DataFrame, candidates: list[str]) -> str | None:
    present = set(df.columns)
    return next((c for c in candidates if c in present), None)


def _share(count_col: str) -> Column:
    """Percentage of the total of ``count_col`` over all rows, 1 decimal."""
    total = F.sum(count_col).over(Window.partitionBy())
    return round_half_away(F.lit(100.0) * F.col(count_col) / total, 1)


def _null_pct(c: str) -> Column:
    return round_half_away(
        F.lit(100.0) * F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)) / F.count(F.lit(1)), 1)


def describe(df: DataFrame) -> DataFrame:
    """Column names and types of a table (schema metadata, one row each)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, column_type string, nullable boolean")


def volume(raw: DataFrame) -> DataFrame:
    """Rows and distinct companies; the distinct count is a two-step
    aggregation (per company, then global), so no key set sits in one task."""
    per_company = raw.groupBy("siren").agg(F.count(F.lit(1)).alias("_n"))
    return per_company.agg(F.sum("_n").cast("bigint").alias("nb_lignes"),
                           F.count("siren").alias("nb_siren"))


def rows_per_year(raw: DataFrame, candidates: list[str] = YEAR_CANDIDATES) -> DataFrame:
    """Rows per value of the first candidate column present; no rows when there
    is none."""
    col = first_present(raw, candidates)
    if col is None:
        return raw.sparkSession.createDataFrame([], f"{candidates[0]} string, nb long")
    return sort_small(raw.groupBy(col).agg(F.count(F.lit(1)).alias("nb")),
                      F.col(col).asc_nulls_last())


def top_codes(df: DataFrame, n: int = 10, candidates: list[str] = CODE_CANDIDATES) -> DataFrame:
    """The ``n`` most frequent codes of the first candidate column present; no
    rows when there is none."""
    col = first_present(df, candidates)
    if col is None:
        return df.sparkSession.createDataFrame([], f"{candidates[0]} string, nb long")
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.desc("nb"), F.col(col).asc_nulls_last())
            .limit(n))


def null_rates_wide(raw: DataFrame, candidates: list[str] = FINANCE_CANDIDATES) -> DataFrame:
    """One row over the candidate columns present; no row when there is none."""
    cols = [c for c in candidates if c in set(raw.columns)]
    if not cols:
        return raw.sparkSession.createDataFrame(
            [], ", ".join(f"null_pct_{c} double" for c in candidates))
    return raw.agg(*[_null_pct(c).alias(f"null_pct_{c}") for c in cols])


def null_rates(raw: DataFrame, columns: list[str] = NULL_PROFILE_COLUMNS) -> DataFrame:
    """One row per listed column, highest null rate first. A listed column
    that is absent is an error."""
    missing = [c for c in columns if c not in set(raw.columns)]
    if missing:
        raise ValueError(f"columns not present: {missing}")
    wide = raw.agg(*[_null_pct(c).alias(c) for c in columns])
    return sort_small(wide.unpivot([], list(columns), "col", "pct_null"),
                      F.desc_nulls_last("pct_null"), F.asc("col"))


def filing_types(raw: DataFrame) -> DataFrame:
    """Revenue is positive, hence not null: the median operator's value
    count is the row count, so one pass gives both."""
    positive = raw.where(F.col("chiffre_affaires") > F.lit(0))
    med = exact_percentiles(positive, ["type_bilan"], {"ca": "chiffre_affaires"}, [0.5],
                            with_counts=True)
    return sort_small(med.select(
        "type_bilan",
        F.col("ca_n").alias("nb"),
        round_half_away(F.col(percentile_column("ca", 0.5)) / F.lit(1000.0), 0).alias("ca_median_k"),
        _share("ca_n").alias("pct"),
    ), F.desc("nb"), F.col("type_bilan").asc_nulls_last())


def revenue_segment(ca: Column) -> Column:
    expr = F.when(ca <= F.lit(0), F.lit(NON_POSITIVE_SEGMENT))
    for bound, label in REVENUE_SEGMENTS:
        expr = expr.when(ca < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(TOP_SEGMENT))


def revenue_segments(raw: DataFrame, year: int) -> DataFrame:
    """Unknown revenue compares as unknown everywhere and lands in the last
    class, as in SQL."""
    return sort_small(raw.where(F.col("annee") == F.lit(year))
                      .groupBy(revenue_segment(F.col("chiffre_affaires")).alias("segment"))
                      .agg(F.count(F.lit(1)).alias("nb"))
                      .select("segment", "nb", _share("nb").alias("pct")), "segment")


def _count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): null on empty input."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def outliers(raw: DataFrame) -> DataFrame:
    ca, rn, cp = F.col("chiffre_affaires"), F.col("resultat_net"), F.col("capitaux_propres")
    return raw.agg(
        _count_when(ca.isNull() | (ca <= F.lit(0))).alias("ca_nul"),
        _count_when(ca > F.lit(HUGE_REVENUE)).alias("ca_sup_1B"),
        _count_when(cp < F.lit(0)).alias("cp_negatifs"),
        _count_when((rn > ca) & (ca > F.lit(0))).alias("rn_sup_ca"),
    )


def duplicate_pairs(raw: DataFrame) -> DataFrame:
    return (raw.groupBy("siren", "annee").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > F.lit(1))
            .agg(F.count(F.lit(1)).alias("nb_doublons")))


def balance_coherence(raw: DataFrame) -> DataFrame:
    """Exact decimal comparison ``|assets - liabilities| > assets * 0.05``."""
    a, p = F.col("total_actif"), F.col("total_passif")
    bad = F.abs(a - p) > a * F.lit(COHERENCE_TOLERANCE)
    n_bad = _count_when(bad)
    return (raw.where(a.isNotNull() & p.isNotNull() & (a > F.lit(0)))
            .agg(F.count(F.lit(1)).alias("total_avec_actif_passif"),
                 n_bad.alias("incoherents"),
                 round_half_away(F.lit(100.0) * n_bad / F.count(F.lit(1)), 1).alias("pct_incoherents")))


def _cells(raw: DataFrame, year: int) -> tuple[list[Column], list[Column]]:
    """What a row is counted under: (report, item, detail) cells that every row
    has, and those that only some rows have (null otherwise)."""
    ca, rn, cp = F.col("chiffre_affaires"), F.col("resultat_net"), F.col("capitaux_propres")
    assets, owed = F.col("total_actif"), F.col("total_passif")
    balanced = (assets > F.lit(0)) & owed.isNotNull()

    def cell(report: str, item, detail=None) -> Column:
        item = F.lit(item) if isinstance(item, str) else item.cast("string")
        return F.struct(F.lit(report).alias("report"), item.alias("item"),
                        (F.lit(None) if detail is None else detail).cast("string").alias("detail"))

    always = [cell("pairs", F.col("siren"), F.col("annee")), cell("years", F.col("annee")),
              cell("codes", F.col("code_naf"))]
    some = [F.when(ca > F.lit(0), cell("types", F.col("type_bilan"))),
            F.when(F.col("annee") == F.lit(year), cell("segments", revenue_segment(ca)))]
    flags = {("nulls", c): F.col(c).isNull() for c in NULL_PROFILE_COLUMNS}
    flags |= {("outliers", "ca_nul"): ca.isNull() | (ca <= F.lit(0)),
              ("outliers", "ca_sup_1B"): ca > F.lit(HUGE_REVENUE),
              ("outliers", "cp_negatifs"): cp < F.lit(0),
              ("outliers", "rn_sup_ca"): (rn > ca) & (ca > F.lit(0)),
              ("coherence", "total_avec_actif_passif"): balanced,
              ("coherence", "incoherents"): balanced & (
                  F.abs(assets - owed) > assets * F.lit(COHERENCE_TOLERANCE))}
    return always, some + [F.when(on, cell(*at)) for at, on in flags.items()]


def _fixed_cells() -> list[tuple[str, str]]:
    """Cells that are reported whether or not a row is in them."""
    return ([("nulls", c) for c in NULL_PROFILE_COLUMNS]
            + [("outliers", c) for c in ("ca_nul", "ca_sup_1B", "cp_negatifs", "rn_sup_ca")]
            + [("coherence", c) for c in ("total_avec_actif_passif", "incoherents")])


def report(raw: DataFrame, year: int, top: int = 10) -> DataFrame:
    """The profile in one scan: report, item, metric, value.

    A row is counted under the cells it belongs to (its company and year, its
    year, its code, its class, each null column, each flag), in one aggregate
    that is partial before its exchange; only (company, year) cells grow with
    the data. They are folded per company, then all cells per report and item.
    ``segments`` are those of ``year``, ``codes`` the ``top`` most frequent ones. An
    empty table has counts of 0, and null shares.
    """
    always, some = _cells(raw, year)
    cells = F.concat(F.array(*always), F.filter(F.array(*some), lambda c: c.isNotNull()))
    counted = (raw.select(F.explode(cells).alias("c")).groupBy("c.report", "c.item", "c.detail")
               .agg(F.count(F.lit(1)).alias("n")))
    folded = counted.groupBy("report", "item").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("repeated"))
    blank = raw.sparkSession.createDataFrame(
        [(r, i, 0, 0) for r, i in [*_fixed_cells(), ("pairs", None)]],
        "report string, item string, n long, repeated long")
    is_pair = F.col("report") == "pairs"
    totals = (folded.unionByName(blank)
              .groupBy("report", F.when(~is_pair, F.col("item")).alias("item"))
              .agg(F.sum("n").alias("n"), F.count("item").alias("members"),
                   F.sum("repeated").alias("repeated")))
    # from here on a few rows per report
    of_report = Window.partitionBy("report")
    rows = F.max(F.when(is_pair, F.col("n"))).over(Window.partitionBy())
    balanced = F.max(F.when(F.col("item") == "total_avec_actif_passif", F.col("n"))).over(of_report)
    placed = totals.select(
        "*", rows.alias("rows"), F.sum("n").over(of_report).alias("all"), balanced.alias("balanced"),
        F.row_number().over(of_report.orderBy(F.desc("n"), F.col("item").asc_nulls_last())).alias("place"))

    def line(name: str, item, metric, value) -> Column:
        return F.struct(F.lit(name).alias("report"), item.alias("item"),
                        metric.alias("metric"), value.cast("double").alias("value"))

    def percent(of: str) -> Column:
        return round_half_away(F.lit(100.0) * F.col("n") / F.nullif(F.col(of), F.lit(0)), 1)

    n, item, nothing = F.col("n"), F.col("item"), F.lit(None).cast("string")
    lines = (
        F.when(is_pair, F.array(line("volume", nothing, F.lit("nb_lignes"), n),
                                line("volume", nothing, F.lit("nb_siren"), F.col("members")),
                                line("duplicates", nothing, F.lit("nb_doublons"), F.col("repeated"))))
        .when(F.col("report") == "years", F.array(line("years", item, F.lit("nb"), n)))
        .when((F.col("report") == "codes") & (F.col("place") <= top),
              F.array(line("codes", item, F.lit("nb"), n))))
    for name in ("types", "segments"):
        lines = lines.when(F.col("report") == name, F.array(
            line(name, item, F.lit("nb"), n), line(name, item, F.lit("pct"), percent("all"))))
    lines = (lines.when(F.col("report") == "nulls",
                        F.array(line("nulls", item, F.lit("pct_null"), percent("rows"))))
             .when(F.col("report") == "outliers", F.array(line("outliers", nothing, item, n)))
             .when(item == "incoherents", F.array(
                 line("coherence", nothing, item, n),
                 line("coherence", nothing, F.lit("pct_incoherents"), percent("balanced"))))
             .when(F.col("report") == "coherence", F.array(line("coherence", nothing, item, n))))
    return placed.select(F.inline(lines))
