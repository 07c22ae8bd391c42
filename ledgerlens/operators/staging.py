"""Staging: cleaned, typed, deduplicated filings and companies.

``stage_statements``: one filing per (company, year).
    Rows need a company id, a year inside ``[min_year, max_year]`` and public
    confidentiality. Twenty amounts are cast to BIGINT with nulls as 0,
    headcount nulls become 0, the negative-equity flag is computed from the
    source column and the key is ``siren_year``. Among filings of one
    company-year the complete one (C) wins, then the consolidated one (K),
    then any other; remaining ties go to the latest closing date and then to
    the values of the output columns, so the output is deterministic.

``stage_companies``: one record per company.
    Records need an id and a code of at least four characters after
    trimming. The record with the smallest *raw* code wins (ties by name and
    category). The code is trimmed and upper-cased, the division is its first
    two characters, and the macro sector is read from the raw prefix.

``stage_by_company`` gives the rows of ``stage_statements``, clustered by company:
a mergeable minimum per year below one exchange on ``siren``, which the windows of
the evolution then share.

Both dedups are ``row_number() == 1`` windows: Spark plans them with a
partial ``WindowGroupLimit`` before the shuffle, so a heavily duplicated key
sends at most one row per map task across the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sectors import sector_label

# The amounts carried to staging, in output order.
AMOUNT_COLUMNS = [
    # income statement
    "chiffre_affaires", "resultat_net", "valeur_ajoutee", "ebe",
    "charges_personnel", "dotations_amortissements",
    # assets
    "total_actif", "immob_corpo_net", "stocks_net", "creances_clients_net",
    "disponibilites_net",
    # liabilities
    "capitaux_propres", "capital_social", "reserves", "resultat_exercice",
    "dettes_total", "dettes_financieres", "dettes_fournisseurs", "dettes_fiscales",
    "actif_circulant_net",
]
# Remaining ties are broken on the columns that reach the output (raw values,
# nulls last): rows equal in all of them give the same staged row, so the
# output is deterministic, and source columns the output does not carry are
# neither scanned nor shuffled for the dedup.
TIE_BREAK_COLUMNS = sorted(AMOUNT_COLUMNS + ["effectif_moyen"]) + ["type_bilan"]

# Filing-type preference of the dedup (others rank last).
FILING_PREFERENCE = {"C": 1, "K": 2}
OTHER_FILING_RANK = 3
PUBLIC = "Public"

# Default year bounds of the published models.
DEFAULT_MIN_YEAR, DEFAULT_MAX_YEAR = 2010, 2025


def _amount(c: str, dtype) -> Column:
    """Integral amount as BIGINT; a fractional source is rounded half to even
    first, since a plain cast would truncate."""
    src = F.col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        src = F.bround(src, 0)
    return F.coalesce(src, F.lit(0)).cast("bigint")


def filing_rank(type_col: Column) -> Column:
    expr = None
    for code, rank in FILING_PREFERENCE.items():
        expr = (F.when(type_col == F.lit(code), F.lit(rank)) if expr is None
                else expr.when(type_col == F.lit(code), F.lit(rank)))
    return expr.otherwise(F.lit(OTHER_FILING_RANK))


def stage_statements(raw: DataFrame, min_year: int = DEFAULT_MIN_YEAR,
                     max_year: int = DEFAULT_MAX_YEAR) -> DataFrame:
    filtered = _usable(raw, min_year, max_year)
    order = ([filing_rank(F.col("type_bilan")), F.col("date_cloture_exercice").desc_nulls_last()]
             + [F.col(c).asc_nulls_last() for c in TIE_BREAK_COLUMNS])
    w = Window.partitionBy("siren", "annee").orderBy(*order)
    deduped = (filtered.withColumn("_rn", F.row_number().over(w))
               .where(F.col("_rn") == 1))

    return _staged(deduped, raw)


def stage_by_company(raw: DataFrame, min_year: int = DEFAULT_MIN_YEAR,
                     max_year: int = DEFAULT_MAX_YEAR) -> DataFrame:
    """The rows of ``stage_statements``, hash-clustered by ``siren``.

    A filing is a struct that compares as the dedup prefers (nulls last: a
    struct compares them first, so each value stands behind its null test), and
    the preferred filing of a year is its least struct. Minima are merged: map
    tasks send one row per company, however many copies it has, and the
    exchange on ``siren`` is the only one. A row holds at most one filing per
    year of the bounds.
    """
    def last_if_null(c: str, key=None):
        return [F.col(c).isNull().alias(f"no_{c}"), (F.col(c) if key is None else key).alias(c)]

    day = -F.datediff("date_cloture_exercice", F.lit("1970-01-01").cast("date"))  # latest first
    filing = F.struct(filing_rank(F.col("type_bilan")).alias("rank"),
                      *last_if_null("date_cloture_exercice", day),
                      *[x for c in TIE_BREAK_COLUMNS for x in last_if_null(c)])
    usable = _usable(raw, min_year, max_year).select("siren", "annee", filing.alias("filing"))
    years = range(min_year, max_year + 1)
    best = usable.groupBy("siren").agg(*[
        F.min(F.when(F.col("annee") == F.lit(y), F.col("filing"))).alias(f"y{y}") for y in years])
    by_year = F.array(*[F.struct(F.lit(y).alias("annee"), F.col(f"y{y}").alias("filing")) for y in years])
    rows = (best.select("siren", F.explode(F.filter(by_year, lambda x: x["filing"].isNotNull())).alias("x"))
            .select("siren", F.col("x.annee").alias("annee"), "x.filing.*")
            .withColumn("date_cloture_exercice", F.date_add(
                F.lit("1970-01-01").cast("date"), -F.col("date_cloture_exercice"))))
    return _staged(rows, raw)


def usable_filings(raw: DataFrame, min_year: int = DEFAULT_MIN_YEAR,
                   max_year: int = DEFAULT_MAX_YEAR) -> DataFrame:
    """The rows and columns of ``raw`` that staging reads."""
    return _usable(raw, min_year, max_year).select(
        "siren", "annee", "date_cloture_exercice", *TIE_BREAK_COLUMNS)


def _usable(raw: DataFrame, min_year: int, max_year: int) -> DataFrame:
    return raw.where(
        F.col("siren").isNotNull()
        & F.col("annee").between(F.lit(min_year), F.lit(max_year))
        & (F.col("confidentiality") == F.lit(PUBLIC)))


def _staged(deduped: DataFrame, raw: DataFrame) -> DataFrame:
    dtypes = {f.name: f.dataType for f in raw.schema.fields}
    return deduped.select(
        "siren",
        F.col("date_cloture_exercice").alias("date_cloture"),
        F.col("annee").cast("int").alias("annee_fiscale"),
        "type_bilan",
        *[_amount(c, dtypes.get(c)).alias(c) for c in AMOUNT_COLUMNS],
        F.coalesce(F.col("effectif_moyen"), F.lit(0)).alias("effectif_moyen"),
        (F.coalesce(F.col("capitaux_propres"), F.lit(0)) < F.lit(0)).alias("capitaux_propres_negatifs"),
        F.concat(F.col("siren"), F.lit("_"), F.col("annee").cast("string")).alias("bilan_key"),
    )


def stage_companies(companies: DataFrame) -> DataFrame:
    """``companies`` has the register columns after renaming
    (``siren, code_naf, denomination, categorie``)."""
    raw_code = F.col("code_naf")
    kept = companies.where(F.col("siren").isNotNull() & raw_code.isNotNull()
                           & (F.length(F.trim(raw_code)) >= F.lit(4)))
    w = Window.partitionBy("siren").orderBy(
        raw_code.asc_nulls_last(), F.col("denomination").asc_nulls_last(),
        F.col("categorie").asc_nulls_last())
    first = kept.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    clean = F.upper(F.trim(raw_code))
    return first.select(
        "siren",
        clean.alias("code_naf"),
        F.substring(clean, 1, 2).alias("naf_division"),
        sector_label(F.substring(raw_code, 1, 2)).alias("secteur_macro"),
        F.coalesce(F.col("denomination"), F.lit("")).alias("denomination"),
        F.coalesce(F.col("categorie"), F.lit("")).alias("categorie"),
    )
