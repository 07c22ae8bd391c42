"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query derives the accounts file and the company register from the
driver tables (``sources.fixtures``) and runs the engine's operators over
all of them. Year bounds are parameters; the test tables span 1995-2001.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import profile, views
from .operators.benchmark import sector_benchmark
from .operators.evolution import compute_evolution
from .operators.indicators import compute_indicators
from .operators.quality import declared_checks, quality_report
from .operators.staging import stage_by_company, stage_companies, stage_statements
from .plans.models import Models, materialize_models
from .plans.runs import shared_run
from .plans.updates import update_models
from .session import materialize, scratch_path, scratch_table
from .sources.fixtures import (amended_accounts, damaged, fixture_accounts,
                               fixture_register, read_table)
from .sources.parquet import company_register, load_raw_accounts, read_accounts

MIN_YEAR, MAX_YEAR = 1995, 2001
# reference defaults (2023, 500000, panels of 200) select nothing there.
PROFILE_YEAR = 1998
ALERT_YEAR, ALERT_MIN_CA, ALERT_LIMIT = 2000, 100000, 10
RANKING_YEAR, RANKING_MIN_COMPANIES = 2000, 100
LOOKUP_SIREN, LOOKUP_YEAR = "000000005", 1998
LOOKUP_BUCKETS = 16
YEAR_BUCKETS = 4
#: Orders a bucket of the stored models, above the smallest numbers of buckets.
ORDERS_A_BUCKET = 750_000

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark, sf_dir):
    return fixture_accounts(spark, sf_dir)


def _companies(spark, sf_dir):
    return company_register(fixture_register(spark, sf_dir))


def _stg(spark, sf_dir):
    return stage_statements(_raw(spark, sf_dir), MIN_YEAR, MAX_YEAR)


def _ent(spark, sf_dir):
    return stage_companies(_companies(spark, sf_dir))


def _ind(spark, sf_dir):
    return compute_indicators(_stg(spark, sf_dir))


def _evo(spark, sf_dir):
    """Staged clustered by company: the dedup and both lag windows share one exchange."""
    stg = stage_by_company(_raw(spark, sf_dir), MIN_YEAR, MAX_YEAR)
    return compute_evolution(compute_indicators(stg))


def q_stg_statements(spark, sf_dir):
    return _stg(spark, sf_dir)


def q_stg_companies(spark, sf_dir):
    return _ent(spark, sf_dir)


def q_indicators(spark, sf_dir):
    return _ind(spark, sf_dir)


def q_evolution(spark, sf_dir):
    return _evo(spark, sf_dir)


def _bench(spark, sf_dir, **panel):
    """The benchmark over a base that is stored first (the named store step)."""
    return sector_benchmark(_ind(spark, sf_dir), _ent(spark, sf_dir), min_panel=50,
                            store=materialize, **panel)


def q_sector_benchmark(spark, sf_dir):
    return _bench(spark, sf_dir)


def q_benchmark_report(spark, sf_dir):
    """The benchmark sorted for presentation (newest year, largest panel)."""
    return views.benchmark_report(_bench(spark, sf_dir))


def q_raw_companies(spark, sf_dir):
    """Register ingest: projection, renaming and row predicates."""
    return _companies(spark, sf_dir)


def q_profile_volume(spark, sf_dir):
    return profile.volume(_raw(spark, sf_dir))


def q_profile_years(spark, sf_dir):
    return profile.rows_per_year(_raw(spark, sf_dir))


def q_profile_top_codes(spark, sf_dir):
    """Top-10 activity codes of the register (first present code column)."""
    return profile.top_codes(_companies(spark, sf_dir), n=10)


def q_ingest_top_codes(spark, sf_dir):
    """Top-5 activity codes reported after the register ingest."""
    return profile.top_codes(_companies(spark, sf_dir), n=5)


def q_profile_nulls(spark, sf_dir):
    return profile.null_rates(_raw(spark, sf_dir))


def q_profile_nulls_wide(spark, sf_dir):
    return profile.null_rates_wide(_raw(spark, sf_dir))


def q_profile_types(spark, sf_dir):
    return profile.filing_types(_raw(spark, sf_dir))


def q_profile_segments(spark, sf_dir):
    return profile.revenue_segments(_raw(spark, sf_dir), PROFILE_YEAR)


def q_profile_outliers(spark, sf_dir):
    return profile.outliers(_raw(spark, sf_dir))


def q_profile_duplicates(spark, sf_dir):
    return profile.duplicate_pairs(_raw(spark, sf_dir))


def q_profile_coherence(spark, sf_dir):
    return profile.balance_coherence(_raw(spark, sf_dir))


def q_company_statements(spark, sf_dir):
    return views.company_statements(_stg(spark, sf_dir))


def q_company_indicators(spark, sf_dir):
    return views.company_indicators(_ind(spark, sf_dir))


def q_company_indicators_year(spark, sf_dir):
    return views.company_indicators(_ind(spark, sf_dir), year=PROFILE_YEAR)


def _stored_accounts(spark, sf_dir):
    """Path of the accounts file: the fixture's rows, written as Parquet."""
    return materialize(_raw(spark, sf_dir), "accounts-file").inputFiles()[0].rsplit("/", 1)[0]


def _buckets(spark, sf_dir, least: int) -> int:
    """Buckets that grow with the input (its rows are counted from the files' footers):
    a bucket is what one task sorts, holds and writes."""
    return max(least, -(-read_table(spark, sf_dir, "orders").count() // ORDERS_A_BUCKET))


def _models(spark, sf_dir) -> Models:
    """All models as stored tables, each built from the stored ones before it:
    one run a session, shared by the queries that read it."""
    parameters = dict(min_year=MIN_YEAR, max_year=MAX_YEAR, min_panel=50)

    def build(name_of, location):
        buckets, year_buckets = (_buckets(spark, sf_dir, n) for n in (LOOKUP_BUCKETS, YEAR_BUCKETS))
        return materialize_models(_raw(spark, sf_dir), fixture_register(spark, sf_dir), name_of=name_of,
                                  location=location, buckets=buckets, year_buckets=year_buckets, **parameters)

    inputs = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("orders", "customer")]
    return shared_run(spark, inputs, parameters, build)


def q_company_lookup(spark, sf_dir):
    """Point lookup of one company and year in the stored, bucketed table of
    indicators: both filters reach the scan, which reads one bucket."""
    return views.company_indicators(_models(spark, sf_dir).mart_indicateurs,
                                    siren=LOOKUP_SIREN, year=LOOKUP_YEAR)


def q_accounts_scan(spark, sf_dir):
    """The accounts file, scanned."""
    return read_accounts(spark, _stored_accounts(spark, sf_dir))


def q_accounts_loaded(spark, sf_dir):
    """The accounts file loaded into a table once; a second load keeps it."""
    path, name = _stored_accounts(spark, sf_dir), scratch_table("raw_bilans")
    load_raw_accounts(spark, path, name, location=scratch_path(spark, "loaded"))
    return load_raw_accounts(spark, path, name)


def q_stored_models_indicators(spark, sf_dir):
    return _models(spark, sf_dir).mart_indicateurs


def q_stored_models_evolution(spark, sf_dir):
    return _models(spark, sf_dir).mart_evolution


def q_stored_models_benchmark(spark, sf_dir):
    return _models(spark, sf_dir).mart_benchmark_sectoriel


def q_schema_listing(spark, sf_dir):
    """Columns of the stored accounts file, with their types."""
    return profile.describe(read_accounts(spark, _stored_accounts(spark, sf_dir)))


def q_profile_account_codes(spark, sf_dir):
    """Top-10 activity codes of the accounts (first present code column)."""
    return profile.top_codes(_raw(spark, sf_dir), n=10)


def q_non_finite_cleaned(spark, sf_dir):
    """Not-a-numbers and infinities (put into the raw amounts) become null."""
    rn, ca = F.col("resultat_net").cast("double"), F.col("chiffre_affaires").cast("double")
    odd = _raw(spark, sf_dir).select(
        "siren", "annee", F.when(rn < 0, F.lit(float("nan"))).otherwise(rn).alias("may_be_nan"),
        F.when(ca == 0, F.lit(float("inf"))).when(ca.isNull(), F.lit(float("-inf")))
         .otherwise(ca).alias("may_be_infinite"))
    return views.clean_non_finite(odd)


def q_company_evolution(spark, sf_dir):
    return views.company_evolution(_evo(spark, sf_dir))


def q_company_summary(spark, sf_dir):
    return views.company_summary(_stg(spark, sf_dir), as_text=True)


def q_trend_summary(spark, sf_dir):
    return views.trend_summary(_evo(spark, sf_dir))


def q_company_header(spark, sf_dir):
    return views.company_header(_evo(spark, sf_dir))


def q_degradation_alerts(spark, sf_dir):
    return views.degradation_alerts(_evo(spark, sf_dir), year=ALERT_YEAR,
                                    min_ca=ALERT_MIN_CA, limit=ALERT_LIMIT)


def q_ranking_margin(spark, sf_dir):
    return views.ranking_margin(_models(spark, sf_dir).mart_benchmark_sectoriel,
                                RANKING_YEAR, RANKING_MIN_COMPANIES)


def q_ranking_bfr(spark, sf_dir):
    return views.ranking_bfr(_models(spark, sf_dir).mart_benchmark_sectoriel,
                             RANKING_YEAR, RANKING_MIN_COMPANIES)


def q_division_history(spark, sf_dir):
    return views.division_history(_models(spark, sf_dir).mart_benchmark_sectoriel, "62")


def q_status_bands(spark, sf_dir):
    return views.status_bands(_ind(spark, sf_dir))


def q_flag_severity(spark, sf_dir):
    return views.flag_severities(_evo(spark, sf_dir))


def q_evolution_rows(spark, sf_dir):
    return views.evolution_rows(_evo(spark, sf_dir))


def q_revenue_series(spark, sf_dir):
    return views.revenue_series(_ind(spark, sf_dir))


def q_quality_report(spark, sf_dir):
    """Every declared check on the stored tables of the session's model run."""
    m = _models(spark, sf_dir)
    tables = {
        "stg_bilans": m.stg_bilans, "stg_entreprises": m.stg_entreprises,
        "mart_indicateurs": m.mart_indicateurs, "mart_evolution": m.mart_evolution,
        "mart_benchmark_sectoriel": m.mart_benchmark_sectoriel,
    }
    return quality_report(tables, declared_checks(MIN_YEAR, MAX_YEAR),
                          within={"bilan_key": "siren"})


def q_quality_failures(spark, sf_dir):
    """The declared checks on tables with seeded failures: repeated keys, nulls
    and values that are not accepted."""
    m, checks = _models(spark, sf_dir), declared_checks(MIN_YEAR, MAX_YEAR)
    tables = {}
    for name, declared in checks.items():
        df = getattr(m, name)
        number = F.col("siren" if "siren" in df.columns else "nb_entreprises").cast("bigint")
        tables[name] = damaged(df, number, declared.not_null, declared.accepted)
    return quality_report(tables, checks)


def q_stg_statements_amended(spark, sf_dir):
    """Staging of accounts with fractional amounts and tied, amended filings."""
    return stage_statements(amended_accounts(_raw(spark, sf_dir)), MIN_YEAR, MAX_YEAR)


def q_indicators_amended(spark, sf_dir):
    return compute_indicators(q_stg_statements_amended(spark, sf_dir))


def q_profile_report(spark, sf_dir):
    """All profile reports but the medians, from one scan."""
    return profile.report(_raw(spark, sf_dir), PROFILE_YEAR)


def q_alerted_companies(spark, sf_dir):
    """Indicators, all years, of every company with an alert in one year: a lookup
    of many companies in the stored tables."""
    m = _models(spark, sf_dir)
    alerted = m.mart_evolution.where((F.col("annee_fiscale") == F.lit(ALERT_YEAR))
                                     & (F.col("flag_degradation") == F.lit("ALERTE")))
    return views.company_indicators(views.of_companies(m.mart_indicateurs, alerted))


def _updated_models(spark, sf_dir) -> Models:
    """Models built before the complete filings of one year came in, then brought up
    to date with them: one run a session."""
    parameters = dict(min_year=MIN_YEAR, max_year=MAX_YEAR, min_panel=50)

    def build(name_of, location):
        raw, register = _raw(spark, sf_dir), fixture_register(spark, sf_dir)
        year_buckets = _buckets(spark, sf_dir, YEAR_BUCKETS)
        late = (F.col("annee") == F.lit(PROFILE_YEAR)) & (F.col("type_bilan") == F.lit("C"))
        for accounts in (raw.where(~F.coalesce(late, F.lit(False))), raw):
            update_models(accounts, register, name_of=name_of, location=location,
                          year_buckets=year_buckets, **parameters)

    inputs = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("orders", "customer")]
    return shared_run(spark, inputs, parameters | {"updated": True}, build)


def q_updated_models_evolution(spark, sf_dir):
    return _updated_models(spark, sf_dir).mart_evolution


def q_updated_models_benchmark(spark, sf_dir):
    return _updated_models(spark, sf_dir).mart_benchmark_sectoriel


QUERIES: dict[str, Query] = {
    "stg_statements": q_stg_statements,
    "stg_companies": q_stg_companies,
    "indicators": q_indicators,
    "evolution": q_evolution,
    "sector_benchmark": q_sector_benchmark,
    "benchmark_report": q_benchmark_report,
    "raw_companies": q_raw_companies,
    "profile_volume": q_profile_volume,
    "profile_years": q_profile_years,
    "profile_top_codes": q_profile_top_codes,
    "ingest_top_codes": q_ingest_top_codes,
    "profile_nulls": q_profile_nulls,
    "profile_nulls_wide": q_profile_nulls_wide,
    "profile_types": q_profile_types,
    "profile_segments": q_profile_segments,
    "profile_outliers": q_profile_outliers,
    "profile_duplicates": q_profile_duplicates,
    "profile_coherence": q_profile_coherence,
    "company_statements": q_company_statements,
    "company_indicators": q_company_indicators,
    "company_indicators_year": q_company_indicators_year,
    "company_lookup": q_company_lookup,
    "company_evolution": q_company_evolution,
    "company_summary": q_company_summary,
    "trend_summary": q_trend_summary,
    "company_header": q_company_header,
    "degradation_alerts": q_degradation_alerts,
    "ranking_margin": q_ranking_margin,
    "ranking_bfr": q_ranking_bfr,
    "division_history": q_division_history,
    "status_bands": q_status_bands,
    "flag_severity": q_flag_severity,
    "evolution_rows": q_evolution_rows,
    "revenue_series": q_revenue_series,
    "quality_report": q_quality_report,
    "profile_account_codes": q_profile_account_codes,
    "accounts_scan": q_accounts_scan,
    "accounts_loaded": q_accounts_loaded,
    "schema_listing": q_schema_listing,
    "stored_models_indicators": q_stored_models_indicators,
    "stored_models_evolution": q_stored_models_evolution,
    "stored_models_benchmark": q_stored_models_benchmark,
    "non_finite_cleaned": q_non_finite_cleaned,
    "quality_failures": q_quality_failures,
    "stg_statements_amended": q_stg_statements_amended,
    "indicators_amended": q_indicators_amended,
    "profile_report": q_profile_report,
    "alerted_companies": q_alerted_companies,
    "updated_models_evolution": q_updated_models_evolution,
    "updated_models_benchmark": q_updated_models_benchmark,
}
