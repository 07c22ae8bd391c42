"""The model chain: raw accounts and register -> staging -> marts.

Each model is a function of its upstream DataFrames (``ref`` between models
is a function argument). ``build_models`` wires them lazily; nothing runs
until a result is written or read. ``stored_models`` and ``materialize_models``
write models as they go (their purpose). ``materialize_models`` stores every model
as a table, with the company-keyed tables bucketed and sorted by ``siren``
so that the evolution window and the benchmark join read co-located data
without a shuffle, and the marts partitioned by fiscal year for year
filters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.benchmark import sector_benchmark
from ..operators.evolution import compute_evolution
from ..operators.indicators import compute_indicators
from ..operators.staging import DEFAULT_MAX_YEAR, DEFAULT_MIN_YEAR, stage_companies, stage_statements
from ..session import materialize
from ..sources.parquet import company_register, save_table


#: Companies to expect in a row group (128 MB, a few hundred thousand rows).
SIRENS_A_ROW_GROUP = 100_000


@dataclass
class Models:
    stg_bilans: DataFrame
    stg_entreprises: DataFrame
    mart_indicateurs: DataFrame
    mart_evolution: DataFrame
    mart_benchmark_sectoriel: DataFrame


def build_models(raw_accounts: DataFrame, register: DataFrame, *,
                 min_year: int = DEFAULT_MIN_YEAR, max_year: int = DEFAULT_MAX_YEAR,
                 min_panel: int = 50, register_is_renamed: bool = False) -> Models:
    companies = register if register_is_renamed else company_register(register)
    stg = stage_statements(raw_accounts, min_year, max_year)
    ent = stage_companies(companies)
    ind = compute_indicators(stg)
    return Models(
        stg_bilans=stg,
        stg_entreprises=ent,
        mart_indicateurs=ind,
        mart_evolution=compute_evolution(ind),
        mart_benchmark_sectoriel=sector_benchmark(ind, ent, min_panel=min_panel),
    )


def materialize_models(raw_accounts: DataFrame, register: DataFrame, *, buckets: int,
                       prefix: str = "", location: str | None = None,
                       name_of: Callable[[str], str] | None = None,
                       year_buckets: int = 16, min_year: int = DEFAULT_MIN_YEAR,
                       max_year: int = DEFAULT_MAX_YEAR, min_panel: int = 50,
                       register_is_renamed: bool = False,
                       writer_options: dict[str, str] | None = None) -> Models:
    """Store each model as a table (``CREATE OR REPLACE``) in dependency order.

    Downstream models are rebuilt from the stored upstream tables, so each
    stage reads its input once and co-located buckets replace shuffles.
    ``buckets`` should make a bucket a few hundred MB at the target scale, and
    ``year_buckets`` likewise a bucket of one year of the evolution mart.
    Tables are files under ``location``, or in the warehouse without it, and
    are named by ``prefix``, or by ``name_of`` if given. Row groups of the tables
    by company are sorted by ``siren`` and carry a Bloom filter on it, so a lookup
    of listed companies reads the row groups that hold them.
    """
    def save(df, name, **layout):
        table = name_of(name) if name_of else f"{prefix}{name}"
        path = f"{location.rstrip('/')}/{table}" if location else None
        if "bucket_by" in layout:
            layout |= dict(bloom={"siren": SIRENS_A_ROW_GROUP}, options=writer_options)
        return save_table(df, table, path=path, **layout)

    companies = register if register_is_renamed else company_register(register)
    by_company_year = dict(bucket_by=["siren"], buckets=buckets, sort_by=["siren", "annee_fiscale"])

    stg = save(stage_statements(raw_accounts, min_year, max_year), "stg_bilans", **by_company_year)
    ent = save(stage_companies(companies), "stg_entreprises",
               bucket_by=["siren"], buckets=buckets, sort_by=["siren"])
    ind = save(compute_indicators(stg), "mart_indicateurs", **by_company_year)
    evo = save(compute_evolution(ind), "mart_evolution", partition_by=["annee_fiscale"],
               bucket_by=["siren"], buckets=year_buckets, sort_by=["siren"])
    # co-located tables join without a shuffle; counts and quartiles read the stored columns
    bench = save(sector_benchmark(ind, ent, min_panel=min_panel, store=materialize),
                 "mart_benchmark_sectoriel")
    return Models(stg, ent, ind, evo, bench)


def stored_models(raw_accounts: DataFrame, register: DataFrame, *,
                  min_year: int = DEFAULT_MIN_YEAR, max_year: int = DEFAULT_MAX_YEAR,
                  min_panel: int = 50, register_is_renamed: bool = False) -> Models:
    """Build the models into the shared checkpoint folder (no catalog
    needed), each downstream model reading its stored inputs. Used to run the
    data checks on built tables, as a model run followed by its tests.

    The models behind a shuffle (staging dedups, the evolution windows) are
    stored; the indicators are a row-wise projection of the stored staging
    table, and the benchmark (one row per panel, its join input stored) is left
    lazy."""
    companies = register if register_is_renamed else company_register(register)
    stg = materialize(stage_statements(raw_accounts, min_year, max_year), "model-stg_bilans")
    ent = materialize(stage_companies(companies), "model-stg_entreprises")
    ind = compute_indicators(stg)
    evo = materialize(compute_evolution(ind), "model-mart_evolution")
    bench = sector_benchmark(ind, ent, min_panel=min_panel, store=materialize)
    return Models(stg, ent, ind, evo, bench)
