"""Models that are kept up to date year by year.

``update_models`` stores the model chain in tables partitioned by fiscal year (and
bucketed by ``siren`` inside a year) and, on later calls, rebuilds what changed:

* A digest per year tells which years have other usable filings than at the last
  update. Staging and indicators of these years are rebuilt; a scan of the other
  years' filings is spent on the digest only.
* Of the evolution, a changed row touches the company's own year, its next available
  year (whose previous values it gives) and the one after (whose flag looks at the
  previous fall). Rows that changed are found by comparing the new indicators with
  the columns the evolution carries, so a late filing that loses the dedup touches
  nothing. The histories of these companies are computed again, and the years
  that hold a touched row are written; all other years keep their files.
* The benchmark is rebuilt for the years whose indicators changed, and for all years
  when the register has.

An update begins by taking the record off the tables and ends by writing it, with
the digests and parameters. Without a record (first build, an update that did not
end, other parameters, ``full``) all is built anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.benchmark import sector_benchmark
from ..operators.evolution import OUTPUT_COLUMNS, compute_evolution
from ..operators.indicators import compute_indicators
from ..operators.staging import (DEFAULT_MAX_YEAR, DEFAULT_MIN_YEAR, stage_companies,
                                 stage_statements, usable_filings)
from ..session import materialize
from ..sources.parquet import company_register, save_table
from .models import SIRENS_A_ROW_GROUP, Models

#: Table property (of the staged statements) with the record of the last update.
UPDATE_RECORD = "ledgerlens.update"
#: Columns of the evolution that are taken from the indicators as they are; all its
#: other columns follow from these.
CARRIED = ["siren", "annee_fiscale", "date_cloture", "type_bilan", "chiffre_affaires",
           "marge_nette_pct", "marge_ebitda_pct", "ebitda", "bfr_jours", "ratio_endettement",
           "ratio_liquidite", "flag_endettement", "flag_liquidite",
           "capitaux_propres_negatifs", "effectif_moyen"]
#: Available years after a changed one that depend on it.
REACH = 2


def _row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; the hash skips nulls, so the null tests are hashed too."""
    return F.xxhash64(*[F.col(c).isNull() for c in df.columns], *df.columns)


def content_digest() -> list[Column]:
    """Aggregates that tell multisets of rows (column ``_h``) apart, up to
    collisions of 64-bit hashes: their number and the exact sum of their hashes."""
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("sum")]


def year_digests(raw: DataFrame, min_year: int, max_year: int) -> dict[int, str]:
    """Digest of the usable filings of each year that has any (one row a year)."""
    usable = usable_filings(raw, min_year, max_year)
    rows = (usable.select(F.col("annee").cast("int").alias("year"), _row_hash(usable).alias("_h"))
            .groupBy("year").agg(*content_digest()).collect())  # at most one row per year of the bounds
    return {r["year"]: f"{r['n']}:{r['sum']}" for r in rows}


def touched_rows(ind: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of the evolution to compute again or to delete: (siren, annee_fiscale)
    of the ``changed`` ones and of each company's next ``REACH`` available years.
    ``ind`` holds the present indicators of these companies at least."""
    marks = (ind.select("siren", "annee_fiscale", F.lit(1).alias("there"), F.lit(0).alias("changed"))
             .unionByName(changed.select("siren", "annee_fiscale", F.lit(0).alias("there"),
                                         F.lit(1).alias("changed")))
             .groupBy("siren", "annee_fiscale").agg(F.max("there").alias("there"),
                                                    F.max("changed").alias("changed")))
    upto = Window.partitionBy("siren").orderBy("annee_fiscale").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    counted = marks.withColumn("n", F.sum("there").over(upto))
    # the number of available years at the latest changed year up to here
    at_change = F.max(F.when(F.col("changed") == 1, F.col("n"))).over(upto)
    return (counted.withColumn("at_change", at_change)
            .where(F.col("n") - F.col("at_change") <= REACH).select("siren", "annee_fiscale"))


def changed_rows(ind: DataFrame, evo: DataFrame, years: list[int]) -> DataFrame:
    """(siren, annee_fiscale) in ``years`` whose carried columns differ between the
    indicators and the evolution, rows of one side only included."""
    keys = ["siren", "annee_fiscale"]
    values = F.struct(*[c for c in CARRIED if c not in keys])
    sides = [df.where(F.col("annee_fiscale").isin(years)).select(*keys, values.alias(name))
             for df, name in ((ind, "now"), (evo, "before"))]
    return sides[0].join(sides[1], keys, "full").where(~F.col("now").eqNullSafe(F.col("before"))).select(*keys)


def _record(spark: SparkSession, table: str) -> dict | None:
    shown = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == UPDATE_RECORD).collect()
    return json.loads(shown[0]["value"]) if shown else None


def _replace_years(df: DataFrame, table: str, years: list[int], present: list[int],
                   buckets: int | None) -> None:
    """Let the rows of ``df`` be those of ``years`` in ``table``; those of the years that
    are not ``present`` go. Other years' files are not touched."""
    spark = df.sparkSession
    if set(years) & set(present):
        rows = df.repartition(buckets, "siren") if buckets else df.repartition("annee_fiscale")
        # the files are written aside and moved when all are there
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(mode, before)
    for year in set(years) - set(present):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (annee_fiscale = {year}) PURGE")
    spark.catalog.refreshTable(table)


def update_models(raw_accounts: DataFrame, register: DataFrame, *, year_buckets: int,
                  prefix: str = "", location: str | None = None,
                  name_of: Callable[[str], str] | None = None, min_year: int = DEFAULT_MIN_YEAR, max_year: int = DEFAULT_MAX_YEAR,
                  min_panel: int = 50, register_is_renamed: bool = False,
                  full: bool = False) -> tuple[Models, dict[str, list[int]]]:
    """Bring the stored models up to the state of their inputs. Returns them, and
    the years written for each model (also those emptied).

    ``year_buckets`` should make a bucket of one year a few hundred MB. The models
    equal those of a full rebuild. Tables are files under ``location``, or in the
    warehouse without it, named by ``prefix``, or by ``name_of`` if given.
    """
    spark = raw_accounts.sparkSession
    companies = register if register_is_renamed else company_register(register)
    names = {f.name: name_of(f.name) if name_of else f"{prefix}{f.name}" for f in fields(Models)}
    state = {"parameters": [min_year, max_year, min_panel, year_buckets],
             "register": "{n}:{sum}".format(**companies.select(_row_hash(companies).alias("_h"))
                                            .agg(*content_digest()).first().asDict()),
             "years": {str(y): d for y, d in year_digests(raw_accounts, min_year, max_year).items()}}
    present = sorted(map(int, state["years"]))
    whole = not full and all(spark.catalog.tableExists(t) for t in names.values())
    known = _record(spark, names["stg_bilans"]) if whole else None
    if known and known["parameters"] != state["parameters"]:
        known = None
    written = {m: [] for m in names}

    def save(df, model, **layout):
        path = f"{location.rstrip('/')}/{names[model]}" if location else None
        return save_table(df, names[model], path=path, **layout)

    by_year = dict(partition_by=["annee_fiscale"], bucket_by=["siren"], buckets=year_buckets,
                   sort_by=["siren"], bloom={"siren": SIRENS_A_ROW_GROUP})
    stg, ent, ind, evo, bench = (names[m] for m in names)
    if known is None:
        if spark.catalog.tableExists(stg):  # from here on the tables are not known to be whole
            spark.sql(f"ALTER TABLE {stg} UNSET TBLPROPERTIES IF EXISTS ('{UPDATE_RECORD}')")
        save(stage_statements(raw_accounts, min_year, max_year), "stg_bilans", **by_year)
        save(stage_companies(companies), "stg_entreprises", bucket_by=["siren"],
             buckets=year_buckets, sort_by=["siren"])
        save(compute_indicators(spark.table(stg)), "mart_indicateurs", **by_year)
        save(compute_evolution(spark.table(ind)), "mart_evolution", **by_year)
        save(sector_benchmark(spark.table(ind), spark.table(ent), min_panel=min_panel, store=materialize),
             "mart_benchmark_sectoriel", partition_by=["annee_fiscale"])
        written = {m: present for m in written}
    else:
        years = sorted(int(y) for y in state["years"].keys() | known["years"].keys()
                       if state["years"].get(y) != known["years"].get(y))
        new_register = state["register"] != known["register"]
        if years or new_register:
            spark.sql(f"ALTER TABLE {stg} UNSET TBLPROPERTIES IF EXISTS ('{UPDATE_RECORD}')")
        if years:
            filings = raw_accounts.where(F.col("annee").isin(years))
            _replace_years(stage_statements(filings, min_year, max_year), stg, years, present, year_buckets)
            of_years = spark.table(stg).where(F.col("annee_fiscale").isin(years))
            _replace_years(compute_indicators(of_years), ind, years, present, year_buckets)
            written["stg_bilans"] = written["mart_indicateurs"] = years
            written["mart_evolution"] = _update_evolution(spark, ind, evo, years, present, year_buckets)
        if new_register:
            save(stage_companies(companies), "stg_entreprises", bucket_by=["siren"],
                 buckets=year_buckets, sort_by=["siren"])
        panels = sorted(set(present) | set(map(int, known["years"]))) if new_register else years
        if panels:
            rows = spark.table(ind).where(F.col("annee_fiscale").isin(panels))
            # a row a panel; a year may have no panel of this size left
            new = materialize(sector_benchmark(rows, spark.table(ent), min_panel=min_panel,
                                               store=materialize), "benchmark-years")
            having = [r[0] for r in new.select("annee_fiscale").distinct().collect()]
            _replace_years(new, bench, panels, having, None)
            written["mart_benchmark_sectoriel"] = panels
    spark.sql(f"ALTER TABLE {stg} SET TBLPROPERTIES ('{UPDATE_RECORD}' = '{json.dumps(state)}')")
    return Models(*[spark.table(names[m]) for m in names]), written


def _update_evolution(spark: SparkSession, ind: str, evo: str, years: list[int],
                      present: list[int], buckets: int) -> list[int]:
    """Bring the evolution up to the indicators, which changed in ``years``; the
    years written."""
    now, before = spark.table(ind), spark.table(evo)
    changed = materialize(changed_rows(now, before, years), "changed-rows")
    # whole histories of the companies with a change
    history = now.join(changed.select("siren").distinct(), "siren", "left_semi")
    touched = materialize(touched_rows(history, changed), "touched-rows")
    stale = sorted(r[0] for r in touched.select("annee_fiscale").distinct().collect())  # of the bounds
    if stale:
        keys = ["siren", "annee_fiscale"]
        new = compute_evolution(history).join(touched, keys, "left_semi").select(*OUTPUT_COLUMNS)
        kept = (before.where(F.col("annee_fiscale").isin(stale))
                .join(touched, keys, "left_anti").select(*OUTPUT_COLUMNS))
        _replace_years(new.unionByName(kept), evo, stale, present, buckets)
    return stale
