"""Skewed inputs derived from the test tables: a group of copies holding most
rows, and one benchmark panel per year holding every company."""

import duckdb
from pyspark.sql import functions as F

from ledgerlens.operators.benchmark import sector_benchmark
from ledgerlens.operators.indicators import compute_indicators
from ledgerlens.operators.staging import stage_by_company, stage_companies, stage_statements
from ledgerlens.oracle import _benchmark_select
from ledgerlens.sources.fixtures import fixture_accounts, fixture_register
from ledgerlens.sources.parquet import company_register
from tests.conftest import SF_SMALL


def test_hot_copies_dedup_to_same_rows(spark):
    raw = fixture_accounts(spark, SF_SMALL)
    n = raw.count()
    one = raw.where(F.col("type_bilan") == "C").orderBy("siren", "annee").limit(1)
    # 3000 identical copies of one filing: about 70 % of all rows
    copies = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("_c")).drop("_c")
    skewed = raw.unionByName(copies).repartition(16)
    assert skewed.count() == n + 3000

    plan = stage_statements(skewed, 1995, 2001)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan  # copies are cut before the exchange

    a = stage_statements(raw, 1995, 2001)
    b = stage_statements(skewed, 1995, 2001)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # clustered by company: minima are merged below the exchange
    c = stage_by_company(skewed, 1995, 2001)
    assert c.exceptAll(a).count() == 0 and a.exceptAll(c).count() == 0
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min(") >= 7 and "hashpartitioning(siren" in plan


def test_both_stagings_agree_on_ties(spark):
    """Amended filings: equal in type and date, of other types, with fractions."""
    from ledgerlens.sources.fixtures import amended_accounts
    raw = amended_accounts(fixture_accounts(spark, SF_SMALL))
    odd = raw.where("total_actif % 2 = 0").withColumn("date_cloture_exercice", F.lit(None).cast("date"))
    raw = raw.unionByName(odd)
    a, b = stage_statements(raw, 1995, 2001), stage_by_company(raw, 1995, 2001)
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert stage_by_company(raw.limit(0), 1995, 2001).count() == 0


def test_single_hot_panel_matches_duckdb(spark):
    """All companies share one activity code: each year is one panel holding
    every filing of that year; quartiles still equal DuckDB's."""
    reg = company_register(fixture_register(spark, "/root/testdata/sf0.01")).withColumn(
        "code_naf", F.lit("62.01Z"))
    ind = compute_indicators(stage_statements(fixture_accounts(spark, "/root/testdata/sf0.01"),
                                              1995, 2001))
    ent = stage_companies(reg)
    got = sector_benchmark(ind, ent, min_panel=50).toPandas()
    assert len(got) == 7  # one panel per year

    mart_indicateurs = ind.toPandas()  # noqa: F841 (read by DuckDB below)
    stg_entreprises = ent.toPandas()  # noqa: F841
    sql = "WITH " + _benchmark_select(50).lstrip() + " SELECT * FROM mart_benchmark_sectoriel"
    want = duckdb.sql(sql).df()
    cols = sorted(got.columns)
    g = got[cols].sort_values("annee_fiscale").reset_index(drop=True)
    w = want[cols].sort_values("annee_fiscale").reset_index(drop=True)
    for c in cols:
        assert list(g[c]) == list(w[c]), c
