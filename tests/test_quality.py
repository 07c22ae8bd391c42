"""Data checks: failures found in seeded bad rows, none in the built tables."""


from ledgerlens.operators.quality import TableChecks, check_table, declared_checks
from ledgerlens.queries import QUERIES
from tests.conftest import SF_ORACLE


def test_seeded_failures(spark):
    df = spark.createDataFrame(
        [("a", "C", 1), ("a", "X", None), ("b", None, 3), (None, "S", 4), (None, "K", 5)],
        "k string, t string, v int")
    checks = TableChecks(unique=["k"], not_null=["k", "v"], accepted={"t": ["C", "S", "K", "N"]})
    got = {(r.column_name, r.check_name): r.failures for r in check_table("t", df, checks).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 2, ("v", "not_null"): 1,
                   ("t", "accepted_values"): 1}


def test_built_tables_pass(spark):
    rows = QUERIES["quality_report"](spark, SF_ORACLE).collect()
    assert len(rows) == 24
    assert all(r.failures == 0 for r in rows), [r for r in rows if r.failures]


def test_declared_years_follow_bounds():
    checks = declared_checks(2010, 2025)
    assert checks["stg_bilans"].accepted["annee_fiscale"] == list(range(2010, 2026))
    assert checks["mart_evolution"].accepted["flag_degradation"] == ["ALERTE", "VIGILANCE", "STABLE"]


def test_fixture_counts_from_the_survey(spark):
    """Counts FIXTURES.md reports for sf0.01: degradation flags and panels."""
    from pyspark.sql import functions as F
    evo = QUERIES["evolution"](spark, SF_ORACLE)
    flags = {r.flag_degradation: r["count"] for r in evo.groupBy("flag_degradation").count().collect()}
    assert flags == {"ALERTE": 81, "VIGILANCE": 3820, "STABLE": 1155, None: 2378}
    assert evo.count() == 7434  # staged rows
    bench = QUERIES["sector_benchmark"](spark, SF_ORACLE)
    assert bench.count() == 35  # panels of 50 companies or more
    assert bench.agg(F.max("nb_entreprises")).first()[0] == 197  # largest panel


def test_keys_are_counted_inside_the_buckets(spark):
    """The uniqueness checks of the stored, bucketed tables need no exchange but
    that of the one-row result; the counts equal those of the plain check."""
    import ledgerlens.queries as q
    models, checks = q._models(spark, SF_ORACLE), declared_checks(q.MIN_YEAR, q.MAX_YEAR)
    for name in ("stg_bilans", "stg_entreprises", "mart_indicateurs", "mart_evolution"):
        df = getattr(models, name)
        inside = check_table(name, df, checks[name], within={"bilan_key": "siren"})
        plan = inside._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan, name
        assert inside.collect() == check_table(name, df, checks[name]).collect()


def test_repeated_keys_inside_clusters(spark):
    import pytest
    checks = TableChecks(unique=["k"], not_null=["k"])
    rows = [("1", "1_a"), ("1", "1_a"), ("1", "1_b"), ("2", "2_a"), ("2", None), (None, None)]
    df = spark.createDataFrame(rows, "c string, k string")
    got = [r.failures for r in check_table("t", df, checks, {"k": "c"}).collect()]
    assert got == [1, 2]
    astray = df.unionByName(spark.createDataFrame([("3", "2_a")], df.schema))
    with pytest.raises(Exception, match="does not start with"):
        check_table("t", astray, checks, {"k": "c"}).collect()
    assert [r.failures for r in check_table("t", astray, checks).collect()] == [2, 2]


def test_seeded_tables_fail_every_check(spark):
    rows = QUERIES["quality_failures"](spark, SF_ORACLE).collect()
    assert len(rows) == 24
    assert sum(r.failures > 0 for r in rows if r.table_name != "mart_benchmark_sectoriel") == 21
    assert any(r.failures > 0 for r in rows if r.table_name == "mart_benchmark_sectoriel")
