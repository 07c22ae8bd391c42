"""Sources and sinks: accounts loader, register ingest, table layout, the
materialised model chain."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.models import build_models, materialize_models
from ledgerlens.queries import QUERIES
from ledgerlens.sources.fixtures import fixture_accounts, fixture_register
from ledgerlens.sources.parquet import (company_register, load_raw_accounts, read_accounts,
                                        read_company_register, save_table)
from tests.conftest import SF_SMALL


def test_missing_accounts_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_accounts(spark, str(tmp_path / "nope.parquet"))


def test_load_once_then_force(spark, tmp_path):
    path = str(tmp_path / "accounts")
    fixture_accounts(spark, SF_SMALL).write.parquet(path)
    first = load_raw_accounts(spark, path, table="t_raw_bilans")
    n = first.count()
    assert n == 1199  # FIXTURES.md: raw rows at sf0.001
    # replace the file: without force the stored table is kept
    fixture_accounts(spark, SF_SMALL).limit(10).write.mode("overwrite").parquet(path)
    assert load_raw_accounts(spark, path, table="t_raw_bilans").count() == n
    assert load_raw_accounts(spark, path, table="t_raw_bilans", force=True).count() == 10


def test_register_ingest_filters(spark):
    reg = company_register(fixture_register(spark, SF_SMALL))
    assert reg.columns == ["siren", "code_naf", "denomination", "categorie"]
    # FIXTURES.md: 162 records, 155 non-null codes; blank codes are dropped too
    n_blank = fixture_register(spark, SF_SMALL).where(
        F.trim("activitePrincipaleUniteLegale") == "").count()
    assert reg.count() == 155 - n_blank


def test_register_read_with_declared_schema(spark, tmp_path):
    path = str(tmp_path / "register")
    fixture_register(spark, SF_SMALL).write.parquet(path)
    got = read_company_register(spark, path)
    want = company_register(fixture_register(spark, SF_SMALL))
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_bucketed_table_avoids_shuffle_on_join(spark):
    df = spark.range(1000).select(F.format_string("%09d", "id").alias("siren"), (F.col("id") % 7).alias("v"))
    a = save_table(df, "t_bucket_a", bucket_by=["siren"], buckets=4, sort_by=["siren"])
    b = save_table(df, "t_bucket_b", bucket_by=["siren"], buckets=4, sort_by=["siren"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = a.join(b, "siren")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan


def test_materialized_models_equal_lazy_models(spark):
    raw, reg = fixture_accounts(spark, SF_SMALL), fixture_register(spark, SF_SMALL)
    lazy = build_models(raw, reg, min_year=1995, max_year=2001, min_panel=5)
    stored = materialize_models(raw, reg, buckets=4, prefix="t_", min_year=1995, max_year=2001,
                                min_panel=5)
    for name in ("stg_bilans", "stg_entreprises", "mart_indicateurs", "mart_evolution",
                 "mart_benchmark_sectoriel"):
        a, b = getattr(lazy, name), getattr(stored, name)
        cols = sorted(a.columns)
        assert sorted(b.columns) == cols, name
        assert a.select(cols).exceptAll(b.select(cols)).count() == 0, name
        assert b.select(cols).exceptAll(a.select(cols)).count() == 0, name
    assert stored.mart_benchmark_sectoriel.count() > 0


def test_stored_layout_removes_shuffles_and_prunes_years(spark):
    from ledgerlens.operators.benchmark import benchmark_base
    from ledgerlens.operators.evolution import compute_evolution
    raw, reg = fixture_accounts(spark, SF_SMALL), fixture_register(spark, SF_SMALL)
    m = materialize_models(raw, reg, buckets=4, prefix="u_", min_year=1995, max_year=2001,
                           min_panel=5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle join path
    try:
        evo_plan = compute_evolution(m.mart_indicateurs)._jdf.queryExecution().executedPlan().toString()
        join_plan = benchmark_base(m.mart_indicateurs, m.stg_entreprises) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in evo_plan  # bucketed by siren: the lag windows need no shuffle
    assert "Exchange" not in join_plan  # both sides bucketed by siren: co-located join
    year_plan = m.mart_evolution.where("annee_fiscale = 1998")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee_fiscale" in year_plan and "= 1998" in year_plan
    # a company lookup on the bucketed indicators selects one bucket of four
    # (shown when the scan is planned as bucketed)
    from ledgerlens.operators.views import company_indicators
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(key, "false")
    try:
        lookup = company_indicators(m.mart_indicateurs, siren="000000005")._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.unset(key)
    assert "SelectedBucketsCount: 1 out of 4" in lookup


def test_build_job_end_to_end(spark, tmp_path):
    from ledgerlens.jobs import parse_args, run
    acc, reg = str(tmp_path / "accounts"), str(tmp_path / "register")
    fixture_accounts(spark, SF_SMALL).write.parquet(acc)
    fixture_register(spark, SF_SMALL).write.parquet(reg)
    args = parse_args(["--accounts", acc, "--register", reg, "--buckets", "4", "--prefix", "job_",
                       "--min-year", "1995", "--max-year", "2001", "--min-panel", "5"])
    assert run(spark, args) == 0
    assert spark.table("job_stg_bilans").count() == 755  # FIXTURES.md: staged rows at sf0.001
    assert spark.table("job_quality_report").count() == 24
    assert spark.table("job_mart_benchmark_sectoriel").count() > 0


def data_files(path):
    return sorted(str(f) for f in path.rglob("*.parquet"))


def test_one_file_per_bucket_and_bounded_files_per_year(spark, tmp_path):
    """However many tasks write: 8 shuffle partitions and 16 buckets give 16
    files, 7 years in two parts give at most 14."""
    df = (spark.range(5000).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("siren"),
                                   (F.lit(1995) + F.col("id") % 7).cast("int").alias("annee"))
          .repartition(8))
    save_table(df, "t_files_bucketed", path=str(tmp_path / "b"), bucket_by=["siren"], buckets=16)
    assert len(data_files(tmp_path / "b")) == 16
    save_table(df, "t_files_years", path=str(tmp_path / "y"), partition_by=["annee"],
               spread_by=["siren"], spread=2)
    assert len(data_files(tmp_path / "y")) <= 14
    for name in ("t_files_bucketed", "t_files_years"):
        assert spark.table(name).count() == 5000


def test_materialized_folders_are_cleared(spark):
    from ledgerlens.session import clear_materialized, materialize
    clear_materialized(spark)
    df = materialize(spark.range(10), "t-clear")
    path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").removeprefix("//")
    assert os.path.isdir(path) and df.count() == 10
    assert clear_materialized(spark) == 1
    assert not os.path.isdir(path)


def test_runs_are_shared_and_cleared(spark, tmp_path):
    """Queries over stored models build one run a session; clearing leaves no
    table and no folder; changed input gives another run."""
    from ledgerlens import queries
    from ledgerlens.session import checkpoint_dir, clear_materialized
    clear_materialized(spark)
    base = checkpoint_dir(spark).removeprefix("file:") + "/ledgerlens"
    os.makedirs(base, exist_ok=True)
    tables, folders = len(spark.catalog.listTables()), set(os.listdir(base))
    first = queries._models(spark, SF_SMALL).mart_indicateurs.inputFiles()
    for name in ("quality_report", "company_lookup", "ranking_margin", "division_history",
                 "stored_models_indicators"):
        QUERIES[name](spark, SF_SMALL).collect()
    assert queries._models(spark, SF_SMALL).mart_indicateurs.inputFiles() == first
    assert len(spark.catalog.listTables()) == tables + 5
    QUERIES["accounts_loaded"](spark, SF_SMALL).count()
    assert clear_materialized(spark) > 0 and clear_materialized(spark) == 0
    assert len(spark.catalog.listTables()) == tables and set(os.listdir(base)) == folders
    assert queries._models(spark, SF_SMALL).mart_indicateurs.inputFiles() != first  # built anew

    sf_dir = str(tmp_path)
    for name in ("orders", "customer"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{sf_dir}/{name}.parquet")
    before = queries._models(spark, sf_dir).stg_bilans
    n = before.count()
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").limit(200).write.mode("overwrite").parquet(
        f"{sf_dir}/orders.parquet")
    assert queries._models(spark, sf_dir).stg_bilans.count() < n
    assert before.count() == n
    clear_materialized(spark)


def failing(df):
    """``df`` with a row that fails while it is written, after others have been."""
    return df.withColumn("v", F.when(F.col("id") == 900, F.raise_error(F.lit("lost")).cast("long"))
                         .otherwise(F.col("v")))


@pytest.mark.parametrize("layout", [{}, dict(bucket_by=["id"], buckets=4, sort_by=["id"]),
                                    dict(partition_by=["p"])])
def test_replacing_a_table_is_all_or_nothing(spark, tmp_path, layout):
    name = f"t_atomic_{len(layout)}"
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("p"), F.lit(1).cast("long").alias("v"))
    cols = ["id", "p", "v"]
    old = save_table(df.select(cols), name, path=str(tmp_path), **layout)
    with pytest.raises(Exception, match="lost"):
        save_table(failing(df).select(cols), name, path=str(tmp_path), **layout)
    assert spark.table(name).agg(F.count("*"), F.sum("v")).first()[:] == (1000, 1000)
    assert len(os.listdir(tmp_path)) == 1  # nothing of the failed write is left
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]

    new = save_table(df.withColumn("v", F.lit(2).cast("long")).select(cols), name,
                     path=str(tmp_path), **layout)
    assert new.agg(F.sum("v")).first()[0] == spark.table(name).agg(F.sum("v")).first()[0] == 2000
    if "partition_by" not in layout:  # partitions are looked up in the catalog by each action
        assert old.agg(F.sum("v")).first()[0] == 1000  # who reads the version before goes on
    save_table(spark.table(name).withColumn("v", F.col("v") + 1).select(cols), name,
               path=str(tmp_path), **layout)  # from the table itself
    assert spark.table(name).agg(F.sum("v")).first()[0] == 3000
    assert len(os.listdir(tmp_path)) == 2  # the table's and the one before
    if "buckets" in layout:
        facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert facts["Num Buckets"] == "4"
    changed = save_table(df.select("id"), name, path=str(tmp_path))  # other columns and layout
    assert changed.columns == ["id"] and spark.table(name).count() == 1000


def test_load_is_done_again_until_it_was_complete(spark, tmp_path, monkeypatch):
    from ledgerlens.sources import parquet
    path, where = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(100).write.parquet(path)
    loads = []
    save = parquet.save_table
    monkeypatch.setattr(parquet, "save_table", lambda *a, **k: loads.append(1) or save(*a, **k))

    def load(**k):
        loads.clear()
        n = load_raw_accounts(spark, path, "t_loaded", location=where, **k).count()
        return n, len(loads)

    # a crash after the table was made, before its record
    save(spark.range(40), "t_loaded", path=where)
    assert parquet.load_record(spark, "t_loaded") is None
    assert load() == (100, 1)
    record = parquet.load_record(spark, "t_loaded")
    assert record["rows"] == 100 and record["input"]["files"] > 0
    assert load() == (100, 0) and load(refresh=True) == (100, 0)  # unchanged input
    # a crash between the switch and the record: the record names other files
    save(spark.range(40), "t_loaded", path=where)
    assert parquet.load_record(spark, "t_loaded") is None and load() == (100, 1)
    # changed input: kept, unless asked for
    spark.range(150).write.mode("append").parquet(path)
    assert load() == (100, 0) and load(refresh=True) == (250, 1) and load(refresh=True) == (250, 0)
    assert load(force=True) == (250, 1)
    # lost files
    gone = spark.table("t_loaded").inputFiles()[0].removeprefix("file://").removeprefix("file:")
    os.remove(gone)
    spark.catalog.refreshTable("t_loaded")
    assert load() == (250, 1)
