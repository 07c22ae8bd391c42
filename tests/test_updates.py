"""Models kept up to date by year, lookups of many companies, clustered loads:
results against full rebuilds, and which files and rows are read or written."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import views
from ledgerlens.plans import updates
from ledgerlens.plans.models import build_models
from ledgerlens.plans.updates import touched_rows, update_models
from ledgerlens.sources.parquet import load_raw_accounts, save_table
from tests.rows import REGISTER_SCHEMA, filing, raw_df

YEARS = (2010, 2016)
# the staged tables show in these
COMPARED = ("mart_indicateurs", "mart_evolution", "mart_benchmark_sectoriel")


def amounts(rng):
    return dict(chiffre_affaires=rng.randrange(1, 9) * 1000, resultat_net=rng.randrange(-3, 3) * 100,
                ebe=rng.randrange(0, 500), stocks_net=rng.randrange(0, 500), dettes_total=rng.randrange(1, 900))


def some_filings(seed, companies=30):
    """Histories with gaps."""
    rng = random.Random(seed)
    return {(f"{i:09d}", y): filing(f"{i:09d}", y, "K", **amounts(rng))
            for i in range(companies) for y in range(*YEARS) if rng.random() < 0.7}


def files_by_year(table, spark):
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    root = facts["Location"].removeprefix("file://").removeprefix("file:")
    found = {}
    for folder, _, names in os.walk(root):
        if "annee_fiscale=" in folder:
            found[int(folder.rsplit("=", 1)[1])] = {
                (n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in names if n.endswith(".parquet")}
    return found


def register(spark, companies=30, shift=0):
    rows = [(f"{i:09d}", ("62.01Z", "47.11A")[(i + shift) % 2], f"n{i}", "PME") for i in range(companies)]
    return spark.createDataFrame(rows, REGISTER_SCHEMA)


class Kept:
    """Stored models of some filings, and their comparison with a full rebuild."""

    def __init__(self, spark, folder, prefix):
        self.spark, self.folder, self.prefix = spark, str(folder), prefix

    def update(self, filings, reg=None, **k):
        raw, reg = raw_df(self.spark, list(filings)), register(self.spark) if reg is None else reg
        bounds = dict(min_year=YEARS[0], max_year=YEARS[1] - 1, min_panel=5, register_is_renamed=True)
        models, written = update_models(raw, reg, year_buckets=2, prefix=self.prefix,
                                        location=self.folder, **bounds, **k)
        whole = build_models(raw, reg, **bounds)
        for name in COMPARED:
            a, b = getattr(models, name), getattr(whole, name)
            assert sorted(a.columns) == sorted(b.columns)
            got, want = (sorted(map(repr, df.select(*b.columns).collect())) for df in (a, b))
            assert got == want, name
        return written

    def files(self, model="mart_evolution"):
        return files_by_year(self.prefix + model, self.spark)


def test_updates_equal_rebuilds(spark, tmp_path):
    kept, rows = Kept(spark, tmp_path, "upd_"), some_filings(1)
    everything = list(range(*YEARS))
    assert kept.update(rows.values())["mart_evolution"] == everything
    before = kept.files(), kept.files("stg_bilans")
    assert not any(kept.update(rows.values()).values())  # nothing changed
    assert (kept.files(), kept.files("stg_bilans")) == before

    # late filings of one year for two companies: a replaced one and a new one
    rng = random.Random(2)
    late = [filing(f"{i:09d}", 2012, "C", **amounts(rng)) for i in (3, 4)]
    written = kept.update([*rows.values(), *late])
    assert written["stg_bilans"] == written["mart_indicateurs"] == written["mart_benchmark_sectoriel"] == [2012]
    after, touched = kept.files(), written["mart_evolution"]
    assert 2012 in touched and min(touched) == 2012 and 2 <= len(touched) <= 5
    for year in everything:
        assert (after[year] == before[0][year]) == (year not in touched), year
    assert all(kept.files("stg_bilans")[y] == before[1][y] for y in everything if y != 2012)

    # one that loses the dedup, and one that is not usable: staging sees the first only
    loser = filing("000000003", 2012, "S", chiffre_affaires=1)
    hidden = filing("000000005", 2013, "C", confidentiality="Confidential")
    written = kept.update([*rows.values(), *late, loser, hidden])
    assert written["stg_bilans"] == [2012] and written["mart_evolution"] == []

    # a whole year that goes and comes back, a new company, another register
    without = [r for (_, y), r in rows.items() if y != 2013]
    gone = kept.update(without)
    assert gone["stg_bilans"] == [2012, 2013] and 2013 in gone["mart_evolution"]
    back = kept.update([*rows.values(), filing("000000099", 2010, "C", chiffre_affaires=5)])
    assert back["stg_bilans"] == [2010, 2013]
    moved = kept.update([*rows.values(), filing("000000099", 2010, "C", chiffre_affaires=5)],
                        reg=register(spark, shift=1))
    assert moved["stg_bilans"] == [] and moved["mart_benchmark_sectoriel"] == everything
    assert kept.update([])["stg_bilans"] == everything  # nothing left


def test_an_update_that_did_not_end_is_done_anew(spark, tmp_path, monkeypatch):
    kept, rows = Kept(spark, tmp_path, "upe_"), some_filings(3, companies=12)
    kept.update(rows.values())
    changed = [*rows.values(), filing("000000001", 2011, "C", chiffre_affaires=77)]

    def lost(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(updates, "_update_evolution", lost)
    with pytest.raises(RuntimeError, match="lost"):
        kept.update(changed)
    monkeypatch.undo()
    assert kept.update(changed)["mart_evolution"] == list(range(*YEARS))


@pytest.mark.parametrize("seed", range(3))
def test_touched_rows_against_rebuilt_histories(spark, seed):
    """Rows that depend on a changed one: it, and two available years after it."""
    rng = random.Random(seed)
    there = {(s, y) for s in "abcdef" for y in range(2000, 2012) if rng.random() < 0.6}
    changed = {(s, y) for s in "abcd" for y in range(2000, 2012) if rng.random() < 0.15}
    want = set(changed)
    for s, y in changed:
        want |= set(sorted((s, z) for t, z in there if t == s and z > y)[:2])
    frame = lambda rows: spark.createDataFrame(sorted(rows), "siren string, annee_fiscale int")
    got = [tuple(r) for r in touched_rows(frame(there), frame(changed)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def rows_scanned(df):
    """Rows that the scans of ``df`` gave, once it has run."""
    total, plan = 0, df._jdf.queryExecution().executedPlan()
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if "Scan" in node.getClass().getSimpleName():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
    return total


@pytest.fixture
def whole_row_groups(spark):
    """Scans that read a row group whole or not at all."""
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.filter.columnindex.enabled", "false")
    yield
    spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.filter.columnindex.enabled")


def test_lookup_of_many_companies_reads_their_row_groups(spark, tmp_path, whole_row_groups):
    n = 200_000
    df = spark.range(n).select(F.lpad((F.col("id") * 7919 % n * 5).cast("string"), 9, "0").alias("siren"),
                               F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("w"))
    small = {"parquet.block.size": str(64 << 10), "parquet.block.size.row.check.min": "100",
             "parquet.page.size.row.check.min": "100", "parquet.page.size.row.check.max": "1000"}
    bloom = save_table(df, "t_bloom", path=str(tmp_path / "a"), bucket_by=["siren"], buckets=4,
                       sort_by=["siren"], bloom={"siren": 2000}, options=small)
    present = [f"{i * 995:09d}" for i in range(1000)]
    absent = [f"{i * 995 + 3:09d}" for i in range(1000)]  # between the stored ones

    def read(ids):
        found = views.of_companies(bloom, ids)
        rows = found.collect()
        return len(rows), rows_scanned(found)

    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "2000")
    try:
        few, few_read = read(present[:5])
        assert few == 5 and 0 < few_read < n / 50
        assert read([])[0] == 0
        none, none_read = read(absent)
        assert none == 0 and none_read < n / 3  # by statistics alone, every row group would be read
        some, some_read = read([*present, *present, None, "no such id"])
        assert some == 1000 and some_read <= n
    finally:
        spark.conf.unset("spark.sql.parquet.pushdown.inFilterThreshold")


def test_frames_and_long_lists_of_companies(spark, tmp_path, monkeypatch):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("siren"), F.col("id").alias("v"))
    stored = save_table(df, "t_many", path=str(tmp_path), bucket_by=["siren"], buckets=4, sort_by=["siren"])
    ids = [f"{i:09d}" for i in range(0, 2000, 3)]
    monkeypatch.setattr(views, "MAX_LISTED", 10)
    frame = spark.createDataFrame([(i, 0) for i in [*ids, *ids, None]], "siren string, v int")
    want = {(f"{i:09d}", i) for i in range(0, 1000, 3)}
    for wanted in (frame, ids):
        found = views.of_companies(stored, wanted)
        assert found.columns == ["siren", "v"]
        rows = [tuple(r) for r in found.collect()]
        assert len(rows) == len(want) and set(rows) == want
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.of_companies(stored, frame)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1  # the list; the stored side is read by bucket


def test_loads_are_clustered_by_year(spark, tmp_path, whole_row_groups):
    """A filter on a year reads its row groups, also when one company has a third of
    all filings; the ranges are even."""
    n = 60_000
    company = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    (spark.range(n).select(F.lpad(company.cast("string"), 9, "0").alias("siren"),
                           (2000 + F.col("id") * 31 % 20).cast("int").alias("annee"),
                           F.col("id").alias("v")).repartition(6).write.parquet(str(tmp_path / "in")))
    small = {"parquet.block.size": str(16 << 10), "parquet.block.size.row.check.min": "100"}
    loaded = load_raw_accounts(spark, str(tmp_path / "in"), "t_clustered", location=str(tmp_path / "out"),
                               writer_options=small)
    year = loaded.where("annee = 2007")
    assert year.count() == n // 20  # count alone may be answered from a narrower scan
    rows = year.select("siren", "v").collect()
    again = year.select("siren", "v")
    assert len(again.collect()) == len(rows) == n // 20
    assert 0 < rows_scanned(again) < n / 4
    plain = spark.read.parquet(str(tmp_path / "in")).where("annee = 2007").select("siren", "v")
    assert len(plain.collect()) == n // 20 and rows_scanned(plain) > n / 2
    sizes = [r["n"] for r in loaded.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2 * n / len(sizes)
