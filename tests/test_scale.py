"""What keeps the model runs and the amended filings within bounds as tables grow."""

import contextlib
import io
import re

import ledgerlens.queries as q
from ledgerlens.operators.evolution import compute_evolution
from ledgerlens.operators.indicators import compute_indicators
from ledgerlens.operators.staging import stage_statements
from ledgerlens.sources.fixtures import amended_accounts
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.rows import filing, raw_df

#: Methods with more bytes of code are never compiled by the JVM.
HUGE_METHOD = 8000


def method_sizes(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", buf.getvalue())]


def test_generated_loops_of_the_marts_are_compiled(spark, tmp_path):
    path = str(tmp_path / "stg")
    stage_statements(raw_df(spark, [filing()])).write.parquet(path)
    indicators = compute_indicators(spark.read.parquet(path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan shows no code yet
    try:
        for df in (indicators, compute_evolution(indicators)):
            sizes = method_sizes(df)
            assert sizes and max(sizes) < HUGE_METHOD, sizes
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_buckets_of_the_model_runs_follow_the_input(spark, monkeypatch):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    seen = []
    monkeypatch.setattr(q, "shared_run", lambda spark, inputs, parameters, build: build(str, "folder"))
    monkeypatch.setattr(q, "materialize_models", lambda *a, buckets, year_buckets, **k: seen.append((buckets, year_buckets)))
    monkeypatch.setattr(q, "update_models", lambda *a, year_buckets, **k: seen.append(year_buckets))
    q._models(spark, SF_SMALL), q._updated_models(spark, SF_SMALL)
    assert seen == [(q.LOOKUP_BUCKETS, q.YEAR_BUCKETS), q.YEAR_BUCKETS, q.YEAR_BUCKETS]
    seen.clear()
    monkeypatch.setattr(q, "ORDERS_A_BUCKET", orders // 40)
    q._models(spark, SF_SMALL), q._updated_models(spark, SF_SMALL)
    assert seen[0][0] == seen[0][1] == seen[1] == seen[2] and seen[1] in (40, 41)


def test_amended_filings_come_from_one_pass(spark):
    plan = q.q_stg_statements_amended(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_amended_filings_equal_a_union_of_their_kinds(spark):
    rows = [filing(f"{n:09d}", 2015, t, total_actif=n, ebe=7, chiffre_affaires=None if n % 4 else 3, reserves=n)
            for n in range(120) for t in ("C", None)] + [filing(total_actif=None, ebe=1)] * 2
    raw = raw_df(spark, rows)
    found = amended_accounts(raw)
    assert found.columns == raw.columns
    # the plain filings, and per kind which of them are amended and how
    whole = F.floor("total_actif")
    plain = raw.select(*[
        F.when(whole_of(F.col("total_actif")) % 7 == 0, F.lit(0.0)).otherwise(quarters(c)).alias(c)
        if c == "capitaux_propres" else quarters(c).alias(c) if t == "bigint" and c != "effectif_moyen"
        else F.col(c) for c, t in raw.dtypes])
    same = plain.where(whole % 3 == 0).withColumns({
        "ebe": F.when(whole % 2 == 0, F.col("ebe") - 1.5), "reserves": F.col("reserves") + 0.5})
    other = plain.where(whole % 5 == 0).withColumn("type_bilan", F.when(whole % 10 == 0, F.lit("N")))
    later = plain.where(whole % 11 == 0).withColumns({
        "date_cloture_exercice": F.date_add("date_cloture_exercice", 30),
        "chiffre_affaires": F.col("chiffre_affaires") * 2})
    want = plain.unionByName(same).unionByName(other).unionByName(later)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))


def quarters(c):
    return F.col(c) + F.col("total_actif") % 4 * F.lit(0.25)


def whole_of(total):
    return F.floor(total + total % 4 * F.lit(0.25))
