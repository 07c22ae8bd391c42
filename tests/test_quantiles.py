"""Exact percentiles against brute force and DuckDB, with a hot group."""

import math
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import exact_percentiles, percentile_column, value_bucket

PROBS = [0.25, 0.5, 0.75]


def brute(values, p):
    a = sorted(v for v in values if v is not None)
    if not a:
        return None
    pos = (len(a) - 1) * p
    lo, hi = math.floor(pos), math.ceil(pos)
    d = pos - lo
    return a[lo] if d == 0 else math.fma(a[lo], 1 - d, a[hi] * d)


def make_rows(seed=3):
    rng = random.Random(seed)
    rows = []
    # hot group: a third of all rows, values with duplicates and nulls
    for _ in range(20000):
        rows.append(("hot", 1, rng.choice([None, round(rng.gauss(5, 30), 2), float(rng.randint(0, 9))]),
                     rng.randint(-10**6, 10**9)))
    for g in range(300):
        n = rng.choice([1, 2, 3, 4, 5, 10, 57, 200])
        for _ in range(n):
            rows.append((f"g{g:03d}", g % 7, round(rng.uniform(-50, 50), rng.choice([1, 2, 3])),
                         None if rng.random() < 0.1 else rng.randint(0, 10**7)))
    rows.append((None, 0, 1.5, 10))
    rows.append((None, 0, 2.5, 20))
    rows.append(("allnull", 3, None, None))
    return rows


def test_matches_brute_force_and_duckdb(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, "g string, k int, x double, y long")
    out = exact_percentiles(df, ["g", "k"], {"x": "x", "y": "y"}, PROBS, with_counts=True)
    got = {(r.g, r.k): r for r in out.collect()}

    groups = {}
    for g, k, x, y in rows:
        groups.setdefault((g, k), ([], []))
        groups[(g, k)][0].append(x)
        groups[(g, k)][1].append(y)
    assert ("allnull", 3) not in got  # no value at all: no row
    assert set(got) == {key for key, (xs, ys) in groups.items()
                        if any(v is not None for v in xs + ys)}
    for key, (xs, ys) in groups.items():
        if key not in got:
            continue
        r = got[key]
        for name, vals in (("x", xs), ("y", [None if v is None else float(v) for v in ys])):
            assert getattr(r, f"{name}_n") == sum(v is not None for v in vals), (key, name)
            for p in PROBS:
                assert getattr(r, percentile_column(name, p)) == brute(vals, p), (key, name, p)

    pdf = pd.DataFrame(rows, columns=["g", "k", "x", "y"])  # noqa: F841 (read by DuckDB)
    duck = duckdb.sql("""SELECT g, k, percentile_cont(0.25) WITHIN GROUP (ORDER BY x) x25,
        percentile_cont(0.75) WITHIN GROUP (ORDER BY x) x75,
        percentile_cont(0.5) WITHIN GROUP (ORDER BY y) y50 FROM pdf GROUP BY g, k""").fetchall()
    for g, k, x25, x75, y50 in duck:
        if (g, k) in got:
            r = got[(g, k)]
            assert (r.x_p25, r.x_p75, r.y_p50) == (x25, x75, y50), (g, k)


def test_buckets_never_fall(spark):
    rng = random.Random(2)
    values = sorted({0.0, 5e-324, 1.0, 1e308, -1e308, float("inf"), float("-inf"),
                     *(rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300)
                       for _ in range(4000)),
                     *(math.nextafter(2.0 ** e, s) for e in range(-60, 60) for s in (0, 1e300)),
                     *(float(i) for i in range(-500, 500))}) + [float("nan")]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    buckets = [r.b for r in df.select("i", value_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert buckets == sorted(buckets)
    assert len(set(buckets)) > 1000


def test_heavy_ties_at_the_quartiles(spark):
    """Half the values equal 0.0 (like debt ratios of companies without debt)."""
    rng = random.Random(4)
    vals = [0.0] * 30000 + [round(rng.uniform(-5, 5), 3) for _ in range(30000)]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    out = exact_percentiles(df, ["g"], {"v": "v"}, PROBS).collect()[0]
    for p in PROBS:
        assert out[percentile_column("v", p)] == brute(vals, p)


@pytest.mark.parametrize("probs", [[0.0, 1.0], [0.5], [0.25, 0.5, 0.75]])
def test_extremes_and_single_values(spark, probs):
    vals = [3.0, -1.5, 8.25, 8.25, 1e300, -1e-300]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 7.0)], "g string, v double")
    got = {r.g: r for r in exact_percentiles(df, ["g"], {"v": "v"}, probs).collect()}
    for p in probs:
        assert got["a"][percentile_column("v", p)] == brute(vals, p)
        assert got["b"][percentile_column("v", p)] == 7.0


def test_nothing_runs_while_the_plan_is_built(spark):
    """And the empty input gives no row."""
    df = spark.createDataFrame([], "g string, v double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles-build", "")
    out = exact_percentiles(df, ["g"], {"v": "v"}, PROBS)
    assert tracker.getJobIdsForGroup("quantiles-build") == []
    assert out.collect() == []


def shuffles(df):
    """(partitioning, rows written) of every exchange of a collected frame."""
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ShuffleExchangeExec":
            found.append((node.outputPartitioning().toString(),
                          node.metrics().apply("shuffleRecordsWritten").value()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_only_values_near_a_wanted_rank_are_shuffled(spark):
    """400,000 values, all different, in two groups: exchanges see bucket counts
    and the few values of the buckets that hold a quartile."""
    n = 400_000
    df = spark.range(n, numPartitions=4).select(
        F.concat(F.lit("g"), F.col("id") % 2).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) + 10**6).cast("double").alias("v"))
    out = exact_percentiles(df, ["g"], {"v": "v"}, PROBS, with_counts=True)
    rows = {r["g"]: r for r in out.collect()}
    found = shuffles(out)
    assert sum(rows_written for _, rows_written in found) < 0.15 * n, found
    for g in ("g0", "g1"):
        values = [r["v"] for r in df.where(F.col("g") == g).collect()]
        assert [rows[g][percentile_column("v", p)] for p in PROBS] == [brute(values, p) for p in PROBS]
        assert rows[g]["v_n"] == n // 2


def test_values_are_counted_before_the_shuffle(spark):
    """Map tasks count per value before the exchange of values."""
    df = spark.range(80_000, numPartitions=4).select(
        F.concat(F.lit("g"), F.col("id") % 2).alias("g"), (F.col("id") % 2000 / 4).cast("double").alias("v"))
    out = exact_percentiles(df, ["g"], {"v": "v"}, PROBS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(_k#\d+, _m#\d+, [^)]*_v", plan), plan[:3000]
    assert "partial_count(1)" in plan
    out.collect()
    assert sum(n for _, n in shuffles(out)) < 8000


def test_benchmark_shuffles_a_small_share_of_its_values(spark):
    """Of the quartiles' values (six a filing), few pass the filter."""
    from ledgerlens.operators.benchmark import KEYS, MEASURES, PROBS as BENCH_PROBS, benchmark_base
    from ledgerlens.queries import _ent, _ind
    from ledgerlens.session import materialize
    base = materialize(benchmark_base(_ind(spark, "/root/testdata/sf0.1"),
                                      _ent(spark, "/root/testdata/sf0.1"))
                       .select(*KEYS, *[src for _, src, _, _ in MEASURES]), "t-base")
    values = base.select(*[F.count(src) for _, src, _, _ in MEASURES]).first()
    out = exact_percentiles(base, KEYS, {stem: src for stem, src, _, _ in MEASURES}, BENCH_PROBS)
    out.collect()
    of_values = [n for keys, n in shuffles(out) if "_v" in keys]
    assert len(of_values) == 1 and of_values[0] < 0.35 * sum(values), (of_values, sum(values))


def test_keep_hits_loses_nothing(spark):
    from ledgerlens.operators.hits import keep_hits
    rows = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("id"))
    keys = spark.range(0, 1000, 7).select(F.col("id").alias("k"))
    kept = keep_hits(rows, keys, "k")
    assert kept.columns == ["k", "id"]
    found = [r["k"] for r in kept.collect()]
    assert sum(k % 7 == 0 for k in found) == 5 * 143 and len(found) < 800
    assert keep_hits(rows, keys.limit(0), "k").collect() == []
