"""Numeric helpers against exact references: C-style rounding (as DuckDB
computes it) and fused multiply-add interpolation."""

import math
import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import interpolate, round_half_away, safe_ratio, scaled_ratio


def test_round_half_away_matches_duckdb(spark):
    rng = random.Random(7)
    xs = ([rng.uniform(-1000, 1000) for _ in range(3000)]
          + [rng.randint(-100000, 100000) / 1000 for _ in range(3000)]
          + [1.005, 2.675, -0.004, -0.0, 0.0049999, 0.5, -0.5, 1.5, 2.5, -2.5, 0.045, -1.005])
    pdf = pd.DataFrame({"x": xs})
    duck = duckdb.sql("SELECT x, round(x, 1) r1, round(x, 2) r2, round(x, 3) r3, round(x, 0) r0 FROM pdf").df()
    df = spark.createDataFrame(pdf)
    got = df.select("x", *[round_half_away(F.col("x"), n).alias(f"r{n}") for n in range(4)]).toPandas()
    merged = got.merge(duck, on="x", suffixes=("", "_duck"))
    assert len(merged) >= len(xs)
    for n in range(4):
        a, b = merged[f"r{n}"], merged[f"r{n}_duck"]
        assert all(x == y and math.copysign(1, x) == math.copysign(1, y) for x, y in zip(a, b)), n


def test_interpolate_equals_fma(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(4000):
        lo = rng.uniform(-1e4, 1e4)
        hi = lo + abs(rng.gauss(0, 100))
        rows.append((lo, hi, rng.choice([0.0, 0.25, 0.5, 0.75])))
    df = spark.createDataFrame(rows, "lo double, hi double, d double")
    got = df.select("lo", "hi", "d", interpolate("lo", "hi", "d").alias("q")).collect()
    bad = [r for r in got if r.q != math.fma(r.lo, 1 - r.d, r.hi * r.d)]
    assert not bad, bad[:3]


def test_ratios_null_on_zero_and_multiply_first(spark):
    df = spark.createDataFrame([(10, 0), (10, None), (1, 3)], "n long, d long")
    out = df.select(safe_ratio("n", "d").alias("r"), scaled_ratio(100.0, "n", "d").alias("s")).collect()
    assert out[0].r is None and out[1].r is None
    assert out[2].s == (100.0 * 1) / 3


def test_quarter_interpolation_is_correctly_rounded(spark):
    """d = 0.25: the result is the exact rational 0.75*lo + 0.25*hi rounded
    once (Python's float(Fraction) rounds to nearest, ties to even)."""
    from fractions import Fraction
    rng = random.Random(5)
    rows = []
    for _ in range(3000):
        scale = 10.0 ** rng.randint(-3, 12)
        lo = rng.uniform(-1, 1) * scale
        rows.append((lo, lo + abs(rng.uniform(0, 1)) * scale))
    df = spark.createDataFrame(rows, "lo double, hi double")
    got = df.select("lo", "hi", interpolate("lo", "hi", F.lit(0.25)).alias("q")).collect()
    for r in got:
        exact = Fraction(r.lo) * Fraction(3, 4) + Fraction(r.hi) * Fraction(1, 4)
        assert r.q == float(exact), (r.lo, r.hi)


def test_describe_lists_columns(spark):
    from ledgerlens.operators.profile import describe
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    assert [tuple(r) for r in describe(df).collect()] == [("n", "bigint", True), ("s", "string", True)]
