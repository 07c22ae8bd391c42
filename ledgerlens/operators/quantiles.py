"""Exact continuous percentiles per group; no group in one task.

``exact_percentiles(df, keys, measures, probs)`` returns one row per group
that has at least one non-null measure value, with one DOUBLE column
``f"{measure}_p{round(100 * p)}"`` per measure and probability: the
``percentile_cont`` of the non-null values, i.e. with ``pos = (n - 1) * p``
the interpolation of the values at ranks ``floor(pos)`` and ``ceil(pos)``.
With ``with_counts`` it adds ``f"{measure}_n"``, the number of non-null
values.

One plan for groups of any size, and nothing runs before the result is used.
Two passes, of which only the second moves values, and few of them:

1. measures become rows (group, measure, value). A monotone bucket (sign and a
   64th of an octave of the magnitude) orders the values of a group coarsely.
   Rows are counted per bucket with map-side combine; a running sum over a
   group's buckets gives each its first rank and names the buckets that hold a
   wanted rank: at most two per probability;
2. the measures are read again, and only values of those buckets pass a filter
   below the exchange (``hits.keep_hits``). They are counted per distinct value,
   with map-side combine: ties are counted, never gathered;
3. inside a bucket a running sum over its distinct values in order gives each
   value its ranks. A task sorts one bucket of one group and measure (values
   within about one percent of each other, each once), and can spill;
4. the values whose ranks are wanted (two per probability at most) are picked
   and interpolated.

The input is read twice: store it first where it is costly. Groups are compared as
structs, in which nulls are equal, so null keys are groups like any other.
Interpolation rounds like a fused multiply-add, see
``functions.numeric.interpolate`` (exact for the quartiles and the median).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import interpolate
from .hits import keep_hits

STEPS_PER_OCTAVE = 64
# Beyond the magnitudes of doubles (2 ** -1074 to 2 ** 1024), in steps.
_OFFSET = 1100 * STEPS_PER_OCTAVE


def percentile_column(measure: str, p: float) -> str:
    return f"{measure}_p{round(p * 100)}"


def value_bucket(v: Column) -> Column:
    """Integer that never falls as ``v`` rises (NaN counts as greatest)."""
    size = F.when(F.abs(v) == F.lit(float("inf")), F.lit(_OFFSET)).otherwise(
        F.floor(F.log2(F.abs(v)) * F.lit(STEPS_PER_OCTAVE))) + F.lit(_OFFSET)
    bucket = (F.when(F.isnan(v), F.lit(3 * _OFFSET)).when(v == F.lit(0.0), F.lit(0))
              .when(v > F.lit(0.0), size).otherwise(-size).cast("int"))
    # log2 counts as nullable; a null test would keep readers from sharing the counts
    return F.coalesce(bucket, F.lit(0))


def _values(df: DataFrame, keys: list[str], measures: dict[str, Column | str]) -> DataFrame:
    """``_k`` (group), ``_m`` (measure number), ``_v``, ``_b`` (bucket): the non-null values."""
    values = [F.struct(F.lit(i).alias("_m"),
                       (F.col(c) if isinstance(c, str) else c).cast("double").alias("_v"))
              for i, c in enumerate(measures.values())]
    return (df.select(F.struct(*keys).alias("_k"), F.inline(F.array(*values)))
            .where(F.col("_v").isNotNull())
            .withColumn("_b", value_bucket(F.col("_v"))))


def exact_percentiles(df: DataFrame, keys: list[str], measures: dict[str, Column | str],
                      probs: list[float], *, with_counts: bool = False) -> DataFrame:
    """See the module docstring. ``df`` is read twice."""
    values = _values(df, keys, measures)
    group = Window.partitionBy("_k", "_m")
    buckets = (values.groupBy("_k", "_m", "_b").agg(F.count(F.lit(1)).alias("_in"))
               .select("_k", "_m", "_b", "_in",
                       (F.sum("_in").over(group.orderBy("_b")) - F.col("_in")).alias("_first"),
                       F.sum("_in").over(group).alias("_total")))

    def position(p: float) -> Column:
        return (F.col("_total") - 1).cast("double") * F.lit(float(p))

    def within(first: Column, stop: Column) -> Column:
        """Does a wanted rank lie from ``first`` on and before ``stop``?"""
        here = [(first <= rank) & (rank < stop)
                for p in probs for rank in (F.floor(position(p)), F.ceil(position(p)))]
        return reduce(Column.__or__, here)

    def holds(rank: Column) -> Column:
        return (F.col("_from") <= rank) & (rank < F.col("_to"))

    named = (buckets.where(within(F.col("_first"), F.col("_first") + F.col("_in")))
             .select("_k", "_m", "_b", "_first", "_total"))
    counts = (keep_hits(values, named, "_k", "_m", "_b")
              .groupBy("_k", "_m", "_b", "_v").agg(F.count(F.lit(1)).alias("_n")))
    inside = Window.partitionBy("_k", "_m", "_b").orderBy("_v")
    ranked = (counts.join(named, ["_k", "_m", "_b"])
              .withColumn("_upto", F.sum("_n").over(inside))
              .select("_k", "_m", "_v", "_total",
                      (F.col("_first") + F.col("_upto") - F.col("_n")).alias("_from"),
                      (F.col("_first") + F.col("_upto")).alias("_to")))
    picks = []
    for i in range(len(measures)):
        mine = F.col("_m") == F.lit(i)
        picks.append(F.max(F.when(mine, F.col("_total"))).alias(f"_n{i}"))
        for j, p in enumerate(probs):
            pos = position(p)
            picks += [F.max(F.when(mine & holds(F.floor(pos)), F.col("_v"))).alias(f"_lo{i}_{j}"),
                      F.max(F.when(mine & holds(F.ceil(pos)), F.col("_v"))).alias(f"_hi{i}_{j}")]
    picked = ranked.where(within(F.col("_from"), F.col("_to"))).groupBy("_k").agg(*picks)
    out = [F.col("_k")[k].alias(k) for k in keys]
    for i, name in enumerate(measures):
        for j, p in enumerate(probs):
            pos = (F.col(f"_n{i}") - 1).cast("double") * F.lit(float(p))
            out.append(interpolate(F.col(f"_lo{i}_{j}"), F.col(f"_hi{i}_{j}"),
                                   pos - F.floor(pos)).alias(percentile_column(name, p)))
        if with_counts:
            out.append(F.coalesce(F.col(f"_n{i}"), F.lit(0)).alias(f"{name}_n"))
    return picked.select(*out)
