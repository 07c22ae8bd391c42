"""Connected components of a graph given as links, by alternating large-star
and small-star rounds: every round is a few joins and aggregations, no node's
neighbours are gathered in one place, and each round is written to the shared
folder. The driver sees a count and a checksum a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, store


def _least_neighbour(sides: DataFrame) -> DataFrame:
    """For every node, itself or its least neighbour, whichever is less."""
    return sides.groupBy(F.col("node").alias("hub")).agg(
        F.least(F.min("other"), F.first("node")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    sides = links.select(F.col("child").alias("node"), F.col("parent").alias("other")).unionAll(
        links.select(F.col("parent").alias("node"), F.col("child").alias("other")))
    return (sides.join(_least_neighbour(sides), F.col("node") == F.col("hub"))
            .where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("child"), F.col("least").alias("parent")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("child").alias("hub")).agg(F.min("parent").alias("least"))
    up = links.join(least, F.col("child") == F.col("hub")).where(F.col("parent") != F.col("least"))
    return (up.select(F.col("parent").alias("child"), F.col("least").alias("parent"))
            .unionAll(least.select(F.col("hub").alias("child"), F.col("least").alias("parent")))
            .distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(child, parent))"),
                           F.expr("sum(pmod(hash(child, parent), 1000003))")).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (least node of its component) for every node of
    ``links`` (columns a and b, of one ordered type) that is not a root itself.

    Repeated links, loops and either direction are allowed. Nulls are no nodes:
    such links are left out. No links give no rows.
    """
    now = store(links.where("a != b").select(
        F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct(), "links")
    state = _state(now)
    while state[0]:
        after = store(_small_star(_large_star(now)), "links")
        drop(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return now.select(F.col("child").alias("node"), F.col("parent").alias("root"))
