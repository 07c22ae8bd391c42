"""Filter below an exchange: rows whose key may be among given keys.

``keep_hits`` stands in front of an exact join, so that rows that can't match
are not shuffled. Keys set bits of a bitmap of fixed size, which is broadcast:
its size is bounded whatever the number of keys. More keys than bits only let
more rows through; no row that matches is ever lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longs of the bitmap: the broadcast has at most so many rows.
HIT_WORDS = 1 << 18


def keep_hits(rows: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """``rows`` without those whose columns ``on`` are surely not in ``keys``."""
    def place() -> Column:
        return F.pmod(F.xxhash64(*on), F.lit(HIT_WORDS * 64))

    def bit(at: str) -> str:
        return f"shiftleft(1L, CAST({at} % 64 AS INT))"

    bitmap = (keys.select(place().alias("_hit_at"))
              .groupBy(F.expr("_hit_at div 64").alias("_hit_word"))
              .agg(F.expr(f"bit_or({bit('_hit_at')})").alias("_hit_bits")))
    marked = rows.withColumn("_hit_place", place())
    hit = F.expr(f"(_hit_bits & {bit('_hit_place')}) != 0L")
    return (marked.join(F.broadcast(bitmap), F.expr("_hit_place div 64 = _hit_word"))
            .where(hit).select(*(marked[c] for c in rows.columns)))
