"""Presentation order of small results.

``orderBy`` plans a range exchange with a sampling job so that very large
results sort in parallel. Results whose size is bounded by a category count
(years, revenue classes, filing types, profiled columns, one company's
years, benchmark panels) are instead moved to one partition and sorted
there: the same total order without the sampling job. ``repartition(1)`` is
used rather than ``coalesce(1)``, which would also pull the upstream stage
(for example the scan of a point lookup) into a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def sort_small(df: DataFrame, *order) -> DataFrame:
    """Total order of a result known to be small (see module docstring)."""
    return df.repartition(1).sortWithinPartitions(*order)
