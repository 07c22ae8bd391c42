"""Company annual-accounts analytics on Spark DataFrames.

Layers (each a plain function from DataFrames to a DataFrame):

* ``sources``   – Parquet readers, catalog loader, table sinks, test fixtures.
* ``operators`` – staging, indicators, evolution, sector benchmark,
  exact quantiles, profiling, data-quality checks and result views.
* ``functions`` – column-expression helpers (rounding, ratios, flags, sectors).
* ``plans``     – the model chain and its materialised, bucketed layout.
* ``llm``       – operators of a training-data pipeline (optional).
"""

__version__ = "0.1.0"
