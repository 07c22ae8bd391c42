"""Batch job: build every model as a table, then run the data checks.

The Spark counterpart of a model run followed by its tests::

    python -m ledgerlens.jobs --accounts …/accounts.parquet \\
        --register …/register.parquet --buckets 2048 \\
        [--prefix fin_] [--min-year 2010 --max-year 2025]

On a cluster, ship the package (``--py-files ledgerlens.zip``) and submit a
two-line launcher that calls ``ledgerlens.jobs.main()``. The tables are written to the
session's catalog (``save_table``); the check results go to
``<prefix>quality_report``. The exit status is 1 when a check fails.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.quality import declared_checks, quality_report
from .operators.staging import DEFAULT_MAX_YEAR, DEFAULT_MIN_YEAR
from .plans.models import materialize_models
from .session import clear_materialized
from .sources.parquet import read_accounts, read_company_register, save_table


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerlens.jobs", description=__doc__.splitlines()[0])
    p.add_argument("--accounts", required=True, help="accounts Parquet path")
    p.add_argument("--register", required=True, help="company register Parquet path")
    p.add_argument("--buckets", type=int, required=True,
                   help="buckets of the company-keyed tables (a few hundred MB each)")
    p.add_argument("--prefix", default="", help="table name prefix")
    p.add_argument("--min-year", type=int, default=DEFAULT_MIN_YEAR)
    p.add_argument("--max-year", type=int, default=DEFAULT_MAX_YEAR)
    p.add_argument("--min-panel", type=int, default=50)
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    raw = read_accounts(spark, args.accounts)
    reg = read_company_register(spark, args.register)
    m = materialize_models(raw, reg, buckets=args.buckets, prefix=args.prefix,
                           min_year=args.min_year, max_year=args.max_year,
                           min_panel=args.min_panel, register_is_renamed=True)
    tables = {"stg_bilans": m.stg_bilans, "stg_entreprises": m.stg_entreprises,
              "mart_indicateurs": m.mart_indicateurs, "mart_evolution": m.mart_evolution,
              "mart_benchmark_sectoriel": m.mart_benchmark_sectoriel}
    report = save_table(quality_report(tables, declared_checks(args.min_year, args.max_year)),
                        f"{args.prefix}quality_report")
    failed = report.where(F.col("failures") > 0).count()  # one row per check: small
    clear_materialized(spark)
    return 1 if failed else 0


def main(argv=None) -> int:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("ledgerlens-build").getOrCreate()
    return run(spark, args)


if __name__ == "__main__":
    sys.exit(main())
