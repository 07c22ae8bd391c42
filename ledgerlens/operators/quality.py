"""Declared data checks of the built tables, as Spark jobs.

A check is ``unique`` (keys occurring more than once; nulls ignored),
``not_null`` (null rows) or ``accepted_values`` (non-null rows outside the
allowed set). ``check_table`` reads a table once: rows are counted per key
(with the failures of the other checks among them), then over the keys; a
further unique key is a further grouped count. A key that contains the column a
table is bucketed by is counted inside the buckets, without an exchange
(``within``). ``quality_report`` unions every table's results into rows of
``table_name, column_name, check_name, failures`` (0 means passed).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import DEBT_FLAGS, DEGRADATION_FLAGS, FILING_TYPES, LIQUIDITY_FLAGS


@dataclass
class TableChecks:
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)


def declared_checks(min_year: int, max_year: int) -> dict[str, TableChecks]:
    """The checks declared for each table (years as the staging bounds)."""
    return {
        "stg_bilans": TableChecks(
            unique=["bilan_key"],
            not_null=["bilan_key", "siren", "annee_fiscale", "date_cloture",
                      "chiffre_affaires", "capitaux_propres", "total_actif"],
            accepted={"annee_fiscale": list(range(min_year, max_year + 1)),
                      "type_bilan": FILING_TYPES}),
        "stg_entreprises": TableChecks(unique=["siren"], not_null=["siren"]),
        "mart_indicateurs": TableChecks(
            unique=["bilan_key"],
            not_null=["bilan_key", "ebitda", "bfr"],
            accepted={"flag_endettement": DEBT_FLAGS, "flag_liquidite": LIQUIDITY_FLAGS}),
        "mart_evolution": TableChecks(
            unique=["bilan_key"], not_null=["bilan_key"],
            accepted={"flag_degradation": DEGRADATION_FLAGS}),
        "mart_benchmark_sectoriel": TableChecks(
            not_null=["naf_division", "annee_fiscale", "nb_entreprises"]),
    }


def check_table(name: str, df: DataFrame, checks: TableChecks,
                within: dict[str, str] | None = None) -> DataFrame:
    """One row per check of ``df``. ``within`` names, for a unique key, the column
    that clusters the stored table and that the key starts with (followed by
    ``_``): equal keys are then in one bucket, and rows are counted by both. A
    row that breaks this rule raises an error when the check runs, since equal
    keys could then be in several buckets."""
    labels, exprs = [], []
    for c in checks.not_null:
        labels.append((c, "not_null"))
        exprs.append(F.col(c).isNull())
    for c, values in checks.accepted.items():
        labels.append((c, "accepted_values"))
        exprs.append(F.col(c).isNotNull() & ~F.col(c).isin(*values))
    counted = [F.count_if(e).alias(f"_c{i}") for i, e in enumerate(exprs)]
    parts = []
    for n, key in enumerate(checks.unique or [None]):
        mine = counted if n == 0 else []
        if key is None:
            one_row, found = df.agg(*mine), labels
        else:
            repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > F.lit(1)))
            clusters = []
            if cluster := (within or {}).get(key):
                clusters = [F.col(cluster).alias("_cluster")]
                inside = F.col("_key").startswith(F.concat("_cluster", F.lit("_")))
                astray = F.count_if(F.col("_key").isNotNull() & ~F.coalesce(inside, F.lit(False)))
                repeated = F.when(astray > 0, F.raise_error(F.lit(
                    f"{name}: {key} does not start with {cluster}; check without `within`"))
                ).otherwise(repeated)
            per_key = df.groupBy(*clusters, F.col(key).alias("_key")).agg(
                F.count(F.lit(1)).alias("_n"), *mine)
            one_row = per_key.agg(
                repeated.cast("bigint").alias("_dup"),
                *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}")
                  for i in range(len(mine))])
            found = [(key, "unique"), *labels[:len(mine)]]
        columns = (["_dup"] if key else []) + [f"_c{i}" for i in range(len(mine))]
        if not columns:
            continue
        parts.append(one_row.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.lit(k).alias("check_name"), F.col(v).cast("bigint").alias("failures"))
            for (c, k), v in zip(found, columns)]))))
    return reduce(DataFrame.unionByName, parts)


def quality_report(tables: dict[str, DataFrame], checks: dict[str, TableChecks],
                   within: dict[str, str] | None = None) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [check_table(n, tables[n], checks[n], within) for n in checks if n in tables])
