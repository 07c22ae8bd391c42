"""Parquet sources and table sinks.

* ``read_accounts``          – scan of the yearly accounts file (all columns).
* ``company_register``       – projection, renaming and row predicates of the
  company register; ``read_company_register`` reads it from Parquet.
* ``load_raw_accounts``      – load the accounts into a catalog table once, with
  a completion record, clustered by year and company; ``force`` reloads.
* ``save_table``             – ``CREATE OR REPLACE TABLE`` sink with an
  optional partitioned / bucketed layout: written aside, then switched to.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Source column names of the company register and their names
# in the engine.
REGISTER_COLUMNS = {
    "siren": "siren",
    "activitePrincipaleUniteLegale": "code_naf",
    "denominationUniteLegale": "denomination",
    "categorieEntreprise": "categorie",
}


def read_accounts(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Accounts file, one row per filing. Schema as stored, or the given one
    (a declared schema skips footer inference over the file listing)."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as exc:  # keep a plain "missing input" error
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"accounts file not found: {path}") from exc
        raise


def company_register(register: DataFrame) -> DataFrame:
    """Register records with an activity code: renamed columns, rows with a
    company id and a code that is not blank after trimming spaces."""
    code = F.col("activitePrincipaleUniteLegale")
    return (register
            .where(F.col("siren").isNotNull() & code.isNotNull() & (F.trim(code) != F.lit("")))
            .select(*[F.col(src).alias(dst) for src, dst in REGISTER_COLUMNS.items()]))


REGISTER_SCHEMA = ", ".join(f"{src} STRING" for src in REGISTER_COLUMNS)


def read_company_register(spark: SparkSession, path: str) -> DataFrame:
    """Only the four register columns are read (declared schema, no footer
    inference); the null tests reach the scan."""
    return company_register(spark.read.schema(REGISTER_SCHEMA).parquet(path))


#: Order of the loaded accounts: a filter on the year reads only its row groups.
ACCOUNT_ORDER = ("annee", "siren")

#: Table property with the completion record of a load.
LOAD_RECORD = "ledgerlens.load"


def input_digest(spark: SparkSession, *paths: str) -> dict:
    """Number, bytes and a digest of the files under ``paths`` (names, sizes and
    times; one small aggregate over the listing, contents are not read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(list(paths)).select("path", "length", "modificationTime"))
    row = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                    F.expr("bit_xor(xxhash64(path, length, modificationTime))").alias("digest")).first()
    return {"files": row["files"], "bytes": row["bytes"] or 0, "digest": row["digest"] or 0}


def load_record(spark: SparkSession, table: str) -> dict | None:
    """The record of the load that filled ``table``'s present files, if that
    load came to its end."""
    shown = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == LOAD_RECORD).collect()
    record = json.loads(shown[0]["value"]) if shown else None
    return record if record and record["location"] == _table_facts(spark, table)["Location"] else None


def load_raw_accounts(spark: SparkSession, path: str, table: str = "raw_bilans",
                      force: bool = False, location: str | None = None,
                      refresh: bool = False,
                      writer_options: dict[str, str] | None = None) -> DataFrame:
    """Load the accounts file into catalog table ``table`` once (its files under
    ``location``, if given), in ranges of year and company, so that the
    statistics of files and row groups tell which of them hold a year.

    A missing file raises ``FileNotFoundError``. A loaded table is kept unless
    ``force`` is true, or ``refresh`` is and the input's files have changed.
    The last step of a load sets a record on the table: input files, their
    bytes and digest, rows and place. A table without the record of its present
    files, or with another number of rows, is a load that did not end, and is
    loaded again.
    """
    src = read_accounts(spark, path)
    if spark.catalog.tableExists(table) and not force:
        record = load_record(spark, table)
        if (record and (not refresh or record["input"] == input_digest(spark, path))
                and spark.table(table).count() == record["rows"]):
            return spark.table(table)
    found = input_digest(spark, path)
    loaded = save_table(src, table, path=location, options=writer_options,
                        range_by=[c for c in ACCOUNT_ORDER if c in src.columns])
    record = json.dumps({"input": found, "rows": loaded.count(),
                         "location": _table_facts(spark, table)["Location"]})
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LOAD_RECORD}' = '{record}')")
    return loaded


def _table_facts(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}  # metadata


def _layout(spark: SparkSession, table: str) -> tuple:
    facts = _table_facts(spark, table)
    columns = [(c.name, c.dataType, c.isPartition, c.isBucket)
               for c in spark.catalog.listColumns(table)]
    return columns, [facts.get(k) for k in ("Type", "Num Buckets", "Bucket Columns", "Sort Columns")]


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _delete_other_versions(spark: SparkSession, base: str, keep: set[str]) -> None:
    """Delete versions under ``base`` but those named in ``keep``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(hadoop):
        name = status.getPath().getName()
        if re.fullmatch(VERSION, name) and name not in keep:
            fs.delete(status.getPath(), True)


#: Names of the folders of a table's versions.
VERSION = "v-[0-9a-f]{32}"


def save_table(df: DataFrame, name: str, *, path: str | None = None,
               partition_by: list[str] | None = None,
               spread_by: list[str] | None = None, spread: int = 1,
               bucket_by: list[str] | None = None, buckets: int | None = None,
               sort_by: list[str] | None = None, range_by: list[str] | None = None,
               bloom: dict[str, int] | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """Replace table ``name`` with ``df`` and return the stored table.

    The rows are written to a folder of their own (a version) under ``path``, or
    under the warehouse without it; only when all are there, the table is set to
    that folder, in one step of the catalog where columns and layout are as
    before. A write that fails leaves the table as it was. The version before
    stays for those who still read it; earlier ones are deleted. Where columns
    or layout change, or the catalog keeps a list of partitions, the table's
    entry is dropped and made anew, its files written already: two steps, and a
    reader in between finds no table.

    ``bucket_by`` + ``buckets`` store the rows hash-clustered (and optionally
    sorted) on the key so that later joins and windows on that key read
    co-located data without a shuffle. ``partition_by`` gives directory
    pruning on low-cardinality filters such as the fiscal year.

    Rows are clustered before the write: one file per bucket, or ``spread``
    files (by hash of ``spread_by``) at most per partition value, however many
    tasks there are. ``range_by`` (for tables without buckets and partitions)
    stores rows in ranges of these columns, sorted; a value that many rows have
    goes over several ranges.

    ``bloom`` gives columns a Parquet Bloom filter in each row group, with the
    number of distinct values to expect there. ``options`` are further ones of
    the writer. Both are kept with the table, for later inserts.
    """
    spark = df.sparkSession
    if bucket_by:
        if not buckets:
            raise ValueError("bucket_by needs a bucket count")
        df = df.repartition(buckets, *bucket_by)  # the hash that assigns buckets
    elif partition_by:
        part = [F.pmod(F.hash(*spread_by), F.lit(spread))] if spread_by else []
        df = df.repartition(*[F.col(c) for c in partition_by], *part)
    elif range_by:
        df = df.repartitionByRange(*range_by, F.monotonically_increasing_id()).sortWithinPartitions(*range_by)
    version = f"v-{uuid.uuid4().hex}"
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions").rstrip("/")
    staged = f"{name}__{version[2:]}"
    writer = df.write.format("parquet").option("path", f"{base}/{version}").options(**(options or {}))
    for column, distinct in (bloom or {}).items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct)))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    try:
        writer.saveAsTable(staged)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        _delete(spark, f"{base}/{version}")
        raise
    _switch(spark, name, staged, base, version)
    return spark.table(name)


def _switch(spark: SparkSession, name: str, staged: str, base: str, version: str) -> None:
    """Let ``name`` be the table whose files are in ``base/version``."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        return
    before = _table_facts(spark, name)
    if _layout(spark, name) == _layout(spark, staged) and before.get("Partition Provider") != "Catalog":
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{base}/{version}'")
        spark.sql(f"DROP TABLE {staged}")  # its entry; the files stay
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    _delete_other_versions(spark, base, {version, before["Location"].rstrip("/").rsplit("/", 1)[-1]})
