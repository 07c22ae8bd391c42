"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

#: Column that with_locator() adds.
LOCATOR = "_ll_locator"
#: Rows of a batch that are turned into Python strings at once.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text as a string; a null text counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, survives lost executors, and keeps column pruning."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the stored table behind ``df`` once nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def with_locator(docs: DataFrame) -> DataFrame:
    """``docs`` and a locator of each row: file and row number in the file.

    Rows that don't come straight from files are written to the shared folder
    first, so the locator always leads back to the same stored bytes.
    """
    def locate(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        return df.withColumn(LOCATOR, F.struct(meta["file_path"].alias("file"),
                                               meta["row_index"].alias("row")))
    try:
        out = locate(docs)
        out.schema  # analysis happens here
        return out
    except AnalysisException:
        return locate(store(docs, "located"))


def locators(docs: DataFrame) -> DataFrame:
    """doc_id, text and locator of ``docs``, which may be located already."""
    if LOCATOR not in docs.columns:
        docs = with_locator(docs.select("doc_id", "text"))
    return docs.select("doc_id", "text", F.col(LOCATOR).alias("locator"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``df.mapInArrow`` in workers that can import this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_slices(batch: pa.RecordBatch, col: int = 1) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch in short runs: (first row, texts)."""
    column = batch.column(col)
    for at in range(0, len(column), ROWS_AT_ONCE):
        yield at, column.slice(at, ROWS_AT_ONCE).to_pylist()
