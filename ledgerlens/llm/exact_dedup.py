"""Exact deduplication by a stateful stream.

Documents arrive as a stream of (digest, identifier, content locator). The
stream's keyed state is on disk (RocksDB), never expires, and keeps for each
digest the row that stays and the number of arrivals. A digest that was hit
more than once is a claim, not a proof: the full bytes of its rows are read
again and compared, and rows whose bytes differ are classed by their bytes.

Hot groups: the state update is preceded by a partial aggregation in every
map task, so a text with very many copies sends one row per task, and byte
checks deal the rows of the largest groups over many tasks. The joins back to
the rows are plain sort merge joins, which adaptive execution splits where a
key is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hits import keep_hits
from .common import (LOCATOR, locators, path_exists, shared_path, store, whole_text,
                     with_locator)

#: Groups, the largest first, whose rows are dealt over many tasks.
HOT_GROUPS = 1000
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # many small stores: no disk set aside for files not written yet
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def run_dedup_stream(arrivals: DataFrame, arrivals_path: str, state_path: str,
                     files_per_trigger: int = 4096) -> DataFrame:
    """Feed the stored ``arrivals`` not consumed yet to the stream and return
    its state: digest, keeper (doc_id, locator) and group_size.

    ``state_path`` is the stream's checkpoint: calling again after more files
    have arrived, or after a crash, goes on where the last commit ended.
    """
    spark = arrivals.sparkSession
    with _state_on_disk(spark):
        stream = (spark.readStream.schema(arrivals.schema)
                  .option("maxFilesPerTrigger", files_per_trigger).parquet(arrivals_path))
        kept = stream.groupBy("digest").agg(
            F.max(F.struct("doc_id", "locator")).alias("keeper"),
            F.count(F.lit(1)).alias("group_size"))
        query = (kept.writeStream.format("noop").outputMode("update")
                 .option("checkpointLocation", state_path)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if not path_exists(spark, f"{state_path}/state"):  # no file has arrived yet
            return spark.createDataFrame([], kept.schema)
        state = spark.read.format("statestore").load(state_path)
        return (state.select("key.*", "value.*").toDF("digest", "keeper", "group_size"))


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest,
                files_per_trigger: int = 4096) -> DataFrame:
    """Class of every row of ``docs`` (columns doc_id and text; others ignored).
    Rows that with_locator() has located keep their locators.

    Returns one row per input row: doc_id, locator, digest, keep_id, group_size,
    kept. Texts are equal when their bytes are equal; a null text is empty. Of
    equal texts the row with the largest doc_id stays; rows that repeat that
    doc_id are ordered by their place in storage, so exactly one stays. A null
    doc_id is smaller than any other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    located = locators(docs).select(
        "doc_id", "locator", digest(whole_text()).alias("digest"), whole_text().alias("text"))
    arrivals_path = shared_path(spark, "arrivals")
    narrow = located.drop("text")
    narrow.write.parquet(arrivals_path)
    arrivals = spark.read.schema(narrow.schema).parquet(arrivals_path)
    if arrivals.isEmpty():
        return arrivals.select(
            "doc_id", "locator", "digest", F.col("doc_id").alias("keep_id"),
            F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"))

    state = store(run_dedup_stream(arrivals, arrivals_path, shared_path(spark, "dedup-state"),
                                   files_per_trigger), "dedup-keepers")
    differing = store(_differing_bytes(located, state), "dedup-differing")
    if differing.isEmpty():
        return _classed(arrivals, state, ["digest"])
    clashing = located.join(differing, "digest", "left_semi")
    keepers = clashing.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "locator")).alias("keeper"),
        F.count(F.lit(1)).alias("group_size"))
    return _classed(arrivals.join(differing, "digest", "left_anti"), state, ["digest"]).unionByName(
        _classed(clashing, keepers, ["digest", "text"]))


def _differing_bytes(located: DataFrame, state: DataFrame) -> DataFrame:
    """Digests hit more than once whose rows don't all have the same bytes.

    The rows of the HOT_GROUPS largest groups are dealt over many tasks and
    compared there, then the least and greatest text of each; any other group
    has at most one row in HOT_GROUPS of all. Texts that were met once are left
    out below the exchange, but for a few that a bitmap of fixed size lets pass.
    """
    salts = int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = state.where("group_size > 1").select("digest", "group_size")
    hot = F.broadcast(  # at most HOT_GROUPS digests
        hits.orderBy(F.desc("group_size"), "digest").limit(HOT_GROUPS)
        .select("digest", F.lit(True).alias("hot")))
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    wanted = (hits.join(hot, "digest", "left").select("digest", F.explode(
        F.when(F.col("hot"), all_salts).otherwise(F.array(F.lit(0)))).alias("salt")))
    hit_rows = keep_hits(located.select("digest", "text", "locator"), hits, "digest")
    rows = (hit_rows.join(hot, "digest", "left").select(
        "digest", "text", F.when(F.col("hot"), F.pmod(F.xxhash64("locator"), F.lit(salts)))
        .otherwise(0).cast("int").alias("salt")))
    parts = (rows.join(wanted, ["digest", "salt"], "left_semi").groupBy("digest", "salt")
             .agg(F.min("text").alias("low"), F.max("text").alias("high")))
    return (parts.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high"))
            .where("low != high").select("digest"))


def _classed(rows: DataFrame, keepers: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(keepers, on).select(
        "doc_id", "locator", "digest", F.col("keeper.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("keeper.locator")).alias("kept"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and no others.

    A null text equals an empty one; of repeated rows, those with equal ids
    included, one stays; whole texts are compared; an empty table gives no
    rows."""
    located = with_locator(docs)
    gone = exact_dedup(located).where("not kept").select(F.col("locator").alias("_ll_gone"))
    return located.join(gone, F.col(LOCATOR) == F.col("_ll_gone"), "left_anti").drop(LOCATOR)
