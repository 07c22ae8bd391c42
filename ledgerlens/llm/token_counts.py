"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once and only their lengths go on, counted by each task
before the shuffle. Every later answer is a sum over the histogram: with N(L)
and T(L) the number and the tokens of documents longer than L, a context limit
L leaves total - T(L) + L * N(L) tokens, and quantiles are lengths at which
the counts from the top cross a share of all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, store, text_slices, whole_text
from .vocabulary import DEFAULT_TOKENIZER, encoder

QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)
#: Lengths whose sums from the top one task makes.
LENGTHS_AT_ONCE = 64


def length_histogram(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``length``, ``n_docs``: how many rows of ``docs`` (column text; others
    ignored) encode to each number of tokens, without special tokens. A null
    text is empty and has length 0. An empty table gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, added_tokens=True)
        for batch in batches:
            counts: Counter[int] = Counter()
            for _, texts in text_slices(batch, col=0):
                counts.update(len(ids) // 4 for ids in own.encode(texts))
            yield pa.record_batch([pa.array(list(counts), pa.int64()),
                                   pa.array(list(counts.values()), pa.int64())],
                                  ["length", "n_docs"])
    lengths = map_batches(docs.select(whole_text().alias("text")), run,
                          "length long, n_docs long")
    return lengths.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length of ``histogram``: ``docs_longer`` and ``tokens_longer``,
    the number and tokens of documents of greater length, and the totals.

    Blocks of lengths are summed first, then the blocks (a row for each
    LENGTHS_AT_ONCE lengths), then the lengths in each block, so the sums from
    the top are made by many tasks.
    """
    rows = histogram.withColumn("block", F.floor(F.col("length") / LENGTHS_AT_ONCE)).withColumn(
        "tokens", F.col("length") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(above), zero).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), zero).alias("tokens_above"),
        F.sum("d").over(whole).alias("total_docs"), F.sum("t").over(whole).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.join(blocks, "block").select(
        "length", "n_docs",
        (F.col("docs_above") + F.coalesce(F.sum("n_docs").over(inside), zero)).alias("docs_longer"),
        (F.col("tokens_above") + F.coalesce(F.sum("tokens").over(inside), zero)
         ).alias("tokens_longer"), "total_docs", "total_tokens")


def context_limits(sums: DataFrame) -> DataFrame:
    """What each length leaves as a context limit. Between two lengths a limit
    L has the same ``docs_longer`` and ``tokens_longer`` as the lower one."""
    return sums.withColumn("tokens_within", F.col("total_tokens") - F.col("tokens_longer")
                           + F.col("length") * F.col("docs_longer"))


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: documents cut and tokens left by any ``limit``; nulls for an
    empty histogram."""
    longer = F.col("length") > limit
    tokens = F.col("length") * F.col("n_docs")
    return sums.agg(
        F.sum(F.when(longer, F.col("n_docs")).otherwise(0)).alias("docs_longer"),
        F.sum(F.when(longer, F.col("n_docs") * limit).otherwise(tokens)).alias("tokens_within"))


def length_quantiles(sums: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """``quantile``, ``length``: the least length that at least that share of
    the documents does not exceed. An empty histogram gives no rows."""
    wanted = F.explode(F.array(*(F.lit(float(q)) for q in quantiles)))
    return (sums.withColumn("quantile", wanted)
            .where(F.col("total_docs") - F.col("docs_longer")
                   >= F.ceil(F.col("quantile") * F.col("total_docs")))
            .groupBy("quantile").agg(F.min("length").alias("length")))


def token_counts(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER,
                 quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """The answers for all of ``docs``: a row for every length that occurs,
    read as a context limit, with ``quantiles`` holding the shares (comma
    joined, ascending; empty if none) whose quantile the length is.

    A null or empty text has length 0 and counts as a document, repeated rows
    count each, ids are not looked at, other columns are ignored, texts are
    encoded whole, and an empty table gives no rows."""
    sums = store(suffix_sums(store(length_histogram(docs, tokenizer), "lengths")), "suffix-sums")
    at = length_quantiles(sums, quantiles).groupBy("length").agg(
        F.array_join(F.sort_array(F.collect_list("quantile")), ",").alias("quantiles"))
    return context_limits(sums).join(at, "length", "left").select(
        F.col("length").alias("context_limit"), "n_docs", "docs_longer", "tokens_longer",
        "tokens_within", "total_docs", "total_tokens",
        F.coalesce("quantiles", F.lit("")).alias("quantiles"))
