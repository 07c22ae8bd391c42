"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints have 64 bits and link when at most ``radius`` differ. Each bit
gets a non-zero vector over GF(2) of ``radius + 1`` entries; each non-zero
vector v of that length is a table, whose mask keeps the bits with an odd
product with v. For any ``radius`` bits some v is orthogonal to all of their
vectors, so the mask of v keeps none of them: every pair within the radius
collides in some table, certainly and not just probably.

Equal fingerprints are one node from the start. Within a bucket, candidates
are compared by their differing bits, and a spanning forest of the links is
emitted, not all pairs. A bucket of more than BUCKET_AT_ONCE fingerprints is
covered anew on the bits that its mask leaves out: its masks of the second
level keep about half of those, so that at most 2^19 fingerprints can
meet there, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (LOCATOR, locators, map_batches, store, text_slices, whole_text,
                     with_locator)
from .components import connected_components

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 3
HASH_SEED = 42
#: Fingerprints of a bucket that are compared as they are.
BUCKET_AT_ONCE = 2048
#: Shingles whose bits are counted at once.
_SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """A bit is set where it is set in over half of the shingles' hashes."""
    words = text.encode().lower().split()  # bytes: A-Z and the six separators only
    if not words:
        return 0
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    shingles = zip(*(words[i:] for i in range(k)))
    hashes = np.array([digest(b" ".join(s), seed) for s in shingles], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[at:at + _SHINGLES_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                 seed: int = HASH_SEED) -> DataFrame:
    """``docs`` (text is its second column) with the text replaced by ``fp``,
    the fingerprint as a signed long; a null text is empty."""
    fields = [f for i, f in enumerate(docs.schema.fields) if i != 1]
    names = [f.name for f in fields]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [c for i, c in enumerate(batch.columns) if i != 1]
            for at, texts in text_slices(batch):
                found = np.array([fingerprint(t, shingle_words, seed) for t in texts],
                                 dtype=np.uint64)
                yield pa.record_batch([*(c.slice(at, len(texts)) for c in rest),
                                       pa.array(found.view(np.int64))], [*names, "fp"])

    return map_batches(docs, run, f"{kinds}, fp long")


#: How the two levels deal the vectors to the bits: step in a row of vectors,
#: and shift from row to row.
FIRST_DEAL, SECOND_DEAL = (1, 0), (5, 6)


def covering_masks(radius: int, bits: int = BITS,
                   deal: tuple[int, int] = FIRST_DEAL) -> list[int]:
    """One mask for each non-zero vector of ``radius + 1`` bits."""
    vectors = (1 << radius + 1) - 1
    step, shift = deal
    deal = [(i % vectors * step + i // vectors * shift) % vectors + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (deal[i] & v).bit_count() % 2)
            for v in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> BITS - 1 else mask


def _table_rows(nodes: DataFrame, masks: Column) -> DataFrame:
    """A row (tab, key, fp) for each fingerprint and mask."""
    return nodes.select("fp", F.posexplode(masks).alias("tab", "mask")).select(
        "tab", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within the radius, one fewer than nodes."""
    links, open_ = [], fps
    while len(open_) > 1:
        ends, open_ = [open_[0]], open_[1:]
        while ends and len(open_):
            near = np.bitwise_count(open_ ^ ends[-1]) <= radius
            end = ends.pop()
            if near.any():
                reached = open_[near]
                links.extend((end, other) for other in reached)
                ends.extend(reached)
                open_ = open_[~near]
    return links


def _bucket_links(radius: int, limit: int | None) -> Callable:
    """Of rows (tab, key, fp) sorted by bucket: links (a, b, null) within each
    bucket; rows of a bucket over the limit are handed on (fp, null, tab)."""
    def emit(a, b, tab) -> pa.RecordBatch:
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                pa.array(tab, pa.int32())], ["a", "b", "tab"])

    def links_of(bucket: np.ndarray) -> pa.RecordBatch | None:
        found = np.array(_forest(bucket, radius), dtype=np.uint64).view(np.int64)
        if len(found):
            return emit(found[:, 0], found[:, 1], pa.nulls(len(found), pa.int32()))
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the bucket that is still open
        here, size, over = None, 0, False

        def hand_on():
            nonlocal held
            fps = np.concatenate(held).view(np.int64)
            held = []
            return emit(fps, pa.nulls(len(fps), pa.int64()), np.full(len(fps), here[0]))

        for batch in batches:
            tab, key, fp = (batch.column(i).to_numpy() for i in range(3))
            if not len(tab):
                continue
            fp = fp.view(np.uint64)
            edges = np.flatnonzero((np.diff(tab) != 0) | (np.diff(key) != 0)) + 1
            starts, stops = [0, *edges.tolist()], [*edges.tolist(), len(tab)]
            for start, stop in zip(starts, stops):
                bucket = (int(tab[start]), int(key[start]))
                if bucket != here:
                    if over:
                        if held:
                            yield hand_on()
                    elif size > 1 and (out := links_of(np.concatenate(held))) is not None:
                        yield out
                    here, held, size, over = bucket, [], 0, False
                held.append(fp[start:stop])
                size += stop - start
                over = limit is not None and size > limit
                if over:
                    yield hand_on()
        if over:
            if held:
                yield hand_on()
        elif size > 1 and (out := links_of(np.concatenate(held))) is not None:
            yield out

    return run


def near_links(nodes: DataFrame, radius: int = RADIUS,
               at_once: int = BUCKET_AT_ONCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` of ``nodes``: their
    components are those of all pairs that differ in at most ``radius`` bits."""
    first, second = covering_masks(radius), covering_masks(radius, deal=SECOND_DEAL)
    kind = "a long, b long, tab int"

    def compare(rows: DataFrame, limit: int | None) -> DataFrame:
        return map_batches(rows.repartition("tab", "key").sortWithinPartitions("tab", "key"),
                           _bucket_links(radius, limit), kind)

    masks = F.array(*(F.lit(_signed(m)) for m in first))
    level1 = store(compare(_table_rows(nodes, masks), at_once), "near")
    finer = F.array(*(F.array(*(F.lit(_signed(m | n)) for n in second)) for m in first))
    crowded = level1.where("tab is not null").select(F.col("a").alias("fp"), "tab")
    inner = crowded.select("fp", F.posexplode(finer[F.col("tab")]).alias("inner", "mask"), "tab")
    level2 = compare(inner.select((F.col("tab") * len(second) + F.col("inner")).alias("tab"),
                                  F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"), None)
    return level1.where("tab is null").select("a", "b").unionAll(level2.select("a", "b"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    seed: int = HASH_SEED, at_once: int = BUCKET_AT_ONCE) -> DataFrame:
    """Fingerprint and component of every row of ``docs`` (columns doc_id and
    text; others ignored). Rows that with_locator() has located keep their
    locators.

    Returns doc_id, locator, fp (signed long), component_id (least doc_id that
    links reach; null only if all of them are null) and kept (true for one row
    of a component: the least doc_id, the first in storage among equal ones; a
    row without doc_id stays only where no row has one). A null text is empty;
    texts without words have fingerprint zero and link like any other. An empty
    table gives no rows.
    """
    located = locators(docs).select("doc_id", whole_text().alias("text"), "locator")
    marked = store(fingerprints(located, shingle_words, seed), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "locator"))
    nodes = store(marked.groupBy("fp").agg(first.alias("first")), "nodes")
    links = near_links(nodes.select("fp"), radius, at_once)
    roots = connected_components(links)
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    least = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "stays")
    return marked.join(classes, "fp").select(
        "doc_id", "locator", "fp", F.col("stays.doc_id").alias("component_id"),
        (F.col("locator") == F.col("stays.locator")).alias("kept"))


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                     radius: int = RADIUS) -> DataFrame:
    """One row of every component, with all its columns and no others.

    Null and empty texts have the fingerprint zero and link like any other; of
    repeated rows one stays; texts are read whole; an empty table gives no
    rows."""
    located = with_locator(docs)
    gone = near_duplicates(located, shingle_words, radius).where("not kept").select(
        F.col("locator").alias("_ll_gone"))
    return located.join(gone, F.col(LOCATOR) == F.col("_ll_gone"), "left_anti").drop(LOCATOR)
