"""Jaccard join of documents on word n-grams by token-combination prefixes.

A document is the set of its n-grams' hashes. All sets are sorted in one order,
rare tokens first. Two sets that link share so many tokens that those of a
prefix are among them: of a set of n tokens that may differ in tau of them from
a partner, a prefix of p has at least p - tau in common with the partner's.
Rare tokens are indexed one by one. Frequent ones fall into classes and are
indexed as pairs within their class, so that a class may hold one common token
without a common pair; the prefix is extended by one token for each such class
that occurs in it. What is counted as common beyond that is a rare token or a
pair of one class, and the two sets meet there (pigeonhole). The number of
classes follows the size of the sets, in octaves, so that combinations grow with
the prefix and not with its square; a set near the lower end of an octave is
indexed for the octave below as well.

How frequent a token is comes from a sketch of counters over the whole corpus.
Any order and any classes give the same links; a bad sketch costs time only.

Sets that meet are compared by parity bitmaps first (bits that differ are at
most the tokens that differ), then token by token. In a bucket of more than a
few sets not all links are asked for at first, but a forest of likely ones; once
those are verified, the sets of different components that could still link are
compared, so that no component is missed and none is spelled out in pairs.
Buckets beyond CHUNK sets are dealt to several tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hits import keep_hits
from .common import locators, map_batches, store, text_slices, whole_text
from .components import connected_components

SHINGLE_WORDS = 3
PERCENT = 90
#: Tokens that share a counter of the sketch on average, and the sketch's bounds (bits of its size).
LOAD, LEAST_BITS, MOST_BITS = 8, 16, 25
_SLICE_BITS = 16
#: Classes of frequent tokens: one for every so many tokens of a set.
TOKENS_A_CLASS = 16
#: Buckets of at most SMALL sets are compared whole at once; larger ones by
#: forests, in chunks of about CHUNK.
SMALL, CHUNK = 8, 4096
_FOLD = 4  # longs of the bitmaps in buckets
_WORDS_KEPT = 1 << 18
_TOKENS_AT_ONCE = 1 << 20
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class _WordHashes(dict):
    """Hashes of words, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokens_of(text: str, hashes: dict, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of ``size`` words; of fewer words,
    of the whole sequence; none without words."""
    words = text.encode().lower().split()  # bytes: A-Z and the six separators only
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(size, len(w))
    grams = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):  # a place and a length have their own multiplier
        grams = grams * np.uint64(_ODD[0]) + _mix(w[i:len(w) - k + 1 + i] + np.uint64(_ODD[1] * (i + 1) % (1 << 64)))
    return np.unique(_mix(grams))


def _at_least(percent: int, n: int) -> int:
    return -(-percent * n // 100)


def most_differing(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Tokens in one only of two linked sets of a and b tokens, at most."""
    return a + b - 2 * -(-percent * (a + b) // (100 + percent))


# ---- sketch of frequencies --------------------------------------------------

def _sketch_bits(docs: DataFrame) -> int:
    chars = docs.agg(F.sum(F.length(whole_text()))).first()[0] or 0
    wanted = math.ceil(math.log2(max(1, chars / 6 / LOAD)))  # some six characters a word
    return min(MOST_BITS, max(LEAST_BITS, wanted))


def frequency_codes(docs: DataFrame, size: int, bits: int) -> tuple[np.ndarray, int]:
    """For each of 2^bits classes of hashes, 8 * log2(1 + tokens in it) as a
    byte, and the code from which on tokens count as frequent. Every token of
    every document counts once a document, up to 255 a task."""
    width = 1 << min(bits, _SLICE_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total, held, n = _WordHashes(), np.zeros(1 << bits, np.uint8), [], 0

        def add():
            at, times = np.unique(np.concatenate(held) >> np.uint64(64 - bits), return_counts=True)
            at = at.astype(np.int64)
            total[at] = np.minimum(total[at] + times, 255)

        for batch in batches:
            for _, texts in text_slices(batch, 0):
                for text in texts:
                    held.append(tokens_of(text, hashes, size))
                    n += len(held[-1])
                    if n >= _TOKENS_AT_ONCE:
                        add()
                        held, n = [], 0
        if held:
            add()
        for i in range(0, len(total), width):
            part = total[i:i + width]
            if part.any():
                yield pa.record_batch([pa.array([i // width], pa.int32()),
                                       pa.array([zlib.compress(part, 1)], pa.binary())], ["slice", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # a task's slices
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
                sums[k] = sums.get(k, np.zeros(width, np.int64)) + part
        for k, s in sums.items():
            codes = np.minimum(255, np.floor(8 * np.log2(1.0 + s))).astype(np.uint8)
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([codes.tobytes()], pa.binary()),
                                   pa.array([int(s.sum())])], ["slice", "codes", "n"])

    parts = map_batches(docs.select(whole_text().alias("text")), count, "slice int, counts binary")
    rows = map_batches(parts.repartition("slice"), merge,
                       "slice int, codes binary, n long").collect()  # 2^bits bytes in all
    codes = np.zeros(1 << bits, np.uint8)
    for r in rows:
        codes[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["codes"], np.uint8)
    load = sum(r["n"] for r in rows) / (1 << bits)
    return codes, int(min(255, 8 * math.log2(17 + load + 4 * math.sqrt(load))))


# ---- signatures -------------------------------------------------------------

def _pairs_within(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i before j, of all pairs of equal entries of ``kind``."""
    order = np.argsort(kind, kind="stable")
    k, left, right, step = kind[order], [], [], 1
    while step < len(k):
        same = np.flatnonzero(k[step:] == k[:-step])
        if not len(same):
            break
        left.append(order[same])
        right.append(order[same + step])
        step += 1
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def signatures(tokens: np.ndarray, codes: np.ndarray, frequent: int, percent: int) -> np.ndarray:
    """Signatures of a set (sorted hashes, and their frequency codes): any two
    sets that link have one in common, unless they are equal."""
    n = len(tokens)
    least = _at_least(percent, n)
    if least == n and 100 * n // percent == n and 100 * (n - 1) < percent * (n + 1):
        return np.zeros(0, np.uint64)  # only an equal set is near enough
    spare = n - least
    order = np.argsort(codes, kind="stable")  # by code, then hash
    ranked, often = tokens[order], codes[order] >= frequent
    octave = n.bit_length() - 1
    found, singles = [], 0
    for band in [octave] + [octave - 1] * (least < 1 << octave and octave > 0):
        classes = max(1, (1 << band) // TOKENS_A_CLASS)
        kind = np.where(often, (ranked % np.uint64(classes)).astype(np.int64), -1)
        _, first = np.unique(kind, return_index=True)
        counts = np.ones(n, np.int64)
        counts[first[kind[first] >= 0]] = 0  # a class may have this one without a pair
        stop = int(np.searchsorted(np.cumsum(counts), spare + 1)) + 1
        singles = max(singles, stop)
        inside = np.flatnonzero(often[:stop])
        i, j = _pairs_within(kind[inside])
        a, b = ranked[inside[i]], ranked[inside[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        found.append(_mix(low * np.uint64(_ODD[0]) + _mix(high + np.uint64(band + 1))))
    rare = ranked[:singles][~often[:singles]]
    return np.unique(np.concatenate([_mix(rare ^ np.uint64(_ODD[2])), *found]))


def parity_bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bits that an odd number of tokens falls on; a power of two of longs, at
    least _FOLD and about a bit for every two tokens."""
    longs = _FOLD
    while longs * 128 < len(tokens):
        longs *= 2
    at = (tokens >> np.uint64(20)) % np.uint64(longs * 64)
    odd = np.bincount(at.astype(np.int64), minlength=longs * 64) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _fingerprints(docs: DataFrame, size: int, percent: int, codes, frequent: int, bits: int) -> DataFrame:
    """doc_id and locator of ``docs`` with n (tokens), key (digest of the set,
    null if empty), sigs, bitmap and fold (the bitmap folded to _FOLD longs)."""
    fields = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in fields]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    at = docs.columns.index("text")

    def longs(rows: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, rows)], dtype=np.int64).astype(np.int32)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(ends, pa.array(flat.view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table = _WordHashes(), codes.value
        for batch in batches:
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            for start, texts in text_slices(batch, at):
                n, key, sigs, bitmaps, folds = [], [], [], [], []
                for text in texts:
                    tokens = tokens_of(text, hashes, size)
                    n.append(len(tokens))
                    key.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                    own = table[(tokens >> np.uint64(64 - bits)).astype(np.int64)]
                    sigs.append(signatures(tokens, own, frequent, percent) if len(tokens) else tokens)
                    bitmaps.append(parity_bitmap(tokens))
                    folds.append(np.bitwise_xor.reduce(bitmaps[-1].reshape(-1, _FOLD), axis=0))
                yield pa.record_batch([*(c.slice(start, len(texts)) for c in rest), pa.array(n, pa.int64()),
                                       pa.array(key, pa.binary()), longs(sigs), longs(bitmaps), longs(folds)],
                                      [*names, "n", "key", "sigs", "bitmap", "fold"])

    return map_batches(docs, run, f"{kinds}, n long, key binary, sigs array<long>, "
                                  "bitmap array<long>, fold array<long>")


# ---- comparison within buckets ----------------------------------------------

class _Rows:
    """Rows of buckets as arrays: what may link by size, bitmap and component."""

    def __init__(self, columns: list[np.ndarray], percent: int):
        self.n, self.node, self.label, self.part = columns[:4]
        self.bits = [c.view(np.uint64) for c in columns[4:]]
        self.percent = percent

    def near(self, i, j) -> np.ndarray:
        a, b = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        differ = sum(np.bitwise_count(c[i] ^ c[j]).astype(np.int64) for c in self.bits)
        return ((differ <= most_differing(a, b, self.percent)) & (100 * a >= self.percent * b)
                & (self.label[i] != self.label[j]))


def _whole_buckets(rows: _Rows, group: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Likely links of small buckets: each row with the next, the next but one, ..."""
    found, step = [], 1
    while True:
        i = np.flatnonzero(group[step:] == group[:-step]) if step < len(group) else []
        if not len(i):
            return found
        i = i[rows.near(i, i + step)]
        found.append((rows.node[i], rows.node[i + step]))
        step += 1


def _forest(rows: _Rows, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the likely links between the rows ``at``."""
    found, open_ = [], at
    while len(open_) > 1:
        ends, open_ = [open_[0]], open_[1:]
        while ends and len(open_):
            end = ends.pop()
            near = rows.near(end, open_)
            if near.any():
                reached, open_ = open_[near], open_[~near]
                found.append((np.full(len(reached), rows.node[end]), rows.node[reached]))
                ends.extend(reached)
    return found


def _all_likely(rows: _Rows, at: np.ndarray, crossed: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """All likely links between the rows ``at``; crossed: of unequal parts."""
    found = []
    for place, i in enumerate(at):
        others = at[place + 1:]
        if crossed:
            others = others[rows.part[others] != rows.part[i]]
        near = others[rows.near(i, others)]
        if len(near):
            found.append((np.full(len(near), rows.node[i]), rows.node[near]))
    return found


def _scan_buckets(percent: int, small: int, forest: bool):
    """Of rows (sig, low, high, n, node, label, part, bits ...) sorted by the
    first three, a bucket's cell: likely links (a, b)."""
    def links(columns: list[np.ndarray]) -> pa.RecordBatch | None:
        rows = _Rows(columns[3:], percent)
        edge = np.any([np.diff(c) != 0 for c in columns[:3]], axis=0)
        group = np.concatenate([[0], np.cumsum(edge)])
        sizes = np.bincount(group)
        found: list = []
        if (few := np.flatnonzero(sizes[group] <= small)).size:
            part = _Rows([c[few] for c in columns[3:]], percent)
            found += _whole_buckets(part, group[few])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        for g in np.flatnonzero(sizes > small):
            at = np.arange(starts[g], starts[g + 1])
            crossed = columns[1][at[0]] != columns[2][at[0]]
            found += _forest(rows, at) if forest else _all_likely(rows, at, crossed)
        found = [f for f in found if len(f[0])]
        if not found:
            return None
        a, b = (np.concatenate(side) for side in zip(*found))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # ends with a cell that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            last = held[-1]
            if all(c[0] == c[-1] for c in last[:3]):
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            edge = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns[:3]], axis=0))[-1] + 1
            if (out := links([c[:edge] for c in columns])) is not None:
                yield out
            held = [[c[edge:] for c in columns]]
        if held and (out := links([np.concatenate(c) for c in zip(*held)])) is not None:
            yield out

    return run


def _likely_links(rows: DataFrame, percent: int, small: int, forest: bool) -> DataFrame:
    cells = rows.select("sig", "low", "high", "n", "node", "label", "part",
                        *(F.get("fold", F.lit(i)).alias(f"b{i}") for i in range(_FOLD)))
    dealt = cells.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")
    return map_batches(dealt, _scan_buckets(percent, small, forest), "a long, b long").distinct()


# ---- verification -----------------------------------------------------------

def _node_sets(nodes: DataFrame, wanted: DataFrame, located: DataFrame, size: int) -> DataFrame:
    """``node`` and ``tokens`` of the wanted nodes, from their texts."""
    places = store(nodes.join(wanted, "node", "left_semi").select("locator", "node"), "wanted-texts")
    texts = keep_hits(located.select("locator", "text"), places, "locator").join(places, "locator")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for at, found in text_slices(batch):
                sets = [tokens_of(t, hashes, size).view(np.int64) for t in found]
                yield pa.record_batch([batch.column(0).slice(at, len(found)),
                                       pa.array(sets, pa.list_(pa.int64()))], ["node", "tokens"])

    return store(map_batches(texts.select("node", "text"), run, "node long, tokens array<long>"), "sets")


def _verified(likely: DataFrame, nodes: DataFrame, located: DataFrame, size: int,
              percent: int) -> DataFrame:
    """The likely links (a, b) that are links: by whole bitmaps, then by tokens."""
    def sides(pairs: DataFrame, table: DataFrame, *cols: str) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(table.select(F.col("node").alias(end), *(
                F.col(c).alias(f"{c}_{end}") for c in cols)), end)
        return pairs

    # bitmaps of linked sets are of one size, or one is twice the other's
    differ = F.expr("""aggregate(zip_with(
        IF(size(bitmap_a) > size(bitmap_b), zip_with(slice(bitmap_a, 1, size(bitmap_b)),
           slice(bitmap_a, size(bitmap_b) + 1, size(bitmap_b)), (x, y) -> x ^ y), bitmap_a),
        IF(size(bitmap_b) > size(bitmap_a), zip_with(slice(bitmap_b, 1, size(bitmap_a)),
           slice(bitmap_b, size(bitmap_a) + 1, size(bitmap_a)), (x, y) -> x ^ y), bitmap_b),
        (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)""")
    most = F.expr(f"n_a + n_b - 2 * (({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent})")
    pairs = store(sides(likely, nodes, "n", "bitmap").where(differ <= most)
                  .select("a", "b", "n_a", "n_b"), "pairs")
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    sets = _node_sets(nodes, ends, located, size)
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return sides(pairs, sets, "tokens").withColumn("both", both).where(
        100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


# ---- the join ---------------------------------------------------------------

def _members(nodes: DataFrame) -> DataFrame:
    """Rows (sig, size, node, n, fold) of the signatures that several sets have."""
    rows = nodes.select(F.explode("sigs").alias("sig"), "node", "n", "fold")
    shared = store(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).where("size > 1"),
                   "shared-signatures")
    return store(keep_hits(rows, shared, "sig").join(shared, "sig"), "members")


def ngram_join(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
               small: int = SMALL, chunk: int = CHUNK, bits: int | None = None) -> DataFrame:
    """Components of the documents (columns doc_id and text; others ignored)
    whose sets of word n-grams have a Jaccard similarity of ``percent`` or more.

    Returns a row for each row of ``docs``: doc_id, locator, n_shingles and
    component_id, the least doc_id that links reach (null only if all of them
    are null). A text without words, or null, has an empty set, links with
    nothing and is its own component. Equal sets are one node from the start, so
    copies and repeated rows cost no comparisons. Texts are read whole, whatever
    their length. An empty table gives no rows. N-grams are compared by 64-bit
    hashes; two different ones of two documents count as equal with a chance of
    2^-64. ``bits`` sets the sketch's size; without it the corpus does.
    """
    spark = docs.sparkSession
    located = locators(docs).select("doc_id", whole_text().alias("text"), "locator")
    bits = _sketch_bits(located) if bits is None else bits
    codes, frequent = frequency_codes(located, shingle_words, bits)
    sketch = spark.sparkContext.broadcast(codes)  # 2^MOST_BITS bytes at most
    marked = store(_fingerprints(located, shingle_words, percent, sketch, frequent, bits), "ngram-sets")
    grouped = marked.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min("locator").alias("locator"), F.first("n").alias("n"),
        F.first("sigs").alias("sigs"), F.first("bitmap").alias("bitmap"), F.first("fold").alias("fold"))
    nodes = store(grouped.withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")
    members = _members(nodes)

    one = F.pmod(F.xxhash64("node", "sig"), F.ceil(F.col("size") / chunk)).cast("long")
    first = members.select("*", one.alias("low"), one.alias("high"), one.alias("part"),
                           F.col("node").alias("label"))
    links = store(_verified(_likely_links(first, percent, small, True), nodes, located,
                            shingle_words, percent), "links")
    more = _links_between(members.where(F.col("size") > small), connected_components(links), one, chunk)
    links = links.unionAll(_verified(_likely_links(more, percent, 1, False), nodes, located,
                                     shingle_words, percent))
    roots = connected_components(links)
    rooted = nodes.select("key", "node", "least").join(roots, "node", "left").select(
        "key", "least", F.coalesce("root", "node").alias("root"))
    classes = rooted.select("key", "root").join(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").drop("root")
    return marked.select("doc_id", "locator", "n", "key").join(classes, "key", "left").select(
        "doc_id", "locator", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
         .alias("component_id"))


def _links_between(members: DataFrame, roots: DataFrame, one, chunk: int) -> DataFrame:
    """Rows of the buckets that still hold several components, dealt to cells:
    each chunk of a bucket meets itself and every other."""
    labelled = store(members.join(roots, "node", "left").select(
        *members.columns, F.coalesce("root", "node").alias("label")), "labelled")
    mixed = labelled.groupBy("sig").agg(F.min("label").alias("from"), F.max("label").alias("to")).where(
        F.col("from") != F.col("to")).select("sig")
    rows = labelled.join(mixed, "sig", "left_semi").withColumn("part", one)
    others = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / chunk).cast("long") - 1)
    return (rows.withColumn("other", F.explode(others))
            .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")))
