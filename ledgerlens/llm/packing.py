"""Best-fit packing of documents into sequences by bin completion.

Pieces of equal length are interchangeable, so the search runs on the
histogram of piece lengths (at most ``capacity`` rows, whatever the corpus):
a plan is a list of patterns, each a filling repeated some number of times.
Spark encodes the documents, counts lengths, ranks the pieces of a length and
hands every rank its place; only the histogram and the plan are ever in one
place, and both are bounded by ``capacity``.

The search is branch and bound by bin completion: the largest length left is
taken, the undominated fillings of the room beside it are enumerated, the
best-fitting first, and one is used as often as the counts allow. A branch
ends when its waste exceeds what a plan better than the incumbent may waste.
The first incumbent is the better of best-fit and first-fit decreasing; inside the
search, best-fit completions of a branch may become the incumbent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, store, text_slices, whole_text
from .vocabulary import DEFAULT_TOKENIZER, encoder

CAPACITY = 1024
END_ID = 2
#: Branches tried before the best plan found is taken.
MAX_NODES = 4_000
#: Nodes between two best-fit completions that may become the incumbent.
BEST_FIT_EVERY = 16
#: Fillings tried around a largest piece, and steps spent to find them.
MAX_FILLINGS = 6
MAX_FILLING_STEPS = 3_000
#: Pieces of one length that one task ranks at most, about.
RANKED_TOGETHER = 100_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences, each holding ``filling``: (length, how many) pairs."""

    filling: tuple[tuple[int, int], ...]
    times: int


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram: the pieces of each length, the largest
    first, go into the open sequences with the least room that holds them."""
    # sequences by the room left: (filling, how many)
    rooms: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    for length, n in sorted(counts.items(), reverse=True):
        moved = []
        for room in [*sorted(r for r in rooms if r >= length), capacity]:
            groups = rooms.pop(room, []) if room < capacity else [((), n)]
            for filling, times in groups:
                # a sequence that took a piece is the fullest: it takes what it holds
                each = room // length
                full = min(times, n // each)
                rest = n - full * each if full < times and n - full * each < each else 0
                for use, many in ((each, full), (rest, 1 if rest else 0)):
                    if many:
                        moved.append((room - use * length, (*filling, (length, use)), many))
                        n -= use * many
                        times -= many
                if times and filling:
                    moved.append((room, filling, times))
        for room, filling, times in moved:
            rooms.setdefault(room, []).append((filling, times))
    return [Pattern(filling, times) for groups in rooms.values() for filling, times in groups]


def first_fit_plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """First-fit decreasing on a histogram: beside the largest length left, the
    largest lengths that still fit, repeated as often as the counts allow."""
    left, plan = dict(sorted(counts.items(), reverse=True)), []
    while left:
        room, filling = capacity, {}
        for length, n in left.items():
            use = min(n, room // length)
            if use:
                filling[length] = use
                room -= use * length
        plan.append(_use(left, tuple(filling.items())))
    return plan


def _use(left: dict[int, int], filling: tuple[tuple[int, int], ...]) -> Pattern:
    """Take ``filling`` out of ``left`` as often as the counts allow."""
    times = min(left[length] // n for length, n in filling)
    for length, n in filling:
        left[length] -= n * times
        if not left[length]:
            del left[length]
    return Pattern(filling, times)


def completions(left: dict[int, int], largest: int, capacity: int,
                max_waste: int) -> list[tuple[tuple[int, int], ...]]:
    """Undominated fillings around one piece of length ``largest`` that waste
    at most ``max_waste``, the least waste and then the fewest pieces first.

    Lengths are tried in descending order, each at its largest count first. A
    filling to which a piece left could be added, or in which a piece could be
    exchanged for a longer one left, is dominated by that one and dropped; a
    piece left that fills the room by itself dominates all others.
    """
    lengths = sorted((n for n in left if n <= capacity - largest), reverse=True)
    free = {n: left[n] - (n == largest) for n in lengths}
    lengths = [n for n in lengths if free[n] > 0]
    found: list[tuple[int, int, tuple[tuple[int, int], ...]]] = []
    steps = [MAX_FILLING_STEPS]

    some_left = sum(1 << n for n in lengths)  # sets of lengths as bits

    def up_to(bits: int, room: int) -> int:
        """Bit s: one of the bits from s - room to s is set."""
        done = 0
        while done < room:
            step = min(done + 1, room - done)
            bits |= bits << step
            done += step
        return bits

    def dominated(chosen: dict[int, int], room: int) -> bool:
        spare = some_left
        for m, use in chosen.items():
            if use == free[m]:
                spare &= ~(1 << m)
        if spare & ((1 << (room + 1)) - 1):
            return True  # a piece left fits beside them
        own = sum(1 << m for m in chosen)
        return bool(room and up_to(own << 1, room - 1) & spare)  # one piece for a longer one

    def extend(at: int, room: int, chosen: dict[int, int]) -> None:
        steps[0] -= 1
        if steps[0] <= 0 or sum(w == 0 for w, _, _ in found) >= MAX_FILLINGS:
            return
        while at < len(lengths) and lengths[at] > room:
            at += 1
        if at == len(lengths):
            if room <= max_waste and not dominated(chosen, room):
                filling = dict(chosen)
                filling[largest] = filling.get(largest, 0) + 1
                found.append((room, sum(chosen.values()),
                              tuple(sorted(filling.items(), reverse=True))))
            return
        length = lengths[at]
        for use in range(min(free[length], room // length), -1, -1):
            if use:
                chosen[length] = use
            extend(at + 1, room - use * length, chosen)
            chosen.pop(length, None)

    room_only = capacity - largest
    if room_only and free.get(room_only, 0) > 0:
        filling = {largest: 1}
        filling[room_only] = filling.get(room_only, 0) + 1
        return [tuple(sorted(filling.items(), reverse=True))]
    if room_only:
        _pairs_first(free, lengths, room_only, found, largest)
    extend(0, capacity - largest, {})
    unique = {filling: (waste, n) for waste, n, filling in found}
    return sorted(unique, key=unique.__getitem__)[:MAX_FILLINGS]


def _pairs_first(free: dict[int, int], lengths: list[int], room: int, found: list,
                 largest: int) -> None:
    """Fillings of two pieces without waste, found directly (no single piece has
    the length of the room)."""
    for n in lengths:
        if len(found) >= MAX_FILLINGS or 2 * n < room:
            return
        m = room - n
        if m and free.get(m, 0) > (m == n):
            filling: dict[int, int] = {}
            for k in (largest, n, m):
                filling[k] = filling.get(k, 0) + 1
            found.append((0, 2, tuple(sorted(filling.items(), reverse=True))))


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """A plan with as few sequences as the search finds; every length of
    ``counts`` (1 to ``capacity``) is used exactly as often as it occurs."""
    counts = {int(k): int(v) for k, v in counts.items() if v > 0}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    total = sum(k * v for k, v in counts.items())
    best = min((plan(counts, capacity) for plan in (best_fit_plan, first_fit_plan)),
               key=lambda plan: sum(p.times for p in plan))
    least, bound, nodes = sum(p.times for p in best), _lower_bound(counts, total, capacity), 0
    # depth first; a frame is (counts left, plan so far, waste, sequences, options)
    stack = [(counts, [], 0, 0, None)]
    while stack and least > bound and nodes < MAX_NODES:
        left, sofar, waste, used, options = stack.pop()
        allowed = (least - 1) * capacity - total  # what a better plan may waste
        if waste > allowed:
            continue
        if not left:
            best, least = sofar, used
            continue
        if options is None:
            nodes += 1
            options = completions(left, max(left), capacity, allowed - waste)
            if nodes % BEST_FIT_EVERY == 0:  # best fit from here: a new incumbent?
                rest = best_fit_plan(left, capacity)
                if used + (n := sum(p.times for p in rest)) < least:
                    best, least = sofar + rest, used + n
        if not options:
            continue
        stack.append((left, sofar, waste, used, options[1:]))
        after = dict(left)
        pattern = _use(after, options[0])
        spare = capacity - sum(k * n for k, n in pattern.filling)
        stack.append((after, sofar + [pattern], waste + spare * pattern.times,
                      used + pattern.times, None))
    return best


def _lower_bound(counts: dict[int, int], total: int, capacity: int) -> int:
    """Sequences that no plan can do without.

    For each limit up to half the capacity: a piece with less room beside it
    than the limit takes no piece of the limit or longer, so the pieces from
    the limit to half must go beside the middle ones or into new sequences.
    """
    number = np.zeros(capacity + 1, dtype=np.int64)
    number[list(counts)] = list(counts.values())
    tokens = np.cumsum(number * np.arange(capacity + 1))
    number = np.cumsum(number)
    half, best = capacity // 2, -(-total // capacity)
    for limit in range(1, half + 1):
        beyond = int(number[capacity] - number[half])  # longer than half: one each
        middle = int(number[capacity - limit] - number[half])
        room = middle * capacity - int(tokens[capacity - limit] - tokens[half])
        small = int(tokens[half] - tokens[limit - 1])
        best = max(best, beyond + max(0, -(-(small - room) // capacity)))
    return best


def cut_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                  tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Pieces of every document: its ids and ``end_id``; a longer document is
    cut into pieces of ``capacity`` ids, of which the first may be shorter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer, added_tokens=True), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for at, texts in text_slices(batch):
                doc_ids = batch.column(0).slice(at, len(texts)).to_pylist()
                rows = []
                for doc_id, ids in zip(doc_ids, own.encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    starts = [0, *range(first, n, capacity)]
                    for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], n])):
                        rows.append((doc_id, piece, start, stop - start,
                                     zlib.crc32(ids[4 * start:4 * stop])))
                yield pa.record_batch(
                    [pa.array(x, pa.int32() if i == 1 else pa.int64())
                     for i, x in enumerate(map(list, zip(*rows)))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   whole_text().alias("text")), run, _PIECES)


def rank_within_length(pieces: DataFrame, largest_count: int) -> DataFrame:
    """``pieces`` and a gapless ``rank`` from 0 among those of equal length.

    A common length is dealt over salted groups, ranked there, and moved up by
    the sizes of the groups before, so no task sees a whole length.
    """
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(4 * parts, -(-largest_count // RANKED_TOGETHER))
    salted = pieces.withColumn("salt", F.pmod(
        F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy(
        "doc_id", "piece", "start", "ids_crc32"))
    return (salted.withColumn("place", place).join(before, ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("place") - 1)
            .drop("salt", "place", "before"))


def _places(plan: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, its uses in the plan in rank order: first rank, pieces
    a sequence, first sequence, offset of the first of them in a sequence."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first_sequence = 0
    for pattern in plan:
        offset = 0
        for length, n in pattern.filling:
            start = taken.get(length, 0)
            rows.setdefault(length, []).append((start, n, first_sequence, offset))
            taken[length] = start + n * pattern.times
            offset += n * length
        first_sequence += pattern.times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*r))
            for length, r in rows.items()}


def place_pieces(ranked: DataFrame, plan: list[Pattern]) -> DataFrame:
    """``sequence_id`` and ``offset`` of every ranked piece."""
    places = _places(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if not len(rows):
                    continue
                n = int(length[rows[0]])
                first, each, base, shift = places[n]
                use = np.searchsorted(first, rank[rows], side="right") - 1
                nth = rank[rows] - first[use]
                sequence[rows] = base[use] + nth // each[use]
                offset[rows] = shift[use] + nth % each[use] * n
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                  ["doc_id", "piece", "start", "length", "ids_crc32",
                                   "sequence_id", "offset"])

    return map_batches(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"),
                       run, _PACKED)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                   tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Pack every row of ``docs`` (columns doc_id and text; others ignored).

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. A null or empty text is a piece of ``end_id`` alone. A null doc_id
    and repeated rows are packed like any other; an empty table gives no rows.
    """
    pieces = store(cut_documents(docs, capacity, end_id, tokenizer), "pieces")
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in histogram.collect()}  # at most ``capacity`` rows
    plan = pack_histogram(counts, capacity)
    return place_pieces(rank_within_length(pieces, max(counts.values(), default=0)), plan)
