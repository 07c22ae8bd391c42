import itertools
import operator
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerlens.llm import queries, token_files
from ledgerlens.llm.bpe import (BacktrackingEncoder, TextCodec, decode_documents, encode_documents,
                                merge_by_ranks, read_ranks)
from ledgerlens.llm.packing import (MAX_FILLINGS, _lower_bound, best_fit_plan, completions, cut_documents,
                                    first_fit_plan, pack_documents, pack_histogram, rank_within_length)
from ledgerlens.llm.token_counts import (length_histogram, length_quantiles, suffix_sums,
                                         token_counts, truncated_total)
from ledgerlens.llm.vocabulary import encoder, units

from .cases import TEXTS, documents, stored

RANKS = read_ranks("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(1)
    letters = " \n\tab1'é世! \x1c s.,"
    return [t or "" for _, t in TEXTS] + ["<|endoftext|> a", "don't  we'll", " " * 3000] + [
        "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]


def test_units_encode_as_the_whole_text(library, odd_texts):
    for text, ids in zip(odd_texts, encoder().encode(odd_texts)):
        assert "".join(units(text)) == text
        assert np.frombuffer(ids, "<u4").tolist() == library(text)


def test_the_memo_is_bounded(monkeypatch, library):
    from ledgerlens.llm import vocabulary
    monkeypatch.setattr(vocabulary, "MEMO_UNITS", 20)
    own = vocabulary.CorpusEncoder()
    text = " ".join(f"w{i % 57}x{i % 31}." for i in range(2000))
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library(text)
    assert len(own._memo) <= 20 and len(own._memo._before) <= 20


def test_another_vocabulary_is_encoded_text_by_text(odd_texts):
    whole = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    whole.encode_special_tokens = True
    for text, ids in zip(odd_texts[:200], encoder("word_bpe_49k.json").encode(odd_texts[:200])):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(
            text, add_special_tokens=False).ids


def test_backtracking_gives_the_merges(odd_texts):
    own, public = TextCodec(), tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for text in odd_texts:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == public.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_backtracking_on_bytes_and_windows(monkeypatch):
    from ledgerlens.llm import bpe
    rnd, own = random.Random(2), BacktrackingEncoder(RANKS)
    pieces = [bytes(rnd.choice(b"abclo \xc3\xa9the") for _ in range(rnd.randint(0, 40)))
              for _ in range(400)]
    assert [own.encode(p) for p in pieces] == [merge_by_ranks(p, RANKS) for p in pieces]
    monkeypatch.setattr(bpe, "MATCH_WINDOW", 7)
    assert [own.encode(p) for p in pieces] == [merge_by_ranks(p, RANKS) for p in pieces]


def test_compatible_pairs():
    own, rnd = BacktrackingEncoder(RANKS), random.Random(3)
    for _ in range(5000):
        whole = own.token[rnd.randrange(own.size)]
        cut = rnd.randint(1, len(whole))
        a = RANKS.get(whole[:cut], rnd.randrange(own.size))
        b = RANKS.get(whole[cut:], rnd.randrange(own.size))
        if own._compatible(-1, a) and own._compatible(-1, b):
            assert own._stay_apart(a, b) == (
                merge_by_ranks(own.token[a] + own.token[b], RANKS) == [a, b])


def test_encode_and_decode_documents(spark):
    rows = decode_documents(encode_documents(documents(spark))).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode()) for r in rows) == sorted(
        (i or -1, t or "") for i, t in TEXTS)
    assert encode_documents(documents(spark, [])).collect() == []


# token files

def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


@pytest.mark.parametrize("length, batch", [(1024, 256), (8, 2)])
def test_token_files_round_trip(spark, library, monkeypatch, length, batch):
    monkeypatch.setattr(token_files, "SEQUENCES_PER_BATCH", batch)
    manifest = token_files.write_token_files(
        documents(spark).coalesce(1) if batch == 2 else documents(spark), length=length)
    if batch == 256:  # workers have the module's own value
        got = sorted(map(tuple, token_files.read_token_files(manifest).collect()),
                     key=lambda r: r[1])
        at = 0
        for (i, t), row in zip(order(TEXTS), got):
            ids = np.array([*library(t), 0], dtype="<u4")
            assert row == (i, at, len(ids), zlib.crc32(ids))
            at += len(ids)


def test_shard_random_access(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEQUENCES_PER_BATCH", 3)
    monkeypatch.setattr(token_files, "DOCS_PER_BATCH", 4)
    writer, rnd = token_files.ShardWriter(str(tmp_path), 50_257, length=8), random.Random(4)
    docs = [np.array([rnd.randrange(50_257) for _ in range(n)], dtype=np.uint32)
            for n in (1, 0, 70, 7, 8, 9, 200, 3, 1)]
    for i, ids in enumerate(docs):
        writer.add(i, ids)
    writer.close()
    reader, stream = token_files.ShardReader(writer.path), np.concatenate(docs)
    for i, start, n in reader.documents():
        assert reader.ids(start, n).tolist() == docs[i].tolist()
    for row in range(writer.n_sequences):
        ids, mask = reader.sequence(row)
        assert len(ids) == len(mask) == 8
        assert ids[mask].tolist() == stream[8 * row:8 * row + 8].tolist()
    assert writer.n_sequences == -(-len(stream) // 8)
    ids, _ = reader.sequence(0)
    assert not ids.flags.owndata  # a view of the file
    reader.close()


def test_a_repeated_doc_id_is_split(spark, library):
    """One doc_id for all documents: several shards, in the order of the texts."""
    texts = [f"{i % 97:02d} text {i}" for i in range(2000)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        manifest = token_files.write_token_files(documents(spark, [(7, t) for t in texts]))
    finally:
        spark.conf.unset(coalesce)
    assert manifest.count() > 2
    rows = token_files.read_token_files(manifest).orderBy("start").collect()
    want = [zlib.crc32(np.array([*library(t), 0], "<u4").tobytes())
            for t in sorted(texts)]
    assert [r["ids_crc32"] for r in rows] == want


def test_token_files_of_nothing(spark):
    manifest = token_files.write_token_files(documents(spark, []))
    assert token_files.read_token_files(manifest).collect() == []


# packing

def check_packing(rows, texts, library, capacity):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    want = Counter()
    for i, t in texts:
        ids = np.array([*library(t), 2], dtype="<u4")
        first = (len(ids) - 1) % capacity + 1
        for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
            stop = first if start == 0 else start + capacity
            want[(i, piece, start, stop - start, zlib.crc32(ids[start:stop]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                   for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 50])
def test_packing(spark, library, capacity):
    rows = pack_documents(documents(spark), capacity=capacity).collect()
    n = check_packing(rows, TEXTS, library, capacity)
    counts = Counter(r["length"] for r in rows)
    assert n == sum(p.times for p in pack_histogram(counts, capacity))
    assert pack_documents(documents(spark, [])).collect() == []


def test_ranks_are_gapless(spark):
    pieces = cut_documents(documents(spark, [(i, "a" * (i % 3)) for i in range(300)]))
    for salts_for in (1, 10**7):
        ranks = {}
        for r in rank_within_length(pieces, salts_for).collect():
            ranks.setdefault(r["length"], []).append(r["rank"])
        assert all(sorted(x) == list(range(len(x))) for x in ranks.values())


def brute_bins(items, capacity):
    """Least number of bins, by trying every placement."""
    best = [len(items)]

    def place(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(items):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[at] <= capacity and bins[i] not in bins[:i]:
                bins[i] += items[at]
                place(at + 1, bins)
                bins[i] -= items[at]
        place(at + 1, [*bins, items[at]])

    place(0, [])
    return best[0]


def test_plans_are_exact_and_never_worse_than_best_fit():
    rnd = random.Random(6)
    optimal = 0
    for case in range(60):
        capacity = rnd.choice([10, 24, 100])
        items = sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(1, 9))), reverse=True)
        counts = Counter(items)
        plan = pack_histogram(counts, capacity)
        used = Counter()
        for p in plan:
            assert sum(k * n for k, n in p.filling) <= capacity
            for k, n in p.filling:
                used[k] += n * p.times
        assert used == counts
        n, least = sum(p.times for p in plan), brute_bins(items, capacity)
        assert _lower_bound(counts, sum(items), capacity) <= least <= n
        assert n <= sum(p.times for p in best_fit_plan(counts, capacity))
        optimal += n == least
    assert optimal >= 58


def test_completions_are_undominated():
    counts = {60: 1, 30: 1, 25: 1, 20: 2, 15: 1, 5: 1}
    found = completions(counts, 60, 100, 100)
    waste = [100 - sum(k * n for k, n in f) for f in found]
    assert waste[0] == 0 and waste == sorted(waste)
    for filling, room in zip(found, waste):
        spare = [k for k, n in counts.items() if n > dict(filling).get(k, 0)]
        assert all(k > room for k in spare)  # nothing could be added
        assert not any(m < k <= m + room for m, _ in filling[1:] for k in spare)  # or exchanged


def test_completions_against_every_filling():
    """Brute force: fillings that no exchange of a piece betters."""
    def room_for(counts, largest, capacity):
        lengths = sorted(counts, reverse=True)
        ranges = [range(counts[n] - (n == largest) + 1) for n in lengths]
        for uses in itertools.product(*ranges):
            if sum(map(operator.mul, lengths, uses)) <= capacity - largest:
                yield {n: use for n, use in zip(lengths, uses) if use}

    assert completions({60: 1, 40: 1, 25: 1, 15: 1}, 60, 100, 100) == [((60, 1), (40, 1))]
    rnd = random.Random(16)
    for _ in range(60):
        counts = Counter(rnd.randint(3, 60) for _ in range(rnd.randint(2, 8)))
        largest, want = max(counts), []
        for chosen in room_for(counts, largest, 100):
            room = 100 - largest - sum(n * use for n, use in chosen.items())
            spare = [n for n, have in counts.items()
                     if have - (n == largest) > chosen.get(n, 0) and n <= 100 - largest]
            pieces = list(Counter(chosen).elements())
            full = counts[100 - largest] > (2 * largest == 100)  # one piece fills the room
            if not any(n <= room or any(m < n <= m + room for m in pieces) for n in spare) and (
                    not full or pieces == [100 - largest]):
                want.append((room, tuple(sorted((Counter(chosen) + Counter([largest])).items(),
                                                reverse=True))))
        found = completions(dict(counts), largest, 100, 100)
        assert set(found) <= {f for _, f in want}
        if len(want) <= MAX_FILLINGS:
            assert set(found) == {f for _, f in want}


def test_search_keeps_best_fit_completions(monkeypatch):
    """Best fit is tried from the nodes of the search, too."""
    import ledgerlens.llm.packing as P
    seen, real = [], P.best_fit_plan

    def recording(counts, capacity):
        plan = real(counts, capacity)
        seen.append((sum(k * n for k, n in counts.items()), sum(p.times for p in plan)))
        return plan

    monkeypatch.setattr(P, "best_fit_plan", recording)
    monkeypatch.setattr(P, "BEST_FIT_EVERY", 1)
    rnd = random.Random(26)
    counts = Counter(rnd.randint(20, 60) for _ in range(60))
    n = sum(p.times for p in P.pack_histogram(counts, 100))
    total = sum(k * m for k, m in counts.items())
    assert len(seen) > 1 and n <= seen[0][1]
    assert any(left < total for left, _ in seen[1:])  # of what a branch left


def test_search_beats_best_fit():
    counts = Counter({60: 1, 50: 1, 40: 1, 30: 1, 20: 1})  # two of 100 do
    assert sum(p.times for p in pack_histogram(counts, 100)) == 2
    tricky = Counter({44: 2, 43: 2, 30: 2, 28: 2, 27: 2, 26: 2, 2: 1})
    assert sum(p.times for p in pack_histogram(tricky, 100)) == 4


# token counts

def test_token_counts(spark, library):
    lengths = sorted(len(library(t)) for _, t in TEXTS)
    histogram = length_histogram(documents(spark))
    assert {r["length"]: r["n_docs"] for r in histogram.collect()} == Counter(lengths)
    for r in token_counts(documents(spark)).collect():
        limit = r["context_limit"]
        assert r["docs_longer"] == sum(n > limit for n in lengths)
        assert r["tokens_longer"] == sum(n for n in lengths if n > limit)
        assert r["tokens_within"] == sum(min(n, limit) for n in lengths)
        assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))
        for q in filter(None, r["quantiles"].split(",")):
            assert sum(n <= limit for n in lengths) >= float(q) * len(lengths)
            assert sum(n < limit for n in lengths) < float(q) * len(lengths)
    sums = suffix_sums(histogram)
    for limit in (0, 1, 7, 1000, 10**6):
        r = truncated_total(sums, limit).first()
        assert tuple(r) == (sum(n > limit for n in lengths), sum(min(n, limit) for n in lengths))
    halves = length_quantiles(sums, (0.5, 1.0)).collect()
    assert {r["quantile"]: r["length"] for r in halves} == {
        0.5: lengths[(len(lengths) + 1) // 2 - 1], 1.0: lengths[-1]}


def test_token_counts_of_nothing(spark):
    assert token_counts(documents(spark, [])).collect() == []


def test_queries_over_a_table(spark, tmp_path, library):
    sf_dir = stored(spark, tmp_path)
    check_packing(queries.QUERIES["op1_packing"](spark, sf_dir).collect(), TEXTS, library, 1024)
    rows = queries.QUERIES["op7_byte_bpe"](spark, sf_dir).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(library(t)) for _, t in TEXTS)


def test_best_fit_puts_a_piece_into_the_fullest_sequence():
    def one_by_one(counts, capacity):
        rooms = []
        for n in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append(min(fits, default=capacity) - n)
        return sorted(rooms)

    rnd = random.Random(6)
    for _ in range(400):
        capacity = rnd.randint(5, 60)
        counts = {rnd.randint(1, capacity): rnd.randint(1, 9) for _ in range(rnd.randint(1, 12))}
        plan = best_fit_plan(counts, capacity)
        used = Counter()
        for p in plan:
            used.update({n: k * p.times for n, k in p.filling})
        assert used == Counter(counts)
        assert sorted(r for p in plan for r in [capacity - sum(n * k for n, k in p.filling)]
                      * p.times) == one_by_one(counts, capacity)
        first = sum(p.times for p in first_fit_plan(counts, capacity))
        best = sum(p.times for p in plan)
        assert sum(p.times for p in pack_histogram(counts, capacity)) <= min(best, first)


def test_added_tokens_are_read_as_by_the_library(spark):
    plain = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>", "<|endoftext", "a"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [50256]
    got = encoder(added_tokens=True).encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want
    rows = cut_documents(documents(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in rows} == {
        i: (len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4"))) for i, ids in enumerate(want)}
