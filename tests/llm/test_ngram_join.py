import itertools
import random

import numpy as np
import pytest

from ledgerlens.llm.ngram_join import (_WordHashes, frequency_codes, ngram_join, parity_bitmap,
                                       signatures, tokens_of)
from ledgerlens.llm.queries import QUERIES

from .cases import TEXTS, documents, prose, stored


def shingles(text):
    words = (text or "").encode().lower().split()
    grams = {tuple(words[i:i + 3]) for i in range(len(words) - 2)}
    return grams or ({tuple(words)} if words else set())


def brute(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)),
                  key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def edited(text, rnd, edits):
    words = text.split()
    for _ in range(edits):
        at = rnd.randrange(len(words))
        words[at:at + 1] = rnd.choice([[], [f"w{rnd.randrange(99)}"], [words[at], "more"]])
    return " ".join(words)


def planted(seed=1):
    """Groups of near copies with shared passages, at and around the threshold."""
    rnd, rows, doc = random.Random(seed), [], 1000
    passage = prose(777, 60)
    for group in range(6):
        base = prose(900 + group, rnd.choice([15, 40, 120, 300])) + " " + passage
        for _ in range(rnd.choice([3, 12, 40])):
            rows.append((doc, edited(base, rnd, rnd.randrange(5))))
            doc += 1
    return rows + [(doc + i, f"{prose(i, 200)} {passage}") for i in range(20)]


@pytest.mark.parametrize("small, chunk", [(8, 4096), (2, 7), (1000, 4096)])
def test_components(spark, small, chunk):
    rows = planted()
    got = ngram_join(documents(spark, rows), small=small, chunk=chunk)
    assert result(got) == brute(rows)


def test_components_with_a_sketch_that_knows_nothing(spark):
    """Sixteen counters: every token counts as frequent, only pairs are indexed."""
    rows = planted(2)
    assert result(ngram_join(documents(spark, rows), bits=4)) == brute(rows)


def test_edge_cases(spark):
    rows = TEXTS + [(100, prose(100, 600)), (101, prose(100, 600) + " the end"),
                    (102, prose(100, 600).upper()), (None, prose(100, 600)), (None, "")]
    assert result(ngram_join(documents(spark, rows))) == brute(rows)
    assert ngram_join(documents(spark, [])).collect() == []
    assert result(ngram_join(documents(spark, [(3, None), (4, "")]))) == [(3, 0, 3), (4, 0, 4)]


def test_query(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in given.collect()]
    assert result(QUERIES["op13_ngram_join"](spark, "/root/testdata/sf0.001")) == brute(rows)
    assert QUERIES["op13_ngram_join"](spark, stored(spark, tmp_path, [])).collect() == []


def test_sets_that_link_have_a_signature_in_common():
    """Whatever the codes: random sets, codes, sizes and differences."""
    rng = np.random.default_rng(4)
    for trial in range(1500):
        n = int(rng.integers(2, 130))
        pool = np.unique(rng.integers(0, 1 << 62, n + 40).astype(np.uint64))
        rng.shuffle(pool)
        common, drop = pool[:n], int(rng.integers(0, 1 + n // 8))
        a = np.sort(np.concatenate([common, pool[n:n + int(rng.integers(0, 8))]]))
        b = np.sort(np.concatenate([common[drop:], pool[n + 8:n + 8 + int(rng.integers(0, 8))]]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 90 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        often = rng.choice([0, 30, 90, 100])
        code = {int(t): int(t % np.uint64(97) < np.uint64(often)) * 40 + int(t % np.uint64(3)) for t in pool}
        sides = [signatures(s, np.array([code[int(t)] for t in s], np.uint8), 40, 90) for s in (a, b)]
        assert len(np.intersect1d(*sides)), (trial, len(a), len(b), both)


def test_signatures_stay_in_proportion_to_the_set():
    rng = np.random.default_rng(5)
    for n in (30, 300, 3000, 30000):
        tokens = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for codes in (0, 200):  # all rare; all frequent
            assert len(signatures(tokens, np.full(len(tokens), codes, np.uint8), 40, 90)) <= n


def test_bitmaps_never_differ_in_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(6)
    a = np.unique(rng.integers(0, 1 << 62, 700).astype(np.uint64))
    for drop in (0, 1, 5, 60):
        bits = np.bitwise_count(parity_bitmap(a) ^ parity_bitmap(a[drop:])).sum()
        assert bits <= drop


def test_tokens(spark):
    hashes = _WordHashes()
    for _, text in TEXTS:
        assert len(tokens_of(text or "", hashes)) == len(shingles(text))
    assert tokens_of("A b C", hashes).tolist() == tokens_of(" a\tB\nc ", hashes).tolist()
    assert tokens_of("a b", hashes).tolist() != tokens_of("b a", hashes).tolist()
    assert len(set(map(str, (tokens_of(t, hashes) for t in ("a", "a a", "a a a"))))) == 3
    docs = documents(spark, [(i, "very common words here") for i in range(300)] + [(999, "one rare text")])
    codes, frequent = frequency_codes(docs, 3, 16)
    common, rare = (tokens_of(t, hashes) for t in ("very common words", "one rare text"))
    assert codes[int(common[0]) >> 48] >= frequent > codes[int(rare[0]) >> 48]
