import itertools
import random

import numpy as np
import xxhash

from ledgerlens.llm.components import connected_components
from ledgerlens.llm.simhash import (SECOND_DEAL, covering_masks, drop_near_copies, fingerprint,
                                    near_duplicates, near_links)

from .cases import TEXTS, documents, prose


def brute_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or (
        [b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            root[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(fps))]


def test_fingerprint():
    for _, text in TEXTS:
        assert fingerprint(text or "") == brute_fingerprint(text or "")


def test_every_three_bits_are_left_out_by_some_mask():
    for deal in ((1, 0), SECOND_DEAL):
        masks = covering_masks(3, deal=deal)
        assert all(any(not m & (1 << a | 1 << b | 1 << c) for m in masks)
                   for a, b, c in itertools.combinations(range(64), 3))
    left = [64 - (m | n).bit_count() for m in covering_masks(3)
            for n in covering_masks(3, deal=SECOND_DEAL)]
    assert max(left) <= 19  # the bound on a bucket of the second level


def test_components_of_planted_neighbours_and_crowded_buckets(spark):
    rnd = random.Random(5)
    fps = set()
    for _ in range(60):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 30])):
            near = centre
            for _ in range(rnd.randint(0, 4)):
                near ^= 1 << rnd.randrange(64)
            fps.add(near)
    fps = sorted(fps)
    signed = [int(x) for x in np.array(fps, dtype=np.uint64).view(np.int64)]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    want = brute_components(signed, fps)
    for at_once in (3, 2048):  # most buckets crowded; none
        roots = {r["node"]: r["root"]
                 for r in connected_components(near_links(nodes, 3, at_once)).collect()}
        assert [roots.get(s, s) for s in signed] == want


def test_components_of_chains_loops_and_nothing(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(50, 50), (61, 60), (60, 61), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 61: 60}
    assert connected_components(df.limit(0)).collect() == []


def test_documents_with_every_edge_case(spark):
    texts = TEXTS + [(100, prose(100, 600)), (101, prose(100, 600) + " the end"),
                     (102, prose(100, 600).upper())]
    rows = near_duplicates(documents(spark, texts)).collect()
    fps = [brute_fingerprint(t or "") for _, t in texts]
    want = sorted((i or -1, f, c or -1)
                  for (i, _), f, c in zip(texts, fps, brute_components([i for i, _ in texts], fps)))
    assert sorted((r["doc_id"] or -1, r["fp"] % (1 << 64), r["component_id"] or -1)
                  for r in rows) == want
    kept = [r["doc_id"] for r in rows if r["kept"]]
    assert len(kept) == len({c for _, _, c in want})
    docs = documents(spark, texts)
    dropped = drop_near_copies(docs)
    assert dropped.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in dropped.collect()) == sorted(k or -1 for k in kept)
    assert near_duplicates(documents(spark, [])).collect() == []
