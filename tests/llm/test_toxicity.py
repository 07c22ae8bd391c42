import math
import random
import zlib
from collections import defaultdict

import pytest
import regex

from ledgerlens.llm import toxicity as T
from ledgerlens.llm.toxicity import (FEATURES, MAX_TRAINING_ROWS, fit_toxicity, learn_lexicon,
                                     score_toxicity, with_features)

from .cases import TEXTS, documents, prose

INSULTS = ["idiot", "scum", "moron", "zorgle", "blimfark"]  # two that no list has


def corpus(n=400, seed=1):
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, 60).split()
        toxic = rnd.random() < 0.3
        for _ in range(4 if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        docs.append((100 + i, " ".join(words)))
        labels.append((100 + i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    rows = score_toxicity(documents(spark, docs + TEXTS),
                          spark.createDataFrame(labels + [(None, 1), (9999, 1), (100, None)],
                                                "doc_id long, toxic int")).collect()
    return rows, dict(labels)


def test_held_out_accuracy(scored):
    rows, labels = scored
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 60
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right / len(held) > 0.93
    pos = [r["score"] for r in held if labels[r["doc_id"]]]
    neg = [r["score"] for r in held if not labels[r["doc_id"]]]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert wins / (len(pos) * len(neg)) > 0.97


def test_every_row_has_a_score(scored):
    rows, _ = scored
    assert len(rows) == 400 + len(TEXTS)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        name = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(name.encode()) % 4 == 2)
    repeated = [r["score"] for r in rows if r["doc_id"] == 7]
    assert len(repeated) == 2 and len(set(repeated)) == 1


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(120, 3)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    got = [sorted(map(tuple, score_toxicity(
        documents(spark, docs), spark.createDataFrame(x, "doc_id long, toxic int")).collect()))
        for x in (labels, flipped)]
    assert got[0] == got[1]


def test_lexicon_is_learned_from_contexts(spark):
    docs, labels = corpus(300, 4)
    copies = [(i, "quux corge grault " * 3) for i in range(5000, 5100)]  # one toxic text, often
    rows = [(t, y) for (_, t), (_, y) in zip(docs, labels)] + [(t, 1) for _, t in copies]
    words = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert {"zorgle", "blimfark"} <= set(words)
    assert not {"quux", "corge", "grault"} & set(words)


def test_features(spark):
    texts = [(1, "You are an IDIOT!! id1ot i d i o t s"), (2, "the sun shines"), (3, None)]
    rows = {r["doc_id"]: r for r in with_features(documents(spark, texts), ["sun"]).collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert one["_ll_seed_density"] > 0 and one["_ll_near_second_person"] > 0
    assert one["_ll_disguised_hits"] > 0 and one["_ll_shouted_words"] > 0
    assert one["_ll_repeated_marks"] > 0 and one["_ll_mixed_words"] > 0
    assert one["_ll_spaced_letters"] > 0 and two["_ll_learned_density"] == pytest.approx(1 / 3)
    assert all(three[f"_ll_{f}"] == 0 for f in FEATURES)


def brute_words(text):
    table = str.maketrans(T._SPACES, " " * len(T._SPACES), T._MARKS)
    return text.lower().translate(table).split()


def brute_features(text, learned):
    """Every feature of one text, read from its description."""
    text = text or ""
    words, seeds = brute_words(text), set(T.SEED_WORDS.split())
    whole = {e for e in learned if not e.endswith("*")}
    stems = {e[:-1] for e in learned if e.endswith("*")}
    hits = [i for i, w in enumerate(words) if w in seeds | whole]
    begun = [w for w in words if w[:4] in stems or w[:5] in stems]
    second = set(T.SECOND_PERSON.split())
    # eleven words, from five before the hit or from the first one
    near = [i for i in hits if second & set(words[max(i - 5, 0):max(i - 5, 0) + 11])]
    touch = regex.search(r"\p{L}[0-9@$!*#]|[0-9@$]\p{L}", text)
    read = regex.sub(r"(?<=\p{L})!(?=\p{L})", "i", text.lower()).translate(
        str.maketrans("0134578@$", "oieastbas"))
    bare = sum(w in seeds | whole for w in brute_words(read)) if touch else 0
    n, chars = max(len(words), 1), max(len(text), 1)

    def found(pattern):
        return len(regex.findall(pattern, text))

    return {
        "seed_density": sum(words[i] in seeds for i in hits) / n,
        "learned_density": sum(words[i] in whole for i in hits) / n,
        "stem_density": len(begun) / n, "stem_hits": math.log1p(len(begun)),
        "lexicon_hits": math.log1p(len(hits)), "near_second_person": len(near) / n,
        "disguised_hits": max(bare - len(hits), 0) / n,
        "capitals": found(r"\p{Lu}") / chars, "shouted_words": found(r"\p{Lu}{3,}") / n,
        "exclamations": text.count("!") / chars, "questions": text.count("?") / chars,
        "repeated_marks": found(r"[!?]{2,}") / n,
        "mixed_words": found(r"\p{L}[0-9@$!*#]+\p{L}") / n if touch else 0.0,
        "spaced_letters": found(r"(?:\b\p{L}[ .]){4,}") / n,
    }


def brute_lexicon(rows):
    contexts = defaultdict(lambda: (set(), set()))
    for text, toxic in rows:
        words = brute_words(text)
        for before, word in zip(["", *words], words):
            for entry in [word, *(f"{word[:k]}*" for k in T.STEMS if len(word) >= k)]:
                contexts[entry][toxic].add(before)
    n = [sum(len(c[side]) for c in contexts.values()) + 1.0 for side in (0, 1)]
    odds = {e: math.log((len(c[1]) + 0.5) / n[1]) - math.log((len(c[0]) + 0.5) / n[0])
            for e, c in contexts.items() if len(c[1]) >= T.MIN_CONTEXTS}
    top = sorted((-round(o, 9), e) for e, o in odds.items() if o >= T.MIN_LOG_ODDS)
    return [e for _, e in top][:T.MAX_LEARNED]


def test_features_and_lexicon_against_brute_force(spark):
    docs, labels = corpus(250, 9)
    rnd = random.Random(9)
    pieces = ["You", "are", "an", "IDIOT!!", "id1ot", "m0ron?!", "i d i o t ", "$cum", "your", "WHAT",
              "zorgle", "zorgling", "--", "\n\n", "naïve", "ÉTÉ", "a.b.c.d. ", "st!pid", "1st", "blimfark"]
    odd = [(9000 + i, " ".join(rnd.choices(pieces, k=rnd.randint(0, 30)))) for i in range(150)]
    learned = ["zorgle", "blim*", "zorgl*", "blimfark"]
    texts = docs[:60] + odd + [(i, t) for i, t in TEXTS if i not in (8, 9)]
    got = with_features(documents(spark, [(n, t) for n, (_, t) in enumerate(texts)]), learned)
    by_place = {r["doc_id"]: r for r in got.collect()}
    for n, (_, text) in enumerate(texts):
        want = brute_features(text, learned)
        assert set(want) == set(FEATURES)
        for f in FEATURES:
            assert by_place[n][f"_ll_{f}"] == pytest.approx(want[f], abs=1e-12), (f, text)
    rows = [(t, y) for (_, t), (_, y) in zip(docs, labels)]
    found = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert found and sorted(found) == sorted(brute_lexicon(rows))


def test_runs_of_separators_change_nothing(spark):
    """Doubled blanks and line breaks, and marks that stand alone."""
    plain = "they say that you are a sorry idiot\nand zorgle\nis what your friends say it is"
    spaced = "  " + plain.replace(" ", "  ").replace("\n", "\n\n") + "\n\n"
    marked = plain.replace(" a ", " a -- ").replace("idiot", "*** idiot")
    rows = {r["doc_id"]: r for r in with_features(documents(
        spark, [(1, plain), (2, spaced), (3, marked)]), ["zorgle"]).collect()}
    assert rows[1]["_ll_near_second_person"] > 0
    for f in FEATURES:
        assert rows[1][f"_ll_{f}"] == rows[2][f"_ll_{f}"] == rows[3][f"_ll_{f}"]


def test_contexts_are_words(spark):
    """Blank lines before a word are not another context of it."""
    texts = [(f"a{'xyzvwqkjhg'[i]} {'  ' * i}zorgle", 1) for i in range(10)]
    texts += [(prose(i), 0) for i in range(10)]
    words = learn_lexicon(spark.createDataFrame(texts, "text string, toxic int"))
    assert "zorgle" in words


def test_training_rows_are_not_halved():
    assert MAX_TRAINING_ROWS == 40_000


def test_without_both_classes(spark):
    docs = documents(spark, TEXTS)
    for labels, want in (([], 0.0), ([(1, 0), (4, 0)], 0.0), ([(i, 1) for i in range(1, 19)], 1.0)):
        frame = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert {r["score"] for r in score_toxicity(docs, frame).collect()} == {want}
    nothing = documents(spark, [])
    assert score_toxicity(nothing, spark.createDataFrame([], "doc_id long, toxic int")
                          ).collect() == []
    assert fit_toxicity(nothing, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
                        ).trees is None
