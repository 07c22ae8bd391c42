import re
import zlib
from collections import Counter

from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.spelling import neighbours, spelling_variants

from .cases import TEXTS, documents, stored


def brute_counts(rows, slip=97):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return counts


def one_edit(word, letters):
    out = set()
    for k in range(len(word) + 1):
        out |= {word[:k] + c + word[k:] for c in letters}
        if k < len(word):
            out |= {word[:k] + c + word[k + 1:] for c in letters} | {word[:k] + word[k + 1:]}
    return out - {word}


def brute(rows, least_length=5, least_count=3):
    words = {w: n for w, n in brute_counts(rows).items()
             if n >= least_count and len(w) >= least_length}
    letters = {c for w in words for c in w}
    out, form = {}, {}
    for w, n in words.items():
        near = [v for v in one_edit(w, letters) if v in words]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form[w], None, n, len(near), words[form[w]] if form[w] else None]
    for w, row in out.items():
        root = w
        while form[root]:
            root = form[root]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def result(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_edge_cases_and_planted_variants(spark):
    planted = ("colour " * 40 + "color " * 12 + "colours " * 6 + "colur " * 3 + "hello " * 9
               + "helo hellooo helloo " * 4 + "ÉTOILE étoile Étoile " * 3 + "étoilé " * 3
               + "aaaaa " * 8 + "aaaaaa " * 4 + "aaaaaaa " * 3 + "naïve×s naïve÷s " * 5)
    rows = TEXTS + [(50, planted), (None, planted), (51, "Colour COLOUR colour " * 50)]
    assert result(spelling_variants(documents(spark, rows))) == brute(rows)
    assert spelling_variants(documents(spark, [])).collect() == []
    assert spelling_variants(documents(spark, [(1, None), (2, ""), (3, "1 2 3")])).collect() == []


def test_every_edit_of_a_word_is_met_once(spark):
    """A dense vocabulary over two letters: runs, swaps, every kind of edit."""
    words = [f"{i:b}".replace("0", "a").replace("1", "b") for i in range(1, 128)]
    df = spark.createDataFrame([(w, (i * 37) % 11 + 1) for i, w in enumerate(words)],
                               "word string, n long")
    counts = {w: (i * 37) % 11 + 1 for i, w in enumerate(words)}
    got = {r["word"]: (r["n_near"], r["best"]["word"]) for r in neighbours(df).collect()}
    for w in words:
        near = [v for v in one_edit(w, "ab") if v in counts]
        assert got[w] == (len(near), min(near, key=lambda v: (-counts[v], v)))


def test_forms_lead_on_over_several_steps(spark):
    """Each word is a variant of the next, which is twice as common."""
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc"]
    rows = [(7, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2 ** k)))]
    rows = [r for r in rows if all(zlib.crc32(f"7:{w}".encode()) % 97 for w in chain)]
    got = result(spelling_variants(documents(spark, rows)))
    assert rows and got == brute(rows)
    assert {got[w][1] for w in chain} == {"bbbbc"}


def test_query_on_a_stored_table(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in given.collect()]
    assert result(QUERIES["op12_spelling"](spark, "/root/testdata/sf0.001")) == brute(rows)
    assert QUERIES["op12_spelling"](spark, stored(spark, tmp_path, [])).collect() == []
