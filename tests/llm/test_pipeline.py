import itertools

import duckdb

import corpus_pipeline
from ledgerlens.llm.packing import cut_documents
from ledgerlens.llm.queries import ORACLE, QUERIES

from .cases import TEXTS, documents, prose, stored
from .test_native import base_spans
from .test_simhash import brute_components, brute_fingerprint

SMALL = "/root/testdata/sf0.001"
EXTRA = [(500, prose(500, 200)), (501, prose(500, 200)), (502, prose(500, 200) + " once"),
         (503, prose(503, 200) + ' password="hunter2hunter2"'), (504, prose(504, 300)),
         (505, prose(505, 150)), (506, prose(505, 150).upper().replace(" ", "### "))]


def run_stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        rows = docs.collect()
        out.append((name, docs.columns, rows))
        if name != corpus_pipeline.STAGES[-1][0]:
            docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_stages_take_effect(spark):
    docs = documents(spark, TEXTS + EXTRA, extra=False)
    names = ["quality rules", "exact dedup", "near dedup", "secret scans", "best-fit packing"]
    stages = run_stages(spark, docs)
    assert [s[0] for s in stages] == names
    assert all(s[1] == docs.columns for s in stages[:-1])
    ids = [{r["doc_id"] for r in rows} for _, _, rows in stages]
    assert {500, 501, 502, 503, 504, 505} <= ids[0] and not {1, 2, 3, 4, 5, 506} & ids[0]
    assert ids[1] & {500, 501, 6, 7} == {501, 7}
    assert len(stages[1][2]) == len({r["text"] for r in stages[0][2]})
    near = stages[1][2]
    classes = brute_components([r["doc_id"] for r in near],
                               [brute_fingerprint(r["text"]) for r in near])
    assert ids[2] == set(classes)
    assert ids[3] == ids[2] == ids[4]
    assert not any(base_spans(r["text"]) for r in stages[3][2])
    cut = cut_documents(spark.createDataFrame(stages[3][2], docs.schema))
    assert sorted(r["ids_crc32"] for r in stages[4][2]) == sorted(
        r["ids_crc32"] for r in cut.collect())


def test_run_over_tables(spark, tmp_path):
    direct = run_stages(spark, documents(spark, TEXTS + EXTRA, extra=False))[-1][2]
    rows = corpus_pipeline.run(spark, stored(spark, tmp_path, TEXTS + EXTRA)).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in rows) == sorted(
        tuple(r[k] for k in key) for r in direct)


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, stored(spark, tmp_path, [])).collect() == []


def test_exact_dedup_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.sql(ORACLE["op8_exact_dedup"])
    rows = QUERIES["op8_exact_dedup"](spark, SMALL).select(*want.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(want.fetchall())


def test_simhash_query_over_a_table(spark):
    rows = QUERIES["op6_simhash"](spark, SMALL).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    fps = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    assert fps == {i: brute_fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    want = dict(zip(ids, brute_components(ids, [fps[i] for i in ids])))
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


def test_every_query_is_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert len(list(itertools.chain(corpus_pipeline.STAGES))) == 5
