import hashlib

from pyspark.sql import functions as F

from ledgerlens.llm.common import shared_path
from ledgerlens.llm.exact_dedup import drop_copies, exact_dedup, run_dedup_stream

from .cases import TEXTS, documents


def expected(texts):
    groups = {}
    for i, t in texts:
        groups.setdefault(t or "", []).append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids))
            for t, ids in groups.items()}


def check(rows, texts):
    want = expected(texts)
    by_digest = {hashlib.sha256(t.encode()).digest(): v for t, v in want.items()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["keep_id"], r["group_size"]) == by_digest[bytes(r["digest"])]
    assert sum(r["kept"] for r in rows) == len(want)
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_groups_nulls_repeats_and_clashing_names(spark):
    check(exact_dedup(documents(spark)).collect(), TEXTS)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []


def test_hits_are_settled_by_bytes_when_digests_clash(spark):
    weak = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))
    rows = exact_dedup(documents(spark), digest=weak).collect()
    want = expected(TEXTS)
    assert sorted((r["keep_id"] or -1, r["group_size"]) for r in rows if r["kept"]) == sorted(
        (k or -1, n) for k, n in want.values())
    assert len(rows) == len(TEXTS)


def test_state_goes_on_where_it_ended(spark):
    """Arrivals of a second run meet the state of the first."""
    path, state = shared_path(spark, "t-arrivals"), shared_path(spark, "t-state")
    rows = spark.createDataFrame(
        [(1, ("f", 0), b"a"), (2, ("f", 1), b"a"), (3, ("f", 2), b"b")],
        "doc_id long, locator struct<file: string, row: long>, digest binary")
    rows.limit(0).write.parquet(path)
    assert run_dedup_stream(rows.limit(0), path, shared_path(spark, "t-none")).count() == 0
    rows.where("doc_id < 3").write.mode("append").parquet(path)
    run_dedup_stream(spark.read.schema(rows.schema).parquet(path), path, state).collect()
    rows.where("doc_id >= 2").write.mode("append").parquet(path)
    after = run_dedup_stream(spark.read.schema(rows.schema).parquet(path), path, state)
    found = {bytes(r["digest"]): (r["keeper"]["doc_id"], r["group_size"]) for r in after.collect()}
    assert found == {b"a": (2, 3), b"b": (3, 1)}
    again = run_dedup_stream(spark.read.schema(rows.schema).parquet(path), path, state)
    assert again.count() == 2  # nothing new: the state stays


def test_drop_copies_keeps_columns_and_one_row_a_text(spark):
    docs = documents(spark)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted({t or "" for _, t in TEXTS})


def test_no_python_in_the_plan(spark):
    plan = exact_dedup(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
