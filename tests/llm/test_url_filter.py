import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

from ledgerlens.llm.queries import ORACLE, QUERIES
from ledgerlens.llm.url_filter import judge_captures, url_keys, validity_intervals

SMALL = "/root/testdata/sf0.001"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def at(n, hour=12):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)


ENTRIES = [
    ("ads", "bad.example.com", "add", day(10)), ("ads", "bad.example.com", "remove", day(100)),
    ("ads", "bad.example.com", "add", day(300)), ("ads", "bad.example.com", "add", day(310)),
    ("spam", "example.com/a/b", "add", day(0)), ("spam", "example.net", "add", day(5)),
    ("spam", "example.net", "remove", day(5)), ("ads", "Bad.org", "add", day(0)),
    (None, "x.org", "add", day(0)), ("ads", None, "add", day(0)), ("ads", "x.org", "add", None),
    ("ads", "x.org", "paint", day(0)), ("ads", "x.org", None, day(1))]
CAPTURES = [
    (1, "http://bad.example.com/x", at(9)), (2, "http://bad.example.com/x", at(10, 0)),
    (3, "https://u:p@www.BAD.example.com.:8080/", at(99, 23)), (4, "//bad.example.com", at(100, 0)),
    (5, "http://bad.example.com", at(350)), (6, "http://example.com//a/b/c?x=1", at(1)),
    (7, "http://example.com/a/bc", at(1)), (8, "http://notbad.example.com", at(20)),
    (9, "http://example.net", at(6)), (10, None, at(6)), (11, "http://bad.example.com", None),
    (12, "", at(6)), (13, "no host", at(6)), (None, "http://bad.example.com", at(20)),
    (14, "http://bad.example.com", at(20)), (14, "http://bad.example.com", at(20)),
    (15, "http://x.org", at(50)), (16, "http://" + "a." * 5000 + "com/", at(6)),
    (17, "http://www.example.com/a/b", at(400))]


def frames(spark, captures, entries):
    return (spark.createDataFrame([(*c, "?", "?") for c in captures],
                                  "capture_id long, url string, fetched_at timestamp, "
                                  "pattern string, lists string"),
            spark.createDataFrame([(*e, "?") for e in entries],
                                  "list string, pattern string, action string, "
                                  "effective_on date, day string"))


def test_verdicts(spark):
    rows = judge_captures(*frames(spark, CAPTURES, ENTRIES)).collect()
    assert len(rows) == len(CAPTURES)
    blocked = sorted((r["capture_id"] or -1, r["lists"], r["matched_on"])
                     for r in rows if r["blocked"])
    bad = ("ads", "bad.example.com")
    assert blocked == [(-1, *bad), (2, *bad), (3, *bad), (5, *bad), (6, "spam", "example.com/a/b"),
                       (14, *bad), (14, *bad)]
    assert all(r["lists"] == r["matched_on"] == "" for r in rows if not r["blocked"])
    hosts = {r["capture_id"]: r["host"] for r in rows}
    assert hosts[3] == "www.bad.example.com" and hosts[12] is None and hosts[13] is None


def test_long_histories_and_open_ends(spark):
    """Every day another state, for years: against a plain look-up."""
    entries = [("l", "h.org", "add" if n % 2 else "remove", day(n)) for n in range(0, 900, 1)]
    captures = [(n, "http://h.org/", at(n)) for n in range(-5, 1000, 3)]
    rows = judge_captures(*frames(spark, captures, entries)).collect()
    for r in rows:
        n = r["capture_id"]
        assert r["blocked"] == (n >= 0 and (n % 2 == 1 if n < 900 else True))


def test_intervals_against_a_plain_walk(spark):
    """Histories with repeated and missing actions over many periods, day by day."""
    rng = random.Random(5)
    entries = [(l, p, rng.choice(["add", "add", "remove"]), day(rng.randrange(-400, 400)))
               for l in ("a", "b") for p, n in (("hot.org", 500), ("rare.org", 6), ("one.org", 1))
               for _ in range(n)]
    want, states = set(), {}
    for l, p, action, d in entries:
        states.setdefault((l, p), {}).setdefault(d, set()).add(action)
    for (l, p), days in states.items():
        since = None
        for d in sorted(days):
            if "remove" in days[d]:
                if since:
                    want.add((l, p, since, d))
                since = None
            else:
                since = since or d
        if since:
            want.add((l, p, since, None))
    _, frame = frames(spark, [], entries)
    got = [tuple(r) for r in validity_intervals(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_nothing(spark):
    captures, entries = frames(spark, CAPTURES, ENTRIES)
    assert judge_captures(captures.limit(0), entries).collect() == []
    assert not any(r["blocked"] for r in judge_captures(captures, entries.limit(0)).collect())
    assert validity_intervals(entries.limit(0)).collect() == []


def test_keys(spark):
    keys = spark.range(1).select(url_keys(F.lit("http://a.b.org/x//y?z")).alias("k")).first()["k"]
    assert sorted(keys) == ["a.b.org", "a.b.org/x", "a.b.org/x/y", "b.org", "org"]


def test_patterns_of_any_length(spark):
    """Hosts of nine and more labels and paths of seven and more segments."""
    host, path = "a.b.c.d.e.f.g.h.org", "deep.org/1/2/3/4/5/6/7"
    captures, entries = frames(spark, [
        (1, f"http://{host}/", at(1)), (2, f"http://x.y.{host}/z", at(1)),
        (3, f"http://{host[2:]}/", at(1)), (4, f"http://{path}", at(1)),
        (5, f"http://{path}/8/9", at(1)), (6, f"http://{path[:-2]}", at(1)),
        (7, "http://other.org/", at(1))],
        [("l", host, "add", day(0)), ("l", path, "add", day(0))])
    for some, want in ((entries, {1: host, 2: host, 4: path, 5: path}),
                       (entries.where("pattern LIKE '%/%'"), {4: path, 5: path}),
                       (entries.where("pattern NOT LIKE '%/%'"), {1: host, 2: host})):
        rows = judge_captures(captures, some).where("blocked").collect()
        assert {r["capture_id"]: r["matched_on"] for r in rows} == want


def test_spellings_of_a_pattern(spark):
    """A pattern meets captures however it is written, and has one history."""
    captures, entries = frames(spark, [
        (1, "http://bad.org/", at(1)), (2, "http://BAD.org./x", at(1)),
        (3, "http://dot.com/", at(1)), (4, "http://dir.com/a/b", at(1)),
        (5, "http://dir.com/b", at(1)), (6, "http://two.net/", at(1)),
        (7, "http://two.net/", at(20)), (8, "http://port.net/", at(1)),
        (9, "http://ask.net/a", at(1)), (10, "http://dir.com/A", at(1))],
        [("l", "Bad.org", "add", day(0)), ("l", "dot.com.", "add", day(0)),
         ("l", "DIR.com//a/", "add", day(0)), ("l", "Two.net", "add", day(0)),
         ("l", "two.net.", "remove", day(10)), ("l", "https://u@port.net:81/", "add", day(0)),
         ("l", "ask.net/a?x", "add", day(0)), ("l", "/a", "add", day(0)), ("l", "", "add", day(0))])
    rows = judge_captures(captures, entries).where("blocked").collect()
    assert {r["capture_id"]: r["matched_on"] for r in rows} == {
        1: "bad.org", 2: "bad.org", 3: "dot.com", 4: "dir.com/a", 6: "two.net", 8: "port.net"}


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    want = con.sql(ORACLE["op9_url_filter"])
    rows = QUERIES["op9_url_filter"](spark, SMALL).select(*want.columns).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=key) == sorted(want.fetchall(), key=key)
