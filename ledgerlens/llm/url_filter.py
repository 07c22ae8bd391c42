"""URL filters with dated lists: a temporal join.

A list is a log of dated entries: on a date a pattern (a host and all hosts
below it, or a host and a path prefix) is added to or taken from a list; a day
is the least step of its history. An entry becomes a validity interval that
ends where the next entry for the same pattern and list begins. A capture is
judged by the entries active when it was fetched, whatever the list says today.

A capture has as keys the suffixes of its host and the prefixes of its path,
each of which can meet a pattern; longer ones than any pattern of the entries
are not made, as nothing can meet them. Intervals are cut at
the borders of periods and captures are put in the period of their fetch, so
the as-of join is an equality join on key and period that compares a capture
with the intervals of that period only: at most one a list and day, however
long the history. A hot host is dealt over the periods, and what is still hot
there is a join key that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a period of the join, in days.
PERIOD_DAYS = 32


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if there is none."""
    host = F.regexp_extract(F.trim(url), r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.rtrim(F.lower(host), F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    """Path without query and fragment, repeated slashes as one; at least "/"."""
    path = F.regexp_extract(F.trim(url), r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(F.concat(F.lit("/"), path), "/+", "/")


def segments_of(url: Column) -> Column:
    """The parts of the path between slashes."""
    return F.filter(F.split(path_of(url), "/"), lambda s: s != "")


def normal_pattern(pattern: Column) -> Column:
    """``pattern`` as ``url_keys`` writes keys: the host in lower case without
    user, port and final dot, single slashes and none at the end. One without
    host name, or with a query or fragment, meets nothing and stays as it is."""
    trimmed = F.trim(pattern)
    url = F.when(trimmed.rlike(r"^(?i:[a-z][a-z0-9+.-]*:)?//"), trimmed).otherwise(
        F.concat(F.lit("//"), trimmed))
    host = host_of(url)
    return F.when(host.isNull() | pattern.rlike(r"[?#\[]"), pattern).otherwise(
        F.array_join(F.concat(F.array(host), segments_of(url)), "/"))


def url_keys(url: Column, most_labels: int | None = None,
             most_segments: int | None = None) -> Column:
    """Keys that a pattern can have to meet ``url``: "host" for the host and
    those above it, and "host/segment/..." for prefixes of its path; those of
    more labels or segments than given are left out."""
    host, segments = host_of(url), segments_of(url)
    labels = F.split(host, r"\.")

    def upto(n: Column, most: int | None, key: Callable[[Column], Column]) -> Column:
        last = n if most is None else F.least(n, F.lit(most))
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), key)).otherwise(
            F.array().cast("array<string>"))

    n = F.size(labels)
    hosts = upto(n, most_labels, lambda i: F.array_join(F.slice(labels, n - i + 1, i), "."))
    paths = upto(F.size(segments), most_segments, lambda i: F.concat_ws(
        "/", host, F.array_join(F.slice(segments, 1, i), "/")))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(hosts, paths)))


def _known(entries: DataFrame) -> DataFrame:
    """The entries that say something: list, pattern as keys are written, action,
    day."""
    return entries.select("list", normal_pattern(F.col("pattern")).alias("pattern"), "action",
                          F.to_date("effective_on").alias("day")).where(
        "list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL "
        "AND action IN ('add', 'remove')")


def longest_patterns(entries: DataFrame) -> tuple[int, int]:
    """The most labels of a host pattern and the most segments of a path pattern
    among added entries; 0 where there is none."""
    parts = F.size(F.split("pattern", "/"))
    labels = F.when(parts == 1, F.size(F.split("pattern", r"\.")))
    most = _known(entries).where("action = 'add'").agg(
        F.max(labels).alias("labels"), F.max(parts - 1).alias("segments")).first()
    return most["labels"] or 0, most["segments"] or 0


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``entries`` (list, pattern, action "add" or "remove", effective_on) as
    intervals of days (list, pattern, valid_from, valid_to); valid_to is the
    first day after, null for open ones.

    Of entries for one pattern and list on the same day, "remove" wins. An
    entry without pattern, list or day says nothing and is left out, and so is
    an unknown action. Repeated additions prolong an interval. Spellings of one
    pattern (case of the host, port, final dot, slashes) are one history, under
    the spelling of the keys.

    No task holds the whole history of a pattern: the days of a period see each
    other, and of other periods only their last action and first removal.
    """
    own = ["list", "pattern", "period"]
    by_day = (_known(entries).groupBy("list", "pattern", "day").agg(F.max("action").alias("action"))
              .withColumn("period", _period(F.col("day"))))
    removed = F.when(F.col("action") == "remove", F.col("day"))
    periods = by_day.groupBy(*own).agg(F.max_by("action", "day").alias("last_action"),
                                       F.min(removed).alias("first_removal"))
    earlier = Window.partitionBy("list", "pattern").orderBy("period")
    later = (Window.partitionBy("list", "pattern").orderBy(F.desc("period"))
             .rowsBetween(Window.unboundedPreceding, -1))
    borders = periods.select(*own, F.lag("last_action").over(earlier).alias("action_before"),
                             F.min("first_removal").over(later).alias("removal_after"))
    days = Window.partitionBy(*own).orderBy("day")
    backwards = (Window.partitionBy(*own).orderBy(F.desc("day"))
                 .rowsBetween(Window.unboundedPreceding, -1))
    within = (by_day.withColumn("before", F.lag("action").over(days))
              .withColumn("removal", F.min(removed).over(backwards)))
    return (within.join(borders, own)
            .where(~F.coalesce("before", "action_before").eqNullSafe(F.lit("add")))
            .where("action = 'add'")
            .select("list", "pattern", F.col("day").alias("valid_from"),
                    F.coalesce("removal", "removal_after").alias("valid_to")))


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD_DAYS)


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every row of ``captures`` (capture_id, url, fetched_at; others ignored)
    with the lists that block it: capture_id, url, host, fetched_at, blocked,
    lists (distinct, sorted, comma-joined), matched_on (the patterns, likewise).

    A capture without host or time, or that no active entry meets, is not
    blocked. Capture ids need not be unique; equal rows get equal results.
    """
    rows = captures.select("capture_id", "url", "fetched_at")
    visits = rows.where("url IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    keyed = visits.select("capture_id", "url", "fetched_at",
                          F.to_date("fetched_at").alias("day"),
                          _period(F.to_date("fetched_at")).alias("period"),
                          F.explode(url_keys(F.col("url"), *longest_patterns(entries))
                                    ).alias("pattern"))
    period = _period(F.to_date("fetched_at"))
    span = captures.agg(F.min(period).alias("first"), F.max(period).alias("last")).first()
    if span["last"] is None:  # no capture has a time
        span = {"first": 0, "last": 0}
    intervals = validity_intervals(entries)
    first = F.greatest(_period(F.col("valid_from")), F.lit(span["first"]))
    last = F.least(F.coalesce(_period(F.col("valid_to")), F.lit(span["last"])),
                   F.lit(span["last"]))
    active = (intervals.withColumn("first", first).withColumn("last", last)
              .where("first <= last")
              .withColumn("period", F.explode(F.sequence("first", "last"))).drop("first", "last"))
    met = (keyed.join(active, ["pattern", "period"])
           .where((F.col("valid_from") <= F.col("day"))
                  & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))))
    blocked = met.groupBy("capture_id", "url", "fetched_at").agg(
        F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"),
        F.array_join(F.sort_array(F.collect_set("pattern")), ",").alias("matched_on"))
    blocked = blocked.toDF("_id", "_url", "_at", "lists", "matched_on")
    return rows.join(blocked, F.expr("capture_id <=> _id AND url <=> _url AND fetched_at <=> _at"),
                     "left").select(
        "capture_id", "url", host_of(F.col("url")).alias("host"), "fetched_at",
        F.col("lists").isNotNull().alias("blocked"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce("matched_on", F.lit("")).alias("matched_on"))
