"""Secret scans in SQL expressions only: patterns, and sliding-window entropy.

Places of pattern matches come from cutting a text at the matches: the text
between them and the matches themselves, in turn, give every start and end.

Strings that could be random are judged by the Shannon entropy of a window
that slides over them. Each class of characters has its own window and limit.
The counts of the characters in the window change by one in and one out a
step, and so does the sum of n * log2(n) over them, which is kept in whole
millionths so that no rounding depends on the way; the entropy is
log2(window) - sum / window. Strings known to be harmless are let through, and
a placeholder excuses itself only: what stands beside it is judged without it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

# The base patterns, and the least characters of a match that
# counts (of the second group for "assign").
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed", "entropy_letters")
_UNIT = 1_000_000


@dataclass(frozen=True)
class CharacterClass:
    """Strings that match ``member``; a window of ``window`` characters is
    suspect from ``least_bits`` of entropy on, and with it the whole string."""

    kind: str
    member: str
    window: int
    least_bits: float


#: The first class that a candidate belongs to judges it.
CLASSES = (
    CharacterClass("entropy_hex", "^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 20, 2.9),
    CharacterClass("entropy_mixed", "^(?=.*[0-9])(?=.*[A-Za-z]).+$", 20, 3.7),
    CharacterClass("entropy_letters", "^[A-Za-z]+$", 24, 4.2),
)
#: Candidate strings: long runs of characters that keys are written in.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Placeholders. They are cut out of a candidate, and what they leave is judged.
PLACEHOLDER = "(?i:example|placeholder|your|xxxx|changeme|dummy|sample)"
#: Harmless strings, matched as a whole: UUIDs, runs of digits, dates and
#: times, paths and names made of words. The words' quantifiers are possessive,
#: so that a path of any number of words is matched in a loop, not by recursion.
ALLOWED = (
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"[0-9+/_=-]+",
    r"\d{4}-\d{2}-\d{2}T?[0-9-]*Z?",
    r"[A-Za-z]++([/_=-][A-Za-z]++)++[0-9]{0,4}",
)
#: Windows that are judged in one go: long candidates are read in stretches.
WINDOWS_AT_ONCE = 200


def _cut(text: Column, pattern: str, found: Column, good: Column, kind: int) -> Column:
    """Spans (start, kind, end) of the matches ``found`` of ``pattern`` for
    which the array ``good`` holds; code points, end exclusive."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"),
                         F.transform(found, F.length).alias("size"), good.alias("good"))
    none = F.expr("CAST(array() AS array<struct<start: int, kind: int, end: int>>)")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["size"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(part["good"], F.concat(
            state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step,
                        lambda state: state["spans"])
    return F.when(F.exists(good, lambda x: x), spans).otherwise(none)


def _matches(docs: DataFrame, text: str, pattern: str, kind: int, group: int,
             least: int) -> DataFrame:
    """``docs`` and the spans ``_ll_s<kind>`` of one base pattern. Hex runs are
    short and common, so runs below the least length don't open a text."""
    quick = pattern if pattern != HEX else f"[0-9a-f]{{{least}}}"
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    body = found if group == 0 else F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
    none = F.expr("CAST(array() AS array<struct<start: int, kind: int, end: int>>)")
    return docs.withColumn(f"_ll_s{kind}", F.when(
        F.col(text).rlike(quick),
        _cut(F.col(text), pattern, found, F.transform(body, lambda x: F.length(x) >= least),
             kind)).otherwise(none))


def _gain_table(window: int) -> str:
    """n * log2(n) for n from 0 to ``window``, in whole millionths."""
    return "array(" + ", ".join(
        f"{round(n * math.log2(n) * _UNIT) if n else 0}L" for n in range(window + 1)) + ")"


def _suspect(candidate: str, rule: CharacterClass) -> str:
    """SQL: is any window of ``candidate`` suspect? Up to the first stretch of
    WINDOWS_AT_ONCE windows that has one; stretches overlap by a window less
    one, so each window lies in one of them. Bytes: candidates are ASCII."""
    w = rule.window
    return f"""exists(sequence(1, greatest(1, length({candidate}) - {w - 1}), {WINDOWS_AT_ONCE}), at ->
      {_suspect_stretch(f"CAST(substring(CAST({candidate} AS BINARY), at, {WINDOWS_AT_ONCE + w - 1}) AS STRING)",
                        rule)})"""


def _suspect_stretch(stretch: str, rule: CharacterClass) -> str:
    """SQL: is any window of ``stretch`` suspect? By incremental counts."""
    w = rule.window
    most = math.floor(w * (math.log2(w) - rule.least_bits) * _UNIT)
    # state: codes and table ride along, so that they are made once a stretch
    return f"""aggregate(
      sequence(1, length({stretch})),
      named_struct('codes', transform(split({stretch}, ''), c -> ascii(c)),
                   'gain', {_gain_table(w)}, 'counts', array_repeat(0, 128),
                   'total', 0L, 'hit', false),
      (a, i) -> aggregate(array(named_struct(
            'come', a.codes[i - 1],
            'gone', IF(i > {w}, get(a.codes, i - {w} - 1), -1))),
          a, (b, x) -> aggregate(array(b.total
              - IF(x.gone < 0, 0L, get(b.gain, get(b.counts, x.gone))
                                   - get(b.gain, get(b.counts, x.gone) - 1))
              + get(b.gain, b.counts[x.come] - IF(x.come = x.gone, 1, 0) + 1)
              - get(b.gain, b.counts[x.come] - IF(x.come = x.gone, 1, 0))),
            b, (d, t) -> named_struct(
              'codes', d.codes, 'gain', d.gain,
              'counts', transform(d.counts, (n, k) ->
                  n + IF(k = x.come, 1, 0) - IF(k = x.gone, 1, 0)),
              'total', t,
              'hit', d.hit OR (i >= {w} AND t <= {most})))),
      a -> a.hit)"""


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _entropy_spans(docs: DataFrame, text: str, allowed: tuple[str, ...],
                   placeholder: str) -> DataFrame:
    """``docs`` and ``_ll_entropy``: candidates with a suspect window, whole."""
    harmless = "^(" + "|".join(f"({p})" for p in allowed) + ")$" if allowed else "^$"
    found = F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0))
    docs = docs.withColumn("_ll_found", F.when(F.col(text).rlike(CANDIDATE), found))
    where = _cut(F.col(text), CANDIDATE, F.col("_ll_found"),
                 F.transform("_ll_found", lambda x: F.lit(True)), 0)
    docs = docs.withColumn("_ll_where", F.when(F.col("_ll_found").isNotNull(), where))
    tests = " ".join(
        f"WHEN c RLIKE '{rule.member}' AND length(c) >= {rule.window} THEN "
        f"IF({_suspect('c', rule)}, {KINDS.index(rule.kind)}, NULL)"
        for rule in CLASSES)
    judged = F.expr(f"""transform(_ll_found, whole -> array_min(transform(
        split(whole, '{_quoted(placeholder)}'),
        c -> CASE WHEN c RLIKE '{_quoted(harmless)}' THEN NULL {tests} END)))""")
    docs = docs.withColumn("_ll_judged", F.when(F.col("_ll_found").isNotNull(), judged))
    spans = F.expr("""filter(transform(arrays_zip(_ll_where, _ll_judged), z -> struct(
        z._ll_where.start AS start, z._ll_judged AS kind, z._ll_where.end AS end)),
        s -> s.kind IS NOT NULL)""")
    none = F.expr("CAST(array() AS array<struct<start: int, kind: int, end: int>>)")
    return docs.withColumn("_ll_entropy", F.coalesce(
        F.when(F.col("_ll_found").isNotNull(), spans), none)).drop(
            "_ll_found", "_ll_where", "_ll_judged")


def scan_secrets(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED,
                 placeholder: str = PLACEHOLDER) -> DataFrame:
    """``docs`` with ``_ll_base`` and ``_ll_spans``: sorted arrays of (start,
    kind, end) of the base matches, and of those and what entropy adds.

    A null text is empty and has none. Base matches are the leftmost that don't
    overlap, each kind by itself; too short ones are dropped. An entropy span
    inside a base span adds nothing and is left out; it is the whole candidate
    string, of the first kind that any part of it between placeholders has.

    Rows that repeat are scanned each for itself, an empty table gives no rows,
    other columns are kept as they are, and texts and candidates of any length
    are read whole, in time in proportion to a candidate's length.
    """
    out = docs.withColumn("_ll_t", whole_text())
    for kind, (pattern, group, least) in enumerate((
            (ASSIGN, 2, LEAST_ASSIGN), (ACCESS, 0, LEAST_ACCESS), (HEX, 0, LEAST_HEX))):
        out = _matches(out, "_ll_t", pattern, kind, group, least)
    out = _entropy_spans(out, "_ll_t", allowed, placeholder)
    out = out.withColumn("_ll_base", F.sort_array(F.concat("_ll_s0", "_ll_s1", "_ll_s2")))
    added = F.expr("filter(_ll_entropy, e -> NOT exists(_ll_base, "
                   "b -> b.start <= e.start AND e.end <= b.end))")
    return out.withColumn("_ll_spans", F.when(F.size("_ll_entropy") > 0, F.sort_array(
        F.concat("_ll_base", added))).otherwise(F.col("_ll_base"))).drop(
            "_ll_t", "_ll_s0", "_ll_s1", "_ll_s2", "_ll_entropy")


def span_text(spans: str) -> Column:
    """The spans as ``kind:start:end``, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', "
                  f"array({names})[s.kind], s.start, s.end)), ',')")


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of a secret in ``text`` replaced by ``mark``
    (overlapping spans by one) and ``n_chars``, where there is one, renewed.
    Texts without secrets, null ones too, stay as they are. Every row stays, so
    repeated rows do and an empty table is empty; texts are read whole."""
    scanned = scan_secrets(docs).withColumn("_ll_mark", F.lit(mark))
    clean = F.expr("""aggregate(_ll_spans, named_struct('text', '', 'upto', 0),
        (a, s) -> IF(s.start >= a.upto,
            named_struct('text', concat(a.text, substr(text, a.upto + 1, s.start - a.upto),
                                        _ll_mark), 'upto', s.end),
            named_struct('text', a.text, 'upto', greatest(a.upto, s.end))),
        a -> concat(a.text, substr(text, a.upto + 1)))""")
    hit = F.size("_ll_spans") > 0
    out = scanned.withColumn("text", F.when(hit, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
