"""Registered queries of the package and the SQL of those that SQL can express."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import decode_documents, encode_documents
from .common import table
from .exact_dedup import exact_dedup
from .ngram_join import ngram_join
from .packing import pack_documents
from .quality import judge_quality
from .secret_scan import (ACCESS, ALLOWED, ASSIGN, CANDIDATE, CLASSES, HEX, KINDS, LEAST_ACCESS,
                          LEAST_ASSIGN, LEAST_HEX, PLACEHOLDER, CharacterClass, count_kind,
                          scan_secrets, span_text)
from .simhash import near_duplicates
from .spelling import spelling_variants
from .token_counts import token_counts
from .token_files import read_token_files, write_token_files
from .toxicity import score_toxicity
from .url_filter import judge_captures
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the labels not held out."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals and truncation of all documents for every context limit."""
    return token_counts(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *(count_kind("_ll_base", kind).alias(f"n_{kind}")
                    for kind in ("assign", "access", "hex")),
        F.sha2(span_text("_ll_base"), 256).alias("base_sha256"),
        span_text("_ll_spans").alias("spans"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return read_token_files(write_token_files(table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by backtracking BPE, and the texts decoded from them."""
    decoded = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents; the largest doc_id of equal texts stays."""
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in captures: every page, with a fetch time made from its id."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("capture_id"), "url",
        F.expr("TIMESTAMP_NTZ'2021-01-01 00:00:00' + make_dt_interval("
               "CAST((page_id * 7919) % 730 AS INT), 0, 0, (page_id * 31) % 86400)").alias("fetched_at"))


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in list log: every page gives one entry for its host, or for the
    first part of its path on that host."""
    site = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    part = F.regexp_extract("url", "^[a-z]+://([^/?#]+/[^/?#]+)", 1)
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("list"), (F.col("page_id") % 3).cast("string")).alias("list"),
        F.when(F.col("page_id") % 2 == 0, site).otherwise(part).alias("pattern"),
        F.when(F.col("page_id") * 13 % 4 == 0, "remove").otherwise("add").alias("action"),
        F.expr("date_add(DATE'2021-01-01', CAST((page_id * 104729) % 730 AS INT))"
               ).alias("effective_on"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page capture, judged by the list entries active when it was fetched."""
    return judge_captures(page_captures(spark, sf_dir), list_entries(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and weakly supervised verdicts of all documents."""
    return judge_quality(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all embeddings on the first eight components."""
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants in the vocabulary of all documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by links of a Jaccard similarity of 0.9 or more."""
    return ngram_join(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def _base_matches_sql(kind: int, pattern: str, group: int, least: int) -> str:
    """Spans of one base pattern: what lies between the matches, and the
    matches, in turn."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, row, {kind} AS kind, CAST(before + length(found) AS BIGINT) AS finish,
         CAST(before AS BIGINT) AS start
  FROM (SELECT doc_id, row, found, body, sum(length(gap) + coalesce(lag_length, 0)) OVER (
               PARTITION BY row ORDER BY n) AS before
        FROM (SELECT *, lag(length(found)) OVER (PARTITION BY row ORDER BY n) AS lag_length
              FROM (SELECT doc_id, row, generate_subscripts(matches, 1) AS n,
                           unnest(matches) AS found, unnest(bodies) AS body,
                           unnest(gaps[:len(matches)]) AS gap
                    FROM (SELECT doc_id, row, regexp_extract_all(t, '{quoted}') AS matches,
                                 regexp_extract_all(t, '{quoted}', {group}) AS bodies,
                                 string_split_regex(t, '{quoted}') AS gaps FROM texts))))
  WHERE length(body) >= {least}"""


def _entropy_sql(rule: CharacterClass, kind: int, member: str) -> str:
    """Candidates with a part of one class and a window in it whose sum of n * log2(n) is small
    enough; every window is counted by itself."""
    most = math.floor(rule.window * (math.log2(rule.window) - rule.least_bits) * 1_000_000)
    return f"""
  SELECT row, start, {kind} AS kind FROM (
    SELECT row, start, part, i, c, count(*) AS n
    FROM (SELECT row, start, part, i, unnest(string_split(substr(found, i, {rule.window}), '')) AS c
          FROM (SELECT *, unnest(range(1, length(found) - {rule.window} + 2)) AS i
                FROM parts WHERE {member}))
    GROUP BY ALL)
  GROUP BY row, start, part, i HAVING sum(round(n * log2(n) * 1000000)) <= {most}"""


def _op4_sql() -> str:
    base = [_base_matches_sql(k, p, g, n) for k, (p, g, n) in enumerate((
        (ASSIGN, 2, LEAST_ASSIGN), (ACCESS, 0, LEAST_ACCESS), (HEX, 0, LEAST_HEX)))]
    digits, letters = "regexp_matches(found, '[0-9]')", "regexp_matches(found, '[A-Za-z]')"
    hexes = f"{digits} AND regexp_matches(found, '^[0-9A-Fa-f]+$') AND {letters}"
    members = (hexes, f"{digits} AND {letters} AND NOT ({hexes})",
               "regexp_matches(found, '^[A-Za-z]+$')")
    suspect = [_entropy_sql(rule, KINDS.index(rule.kind), member)
               for rule, member in zip(CLASSES, members)]
    allowed = "|".join(f"({p})" for p in ALLOWED).replace("++", "+")  # nothing is possessive here
    kinds = ", ".join(f"'{k}'" for k in KINDS)

    def listed(rows: str) -> str:
        return (f"SELECT row, string_agg(([{kinds}])[kind + 1] || ':' || start || ':' || finish, ',' "
                f"ORDER BY start, kind, finish) AS spans FROM {rows} GROUP BY row")
    return f"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED ({" UNION ALL ".join(base)}),
candidates AS MATERIALIZED (
  SELECT row, start, finish, substr(t, start + 1, finish - start) AS found
  FROM ({_base_matches_sql(0, CANDIDATE, 0, 20)}) JOIN texts USING (row)),
parts AS MATERIALIZED (
  SELECT * FROM (
    SELECT row, start, generate_subscripts(pieces, 1) AS part, unnest(pieces) AS found
    FROM (SELECT row, start, string_split_regex(found, '{PLACEHOLDER}') AS pieces FROM candidates))
  WHERE NOT regexp_full_match(found, '{allowed}')),
added AS (
  SELECT s.row, min(s.kind) AS kind, c.finish, s.start
  FROM ({" UNION ALL ".join(suspect)}) s JOIN candidates c ON c.row = s.row AND c.start = s.start
  WHERE NOT EXISTS (SELECT 1 FROM base b
                    WHERE b.row = s.row AND b.start <= s.start AND c.finish <= b.finish)
  GROUP BY s.row, c.finish, s.start),
base_list AS ({listed("base")}),
all_list AS ({listed("(SELECT row, kind, finish, start FROM base UNION ALL FROM added)")}),
counts AS (
  SELECT row, count(*) FILTER (WHERE kind = 0) AS n_assign,
         count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex
  FROM base GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b.spans, '')) AS base_sha256,
       coalesce(a.spans, '') AS spans
FROM texts LEFT JOIN counts USING (row) LEFT JOIN base_list b USING (row)
     LEFT JOIN all_list a USING (row)
"""


OP9_SQL = """
WITH captures AS (
  SELECT page_id AS capture_id, url,
         make_timestamp(CAST((epoch(DATE '2021-01-01') + (page_id * 7919) % 730 * 86400
                              + (page_id * 31) % 86400) * 1000000 AS BIGINT)) AS fetched_at
  FROM pages),
entries AS (
  SELECT 'list' || (page_id % 3) AS list,
         CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)
              ELSE regexp_extract(url, '^[a-z]+://([^/?#]+/[^/?#]+)', 1) END AS pattern,
         CASE WHEN page_id * 13 % 4 = 0 THEN 'remove' ELSE 'add' END AS action,
         DATE '2021-01-01' + CAST((page_id * 104729) % 730 AS INTEGER) AS day
  FROM pages),
by_day AS (
  SELECT list, pattern, day, max(action) AS action FROM entries
  WHERE pattern IS NOT NULL GROUP BY ALL),
active AS (
  SELECT list, pattern, action, day AS valid_from,
         lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS valid_to
  FROM by_day),
parsed AS (
  SELECT *, nullif(rtrim(lower(regexp_extract(
             trim(url), '^(?:(?i)[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '')
             AS host,
         list_filter(string_split(regexp_extract(
             trim(url), '^(?:(?i)[a-z][a-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/'),
             lambda x: x <> '') AS segments
  FROM captures),
keyed AS (
  SELECT DISTINCT capture_id, url, fetched_at, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i:
      array_to_string(string_split(host, '.')[len(string_split(host, '.')) - i + 1:], '.')),
    list_transform(range(1, len(segments) + 1), lambda i:
      host || '/' || array_to_string(segments[1:i], '/')))) AS pattern
  FROM parsed WHERE host IS NOT NULL),
met AS (
  SELECT capture_id, url, fetched_at,
         string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         string_agg(DISTINCT pattern, ',' ORDER BY pattern) AS matched_on
  FROM keyed JOIN active USING (pattern)
  WHERE action = 'add' AND valid_from <= CAST(fetched_at AS DATE)
    AND (valid_to IS NULL OR CAST(fetched_at AS DATE) < valid_to)
  GROUP BY ALL)
SELECT p.capture_id, p.url, p.host, p.fetched_at, m.lists IS NOT NULL AS blocked,
       coalesce(m.lists, '') AS lists, coalesce(m.matched_on, '') AS matched_on
FROM parsed p LEFT JOIN met m
  ON p.capture_id = m.capture_id AND p.url = m.url AND p.fetched_at = m.fetched_at
"""

OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_secrets": op4_secrets,
    "op5_token_files": op5_token_files,
    "op6_simhash": op6_simhash,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_ngram_join": op13_ngram_join,
}

ORACLE: dict[str, str] = {
    "op4_secrets": _op4_sql(),
    "op8_exact_dedup": OP8_SQL,
    "op9_url_filter": OP9_SQL,
}
