"""Quality rules combined by weak supervision, in SQL expressions only.

Each rule looks at measures of a text and votes good (1), bad (0) or abstains
(null). Expectation-maximisation estimates how often each rule is right about
good and about bad texts, without labels, from the counts of vote patterns (at
most 3 ** number of rules rows, whatever the corpus); the posterior
probability that a text is good then replaces "all rules must pass".
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, whole_text

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_PROBABILITY = 0.5
#: Rounds of expectation-maximisation at most, and the change that ends them.
MAX_ROUNDS, TOLERANCE = 20, 1e-3
#: What is held before any vote is seen: most texts are good, a rule almost
#: never accuses a good text and notices one bad text in four; the latter two
#: as strongly as this many votes would say.
PRIOR_GOOD, PRIOR_ON_GOOD, PRIOR_ON_BAD, PRIOR_VOTES = 0.7, 0.995, 0.25, 20.0
#: Bounds that keep "good" and "bad" from changing places: a rule that accused
#: more than one good text in fifty would not have been written.
GOOD_RANGE, ON_GOOD_RANGE, ON_BAD_RANGE = (0.05, 0.95), (0.98, 0.999), (0.05, 0.95)
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the corpus languages.
FUNCTION_WORDS = (
    "the of and to in is that for with as on was are this it at by from or an",
    "der die das und ist nicht ein eine den von zu mit sich auf für im dem des als auch",
    "le la les de des et un une est que dans pour pas sur du en qui au par plus",
    "el los las que y en un una por con para del se no es su al lo como más",
)
MEASURES = "_ll_measures"

_HASHES = ("transform(sequence(0, size(_ll_w) - 3), "
           "i -> xxhash64(_ll_w[i], _ll_w[i + 1], _ll_w[i + 2]))")
#: Windows that occur twice, by sorting (hash, place) and looking beside.
_SORTED = "sort_array(transform(_ll_h, (x, i) -> struct(x AS hash, i AS place)))"
_TWICE = ("sort_array(transform(filter(_ll_s, (x, i) -> get(_ll_s, i - 1).hash <=> x.hash "
          "OR get(_ll_s, i + 1).hash <=> x.hash), x -> x.place))")
#: Words under any of those windows; each counts once.
_COVERED = ("aggregate(_ll_p, struct(0L AS n, 0 AS upto), (a, i) -> struct("
            "a.n + i + 3 - greatest(i, a.upto) AS n, i + 3 AS upto), a -> a.n)")


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` and a struct ``_ll_measures`` of what the rules look at.

    Words are what the six ASCII separators leave; a null text has none. Three
    word windows are compared by their 64-bit hashes within one text.
    """
    n = F.size("_ll_w").cast("long")
    steps = (docs.withColumn("_ll_t", whole_text())
             .withColumn("_ll_w", F.array_remove(
                 F.split(F.translate("_ll_t", "\t\n\v\f\r", "     "), " "), ""))
             .withColumn("_ll_h", F.when(n >= 3, F.expr(_HASHES)))
             .withColumn("_ll_s", F.when(F.size(F.array_distinct("_ll_h")) < F.size("_ll_h"),
                                         F.expr(_SORTED)))
             .withColumn("_ll_p", F.when(F.col("_ll_s").isNotNull(), F.expr(_TWICE)))
             .withColumn("_ll_l", F.filter(F.split("_ll_t", "\n"),
                                           lambda x: x.rlike(r"[^\x20\x09-\x0D]"))))
    text = F.col("_ll_t")
    bare = F.translate(text, SYMBOLS, "")
    lowered = F.array_distinct(F.transform("_ll_w", F.lower))
    stop = F.array(*(F.lit(w) for w in sorted({w for ws in FUNCTION_WORDS for w in ws.split()})))
    measures = F.struct(
        n.alias("n_words"),
        F.length(F.array_join("_ll_w", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(bare)).cast("long").alias("n_symbols"),
        F.size("_ll_l").cast("long").alias("n_lines"),
        (F.size("_ll_l") - F.size(F.array_distinct("_ll_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("_ll_p").isNotNull(), F.expr(_COVERED)),
                   F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lowered).cast("long").alias("n_distinct"),
        F.size(F.array_intersect(lowered, stop)).cast("long").alias("n_function_words"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace(text, r"[^0-9]+", "")).cast("long").alias("n_digits"))
    return steps.withColumn(MEASURES, measures).drop(
        "_ll_t", "_ll_w", "_ll_h", "_ll_s", "_ll_p", "_ll_l")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1)


def rule_votes() -> dict[str, Column]:
    """The rules over ``_ll_measures``; a text without words gets only the
    vote on its length."""
    m = {f: F.col(f"{MEASURES}.{f}") for f in (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "n_distinct", "n_function_words", "n_capitals", "n_digits")}
    words, chars = m["n_words"], m["word_chars"]
    some = words > 0
    return {
        "length": _vote(words >= 2 * MIN_WORDS, words < MIN_WORDS),
        "heavy_symbols": _vote(some & (100 * m["n_symbols"] <= 2 * words),
                               4 * m["n_symbols"] > words),
        "word_length": _vote(some & chars.between(3 * words, 10 * words),
                             some & ~chars.between(2 * words, 14 * words)),
        "symbols": _vote(some & (100 * m["n_symbols"] <= 2 * words),
                         10 * m["n_symbols"] > words),
        "duplicate_lines": _vote((m["n_lines"] >= 3) & (m["n_dup_lines"] == 0),
                                 (m["n_lines"] >= 6) & (10 * m["n_dup_lines"] > 3 * m["n_lines"])),
        "repetition": _vote(some & (100 * m["n_repeat_words"] <= 5 * words),
                            100 * m["n_repeat_words"] > 30 * words),
        "variety": _vote(some & (100 * m["n_distinct"] >= 30 * words),
                         (words >= MIN_WORDS) & (100 * m["n_distinct"] < 10 * words)),
        "function_words": _vote(m["n_function_words"] >= 3,
                                (words >= MIN_WORDS) & (m["n_function_words"] == 0)),
        "capitals": _vote(some & (5 * m["n_capitals"] <= chars), 2 * m["n_capitals"] > chars),
        "digits": _vote(some & (10 * m["n_digits"] <= chars), 10 * m["n_digits"] > 3 * chars),
    }


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and how often each rule's vote is right about good
    and about bad ones."""

    good_share: float
    right_on_good: dict[str, float]
    right_on_bad: dict[str, float]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """Probability that a text is good, from its votes."""
        odds = F.lit(math.log(self.good_share / (1 - self.good_share)))
        for rule, vote in votes.items():
            good, bad = self.right_on_good[rule], self.right_on_bad[rule]
            odds = odds + (F.when(vote == 1, F.lit(math.log(good / (1 - bad))))
                           .when(vote == 0, F.lit(math.log((1 - good) / bad))).otherwise(0.0))
        return 1 / (1 + F.exp(-odds))


def _held(x: float, low: float, high: float) -> float:
    return round(min(max(x, low), high), 6)


def fit_label_model(measured: DataFrame) -> LabelModel:
    """Expectation-maximisation over the vote patterns of those texts of
    ``measured`` that don't fail outright (their verdict needs no vote)."""
    rules = rule_votes()
    names = list(rules)
    patterns = store(measured.where(~_failed()).select(*(v.alias(r) for r, v in rules.items()))
                     .groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "vote-patterns")
    model = LabelModel(PRIOR_GOOD, {r: PRIOR_ON_GOOD for r in names},
                       {r: PRIOR_ON_BAD for r in names})
    votes = {r: F.col(r) for r in names}
    for _ in range(MAX_ROUNDS):
        good = F.col("n") * F.col("q")
        bad = F.col("n") - good
        sums = [F.sum("n").alias("all"), F.sum(good).alias("good")]
        for r in names:
            sums += [F.sum(F.when(F.col(r) == 1, good)).alias(f"{r}_good_right"),
                     F.sum(F.when(F.col(r).isNotNull(), good)).alias(f"{r}_good"),
                     F.sum(F.when(F.col(r) == 0, bad)).alias(f"{r}_bad_right"),
                     F.sum(F.when(F.col(r).isNotNull(), bad)).alias(f"{r}_bad")]
        s = patterns.withColumn("q", model.posterior(votes)).agg(*sums).first()
        if not s["all"]:
            return model

        def accuracy(r: str, side: str, prior: float, within: tuple[float, float]) -> float:
            right = (s[f"{r}_{side}_right"] or 0.0) + prior * PRIOR_VOTES
            return _held(right / ((s[f"{r}_{side}"] or 0.0) + PRIOR_VOTES), *within)

        after = LabelModel(
            _held(s["good"] / s["all"], *GOOD_RANGE),
            {r: accuracy(r, "good", PRIOR_ON_GOOD, ON_GOOD_RANGE) for r in names},
            {r: accuracy(r, "bad", PRIOR_ON_BAD, ON_BAD_RANGE) for r in names})
        change = max(abs(after.good_share - model.good_share),
                     *(abs(a[r] - b[r]) for a, b in ((after.right_on_good, model.right_on_good),
                                                     (after.right_on_bad, model.right_on_bad))
                       for r in names))
        model = after
        if change < TOLERANCE:
            break
    return model


def _failed() -> Column:
    words, repeats = F.col(f"{MEASURES}.n_words"), F.col(f"{MEASURES}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def _verdict(measured: DataFrame, model: LabelModel) -> DataFrame:
    return (measured.withColumn("_ll_failed", _failed())
            .withColumn("_ll_quality", model.posterior(rule_votes()))
            .withColumn("_ll_kept", ~F.col("_ll_failed")
                        & (F.col("_ll_quality") >= KEEP_PROBABILITY)))


def judge_quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (columns doc_id and text;
    others ignored): doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, quality (posterior probability).

    A null or empty text has no words and fails; a null doc_id and repeated
    rows are judged like any other; an empty table gives no rows.
    """
    measured = store(measure(docs.select("doc_id", "text")).select("doc_id", MEASURES), "measures")
    judged = _verdict(measured, fit_label_model(measured))
    return judged.select(
        "doc_id", *(F.col(f"{MEASURES}.{f}").alias(f) for f in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("_ll_failed").alias("base_failed"), F.col("_ll_kept").alias("kept"),
        F.col("_ll_quality").alias("quality"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and no others.

    Null and empty texts fail the base rules and go; repeated rows and null ids
    are judged row by row; texts of any length are read whole; an empty table
    gives no rows.
    """
    measured = store(measure(docs), "measured-documents")
    return _verdict(measured, fit_label_model(measured)).where("_ll_kept").select(*docs.columns)
