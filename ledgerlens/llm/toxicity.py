"""Toxicity scores: boosted trees over dense features, calibrated.

A small public list of insults and a list learned from the training labels
give lexicon densities; the other features are how near second persons stand
to lexicon words, capitals, punctuation, and how often words are disguised.
All features come from the text alone. Gradient-boosted trees are fitted on
one part of a bounded sample of labelled rows and isotonic regression on the
other turns their probability into a calibrated score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, whole_text

#: Labelled rows the model is fitted on at most (those whose ids hash lowest).
MAX_TRAINING_ROWS = 40_000
#: Entries of the learned lexicon at most, the neighbours they were seen beside in
#: toxic texts at least, and their log odds at least.
MAX_LEARNED, MIN_CONTEXTS, MIN_LOG_ODDS = 500, 10, 2.5
TREES, DEPTH, MIN_LEAF, SEED = 20, 4, 10, 7
#: Lengths of first letters that are entries too.
STEMS = (4, 5)
HELD_OUT_REMAINDER, CALIBRATION_REMAINDER = 2, 3
TOXIC_FROM = 0.3
#: Words to either side of a lexicon word in which a second person counts.
REACH = 5
#: Share of the uncalibrated probability in a score: it parts ties only.
TIE_SHARE = 0.001

#: Insults only: no word that is an ordinary one in another corpus language.
SEED_WORDS = (
    "idiot idiots idiotic stupid moron morons moronic dumb dumbass scum trash garbage loser "
    "losers pathetic worthless disgusting clown clowns jerk creep filth filthy vermin imbecile "
    "cretin retarded bastard bitch whore slut asshole crap shit shitty bullshit fuck fucking "
    "fucker cunt prick wanker twat freak "
    "idiota idiotas imbécil estúpido estúpida basura mierda cabrón gilipollas asqueroso "
    "idiote imbécile crétin connard connasse salope merde ordure débile "
    "dummkopf idioten trottel arschloch scheiße scheisse abschaum schlampe wichser")
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta "
                 "tes vous votre vos tú ti tus usted vosotros")
_LEET, _PLAIN = "0134578@$", "oieastbas"
_SPACES = " \t\n\v\f\r\x85\xa0\u2028\u2029"
_MARKS = "!.,;:?\"'()[]{}…#*%&<>|~_-+=/\\`^¡¿«»"
FEATURES = ("seed_density", "learned_density", "stem_density", "stem_hits", "lexicon_hits",
            "near_second_person", "disguised_hits", "capitals", "shouted_words", "exclamations",
            "questions", "repeated_marks", "mixed_words", "spaced_letters")


def _words(lowered: Column, letters: str = "", read_as: str = "") -> Column:
    """Words of a lower-case text without marks; one pass over the characters
    also reads ``letters`` as others and every separator as a blank. Empty words
    between separators are left in."""
    cut = F.translate(lowered, _SPACES + letters + _MARKS, " " * len(_SPACES) + read_as)
    return F.split(cut, " ")


def plain_words(text: Column) -> Column:
    """Lower-case words without punctuation, none of them empty."""
    return F.array_remove(_words(F.lower(text)), "")


def disguised(text: Column) -> Column:
    """Do digits or signs touch letters anywhere?"""
    return text.rlike(r"\p{L}[0-9@$!*#]|[0-9@$]\p{L}")


def undisguised_words(text: Column) -> Column:
    """The words with digits and signs read as the letters they stand for, and
    empty ones, which no list has: they are looked up and not counted."""
    inside = F.regexp_replace(F.lower(text), r"(?<=\p{L})!(?=\p{L})", "i")
    return _words(inside, _LEET, _PLAIN)


def _stem(word: Column, length: int) -> Column:
    """The first letters of a word."""
    return F.substring(word, 1, length)


def learn_lexicon(training: DataFrame) -> list[str]:
    """Words, and first letters of words (marked with a final "*"), of toxic
    rather than other texts of ``training`` (text, toxic).

    An entry counts once for each word it follows, so that copies of a text, or
    a phrase that repeats, don't pass for many sightings.
    """
    words = training.select("toxic", plain_words(whole_text()).alias("w"))
    pairs = words.select("toxic", F.explode(F.expr(
        "transform(sequence(1, greatest(size(w), 1)), "
        "i -> struct(get(w, i - 1) AS word, coalesce(get(w, i - 2), '') AS after))")).alias("p"))
    word = F.col("p.word")
    entries = F.array(word, *(F.when(F.length(word) >= n, F.concat(_stem(word, n), F.lit("*")))
                              for n in STEMS))
    seen = (pairs.select(F.explode(entries).alias("entry"),
                         F.xxhash64("p.after").alias("after"), "toxic")
            .where("entry != ''").distinct()
            .groupBy("entry").agg(F.count_if(F.col("toxic") == 1).alias("toxic_n"),
                                  F.count_if(F.col("toxic") == 0).alias("other_n")))
    seen = store(seen, "word-contexts")
    n = seen.agg(F.sum("toxic_n").alias("t"), F.sum("other_n").alias("o")).first()
    odds = (F.log((F.col("toxic_n") + 0.5) / ((n["t"] or 0) + 1.0))
            - F.log((F.col("other_n") + 0.5) / ((n["o"] or 0) + 1.0)))
    top = (seen.where(F.col("toxic_n") >= MIN_CONTEXTS).withColumn("odds", odds)
           .where(F.col("odds") >= MIN_LOG_ODDS)
           .orderBy(F.desc("odds"), "entry").limit(MAX_LEARNED))
    return [r["entry"] for r in top.collect()]  # at most MAX_LEARNED entries


def with_features(docs: DataFrame, learned: list[str]) -> DataFrame:
    """``docs`` and the features (prefix ``_ll_``); null texts are empty."""
    seeds = SEED_WORDS.split()
    stems = [e for e in learned if e.endswith("*")]
    learned = [e for e in learned if not e.endswith("*")]
    lexicon = sorted({*seeds, *learned})
    second = SECOND_PERSON.split()
    text = F.col("_ll_t")

    def in_lexicon(word: Column) -> Column:
        return word.isin(lexicon)

    def stemmed(word: Column) -> Column:
        known = F.lit(False)
        for length in STEMS:
            if mine := [e[:-1] for e in stems if len(e) == length + 1]:
                known = known | _stem(word, length).isin(mine)
        return known

    def word_at(i: Column) -> Column:
        return F.get("_ll_w", i - 1)

    # one pass over all words; what follows looks at the few places found
    out = (docs.withColumn("_ll_t", whole_text())
           .withColumn("_ll_w", plain_words(text))
           .withColumn("_ll_found", F.filter(
               F.sequence(F.lit(1), F.size("_ll_w")),
               lambda i: in_lexicon(word_at(i)) | stemmed(word_at(i))))
           .withColumn("_ll_hit", F.filter("_ll_found", lambda i: in_lexicon(word_at(i))))
           .withColumn("_ll_touch", disguised(text))
           .withColumn("_ll_bare", F.when(F.col("_ll_touch"), F.size(F.filter(
               undisguised_words(text), in_lexicon))).otherwise(0)))
    n = F.greatest(F.size("_ll_w"), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    hits = F.size("_ll_hit")
    stem_hits = F.size(F.filter("_ll_found", lambda i: stemmed(word_at(i))))

    def found(among: list[str]) -> Column:
        if not among:
            return F.lit(0)
        return F.size(F.filter("_ll_hit", lambda i: word_at(i).isin(among)))

    near = F.size(F.filter("_ll_hit", lambda i: F.exists(
        F.slice("_ll_w", F.greatest(i - REACH, F.lit(1)), 2 * REACH + 1),
        lambda w: w.isin(second))))
    capitals = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))

    def rate(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / n

    def share(mark: str) -> Column:
        return (F.length(text) - F.length(F.replace(text, F.lit(mark)))) / chars

    values = {
        "seed_density": found(seeds) / n, "learned_density": found(learned) / n,
        "stem_density": stem_hits / n, "stem_hits": F.log1p(stem_hits.cast("double")),
        "lexicon_hits": F.log1p(hits.cast("double")), "near_second_person": near / n,
        "disguised_hits": F.greatest(F.col("_ll_bare") - hits, F.lit(0)) / n,
        "capitals": capitals / chars, "shouted_words": rate(r"\p{Lu}{3,}"),
        "exclamations": share("!"), "questions": share("?"),
        "repeated_marks": rate(r"[!?]{2,}"),
        "mixed_words": F.when(F.col("_ll_touch"), rate(r"\p{L}[0-9@$!*#]+\p{L}")).otherwise(0.0),
        "spaced_letters": rate(r"(?:\b\p{L}[ .]){4,}"),
    }
    return out.select(*docs.columns, *(values[f].cast("double").alias(f"_ll_{f}")
                                       for f in FEATURES))


def _remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text modulo four; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


@dataclass(frozen=True)
class ToxicityModel:
    """Fitted trees and calibration; without both classes to learn from, only
    the share of toxic rows, which every text then gets as its score."""

    learned: list[str]
    base_rate: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None

    def score(self, featured: DataFrame) -> DataFrame:
        """``featured`` and ``_ll_score``."""
        if self.trees is None or self.calibration is None:
            return featured.withColumn("_ll_score", F.lit(self.base_rate))
        scored = self.calibration.transform(_probability(featured, self.trees))
        mixed = (1 - TIE_SHARE) * F.col("_ll_calibrated") + TIE_SHARE * F.col("_ll_p")
        return scored.withColumn("_ll_score", F.least(F.greatest(mixed, F.lit(0.0)), F.lit(1.0)))


def _assembled(featured: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_ll_{f}" for f in FEATURES],
                           outputCol="_ll_vector").transform(featured)


def _probability(featured: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    return trees.transform(_assembled(featured)).withColumn(
        "_ll_p", vector_to_array("_ll_probability")[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame,
                 max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Fit on rows of ``labels`` (doc_id, toxic) that are not held out."""
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
             .where(_remainder() != HELD_OUT_REMAINDER)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = store(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "toxic-labels")
    training = store(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"),
                     "toxic-training")  # the sample's size is bounded by max_rows
    learned = learn_lexicon(training.where(_remainder() != CALIBRATION_REMAINDER))
    featured = store(with_features(training, learned).drop("text").withColumn(
        "_ll_label", F.col("toxic").cast("double")), "toxic-features")
    part = _remainder() == CALIBRATION_REMAINDER
    counts = featured.groupBy(part.alias("part"), "_ll_label").count().collect()  # four rows
    toxic = sum(r["count"] for r in counts if r["_ll_label"] == 1)
    rate = toxic / max(1, sum(r["count"] for r in counts))
    if {(r["part"], r["_ll_label"]) for r in counts} < {
            (a, b) for a in (False, True) for b in (0.0, 1.0)}:
        return ToxicityModel(learned, rate)
    booster = GBTClassifier(featuresCol="_ll_vector", labelCol="_ll_label", maxIter=TREES,
                            maxDepth=DEPTH, minInstancesPerNode=MIN_LEAF, seed=SEED,
                            predictionCol="_ll_prediction")
    booster.setProbabilityCol("_ll_probability").setRawPredictionCol("_ll_raw")
    trees = booster.fit(_assembled(featured.where(~part)))
    calibration = IsotonicRegression(
        featuresCol="_ll_p", labelCol="_ll_label", predictionCol="_ll_calibrated",
    ).fit(_probability(featured.where(part), trees).select("_ll_p", "_ll_label"))
    return ToxicityModel(learned, rate, trees, calibration)


def score_toxicity(docs: DataFrame, labels: DataFrame,
                   max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Fit on ``labels`` and score every row of ``docs`` (columns doc_id and
    text; others ignored): doc_id, held_out, score, predicted.

    A null text is empty and gets the score of a text without words; a null
    doc_id is not held out; repeated rows get equal scores; an empty table
    gives no rows. Without labels of both classes every score is their share of
    toxic rows (0 without labels).
    """
    model = fit_toxicity(docs, labels, max_rows)
    scored = model.score(with_features(docs.select("doc_id", "text"), model.learned).drop("text"))
    return scored.select(
        "doc_id", (_remainder() == HELD_OUT_REMAINDER).alias("held_out"),
        F.col("_ll_score").alias("score"),
        (F.col("_ll_score") >= TOXIC_FROM).cast("int").alias("predicted"))
