"""Spelling variants by permuterm rotations.

A word is closed by a mark and rotated: the rotation at place i is the rest of
the word from i on, the mark, and what precedes i. Words that differ in the
character at i alone have rotations from i + 1 on that agree up to their last
character, which is the edited one; the word that lacks it has that common part
as a rotation of its own. So every edit of one character, be it a replacement,
an insertion or a deletion, is a range of sorted rotations with one prefix that
skips the edited character.

All rotations are sorted by prefix and scanned. A range holds at most one word
a character of the alphabet and one without it, whatever the vocabulary, and
for each of its words gives the number of the others and the commonest of them;
sums of those over a word's ranges are its neighbours. No pair comes up twice:
a word with a run of equal letters can lose any of them with one result, and
only the last of the run counts as lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, map_batches, store, text_slices, whole_text

# What a word is made of, once A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
MARK = "$"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word's form occurs at least this many times as often.
TIMES = 2
#: One run in so many loses a character.
SLIP = 97
#: Distinct words that a task counts before it hands its counts on.
_WORDS_AT_ONCE = 1 << 17


def _slipped(word: str, seed: int, slip: int) -> str:
    h = zlib.crc32(word.encode(), seed)
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, slip: int = SLIP) -> DataFrame:
    """``word`` and ``n`` over all of ``docs`` (doc_id, text): words as slips
    leave them, of any length but zero. A null text has none; a null doc_id
    counts as an empty one in the slip's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            done = pa.record_batch([pa.array(list(counts), pa.string()),
                                    pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return done

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in text_slices(batch):
                for doc, text in zip(ids[at:], texts):
                    text = text.encode().lower().decode()  # A-Z only
                    seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word, n in Counter(RUN.findall(text)).items():
                        counts[_slipped(word, seed, slip)] += n
                if len(counts) >= _WORDS_AT_ONCE:
                    yield out()
        if counts:
            yield out()

    whole = docs.select("doc_id", whole_text().alias("text"))
    return (map_batches(whole, run, "word string, n long").where("word != ''")
            .groupBy("word").agg(F.sum("n").alias("n")))


def rotations(words: DataFrame) -> DataFrame:
    """``prefix``, ``skipped``, ``word``, ``n``: every rotation of every word
    twice, by what precedes its last character (which is skipped) unless that
    is the mark, and whole (nothing is skipped)."""
    turned = F.expr(f"""concat(
        transform(sequence(1, length(word)), i -> struct(
            concat(substr(word, i + 1), '{MARK}', substr(word, 1, i - 1)) AS prefix,
            substr(word, i, 1) AS skipped)),
        transform(sequence(0, length(word)), i -> struct(
            concat(substr(word, i + 1), '{MARK}', substr(word, 1, i)) AS prefix,
            CAST(NULL AS STRING) AS skipped)))""")
    return words.select(F.inline(turned), "word", "n")


def _others(member: Column, group: Column) -> Column:
    """Of a range, the words one edit from ``member``: others by a replacement
    of the skipped character; with and without it by its loss, which counts
    where the character is not the one that follows it."""
    follows = F.substring("prefix", 1, 1)

    def other(x: Column) -> Column:
        lost = F.coalesce(x["skipped"], member["skipped"]) != follows
        return F.when(x["skipped"].isNull() & member["skipped"].isNull(), F.lit(False)).when(
            x["skipped"].isNull() | member["skipped"].isNull(), lost).otherwise(
            x["skipped"] != member["skipped"])

    return F.filter(group, other)


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` (words one edit away) and ``best`` (less, word: the
    commonest of them, least in code-point order on a tie, with minus its n) of
    each word of ``words`` (distinct ``word``, ``n``) that has any."""
    sorted_ = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "skipped")
    ranges = (sorted_.groupBy("prefix").agg(F.collect_list(F.struct(  # bounded by the alphabet
        (-F.col("n")).alias("less"), "word", "skipped")).alias("group"))
        .where(F.size("group") > 1))
    found = ranges.select(F.explode(F.transform("group", lambda m: F.struct(
        m["word"].alias("word"), F.transform(_others(m, F.col("group")), lambda x: F.struct(
            x["less"].alias("less"), x["word"].alias("word"))).alias("near")))).alias("m"))
    return (found.where(F.size("m.near") > 0)
            .groupBy(F.col("m.word").alias("word"))
            .agg(F.sum(F.size("m.near")).alias("n_near"),
                 F.min(F.array_min("m.near")).alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words with a form. A form occurs at least
    twice as often as its word, so there are no rings, and each round doubles
    the steps taken: rounds grow with the logarithm of a logarithm."""
    now = store(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "roots")
    while not now.where("open").isEmpty():
        ahead = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        after = store(now.join(ahead, now["root"] == ahead["via"], "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("open")), "roots")
        drop(now)
        now = after
    return now.select("word", "root")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT, times: int = TIMES,
                      slip: int = SLIP) -> DataFrame:
    """Vocabulary of ``docs`` (columns doc_id and text; others ignored), each
    word with the form that it is a variant of.

    Returns word, form (of the words one edit away the commonest, the least in
    code-point order on a tie, if it occurs ``times`` as often; else null), root
    (where forms lead to; the word itself without a form), n, n_near and form_n.
    Words are runs of letters of at least ``least_length`` code points that
    occur ``least_count`` times in all, after one run in ``slip`` has lost a
    character by its hash with the doc_id. Null and empty texts, and an empty
    table, have none; a null doc_id hashes as an empty one; rows that repeat
    count as often as they occur; texts of any length are read whole.
    """
    counted = count_words(docs, slip).where(
        (F.col("n") >= least_count) & (F.length("word") >= least_length))
    words = store(counted, "words")
    near = words.join(neighbours(words), "word", "left")
    common = -F.col("best.less") >= times * F.col("n")
    formed = store(near.select(
        "word", F.when(common, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
