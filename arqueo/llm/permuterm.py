"""Spelling variants of a corpus' words, found by permuterm rotations.

Method: a word is marked with a terminator and rotated to every place.  Where the
rotation begins behind the edited character, that character comes last, so two
words that differ in one replaced character have rotations that are equal but for
their last character, and a word that lacks the character has a rotation that is
exactly this common prefix.  All rotations are sorted by their prefix, and each
group of one prefix is scanned for neighbours.

The terminator's place in a prefix fixes the edited place and the length, so the
members of a group differ in one character only: a group has at most one member
per letter and one without it, whatever the corpus holds.  Two words that differ by
a replacement meet in exactly one group.  A word and the same word without one
character meet once for each character of the run the character lies in; they are
counted where it is the first of its run.

Words are counted before any shuffle of words; the forms are followed by pointer
doubling, whose rounds are the logarithm of the longest chain (each form is at
least twice as frequent as the word before it).

Defined cases: a null text has no words; every row counts, repeated ones too; a
null id is written as an empty string where the id is used; other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Everything but a letter of the words (A-Z, a-z, U+00C0 to U+00FF).
GAP = "[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The terminator is no letter.
END = "$"


def ascii_lower(word: Column) -> Column:
    """Only A-Z lower-cased; words of ASCII alone take the quick way."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def without_place(word: Column, place: Column) -> Column:
    """``word`` without the code point at ``place`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word)))


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word): every run of letters of every text, lower-cased."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.split(F.col(text_col).cast("string"), GAP)).alias("word"))
    return runs.where("word != ''").select("id", ascii_lower(F.col("word")).alias("word"))


def damaged(words: DataFrame, every: int) -> DataFrame:
    """(id, word) with one code point deleted from the runs whose crc32 with their document's id ``every`` divides."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    place = F.pmod(F.col("h"), F.char_length("word").cast("long")).cast("int")
    return words.withColumn("h", h).select(
        "id", F.when(F.pmod("h", F.lit(every)) == 0, without_place(F.col("word"), place)).otherwise(F.col("word")).alias("word"))


def word_counts(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n): the words of at least this length and frequency.  Written."""
    n = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return written(n.where(F.col("n") >= least_count), "words")


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, skipped, n): of each word the rotations that end in a character, without it (``skipped``), and the whole
    rotations (``skipped`` null)."""
    size = F.char_length("word")
    behind = F.expr("substring(word, place + 1)")
    before = F.expr("substring(word, 1, place)")
    whole = words.select("n", "word", F.explode(F.sequence(F.lit(0), size)).alias("place")).select(
        F.concat(behind, F.lit(END), before).alias("prefix"), F.lit(None).cast("string").alias("skipped"), "n")
    skipping = words.select("n", "word", F.explode(F.sequence(F.lit(0), size - 1)).alias("place")).select(
        F.concat(F.expr("substring(word, place + 2)"), F.lit(END), before).alias("prefix"),
        F.expr("substring(word, place + 1, 1)").alias("skipped"), "n")
    return whole.union(skipping)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): of each word with a near word their number and the most frequent of them (ties: the
    smallest word).  Words differ by exactly one inserted, deleted or replaced code point."""
    rows = rotations(words).repartition("prefix")
    head, tail = F.substring_index("prefix", END, 1), F.substring_index("prefix", END, -1)
    rows = rows.select(
        "prefix", "skipped", "n", F.concat(tail, F.coalesce("skipped", F.lit("")), head).alias("word"),
        # the character before the skipped one ends the prefix; behind the terminator there is none
        (F.col("skipped").isNotNull() & (F.right("prefix", F.lit(1)) != F.col("skipped"))).alias("leads"))
    group = Window.partitionBy("prefix")
    rows = rows.select("*", F.count("*").over(group).alias("size"), F.count("skipped").over(group).alias("n_skipped"),
                       F.count_if("leads").over(group).alias("n_leads")).where("size > 1")
    order = group.orderBy(F.desc("n"), "word")
    me = F.struct((-F.col("n")).alias("minus_n"), "word")
    best = F.when(F.row_number().over(order) == 1, F.lead(me).over(order)).otherwise(F.first(me).over(order))
    # a word without the character meets those that have it; those meet each other, and the one without it
    count = F.when(F.col("skipped").isNull(), F.col("n_leads")).otherwise(
        F.col("n_skipped") - 1 + F.when(F.col("leads"), F.col("size") - F.col("n_skipped")).otherwise(0))
    return (rows.select("word", count.alias("c"), best.alias("best")).groupBy("word")
            .agg(F.sum("c").alias("n_near"), F.min("best").alias("best"))
            .select("word", "n_near", (-F.col("best.minus_n")).alias("near_n"), F.col("best.word").alias("near")))


def followed(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form of each chain, by pointer doubling."""
    hop = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = hop.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        step = written(hop.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("at").isNotNull().alias("moved")), "forms")
        hop = step.drop("moved")
        if step.where("moved").isEmpty():
            return hop


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a (word, n) table of distinct words.

    The form is the most frequent near word, if it is at least ``ratio`` times as frequent; the root is the end of the
    chain of forms.  A ``ratio`` of 1 or less could close a chain to a ring and is refused.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    fits = F.col("near_n") >= ratio * F.col("n")
    own = written(words.join(neighbours(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")), "variants")
    roots = followed(own.where("form IS NOT NULL").select("word", "form"))
    return own.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3,
                ratio: int = 2, damage_every: int | None = None) -> DataFrame:
    """Spelling variants among the words of ``docs``; with ``damage_every`` after planted deletions."""
    words = occurrences(docs, id_col, text_col)
    if damage_every:
        words = damaged(words, damage_every)
    return spelling_variants(word_counts(words, least_length, least_count), ratio)
