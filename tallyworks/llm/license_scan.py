"""Licence scan by diagonal voting, in DataFrame functions.

The hash of every run of `k` words of every text is joined to the positions of the same run in the licence
templates. A match at text position p and template position t votes for the diagonal p - t; votes are summed per
diagonal before the shuffle, so a text that repeats a notice is a few rows. Diagonals a few words apart (words
put in or left out) are merged, and a merged diagonal with enough votes is verified: the words of its span, and those of
the spans of its parts, are compared with the whole template by edit distance, and the nearest counts. So a stray run
beside a notice, as its own name is, does not widen the notice.

The templates are a fixed list, so the joined table of their word runs is bounded whatever the corpus. A text meets its
candidates again by a hash of the whole row, so equal ids do not mix texts.

Cases: null and empty texts have no words, no labels and the score 0; a template with fewer than k words is not
searched; overlapping templates all count; repeated rows are scanned each for itself; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyworks.llm.license_texts import PHRASES, TEMPLATES
from tallyworks.llm.staging import staged

K = 3
MERGE_GAP = 4       # words between diagonals that belong together
MIN_VOTES = 0.3     # share of a template's runs that must vote
MIN_SIMILARITY = 0.8
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are; texts of ASCII alone take the quick way."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text.cast("string"), F.lit(""))), _SEPARATORS), "")


def _runs(words: Column, k: int) -> Column:
    """Hashes of all runs of k words, by their first word."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])))


def _parts(diagonals: Column, size: Column) -> Column:
    """(low, high) of a band and of all its runs of diagonals at most a template apart."""
    runs = F.transform(diagonals, lambda low, i: F.transform(
        F.filter(F.slice(diagonals, i + 1, size + 1), lambda high: high - low <= size),
        lambda high: F.struct(low.alias("low"), high.alias("high"))))
    whole = F.struct(F.array_min(diagonals).alias("low"), F.array_max(diagonals).alias("high"))
    return F.array_distinct(F.concat(F.array(whole), F.flatten(runs)))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, label, t_words, t_text) of the templates, cut like the texts."""
    rows = [(name, label, w, " ".join(w)) for name, label, text in templates
            for w in [[x for x in re.split(_SEPARATORS, text.translate(str.maketrans(_UPPER, _LOWER))) if x]]]
    return spark.createDataFrame(rows, "template string, label string, t_words array<string>, t_text string")


def find_spans(docs: DataFrame, templates: DataFrame, k: int = K, min_votes: float = MIN_VOTES,
               min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """(row, template, label, first_word, end_word, votes, similarity): verified spans of the texts.

    `docs` has row (a key of the text) and text; equal rows are scanned once.
    """
    runs = templates.select("template", F.size("t_words").alias("t_size"), F.posexplode(_runs(F.col("t_words"), k))
                            .alias("t_pos", "run"))
    cut = docs.select("row", words_of(F.col("text")).alias("_words"))
    votes = (cut.select("row", F.posexplode(_runs(F.col("_words"), k)).alias("pos", "run"))
             .join(F.broadcast(runs), "run")
             .groupBy("row", "template", "t_size", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
             .agg(F.count_distinct("t_pos").alias("votes")))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > MERGE_GAP, F.lit(False)).cast("int")
    bands = (votes.withColumn("apart", apart).withColumn("band", F.sum("apart").over(order))
             .groupBy("row", "template", "t_size", "band")
             .agg(F.sum("votes").alias("votes"), F.sort_array(F.collect_list("diagonal")).alias("diagonals"))
             .where(F.col("votes") >= F.greatest(F.lit(1), min_votes * (F.col("t_size") - (k - 1))))
             .groupBy("row").agg(F.collect_list(F.struct("template", "votes", "band", _parts(F.col("diagonals"), F.col("t_size"))
                                                          .alias("parts"))).alias("bands")))
    candidates = staged(bands, "licence-bands")

    begin = F.greatest(F.lit(0), F.col("part.low"))
    end = F.least(F.size("_words"), F.col("part.high") + F.size("t_words"))
    span = F.array_join(F.slice("_words", begin + 1, F.greatest(end - begin, F.lit(0))), " ")
    once = docs.join(candidates, "row").dropDuplicates(["row"])
    spans = (once.select("row", words_of(F.col("text")).alias("_words"), F.explode("bands").alias("band"))
             .join(F.broadcast(templates), F.col("band.template") == F.col("template"))
             .select("row", "template", "label", "band", "_words", "t_words", "t_text", F.explode("band.parts").alias("part"))
             .select("row", "template", "label", F.col("band.band").alias("band"), begin.alias("first_word"),
                     end.alias("end_word"), F.col("band.votes").alias("votes"), "t_text", span.alias("span")))
    shorter, longer = (f(F.length("span"), F.length("t_text")) for f in (F.least, F.greatest))
    # The difference in length is a bound of the distance.
    similarity = F.when(shorter >= min_similarity * longer, 1 - F.levenshtein("span", "t_text") / longer)
    verified = (spans.select("row", "template", "label", "band", "first_word", "end_word", "votes",
                             similarity.alias("similarity"))
                .where(F.col("similarity") >= min_similarity)
                .groupBy("row", "template", "label", "band")
                .agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("back"), "end_word", "votes")).alias("best"))
                .select("row", "template", "label", (-F.col("best.back")).alias("first_word"), "best.end_word",
                        "best.votes", "best.similarity"))
    # Notices that differ in a word match one place; the nearest counts.
    nearest = F.max("similarity").over(Window.partitionBy("row", "first_word"))
    return verified.withColumn("nearest", nearest).where(F.col("similarity") == F.col("nearest")).drop("nearest")


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")
    spaced = F.concat(F.lit(" "), F.col("_line"), F.lit(" "))

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + j) == part)
        return found

    return F.when(F.contains(spaced, F.lit(f" {phrase} ")),
                  F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)).otherwise(
        F.array().cast("array<int>"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    The score is that of the best verified span, 1 where a base phrase stands, 0 without either.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                        F.xxhash64(F.col("doc_id"), F.col("text").cast("string")).alias("row"))
    spans = find_spans(texts.select("row", "text"), template_table(docs.sparkSession))
    found = staged(spans.groupBy("row").agg(F.collect_set("label").alias("found"),
                                            F.max("similarity").alias("similarity")), "licence-labels")
    words = F.col("_words")
    cut = texts.select("doc_id", "row", words_of(F.col("text")).alias("_words"))
    base = cut.select("doc_id", "row", "_words", F.array_join(words, " ").alias("_line")).select(
        "doc_id", "row", F.size(words).cast("long").alias("n_words"),
        *[_places(words, phrase).alias(f"_p{k}") for k, (phrase, _) in enumerate(PHRASES)])
    places = F.concat(*[F.col(f"_p{k}") for k in range(len(PHRASES))])
    named = F.array_compact(F.array(*[F.when(F.size(f"_p{k}") > 0, F.lit(label))
                                      for k, (_, label) in enumerate(PHRASES)]))
    joined = base.join(found, "row", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.sort_array(named), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(named, F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce("similarity", F.lit(0.0))).alias("score"))
