"""Synonym mining from texts that two languages give the same thing (JN-6, AGG-8, AGG-9, STR-8 to STR-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsers import phrase_pair

LEAST_VOTES, BEST_WORDS, BEST_PHRASES = 2, 6, 4


def differing(lexicon: DataFrame) -> DataFrame:
    """(a, b): word lists of the texts that two languages give one id, where they differ. lexicon: description_id, language, text."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))
    us = lexicon.where("language = 'us'").select("description_id", F.col("text").alias("us"))
    gb = lexicon.where("language = 'gb'").select("description_id", F.col("text").alias("gb"))
    return us.join(gb, "description_id").where("us <> gb").select("description_id", words(F.col("us")).alias("a"), words(F.col("gb")).alias("b"))


def voted(pairs: DataFrame, best: int) -> DataFrame:
    """(term, alt, n) in both directions, with enough votes, the best few of each term; ties by name."""
    both = pairs.select(F.col("x").alias("term"), F.col("y").alias("alt")).unionByName(pairs.select(F.col("y").alias("term"), F.col("x").alias("alt")))
    counts = both.groupBy("term", "alt").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_VOTES)
    return counts.withColumn("k", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("n"), "alt"))).where(F.col("k") <= best).drop("k")


def mined_words(lexicon: DataFrame) -> DataFrame:
    """Word synonyms: texts of equal length that differ in one word of three letters or more."""
    zipped = F.filter(F.zip_with("a", "b", lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda s: s["x"] != s["y"])
    rows = differing(lexicon).where(F.size("a") == F.size("b")).withColumn("d", zipped).where(F.size("d") == 1)
    rows = rows.select(F.col("d")[0]["x"].alias("x"), F.col("d")[0]["y"].alias("y")).where("length(x) >= 3 and length(y) >= 3")
    return voted(rows, BEST_WORDS)


def mined_phrases(lexicon: DataFrame) -> DataFrame:
    """Phrase synonyms: texts that differ in one replaced span."""
    rows = differing(lexicon).select(phrase_pair("a", "b").alias("p")).where("p.phrase is not null and (instr(p.phrase, ' ') > 0 or instr(p.alt, ' ') > 0)")
    return voted(rows.select(F.col("p.phrase").alias("x"), F.col("p.alt").alias("y")), BEST_PHRASES)
