"""Dictionaries that are tables: banks, organisation words and standard names by the hundred thousand.

A phrase is indexed by its rarest gram, the three characters in a row (or fewer, if it is shorter) that the fewest names have.
Names are cut into grams once, and a phrase meets only the names that hold its rarest one; whether it is really part of
the name is tested then. So the work follows the names that could hold a phrase, not names times phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedweb.functions.tokens import joined, tokens
from deedweb.scratch import written

GRAM = 3


def _grams(c: Column | str, n: Column | int) -> Column:
    """The distinct runs of ``n`` characters of a string; none for a shorter one."""
    c = F.col(c) if isinstance(c, str) else c
    n = n if isinstance(n, Column) else F.lit(n)
    last = F.length(c) - n + 1
    cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(c, i, n))
    return F.when(last >= 1, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def longest_phrases(names: DataFrame, phrases: DataFrame, name_col: str, phrase_col: str = "phrase") -> DataFrame:
    """``name, phrase``: for each distinct name that holds a phrase, the longest one; of equally long ones, the first in order. Null and
    empty phrases are in no name; a phrase may begin and end inside words."""
    known = phrases.select(F.col(phrase_col).alias("phrase")).where("phrase <> ''").distinct()
    known = known.withColumn("n", F.least(F.length("phrase"), F.lit(GRAM)))
    sizes = [r[0] for r in known.select("n").distinct().collect()]  # three at most
    name = F.col(name_col).alias("name")
    cut = F.array_distinct(F.flatten(F.array(*(_grams(name_col, n) for n in sizes)))) if sizes else F.array().cast("array<string>")
    grams = written(names.where(F.col(name_col).isNotNull()).select(name, cut.alias("grams")).distinct(), "name-grams")
    grams = grams.select("name", F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    own = known.select("phrase", F.explode(_grams("phrase", F.col("n"))).alias("gram")).join(often, "gram", "left")
    # A gram that no name has is the rarest: its phrase meets nothing.
    keys = own.groupBy("phrase").agg(F.min_by("gram", F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram")).alias("gram"))
    met = grams.join(keys, "gram").where(F.contains("name", F.col("phrase")))
    return met.groupBy("name").agg(F.min_by("phrase", F.struct((-F.length("phrase")).alias("size"), "phrase")).alias("phrase"))


def _back(df: DataFrame, found: DataFrame, name_col: str, *new: str) -> DataFrame:
    of = found.select(F.struct(F.col("name").alias(name_col)).alias("_of"), *new)
    return df.join(of, F.struct(name_col) == F.col("_of"), "left").drop("_of")


def flag_phrases(df: DataFrame, name_col: str, phrases: DataFrame, flag: str = "is_bank", phrase_col: str = "phrase") -> DataFrame:
    """``df`` with ``flag``: whether any phrase of the table is part of the name; false for null."""
    found = longest_phrases(df, phrases, name_col, phrase_col).withColumn("_hit", F.lit(True))
    return _back(df, found, name_col, "_hit").withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")


def fix_names_by_table(df: DataFrame, name_col: str, standard: DataFrame, phrase_col: str = "phrase", standard_col: str = "standard") -> DataFrame:
    """``df`` in which the longest phrase of each name is replaced, everywhere in it, by its standard form (of several, the first in
    order), and spaces are collapsed where one was; ``fix_names`` for tables."""
    forms = standard.groupBy(F.col(phrase_col).alias("phrase")).agg(F.min(standard_col).alias("_standard"))
    found = longest_phrases(df, standard, name_col, phrase_col).join(forms, "phrase").select("name", F.col("phrase").alias("_phrase"), "_standard")
    fixed = joined(tokens(F.replace(F.col(name_col), F.col("_phrase"), F.concat("_standard", F.lit(" ")))))
    out = _back(df, found, name_col, "_phrase", "_standard")
    return out.withColumn(name_col, F.when(F.col("_phrase").isNotNull(), fixed).otherwise(F.col(name_col))).drop("_phrase", "_standard")


def flag_words(df: DataFrame, name_col: str, words: DataFrame, flag: str = "is_org", word_col: str = "word") -> DataFrame:
    """``df`` with ``flag``: whether any word of the name is in the table; false for null."""
    names = df.where(F.col(name_col).isNotNull()).select(F.col(name_col).alias("name")).distinct()
    each = names.select("name", F.explode(F.array_distinct(tokens("name"))).alias("word"))
    found = each.join(words.select(F.col(word_col).alias("word")).distinct(), "word").select("name").distinct().withColumn("_hit", F.lit(True))
    return _back(df, found, name_col, "_hit").withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")
