"""Predicates over names and addresses. All are false for null unless said."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedweb.functions import constants as K
from deedweb.functions.clean import is_int
from deedweb.functions.tokens import col, joined, token_at, tokens, words_array

Text = Column | str


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _any_word(c: Text, values: list[str]) -> Column:
    return _sure(F.arrays_overlap(tokens(c), words_array(values)))


def is_bank(c: Text, keywords: list[str]) -> Column:
    """Whether any keyword is part of the name."""
    return _sure(F.exists(words_array(keywords), lambda k: F.contains(col(c), k)))


def is_trust(c: Text) -> Column:
    parts = F.exists(words_array(K.TRUSTS_STRINGS), lambda k: F.contains(col(c), k))
    return _any_word(c, K.TRUSTS) | _sure(parts)


def is_person(c: Text, names: list[str]) -> Column:
    """Whether all words are known names; with more than two words, the last may be JR or SR."""
    words = tokens(c)
    ends = (F.size(words) > 2) & token_at(words, -1).isin("JR", "SR")
    own = F.when(_sure(ends), F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1)))).otherwise(words)
    return _sure((F.size(own) > 0) & F.forall(own, lambda w: F.array_contains(words_array(names), w)))


def flag_persons(df: DataFrame, name_col: str, names: DataFrame, id_col: str, flag: str = "is_person") -> DataFrame:
    """``is_person`` for a list of names that is a table (column ``name``): distinct words are looked up once."""
    words = tokens(name_col)
    ends = _sure((F.size(words) > 2) & token_at(words, -1).isin("JR", "SR"))
    own = F.when(ends, F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1)))).otherwise(words)
    rows = df.select(F.col(id_col).alias("_id"), F.explode(own).alias("_word"))
    known = names.select(F.col("name").alias("_word"), F.lit(True).alias("_known")).distinct()
    flags = rows.join(known, "_word", "left").groupBy("_id").agg(F.bool_and(F.coalesce("_known", F.lit(False))).alias(flag))
    return df.join(flags, F.col(id_col) == F.col("_id"), "left").drop("_id").withColumn(flag, F.coalesce(flag, F.lit(False)))


def is_org(c: Text, words: list[str] | None = None) -> Column:
    """Whether any word marks an organisation."""
    return _any_word(c, K.ORG_WORDS if words is None else words)


def is_llc(c: Text) -> Column:
    return _sure(F.array_contains(tokens(c), "LLC") | F.contains(F.right(col(c), F.lit(4)), F.lit("LLC")))


def is_pobox(c: Text) -> Column:
    return _sure(F.replace(col(c), F.lit(" "), F.lit("")).rlike(f"^({'|'.join(K.PO_BOXES)})"))


def has_rental_class(codes: Text, rental: list[str]) -> Column:
    """Whether one of the comma-separated codes is a rental code."""
    own = F.transform(F.split(col(codes), ","), lambda x: F.trim(x))
    return _sure(F.arrays_overlap(own, words_array(rental)))


def is_irregular_zip(c: Text) -> Column:
    """True unless it is 5 or 9 digits, or 5 and 4 with a dash; true for null."""
    return F.coalesce(~col(c).rlike(r"^([0-9]{5}|[0-9]{9}|[0-9]{5}-[0-9]{4})$"), F.lit(True))


def is_irregular_state(c: Text) -> Column:
    """True unless it is a state's name or abbreviation; true for null."""
    return F.coalesce(~F.trim(col(c)).isin([*K.STATES, *K.STATES.values()]), F.lit(True))


def is_incomplete_address(street: Text = "street_1", zip_code: Text = "zip_code") -> Column:
    return col(street).isNull() | col(zip_code).isNull()


def is_not_secondary_number(c: Text) -> Column:
    """Whether the number that ends the street part belongs to a road, as in ``HWY 10`` or ``COUNTY RD 136``."""
    words = tokens(F.split_part(col(c), F.lit(","), F.lit(1)))
    pair = joined(F.array(token_at(words, -3), token_at(words, -2)))
    highway = token_at(words, -2).isin("HWY", "HIGHWAY") & F.coalesce(pair != "DUPONT HWY", F.lit(True))
    road = pair.isin("CO RD", "COUNTY RD", "STATE RD", "ST RD")
    return _sure(is_int(token_at(words, -1)) & (_sure(highway) | _sure(road)))


def is_invalid_street(c: Text) -> Column:
    """Whether the street part is a number and nothing else."""
    return is_int(F.split_part(col(c), F.lit(","), F.lit(1)))


def is_unit_gte_1(c: Text) -> Column:
    """Whether there is more than one unit. The name is that of the delivered column, which means this."""
    return _sure(F.trim(col(c).cast("string")).try_cast("int") > 1)


def is_validated(c: Text) -> Column:
    return col(c).isNotNull()
