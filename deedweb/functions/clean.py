"""Cleaners: each takes a string column and returns one. Null stays null unless said."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedweb.functions import constants as K
from deedweb.functions.tokens import col, joined, let, literal_map, looked_up, token_at, tokens, words_array

Text = Column | str


def clean(df: DataFrame, cleaner: Callable[[Column], Column], cols: list[str] | None = None) -> DataFrame:
    """``cleaner`` over some columns, or all. It may be any function of a column, a pandas UDF among them."""
    return df.withColumns({c: cleaner(F.col(c)) for c in (df.columns if cols is None else cols)})


def make_upper(c: Text) -> Column:
    return F.upper(col(c))


def remove_symbols_punctuation(c: Text) -> Column:
    """``&`` becomes AND; other ASCII punctuation becomes a space each, but for the slash and the dash."""
    return F.translate(F.replace(col(c), F.lit("&"), F.lit(" AND ")), K.PUNCTUATION, " " * len(K.PUNCTUATION))


def trim_whitespace(c: Text) -> Column:
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def strip_dashes(c: Text) -> Column:
    return F.regexp_replace(col(c), "^-+|-+$", "")


def empty_to_null(c: Text) -> Column:
    return F.nullif(col(c), F.lit(""))


def remove_extra_spaces(c: Text) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(col(c), r"(?U)\s+", " ")


def fix_llcs(c: Text) -> Column:
    return F.replace(col(c), F.lit("L L C"), F.lit("LLC"))


#: Values of spelled numbers below a hundred.
SMALL = {w: i for i, w in enumerate(K.UNITS)} | {w: 10 * (i + 2) for i, w in enumerate(K.TENS)}
SCALES = {"THOUSAND": 1_000, "MILLION": 1_000_000, "BILLION": 1_000_000_000}


def _spelled_value(words: Column) -> Column:
    """The value of an array of number words; null if one of them is none."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("now"), F.lit(True).alias("ok"))

    def step(s: Column, w: Column) -> Column:
        small, scale = looked_up(SMALL, w), looked_up(SCALES, w)
        now = (
            F.when(w == "HUNDRED", F.greatest(s["now"], F.lit(1)) * 100)
            .when(scale.isNotNull(), F.lit(0))
            .otherwise(s["now"] + F.coalesce(small, F.lit(0)))
        )
        total = s["total"] + F.when(scale.isNotNull(), F.greatest(s["now"], F.lit(1)) * scale).otherwise(F.lit(0))
        known = small.isNotNull() | scale.isNotNull() | w.isin("HUNDRED", "AND")
        return F.struct(total.cast("long").alias("total"), now.cast("long").alias("now"), (s["ok"] & known).alias("ok"))

    value = F.aggregate(words, start, step, lambda s: F.when(s["ok"], s["total"] + s["now"]))
    return F.when(F.exists(words, lambda w: w != "AND"), value)


def words_to_num(c: Text) -> Column:
    """A wholly spelled number in digits (``TWENTY FIVE`` gives ``25``); anything else unchanged."""
    words = tokens(F.translate(F.upper(col(c)), "-", " "))
    return F.coalesce(_spelled_value(words).cast("string"), col(c))


def deduplicate(c: Text) -> Column:
    """Each word once, where it stood first."""
    return joined(F.array_distinct(tokens(c)))


def _ordinal(n: int) -> str:
    ending = "TH" if n % 100 in (11, 12, 13) else {1: "ST", 2: "ND", 3: "RD"}.get(n % 10, "TH")
    return f"{n}{ending}"


ORDINAL_ENDS = {w: i for i, w in enumerate(K.ORDINAL_UNITS)} | {w: 10 * (i + 2) for i, w in enumerate(K.ORDINAL_TENS)}


def convert_ordinals(c: Text) -> Column:
    """Spelled ordinals in digits, with the tens or hundreds before them: ``EAST TWENTY FIFTH STREET`` gives
    ``EAST 25TH STREET``, ``ONE HUNDREDTH`` gives ``100TH``. Other words stay."""
    held = lambda s: F.when(s["tens"] > 0, F.array(s["word"])).otherwise(F.array().cast("array<string>"))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("tens"), F.lit("").alias("word"))
    tens = {w: 10 * (i + 2) for i, w in enumerate(K.TENS)}
    units = {w: i for i, w in enumerate(K.UNITS) if 0 < i < 20}
    names = {n: _ordinal(n) for n in range(100)}

    def step(s: Column, w: Column) -> Column:
        end, ten, unit = looked_up(ORDINAL_ENDS, w), looked_up(tens, w), looked_up(units, w)
        joins = end.isNotNull() & (s["tens"] >= 20) & (end < 10)
        number = F.when(joins, s["tens"] + end).otherwise(end)
        before = F.when(joins, F.array().cast("array<string>")).otherwise(held(s))
        hundredth = (w == "HUNDREDTH") & (s["tens"] < 20)
        put = (
            F.when(hundredth, F.concat(s["out"], F.array(F.concat(F.greatest(s["tens"], F.lit(1)).cast("string"), F.lit("00TH")))))
            .when(end.isNotNull(), F.concat(s["out"], before, F.array(F.try_element_at(literal_map(names), number))))
            .when(ten.isNotNull() | unit.isNotNull(), F.concat(s["out"], held(s)))
            .otherwise(F.concat(s["out"], held(s), F.array(w)))
        )
        keeps = ten.isNotNull() | unit.isNotNull()
        return F.struct(
            put.alias("out"), F.when(keeps, F.coalesce(ten, unit)).otherwise(0).alias("tens"), F.when(keeps, w).otherwise("").alias("word")
        )

    return F.aggregate(tokens(c), start, step, lambda s: joined(F.concat(s["out"], held(s))))


def take_first(c: Text) -> Column:
    """The first number of the first range comes in front, and all ranges go: ``12-16 OAK`` gives ``12 OAK``."""
    first = F.regexp_extract(col(c), r"(\d+)-\d+", 1)
    return F.when(col(c).rlike(r"\d+-\d+"), F.concat(first, F.regexp_replace(col(c), r"\d+-\d+", ""))).otherwise(col(c))


def combine_numbers(c: Text) -> Column:
    """Runs of whole numbers are joined. In a run of three or more, a zero at the end of the first number goes."""
    none = F.array().cast("array<string>")

    def run_of(s: Column) -> Column:
        run = s["run"]
        first = token_at(run, 1)
        first = F.when((F.size(run) >= 3) & F.endswith(first, F.lit("0")), F.substring(first, F.lit(1), F.length(first) - 1)).otherwise(first)
        whole = F.concat(first, F.array_join(F.slice(run, 2, F.greatest(F.size(run) - 1, F.lit(0))), ""))
        return F.when(F.size(run) == 0, none).otherwise(F.array(whole))

    def step(s: Column, w: Column) -> Column:
        number = w.rlike(r"^[+-]?\d+$")
        return F.struct(
            F.when(number, s["out"]).otherwise(F.concat(s["out"], run_of(s), F.array(w))).alias("out"),
            F.when(number, F.concat(s["run"], F.array(w))).otherwise(none).alias("run"),
        )

    start = F.struct(none.alias("out"), none.alias("run"))
    return F.aggregate(tokens(c), start, step, lambda s: joined(F.concat(s["out"], run_of(s))))


def switch_the(c: Text) -> Column:
    return F.regexp_replace(col(c), r"(?s)^(.*) THE$", "THE $1")


def fix_names(c: Text, standard: dict[str, str]) -> Column:
    """The longest key that occurs in the name is replaced, everywhere in it, by its standard form; spaces are collapsed.
    For lists of some hundred keys, which become one expression."""
    keys = sorted(standard, key=lambda k: (-len(k), k))
    out = None
    for key in keys:
        fixed = joined(tokens(F.replace(col(c), F.lit(key), F.lit(f"{standard[key]} "))))
        hit = F.contains(col(c), F.lit(key))
        out = F.when(hit, fixed) if out is None else out.when(hit, fixed)
    return col(c) if out is None else out.otherwise(col(c))


def convert_nsew(c: Text) -> Column:
    """Directions are abbreviated. Of two in a row, the second stays, and the first is abbreviated only before a street
    suffix in its short form."""
    shorts = sorted(set(K.STREET_SUFFIXES.values()))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("skip"))

    def walk(bound: Column) -> Column:
        words = bound["words"]

        def step(s: Column, i: Column) -> Column:
            at = lambda k: F.try_element_at(words, i + k)
            short, pair = looked_up(K.DIRECTIONS, at(0)), looked_up(K.DIRECTIONS, at(1)).isNotNull()
            plain = s["skip"] | short.isNull()
            stays = plain | (pair & ~F.coalesce(at(2).isin(shorts), F.lit(False)))
            word = F.when(stays, at(0)).otherwise(short)
            return F.struct(F.concat(s["out"], F.array(word)).alias("out"), (~plain & pair).alias("skip"))

        spots = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(spots, start, step, lambda s: joined(s["out"]))

    return F.when(col(c).isNotNull(), let({"words": tokens(c)}, walk))


def remove_secondary_designators(c: Text) -> Column:
    """The first unit keyword goes, its number stays; also the mark in ``#4B``. Unchanged where the keyword follows a number
    at the very beginning."""
    words = tokens(c)
    is_key = lambda w: w.isin(K.SECONDARY_KEYWORDS) | w.rlike("^#.")
    spots = F.transform(words, lambda w, i: F.when(is_key(w), i))
    first = F.array_min(F.filter(spots, lambda x: x.isNotNull()))
    cut = F.filter(
        F.transform(words, lambda w, i: F.when(i != first, w).when(w.rlike("^#."), F.substring(w, F.lit(2), F.length(w)))),
        lambda w: w.isNotNull(),
    )
    leads = token_at(words, 1).rlike(r"^\d+$") & token_at(words, 2).isin(K.SECONDARY_KEYWORDS)
    return F.when(F.coalesce(leads, F.lit(False)) | first.isNull(), col(c)).otherwise(joined(cut))


def convert_street_suffixes(c: Text) -> Column:
    return joined(F.transform(tokens(c), lambda w: F.coalesce(looked_up(K.STREET_SUFFIXES, w), w)))


def fix_zip(c: Text) -> Column:
    """Five digits, or nine with a dash; longer ones are cut, shorter ones padded; anything else gives an empty string."""
    size = F.length(col(c))
    return (
        F.when(col(c).isNull(), None)
        .when(~col(c).rlike("^[0-9]+$"), "")
        .when(size == 9, F.concat(F.substring(col(c), 1, 5), F.lit("-"), F.substring(col(c), 6, 4)))
        .when(size > 5, F.substring(col(c), 1, 5))
        .otherwise(F.lpad(col(c), 5, "0"))
    )


def check_sec_num(c: Text) -> Column:
    """The digits at the end of the part before the first comma, or null."""
    return F.nullif(F.regexp_extract(F.trim(F.split_part(col(c), F.lit(","), F.lit(1))), r"(\d+)$", 1), F.lit(""))


def fix_mpls(c: Text) -> Column:
    return F.replace(F.replace(col(c), F.lit("MPLS"), F.lit("MINNEAPOLIS")), F.lit("MNPLS"), F.lit("MINNEAPOLIS"))


def fix_directionals(c: Text) -> Column:
    """A value that is a direction, and nothing else, is abbreviated."""
    return F.coalesce(looked_up(K.DIRECTIONAL_MAP, col(c)), col(c))


def drop_letters(c: Text, literal: bool = False) -> Column:
    """A letter that ends a number goes (``12A OAK`` gives ``12 OAK``; ``10TH`` stays). ``literal``: each number with a
    letter becomes the first such number without its letter."""
    if literal:
        first = F.regexp_extract(col(c), r"(\d+)[a-zA-Z]", 1)
        return F.when(col(c).rlike(r"\d[a-zA-Z]"), F.regexp_replace(col(c), F.lit(r"\d+[a-zA-Z]"), first)).otherwise(col(c))
    return F.regexp_replace(col(c), r"(\d+)[A-Za-z]\b", "$1")


def convert_mixed(c: Text) -> Column:
    """Each word that spells a number, in digits; others stay."""
    numbers = {w: str(n) for w, n in (SMALL | SCALES | {"HUNDRED": 100}).items()}
    return joined(F.transform(tokens(c), lambda w: F.coalesce(looked_up(numbers, F.upper(w)), w)))


def remove_secondary_component(c: Text, literal: bool = False) -> Column:
    """Everything from the first unit keyword on goes. A keyword is a whole word, or ``#`` anywhere; ``literal``: any part of
    a word too (``12 FLOWER ST`` gives ``12``)."""
    words = [re.escape(k) for k in K.SECONDARY_KEYWORDS if k != "#"]
    rule = f"(#|{'|'.join(words)})" if literal else rf"(#|\b({'|'.join(words)})\b)"
    return trim_whitespace(F.regexp_replace(col(c), rf"(?s){rule}.*$", ""))


def core_name(c: Text, literal: bool = False) -> Column:
    """The name without the words for a kind of business. ``literal``: also at the end of longer words (``ZINC`` gives ``Z``)."""
    keys = sorted(K.CORE_NAME_KEYS, key=lambda k: -len(k.split())) if not literal else K.CORE_NAME_KEYS
    text = F.concat(col(c), F.lit(" "))
    if literal:
        text = reduce(lambda t, k: F.replace(t, F.lit(f"{k} "), F.lit("")), keys, text)
    else:
        text = F.regexp_replace(text, rf"\b({'|'.join(keys)})(?= )", "")
    return trim_whitespace(text if literal else remove_extra_spaces(text))


def fix_states(c: Text, own: dict[str, str] | None = None) -> Column:
    """A state's name as its abbreviation; ``own`` spellings come first. Others stay."""
    return F.coalesce(*([looked_up(own, col(c))] if own else []), looked_up(K.STATES, col(c)), col(c))


def is_encoded_empty(c: Text) -> Column:
    """Whether there is a control character; false for null."""
    return F.coalesce(col(c).rlike(r"[\x00-\x1F]"), F.lit(False))


def is_int(c: Text) -> Column:
    """Whether it reads as a whole number; false for null."""
    return F.coalesce(col(c).rlike(r"^\s*[+-]?\d+\s*$"), F.lit(False))


def null_tokens(c: Text, values: list[str] | None = None) -> Column:
    """Null for the strings that stand for a missing value."""
    return F.when(F.array_contains(words_array(K.NA_TOKENS if values is None else values), F.trim(col(c))), None).otherwise(col(c))


def coerce_boolean(c: Text) -> Column:
    """True for true, 1, t and yes in any case; else, and for null, false."""
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))).isin("true", "1", "t", "yes"), F.lit(False))


def standard_name(c: Text) -> Column:
    """The usual chain for names."""
    steps = (make_upper, remove_symbols_punctuation, trim_whitespace, remove_extra_spaces, fix_llcs, deduplicate, switch_the)
    return reduce(lambda x, f: f(x), steps, col(c))


def standard_street(c: Text) -> Column:
    """The usual chain for street addresses."""
    steps = (
        make_upper, remove_symbols_punctuation, trim_whitespace, remove_extra_spaces, take_first, combine_numbers,
        convert_nsew, convert_street_suffixes, remove_secondary_designators,
    )
    return reduce(lambda x, f: f(x), steps, col(c))
