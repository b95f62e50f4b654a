"""Composition and repair of addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from deedweb.functions import constants as K
from deedweb.functions.classify import is_irregular_state, is_irregular_zip, is_pobox
from deedweb.functions.tokens import col, joined, token_at, tokens

Text = Column | str


def part(c: Text) -> Column:
    """A trimmed part of an address; blank counts as missing."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def full_address(parts: list[str], llc: bool = False, street: Text = "raw_street") -> Column:
    """Parts that are not empty, joined by commas. Unless ``llc``, the last is joined by a space, and the address is empty
    where there is no street."""
    found = F.filter(F.array(*map(F.col, parts)), lambda x: x.isNotNull() & (x != ""))
    if llc:
        return F.array_join(found, ", ")
    n = F.size(found)
    lead = F.array_join(F.slice(found, 1, F.greatest(n - 1, F.lit(0))), ", ")
    last = token_at(found, -1)
    return F.when(col(street).isNull() | (n == 0), "").when(n > 1, F.concat(lead, F.lit(" "), last)).otherwise(last)


def short_address() -> Column:
    """Number, its suffix, direction, street, suffix, direction and unit; the unit's kind only with its number."""
    unit = F.when(part("secondary_number").isNotNull(), F.concat_ws(" ", part("secondary_unit"), part("secondary_number")))
    names = ("number", "number_suffix", "predirectional", "street", "suffix", "postdirectional")
    return F.concat_ws(" ", *map(part, names), unit)


def format_address(directionals: bool = True, unit_prefix: bool = True, unit_number: bool = True) -> Column:
    """``number predirectional prefix street suffix postdirectional[, unit number], city, state zip``."""
    names = [
        "number", *(["predirectional"] if directionals else []), "prefix", "street", "suffix",
        *(["postdirectional"] if directionals else []),
    ]
    box = F.upper(part("street")) == "PO BOX"
    line = F.when(box, F.concat_ws(" ", F.lit("PO BOX"), part("number"))).otherwise(F.concat_ws(" ", *map(part, names)))
    unit = F.concat_ws(" ", *([part("secondary_unit")] if unit_prefix else []), part("secondary_number"))
    unit = F.when(part("secondary_number").isNotNull(), unit) if unit_number else F.lit(None).cast("string")
    place = F.nullif(F.concat_ws(" ", part("state"), part("zip_code")), F.lit(""))
    return F.concat_ws(", ", line, unit, part("city"), place)


#: Which parts each variant has: directionals, the unit's kind, the unit's number.
VARIANTS = {"v0": (True, True, True), "v1": (True, False, True), "v2": (True, False, False), "v3": (False, False, True), "v4": (False, False, False)}


def formatted_addresses(or_given: bool = False) -> dict[str, Column]:
    """The five variants, by column name. ``or_given``: ``formatted_address`` where there is no city."""
    made = {f"formatted_address_{v}": format_address(*flags) for v, flags in VARIANTS.items()}
    if not or_given:
        return made
    return {k: F.when(part("city").isNull(), F.col("formatted_address")).otherwise(v) for k, v in made.items()}


def fix_formatted_address_unit() -> Column:
    """The first part with the unit added, without a last word that repeats the one before it, then city, state and zip."""
    street = F.trim(F.split_part("formatted_address", F.lit(","), F.lit(1)))
    unit, number = F.trim("secondary_unit"), F.trim("secondary_number")
    line = (
        F.when(F.col("secondary_unit").isNotNull(), F.concat(street, F.lit(", "), F.concat_ws(" ", unit, number)))
        .when(F.col("secondary_number").isNotNull(), F.concat(street, F.lit(" "), number))
        .otherwise(street)
    )
    words = tokens(line)
    again = F.coalesce(token_at(words, -1) == token_at(words, -2), F.lit(False))
    line = F.when(again, joined(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))))).otherwise(line)
    return F.concat(line, F.lit(", "), F.col("city"), F.lit(", "), F.col("state"), F.lit(" "), F.col("zip_code"))


def fix_pobox(c: Text) -> Column:
    """Any spelling of a PO box becomes ``PO BOX n [TAX DEPT d]``, followed by the rest; other addresses stay."""
    text = col(c)
    first = F.split_part(text, F.lit(","), F.lit(1))
    bare = F.replace(first, F.lit(" "), F.lit(""))
    mark = F.when(bare.rlike("[a-zA-Z]#"), F.lit("")).otherwise(F.lit("DEPT"))
    bare = F.when(F.contains(first, F.lit("#")), F.replace(F.replace(text, F.lit("#"), mark), F.lit(" "), F.lit(""))).otherwise(
        F.replace(text, F.lit(" "), F.lit(""))
    )
    after = F.split_part(F.regexp_replace(bare, f"^({'|'.join(K.PO_BOXES)})", ""), F.lit(","), F.lit(1))
    number = reduce(lambda x, k: F.replace(x, F.lit(k), F.lit("")), K.PO_BOXES_REMOVE, after)
    # The first marker in the order of the list decides, wherever it stands.
    found = reduce(lambda x, k: x.when(F.contains(number, F.lit(k)), k), K.PO_BOXES_DEPT[1:], F.when(F.contains(number, F.lit(K.PO_BOXES_DEPT[0])), K.PO_BOXES_DEPT[0]))
    spot = F.locate(K.PO_BOXES_DEPT[0], number)
    for key in K.PO_BOXES_DEPT:
        spot = F.when(found == key, F.locate(key, number)).otherwise(spot)
    tail = F.regexp_replace(F.substring(number, spot + F.length(found), F.length(number)), "[^0-9]", "")
    dept = F.when(found.isNotNull(), F.concat(F.lit(" TAX DEPT "), tail)).otherwise("")
    box = F.when(found.isNotNull(), F.substring(number, F.lit(1), spot - 1)).otherwise(number)
    line = F.rtrim(F.concat(F.lit("PO BOX "), box, dept))
    rest = F.substring(text, F.length(first) + 1, F.length(text))
    return F.when(is_pobox(text), F.concat(line, rest)).otherwise(text)


def city_state_zip(c: Text = "clean_city_state_zip") -> dict[str, Column]:
    """``clean_city``, ``clean_state``, ``clean_zip_code`` from one field, or nulls where the last two words are not
    a state and a zip code."""
    words = tokens(c)
    state, code = token_at(words, -2), token_at(words, -1)
    good = ~is_irregular_zip(code) & ~is_irregular_state(state)
    city = joined(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))))
    return {"clean_city": F.when(good, city), "clean_state": F.when(good, state), "clean_zip_code": F.when(good, code)}


def concatenated_address() -> Column:
    """``street, city, state zip`` where all three are known, else ``street, city_state_zip``."""
    known = F.col("clean_city").isNotNull() & F.col("clean_state").isNotNull() & F.col("clean_zip_code").isNotNull()
    whole = F.concat("clean_street", F.lit(", "), "clean_city", F.lit(", "), "clean_state", F.lit(" "), "clean_zip_code")
    return F.when(known, whole).otherwise(F.concat("clean_street", F.lit(", "), "clean_city_state_zip"))


def filing_address(prefix: str = "", incomplete: Text = "is_incomplete_address") -> Column:
    """``street_1[ street_2], [city, ][state ]zip``, null where the address is incomplete."""
    at = lambda n: F.col(f"{prefix}{n}")
    text = F.concat(
        at("street_1"), F.coalesce(F.concat(F.lit(" "), at("street_2")), F.lit("")), F.lit(", "),
        F.coalesce(F.concat(at("city"), F.lit(", ")), F.lit("")), F.coalesce(F.concat(at("state"), F.lit(" ")), F.lit("")), at("zip_code"),
    )
    return F.when(~col(incomplete), text)


def filing_street(first: Text = "clean_street_1", second: Text = "clean_street_2") -> Column:
    return F.when(col(first).isNotNull() & col(second).isNotNull(), F.concat(col(first), F.lit(" "), col(second))).otherwise(col(first))


def matching_address(validated: Text = "raw_address_v", raw: Text = "raw_address") -> Column:
    """The validated address, or the raw one where that is blank."""
    return F.when(col(validated).isNull() | (F.trim(col(validated)) == ""), col(raw)).otherwise(col(validated))


def first_address(variant: Text, fallback: Text) -> Column:
    """A variant of an address where there is one, else the plain one."""
    return F.coalesce(col(variant), col(fallback))
