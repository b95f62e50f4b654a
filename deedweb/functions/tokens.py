"""Helpers over the words of a string column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` of a struct of ``values``, each of which is computed once, however often the body uses it. Inside lambda
    functions Spark would compute an expression again for every element."""
    return F.transform(F.array(F.struct(*(v.alias(n) for n, v in values.items()))), body)[0]


def tokens(c: Column | str) -> Column:
    """The words between runs of white space (of any script); an empty array for a blank string, null for null."""
    return F.filter(F.split(col(c), r"(?U)\s+"), lambda x: x != "")


def joined(words: Column) -> Column:
    return F.array_join(words, " ")


def literal_map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def looked_up(values: dict, c: Column) -> Column:
    """``values[c]``, or null."""
    return F.try_element_at(literal_map(values), c)


def words_array(values: list[str]) -> Column:
    return F.array(*(F.lit(x) for x in values)) if values else F.array().cast("array<string>")


def token_at(words: Column, place: int) -> Column:
    """The word at a place, from 1, or from the end with -1; null where there is none."""
    return F.try_element_at(words, F.lit(place))


def title_case(c: Column | str) -> Column:
    """A letter is upper case after anything that is no letter, and lower case after a letter: ``3rd ave`` gives ``3Rd Ave``."""

    def raised(s: Column) -> Column:
        letters = s["letters"]
        before = lambda i: F.try_element_at(letters, i)  # noqa: E731  (i counts from 0, places from 1)
        letter = lambda x: (x >= "a") & (x <= "z")  # noqa: E731  (one character, lower case)
        return F.transform(
            letters, lambda x, i: F.when((i > 0) & F.coalesce(letter(before(F.when(i > 0, i))), F.lit(False)), x).otherwise(F.upper(x))
        )

    low = F.lower(col(c))
    return F.when(F.length(low) == 0, low).otherwise(F.array_join(let({"letters": F.split(low, "")}, raised), ""))


def match_text(c: Column | str) -> Column:
    """The form in which documents are compared: ASCII, title case, single spaces, a space at both ends."""
    plain = F.lower(F.regexp_replace(col(c), r"[^\x00-\x7F]", ""))
    plain = F.regexp_replace(plain, r"[)(.|\[\]{}']", "")
    plain = F.translate(F.replace(plain, F.lit("&"), F.lit("and")), ",-", "  ")
    spaced = F.trim(F.regexp_replace(plain, " +", " "))
    # ``title_case`` of ASCII text without a loop: a letter after what is neither letter nor space gets a mark with a space, for ``initcap``.
    marked = F.initcap(F.regexp_replace(spaced, "(?<=[^a-z ])(?=[a-z])", "\u00a7 "))
    return F.concat(F.lit(" "), F.replace(marked, F.lit("\u00a7 "), F.lit("")), F.lit(" "))


def ngrams(c: Column | str, n: int = 3) -> Column:
    """All runs of ``n`` characters of ``match_text``, in order, repeats kept; none for a shorter text."""

    def cut(s: Column) -> Column:
        last = F.length(s["text"]) - (n - 1)
        grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(s["text"], i, F.lit(n)))
        return F.when(last >= 1, grams).when(s["text"].isNotNull(), F.array().cast("array<string>"))

    return let({"text": match_text(c)}, cut)
