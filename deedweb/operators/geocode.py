"""Requests to a geocoder and the resolution of its answers, as tables. The call itself is left to the user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deedweb.functions.tokens import token_at, tokens

COMPONENTS = {
    "number": "number", "predirectional": "predirectional", "prefix": "prefix", "street": "street", "suffix": "suffix",
    "postdirectional": "postdirectional", "secondary_unit": "secondaryunit", "secondary_number": "secondarynumber",
    "city": "city", "county": "county", "state": "state", "zip_code": "zip", "country": "country",
}
RESULTS = (
    "array<struct<address_components: struct<"
    + ", ".join(f"{c}: string" for c in COMPONENTS.values())
    + ">, formatted_address: string, location: struct<lat: double, lng: double>, accuracy: double, accuracy_type: string, source: string>>"
)


def requests(df: DataFrame) -> DataFrame:
    """``df`` plus ``request``: the parts of a structured query, or the free text ``q`` where there is no zip code."""
    parts = {"street": "clean_street_1", "street2": "clean_street_2", "city": "clean_city", "state": "clean_state", "postal_code": "clean_zip_code", "country": "clean_country"}
    known = F.col("clean_zip_code").isNotNull()
    fields = [F.when(~known, F.col("clean_address")).alias("q"), *(F.when(known, F.col(c)).alias(n) for n, c in parts.items())]
    return df.withColumn("request", F.struct(*fields))


def searched(df: DataFrame) -> DataFrame:
    """The left side of the resolution."""
    return df.select("clean_address", F.col("clean_street_1").alias("street"), F.col("clean_city").alias("city"), F.col("clean_state").alias("state"), F.col("clean_zip_code").alias("zip_code"))


def flatten_results(df: DataFrame, keep: list[str], results: str = "results") -> DataFrame:
    """A row for each candidate, with its place ``candidate``; missing parts are empty strings, and all are strings."""
    rows = df.select(*keep, F.posexplode(results).alias("candidate", "_r"))
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return rows.select(
        *keep,
        "candidate",
        *(empty(F.col(f"_r.address_components.{src}")).alias(n) for n, src in COMPONENTS.items()),
        *(empty(F.col(f"_r.location.{n}")).alias(n) for n in ("lng", "lat")),
        *(empty(F.col(f"_r.{n}")).alias(n) for n in ("accuracy", "formatted_address")),
    )


def every_candidate(answers: DataFrame, keep: list[str], results: str = "results") -> DataFrame:
    """All candidates of all answers, none left out: for a user who wants to choose among them."""
    return flatten_results(answers, keep, results)


def resolve(candidates: DataFrame, address: str = "clean_address", street: str | None = None, zip_code: str | None = None) -> DataFrame:
    """The candidates that stay for each address.

    1. Without any street number all stay. One candidate with a number, or candidates that all have one formatted address:
       the first of them. 2. Then those with the address's own number: none, then all candidates stay; one, or all alike, the
       first. 3. Then those with its zip code too: none, then those of step 2 stay; one, or all alike, the first; else they.

    The number is the first word of ``street``, or of the address; the zip code is ``zip_code``, or the last word of the
    address. An address has a handful of candidates, so one window over its rows does all steps.
    """
    number = token_at(tokens(street or F.split_part(address, F.lit(","), F.lit(1))), 1)
    code = F.col(zip_code) if zip_code else token_at(tokens(address), -1)
    levels = {1: F.col("number") != "", 2: F.col("number") == number, 3: (F.col("number") == number) & (F.col("zip_code") == code)}
    group = Window.partitionBy(address)
    rows = candidates
    for i, level in levels.items():
        hit = F.coalesce(level, F.lit(False))
        rows = rows.withColumns(
            {
                f"_hit{i}": hit,
                f"_n{i}": F.count_if(hit).over(group),
                f"_low{i}": F.min(F.when(hit, F.col("formatted_address"))).over(group),
                f"_high{i}": F.max(F.when(hit, F.col("formatted_address"))).over(group),
                f"_first{i}": F.min(F.when(hit, F.col("candidate"))).over(group),
            }
        )
    one = lambda i: (F.col(f"_n{i}") == 1) | (F.col(f"_low{i}") == F.col(f"_high{i}"))
    first = lambda i: F.col("candidate") == F.col(f"_first{i}")
    stays = (
        F.when(F.col("_n1") == 0, True)
        .when(one(1), first(1))
        .when(F.col("_n2") == 0, True)
        .when(one(2), first(2))
        .when(F.col("_n3") == 0, F.col("_hit2"))
        .when(one(3), first(3))
        .otherwise(F.col("_hit3"))
    )
    return rows.where(stays).select(*candidates.columns)


def process_results(candidates: DataFrame, address: str = "clean_address", **options: str) -> DataFrame:
    """``resolve`` over upper-case candidates."""
    upper = {c: F.upper(c) for c, kind in candidates.dtypes if kind == "string" and c != address}
    return resolve(candidates.withColumns(upper), address, **options)


def split_results(asked: DataFrame, resolved: DataFrame, address: str = "clean_address") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validated (one candidate left), unvalidated (several, all of them) and failed addresses (no candidate).

    Sizes of Parquet files say little about repetitive answers, whose addresses may be a hundred times larger; the hint keeps Spark from broadcasting them."""
    counted = resolved.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(address)))
    found = resolved.select(address).distinct()
    return counted.where("_n = 1").drop("_n"), counted.where("_n > 1").drop("_n"), asked.join(found.hint("merge"), address, "left_anti")


def cost(df: DataFrame, price: float = 0.0005, free: int = 2500) -> DataFrame:
    """``addresses`` and ``cost`` of geocoding them."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("addresses"), F.round(F.greatest(n - free, F.lit(0)) * price, 4).alias("cost"))
