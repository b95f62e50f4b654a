"""Summary statistics as small tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedweb.operators.tables import in_top


def _stacked(row: DataFrame, names: dict[str, str]) -> DataFrame:
    """``stat, value`` rows from one row of aggregates."""
    pairs = F.array(*(F.struct(F.lit(n).alias("stat"), F.col(c).cast("long").alias("value")) for c, n in names.items()))
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def distinct_values(c: str) -> Column:
    """Distinct values, null among them."""
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))


def load_table(dfs: dict[str, DataFrame]) -> DataFrame:
    """``dataset, n_rows, n_columns``."""
    rows = [df.agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")) for n, df in dfs.items()]
    return reduce(DataFrame.unionByName, rows)


def null_profile(dfs: dict[str, DataFrame]) -> DataFrame:
    """``dataset, column, n_missing``: nulls and empty strings of each column, in one pass over each table."""

    def profile(name: str, df: DataFrame) -> DataFrame:
        missing = lambda c: F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == ""))
        row = df.agg(*(missing(c).alias(c) for c in df.columns))
        return _stacked(row, {c: c for c in df.columns}).select(F.lit(name).alias("dataset"), F.col("stat").alias("column"), F.col("value").alias("n_missing"))

    return reduce(DataFrame.unionByName, (profile(n, df) for n, df in dfs.items()))


def data_clean(properties: DataFrame, taxpayers: DataFrame, corps: DataFrame, llcs: DataFrame, addresses: DataFrame) -> DataFrame:
    """``stat, value``: distinct properties, taxpayer records and business names, and rows of addresses."""
    parts = [
        _stacked(properties.agg(distinct_values("pin").alias("a")), {"a": "Unique Properties"}),
        _stacked(taxpayers.agg(distinct_values("raw_name_address").alias("a")), {"a": "Unique Taxpayer Records"}),
    ]
    for df, label in ((corps, "Corporations"), (llcs, "LLCs")):
        row = df.agg(distinct_values("raw_name").alias("a"), distinct_values("clean_name").alias("b"))
        parts.append(_stacked(row, {"a": f"Unique {label} (Raw)", "b": f"Unique {label} (Clean)"}))
    parts.append(_stacked(addresses.agg(F.count(F.lit(1)).alias("a")), {"a": "Unique Addresses (Unvalidated)"}))
    return reduce(DataFrame.unionByName, parts)


def address_clean(addresses: DataFrame) -> DataFrame:
    return _stacked(addresses.agg(F.count_if("is_pobox").alias("a")), {"a": "PO Box Addresses"})


def geocoded(valid_before: DataFrame, valid_after: DataFrame, unvalid_before: DataFrame, unvalid_after: DataFrame) -> DataFrame:
    """``stat, value`` with texts like ``1,234 (+34)``."""

    def line(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
        rows = before.select("clean_address", F.lit(False).alias("new")).unionByName(after.select("clean_address", F.lit(True).alias("new")))
        found = rows.groupBy("new").agg(distinct_values("clean_address").alias("n"))
        total = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.coalesce(F.sum(F.when(F.col("new"), F.col("n"))), F.lit(0)).alias("more"))
        text = F.concat(F.format_number("all", 0), F.lit(" (+"), F.format_number("more", 0), F.lit(")"))
        return total.select(F.lit(label).alias("stat"), text.alias("value"))

    return line(valid_before, valid_after, "Validated addresses").unionByName(line(unvalid_before, unvalid_after, "Unvalidated addresses"))


def clean_merge(taxpayers: DataFrame, corps: DataFrame, llcs: DataFrame) -> DataFrame:
    """``stat, value``: taxpayer records linked to businesses, and organisations that are linked to none."""
    alone = F.col("origin").isNull()
    row = taxpayers.agg(
        F.count_if(F.col("origin") == "corp").alias("a"), F.count_if(F.col("origin") == "llc").alias("b"),
        F.count_if(alone & F.col("is_llc")).alias("c"), F.count_if(alone & F.col("is_org")).alias("d"),
    )
    linked = _stacked(row, {"a": "Number of Linked Corporations in Taxpayer Records", "b": "Number of Linked LLCs in Taxpayer Records",
                            "c": "Unlinked LLCs in Taxpayer Records", "d": "Unlinked Organizations in Taxpayer Records"})
    count = lambda df, n: _stacked(df.agg(F.count(F.lit(1)).alias("a")), {"a": n})
    return linked.unionByName(count(corps, "Unique Corporations Identified in Taxpayer Records")).unionByName(count(llcs, "Unique LLCs Identified in Taxpayer Records"))


def string_match(taxpayers: DataFrame, match_cols: list[str]) -> DataFrame:
    """``string_match_name, matched_taxpayers, unique_matches, percent_matched`` for each set of parameters, in one pass."""
    aggs = [x for i, c in enumerate(match_cols) for x in (F.count(c).alias(f"n{i}"), F.count_distinct(c).alias(f"u{i}"))]
    row = taxpayers.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    share = lambda i: F.round(F.try_divide(F.col(f"n{i}") * 100.0, F.col("rows")), 2)
    lines = [
        F.struct(F.lit(c).alias("string_match_name"), F.col(f"n{i}").alias("matched_taxpayers"), F.col(f"u{i}").alias("unique_matches"), share(i).alias("percent_matched"))
        for i, c in enumerate(match_cols)
    ]
    return row.select(F.explode(F.array(*lines)).alias("p")).select("p.*")


def network_graph(taxpayers: DataFrame, network_cols: list[str], top: int = 100) -> DataFrame:
    """``network_name, taxpayers_missing_networks, unique_networks, taxpayers_in_top`` for each set of parameters."""

    def one(c: str) -> DataFrame:
        row = taxpayers.agg(F.count_if(F.col(c).isNull()).alias("taxpayers_missing_networks"), F.count_distinct(c).alias("unique_networks"))
        inside = in_top(taxpayers, c, top).agg(F.count(F.lit(1)).alias("taxpayers_in_top"))
        return row.crossJoin(inside).select(F.lit(c).alias("network_name"), "*")

    return reduce(DataFrame.unionByName, map(one, network_cols))
