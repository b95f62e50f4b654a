"""Schema contracts of the datasets, and the rows that break them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from deedweb.sources.tables import dataset_path


def columns(*names: str, required: Iterable[str] = (), flags: Iterable[str] = ()) -> StructType:
    """Nullable strings; ``required`` ones are not nullable; ``flags`` are booleans at the end."""
    fields = [StructField(n, StringType(), n not in set(required)) for n in names]
    return StructType([*fields, *(StructField(n, BooleanType(), n not in set(required)) for n in flags)])


@dataclass(frozen=True)
class Contract:
    """Columns with types and nullability, columns without repeats, and allowed values."""

    name: str
    schema: StructType
    unique: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def boolean_fields(self) -> list[str]:
        return [f.name for f in self.schema if isinstance(f.dataType, BooleanType)]

    def extended(self, name: str, more: StructType, unique: tuple[str, ...] = ()) -> Contract:
        return Contract(name, StructType([*self.schema, *more]), (*self.unique, *unique), self.allowed)


#: The names of the datasets' columns, and which of them may not be null or repeat.
_PARTS = ("street", "city", "state", "zip_code")
UNVALIDATED_ADDRS = Contract(
    "unvalidated_addrs",
    columns(*(f"{k}_{p}" for k in ("raw", "clean") for p in _PARTS), "raw_address", "clean_address", "addr_type", "origin", "active", required=("raw_address", "clean_address")),
    unique=("raw_address",),
)
UNVALIDATED_ADDRS_CLEAN = UNVALIDATED_ADDRS.extended("unvalidated_addrs_clean", columns(flags=("is_pobox",), required=("is_pobox",)))
GEOCODED = Contract(
    "geocoded",
    columns(
        "raw_address", "clean_address", "number", "predirectional", "prefix", "street", "suffix", "postdirectional",
        "secondary_unit", "secondary_number", "city", "county", "state", "zip_code", "country", "lng", "lat", "accuracy",
        "formatted_address", flags=("is_pobox",),
        required=("raw_address", "number", "street", "city", "state", "zip_code", "country", "formatted_address"),
    ),
    unique=("raw_address",),
)
GEOCODED_FORMATTED = GEOCODED.extended("geocoded_formatted", columns(*(f"formatted_address_v{i}" for i in range(1, 5))))
FIXING_ADDRS = GEOCODED.extended("fixing_addrs", columns("check_sec_num"))
FIXING_TAX_NAMES = Contract("fixing_tax_names", columns("raw_value", "standardized_value", required=("raw_value",)), unique=("raw_value",))
FREQUENT_TAX_NAMES = Contract("frequent_tax_names", columns("value", "frequency", required=("value",), flags=("exclude_name",)), unique=("value",))
ADDRESS_ANALYSIS = Contract(
    "address_analysis",
    columns(
        "address", "frequency", "value", "name", "urls", "notes", "yelp_urls", "google_urls", "google_place_id", required=("address",),
        flags=("is_landlord_org", "is_govt_agency", "is_lawfirm", "is_missing_suite", "is_problematic_suite", "is_realtor", "is_financial_services",
               "is_assoc_bus", "is_virtual_office_agent", "is_nonprofit", "is_ignore_misc", "fix_address", "is_researched"),
    ),
    unique=("address",),
)
CLASS_CODES = Contract("class_codes", columns("code", "category", "description", required=("code",), flags=("is_rental",)), unique=("code",))
PROPERTIES = Contract("properties", columns("pin", "raw_name_address", "clean_name_address", "class_code", "num_units", required=("pin",)), unique=("pin",))
CONTRACTS = {
    c.name: c
    for c in (
        UNVALIDATED_ADDRS, UNVALIDATED_ADDRS_CLEAN, GEOCODED, GEOCODED_FORMATTED, FIXING_ADDRS, FIXING_TAX_NAMES,
        FREQUENT_TAX_NAMES, ADDRESS_ANALYSIS, CLASS_CODES, PROPERTIES,
    )
}


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``dataset, column, rule, value, n``: broken rules, with the value where there is one and the number of rows.

    Missing columns and nulls take one pass together; repeats and values that are not allowed take one aggregation each.
    """
    required = [f.name for f in contract.schema if not f.nullable]
    present = [c for c in required if c in df.columns]
    row = lambda c, rule, value, n: F.struct(F.lit(c).alias("column"), F.lit(rule).alias("rule"), value.cast("string").alias("value"), n.cast("long").alias("n"))
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in present))
    absent = [f.name for f in contract.schema if f.name not in df.columns]
    none = F.lit(None)
    lines = [row(c, "not_null", none, F.col(c)) for c in present] + [row(c, "missing_column", none, F.lit(1)) for c in absent]
    parts = []
    if lines:
        parts.append(counts.select(F.explode(F.array(*lines)).alias("v")).select("v.*").where("n > 0"))
    for c in contract.unique:
        if c in df.columns:
            again = df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 and value is not null")
            parts.append(again.select(F.lit(c).alias("column"), F.lit("unique").alias("rule"), "value", "n"))
    for c, values in contract.allowed.items():
        if c in df.columns:
            odd = df.where(~F.col(c).isin(*values)).groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
            parts.append(odd.select(F.lit(c).alias("column"), F.lit("allowed").alias("rule"), "value", "n"))
    empty = df.sparkSession.range(0).select(F.lit("").alias("column"), F.lit("").alias("rule"), F.lit("").alias("value"), F.lit(0).cast("long").alias("n"))
    return reduce(DataFrame.unionByName, parts, empty).select(F.lit(contract.name).alias("dataset"), "*")


def write_report(found: list[DataFrame], root: str, workflow: str, at: str) -> str:
    """The results of ``violations`` for the tables of a workflow, as one dataset named by the workflow and the time; returns
    its path. Every run has a report of its own, without rows where nothing is broken."""
    path = f"{dataset_path(root, 'schema', 'validation_errors')}/{workflow}__{at}"
    reduce(DataFrame.unionByName, found).write.mode("errorifexists").parquet(path)
    return path
