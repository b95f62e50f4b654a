"""Column maintenance, joins, deduplication and unions of the record tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedweb.functions.address import first_address

# Columns


def rename_col(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def combine_columns(first: str, second: str) -> Column:
    return F.coalesce(first, second)


def combine_columns_parallel(df: DataFrame) -> DataFrame:
    """Each pair ``X_x``, ``X_y`` becomes ``X``, the first that is not null."""
    pairs = [c[:-2] for c in df.columns if c.endswith("_x") and f"{c[:-2]}_y" in df.columns]
    gone = {f"{p}{s}" for p in pairs for s in ("_x", "_y")}
    return df.select(*(c for c in df.columns if c not in gone), *(F.coalesce(f"{p}_x", f"{p}_y").alias(p) for p in pairs))


def non_raw_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("raw")]


def set_raw_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """A copy of each column as delivered: ``raw_`` before its name, in place of ``tax_`` if it begins so."""
    return df.withColumns({f"raw_{c.removeprefix('tax_')}": F.col(c) for c in cols})


def split_props_taxpayers(df: DataFrame, props: list[str], taxpayers: list[str], row_id: str) -> tuple[DataFrame, DataFrame]:
    """Properties, and one row for each ``raw_name_address``: that with the smallest ``row_id``."""
    return df.select(*props), keep_first(df, ["raw_name_address"], row_id).select(*taxpayers)


def name_address(name: str, address: str, second_name: str | None = None) -> Column:
    """``name -- [second name --] address``; null if the name or the address is."""
    plain = F.concat(F.col(name), F.lit(" -- "), F.col(address))
    if second_name is None:
        return plain
    both = F.concat(F.col(name), F.lit(" -- "), F.col(second_name), F.lit(" -- "), F.col(address))
    return F.when(F.col(second_name).isNotNull(), both).otherwise(plain)


def match_document(name: str, address: str) -> Column:
    """The document that string matching compares."""
    return F.concat(F.col(name), F.lit(" - "), F.col(address))


def set_business_names(df: DataFrame) -> DataFrame:
    """The entity's names where a record has one."""
    has = F.col("entity_clean_name").isNotNull()
    return df.withColumns(
        {"clean_name": F.when(has, F.col("entity_clean_name")).otherwise(F.col("clean_name")),
         "core_name": F.when(has, F.col("entity_core_name")).otherwise(F.col("core_name"))}
    )


ENTITY_COLUMNS = ("entity_clean_name", "entity_core_name", "entity_address_1", "entity_address_2", "entity_address_3")


def clear_excluded_entities(df: DataFrame, cols: tuple[str, ...] = ENTITY_COLUMNS) -> DataFrame:
    """Nulls in the entity columns of excluded names."""
    return df.withColumns({c: F.when(~F.coalesce("exclude_name", F.lit(False)), F.col(c)) for c in cols})


def shift_taxpayers(df: DataFrame) -> DataFrame:
    """Where the third name is missing, the others move up by one."""
    free = F.col("taxpayer_3").isNull()
    return df.withColumns(
        {"taxpayer_1": F.when(~free, F.col("taxpayer_1")),
         "taxpayer_2": F.when(free, F.col("taxpayer_1")).otherwise(F.col("taxpayer_2")),
         "taxpayer_3": F.when(free, F.col("taxpayer_2")).otherwise(F.col("taxpayer_3"))}
    )


def shift_streets(df: DataFrame, prefix: str = "") -> DataFrame:
    """Where the first street line is missing, the second moves up."""
    one, two = F.col(f"{prefix}street_1"), F.col(f"{prefix}street_2")
    free = one.isNull() & two.isNotNull()
    return df.withColumns({f"{prefix}street_1": F.when(free, two).otherwise(one), f"{prefix}street_2": F.when(~free, two)})


# Joins


def merge_orgs(taxpayers: DataFrame, orgs: DataFrame, key: str = "clean", right_on: str = "entity_clean_name") -> DataFrame:
    """Organisations joined on ``clean_name`` or ``core_name``; columns that both have are taken from the left first."""
    both = [c for c in orgs.columns if c in taxpayers.columns]
    right = orgs.select(*(F.col(c).alias(f"_right_{c}" if c in both else c) for c in orgs.columns))
    on = F.col(f"_right_{right_on}" if right_on in both else right_on)
    joined = taxpayers.join(right, taxpayers[f"{key}_name"] == on, "left")
    left = [F.coalesce(taxpayers[c], F.col(f"_right_{c}")).alias(c) if c in both else taxpayers[c] for c in taxpayers.columns]
    return joined.select(*left, *(c for c in orgs.columns if c not in both))


def merge_validated_addrs(df: DataFrame, validated: DataFrame, cols: list[str]) -> DataFrame:
    """For each address column, the validated form as ``<column>_v``. The columns' distinct combinations are looked up address by
    address, in one join for all columns; the wide table is shuffled once, to meet what was found."""
    known = validated.groupBy(F.col("clean_address").alias("_at")).agg(F.min("formatted_address").alias("_valid"))
    combo = F.struct(*(F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(cols)))
    combos = df.select(combo.alias("_combo")).distinct()
    places = F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"_combo._{i}").alias("a")) for i in range(len(cols))))
    each = combos.select("_combo", F.inline(places)).where("a is not null").join(known, F.col("a") == F.col("_at"))
    found = each.groupBy("_combo").agg(*(F.max(F.when(F.col("i") == i, F.col("_valid"))).alias(f"{c}_v") for i, c in enumerate(cols)))
    return df.join(found, combo == F.col("_combo"), "left").drop("_combo")


def merge_validated_variants(df: DataFrame, validated: DataFrame, address_col: str) -> DataFrame:
    """The five variants of the validated address as ``<column>_v0`` to ``_v4``."""
    names = {f"formatted_address_v{i}": f"{address_col}_v{i}" for i in range(5)}
    right = validated.select(F.col("clean_address").alias("_at"), *(F.col(a).alias(b) for a, b in names.items()))
    return df.join(right, df[address_col] == F.col("_at"), "left").drop("_at")


def merge_proptax_match(taxpayers: DataFrame, props: DataFrame, prop_addrs: DataFrame, validated: DataFrame) -> DataFrame:
    """One row for each ``pin``: the property, its address, its taxpayer and the validated form of the taxpayer's address.
    Each of the right sides has one row for each key (that with the smallest values)."""
    joined = (
        props.join(_one_row(prop_addrs, "pin"), "pin", "left")
        .join(_one_row(taxpayers, "raw_name_address"), "raw_name_address", "left")
        .join(_one_row(validated, "clean_address"), "clean_address", "left")
    )
    return _one_row(joined, "pin")


def _one_row(df: DataFrame, key: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    found = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return found.select(key, *(F.col(f"_row.{c}").alias(c) for c in rest))


def flag_from_list(df: DataFrame, col: str, listed: DataFrame, listed_col: str, flag: str) -> DataFrame:
    """``flag``: whether the value is in a column of another table. Null never is."""
    known = listed.select(F.col(listed_col).alias("_listed")).distinct()
    return df.join(known, df[col] == F.col("_listed"), "left").withColumn(flag, F.col("_listed").isNotNull()).drop("_listed")


def set_is_rental_initial(props: DataFrame, codes: DataFrame) -> DataFrame:
    """Whether one of a property's comma-separated class codes is a rental code. The codes are a reference table of some
    hundred rows; each distinct ``class_code`` is judged once."""
    rental = codes.where("is_rental").select(F.col("code").alias("_code")).distinct()
    each = props.select("class_code").distinct().withColumn("_code", F.explode(F.transform(F.split("class_code", ","), lambda x: F.trim(x))))
    hit = each.join(rental, "_code", "left_semi").select(F.col("class_code").alias("_class")).distinct()
    return props.join(hit, props["class_code"] == F.col("_class"), "left").withColumn("is_rental", F.col("_class").isNotNull()).drop("_class")


def set_is_rental_final(df: DataFrame, nonrental: DataFrame) -> DataFrame:
    """The flag as it was, or true for the listed ``raw_name_address``."""
    marked = flag_from_list(df, "raw_name_address", nonrental, "raw_name_address", "_more")
    return marked.withColumn("is_rental", F.coalesce("is_rental", F.lit(False)) | F.col("_more")).drop("_more")


def set_is_landlord_org(taxpayers: DataFrame, analysis: DataFrame) -> DataFrame:
    return flag_from_list(taxpayers, "raw_address_v", analysis.where("is_landlord_org"), "address", "is_landlord_org")


def set_exclude_name(taxpayers: DataFrame, frequent: DataFrame) -> DataFrame:
    return flag_from_list(taxpayers, "clean_name", frequent.where("exclude_name"), "value", "exclude_name")


ADDRESS_FLAGS = {
    "exclude_address": "is_ignore_misc",
    "is_org_address": "is_landlord_org",
    "is_missing_suite": "is_missing_suite",
    "is_problem_suite": "is_problematic_suite",
    "is_realtor": "is_realtor",
}


def set_address_flags(
    df: DataFrame, analysis: DataFrame, address_cols: Mapping[str, str], flags: Mapping[str, str] = ADDRESS_FLAGS
) -> DataFrame:
    """Research flags of addresses. ``address_cols`` has a suffix for each address column; ``flags`` the column of
    ``analysis`` behind each flag. Every address in ``analysis`` counts as researched. One join for an address column sets
    all of its flags."""
    known = analysis.groupBy("address").agg(*(F.bool_or(F.coalesce(src, F.lit(False))).alias(flag) for flag, src in flags.items()))
    for col, suffix in address_cols.items():
        names = {f: f"{f}{suffix}" for f in flags}
        right = known.select(F.col("address").alias("_at"), *(F.col(f).alias(n) for f, n in names.items()))
        df = df.join(right, df[col] == F.col("_at"), "left").withColumns(
            {**{n: F.coalesce(n, F.lit(False)) for n in names.values()}, f"is_researched{suffix}": F.col("_at").isNotNull()}
        )
        df = df.drop("_at")
    return df


def nonrentals_from_addrs(everyone: DataFrame, rentals: DataFrame, address: str = "tax_address", key: str = "raw_name_address") -> DataFrame:
    """Rows that are not rentals, and whose address is that of a rental."""
    others = everyone.join(rentals.select(key).distinct(), key, "left_anti")
    return others.join(rentals.select(address).distinct(), address, "left_semi")


def remove_listed(df: DataFrame, listed: DataFrame, col: str, listed_col: str | None = None) -> DataFrame:
    """Rows whose value another table does not have; rows with null stay."""
    return df.join(listed.select(F.col(listed_col or col).alias("_listed")).distinct(), df[col] == F.col("_listed"), "left_anti")


# Aggregation and deduplication


def frequency(df: DataFrame, col: str, value: str = "value", count: str = "frequency") -> DataFrame:
    """How often each value occurs, most first, then by value. Nulls are not counted."""
    counted = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(value)).agg(F.count(F.lit(1)).alias(count))
    return counted.orderBy(F.col(count).desc(), value)


def duplicates(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """The rows of values that occur again, and the others. Nulls count as one value. Values are counted by a partial
    aggregation, so a frequent one does not meet in one task."""
    again = df.groupBy(F.struct(col).alias("_again")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    keyed = df.withColumn("_key", F.struct(col))
    on = F.col("_key") == F.col("_again")
    return keyed.join(again, on, "left_semi").drop("_key"), keyed.join(again, on, "left_anti").drop("_key")


def merge_duplicates(df: DataFrame, subset: list[str], row_id: str, status: str = "status") -> DataFrame:
    """One row for each group: the status 0 before 1 before the first that is not null, and of every other column the first
    value that is not null, in the order of ``row_id``. Groups with a null key go."""
    rest = [c for c in df.columns if c not in (*subset, status)]
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(row_id)))
    of_status = []
    if status in df.columns:
        best = F.coalesce(F.max(F.when(F.col(status) == "0", "0")), F.max(F.when(F.col(status) == "1", "1")), first(status))
        of_status = [best.alias(status)]
    known = df.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in subset)))
    return known.groupBy(*subset).agg(*of_status, *(first(c).alias(c) for c in rest)).select(*df.columns)


def keep_first(df: DataFrame, subset: list[str], row_id: str) -> DataFrame:
    """The row with the smallest ``row_id`` of each group, by partial aggregation; null keys are a group."""
    rows = df.groupBy(*subset).agg(F.min_by(F.struct(*df.columns), row_id).alias("_row"))
    return rows.select(*(F.col(f"_row.{c}").alias(c) for c in df.columns))


def active(df: DataFrame, col: str = "status") -> DataFrame:
    return df.where(F.col(col).isin("0", "1"))


def poboxes(df: DataFrame) -> DataFrame:
    return df.where("is_pobox")


def unvalidated_addresses(sources: list[tuple[DataFrame, str, str, dict[str, str]]]) -> DataFrame:
    """The addresses of all datasets: of each, a table, its origin, the kind of address, and its columns for ``raw_address``
    (needed) and further ones. An address is taken from the first source that has it."""
    names = list(dict.fromkeys(n for *_, cols in sources for n in cols))
    parts = []
    for i, (df, origin, kind, cols) in enumerate(sources):
        part = df.select(*(F.col(src).alias(n) for n, src in cols.items()), F.lit(origin).alias("origin"), F.lit(kind).alias("addr_type"))
        parts.append(part.withColumn("_source", F.lit(i)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).where("raw_address is not null")
    order = F.struct("_source", *(n for n in names if n != "raw_address"))
    rows = union.groupBy("raw_address").agg(F.min_by(F.struct(*names, "origin", "addr_type"), order).alias("_row"))
    return rows.select(*(F.col(f"_row.{c}").alias(c) for c in (*names, "origin", "addr_type")))


CORP_ADDRESSES = ("raw_president_address", "raw_secretary_address")
LLC_ADDRESSES = ("raw_office_address", "raw_manager_member_address", "raw_agent_address")


def combine_corps_llcs(corps: DataFrame, llcs: DataFrame) -> DataFrame:
    """Corporations and LLCs under common names: up to three addresses, each with its validated form and the one to match."""

    def shaped(df: DataFrame, origin: str, addresses: tuple[str, ...]) -> DataFrame:
        cols = [
            c
            for i, a in enumerate(addresses, 1)
            for c in (
                F.col(a).alias(f"entity_address_{i}"),
                F.col(f"{a}_v").alias(f"entity_address_{i}_v"),
                first_address(f"{a}_v", a).alias(f"match_address_e{i}"),
            )
        ]
        return df.select(F.lit(origin).alias("origin"), F.col("clean_name").alias("entity_clean_name"), F.col("core_name").alias("entity_core_name"), *cols)

    return shaped(corps, "corp", CORP_ADDRESSES).unionByName(shaped(llcs, "llc", LLC_ADDRESSES), allowMissingColumns=True)


def in_top(df: DataFrame, col: str, n: int = 100) -> DataFrame:
    """The rows whose value is among the ``n`` most frequent ones."""
    top = frequency(df, col).limit(n).select(F.col("value").alias("_top"))
    return df.join(F.broadcast(top), df[col] == F.col("_top"), "left_semi")


