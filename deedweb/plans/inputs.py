"""Property-shaped tables derived from the given ones, by expressions that mean the same in Spark SQL and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _case(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _text(*values: str) -> list[str]:
    return [f"'{v}'" for v in values]


def _name(key: str, other: str) -> str:
    first = _case(
        key,
        _text(
            "Smith & Sons, L.L.C.", "OAK GROVE PROPERTIES THE", "Oak  Grove Oak Grove Properties", "Pleasant View Apartments LLC",
            "FIRST NATL TRUSTEE 12", "jones family trust", "ACME (HOLDINGS) INC.", "John Smith Jr", "CITY OF SPRINGFIELD",
            "-Zinc Partners L L C-", "MARY JONES", "Harbor Real Estate Group",
        ),
    )
    return f"{first} || {_case(other, _text('', ' 7', ' of Boston', ' - North', ' # 2'))}"


def _street(key: str) -> str:
    return _case(
        key,
        [
            f"({key} % 97) || '-' || ({key} % 89) || ' NORTH MAIN STREET APT ' || ({key} % 7)",
            f"({key} % 97) || ' 1 2 SOUTH WEST AVE'",
            f"'PO BOX ' || ({key} % 500) || ' TAX DEPT ' || ({key} % 30)",
            f"({key} % 97) || 'A OAK AVENUE #' || ({key} % 9) || 'B'",
            f"'20 1 ' || ({key} % 90) || ' EAST 42ND STREE UNIT 3'",
            f"({key} % 97) || ' STATE HWY ' || ({key} % 50)",
            f"({key} % 97) || ' FLOWER LANE SUITE ' || ({key} % 5)",
            f"'P O BOX ' || ({key} % 500)",
        ],
    )


def _city(key: str) -> str:
    return _case(key, _text("CHICAGO", "ST PAUL", "MPLS", "NEW YORK", "MNPLS"))


def _state(key: str) -> str:
    return _case(key, _text("IL", "MN", "MN", "NEW YORK", "XX", "TX"))


def _zip(key: str) -> str:
    return _case(key, [f"'' || (60601 + {key} % 900)", f"'' || (606010000 + {key} % 9000)", f"'' || ({key} % 999 + 1)", "'12A34'", f"(60601 + {key} % 90) || '-' || (1000 + {key} % 9000)"])


def _word(key: str, size: int) -> str:
    """A word of letters that a number gives, another for each."""
    return f"upper(translate(substring(md5('' || {key}), 1, {size}), '0123456789', 'ghijklmnop'))"


_THREE = "(c_custkey - c_custkey % 3)"

#: table -> (given table, {column: expression})
DERIVED: dict[str, tuple[str, dict[str, str]]] = {
    "taxpayers": (
        "customer",
        {
            "id": "c_custkey",
            "tax_name": _name("c_custkey", "c_nationkey"),
            "tax_street": _street("c_custkey"),
            "tax_city": _city("c_custkey"),
            "tax_state": _state("c_custkey"),
            "tax_zip": _zip("c_custkey"),
            "city_state_zip": f"{_city('c_custkey')} || ' ' || {_state('c_custkey')} || ' ' || {_zip('c_custkey')}",
        },
    ),
    # Owners as string matching compares them: a name and an address. Three each differ in a number.
    "owners": (
        "customer",
        {
            "id": "c_custkey",
            "doc": f"{_word(_THREE, 7)} || ' ' || {_word(f'({_THREE} % 397)', 6)} || ' - ' || (c_custkey % 97) || ' ' || "
            + _case(_THREE, _text("MAIN", "OAK", "FLOWER", "STATE", "RIVER"))
            + " || ' ST'",
        },
    ),
    "properties": (
        "orders",
        {
            "pin": "o_orderkey",
            "owner": "o_custkey",
            "class_code": "substring(o_orderpriority, 1, 1) || ', ' || o_orderstatus",
            "num_units": "'' || (o_orderkey % 5)",
            "price": "o_totalprice",
        },
    ),
    "corps": (
        "supplier",
        {
            "file_number": "s_suppkey",
            "raw_name": _name("s_suppkey", "s_nationkey"),
            "status": "CASE s_suppkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'dissolved' END",
            "raw_president_address": _street("s_suppkey"),
            "raw_secretary_address": "CASE WHEN s_suppkey % 3 > 0 THEN " + _street("(s_suppkey * 7)") + " END",
        },
    ),
    "llcs": (
        "part",
        {
            "file_number": "p_partkey",
            "raw_name": "p_name || CASE WHEN p_size % 3 = 0 THEN ' LLC' ELSE '' END",
            "status": "CASE p_size % 4 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'dissolved' END",
            "brand": "CASE WHEN p_size % 7 > 2 THEN p_brand END",
            "kind": "p_type",
            "raw_office_address": _street("p_partkey"),
            "raw_manager_member_address": "CASE WHEN p_size % 2 = 0 THEN " + _street("(p_partkey * 3)") + " END",
            "raw_agent_address": "CASE WHEN p_size % 5 = 0 THEN " + _street("(p_partkey * 11)") + " END",
        },
    ),
    "candidates": (
        "lineitem",
        {
            "order_id": "l_orderkey",
            "clean_address": "(l_orderkey % 4 + 1) || ' MAIN ST, CHICAGO, IL ' || (60600 + l_orderkey % 3)",
            "candidate": "l_linenumber",
            "number": "CASE WHEN l_partkey % 5 = 0 THEN '' ELSE '' || (l_partkey % 4 + 1) END",
            "zip_code": "'' || (60600 + l_suppkey % 3)",
            "formatted_address": "(l_partkey % 4 + 1) || ' MAIN ST, CHICAGO, IL ' || (60600 + l_suppkey % 2)",
        },
    ),
    "addresses": (
        "orders",
        {
            "id": "o_orderkey",
            "number": "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '' || (o_orderkey % 300) END",
            "predirectional": _case("o_custkey", _text("N", "", "SE")),
            "prefix": _case("o_orderkey", _text("", "OLD", "")),
            "street": _case("o_custkey", _text("MAIN", "OAK GROVE", "PO BOX", "42ND")),
            "suffix": _case("o_orderkey", _text("ST", "AVE", "")),
            "postdirectional": _case("o_orderkey", _text("", "", "", "W")),
            "secondary_unit": _case("o_custkey", _text("APT", "", "STE", "UNIT", "")),
            "secondary_number": _case("o_orderkey", _text("", "3", "4B")),
            "city": _case("o_custkey", _text("CHICAGO", "ST PAUL")),
            "state": _case("o_custkey", _text("IL", "MN")),
            "zip_code": "'' || (60600 + o_orderkey % 30)",
        },
    ),
    "records": (
        "orders",
        {
            "rid": "o_orderkey",
            "clean_name": "CASE WHEN o_custkey % 17 = 0 THEN 'UNKNOWN' WHEN o_custkey % 19 = 0 THEN 'CHICAGO TITLE LAND' ELSE 'OWNER ' || o_custkey END",
            "match_address_t": "CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN o_orderkey || ' OAK ST' ELSE (o_custkey - o_custkey % 3) || ' MAIN ST' END",
            "exclude_name": "o_custkey % 23 = 0",
            "is_validated_t": "o_orderkey % 5 > 0",
            "is_researched_t": "o_orderkey % 7 > 1",
            "exclude_address_t": "o_orderkey % 900 < 40",
            "is_org_address_t": "o_orderkey % 900 > 860",
            "entity_clean_name": "CASE WHEN o_custkey % 4 = 0 THEN 'OWNER ' || o_custkey END",
            "match_name": "CASE WHEN o_custkey % 6 = 0 THEN 'MATCH ' || (o_custkey - o_custkey % 30) END",
        }
        | {
            k: v
            for i, m in ((1, 70), (2, 50), (3, 30))
            for k, v in {
                f"match_address_e{i}": f"CASE WHEN o_custkey % {i + 4} > 0 THEN (o_custkey - o_custkey % {m}) || ' ENTITY AVE' END",
                f"is_validated_e{i}": f"o_custkey % {i + 2} > 0",
                f"is_researched_e{i}": f"o_custkey % {i + 3} > 0",
                f"exclude_address_e{i}": f"o_custkey % {m} < 3",
                f"is_org_address_e{i}": f"o_custkey % {m} > {m - 6}",
            }.items()
        },
    ),
}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table in Spark."""
    given, columns = DERIVED[name]
    return spark.read.parquet(f"{sf_dir}/{given}.parquet").selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def derived_sql(*names: str) -> str:
    """``WITH`` clauses of derived tables for DuckDB, with a comma at the end."""
    parts = []
    for name in names:
        given, columns = DERIVED[name]
        parts.append(f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {given})")
    return ",\n".join(parts)
