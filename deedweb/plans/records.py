"""Further queries over the record tables, each next to the DuckDB SQL that it is held against.

``made`` adds columns to derived tables by expressions that mean the same in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedweb.functions import address as A
from deedweb.functions import classify as Q
from deedweb.functions import clean as C
from deedweb.functions import constants as K
from deedweb.operators import geocode, network
from deedweb.operators import match as M
from deedweb.operators import tables as T
from deedweb.plans.inputs import DERIVED, derived
from deedweb.plans.queries import PARAMS, query
from deedweb.plans.sql import EDGES, PARTS, STATES, collapsed, formatted, over, sql_grams, words
from deedweb.scratch import fresh_path
from deedweb.sources import contracts, tables

Expressions = dict[str, str]

FILING: Expressions = {
    "street_1": "CASE WHEN id % 3 > 0 THEN tax_street END",
    "street_2": "CASE WHEN id % 4 > 0 THEN 'STE ' || (id % 10) END",
    "city": "CASE WHEN id % 5 > 0 THEN tax_city END",
    "state": "CASE WHEN id % 7 > 0 THEN tax_state END",
    "zip_code": "CASE WHEN id % 11 > 0 THEN tax_zip END",
}
SECOND: Expressions = {
    "raw_name": "CASE WHEN id % 6 > 0 THEN tax_name END",
    "second_name": "CASE WHEN id % 3 = 0 THEN 'C/O ' || (id % 50) END",
    "raw_address": "CASE WHEN id % 5 > 0 THEN tax_street END",
}
ENTITY: Expressions = {
    "clean_name": "tax_name",
    "core_name": "'CORE ' || id",
    "entity_clean_name": "CASE WHEN id % 3 = 0 THEN 'ENTITY ' || (id % 40) END",
    "entity_core_name": "CASE WHEN id % 3 = 0 THEN 'E' || (id % 40) END",
    "entity_address_1": "tax_street",
    "entity_address_2": "CASE WHEN id % 2 = 0 THEN tax_city END",
    "entity_address_3": "tax_zip",
    "exclude_name": "CASE id % 4 WHEN 0 THEN true WHEN 1 THEN false END",
}
OWNERS: Expressions = {
    "taxpayer_1": "tax_name",
    "taxpayer_2": "CASE WHEN id % 2 = 0 THEN 'SECOND ' || id END",
    "taxpayer_3": "CASE WHEN id % 3 = 0 THEN 'THIRD ' || id END",
}
VALID: Expressions = {"raw_address": "tax_street", "raw_address_v": "CASE id % 3 WHEN 1 THEN ' ' WHEN 2 THEN tax_street || ' OK' END"}
UNITS: Expressions = {
    "formatted_address": "(id % 97) || ' MAIN ' || CASE WHEN id % 5 = 0 THEN 'ST ST' ELSE 'ST' END || ', ' || city",
    "unit_kind": "nullif(secondary_unit, '')",
    "unit_number": "nullif(secondary_number, '')",
    "number_suffix": "CASE WHEN id % 9 = 0 THEN 'B' ELSE ' ' END",
    "some_city": "CASE WHEN id % 5 > 0 THEN city ELSE ' ' END",
}
DOCS: Expressions = {
    "original_doc": "(id % 50) || ' MAIN ST ' || secondary_number || ', CHICAGO, IL ' || (60600 + id % 7)",
    "matched_doc": "(id % 30) || ' MAIN ST, CHICAGO, IL ' || (60600 + id % 11)",
}
#: The taxpayer's own address is that of the property, or differs in a word, or is another.
VERDICT: Expressions = {
    "clean_address": "(id % 300) || ' OAK ST, CHICAGO, IL ' || (60600 + id % 30)",
    "clean_address_v1": "CASE WHEN id % 3 = 0 THEN (id % 300) || ' OAK GROVE ST, CHICAGO, IL ' || (60600 + id % 30) END",
    "formatted_address_prop": "CASE id % 4 WHEN 0 THEN (id % 300) || ' OAK GROVE ST, CHICAGO, IL ' || (60600 + id % 30) "
    "WHEN 1 THEN (id % 300) || ' OAK GROVES ST, CHICAGO, IL ' || (60600 + id % 30) WHEN 2 THEN (id % 300) || ' OAK STS, CHICAGO, IL ' || (60600 + id % 30) END",
    "number_validated": "'' || (id % 300)",
    "street_validated": "'OAK GROVE'",
    "zip_code_validated": "'' || (60600 + id % 30)",
}


def made(spark: SparkSession, sf_dir: str, name: str, more: Expressions) -> DataFrame:
    return derived(spark, sf_dir, name).selectExpr("*", *(f"{e} AS {c}" for c, e in more.items() if not _has(name, c)))


def _has(name: str, column: str) -> bool:
    return column in DERIVED[name][1]


def held(query_name: str, name: str, more: Expressions, body: str, *inputs: str, recursive: bool = False) -> None:
    """The SQL of a query over ``x``, a derived table with more columns."""
    columns = "".join(f", {e} AS {c}" for c, e in more.items() if not _has(name, c))
    over(query_name, f", x AS (SELECT *{columns} FROM {name}) {body}", name, *inputs, recursive=recursive)


# Addresses


@query
def short_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, "addresses", UNITS).select("id", A.short_address().alias("address"))


_BLANK = lambda c: f"nullif(trim({c}), '')"
held(
    "short_address", "addresses", UNITS,
    f"""SELECT id, concat_ws(' ', {', '.join(map(_BLANK, ('number', 'number_suffix', 'predirectional', 'street', 'suffix', 'postdirectional')))},
  CASE WHEN {_BLANK('secondary_number')} IS NOT NULL THEN concat_ws(' ', {_BLANK('secondary_unit')}, {_BLANK('secondary_number')}) END) AS address FROM x""",
)


@query
def formatted_or_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = made(spark, sf_dir, "addresses", UNITS).withColumn("city", F.col("some_city"))
    return df.select("id", *(c.alias(n) for n, c in A.formatted_addresses(or_given=True).items()))


held(
    "formatted_or_given", "addresses", UNITS,
    "SELECT id, " + ", ".join(f"CASE WHEN trim(some_city) = '' THEN formatted_address ELSE {formatted(*v)} END AS formatted_address_{k}" for k, v in A.VARIANTS.items()) + " FROM x",
)


@query
def formatted_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = made(spark, sf_dir, "addresses", UNITS).withColumns({"secondary_unit": F.col("unit_kind"), "secondary_number": F.col("unit_number")})
    return df.select("id", A.fix_formatted_address_unit().alias("address"))


held(
    "formatted_unit", "addresses", UNITS,
    f""", s AS (SELECT *, trim(string_split(formatted_address, ',')[1]) AS street_part FROM x),
l AS (SELECT *, CASE WHEN unit_kind IS NOT NULL THEN street_part || ', ' || concat_ws(' ', unit_kind, unit_number)
  WHEN unit_number IS NOT NULL THEN street_part || ' ' || unit_number ELSE street_part END AS line FROM s), w AS (SELECT *, {words('line')} AS ws FROM l)
SELECT id, CASE WHEN coalesce(ws[-1] = ws[-2], false) THEN array_to_string(ws[:-2], ' ') ELSE line END || ', ' || city || ', ' || state || ' ' || zip_code AS address FROM w""",
)


@query
def concatenated_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "taxpayers")
    df = df.select("id", F.col("tax_street").alias("clean_street"), F.col("city_state_zip").alias("clean_city_state_zip"), *(c.alias(n) for n, c in A.city_state_zip("city_state_zip").items()))
    return df.select("id", A.concatenated_address().alias("address"))


over(
    "concatenated_address",
    f""", w AS (SELECT *, {words('city_state_zip')} AS ws FROM taxpayers)
SELECT id, CASE WHEN regexp_matches(ws[-1], '^([0-9]{{5}}|[0-9]{{9}}|[0-9]{{5}}-[0-9]{{4}})$') AND list_contains({STATES}, ws[-2])
  THEN tax_street || ', ' || array_to_string(ws[:-3], ' ') || ', ' || ws[-2] || ' ' || ws[-1] ELSE tax_street || ', ' || city_state_zip END AS address FROM w""",
    "taxpayers",
)


@query
def filing_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = T.shift_streets(made(spark, sf_dir, "taxpayers", FILING))
    df = df.withColumn("is_incomplete_address", Q.is_incomplete_address())
    return df.select("id", "street_1", "street_2", "is_incomplete_address", A.filing_address().alias("address"), A.filing_street("street_1", "street_2").alias("street"))


held(
    "filing_addresses", "taxpayers", FILING,
    """, s AS (SELECT id, coalesce(street_1, street_2) AS a, CASE WHEN street_1 IS NOT NULL THEN street_2 END AS b, city, state, zip_code FROM x)
SELECT id, a AS street_1, b AS street_2, a IS NULL OR zip_code IS NULL AS is_incomplete_address,
  a || coalesce(' ' || b, '') || ', ' || coalesce(city || ', ', '') || coalesce(state || ' ', '') || zip_code AS address, a || coalesce(' ' || b, '') AS street FROM s""",
)


# Columns and records


@query
def matching_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address to match, whether it is validated, and two columns made one."""
    df = T.rename_col(made(spark, sf_dir, "taxpayers", VALID), "tax_street", "street")
    return df.select(
        "id", "street", A.matching_address().alias("match_address_t"), Q.is_validated("raw_address_v").alias("is_validated_t"), T.combine_columns("raw_address_v", "raw_address").alias("either")
    )


held(
    "matching_addresses", "taxpayers", VALID,
    """SELECT id, tax_street AS street, CASE WHEN trim(coalesce(raw_address_v, '')) = '' THEN raw_address ELSE raw_address_v END AS match_address_t,
  raw_address_v IS NOT NULL AS is_validated_t, coalesce(raw_address_v, raw_address) AS either FROM x""",
)


@query
def combined_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "taxpayers").select(
        "id", F.when(F.col("id") % 2 == 0, F.col("tax_name")).alias("name_x"), F.concat(F.lit("Y"), F.col("id")).alias("name_y"), F.col("tax_city").alias("raw_city"), F.col("tax_zip").alias("zip_y")
    )
    df = T.combine_columns_parallel(df)
    return df.select(*T.non_raw_columns(df))


over("combined_pairs", "SELECT id, CASE WHEN id % 2 = 0 THEN tax_name ELSE 'Y' || id END AS name, tax_zip AS zip_y FROM taxpayers", "taxpayers")


@query
def second_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, "taxpayers", SECOND).select("id", T.name_address("raw_name", "raw_address", "second_name").alias("name_address"))


held("second_names", "taxpayers", SECOND, "SELECT id, raw_name || ' -- ' || coalesce(second_name || ' -- ', '') || raw_address AS name_address FROM x")


@query
def business_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = T.set_business_names(T.clear_excluded_entities(made(spark, sf_dir, "taxpayers", ENTITY)))
    return df.select("id", "clean_name", "core_name", *T.ENTITY_COLUMNS)


held(
    "business_names", "taxpayers", ENTITY,
    ", e AS (SELECT id, clean_name AS n, core_name AS c, "
    + ", ".join(f"CASE WHEN NOT coalesce(exclude_name, false) THEN {c} END AS {c}" for c in T.ENTITY_COLUMNS)
    + " FROM x) SELECT id, coalesce(entity_clean_name, n) AS clean_name, coalesce(entity_core_name, c) AS core_name, "
    + ", ".join(T.ENTITY_COLUMNS) + " FROM e",
)


@query
def shifted_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.shift_taxpayers(made(spark, sf_dir, "taxpayers", OWNERS)).select("id", "taxpayer_1", "taxpayer_2", "taxpayer_3")


held(
    "shifted_owners", "taxpayers", OWNERS,
    """SELECT id, CASE WHEN taxpayer_3 IS NOT NULL THEN taxpayer_1 END AS taxpayer_1,
  CASE WHEN taxpayer_3 IS NULL THEN taxpayer_1 ELSE taxpayer_2 END AS taxpayer_2, coalesce(taxpayer_3, taxpayer_2) AS taxpayer_3 FROM x""",
)


@query
def poboxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.poboxes(derived(spark, sf_dir, "taxpayers").select("id", "tax_street", Q.is_pobox("tax_street").alias("is_pobox"))).select("id", "tax_street")


over("poboxes", f"SELECT id, tax_street FROM taxpayers WHERE regexp_matches(replace(tax_street, ' ', ''), '^({'|'.join(K.PO_BOXES)})')", "taxpayers")


@query
def whole_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaners that work on whole words, and one applied over several columns."""
    df = C.clean(derived(spark, sf_dir, "taxpayers"), C.make_upper, ["tax_name", "tax_street"])
    return df.select("id", C.core_name("tax_name").alias("core"), C.remove_secondary_component("tax_street").alias("street"), C.drop_letters("tax_street").alias("dropped"))


_CORE = "|".join(sorted(K.CORE_NAME_KEYS, key=lambda k: -len(k.split())))
_UNITS = "|".join(k for k in K.SECONDARY_KEYWORDS if k != "#")
_BARE = rf"regexp_replace(upper(tax_name) || ' ', '\b({_CORE}) ', ' ', 'g')"
over(
    "whole_words",
    rf"""SELECT id, {collapsed(_BARE)} AS core, trim(regexp_replace(upper(tax_street), '(#|\b({_UNITS})\b).*$', '')) AS street,
  regexp_replace(upper(tax_street), '(\d+)[A-Za-z]\b', '\1', 'g') AS dropped FROM taxpayers""",
    "taxpayers",
)


# Joins


@query
def landlord_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    corps = derived(spark, sf_dir, "corps")
    analysis = corps.select(F.col("raw_president_address").alias("address"), (F.col("file_number") % 3 == 0).alias("is_landlord_org"))
    frequent = corps.select(F.upper("raw_name").alias("value"), (F.col("file_number") % 2 == 0).alias("exclude_name"))
    df = derived(spark, sf_dir, "taxpayers").select("id", F.col("tax_street").alias("raw_address_v"), F.upper("tax_name").alias("clean_name"))
    return T.set_exclude_name(T.set_is_landlord_org(df, analysis), frequent).select("id", "is_landlord_org", "exclude_name")


over(
    "landlord_orgs",
    """SELECT id, tax_street IN (SELECT raw_president_address FROM corps WHERE file_number % 3 = 0) AS is_landlord_org,
  upper(tax_name) IN (SELECT upper(raw_name) FROM corps WHERE file_number % 2 = 0) AS exclude_name FROM taxpayers""",
    "taxpayers", "corps",
)


@query
def validated_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    corps = derived(spark, sf_dir, "corps").groupBy(F.col("raw_president_address").alias("clean_address")).agg(F.min("file_number").alias("n"))
    valid = corps.select("clean_address", *(F.concat("clean_address", F.lit(f" v{i} "), "n").alias(f"formatted_address_v{i}") for i in range(5)))
    return T.merge_validated_variants(derived(spark, sf_dir, "taxpayers").select("id", "tax_street"), valid, "tax_street")


over(
    "validated_variants",
    ", v AS (SELECT raw_president_address AS a, min(file_number) AS n FROM corps GROUP BY 1) SELECT id, tax_street, "
    + ", ".join(f"a || ' v{i} ' || n AS tax_street_v{i}" for i in range(5)) + " FROM taxpayers LEFT JOIN v ON a = tax_street",
    "taxpayers", "corps",
)


# Geocoding


@query
def geocode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is asked for each taxpayer's address, and the left side of the resolution."""
    df = derived(spark, sf_dir, "taxpayers").select(
        "id", F.concat("tax_street", F.lit(", "), "tax_city").alias("clean_address"), F.col("tax_street").alias("clean_street_1"), F.lit(None).cast("string").alias("clean_street_2"),
        F.col("tax_city").alias("clean_city"), F.col("tax_state").alias("clean_state"), F.when(F.col("id") % 3 > 0, F.col("tax_zip")).alias("clean_zip_code"), F.lit("USA").alias("clean_country"),
    )
    asked = geocode.requests(df).select("id", "request.*")
    sought = geocode.searched(df.withColumn("clean_address", F.col("id").cast("string"))).select(F.col("clean_address").cast("long").alias("id"), F.concat_ws("|", "street", "city", "state", "zip_code").alias("sought"))
    return asked.join(sought, "id")


over(
    "geocode_requests",
    """, t AS (SELECT *, CASE WHEN id % 3 > 0 THEN tax_zip END AS z FROM taxpayers)
SELECT id, CASE WHEN z IS NULL THEN tax_street || ', ' || tax_city END AS q, CASE WHEN z IS NOT NULL THEN tax_street END AS street, NULL::VARCHAR AS street2,
  CASE WHEN z IS NOT NULL THEN tax_city END AS city, CASE WHEN z IS NOT NULL THEN tax_state END AS state, z AS postal_code, CASE WHEN z IS NOT NULL THEN 'USA' END AS country,
  concat_ws('|', tax_street, tax_city, tax_state, z) AS sought FROM t""",
    "taxpayers",
)


@query
def geocode_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a geocoder, as it nests them, to one row for each candidate, all of them kept."""
    part = {"number": F.col("number"), "street": F.lit("MAIN"), "zip": F.col("zip_code")}
    components = F.struct(*(part.get(c, F.lit(None).cast("string")).alias(c) for c in geocode.COMPONENTS.values()))
    one = F.struct(
        components.alias("address_components"), "formatted_address", F.struct(F.col("candidate").cast("double").alias("lat"), F.lit(None).cast("double").alias("lng")).alias("location"),
        F.lit(1.0).alias("accuracy"), F.lit("rooftop").alias("accuracy_type"), F.lit("x").alias("source"),
    )
    rows = derived(spark, sf_dir, "candidates").groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct("candidate", one.alias("one")))).alias("all"))
    answers = rows.select("order_id", F.transform("all", lambda x: x["one"]).cast(geocode.RESULTS).alias("results"))
    return geocode.every_candidate(answers, ["order_id"]).select("order_id", "candidate", "number", "street", "suffix", "zip_code", "lat", "lng", "accuracy", "formatted_address")


over(
    "geocode_candidates",
    """SELECT order_id, (row_number() OVER (PARTITION BY order_id ORDER BY candidate, number, zip_code, formatted_address) - 1)::INT AS candidate, number, 'MAIN' AS street, '' AS suffix, zip_code, candidate || '.0' AS lat, '' AS lng,
  '1.0' AS accuracy, formatted_address FROM candidates""",
    "candidates",
)


# Matching


@query
def match_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = made(spark, sf_dir, "addresses", DOCS | {"unit_number": UNITS["unit_number"]})
    return df.select("id", M.is_match_street().alias("same_street"), M.is_match_zip().alias("same_zip"), M.is_match_secondary("unit_number").alias("same_unit"))


held(
    "match_tests", "addresses", DOCS | {"unit_number": UNITS["unit_number"]},
    f""", w AS (SELECT *, {words('original_doc')} AS a, {words('matched_doc')} AS b, {words("string_split(original_doc, ',')[1]")} AS s FROM x)
SELECT id, a[1] = b[1] AS same_street, a[-1] = b[-1] AS same_zip, CASE WHEN unit_number IS NOT NULL THEN list_contains(s, trim(unit_number)) END AS same_unit FROM w""",
)


@query
def match_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict where likeness decides: the number and the zip code agree, and the street does not."""
    df = M.set_match_verdict(made(spark, sf_dir, "addresses", VERDICT))
    return df.select("id", "is_match_number_street_zip", "is_match_number_zip", F.round("match_conf", 6).alias("match_conf"), "is_match")


_GRAMS = lambda e: sql_grams(f"replace({e}, ',', '')")
held(
    "match_confidence", "addresses", VERDICT,
    f""", v AS (SELECT id, coalesce(clean_address_v1, clean_address) AS a, formatted_address_prop AS b,
  number = CASE WHEN clean_address_v1 IS NULL THEN {words('clean_address')}[1] ELSE number_validated END AND zip_code = CASE WHEN clean_address_v1 IS NULL THEN {words('clean_address')}[-1] ELSE zip_code_validated END AS nz,
  street = CASE WHEN clean_address_v1 IS NULL THEN {words('clean_address')}[2] ELSE street_validated END AS s FROM x),
p AS (SELECT DISTINCT a, b FROM v WHERE nz AND NOT s AND b IS NOT NULL),
ga AS (SELECT a, b, g, count(*) AS n FROM (SELECT a, b, unnest({_GRAMS('a')}) AS g FROM p) GROUP BY ALL), gb AS (SELECT a, b, g, count(*) AS n FROM (SELECT a, b, unnest({_GRAMS('b')}) AS g FROM p) GROUP BY ALL),
c AS (SELECT a, b, sum(ga.n * coalesce(gb.n, 0)) / sqrt(sum(ga.n * ga.n) * sum(coalesce(gb.n, 0) * coalesce(gb.n, 0))) AS c FROM ga LEFT JOIN gb USING (a, b, g) GROUP BY a, b),
k AS (SELECT a, b, CASE WHEN a <> b AND c > 0 AND c < 1 - 1e-9 THEN c END AS c FROM c)
SELECT id, nz AND s AS is_match_number_street_zip, CASE WHEN NOT (nz AND s) THEN nz END AS is_match_number_zip,
  CASE WHEN nz AND NOT s THEN round(c, 6) END AS match_conf, (nz AND s) OR coalesce(nz AND NOT s AND c > 0.9, false) AS is_match FROM v LEFT JOIN k USING (a, b)""",
)


# Networks


@query
def network_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = network.taxpayer_edges(derived(spark, sf_dir, "records"), PARAMS)
    return network.network_text(network.components(edges), edges)


over(
    "network_texts",
    EDGES + PARTS + f""", e AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst),
k AS (SELECT component, a, b, (row_number() OVER (PARTITION BY component ORDER BY a, b) - 1) // {network.CHUNK} AS chunk FROM e JOIN parts ON parts.node = e.a),
s AS (SELECT component, chunk, to_json(list([a, b] ORDER BY a, b))::VARCHAR AS network_text FROM k GROUP BY ALL),
l AS (SELECT component, min(node) AS node FROM parts GROUP BY component)
SELECT component, coalesce(chunk, 0)::BIGINT AS chunk, coalesce(network_text, to_json([node])::VARCHAR) AS network_text FROM l LEFT JOIN s USING (component)""",
    "records", recursive=True,
)


# Sources


@query
def stored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written and read back by every reader and writer: how many rows and values come back from each."""
    root = fresh_path(spark, "datasets")
    llcs = derived(spark, sf_dir, "llcs").select(
        F.col("brand").alias("code"), F.col("kind").alias("category"), F.col("raw_name").alias("description"), (F.col("file_number") % 3 == 0).alias("is_rental")
    )
    flags = contracts.CLASS_CODES.schema
    assert contracts.CLASS_CODES.boolean_fields() == ["is_rental"]
    for kind in ("csv", "json", "parquet"):
        tables.save(llcs, f"{root}/{kind}", kind)
    back = {kind: tables.load(spark, f"{root}/{kind}", kind, flags) for kind in ("csv", "json", "parquet")}
    tables.write_dataset(llcs, root, "raw", "class_codes")
    back["catalog"] = tables.read_dataset(spark, root, "raw", "class_codes", flags)
    back["store"] = tables.retrieve(spark, root, tables.store(llcs, root, "frame").rsplit("/", 1)[-1])
    for batch in ("a", "b"):
        tables.save_partial(llcs, f"{root}/partials", batch)
    back["partials"] = tables.load(spark, f"{root}/partials", contract=flags)
    assert tables.load(spark, f"{root}/none") is None
    rows = [
        df.select(F.lit(name).alias("source"), "code", "description", F.col("is_rental").cast("int").alias("rental"))
        for name, df in back.items()
    ]
    return tables.union_all(rows).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count("code").alias("codes"), F.count_distinct("code").alias("kinds"), F.sum("rental").alias("rentals"), F.min("description").alias("least"), F.max("description").alias("most")
    )


over(
    "stored_tables",
    """SELECT s.source, count(*) AS n, count(brand) AS codes, count(DISTINCT brand) AS kinds, sum((file_number % 3 = 0)::INT)::BIGINT AS rentals, min(raw_name) AS least, max(raw_name) AS most
FROM llcs, (VALUES ('csv'), ('json'), ('parquet'), ('catalog'), ('store'), ('partials'), ('partials')) s(source) GROUP BY s.source""",
    "llcs",
)


@query
def violation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken rules of a workflow's tables, written as its report and read back."""
    root = fresh_path(spark, "reports")
    codes = derived(spark, sf_dir, "llcs").select(F.col("brand").alias("code"), F.col("kind").alias("category"), F.col("raw_name").alias("description"), F.lit(True).alias("is_rental"))
    props = derived(spark, sf_dir, "properties").select(F.col("owner").alias("pin"), F.lit(None).cast("string").alias("raw_name_address"), F.lit("x").alias("clean_name_address"), "class_code", "num_units")
    found = [contracts.violations(codes, contracts.CLASS_CODES), contracts.violations(props, contracts.PROPERTIES)]
    path = contracts.write_report(found, root, "load", "20240101T000000")
    assert path.endswith("/schema/validation_errors/load__20240101T000000")
    return spark.read.parquet(path)


over(
    "violation_report",
    """SELECT 'class_codes' AS dataset, 'code' AS "column", 'not_null' AS rule, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM llcs WHERE brand IS NULL HAVING count(*) > 0
UNION ALL SELECT 'class_codes', 'code', 'unique', brand, count(*) FROM llcs WHERE brand IS NOT NULL GROUP BY brand HAVING count(*) > 1
UNION ALL SELECT 'properties', 'pin', 'unique', '' || owner, count(*) FROM properties GROUP BY owner HAVING count(*) > 1""",
    "llcs", "properties",
)
