"""DuckDB SQL for the registered queries, written from the rules and not from the Spark code."""

from __future__ import annotations

from deedweb.functions import constants as K
from deedweb.plans.inputs import derived_sql

ORACLE_SQL: dict[str, str] = {}


def over(name: str, body: str, *inputs: str, recursive: bool = False) -> None:
    ORACLE_SQL[name] = f"WITH {'RECURSIVE ' if recursive else ''}{derived_sql(*inputs)} {body}" if inputs else body


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def mapped(key: str, values: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in values.items()) + f" ELSE {key} END"


def words(e: str) -> str:
    return rf"list_filter(regexp_split_to_array({e}, '\s+'), lambda w: w <> '')"


def sql_punct(e: str) -> str:
    return f"translate(replace({e}, '&', ' AND '), {quoted(K.PUNCTUATION)}, '{' ' * len(K.PUNCTUATION)}')"


def sql_core(e: str) -> str:
    text = f"{e} || ' '"
    for key in K.CORE_NAME_KEYS:
        text = f"replace({text}, '{key} ', '')"
    return f"trim({text})"


def collapsed(e: str) -> str:
    return rf"regexp_replace(trim({e}), '\s+', ' ', 'g')"


POBOX = "^(" + "|".join(K.PO_BOXES) + ")"
STATES = listed([*K.STATES, *K.STATES.values()])
NUMBER = r"'^[+-]?\d+$'"
INT = r"'^\s*[+-]?\d+\s*$'"

# Cleaning

over("clean_upper_punct", f"SELECT id, {sql_punct('upper(tax_name)')} AS name, {sql_punct('tax_street')} AS street FROM taxpayers", "taxpayers")
over(
    "clean_spaces",
    f"SELECT id, replace(regexp_replace({collapsed('upper(tax_name)')}, '^-+|-+$', '', 'g'), 'L L C', 'LLC') AS name, CAST(NULL AS VARCHAR) AS none FROM taxpayers",
    "taxpayers",
)
over("dedup_words", f"SELECT id, array_to_string(list_filter({words('upper(tax_name)')}, lambda w, i: list_position({words('upper(tax_name)')}, w) = i), ' ') AS name FROM taxpayers", "taxpayers")
over("switch_the", "SELECT id, CASE WHEN tax_name LIKE '% THE' THEN 'THE ' || left(tax_name, length(tax_name) - 4) ELSE tax_name END AS name FROM taxpayers", "taxpayers")
over(
    "take_first",
    r"SELECT id, CASE WHEN regexp_matches(tax_street, '\d+-\d+') THEN regexp_extract(tax_street, '(\d+)-\d+', 1) || regexp_replace(tax_street, '\d+-\d+', '', 'g') ELSE tax_street END AS street FROM taxpayers",
    "taxpayers",
)
over(
    "combine_numbers",
    rf""", w AS (SELECT id, unnest({words('tax_street')}) AS w, generate_subscripts({words('tax_street')}, 1) AS i FROM taxpayers),
n AS (SELECT *, regexp_matches(w, {NUMBER}) AS num, i - row_number() OVER (PARTITION BY id, regexp_matches(w, {NUMBER}) ORDER BY i) AS run FROM w),
g AS (SELECT id, min(i) AS i, CASE WHEN count(*) >= 3 AND ends_with(arg_min(w, i), '0')
  THEN left(arg_min(w, i), length(arg_min(w, i)) - 1) || substring(string_agg(w, '' ORDER BY i), length(arg_min(w, i)) + 1) ELSE string_agg(w, '' ORDER BY i) END AS w
  FROM n WHERE num GROUP BY id, run UNION ALL SELECT id, i, w FROM n WHERE NOT num)
SELECT id, string_agg(w, ' ' ORDER BY i) AS street FROM g GROUP BY id""",
    "taxpayers",
)
over("street_suffix", f"SELECT id, array_to_string(list_transform({words('tax_street')}, lambda w: {mapped('w', K.STREET_SUFFIXES)}), ' ') AS street FROM taxpayers", "taxpayers")
over(
    "convert_nsew",
    f""", w AS (SELECT id, {words('tax_street')} AS ws FROM taxpayers), e AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
n AS (SELECT *, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2, lag(w) OVER o AS w0 FROM e WINDOW o AS (PARTITION BY id ORDER BY i))
SELECT id, string_agg(CASE WHEN coalesce(w0 IN ({', '.join(map(quoted, K.DIRECTIONS))}), false) THEN w
  WHEN w1 IN ({', '.join(map(quoted, K.DIRECTIONS))}) AND coalesce(w2, '') NOT IN ({', '.join(map(quoted, sorted(set(K.STREET_SUFFIXES.values()))))}) THEN w
  ELSE {mapped('w', K.DIRECTIONS)} END, ' ' ORDER BY i) AS street, arg_max({mapped('w', K.DIRECTIONAL_MAP)}, i) AS last FROM n GROUP BY id""",
    "taxpayers",
)
over(
    "fix_zip",
    rf"""SELECT id, CASE WHEN NOT regexp_matches(tax_zip, '^[0-9]+$') THEN '' WHEN length(tax_zip) = 9 THEN left(tax_zip, 5) || '-' || right(tax_zip, 4)
  WHEN length(tax_zip) > 5 THEN left(tax_zip, 5) ELSE lpad(tax_zip, 5, '0') END AS zip,
  NOT regexp_matches(tax_zip, '^([0-9]{{5}}|[0-9]{{9}}|[0-9]{{5}}-[0-9]{{4}})$') AS odd_zip, NOT list_contains({STATES}, tax_state) AS odd_state,
  {mapped('tax_state', K.STATES)} AS state, replace(replace(tax_city, 'MPLS', 'MINNEAPOLIS'), 'MNPLS', 'MINNEAPOLIS') AS city FROM taxpayers""",
    "taxpayers",
)
over(
    "secondary_component",
    rf""", w AS (SELECT id, tax_street AS s, {words('tax_street')} AS ws FROM taxpayers),
f AS (SELECT *, list_position(list_transform(ws, lambda x: x IN ({', '.join(map(quoted, K.SECONDARY_KEYWORDS))}) OR regexp_matches(x, '^#.')), true) AS p FROM w)
SELECT id, trim(regexp_replace(s, '(#|{'|'.join(K.SECONDARY_KEYWORDS[1:])}).*$', '')) AS street,
  CASE WHEN p IS NULL OR p = 0 OR (regexp_matches(ws[1], '^\d+$') AND ws[2] IN ({', '.join(map(quoted, K.SECONDARY_KEYWORDS))})) THEN s
  ELSE array_to_string(list_filter(list_transform(ws, lambda x, i: CASE WHEN i <> p THEN x WHEN regexp_matches(x, '^#.') THEN x[2:] END), lambda x: x IS NOT NULL), ' ') END AS kept,
  CASE WHEN regexp_matches(s, '\d[a-zA-Z]') THEN regexp_replace(s, '\d+[a-zA-Z]', regexp_extract(s, '(\d+)[a-zA-Z]', 1), 'g') ELSE s END AS dropped FROM f""",
    "taxpayers",
)
over("core_name", f"SELECT id, {sql_core('upper(tax_name)')} AS core FROM taxpayers", "taxpayers")
over(
    "fix_names",
    f"""SELECT id, CASE WHEN contains(tax_name, 'FIRST NATL') THEN {collapsed("replace(tax_name, 'FIRST NATL', 'FIRST NATIONAL BANK ')")}
  WHEN contains(tax_name, 'FIRST') THEN {collapsed("replace(tax_name, 'FIRST', 'FIRST BANK ')")} ELSE tax_name END AS name FROM taxpayers""",
    "taxpayers",
)
over(
    "number_words",
    """WITH n AS (SELECT c_custkey, c_custkey % 9 + 1 AS o, (c_custkey // 9) % 8 + 2 AS t, (c_custkey // 72) % 9 + 1 AS h FROM customer)
SELECT c_custkey, '' || (h * 100 + t * 10 + o) AS number, 'EAST ' || t || o || CASE o WHEN 1 THEN 'ST' WHEN 2 THEN 'ND' WHEN 3 THEN 'RD' ELSE 'TH' END || ' STREET' AS ordinal,
  h || ' ' || t || '0 MAIN ST' AS mixed FROM n""",
)
over(
    "value_tests",
    f"""SELECT pin, regexp_matches(num_units, {INT}) AS is_int, num_units::INT > 1 AS several, regexp_matches(class_code, '[\\x00-\\x1F]') AS odd,
  lower(num_units) IN ('true', '1', 't', 'yes') AS flag, list_has_any(list_transform(string_split(class_code, ','), lambda x: trim(x)), ['1', 'F']) AS rental FROM properties""",
    "properties",
)

# Classification

over(
    "name_flags",
    f""", n AS (SELECT id, upper(tax_name) AS n, {words('upper(tax_name)')} AS ws FROM taxpayers),
p AS (SELECT *, CASE WHEN len(ws) > 2 AND ws[-1] IN ('JR', 'SR') THEN ws[:-2] ELSE ws END AS own FROM n)
SELECT id, list_has_any(ws, {listed(K.ORG_WORDS)}) AS is_org,
  list_has_any(ws, {listed(K.TRUSTS)}) OR regexp_matches(n, '{'|'.join(K.TRUSTS_STRINGS)}') AS is_trust,
  list_contains(ws, 'LLC') OR contains(right(n, 4), 'LLC') AS is_llc, contains(n, 'NATL') OR contains(n, 'CITY') AS is_bank,
  len(own) > 0 AND len(list_filter(own, lambda x: x NOT IN ('JOHN', 'MARY', 'JONES', 'SMITH'))) = 0 AS is_person FROM p""",
    "taxpayers",
)
over(
    "person_table",
    f""", names AS (SELECT DISTINCT w FROM (SELECT unnest(string_split(upper(raw_name), ' ')) AS w FROM corps) WHERE w NOT IN ('', 'CITY', 'OF')),
n AS (SELECT id, {words('upper(tax_name)')} AS ws FROM taxpayers),
p AS (SELECT id, unnest(CASE WHEN len(ws) > 2 AND ws[-1] IN ('JR', 'SR') THEN ws[:-2] ELSE ws END) AS w FROM n)
SELECT id, bool_and(w IN (SELECT w FROM names)) AS is_person FROM p GROUP BY id""",
    "taxpayers", "corps",
)
over(
    "address_tests",
    rf""", w AS (SELECT id, tax_street AS s, {words('tax_street')} AS ws FROM taxpayers)
SELECT id, regexp_matches(replace(s, ' ', ''), '{POBOX}') AS is_pobox,
  coalesce(regexp_matches(ws[-1], {INT}) AND ((ws[-2] IN ('HWY', 'HIGHWAY') AND ws[-3] || ' ' || ws[-2] <> 'DUPONT HWY')
    OR ws[-3] || ' ' || ws[-2] IN ('CO RD', 'COUNTY RD', 'STATE RD', 'ST RD')), false) AS is_road, true AS only_number,
  nullif(regexp_extract(trim(string_split(s, ',')[1]), '(\d+)$', 1), '') AS number FROM w""",
    "taxpayers",
)

# Addresses


def formatted(directionals: bool, prefix: bool, number: bool) -> str:
    at = lambda c: f"nullif(trim({c}), '')"
    names = ["number", *(["predirectional"] if directionals else []), "prefix", "street", "suffix", *(["postdirectional"] if directionals else [])]
    line = f"CASE WHEN upper(street) = 'PO BOX' THEN concat_ws(' ', 'PO BOX', {at('number')}) ELSE concat_ws(' ', {', '.join(map(at, names))}) END"
    unit = f"CASE WHEN {at('secondary_number')} IS NOT NULL THEN concat_ws(' ', {at('secondary_unit') + ', ' if prefix else ''}{at('secondary_number')}) END"
    return f"concat_ws(', ', {line}, {unit if number else 'NULL'}, {at('city')}, concat_ws(' ', {at('state')}, {at('zip_code')}))"


VARIANTS = {"v0": (True, True, True), "v1": (True, False, True), "v2": (True, False, False), "v3": (False, False, True), "v4": (False, False, False)}
over("format_address", "SELECT id, " + ", ".join(f"{formatted(*v)} AS formatted_address_{k}" for k, v in VARIANTS.items()) + " FROM addresses", "addresses")
_REMOVED = "regexp_replace(replace(tax_street, ' ', ''), '" + POBOX + "', '')"
for _key in K.PO_BOXES_REMOVE:
    _REMOVED = f"replace({_REMOVED}, '{_key}', '')"
over(
    "fix_pobox",
    f""", b AS (SELECT id, tax_street || ', ' || tax_city AS a, regexp_matches(replace(tax_street, ' ', ''), '{POBOX}') AS box, {_REMOVED} AS n, tax_city FROM taxpayers)
SELECT id, CASE WHEN NOT box THEN a WHEN contains(n, 'TAXDEPT')
  THEN 'PO BOX ' || string_split(n, 'TAXDEPT')[1] || ' TAX DEPT ' || regexp_replace(string_split(n, 'TAXDEPT')[2], '[^0-9]', '', 'g') || ', ' || tax_city
  ELSE 'PO BOX ' || n || ', ' || tax_city END AS address FROM b""",
    "taxpayers",
)
over(
    "city_state_zip",
    f""", w AS (SELECT id, {words('city_state_zip')} AS ws FROM taxpayers),
g AS (SELECT *, regexp_matches(ws[-1], '^([0-9]{{5}}|[0-9]{{9}}|[0-9]{{5}}-[0-9]{{4}})$') AND list_contains({STATES}, ws[-2]) AS good FROM w)
SELECT id, CASE WHEN good THEN array_to_string(ws[:-3], ' ') END AS clean_city, CASE WHEN good THEN ws[-2] END AS clean_state, CASE WHEN good THEN ws[-1] END AS clean_zip_code FROM g""",
    "taxpayers",
)
over(
    "full_address",
    """, a AS (SELECT id, tax_name, tax_street || ', ' || tax_city || ', ' || tax_state || ' ' || tax_zip AS raw_address,
  tax_street || ', ' || tax_city || ', ' || tax_state || ', ' || tax_zip AS llc_address FROM taxpayers)
SELECT id, raw_address, llc_address, tax_name || ' -- ' || raw_address AS name_address, tax_name || ' - ' || raw_address AS document FROM a""",
    "taxpayers",
)

# Joins

over(
    "merge_orgs",
    f""", t AS (SELECT id, {collapsed('upper(tax_name)')} AS clean_name FROM taxpayers),
c AS (SELECT {collapsed('upper(raw_name)')} AS clean_name, min(file_number) AS file_number, arg_min(coalesce(status, '-'), file_number) AS status FROM corps GROUP BY 1)
SELECT t.id, t.clean_name, {sql_core('t.clean_name')} AS core_name, c.file_number, nullif(c.status, '-') AS status FROM t LEFT JOIN c USING (clean_name)""",
    "taxpayers", "corps",
)
over(
    "merge_orgs_by_core",
    f""", t AS (SELECT id, {collapsed('upper(tax_name)')} AS clean_name FROM taxpayers),
c AS (SELECT {sql_core(collapsed('upper(raw_name)'))} AS core_name, min(file_number) AS file_number, arg_min(coalesce(status, '-'), file_number) AS status FROM corps GROUP BY 1)
SELECT t.id, t.clean_name, t.core_name, c.file_number, nullif(c.status, '-') AS status FROM (SELECT *, {sql_core('clean_name')} AS core_name FROM t) t LEFT JOIN c USING (core_name)""",
    "taxpayers", "corps",
)
over("published_masters", "SELECT 'corp' AS kind, file_number, raw_name FROM corps UNION ALL SELECT 'llc', file_number, raw_name FROM llcs", "corps", "llcs")
over(
    "quarantined",
    """SELECT reason, count(*) AS n, sum(CASE WHEN reason = 'good' THEN pin END)::BIGINT AS pins
FROM (SELECT pin, CASE WHEN pin % 7 = 0 OR pin % 11 = 0 THEN 'malformed' WHEN pin % 5 = 0 THEN 'missing: owner' ELSE 'good' END AS reason FROM properties) GROUP BY reason""",
    "properties",
)
over(
    "bank_table",
    f""", p AS (SELECT DISTINCT substring(upper(raw_name), 2, 6) AS phrase FROM corps), n AS (SELECT DISTINCT upper(tax_name) AS name FROM taxpayers),
b AS (SELECT name, arg_min(phrase, row(-length(phrase), phrase)) AS phrase FROM n JOIN p ON contains(name, phrase) AND phrase <> '' GROUP BY name)
SELECT id, phrase IS NOT NULL AS is_bank, CASE WHEN phrase IS NULL THEN upper(tax_name) ELSE array_to_string({words("replace(upper(tax_name), phrase, '<' || phrase || '> ')")}, ' ') END AS name
FROM taxpayers LEFT JOIN b ON b.name = upper(tax_name)""",
    "taxpayers", "corps",
)
over(
    "org_table",
    f""", w AS (SELECT DISTINCT string_split(upper(raw_name), ' ')[-1] AS word FROM corps)
SELECT id, coalesce(list_has_any({words('upper(tax_name)')}, (SELECT list(word) FROM w)), false) AS is_org FROM taxpayers""",
    "taxpayers", "corps",
)
over(
    "merge_proptax",
    f"""SELECT p.pin, 'owner ' || p.owner AS raw_name_address, p.num_units, a.street, a.city, t.tax_street AS clean_address,
  CASE WHEN NOT regexp_matches(replace(t.tax_street, ' ', ''), '{POBOX}') THEN t.tax_street || ' OK' END AS formatted_address
FROM properties p LEFT JOIN addresses a ON a.id = p.pin LEFT JOIN taxpayers t ON t.id = p.owner""",
    "properties", "addresses", "taxpayers",
)
over(
    "rental_flags",
    """, f AS (SELECT pin, owner, num_units, list_has_any(string_split(class_code, ', '), ['1', 'F']) AS first FROM properties)
SELECT pin, first, first OR owner IN (SELECT owner FROM f WHERE num_units = '3') AS is_rental FROM f""",
    "properties",
)
over(
    "address_flags",
    """, r AS (SELECT raw_president_address AS a, bool_or(file_number % 2 = 0) AS e, bool_or(file_number % 3 = 0) AS o, bool_or(file_number % 5 = 0) AS m, bool_or(file_number % 7 = 0) AS r FROM corps GROUP BY 1)
SELECT t.id, coalesce(e, false) AS exclude_address_t, coalesce(o, false) AS is_org_address_t, coalesce(m, false) AS is_missing_suite_t, false AS is_problem_suite_t,
  coalesce(r, false) AS is_realtor_t, a IS NOT NULL AS is_researched_t FROM taxpayers t LEFT JOIN r ON t.tax_street = r.a""",
    "taxpayers", "corps",
)
over(
    "nonrentals",
    """, r AS (SELECT owner, class_code FROM properties WHERE num_units = '1')
SELECT pin, '' || owner AS raw_name_address FROM properties WHERE owner NOT IN (SELECT owner FROM r) AND class_code IN (SELECT class_code FROM r)""",
    "properties",
)
over("remove_validated", "SELECT id, tax_street FROM taxpayers WHERE tax_street NOT IN (SELECT raw_president_address FROM corps)", "taxpayers", "corps")

# Aggregation

over("frequency", "SELECT brand AS value, count(*) AS frequency FROM llcs WHERE brand IS NOT NULL GROUP BY 1", "llcs")
over("duplicates", "SELECT file_number, count(*) OVER (PARTITION BY raw_name) > 1 AS again FROM llcs", "llcs")
over(
    "merge_duplicates",
    """SELECT min(file_number) AS file_number, raw_name, coalesce(max(CASE WHEN status = '0' THEN '0' END), max(CASE WHEN status = '1' THEN '1' END),
  arg_min(status, file_number) FILTER (WHERE status IS NOT NULL)) AS status, arg_min(brand, file_number) FILTER (WHERE brand IS NOT NULL) AS brand,
  arg_min(raw_agent_address, file_number) FILTER (WHERE raw_agent_address IS NOT NULL) AS raw_agent_address FROM llcs GROUP BY raw_name""",
    "llcs",
)
ORACLE_SQL["merged_deliveries"] = ORACLE_SQL["merge_duplicates"]
over(
    "keep_first",
    """, f AS (SELECT file_number, raw_name, status, brand, row_number() OVER (PARTITION BY raw_name, brand ORDER BY file_number) AS r FROM llcs)
SELECT file_number, raw_name, status, brand FROM f WHERE r = 1 AND status IN ('0', '1')""",
    "llcs",
)
over("split_tables", "SELECT '' || owner AS raw_name_address, count(*) AS n, arg_min(class_code, pin) AS class_code FROM properties GROUP BY owner", "properties")
over(
    "union_addresses",
    """, u AS (SELECT tax_street AS raw_address, tax_city AS raw_city, 'taxpayers' AS origin, 'taxpayer' AS addr_type, 0 AS s FROM taxpayers
  UNION ALL SELECT raw_president_address, NULL, 'corps', 'president', 1 FROM corps UNION ALL SELECT raw_secretary_address, NULL, 'corps', 'secretary', 2 FROM corps
  UNION ALL SELECT raw_office_address, NULL, 'llcs', 'office', 3 FROM llcs),
f AS (SELECT *, row_number() OVER (PARTITION BY raw_address ORDER BY s, raw_city) AS r FROM u WHERE raw_address IS NOT NULL)
SELECT raw_address, raw_city, origin, addr_type FROM f WHERE r = 1""",
    "taxpayers", "corps", "llcs",
)


def _entity(table: str, origin: str, addresses: list[str]) -> str:
    cols = []
    for i in (1, 2, 3):
        a = addresses[i - 1] if i <= len(addresses) else "CAST(NULL AS VARCHAR)"
        cols.append(f"{a} AS entity_address_{i}, CASE WHEN {a} IN (SELECT tax_street FROM taxpayers) THEN {a} || ', OK' END AS entity_address_{i}_v, "
                    f"CASE WHEN {a} IN (SELECT tax_street FROM taxpayers) THEN {a} || ', OK' ELSE {a} END AS match_address_e{i}")  # fmt: skip
    name = collapsed("upper(raw_name)")
    return f"SELECT '{origin}' AS origin, {name} AS entity_clean_name, {sql_core(name)} AS entity_core_name, {', '.join(cols)} FROM {table}"


over(
    "combine_entities",
    _entity("corps", "corp", ["raw_president_address", "raw_secretary_address"]) + " UNION ALL " + _entity("llcs", "llc", ["raw_office_address", "raw_manager_member_address", "raw_agent_address"]),
    "taxpayers", "corps", "llcs",
)

# Geocoding

RESOLVE = """, c AS (SELECT *, number <> '' AS h1, number = (order_id % 4 + 1)::VARCHAR AS h2, number = (order_id % 4 + 1)::VARCHAR AND zip_code = (60600 + order_id % 3)::VARCHAR AS h3 FROM candidates),
k AS (SELECT *, {levels} FROM c WINDOW g AS (PARTITION BY order_id)),
s AS (SELECT *, CASE WHEN n1 = 0 THEN true WHEN n1 = 1 OR d1 = 1 THEN candidate = f1 WHEN n2 = 0 THEN true WHEN n2 = 1 OR d2 = 1 THEN candidate = f2
  WHEN n3 = 0 THEN h2 WHEN n3 = 1 OR d3 = 1 THEN candidate = f3 ELSE h3 END AS stays FROM k)""".replace(
    "{levels}",
    ", ".join(f"count(*) FILTER (WHERE h{i}) OVER g AS n{i}, count(DISTINCT formatted_address) FILTER (WHERE h{i}) OVER g AS d{i}, min(candidate) FILTER (WHERE h{i}) OVER g AS f{i}" for i in (1, 2, 3)),
)
over("geocode_resolve", RESOLVE + " SELECT order_id, candidate, number, zip_code, formatted_address FROM s WHERE stays", "candidates")
over(
    "geocode_split",
    """, v AS (SELECT * FROM candidates WHERE number <> ''),
c AS (SELECT *, true AS h1, number = order_id::VARCHAR AS h2, number = order_id::VARCHAR AND zip_code = order_id::VARCHAR AS h3 FROM v),
k AS (SELECT *, LEVELS FROM c WINDOW g AS (PARTITION BY order_id)),
s AS (SELECT *, CASE WHEN n1 = 1 OR d1 = 1 THEN candidate = f1 WHEN n2 = 0 THEN true WHEN n2 = 1 OR d2 = 1 THEN candidate = f2
  WHEN n3 = 0 THEN h2 WHEN n3 = 1 OR d3 = 1 THEN candidate = f3 ELSE h3 END AS stays FROM k),
n AS (SELECT order_id, count(*) AS n FROM s WHERE stays GROUP BY 1)
SELECT 'validated' AS part, count(*) FILTER (WHERE n = 1) AS addresses, NULL::DOUBLE AS cost FROM n
UNION ALL SELECT 'unvalidated', count(*) FILTER (WHERE n > 1), NULL FROM n
UNION ALL SELECT 'failed', count(*), NULL FROM properties WHERE pin NOT IN (SELECT order_id FROM n)
UNION ALL SELECT 'asked', count(*), round(greatest(count(*) - 2500, 0) * 0.0005, 4) FROM properties""".replace(
        "LEVELS",
        ", ".join(f"count(*) FILTER (WHERE h{i}) OVER g AS n{i}, count(DISTINCT formatted_address) FILTER (WHERE h{i}) OVER g AS d{i}, min(candidate) FILTER (WHERE h{i}) OVER g AS f{i}" for i in (1, 2, 3)),
    ),
    "candidates", "properties",
)

over(
    "settled_answers",
    ", lines AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY first, number, zip_code, formatted_address) - 1 AS candidate"
    " FROM (SELECT order_id, number, zip_code, formatted_address, min(candidate) AS first FROM candidates GROUP BY ALL))"
    + RESOLVE.replace("FROM candidates)", "FROM lines)")
    + """, z AS (SELECT *, count(*) OVER (PARTITION BY order_id) AS n, (order_id % 4 + 1) || ' MAIN ST ' || order_id || ', CHICAGO, IL ' || (60600 + order_id % 3) AS clean_address FROM s WHERE stays)
SELECT CASE WHEN n = 1 THEN 'validated' ELSE 'unvalidated' END AS part, clean_address, candidate, number, zip_code, formatted_address FROM z
UNION ALL SELECT 'failed', (pin % 4 + 1) || ' MAIN ST ' || pin || ', CHICAGO, IL ' || (60600 + pin % 3), NULL, NULL, NULL, NULL FROM properties WHERE pin NOT IN (SELECT order_id FROM candidates)""",
    "candidates", "properties",
)

# Matching


def sql_title(e: str) -> str:
    return f"' ' || array_to_string(list_transform(string_split(lower({e}), ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' '"


def sql_grams(e: str) -> str:
    return f"list_transform(range(1, length({sql_title(e)}) - 1), lambda i: substring({sql_title(e)}, i, 3))"


over("name_ngrams", f"SELECT p_partkey, array_to_string({sql_grams('p_name')}, '|') AS grams FROM part")
def sql_scores(weight: str) -> str:
    """``r``: the cosine of all pairs of owners' documents, ranked; ``weight`` is what a document counts for."""
    return f""", docs AS (SELECT doc AS d, replace(doc, ' - ', ' ') AS t, {weight}::DOUBLE AS n FROM owners GROUP BY doc),
g AS (SELECT d, n, gram, count(*) AS tf FROM (SELECT d, n, unnest({sql_grams('t')}) AS gram FROM docs) GROUP BY ALL),
idf AS (SELECT gram, ln((1 + (SELECT sum(n) FROM docs)) / (1 + sum(n))) + 1 AS idf FROM g GROUP BY gram),
w AS (SELECT d, gram, tf * idf AS w FROM g JOIN idf USING (gram)), u AS (SELECT d, gram, w / sqrt(sum(w * w) OVER (PARTITION BY d)) AS w FROM w),
s AS (SELECT a.d AS original_doc, b.d AS matched_doc, sum(a.w * b.w) AS c FROM u a JOIN u b USING (gram) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY original_doc ORDER BY round(c, 12) DESC, matched_doc) AS k FROM s)"""


over(
    "tfidf_match",
    sql_scores("1") + """ SELECT original_doc, matched_doc, round(c, 6) AS conf1, round(1 - c, 6) AS conf, levenshtein(original_doc, matched_doc)::INT AS ldist
FROM r WHERE k <= 4 AND c > 0.75 AND c < 1 - 1e-9""",
    "owners",
)
over("tfidf_nearest", sql_scores("count(*)") + " SELECT original_doc, matched_doc, round(c, 6) AS conf1, levenshtein(original_doc, matched_doc)::INT AS ldist FROM r WHERE k <= 3", "owners")
over(
    "saved_matcher",
    f""", docs AS (SELECT DISTINCT doc AS d, replace(doc, ' - ', ' ') AS t FROM owners),
later AS (SELECT DISTINCT regexp_replace(doc, ' ST$', ' STREET') AS d, regexp_replace(replace(doc, ' - ', ' '), ' ST$', ' STREET') AS t FROM owners),
g AS (SELECT d, gram, count(*) AS tf FROM (SELECT d, unnest({sql_grams('t')}) AS gram FROM docs) GROUP BY ALL),
h AS (SELECT d, gram, count(*) AS tf FROM (SELECT d, unnest({sql_grams('t')}) AS gram FROM later) GROUP BY ALL),
idf AS (SELECT gram, ln((1 + (SELECT count(*) FROM docs)) / (1 + count(*))) + 1 AS idf FROM g GROUP BY gram),
u AS (SELECT d, gram, w / sqrt(sum(w * w) OVER (PARTITION BY d)) AS w FROM (SELECT d, gram, tf * idf AS w FROM g JOIN idf USING (gram))),
v AS (SELECT d, gram, w / sqrt(sum(w * w) OVER (PARTITION BY d)) AS w FROM (SELECT d, gram, tf * idf AS w FROM h JOIN idf USING (gram))),
s AS (SELECT v.d AS original_doc, u.d AS matched_doc, sum(v.w * u.w) AS c FROM v JOIN u USING (gram) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY original_doc ORDER BY round(c, 12) DESC, matched_doc) AS k FROM s)
SELECT original_doc, matched_doc, round(c, 6) AS conf1, levenshtein(original_doc, matched_doc)::INT AS ldist
FROM r WHERE k <= 2 AND c > 0.6 AND c < 1 - 1e-9 AND original_doc <> matched_doc""",
    "owners",
)
GROUPS = sql_scores("1") + """, m AS (SELECT original_doc AS a, matched_doc AS b FROM r WHERE k <= 3 AND c > 0.75 AND c < 1 - 1e-9),
e AS (SELECT a, b FROM m UNION SELECT b, a FROM m), t(node, label) AS (SELECT a, a FROM e UNION SELECT e.b, t.label FROM t JOIN e ON e.a = t.node),
p AS (SELECT node, min(label) AS component FROM t GROUP BY node),
o AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY length(node), node) AS k FROM p),
n AS (SELECT component, arg_min(node, k) AS fuzzy_match_name, string_agg(trim(string_split(node, '-')[1]), ' -- ' ORDER BY k) || ' -- ' || component AS fuzzy_match_combo FROM o WHERE k <= 3 GROUP BY component)"""
over("match_groups", GROUPS + " SELECT node, component, fuzzy_match_name, fuzzy_match_combo FROM p JOIN n USING (component)", "owners", recursive=True)
over(
    "matches_with_groups",
    GROUPS + " SELECT a AS original_doc, b AS matched_doc, fuzzy_match_name, fuzzy_match_combo FROM m JOIN p ON p.node = m.a JOIN n USING (component)",
    "owners", recursive=True,
)
over(
    "pair_similarity",
    f"""WITH d AS (SELECT p_partkey, p_name AS a, string_split(p_name, ' ')[2] || ' ' || lower(p_type) AS b FROM part),
ga AS (SELECT p_partkey, g, count(*) AS n FROM (SELECT p_partkey, unnest({sql_grams('a')}) AS g FROM d) GROUP BY ALL),
gb AS (SELECT p_partkey, g, count(*) AS n FROM (SELECT p_partkey, unnest({sql_grams('b')}) AS g FROM d) GROUP BY ALL),
j AS (SELECT p_partkey, coalesce(ga.n, 0) AS x, coalesce(gb.n, 0) AS y FROM ga FULL JOIN gb USING (p_partkey, g)),
s AS (SELECT p_partkey, sum(x * y) AS xy, sum(x * x) AS xx, sum(y * y) AS yy, sum(y * y) FILTER (WHERE x > 0) AS yx FROM j GROUP BY p_partkey)
SELECT p_partkey, CASE WHEN yx > 0 AND xy / sqrt(xx * yx) > 0.1 AND xy / sqrt(xx * yx) < 1 - 1e-9 THEN round(xy / sqrt(xx * yx), 6) END AS one_way,
  round(xy / sqrt(xx * yy), 6) AS both_ways FROM s""",
)
over(
    "match_verdict",
    """, v AS (SELECT id, number = CASE WHEN id % 3 = 0 THEN '' || (id % 300) ELSE '' || (id % 40 * 7) END AS n, street = 'MAIN' AS s,
  zip_code = CASE WHEN id % 3 = 0 THEN '' || (60600 + id % 30) ELSE '' || (60600 + id % 5) END AS z FROM addresses)
SELECT id, n AND s AND z AS is_match_number_street_zip, CASE WHEN NOT (n AND s AND z) THEN n AND z END AS is_match_number_zip, n AND s AND z AS is_match FROM v""",
    "addresses",
)

# Networks

EDGES = """, f AS (SELECT *, CASE WHEN NOT exclude_name THEN clean_name END AS n,
  CASE WHEN match_address_t <> '' AND is_validated_t AND NOT exclude_address_t AND is_researched_t AND NOT is_org_address_t THEN match_address_t END AS a,
  CASE WHEN entity_clean_name IS NOT NULL AND clean_name NOT IN ('CHICAGO TITLE LAND TRUST COMPANY', 'CHICAGO TITLE LAND') THEN clean_name END AS ent FROM records),
x AS (SELECT n AS p, a AS q FROM f UNION ALL SELECT n, match_name FROM f WHERE n IS NOT NULL AND match_name IS NOT NULL
  UNION ALL SELECT a, match_name FROM f WHERE a IS NOT NULL AND match_name IS NOT NULL""" + "".join(
    f"\n  UNION ALL SELECT ent, match_address_e{i} FROM f WHERE ent IS NOT NULL AND match_address_e{i} <> '' AND is_validated_e{i} AND NOT exclude_address_e{i} AND is_researched_e{i} AND NOT is_org_address_e{i}"
    for i in (1, 2, 3)
) + "),\nedges AS (SELECT DISTINCT coalesce(p, q) AS src, coalesce(q, p) AS dst FROM x WHERE p IS NOT NULL OR q IS NOT NULL)"
PARTS = """, both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
reach(node, label) AS (SELECT src, src FROM both_ways UNION SELECT b.dst, r.label FROM reach r JOIN both_ways b ON b.src = r.node WHERE r.label < b.dst),
parts AS (SELECT node, min(label) AS component FROM reach GROUP BY node)"""
over("network_edges", EDGES + " SELECT src, dst FROM edges", "records")
over(
    "network_components",
    EDGES + PARTS + " SELECT node, component, dense_rank() OVER (ORDER BY component) - 1 AS component_id FROM parts",
    "records", recursive=True,
)
ORACLE_SQL["network_growth"] = ORACLE_SQL["network_components"]
over(
    "network_counts",
    EDGES + PARTS + """ SELECT (SELECT count(DISTINCT component) FROM parts) AS components, (SELECT count(*) FROM parts) AS nodes,
  (SELECT count(*) FROM (SELECT DISTINCT least(src, dst), greatest(src, dst) FROM edges WHERE src <> dst)) AS edges""",
    "records", recursive=True,
)
NAMED = EDGES + PARTS + """, k AS (SELECT rid, unnest([clean_name, match_address_t, match_name, match_address_e1, match_address_e2, match_address_e3]) AS key, unnest(range(6)) AS i FROM records),
c AS (SELECT rid, arg_min(component, i) AS final_component_1 FROM k JOIN parts ON parts.node = k.key GROUP BY rid),
t AS (SELECT r.rid, r.clean_name, c.final_component_1 FROM records r LEFT JOIN c USING (rid)),
o AS (SELECT final_component_1, clean_name, count(*) AS n FROM t WHERE final_component_1 IS NOT NULL GROUP BY ALL),
q AS (SELECT *, row_number() OVER (PARTITION BY final_component_1 ORDER BY n DESC, clean_name) AS r FROM o),
l AS (SELECT final_component_1, string_agg(clean_name, ' -- ' ORDER BY r) || ' -- ' || final_component_1 || ' -- (1)' AS network_1, arg_min(clean_name, r) || ' Etc.' AS network_1_short
  FROM q WHERE r <= 3 GROUP BY final_component_1)"""
over("landlord_networks", NAMED + " SELECT t.rid, t.clean_name, t.final_component_1, l.network_1, l.network_1_short FROM t LEFT JOIN l USING (final_component_1)", "records", recursive=True)
over(
    "networks_with_filings",
    """, t AS (SELECT rid, clean_name, match_address_t AS a, CASE WHEN NOT exclude_name AND clean_name <> 'UNKNOWN' THEN clean_name END AS n,
  CASE WHEN match_address_t <> '' AND is_validated_t AND is_researched_t AND NOT exclude_address_t AND rid % 10 > 0 AND rid % 12 > 0 AND NOT is_org_address_t THEN match_address_t END AS q,
  CASE WHEN rid % 3 = 0 THEN rid % 50 END AS uid FROM records),
f AS (SELECT file_number % 60 AS uid, (file_number % 400) || ' FILING RD' AS a, file_number % 3 > 0 AND file_number % 29 > 0 AS good FROM llcs),
edges AS (SELECT DISTINCT coalesce(n, q) AS src, coalesce(q, n) AS dst FROM t WHERE n IS NOT NULL OR q IS NOT NULL
  UNION SELECT DISTINCT t.clean_name, f.a FROM t JOIN f USING (uid) WHERE f.good)""" + PARTS + """,
own AS (SELECT rid, arg_min(component, i) AS c FROM (SELECT rid, unnest([clean_name, a]) AS key, unnest([0, 1]) AS i FROM t) k JOIN parts ON parts.node = k.key GROUP BY rid),
more AS (SELECT uid, arg_min(component, a) AS c FROM (SELECT DISTINCT uid, a FROM f) d JOIN parts ON parts.node = d.a GROUP BY uid)
SELECT t.rid, coalesce(own.c, more.c) AS final_component_1 FROM t LEFT JOIN own USING (rid) LEFT JOIN more USING (uid)""",
    "records", "llcs", recursive=True,
)

ORACLE_SQL["networks_with_filings_and_matches"] = (
    ORACLE_SQL["networks_with_filings"]
    .replace("match_address_t AS a,", "match_address_t AS a, match_name AS m,", 1)
    .replace("  UNION SELECT DISTINCT t.clean_name, f.a", "  UNION SELECT n, m FROM t WHERE n IS NOT NULL AND m IS NOT NULL UNION SELECT q, m FROM t WHERE q IS NOT NULL AND m IS NOT NULL\n  UNION SELECT DISTINCT t.clean_name, f.a")
    .replace("unnest([clean_name, a]) AS key, unnest([0, 1]) AS i", "unnest([clean_name, a, m]) AS key, unnest([0, 1, 2]) AS i")
)

# Statistics


def _missing(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{table}' AS dataset, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL OR {c}::VARCHAR = '') AS n_missing FROM {table}" for c in columns)


def _columns(name: str) -> list[str]:
    from deedweb.plans.inputs import DERIVED

    return list(DERIVED[name][1])


_THREE = ("taxpayers", "corps", "llcs")
over("null_profile", " UNION ALL ".join(_missing(n, _columns(n)) for n in _THREE), *_THREE)
over("load_table", " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS n_rows, {len(_columns(n))} AS n_columns FROM {n}" for n in _THREE), *_THREE)
_DISTINCT = "count(DISTINCT {0}) + coalesce(max(({0} IS NULL)::INT), 0)"
over(
    "clean_stats",
    " UNION ALL ".join(
        f"SELECT '{label}' AS stat, ({value})::BIGINT AS value FROM {table}"
        for label, value, table in (
            ("Unique Properties", _DISTINCT.format("pin"), "properties"),
            ("Unique Taxpayer Records", _DISTINCT.format("(tax_name || ' -- ' || tax_street)"), "taxpayers"),
            ("Unique Corporations (Raw)", _DISTINCT.format("raw_name"), "corps"),
            ("Unique Corporations (Clean)", _DISTINCT.format(collapsed("upper(raw_name)")), "corps"),
            ("Unique LLCs (Raw)", _DISTINCT.format("raw_name"), "llcs"),
            ("Unique LLCs (Clean)", _DISTINCT.format(collapsed("upper(raw_name)")), "llcs"),
            ("Unique Addresses (Unvalidated)", "count(*)", "taxpayers"),
            ("PO Box Addresses", f"count(*) FILTER (WHERE regexp_matches(replace(tax_street, ' ', ''), '{POBOX}'))", "taxpayers"),
        )
    ),
    "properties", "taxpayers", "corps", "llcs",
)
over(
    "merge_stats",
    f""", t AS (SELECT CASE WHEN id % 3 = 0 THEN 'corp' WHEN id % 7 = 0 THEN 'llc' END AS origin, list_contains({words('upper(tax_name)')}, 'LLC') OR contains(right(upper(tax_name), 4), 'LLC') AS is_llc,
  list_has_any({words('upper(tax_name)')}, {listed(K.ORG_WORDS)}) AS is_org FROM taxpayers)
SELECT 'Number of Linked Corporations in Taxpayer Records' AS stat, count(*) FILTER (WHERE origin = 'corp') AS value FROM t
UNION ALL SELECT 'Number of Linked LLCs in Taxpayer Records', count(*) FILTER (WHERE origin = 'llc') FROM t
UNION ALL SELECT 'Unlinked LLCs in Taxpayer Records', count(*) FILTER (WHERE origin IS NULL AND is_llc) FROM t
UNION ALL SELECT 'Unlinked Organizations in Taxpayer Records', count(*) FILTER (WHERE origin IS NULL AND is_org) FROM t
UNION ALL SELECT 'Unique Corporations Identified in Taxpayer Records', count(*) FROM corps UNION ALL SELECT 'Unique LLCs Identified in Taxpayer Records', count(*) FROM llcs""",
    "taxpayers", "corps", "llcs",
)
over(
    "geocode_stats",
    """, n AS (SELECT (SELECT count(DISTINCT tax_street) FROM taxpayers) AS t, (SELECT count(DISTINCT raw_agent_address) + max((raw_agent_address IS NULL)::INT) FROM llcs) AS l)
SELECT 'Validated addresses' AS stat, format('{:,} (+{:,})', t + l, l) AS value FROM n UNION ALL SELECT 'Unvalidated addresses', format('{:,} (+{:,})', t + l, t) FROM n""",
    "taxpayers", "llcs",
)
over(
    "match_stats",
    """SELECT 'string_matched_name_1' AS string_match_name, count(match_name) AS matched_taxpayers, count(DISTINCT match_name) AS unique_matches, round(count(match_name) * 100.0::DOUBLE / count(*), 2) AS percent_matched FROM records
UNION ALL SELECT 'string_matched_name_2', count(entity_clean_name), count(DISTINCT entity_clean_name), round(count(entity_clean_name) * 100.0::DOUBLE / count(*), 2) FROM records""",
    "records",
)


def _top(column: str, label: str) -> str:
    top = f"SELECT v FROM (SELECT {column} AS v, count(*) AS n FROM records WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 100)"
    return f"SELECT '{label}' AS network_name, count(*) - count({column}) AS taxpayers_missing_networks, count(DISTINCT {column}) AS unique_networks, count(*) FILTER (WHERE {column} IN ({top})) AS taxpayers_in_top FROM records"


over("network_stats", _top("nullif(match_address_t, '')", "network_1") + " UNION ALL " + _top("entity_clean_name", "network_2"), "records")
def _counted(source: str, table: str, column: str, value: str, batches: int) -> str:
    return (f"SELECT '{source}' AS source, '{column}' AS \"column\", {batches} AS n_batches, count(*) AS n_rows, count(*) FILTER (WHERE coalesce({value}::VARCHAR, '') = '')::BIGINT AS n_missing, "
            f"count(DISTINCT nullif({value}::VARCHAR, '')) AS n_distinct FROM {table}")  # fmt: skip


over(
    "merged_statistics",
    " UNION ALL ".join(
        [_counted("owners", "taxpayers", c, v, 3) for c, v in (("name", "upper(tax_name)"), ("tax_street", "tax_street"), ("tax_city", "tax_city"), ("tax_zip", "tax_zip"))]
        + [_counted("corps", "corps", c, v, 1) for c, v in (("name", "upper(raw_name)"), ("status", "status"))]
    ),
    "taxpayers", "corps",
)
over(
    "linked_statistics",
    """, a AS (SELECT DISTINCT upper(tax_name) AS v FROM taxpayers WHERE tax_name <> ''), b AS (SELECT DISTINCT upper(raw_name) AS v FROM corps WHERE raw_name <> '')
SELECT count(*) FILTER (WHERE a.v = b.v) AS n_linked, count(*) FILTER (WHERE b.v IS NULL) AS n_left_only, count(*) FILTER (WHERE a.v IS NULL) AS n_right_only
FROM a FULL JOIN b ON a.v = b.v""",
    "taxpayers", "corps",
)
over(
    "contract_violations",
    """SELECT 'class_codes' AS dataset, 'code' AS "column", 'not_null' AS rule, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM llcs WHERE brand IS NULL HAVING count(*) > 0
UNION ALL SELECT 'class_codes', 'is_rental', 'missing_column', NULL, 1
UNION ALL SELECT 'class_codes', 'code', 'unique', brand, count(*) FROM llcs WHERE brand IS NOT NULL GROUP BY brand HAVING count(*) > 1
UNION ALL SELECT 'class_codes', 'description', 'allowed', status, count(*) FROM llcs WHERE status NOT IN ('0', '1') GROUP BY status""",
    "llcs",
)
