"""Table, match, network, geocoding and statistics operators, sources and streams."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from deedweb.operators import geocode, network, stats
from deedweb.operators import match as M
from deedweb.operators import tables as T
from deedweb.operators.components import connected_components
from deedweb.sources import contracts, tables
from deedweb.streaming.resolve import as_parts, gathered, open_addresses, resolve_stream, settled, settled_tables


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


GRAPHS = {
    "random": [(random.Random(1).randrange(10**9) % 97 + i % 5, (i * 7919) % 300) for i in range(250)],
    "chain": [(i, i + 1) for i in range(120)],
    "star": [(500, i) for i in range(200)] + [(-1, 500)],
    "odd": [(1, 1), (2, 2), (2, 3), (3, 2), (None, 4), (5, None), (9, 8), (9, 8)],
    "empty": [],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = GRAPHS[name]
    got = connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()
    assert sorted(map(tuple, got)) == sorted(union_find(edges).items())


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "b", "n", None, "a2")], "id int, v_x string, v_y string, tax_name string, street_1 string, street_2 string")
    assert T.combine_columns_parallel(df).select("v").first()["v"] == "b"
    assert "raw_name" in T.set_raw_columns(df, ["tax_name"]).columns
    assert tuple(T.shift_streets(df).select("street_1", "street_2").first()) == ("a2", None)
    assert T.non_raw_columns(T.set_raw_columns(df, ["tax_name"])) == df.columns
    three = spark.createDataFrame([("a", "b", None), ("a", "b", "c")], "taxpayer_1 string, taxpayer_2 string, taxpayer_3 string")
    assert [tuple(r) for r in T.shift_taxpayers(three).collect()] == [(None, "a", "b"), ("a", "b", "c")]
    ent = spark.createDataFrame([("x", "y", True, "E", "F", "1", "2", "3"), ("x", "y", None, None, None, "1", "2", "3")],
                                "clean_name string, core_name string, exclude_name boolean, entity_clean_name string, entity_core_name string, "
                                "entity_address_1 string, entity_address_2 string, entity_address_3 string")  # fmt: skip
    assert [tuple(r) for r in T.set_business_names(ent).select("clean_name", "core_name").collect()] == [("E", "F"), ("x", "y")]
    assert [tuple(r) for r in T.clear_excluded_entities(ent).select("entity_clean_name", "entity_address_3").collect()] == [(None, None), (None, "3")]


def test_duplicates_and_first_rows(spark):
    rows = [(1, "a", None, None), (2, "a", "1", "x"), (3, "a", "0", "y"), (4, None, "5", "z"), (5, None, None, None), (6, "b", None, "w")]
    df = spark.createDataFrame(rows, "id int, name string, status string, other string")
    again, alone = T.duplicates(df, "name")
    assert {r["id"] for r in again.collect()} == {1, 2, 3, 4, 5} and {r["id"] for r in alone.collect()} == {6}
    assert {tuple(r) for r in T.merge_duplicates(df, ["name"], "id").collect()} == {(1, "a", "0", "x"), (6, "b", None, "w")}
    assert {tuple(r) for r in T.keep_first(df, ["name"], "id").collect()} == {rows[0], rows[3], rows[5]}
    assert [tuple(r) for r in T.frequency(df, "name").collect()] == [("a", 3), ("b", 1)]
    assert T.in_top(df, "name", 1).count() == 3
    assert T.remove_listed(df, spark.createDataFrame([("a",)], "name string"), "name").count() == 3


def test_flags_by_suffix(spark):
    df = spark.createDataFrame([(1, "x", "y"), (2, None, "x")], "id int, a string, b string")
    research = spark.createDataFrame([("x", True, None, False, None, True)], "address string, is_ignore_misc boolean, is_landlord_org boolean, is_missing_suite boolean, is_problematic_suite boolean, is_realtor boolean")
    got = {r["id"]: r for r in T.set_address_flags(df, research, {"a": "_t", "b": "_e1"}).collect()}
    assert got[1]["exclude_address_t"] and got[1]["is_researched_t"] and not got[1]["is_researched_e1"] and got[2]["is_realtor_e1"]
    assert not got[2]["is_researched_t"] and not got[1]["is_org_address_t"]


def brute_resolve(candidates, number, code):
    def one(rows):
        return len(rows) == 1 or len({r["formatted"] for r in rows}) == 1

    with_number = [r for r in candidates if r["number"]]
    if not with_number:
        return candidates
    if one(with_number):
        return with_number[:1]
    same = [r for r in candidates if r["number"] == number]
    if not same:
        return candidates
    if one(same):
        return same[:1]
    both = [r for r in same if r["zip"] == code]
    if not both:
        return same
    return both[:1] if one(both) else both


def test_geocode(spark):
    rng = random.Random(3)
    rows, want = [], Counter()
    for i in range(200):
        address = f"{i} MAIN ST, X, IL 6060{i % 3}"
        found = [dict(number=rng.choice(["", str(i), "7"]), zip=rng.choice(["60600", "60601", "60602"]), formatted=rng.choice("ab")) for _ in range(rng.randint(1, 4))]
        rows += [(address, k, r["number"], r["zip"], r["formatted"]) for k, r in enumerate(found)]
        for r in brute_resolve(found, str(i), f"6060{i % 3}"):
            want[address, r["number"], r["zip"], r["formatted"]] += 1
    df = spark.createDataFrame(rows, "clean_address string, candidate int, number string, zip_code string, formatted_address string")
    got = geocode.resolve(df)
    assert Counter((r[0], r[2], r[3], r[4]) for r in got.collect()) == want
    asked = spark.createDataFrame([("nowhere",)], "clean_address string").unionByName(df.select("clean_address").distinct())
    valid, unvalid, failed = geocode.split_results(asked, got)
    assert valid.count() + unvalid.select("clean_address").distinct().count() == 200 and failed.count() == 1
    assert geocode.cost(asked).first()["cost"] == 0


def answer(n, f):
    return ((n, None, None, "MAIN", None, None, None, None, "X", None, "IL", "60601", "US"), f, (1.0, 2.0), 0.9, "roof", "s")


def test_stream_of_answers(spark, tmp_path):
    rows = [("1 MAIN", [answer("1", "1 main")]), ("2 MAIN", [answer("2", "a"), answer("3", "b")]), ("3 MAIN", []), (None, [])]
    schema = f"clean_address string, results {geocode.RESULTS}"
    df = spark.createDataFrame(rows, schema)
    for i in range(2):
        df.where(F.col("clean_address") == "1 MAIN" if i else F.col("clean_address").eqNullSafe("1 MAIN") == F.lit(False)).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    resolve_stream(stream, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    found = settled_tables(spark, f"{tmp_path}/out")
    valid = found["validated"]
    assert {r["clean_address"] for r in valid.collect()} == {"1 MAIN", "2 MAIN"}
    assert valid.where("clean_address = '1 MAIN'").first()["formatted_address"] == "1 MAIN"
    assert [r["clean_address"] for r in found["failed"].collect()] == ["3 MAIN"]
    assert [r["clean_address"] for r in open_addresses(df.where("clean_address is not null"), valid).collect()] == ["3 MAIN"]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_of_a_stream_settles_alike(spark, tmp_path, seed):
    """Parts of answers in any order and batches, some sent again, some never: the tables are those of one batch."""
    rng, rows = random.Random(seed), []
    for i in range(30):
        parts = rng.randint(1, 3)
        for part in range(1, parts + 1):
            got = [answer(rng.choice(["", str(i), "7"]), rng.choice("ab")) for _ in range(rng.randint(0, 2))]
            if part < 3 or i % 4:  # else it never comes
                rows += [(f"{i} MAIN ST", part, parts, rng.randint(1, 500), got)] * rng.choice([1, 1, 2])
    end = [(None, 1, 1, 10**6, [])]
    schema = f"clean_address string, part int, parts int, at long, results {geocode.RESULTS}"
    kinds = spark.createDataFrame([], schema).withColumn("at", F.timestamp_seconds("at")).schema
    stamped = lambda part: spark.createDataFrame(part, schema).withColumn("at", F.timestamp_seconds("at"))
    rng.shuffle(rows)
    cuts = [0, *sorted(rng.sample(range(len(rows)), 3)), len(rows)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        stamped(rows[a:b]).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stamped(end).coalesce(1).write.parquet(f"{tmp_path}/in/9")
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    options = dict(part="part", parts="parts", at="at", wait_seconds=60, delay="20 minutes")
    for _ in range(2):  # a second start has nothing new, and changes nothing
        resolve_stream(stream, f"{tmp_path}/out", f"{tmp_path}/check", **options).awaitTermination()
    found = settled_tables(spark, f"{tmp_path}/out")
    whole = settled(gathered(as_parts(stamped(rows), part="part", parts="parts", at="at")), geocode.RESULTS)
    for name in whole:
        got = found[name].select(*whole[name].columns) if name in found else []
        assert sorted(map(str, got.collect())) == sorted(map(str, whole[name].collect())), name
    assert whole["failed"].count() and whole["unvalidated"].count() and whole["validated"].count()


def test_requests(spark):
    asked = spark.createDataFrame([("a", "1 A", None, "C", "IL", None, None), ("b", "1 B", None, "C", "IL", "60601", None)],
                                  "clean_address string, clean_street_1 string, clean_street_2 string, clean_city string, clean_state string, clean_zip_code string, clean_country string")
    got = [r["request"] for r in geocode.requests(asked).collect()]
    assert got[0]["q"] == "a" and got[0]["street"] is None and got[1]["q"] is None and got[1]["postal_code"] == "60601"
    assert geocode.searched(asked).columns == ["clean_address", "street", "city", "state", "zip_code"]


def test_match_strings_with_any_threshold(spark):
    rng = random.Random(5)
    names = ["".join(rng.choices("abcd ", k=rng.randint(3, 9))) for _ in range(60)]
    df = spark.createDataFrame([(n,) for n in [*names, None, names[0]]], "doc string")
    everything = {(r[0], r[1]): r["conf1"] for r in M.similar_pairs(df, df, "doc", "doc", M.StringMatchParams(threshold=0.0)).collect()}
    for theta in (0.3, 0.7):
        found = {(r[0], r[1]): r["conf1"] for r in M.similar_pairs(df, df, "doc", "doc", M.StringMatchParams(threshold=theta)).collect()}
        assert found.keys() == {k for k, v in everything.items() if v >= theta - 1e-9}
    given = M.similar_pairs(df, df, "doc", "doc", M.StringMatchParams(threshold=0.3, as_given=True)).collect()
    assert given and all(r["conf1"] <= 1 + 1e-9 for r in given)
    with pytest.raises(ValueError):
        M.similar_pairs(df, df, "doc", "doc", M.StringMatchParams(threshold=None))
    near = M.match_strings(df, df, params=M.StringMatchParams(threshold=None, k=4)).collect()
    want = {}
    for (a, b), c in sorted(everything.items(), key=lambda x: (x[0][0], -round(x[1], 12), x[0][1])):
        if len(want.setdefault(a, [])) < 4:
            want[a].append(b)
    got = {a: [r["matched_doc"] for r in sorted((r for r in near if r["original_doc"] == a), key=lambda r: (-round(r["conf1"], 12), r["matched_doc"]))] for a in want}
    assert got == want and len(near) == sum(map(len, want.values()))


def test_network(spark):
    flags = {f"{f}{s}": v for s in ("_t", "_e1", "_e2", "_e3") for f, v in (("is_validated", True), ("is_researched", True), ("exclude_address", False), ("is_org_address", True))}
    rows = [
        dict(id=1, clean_name="Erick Larson", entity_clean_name=None, match_address_t="123 Oak St", match_address_e1=None, match_address_e2=None, match_address_e3=None),
        dict(id=2, clean_name="Top Props LLC", entity_clean_name="Top Props LLC", match_address_t="456 Maple St", match_address_e1="555 State St", match_address_e2="998 Jameston St", match_address_e3="322 Staple St"),
        dict(id=3, clean_name="Real Management Corp", entity_clean_name="Real Management Corp", match_address_t="789 Diamond St", match_address_e1="928 River Rd", match_address_e2="523 Taylor Ave", match_address_e3=None),
        dict(id=4, clean_name="Other LLC", entity_clean_name="Other LLC", match_address_t=None, match_address_e1="555 State St", match_address_e2=None, match_address_e3=None),
    ]
    rows = [r | flags | {"exclude_name": False} for r in rows]
    schema = ", ".join(f"{k} {'int' if k == 'id' else 'boolean' if k in flags or k == 'exclude_name' else 'string'}" for k in rows[0])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    with_orgs = network.NetworkParams(include_orgs=True)
    got = {r["id"]: r for r in network.taxpayer_networks(df, [with_orgs, network.NetworkParams()], "id").collect()}
    assert got[2]["final_component_1"] == got[4]["final_component_1"] == "322 Staple St"
    assert len({r["final_component_1"] for r in got.values()}) == 3 and len({r["final_component_2"] for r in got.values()}) == 4
    assert got[2]["network_1"] == "Other LLC -- Top Props LLC -- 322 Staple St -- (1)" and got[2]["network_1_short"] == "Other LLC Etc."
    edges = network.taxpayer_edges(df, with_orgs)
    parts = network.components(edges)
    assert tuple(network.network_counts(parts, edges).first()) == (3, 12, 9)
    numbers = network.numbered(parts).select("component", "component_id").distinct().orderBy("component").collect()
    assert [r["component_id"] for r in numbers] == [0, 1, 2]
    texts = {r["component"]: r["network_text"] for r in network.network_text(parts, edges).collect()}
    assert texts["123 Oak St"] == '[["123 Oak St","Erick Larson"]]'
    whole = json.loads(texts["322 Staple St"])
    for chunk in (1, 2):
        rows = network.network_text(parts, edges, chunk=chunk).where("component = '322 Staple St'").orderBy("chunk").collect()
        assert [r["chunk"] for r in rows] == list(range(-(-len(whole) // chunk)))
        assert [e for r in rows for e in json.loads(r["network_text"])] == whole == sorted(whole)


@pytest.mark.parametrize("suffix", ["v1", "v2"])
def test_address_rules(spark, suffix):
    """The truth tables of both inclusion rules."""
    names = ["is_validated", "is_researched", "exclude_address", "is_org_address", "is_missing_suite", "is_problem_suite"]
    rows = [(a, *(bool(i >> k & 1) for k in range(6))) for i in range(64) for a in ("x", "", None)]
    df = spark.createDataFrame(rows, "a string, " + ", ".join(f"{n} boolean" for n in names))
    for bits in range(32):
        p = network.NetworkParams(suffix=suffix, **{n: bool(bits >> k & 1) for k, n in enumerate(("include_unvalidated", "include_unresearched", "include_orgs", "include_missing_suites", "include_problem_suites"))})
        got = df.select("*", network.address_counts("a", p).alias("one"), network.address_counts_by_suite("a", p).alias("two")).collect()
        for r in got:
            if not r["a"]:
                want = want2 = False
            else:
                want = (r["is_validated"] or p.include_unvalidated) and not r["exclude_address"] and (p.include_unresearched or (r["is_researched"] and (p.include_orgs or not r["is_org_address"])))
                if not r["is_validated"]:
                    want2 = p.include_unvalidated and p.include_unresearched
                elif not r["is_researched"]:
                    want2 = p.include_unresearched
                elif r["exclude_address"]:
                    want2 = False
                elif suffix == "v2" and r["is_missing_suite"]:
                    want2 = p.include_missing_suites
                elif suffix == "v2" and r["is_problem_suite"]:
                    want2 = p.include_problem_suites
                else:
                    want2 = p.include_orgs or not r["is_org_address"]
            assert (r["one"], r["two"]) == (want, want2)


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("1", "yes", "N/A"), ("2", None, 'a "b", c')], "id string, flag string, text string")
    contract = contracts.columns("id", "text", flags=("flag",))
    for kind in ("parquet", "csv", "json", "orc"):
        tables.save(df, f"{tmp_path}/{kind}", kind)
        got = {r["id"]: (r["flag"], r["text"]) for r in tables.load(spark, f"{tmp_path}/{kind}", kind, contract).collect()}
        assert got == {"1": (True, None if kind == "csv" else "N/A"), "2": (False, 'a "b", c')}
    assert tables.load(spark, f"{tmp_path}/nothing") is None
    for batch in ("b1", "b2"):
        tables.save_partial(df, f"{tmp_path}/partial", batch)
    assert spark.read.parquet(f"{tmp_path}/partial").groupBy("batch").count().count() == 2
    tables.store(df, str(tmp_path), "some")
    assert tables.retrieve(spark, str(tmp_path), "some").count() == 2
    tables.write_dataset(df, str(tmp_path), "raw", "corps")
    assert tables.read_dataset(spark, str(tmp_path), "raw", "corps").count() == 2
    with pytest.raises(KeyError):
        tables.dataset_path("r", "raw", "unknown")


def test_contracts(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y")], "raw_value string, standardized_value string")
    got = {(r["column"], r["rule"], r["value"]): r["n"] for r in contracts.violations(df, contracts.FIXING_TAX_NAMES).collect()}
    assert got == {("raw_value", "not_null", None): 1, ("raw_value", "unique", "a"): 2}
    assert contracts.UNVALIDATED_ADDRS_CLEAN.boolean_fields() == ["is_pobox"]
    bad = contracts.violations(df.drop("raw_value"), contracts.FIXING_TAX_NAMES).collect()
    assert [(r["column"], r["rule"]) for r in bad] == [("raw_value", "missing_column")]


def test_statistics(spark):
    df = spark.createDataFrame([("a", "", 1), (None, "x", 2)], "p string, q string, n int")
    got = {(r["dataset"], r["column"]): r["n_missing"] for r in stats.null_profile({"t": df}).collect()}
    assert got == {("t", "p"): 1, ("t", "q"): 1, ("t", "n"): 0}
    assert tuple(stats.load_table({"t": df}).first()) == ("t", 2, 3)
    assert df.agg(stats.distinct_values("p").alias("d")).first()["d"] == 2
    assert stats.string_match(df.where("false"), ["p"]).first()["percent_matched"] is None


def test_every_query_has_sql_or_a_reason():
    import __spark_entry__ as entry

    without = entry.queries().keys() - entry.oracle_sql().keys()
    assert without <= {"op2_simhash", "op4_toxicity", "op5_fingerprints", "op6_packing", "op10_bpe", "pipeline"}
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "network_1" in df.columns
