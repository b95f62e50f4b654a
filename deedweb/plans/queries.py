"""The registered queries of the linkage operators: each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deedweb.functions import address as A
from deedweb.functions import classify as Q
from deedweb.functions import clean as C
from deedweb.functions.tokens import ngrams
from deedweb.operators import geocode, network, stats
from deedweb.operators import match as M
from deedweb.operators import phrases as P
from deedweb.operators import tables as T
from deedweb.operators.growth import grow_components, read_components, save_components
from deedweb.operators.masters import apply_delivery, read_master
from deedweb.operators.sketches import add_statistics, linked_values, statistics, total_statistics
from deedweb.plans.inputs import derived
from deedweb.scratch import discard, fresh_path, written
from deedweb.sources.contracts import CLASS_CODES, Contract, columns, violations
from deedweb.sources.snapshots import publish, snapshot
from deedweb.sources.tables import load_with_quarantine, union_all
from deedweb.streaming.resolve import resolve_stream, settled_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BANKS = {"FIRST NATL": "FIRST NATIONAL BANK", "FIRST": "FIRST BANK"}
PEOPLE = ["JOHN", "MARY", "JONES", "SMITH"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def taxpayers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "taxpayers")


# Cleaning


@query
def clean_upper_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = taxpayers(spark, sf_dir)
    return df.select("id", C.remove_symbols_punctuation(C.make_upper("tax_name")).alias("name"), C.remove_symbols_punctuation("tax_street").alias("street"))


@query
def clean_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = C.remove_extra_spaces(C.trim_whitespace(C.make_upper("tax_name")))
    return taxpayers(spark, sf_dir).select("id", C.fix_llcs(C.strip_dashes(plain)).alias("name"), C.empty_to_null(C.strip_dashes(F.lit("--"))).alias("none"))


@query
def dedup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.deduplicate(C.make_upper("tax_name")).alias("name"))


@query
def switch_the(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.switch_the("tax_name").alias("name"))


@query
def take_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.take_first("tax_street").alias("street"))


@query
def combine_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.combine_numbers("tax_street").alias("street"))


@query
def street_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.convert_street_suffixes("tax_street").alias("street"))


@query
def convert_nsew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.convert_nsew("tax_street").alias("street"), C.fix_directionals(F.element_at(F.split("tax_street", " "), -1)).alias("last"))


@query
def fix_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.fix_zip("tax_zip").alias("zip"), Q.is_irregular_zip("tax_zip").alias("odd_zip"), Q.is_irregular_state("tax_state").alias("odd_state"), C.fix_states("tax_state").alias("state"), C.fix_mpls("tax_city").alias("city"))


@query
def secondary_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.remove_secondary_component("tax_street", literal=True).alias("street"), C.remove_secondary_designators("tax_street").alias("kept"), C.drop_letters("tax_street", literal=True).alias("dropped"))


@query
def core_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.core_name(C.make_upper("tax_name"), literal=True).alias("core"))


@query
def fix_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", C.fix_names("tax_name", BANKS).alias("name"))


ONES = ("ONE", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "NINE")
TENS = ("TWENTY", "THIRTY", "FORTY", "FIFTY", "SIXTY", "SEVENTY", "EIGHTY", "NINETY")
NTHS = ("FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "SIXTH", "SEVENTH", "EIGHTH", "NINTH")


@query
def number_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's keys spelled out, as numbers and as names of streets, and back."""
    word = lambda values, n: F.array(*map(F.lit, values))[n.cast("int")]
    key = F.col("c_custkey")
    ones, tens, hundreds = key % 9, F.floor(key / 9) % 8, F.floor(key / 72) % 9
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat_ws(" ", word(ONES, hundreds), F.lit("HUNDRED"), word(TENS, tens), word(ONES, ones)).alias("a"),
        F.concat_ws(" ", F.lit("EAST"), word(TENS, tens), word(NTHS, ones), F.lit("STREET")).alias("b"),
        F.concat_ws(" ", word(ONES, hundreds), word(TENS, tens), F.lit("MAIN ST")).alias("c"),
    )
    return df.select("c_custkey", C.words_to_num("a").alias("number"), C.convert_ordinals("b").alias("ordinal"), C.convert_mixed("c").alias("mixed"))


@query
def value_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "properties")
    return df.select("pin", C.is_int("num_units").alias("is_int"), Q.is_unit_gte_1("num_units").alias("several"), C.is_encoded_empty("class_code").alias("odd"), C.coerce_boolean("num_units").alias("flag"), Q.has_rental_class("class_code", ["1", "F"]).alias("rental"))


# Classification


@query
def name_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = C.make_upper("tax_name")
    flags = {"is_org": Q.is_org(name), "is_trust": Q.is_trust(name), "is_llc": Q.is_llc(name), "is_bank": Q.is_bank(name, ["NATL", "CITY"]), "is_person": Q.is_person(name, PEOPLE)}
    return taxpayers(spark, sf_dir).select("id", *(f.alias(n) for n, f in flags.items()))


@query
def person_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as a table: the words of the suppliers' names."""
    words = derived(spark, sf_dir, "corps").select(F.explode(F.split(F.upper("raw_name"), " ")).alias("name")).where("name <> '' and name not in ('CITY', 'OF')")
    df = taxpayers(spark, sf_dir).select("id", C.make_upper("tax_name").alias("name"))
    return Q.flag_persons(df, "name", words, "id").select("id", "is_person")


@query
def bank_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary that is a table, of parts of the corporations' names: whether a name holds one, and the name with the longest
    one in its standard form."""
    phrase = F.substring(F.upper("raw_name"), 2, 6)
    phrases = derived(spark, sf_dir, "corps").select(phrase.alias("phrase"), F.concat(F.lit("<"), phrase, F.lit(">")).alias("standard"))
    df = taxpayers(spark, sf_dir).select("id", C.make_upper("tax_name").alias("name"))
    return P.fix_names_by_table(P.flag_phrases(df, "name", phrases), "name", phrases)


@query
def org_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisation words as a table, of any length: the last words of the corporations' names."""
    words = derived(spark, sf_dir, "corps").select(F.element_at(F.split(F.upper("raw_name"), " "), -1).alias("word"))
    df = taxpayers(spark, sf_dir).select("id", C.make_upper("tax_name").alias("name"))
    return P.flag_words(df, "name", words).select("id", "is_org")


@query
def address_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    street = F.col("tax_street")
    return taxpayers(spark, sf_dir).select("id", Q.is_pobox(street).alias("is_pobox"), Q.is_not_secondary_number(street).alias("is_road"), Q.is_invalid_street(F.concat(F.lit("12, "), street)).alias("only_number"), C.check_sec_num(street).alias("number"))


# Addresses


@query
def format_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "addresses").select("id", *(c.alias(n) for n, c in A.formatted_addresses().items()))


@query
def fix_pobox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", A.fix_pobox(F.concat("tax_street", F.lit(", "), "tax_city")).alias("address"))


@query
def city_state_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxpayers(spark, sf_dir).select("id", *(c.alias(n) for n, c in A.city_state_zip("city_state_zip").items()))


@query
def full_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = T.set_raw_columns(taxpayers(spark, sf_dir), ["tax_name", "tax_street", "tax_city", "tax_state", "tax_zip"])
    parts = ["raw_street", "raw_city", "raw_state", "raw_zip"]
    df = df.withColumns({"raw_address": A.full_address(parts), "llc_address": A.full_address(parts, llc=True)})
    return df.select("id", "raw_address", "llc_address", T.name_address("raw_name", "raw_address").alias("name_address"), T.match_document("raw_name", "raw_address").alias("document"))


# Joins


def _named(df: DataFrame, raw: str = "raw_name") -> DataFrame:
    clean = C.remove_extra_spaces(C.trim_whitespace(C.make_upper(raw)))
    return df.withColumns({"clean_name": clean, "core_name": C.core_name(clean, literal=True)})


@query
def merge_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxpayers with the corporation of their clean name; of namesakes, that with the smallest number."""
    corps = T.keep_first(_named(derived(spark, sf_dir, "corps")), ["clean_name"], "file_number")
    left = _named(taxpayers(spark, sf_dir), "tax_name").select("id", "clean_name", "core_name")
    return T.merge_orgs(left, corps.select("clean_name", "core_name", "file_number", "status"), "clean", "clean_name")


@query
def merge_orgs_by_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxpayers with the corporation of their core name; of namesakes, that with the smallest number."""
    corps = T.keep_first(_named(derived(spark, sf_dir, "corps")), ["core_name"], "file_number")
    left = _named(taxpayers(spark, sf_dir), "tax_name").select("id", "clean_name", "core_name")
    return T.merge_orgs(left, corps.select("core_name", "file_number", "status"), "core", "core_name")


@query
def published_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corporations are published, then the companies as a batch that runs twice; what a reader sees."""
    root, names = fresh_path(spark, "masters"), ("file_number", "raw_name")
    publish(spark, root, {"entities": derived(spark, sf_dir, "corps").select(F.lit("corp").alias("kind"), *names)}, source="state", batch=1)
    for _ in range(2):
        publish(spark, root, append={"entities": derived(spark, sf_dir, "llcs").select(F.lit("llc").alias("kind"), *names)}, source="state", batch=2)
    return snapshot(spark, root).read(spark, "entities")


@query
def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties as JSON lines, some cut off, some with a price that is no number, some without an owner: how many rows are
    good, and how many are bad for what reason."""
    pin, path = F.col("pin"), fresh_path(spark, "lines")
    known = F.struct("pin", F.when(pin % 5 != 0, F.col("owner")).alias("owner"), F.when(pin % 11 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("price"))
    line = F.regexp_replace(F.to_json(known), '"price":"([0-9.E]+)"', '"price":$1')
    line = F.when(pin % 7 == 0, F.substring(line, 1, 12)).otherwise(line)
    derived(spark, sf_dir, "properties").select(line.alias("value")).write.text(path)
    schema = StructType().add("pin", "long").add("owner", "long").add("price", "double")
    good, bad = load_with_quarantine(spark, path, schema, "json", ["pin", "owner"])
    rows = good.select(F.lit("good").alias("reason"), "pin").unionByName(bad.select("reason", F.lit(None).cast("long").alias("pin")))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("pin").alias("pins"))


@query
def merge_proptax(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = derived(spark, sf_dir, "properties").select("pin", F.concat(F.lit("owner "), F.col("owner").cast("string")).alias("raw_name_address"), "num_units")
    prop_addrs = derived(spark, sf_dir, "addresses").select(F.col("id").alias("pin"), "street", "city")
    owners = taxpayers(spark, sf_dir).select(F.concat(F.lit("owner "), F.col("id").cast("string")).alias("raw_name_address"), F.col("tax_street").alias("clean_address"))
    valid = owners.where(~Q.is_pobox("clean_address")).select("clean_address", F.concat("clean_address", F.lit(" OK")).alias("formatted_address"))
    return T.merge_proptax_match(owners, props, prop_addrs, valid)


@query
def rental_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = derived(spark, sf_dir, "properties")
    codes = props.select(F.explode(F.split("class_code", ", ")).alias("code")).distinct().withColumn("is_rental", F.col("code").isin("1", "F"))
    first = T.set_is_rental_initial(props, codes).withColumns({"raw_name_address": F.col("owner").cast("string"), "first": F.col("is_rental")})
    more = first.where("num_units = '3'").select("raw_name_address")
    return T.set_is_rental_final(first, more).select("pin", "first", "is_rental")


@query
def address_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    corps = derived(spark, sf_dir, "corps")
    research = corps.select(
        F.col("raw_president_address").alias("address"),
        (F.col("file_number") % 2 == 0).alias("is_ignore_misc"),
        (F.col("file_number") % 3 == 0).alias("is_landlord_org"),
        (F.col("file_number") % 5 == 0).alias("is_missing_suite"),
        F.lit(None).cast("boolean").alias("is_problematic_suite"),
        (F.col("file_number") % 7 == 0).alias("is_realtor"),
    )
    df = taxpayers(spark, sf_dir).select("id", F.col("tax_street").alias("match_address_t"))
    return T.set_address_flags(df, research, {"match_address_t": "_t"}).drop("match_address_t")


@query
def nonrentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = derived(spark, sf_dir, "properties").withColumn("raw_name_address", F.col("owner").cast("string"))
    rentals = props.where("num_units = '1'")
    found = T.nonrentals_from_addrs(props, rentals.select("raw_name_address", "class_code"), "class_code")
    return found.select("pin", "raw_name_address")


@query
def remove_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.remove_listed(taxpayers(spark, sf_dir).select("id", "tax_street"), derived(spark, sf_dir, "corps"), "tax_street", "raw_president_address")


# Aggregation


@query
def frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.frequency(derived(spark, sf_dir, "llcs"), "brand")


@query
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    again, alone = T.duplicates(derived(spark, sf_dir, "llcs"), "raw_name")
    return again.select("file_number", F.lit(True).alias("again")).unionByName(alone.select("file_number", F.lit(False).alias("again")))


@query
def merge_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.merge_duplicates(derived(spark, sf_dir, "llcs").select("file_number", "raw_name", "status", "brand", "raw_agent_address"), ["raw_name"], "file_number")


@query
def merged_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The companies come in four deliveries, by their status; the master after the last one."""
    columns = ["file_number", "raw_name", "status", "brand", "raw_agent_address"]
    df, root = derived(spark, sf_dir, "llcs").select(*columns), fresh_path(spark, "master")
    status = F.coalesce("status", F.lit("-"))
    parts = (status == "1", status == "-", ~status.isin("0", "1", "-"), status == "0")
    for i, part in enumerate(parts):
        apply_delivery(spark, root, df.where(part), ["raw_name"], "file_number", source="state", batch=i)
    return read_master(spark, root, columns, ["raw_name"])


@query
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.active(T.keep_first(derived(spark, sf_dir, "llcs").select("file_number", "raw_name", "status", "brand"), ["raw_name", "brand"], "file_number"))


@query
def split_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties joined to the records that were split off them."""
    wide = derived(spark, sf_dir, "properties").withColumn("raw_name_address", F.col("owner").cast("string"))
    props, owners = T.split_props_taxpayers(wide, ["pin", "raw_name_address"], ["raw_name_address", "class_code"], "pin")
    return props.groupBy("raw_name_address").agg(F.count(F.lit(1)).alias("n")).join(owners, "raw_name_address")


@query
def union_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    tax, corps, llcs = (derived(spark, sf_dir, n) for n in ("taxpayers", "corps", "llcs"))
    return T.unvalidated_addresses(
        [
            (tax, "taxpayers", "taxpayer", {"raw_address": "tax_street", "raw_city": "tax_city"}),
            (corps, "corps", "president", {"raw_address": "raw_president_address"}),
            (corps, "corps", "secretary", {"raw_address": "raw_secretary_address"}),
            (llcs, "llcs", "office", {"raw_address": "raw_office_address"}),
        ]
    )


@query
def combine_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    corps, llcs = _named(derived(spark, sf_dir, "corps")), _named(derived(spark, sf_dir, "llcs"))
    valid = taxpayers(spark, sf_dir).select(F.col("tax_street").alias("clean_address"), F.concat("tax_street", F.lit(", OK")).alias("formatted_address"))
    corps = T.merge_validated_addrs(corps, valid, list(T.CORP_ADDRESSES))
    llcs = T.merge_validated_addrs(llcs, valid, list(T.LLC_ADDRESSES))
    return T.combine_corps_llcs(corps, llcs)


# Geocoding


@query
def geocode_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines stand for the candidates of an address."""
    df = derived(spark, sf_dir, "candidates").withColumn("clean_address", F.concat(F.lpad(F.col("order_id").cast("string"), 8, "0"), F.lit("|"), "clean_address"))
    df = df.withColumns({"street": F.split_part("clean_address", F.lit("|"), F.lit(2))})
    return geocode.process_results(df, "clean_address", street="street").select("order_id", "candidate", "number", "zip_code", "formatted_address")


@query
def geocode_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many addresses are settled, open or failed, and what asking costs."""
    df = derived(spark, sf_dir, "candidates").withColumn("clean_address", F.col("order_id").cast("string"))
    asked = derived(spark, sf_dir, "properties").select(F.col("pin").cast("string").alias("clean_address"))
    valid, unvalid, failed = geocode.split_results(asked, geocode.resolve(df.where("number <> ''")))
    parts = [d.agg(F.lit(n).alias("part"), F.count_distinct("clean_address").alias("addresses")) for n, d in (("validated", valid), ("unvalidated", unvalid), ("failed", failed))]
    costs = geocode.cost(asked).select(F.lit("asked").alias("part"), "addresses", "cost")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("cost", F.lit(None).cast("double")).unionByName(costs)


@query
def settled_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers come in two parts, in several batches; each address is settled when it has both. Addresses without any are asked
    and answered by nothing."""
    df, path = derived(spark, sf_dir, "candidates"), fresh_path(spark, "answers")
    address = lambda key: F.concat(key % 4 + 1, F.lit(" MAIN ST "), key, F.lit(", CHICAGO, IL "), 60600 + key % 3)
    given = {"number": F.col("number"), "zip": F.col("zip_code")}
    components = F.struct(*(given.get(c, F.lit(None).cast("string")).alias(c) for c in geocode.COMPONENTS.values()))
    one = F.struct(
        components.alias("address_components"), "formatted_address", F.lit(None).cast("struct<lat: double, lng: double>").alias("location"),
        F.lit(None).cast("double").alias("accuracy"), F.lit(None).cast("string").alias("accuracy_type"), F.lit(None).cast("string").alias("source"),
    )
    part = F.when(F.col("candidate") <= 3, 1).otherwise(2)
    rows = df.repartition("order_id").groupBy("order_id", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("candidate", one.alias("r")))).alias("rows"))
    total = F.count(F.lit(1)).over(Window.partitionBy("order_id"))
    rows = rows.select(address(F.col("order_id")).alias("clean_address"), "part", F.transform("rows", lambda x: x["r"]).cast(geocode.RESULTS).alias("results"), total.alias("parts"))
    none = derived(spark, sf_dir, "properties").join(df.select(F.col("order_id").alias("pin")).hint("merge"), "pin", "left_anti")
    none = none.select(address(F.col("pin")).alias("clean_address"), F.lit(1).alias("part"), F.array().cast(geocode.RESULTS).alias("results"), F.lit(1).cast("long").alias("parts"))
    # Two batches, each of as many files as there are tasks.
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.unionByName(none).repartitionByRange(2 * n, "part", "clean_address").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{path}/in").schema).option("maxFilesPerTrigger", n).parquet(f"{path}/in")
    resolve_stream(stream, f"{path}/out", f"{path}/check", part="part", parts="parts").awaitTermination()
    found = settled_tables(spark, f"{path}/out")
    columns = ("clean_address", "candidate", "number", "zip_code", "formatted_address")
    return union_all([d.select(F.lit(n).alias("part"), *(c for c in columns if c in d.columns)) for n, d in found.items()])


# Matching


@query
def name_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(ngrams("p_name"), "|").alias("grams"))


def _matched(spark: SparkSession, sf_dir: str, params: M.StringMatchParams, in_order: bool = True) -> DataFrame:
    df = derived(spark, sf_dir, "owners").select("doc")
    return M.match_strings(df, df, params=params, in_order=in_order)


@query
def tfidf_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _matched(spark, sf_dir, M.StringMatchParams(threshold=0.75, k=4))
    return found.select("original_doc", "matched_doc", F.round("conf1", 6).alias("conf1"), F.round("conf", 6).alias("conf"), "ldist")


@query
def tfidf_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a threshold, and with document counts over the table as it is."""
    found = _matched(spark, sf_dir, M.StringMatchParams(threshold=None, k=3, as_given=True))
    return found.select("original_doc", "matched_doc", F.round("conf1", 6).alias("conf1"), "ldist")


@query
def saved_matcher(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matcher is fitted on the owners and saved; a later delivery, in which streets are spelled out, meets what is loaded."""
    owners, path = derived(spark, sf_dir, "owners").select("doc"), fresh_path(spark, "matcher")
    fitted = M.fit_matcher(owners, params=M.StringMatchParams(threshold=0.6, k=2))
    M.save_matcher(fitted, path)
    for done in (fitted.weights, fitted.vectors):
        discard(done)
    later = owners.select(F.regexp_replace("doc", " ST$", " STREET").alias("doc"))
    found = M.match_with(M.load_matcher(spark, path), later)
    return found.select("original_doc", "matched_doc", F.round("conf1", 6).alias("conf1"), "ldist")


@query
def match_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.match_groups(_matched(spark, sf_dir, M.StringMatchParams(threshold=0.75, k=3), in_order=False))


@query
def matches_with_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.with_match_groups(_matched(spark, sf_dir, M.StringMatchParams(threshold=0.75, k=3), in_order=False))
    return found.select("original_doc", "matched_doc", "fuzzy_match_name", "fuzzy_match_combo")


@query
def pair_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), F.lower("p_type")).alias("other"))
    return df.select("p_partkey", F.round(M.pair_similarity(F.col("p_name"), F.col("other"), 0.1), 6).alias("one_way"), F.round(M.cosine_trigram(F.col("p_name"), F.col("other")), 6).alias("both_ways"))


@query
def match_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "addresses").select(
        "id", "number", "street", "zip_code",
        F.concat(F.col("id") % 40 * 7, F.lit(" MAIN ST, CHICAGO, IL "), 60600 + F.col("id") % 5).alias("clean_address"),
        F.when(F.col("id") % 3 == 0, F.lit("valid")).alias("clean_address_v1"),
        (F.col("id") % 300).cast("string").alias("number_validated"), F.lit("MAIN").alias("street_validated"),
        (60600 + F.col("id") % 30).cast("string").alias("zip_code_validated"),
        F.lit(None).cast("string").alias("formatted_address_prop"),
    )
    return M.set_match_verdict(df).select("id", "is_match_number_street_zip", "is_match_number_zip", "is_match")


# Networks

PARAMS = network.NetworkParams(match_col="match_name")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.taxpayer_edges(derived(spark, sf_dir, "records"), PARAMS)


@query
def network_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


@query
def network_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.numbered(network.components(_edges(spark, sf_dir)))


@query
def network_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir)
    return network.network_counts(network.components(edges), edges)


@query
def network_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelling of the edges between owners and their own addresses is saved; string matches and entities' addresses come as
    two deliveries, whose edges alone are read."""
    df, root = derived(spark, sf_dir, "records"), fresh_path(spark, "components")
    none = F.lit(None).cast("string")
    own = df.withColumn("entity_clean_name", none)
    first = network.taxpayer_edges(own, replace(PARAMS, match_col=None))
    save_components(spark, network.components(first), root)
    grow_components(spark, network.taxpayer_edges(own, PARAMS), root, source="matches", batch=1)
    grow_components(spark, network.taxpayer_edges(df, PARAMS), root, source="entities", batch=1)
    return network.numbered(written(read_components(spark, root), "grown"))


@query
def landlord_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: the network of each record, with its name."""
    found = network.taxpayer_networks(derived(spark, sf_dir, "records"), [PARAMS], "rid")
    return found.select("rid", "clean_name", "final_component_1", "network_1", "network_1_short")


def _filings(spark: SparkSession, sf_dir: str, params: network.NetworkParams) -> DataFrame:
    """The component of each record with address variants, and of filings that share its owner's number."""
    df = derived(spark, sf_dir, "records").select(
        "rid", "clean_name", "exclude_name", "match_name", F.col("match_address_t").alias("match_address_v2"), F.col("is_validated_t").alias("is_validated"),
        F.col("is_researched_t").alias("is_researched"), F.col("exclude_address_t").alias("exclude_address"), F.col("is_org_address_t").alias("is_org_address"),
        (F.col("rid") % 10 == 0).alias("is_missing_suite"), (F.col("rid") % 12 == 0).alias("is_problem_suite"),
        F.when(F.col("rid") % 3 == 0, F.col("rid") % 50).alias("uid"),
    )
    filings = derived(spark, sf_dir, "llcs").select(
        (F.col("file_number") % 60).alias("uid"), F.concat(F.col("file_number") % 400, F.lit(" FILING RD")).alias("match_address_v2"),
        F.lit(True).alias("is_validated"), (F.col("file_number") % 3 > 0).alias("is_researched"), (F.col("file_number") % 29 == 0).alias("exclude_address"),
        F.lit(False).alias("is_org_address"), F.lit(False).alias("is_missing_suite"), F.lit(False).alias("is_problem_suite"),
    )
    parts = network.components(network.taxpayer_edges_with_filings(df, filings, params, spanning=True))
    return network.assign_components_with_filings(df, filings, parts, params, "rid").select("rid", "final_component_1")


# Statistics


@query
def networks_with_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filings(spark, sf_dir, network.NetworkParams(suffix="v2", ignored_entities=[]))


@query
def networks_with_filings_and_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with edges to what names and addresses were matched with."""
    return _filings(spark, sf_dir, network.NetworkParams(suffix="v2", ignored_entities=[], match_col="match_name"))


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.null_profile({n: derived(spark, sf_dir, n) for n in ("taxpayers", "corps", "llcs")})


@query
def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.load_table({n: derived(spark, sf_dir, n) for n in ("taxpayers", "corps", "llcs")})


@query
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tax, corps, llcs = taxpayers(spark, sf_dir), _named(derived(spark, sf_dir, "corps")), _named(derived(spark, sf_dir, "llcs"))
    records = tax.select(T.name_address("tax_name", "tax_street").alias("raw_name_address"))
    addrs = tax.select(F.col("tax_street").alias("raw_address"), Q.is_pobox("tax_street").alias("is_pobox"))
    return stats.data_clean(derived(spark, sf_dir, "properties"), records, corps, llcs, addrs).unionByName(stats.address_clean(addrs))


@query
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = C.make_upper("tax_name")
    tax = taxpayers(spark, sf_dir).select(F.when(F.col("id") % 3 == 0, "corp").when(F.col("id") % 7 == 0, "llc").alias("origin"), Q.is_llc(name).alias("is_llc"), Q.is_org(name).alias("is_org"))
    return stats.clean_merge(tax, derived(spark, sf_dir, "corps"), derived(spark, sf_dir, "llcs"))


def _by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the owners, in three batches, and of the corporations, in one."""
    root, owners = fresh_path(spark, "statistics"), taxpayers(spark, sf_dir).withColumn("name", C.make_upper("tax_name"))
    for i in range(3):
        add_statistics(spark, root, owners.where(F.col("id") % 3 == i), ["name", "tax_street", "tax_city", "tax_zip"], "owners", i)
    add_statistics(spark, root, derived(spark, sf_dir, "corps").select(F.upper("raw_name").alias("name"), "status"), ["name", "status"], "corps", 0)
    return statistics(spark, root)


@query
def merged_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_statistics(_by_batches(spark, sf_dir))


@query
def linked_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many names owners and corporations share, from what their batches left."""
    return linked_values(_by_batches(spark, sf_dir), ("owners", "name"), ("corps", "name"))


@query
def geocode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tax, corps = taxpayers(spark, sf_dir).select(F.col("tax_street").alias("clean_address")), derived(spark, sf_dir, "llcs").select(F.col("raw_agent_address").alias("clean_address"))
    return stats.geocoded(tax, corps, corps, tax)


@query
def match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "records").select(F.col("match_name").alias("string_matched_name_1"), F.col("entity_clean_name").alias("string_matched_name_2"))
    return stats.string_match(df, ["string_matched_name_1", "string_matched_name_2"])


@query
def network_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "records").select(F.nullif("match_address_t", F.lit("")).alias("network_1"), "entity_clean_name")
    return stats.network_graph(df.withColumnRenamed("entity_clean_name", "network_2"), ["network_1", "network_2"])


@query
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = derived(spark, sf_dir, "llcs").select(F.col("brand").alias("code"), F.col("kind").alias("category"), F.col("status").alias("description"))
    contract = Contract("class_codes", columns(*(f.name for f in CLASS_CODES.schema), required=("code",)), ("code",), {"description": ("0", "1")})
    return violations(codes, contract)
