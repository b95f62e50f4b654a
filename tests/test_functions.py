"""Column functions against tables of examples and plain-Python twins."""

import random
import re

import pytest
from pyspark.sql import functions as F

from deedweb.functions import address as A
from deedweb.functions import classify as Q
from deedweb.functions import clean as C
from deedweb.functions import constants as K
from deedweb.functions.tokens import ngrams, title_case

EXAMPLES = [
    (C.make_upper, "Smith LLC", "SMITH LLC"),
    (C.remove_symbols_punctuation, "Smith & Sons, LLC.", "Smith  AND  Sons  LLC "),
    (C.remove_symbols_punctuation, "Fast-Food/Cafe", "Fast-Food/Cafe"),
    (C.trim_whitespace, "\t a b \n", "a b"),
    (C.strip_dashes, "--a-b-", "a-b"),
    (C.empty_to_null, "", None),
    (C.remove_extra_spaces, "BLOOMINGTON  MN   55439", "BLOOMINGTON MN 55439"),
    (C.fix_llcs, "OAK L L C", "OAK LLC"),
    (C.words_to_num, "SEVEN", "7"),
    (C.words_to_num, "ONE HUNDRED TWENTY FIVE", "125"),
    (C.words_to_num, "TWO THOUSAND AND SIX", "2006"),
    (C.words_to_num, "POINT", "POINT"),
    (C.words_to_num, "OAK SEVEN", "OAK SEVEN"),
    (C.words_to_num, "", ""),
    (C.deduplicate, "FIRST FIRST SECOND SECOND TRUST", "FIRST SECOND TRUST"),
    (C.convert_ordinals, "TENTH STREET", "10TH STREET"),
    (C.convert_ordinals, "WEST TENTH STREET", "WEST 10TH STREET"),
    (C.convert_ordinals, "EAST TWENTY FIFTH STREET", "EAST 25TH STREET"),
    (C.convert_ordinals, "FORTY SECOND AVENUE NORTH", "42ND AVENUE NORTH"),
    (C.convert_ordinals, "SOUTH ONE HUNDREDTH STREET", "SOUTH 100TH STREET"),
    (C.convert_ordinals, "TWENTY OAKS", "TWENTY OAKS"),
    (C.convert_ordinals, "TWELFTH", "12TH"),
    (C.take_first, "123-456 MAIN ST", "123 MAIN ST"),
    (C.take_first, "MAIN ST", "MAIN ST"),
    (C.combine_numbers, "1 2 3 MAIN", "123 MAIN"),
    (C.combine_numbers, "20 15 OAK", "2015 OAK"),
    (C.combine_numbers, "20 1 5 OAK", "215 OAK"),
    (C.combine_numbers, "NO 1 2 WAY", "NO 12 WAY"),
    (C.switch_the, "SMITH LLC THE", "THE SMITH LLC"),
    (C.switch_the, "THE CORPORATION", "THE CORPORATION"),
    (C.convert_nsew, "NORTH MAIN STREET", "N MAIN STREET"),
    (C.convert_nsew, "123 SOUTH WEST AVE", "123 S WEST AVE"),
    (C.convert_nsew, "NORTH WEST BUILDING", "NORTH WEST BUILDING"),
    (C.remove_secondary_designators, "123 MAIN ST #4B", "123 MAIN ST 4B"),
    (C.remove_secondary_designators, "456 OAK AVE APT 7", "456 OAK AVE 7"),
    (C.remove_secondary_designators, "12 UNIT 4", "12 UNIT 4"),
    (C.convert_street_suffixes, "789 PINE BOULEVARD", "789 PINE BLVD"),
    (C.fix_zip, "123", "00123"),
    (C.fix_zip, "123456789", "12345-6789"),
    (C.fix_zip, "1234567", "12345"),
    (C.fix_zip, "12A34", ""),
    (C.check_sec_num, "12 OAK 45, CHICAGO", "45"),
    (C.check_sec_num, "12 OAK ST, CHICAGO", None),
    (C.fix_mpls, "MPLS MNPLS", "MINNEAPOLIS MINNEAPOLIS"),
    (C.fix_directionals, "SOUTH WEST", "SW"),
    (C.fix_directionals, "SOUTH PARK", "SOUTH PARK"),
    (C.drop_letters, "123A MAIN ST 10TH", "123 MAIN ST 10TH"),
    (lambda c: C.drop_letters(c, literal=True), "12A OAK 34B", "12 OAK 12"),
    (C.convert_mixed, "55 THIRTY AVE", "55 30 AVE"),
    (C.convert_mixed, "1 HUNDRED STREET", "1 100 STREET"),
    (C.remove_secondary_component, "456 OAK AVE APT 7", "456 OAK AVE"),
    (C.remove_secondary_component, "12 FLOWER ST", "12 FLOWER ST"),
    (lambda c: C.remove_secondary_component(c, literal=True), "12 FLOWER ST", "12"),
    (lambda c: C.core_name(C.make_upper(c)), "Oak Grove Properties", "OAK GROVE"),
    (C.core_name, "ZINC LLC", "ZINC"),
    (lambda c: C.core_name(c, literal=True), "ZINC LLC", "Z"),
    (C.fix_states, "MINNESOTA", "MN"),
    (lambda c: C.fix_states(c, {"MINN": "MN"}), "MINN", "MN"),
    (lambda c: C.fix_names(c, {"CHICAGO TITLE": "CHICAGO TITLE LAND TRUST COMPANY"}), "CHICAGO TITLE LND", "CHICAGO TITLE LAND TRUST COMPANY LND"),
    (C.null_tokens, " N/A ", None),
    (title_case, "3rd o'neil", "3Rd O'Neil"),
    (A.fix_pobox, "P O BOX #12, CHICAGO", "PO BOX 12, CHICAGO"),
    (A.fix_pobox, "POST OFFICE BOX 99 TX DEPT 7, X", "PO BOX 99 TAX DEPT 7, X"),
    (A.fix_pobox, "12 OAK ST, X", "12 OAK ST, X"),
]
FLAGS = [
    (Q.is_pobox, "P.O. BOX 1", False),
    (Q.is_pobox, "PO BOX 1", True),
    (Q.is_trust, "JONES FAMILY TRUST", True),
    (Q.is_trust, "TRUMAN", False),
    (Q.is_org, "OAK LLC", True),
    (Q.is_llc, "OAKLLC", True),
    (lambda c: Q.is_bank(c, ["BANK"]), "CITYBANK", True),
    (lambda c: Q.is_person(c, ["JOHN", "SMITH"]), "JOHN SMITH JR", True),
    (lambda c: Q.is_person(c, ["JOHN", "SMITH"]), "JOHN JR", False),
    (Q.is_irregular_zip, "FRANCE", True),
    (Q.is_irregular_zip, "12345-6789", False),
    (Q.is_irregular_state, " MN ", False),
    (Q.is_not_secondary_number, "25715 COUNTY RD 136, ST CLOUD, MN 56301", True),
    (Q.is_not_secondary_number, "1 DUPONT HWY 5", False),
    (Q.is_not_secondary_number, "1 OAK 5", False),
    (Q.is_invalid_street, "12, X", True),
    (Q.is_unit_gte_1, " 2 ", True),
    (Q.is_unit_gte_1, "1", False),
    (Q.is_unit_gte_1, "many", False),
    (C.is_int, "-12", True),
    (C.is_encoded_empty, "a\x01", True),
    (C.coerce_boolean, " YES ", True),
    (lambda c: Q.has_rental_class(c, ["2"]), "1, 2", True),
]


@pytest.mark.parametrize("cases", [EXAMPLES, FLAGS])
def test_examples(spark, cases):
    for function, given, wanted in cases:
        row = spark.createDataFrame([(given,), (None,)], "c string").select(function(F.col("c")).alias("v")).collect()
        assert row[0]["v"] == wanted, (given, row[0]["v"])
        if cases is EXAMPLES:
            assert row[1]["v"] is None
        else:
            assert row[1]["v"] is (function in (Q.is_irregular_zip, Q.is_irregular_state))


def twin_nsew(text):
    words, i = text.split(), 0
    out = list(words)
    while i < len(words):
        if words[i] in K.DIRECTIONS:
            if i + 1 < len(words) and words[i + 1] in K.DIRECTIONS:
                if i + 2 < len(words) and words[i + 2] in K.STREET_SUFFIXES.values():
                    out[i] = K.DIRECTIONS[words[i]]
                i += 2
                continue
            out[i] = K.DIRECTIONS[words[i]]
        i += 1
    return " ".join(out)


def twin_numbers(text):
    out, run = [], []
    for word in [*text.split(), None]:
        if word is not None and re.fullmatch(r"[+-]?\d+", word):
            run.append(word)
            continue
        if run:
            first = run[0][:-1] if len(run) > 2 and run[0].endswith("0") else run[0]
            out.append(first + "".join(run[1:]))
            run = []
        out.append(word)
    return " ".join(out[:-1])


def twin_grams(text, n=3):
    text = text.encode("ascii", "ignore").decode().lower()
    text = re.sub(r"[)(.|\[\]{}']", "", text).replace("&", "and").replace(",", " ").replace("-", " ").title()
    text = f" {re.sub(' +', ' ', text).strip()} "
    return [text[i : i + n] for i in range(len(text) - n + 1)]


def test_twins(spark):
    rng = random.Random(7)
    words = ["NORTH", "WEST", "SOUTH", "AVE", "ST", "OAK", "1", "20", "305", "-4", "x-3rd", "é&b", "(a)"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 7))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    rows = df.select("c", C.convert_nsew("c").alias("nsew"), C.combine_numbers("c").alias("numbers"), ngrams("c").alias("grams")).collect()
    for r in rows:
        assert r["nsew"] == twin_nsew(r["c"])
        assert r["numbers"] == twin_numbers(r["c"])
        assert r["grams"] == twin_grams(r["c"])


def test_cleaners_are_idempotent(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit(" a  MPLS a "), "c_name").alias("c"))
    for f in (C.make_upper, C.trim_whitespace, C.remove_extra_spaces, C.deduplicate, C.fix_mpls):
        assert df.select(f("c").alias("x")).where(F.col("x") != f("x")).count() == 0


def test_clean_takes_any_function(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert C.clean(df, F.upper).first() == ("A", "B")
    assert C.clean(df, lambda c: F.concat(c, c), ["y"]).first() == ("a", "bb")


def test_addresses(spark):
    parts = dict(number="12", number_suffix=None, predirectional="N", prefix="", street="OAK", suffix="ST", postdirectional=None,
                 secondary_unit="APT", secondary_number="4", city="CHICAGO", state="IL", zip_code="60601", formatted_address="given")
    schema = ", ".join(f"{k} string" for k in parts)
    rows = [parts, parts | {"street": "PO BOX", "secondary_number": ""}, parts | {"city": None}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    made = df.select(*(c.alias(n) for n, c in A.formatted_addresses(or_given=True).items()), A.short_address().alias("short"), A.fix_formatted_address_unit().alias("fixed")).collect()
    assert made[0]["formatted_address_v0"] == "12 N OAK ST, APT 4, CHICAGO, IL 60601"
    assert made[0]["formatted_address_v1"] == "12 N OAK ST, 4, CHICAGO, IL 60601"
    assert made[0]["formatted_address_v4"] == "12 OAK ST, CHICAGO, IL 60601"
    assert made[0]["short"] == "12 N OAK ST APT 4" and made[0]["fixed"] == "given, APT 4, CHICAGO, IL 60601"
    assert made[1]["formatted_address_v0"] == "PO BOX 12, CHICAGO, IL 60601"
    assert made[2]["formatted_address_v2"] == "given"
    other = spark.createDataFrame([("1 A", None, "C", None, "60601", False), (None, "x", "C", "IL", None, True)],
                                  "street_1 string, street_2 string, city string, state string, zip_code string, is_incomplete_address boolean")
    got = other.select(A.filing_address().alias("a"), A.filing_street("street_1", "street_2").alias("s"), Q.is_incomplete_address().alias("i"), A.matching_address("street_2", "street_1").alias("m")).collect()
    assert [tuple(r) for r in got] == [("1 A, C, 60601", "1 A", False, "1 A"), (None, None, True, "x")]
