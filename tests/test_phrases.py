"""Dictionaries as tables, quarantine on load, and validated addresses in one join."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deedweb.functions import clean as C
from deedweb.operators import phrases as P
from deedweb.operators import tables as T
from deedweb.sources.tables import load_with_quarantine


def test_phrases_of_a_table(spark):
    """Against a loop over all names and phrases; short, empty, null and overlapping phrases, regular-expression characters."""
    rng = random.Random(4)
    words = ["FIRST", "NATL", "BANK", "OF", "A", "TRUST.CO", "(X", "É"]
    names = [" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(80)] + [None, "", " ", "F"]
    phrases = ["FIRST NATL", "FIRST", "T N", "ATL B", "K", "OF", "(X", ".", "É F", "NOWHERE", "", None, "FIRST NATL BANK OF A TRUST.CO"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    table = spark.createDataFrame([(p, f"<{p}>") for p in phrases if p is not None] + [(None, "x"), ("OF", "<a>")], "phrase string, standard string")
    hits = lambda n: [p for p in phrases if p and n is not None and p in n]
    flags = {r.id: r.is_bank for r in P.flag_phrases(df, "name", table).collect()}
    assert flags == {i: bool(hits(n)) for i, n in enumerate(names)}
    standard = {p: f"<{p}>" for p in phrases if p} | {"OF": "<OF>"}
    standard["OF"] = min("<OF>", "<a>")
    got = {r.id: r.name for r in P.fix_names_by_table(df, "name", table).collect()}
    listed = {r.id: r.name for r in df.select("id", C.fix_names("name", standard).alias("name")).collect()}
    assert got == listed and any(got[i] != n for i, n in enumerate(names))
    none = table.limit(0)
    assert P.flag_phrases(df, "name", none).where("is_bank").count() == 0 and P.fix_names_by_table(df.limit(0), "name", table).collect() == []


def test_words_of_a_table(spark):
    df = spark.createDataFrame([(1, "ACME LLC"), (2, "ACMELLC"), (3, None), (4, "LLC"), (4, "LLC")], "id int, name string")
    words = spark.createDataFrame([("LLC",), ("LLC",), (None,)], "word string")
    assert sorted((r.id, r.is_org) for r in P.flag_words(df, "name", words).collect()) == [(1, True), (2, False), (3, False), (4, True), (4, True)]


def test_quarantine(spark, tmp_path):
    """Good and bad rows add up to the records of the files, and say which file they are from."""
    schema = StructType().add("id", "long").add("name", "string").add("price", "double")
    for i, lines in enumerate((["1,a,1.5", "2,b,dear", "3,c", '4,"d, ""e""",2', "5,f,1,9"], ["6,,3", ",g,4", "", "x,h,5"])):
        (tmp_path / f"{i}.csv").write_text("\n".join(["id,name,price", *lines]) + "\n")
    good, bad = load_with_quarantine(spark, f"{tmp_path}/*.csv", schema, required=["id", "name"])
    assert sorted(map(tuple, good.collect())) == [(1, "a", 1.5), (4, 'd, "e"', 2.0)]
    found = Counter((r.file.rsplit("/", 1)[1], r.reason) for r in bad.collect())
    assert found == {("0.csv", "malformed"): 3, ("1.csv", "missing: name"): 1, ("1.csv", "missing: id"): 1, ("1.csv", "malformed"): 1}
    assert "2,b,dear" in {r.record for r in bad.collect()}
    (tmp_path / "a.json").write_text('{"id": 1, "name": "a", "price": 2}\n{"id": 2, "na\n{"id": "x"}\n{"name": "b"}\n')
    good, bad = load_with_quarantine(spark, f"{tmp_path}/a.json", schema, "json", ["id"])
    assert good.count() == 1 and Counter(r.reason for r in bad.collect()) == {"malformed": 2, "missing: id": 1}
    assert json.loads(bad.where("reason = 'missing: id'").first().record) == {"name": "b"}
    good, bad = load_with_quarantine(spark, f"{tmp_path}/a.json", schema, "json")
    assert good.count() == 2 and bad.count() == 2


def test_validated_addresses_of_all_columns(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "a"), (3, "c", None), (4, None, None), (4, None, None)], "id int, x string, y string")
    valid = spark.createDataFrame([("a", "A2"), ("a", "A1"), ("b", "B"), (None, "N")], "clean_address string, formatted_address string")
    got = T.merge_validated_addrs(df, valid, ["x", "y"])
    assert got.columns == ["id", "x", "y", "x_v", "y_v"]
    assert sorted((r.id, r.x_v, r.y_v) for r in got.where("id < 4").collect()) == [(1, "A1", "B"), (2, None, "A1"), (3, None, None)]
    assert [(r.x_v, r.y_v) for r in got.where("id = 4").collect()] == [(None, None)] * 2
    wide = T.merge_validated_addrs(df.withColumn("more", F.lit("x" * 50)), valid, ["x", "y"])
    assert wide.count() == 5
