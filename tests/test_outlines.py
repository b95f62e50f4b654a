import random

import pytest
from pyspark.sql import functions as F

from deedweb.operators import match as M
from deedweb.scratch import written


def owners(n=900, seed=3):
    """Groups of three that differ in a number; many share their second word."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    seconds, out = [word(6) for _ in range(25)], []
    for i in range(n // 3):
        first, second = word(7), rng.choice(seconds)
        out += [f"{first} {second} - {(3 * i + j) % 97} {('MAIN', 'OAK', 'RIVER')[i % 3]} ST" for j in range(3)]
    return out + ["ab", "abc", "aaaa"]


def cosines(matcher):
    weights = {r["doc"]: {t["gram"]: t["w"] for t in r["terms"]} for r in matcher.vectors.collect()}
    return {(a, b): sum(w * y.get(g, 0.0) for g, w in x.items()) for a, x in weights.items() for b, y in weights.items()}


@pytest.mark.parametrize("theta", [0.6, 0.75])
def test_hardly_more_pairs_leave_than_are_near(spark, theta, monkeypatch):
    """Outlines keep every near pair, and few others leave the join, in however many turns keys meet."""
    matcher = M.fit_matcher(spark.createDataFrame([(d,) for d in owners()], "doc string"))
    v, docs = matcher.vectors, dict(matcher.vectors.select("id", "doc").collect())
    near = {p for p, c in cosines(matcher).items() if c >= theta}
    named = lambda df: [(docs[r["query"]], docs[r["ref"]]) for r in df.collect()]
    found = named(M.meetings(v, v, theta))
    assert near <= set(found) and len(found) == len(set(found)) <= 1.03 * len(near)
    monkeypatch.setattr(M, "TURN", 40_000)
    asked = v.where(v["id"] >= 0)  # another table than the references
    assert sorted(named(M.meetings(asked, v, theta))) == sorted(found)
    once = named(M.meetings(v, v, theta, once=True))
    assert len(once) == len(set(once)) and {p for p in found if p[0] != p[1]} == {*once, *((b, a) for a, b in once)}


@pytest.mark.parametrize("few", [0, M.FEW])
def test_nearest_in_steps(spark, few, monkeypatch):
    """Queries that have their nearest at a higher threshold are done; the result is that of brute force."""
    monkeypatch.setattr(M, "FEW", few)
    df = spark.createDataFrame([(d,) for d in owners(150)], "doc string")
    params = M.StringMatchParams(threshold=0.6, k=2)
    matcher = M.fit_matcher(df, params=params)
    every = cosines(matcher)
    want = {}
    for a in {a for a, _ in every}:
        best = sorted(((-round(c, 12), b) for (x, b), c in every.items() if x == a and c >= 0.6 - 1e-9))[:2]
        want |= {(a, b): round(-c, 9) for c, b in best if a != b and 0.6 < -c < 1 - 1e-9}
    for found in (M.match_strings(df, df, params=params), M.match_with(matcher, df.where("doc is not null"))):
        assert {(r["original_doc"], r["matched_doc"]): round(r["conf1"], 9) for r in found.collect()} == want


def test_written_tables_leave_no_shuffle_files(spark):
    files = lambda: sum(f.getName().startswith("shuffle_") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()))
    before = files()
    table = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    assert files() <= before and table.count() == 7
