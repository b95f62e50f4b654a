import random

import pytest
from pyspark.sql import functions as F

from deedweb.operators import components as C
from deedweb.operators import network


def edges_of(spark, rows):
    return spark.createDataFrame(rows, "src long, dst long")


def test_rounds_shrink(spark, monkeypatch):
    """On a path in order, where every node has a smaller neighbour: all rounds together have but a few times its edges."""
    sizes, once = [], C._round

    def counted(*args):
        found = once(*args)
        sizes.append(found[1])
        return found

    monkeypatch.setattr(C, "_round", counted)
    found = C.connected_components(spark.range(3000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")))
    assert found.where("component = 0").count() == 3001 == found.count()
    assert sizes[0] == 3000 and sum(sizes) < 4 * sizes[0]


def test_shared_numbers_are_seen(spark, monkeypatch):
    """Nodes whose hashes agree under one salt are numbered by another."""
    real = F.xxhash64
    clash = lambda *cols: F.when(F.lit(True), cols[1] % 3 if str(cols[0]._jc) == "0" else real(*cols)).cast("long")
    ends = spark.createDataFrame([([a, a + 10],) for a in range(10)], "e array<long>")
    monkeypatch.setattr(C.F, "xxhash64", clash)
    names, _, _ = C._numbers(ends)
    assert names.select("id").distinct().count() == 20


@pytest.mark.parametrize("seed", [1, 2])
def test_filings_tie_by_a_tree(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame([(f"N{rng.randrange(30)}", "", False, rng.choice([None, *range(4)])) for _ in range(80)], "clean_name string, match_address_v1 string, exclude_name boolean, uid int")
    df = df.withColumns({c: F.lit(True) for c in ("is_validated", "is_researched")} | {c: F.lit(False) for c in ("exclude_address", "is_org_address", "is_missing_suite", "is_problem_suite")})
    filings = spark.createDataFrame([(rng.randrange(6), f"{rng.randrange(40)} ST") for _ in range(80)], "uid int, match_address_v1 string")
    filings = filings.withColumns({c: F.lit(True) for c in ("is_validated", "is_researched")} | {c: F.lit(False) for c in ("exclude_address", "is_org_address", "is_missing_suite", "is_problem_suite")})
    params = network.NetworkParams(suffix="v1")
    whole, tree = (network.taxpayer_edges_with_filings(df, filings, params, spanning=s) for s in (False, True))
    labels = [sorted(map(tuple, network.components(e).collect())) for e in (whole, tree)]
    assert labels[0] == labels[1]
    assert tree.where("src <> dst").count() < whole.where("src <> dst").count() / 3
