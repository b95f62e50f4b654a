"""Published tables, growing components and saved matchers."""

import random

import pytest
from pyspark.sql import functions as F

from deedweb.operators import growth
from deedweb.operators import masters
from deedweb.operators import match as M
from deedweb.operators import sketches
from deedweb.operators import tables as T
from deedweb.sources import snapshots as S
from test_operators import union_find


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_failing_write_changes_nothing(spark, tmp_path):
    root = f"{tmp_path}/masters"
    assert S.snapshot(spark, root).version == 0 and S.versions(spark, root) == []
    first = S.publish(spark, root, {"owners": spark.range(3), "notes": spark.range(1)}, source="office", batch=4)
    assert first.version == 1
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        S.publish(spark, root, {"notes": spark.range(9), "owners": broken}, source="office", batch=5)
    now = S.snapshot(spark, root)
    assert now == first and rows(now.read(spark, "owners")) == [(0,), (1,), (2,)] and rows(now.read(spark, "notes")) == [(0,)]
    again = S.publish(spark, root, {"owners": spark.range(7)}, source="office", batch=4)
    assert again == first
    second = S.publish(spark, root, append={"owners": spark.range(10, 12)}, source="office", batch=5)
    assert rows(second.read(spark, "owners")) == [(0,), (1,), (2,), (10,), (11,)] and rows(second.read(spark, "notes")) == [(0,)]
    assert rows(S.snapshot(spark, root, 1).read(spark, "owners")) == [(0,), (1,), (2,)]


def test_of_two_writers_one_is_told(spark, tmp_path):
    root = f"{tmp_path}/masters"
    seen = S.publish(spark, root, {"owners": spark.range(1)})
    S.publish(spark, root, {"owners": spark.range(2)}, since=seen)
    with pytest.raises(Exception, match="exist"):
        S.publish(spark, root, {"owners": spark.range(3)}, since=seen)
    assert S.snapshot(spark, root).read(spark, "owners").count() == 2
    gone = S.expire(spark, root, keep=1)
    assert len(gone) == 2 and S.versions(spark, root) == [2] and S.snapshot(spark, root).read(spark, "owners").count() == 2


def test_tables_may_be_empty_and_partitioned(spark, tmp_path):
    root = f"{tmp_path}/masters"
    df = spark.createDataFrame([(1, "x", 0), (None, "y", 1)], "id long, name string, part int")
    S.publish(spark, root, {"t": df.limit(0)}, partition_by={"t": ["part"]})
    assert S.snapshot(spark, root).read(spark, "t").collect() == []
    S.publish(spark, root, append={"t": df}, partition_by={"t": ["part"]})
    assert sorted(map(str, S.snapshot(spark, root).read(spark, "t").select("id", "name", "part").collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_growing_components(spark, tmp_path, seed):
    """Any cut of the edges into deliveries gives the components of all of them."""
    rng, root = random.Random(seed), f"{tmp_path}/parts"
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(7, 7), (None, 3), (200, None), (-5, 119), (300, 301)]
    rng.shuffle(edges)
    deliveries = [edges[:25], [], edges[25:30], edges[30:60], edges[55:]]
    frame = lambda part: spark.createDataFrame(part, "src long, dst long")
    from deedweb.operators.components import connected_components

    growth.save_components(spark, connected_components(frame(deliveries[0])), root, buckets=8)
    for i, part in enumerate(deliveries[1:], 1):
        done = growth.grow_components(spark, frame(part), root, source="edges", batch=i)
        assert growth.grow_components(spark, frame(edges), root, source="edges", batch=i).snapshot == done.snapshot
        assert done.read <= min(8, 2 * len(part)) and done.merged <= len(part)
        want = union_find([e for p in deliveries[: i + 1] for e in p])
        assert dict(growth.read_components(spark, root).collect()) == want
    assert len(growth.read_components(spark, root, 1).collect()) == len(union_find(deliveries[0]))
    growth.compact_components(spark, root)
    assert dict(growth.read_components(spark, root).collect()) == union_find(edges)
    assert S.snapshot(spark, root).read(spark, "merges").count() == 0


def test_components_may_start_empty(spark, tmp_path):
    growth.save_components(spark, spark.createDataFrame([], "node string, component string"), f"{tmp_path}/p")
    growth.grow_components(spark, spark.createDataFrame([("b", "a"), ("c", "c")], "src string, dst string"), f"{tmp_path}/p")
    assert dict(growth.read_components(spark, f"{tmp_path}/p").collect()) == {"a": "a", "b": "a", "c": "c"}


def names(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcd ", k=rng.randint(3, 14))) for _ in range(n)]


@pytest.mark.parametrize("theta", [0.3, 0.6, 0.85])
def test_candidates_have_bounds(spark, theta):
    """No pair that reaches the threshold is missed, no bound is below a cosine, and bounds leave fewer pairs than meet."""
    df = spark.createDataFrame([(n,) for n in names(150)], "doc string")
    matcher = M.fit_matcher(df, params=M.StringMatchParams(threshold=theta))
    found = M.candidates(matcher.vectors.withColumn("least", F.lit(theta)), matcher.postings)
    scored = {(r["query"], r["original_doc"], r["matched_doc"]): r["conf1"] for r in M._dots(found, matcher.vectors, matcher.vectors).collect()}
    docs = dict(matcher.vectors.select("id", "doc").collect())
    for r in found.collect():
        assert scored[r["query"], docs[r["query"]], docs[r["ref"]]] <= r["bound"] + 1e-9
    near = {k[1:] for k, v in scored.items() if v >= theta - 1e-9}
    every = M._dots(found.sparkSession.createDataFrame([(a, b) for a in docs for b in docs], "query long, ref long"), matcher.vectors, matcher.vectors)
    assert near == {(r["original_doc"], r["matched_doc"]) for r in every.where(F.col("conf1") >= theta - 1e-9).collect()}
    leading = matcher.postings.where(F.col("tail") >= theta).select("gram", "ref")
    met = leading.join(leading.withColumnRenamed("ref", "other"), "gram").select("ref", "other").distinct().count()
    assert len(scored) < met


def test_saved_matcher(spark, tmp_path):
    """A saved matcher gives what one call gives, and no reference is shuffled."""
    refs = spark.createDataFrame([(n,) for n in names(80)] + [(None,)], "doc string")
    later = spark.createDataFrame([(n + " ab",) for n in names(40, 6)] + [(n,) for n in names(9)] + [(None,)], "text string")
    for params in (M.StringMatchParams(threshold=0.4, k=2), M.StringMatchParams(threshold=None, k=3, as_given=True)):
        path = f"{tmp_path}/it's {params.k}"
        M.save_matcher(M.fit_matcher(refs, params=params), path)
        loaded = M.load_matcher(spark, path)
        assert loaded.params == params
        got = [(*r[:2], *(round(x, 9) for x in r[2:])) for r in M.match_with(loaded, later, "text").collect()]
        want = [(*r[:2], *(round(x, 9) for x in r[2:])) for r in M.match_strings(refs, later, "doc", "text", params).collect()]
        assert sorted(got) == sorted(want) and got
    asked = M._asked(loaded, later, "text").withColumn("least", F.lit(0.4))
    joined = asked.select(F.inline("terms")).join(loaded.postings, "gram")
    plan = joined.hint("merge")._jdf.queryExecution().sparkPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asked.select(F.inline("terms")).join(loaded.postings, "gram")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(gram") == 1 and "Bucketed: true" in plan
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        M.load_matcher(spark, f"{tmp_path}/nothing")


@pytest.mark.parametrize("seed", [1, 2])
def test_deliveries_one_by_one(spark, tmp_path, seed):
    """Any cut into deliveries gives what merging all of them at once gives; buckets that a delivery does not touch stay as they are."""
    rng, root, columns = random.Random(seed), f"{tmp_path}/master", ["id", "name", "kind", "status", "note"]
    rows = [(i, rng.choice(["a", "b", "c", "d", "e", None]), rng.choice("xy"), rng.choice(["0", "1", "2", None, None]), rng.choice(["n", None, None])) for i in range(60)]
    rng.shuffle(rows)
    frame = lambda part: spark.createDataFrame(part, "id long, name string, kind string, status string, note string")
    keys, done = ["name", "kind"], []
    for i, part in enumerate([rows[:20], [], rows[20:21], rows[21:50], rows[50:], rows[:5]]):
        before = S.snapshot(spark, root)
        after = masters.apply_delivery(spark, root, frame(part), keys, "id", buckets=8, source="s", batch=i)
        assert masters.apply_delivery(spark, root, frame(rows), keys, "id", buckets=8, source="s", batch=i) == after
        done += part
        same = set(before.folders.get("master", [])) & set(after.folders["master"])
        assert len(after.folders["master"]) - len(same) <= len(part)
        got = sorted(map(str, masters.read_master(spark, root, columns, keys).collect()))
        assert got == sorted(map(str, T.merge_duplicates(frame(sorted(set(done), key=str)), keys, "id").select(*columns).collect()))
    assert S.expire(spark, root, keep=1) and masters.read_master(spark, root, columns, keys).count() == len(got)


def test_statistics_over_batches(spark, tmp_path):
    """Exact below the capacity, within the stated error above it; a batch that runs again counts once."""
    root = f"{tmp_path}/s"
    frame = lambda a, b: spark.range(a, b).select((F.col("id") % 900).alias("few"), F.col("id").alias("many"), F.when(F.col("id") % 5 > 0, F.lit("")).alias("gone"))
    for i in range(4):
        for _ in range(2):
            sketches.add_statistics(spark, root, frame(5000 * i, 5000 * (i + 1)), ["few", "many", "gone"], "a", i, capacity=12)
    sketches.add_statistics(spark, root, frame(300, 1500).where("few < 1000"), ["few", "many"], "b", 0, capacity=12)
    found = {(r.source, r.column): tuple(r)[2:] for r in sketches.total_statistics(sketches.statistics(spark, root), capacity=12).collect()}
    assert found["a", "few"] == (4, 20000, 0, 900) and found["a", "gone"] == (4, 20000, 20000, 0) and found["b", "many"] == (1, 1200, 0, 1200)
    assert found["a", "many"][:3] == (4, 20000, 0) and abs(found["a", "many"][3] - 20000) < 20000 * 4 / 64
    both = sketches.linked_values(sketches.statistics(spark, root), ("b", "few"), ("a", "few"), 12).first()
    assert tuple(both) == (900, 0, 0)
    some = sketches.linked_values(sketches.statistics(spark, root), ("b", "many"), ("a", "few"), 12).first()
    assert tuple(some) == (600, 600, 300)
    assert tuple(sketches.linked_values(sketches.statistics(spark, root), ("b", "many"), ("a", "gone"), 12).first()) == (0, 1200, 0)


@pytest.mark.parametrize("theta", [0.6, 0.75, 0.9])
def test_meetings_on_two_grams(spark, theta):
    """Every pair that reaches the threshold meets, short documents among them; far fewer meet than by single grams, and the join runs once."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    seconds = [word(6) for _ in range(5)]
    docs = [f"{word(7)} {rng.choice(seconds)} {rng.randrange(30)} MAIN ST" for _ in range(300)]
    docs += [d.replace(" MAIN ST", " OAK ST") for d in docs[:40]] + [d[:3] + "x" + d[4:] for d in docs[20:60]]
    docs += [word(k) for k in (1, 2, 2, 3, 3, 3, 4, 4) for _ in range(6)] + ["ab", "abc", "abcab", "ababab", "aaaa", "aaaaaaaa"]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    matcher = M.fit_matcher(df)
    v = matcher.vectors.select("id", "terms").collect()
    weights = {r["id"]: {t["gram"]: t["w"] for t in r["terms"]} for r in v}
    near = {(a, b) for a, x in weights.items() for b, y in weights.items() if sum(w * y.get(g, 0.0) for g, w in x.items()) >= theta}
    met = {tuple(r) for r in M.meetings(matcher.vectors, matcher.vectors, theta).collect()}
    assert near <= met
    once = {tuple(r) for r in M.meetings(matcher.vectors, matcher.vectors, theta, once=True).collect()}
    assert {p for p in near if p[0] < p[1]} <= once and all(a < b for a, b in once) and len(near) >= len(weights)
    some = spark.createDataFrame(sorted(near) + [(a, b) for a in list(weights)[:60] for b in weights], "query long, ref long").distinct()
    kept = {tuple(r) for r in M.likely(some, matcher.vectors, matcher.vectors, theta).collect()}
    assert near <= kept and len(kept) < some.count() / 4
    leading = matcher.postings.where(F.col("tail") >= theta).select("gram", "ref")
    single = leading.join(leading.withColumnRenamed("ref", "other"), "gram").where("ref <> other").select("ref", "other").distinct().count()
    assert len([p for p in met if p[0] != p[1]]) < single / 2
    found = M.similar_pairs(df, df, "doc", "doc", M.StringMatchParams(threshold=theta))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == len({(a, b) for a, x in weights.items() for b, y in weights.items() if sum(w * y.get(g, 0.0) for g, w in x.items()) >= theta - 1e-9})
