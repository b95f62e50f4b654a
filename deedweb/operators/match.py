"""String matching: exact TF-IDF cosine over character n-grams by an inverted-index join."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deedweb.functions.tokens import let, ngrams, token_at, tokens
from deedweb.operators.components import connected_components
from deedweb.scratch import discard, written


@dataclass(frozen=True)
class StringMatchParams:
    """``threshold``: least cosine of a match (None: the ``k`` nearest, whatever their cosine). ``k``: nearest references for each query. ``n``: characters of a
    gram. ``as_given``: repeated references raise the document counts as often as they occur."""

    threshold: float | None = 0.85
    k: int = 3
    n: int = 3
    as_given: bool = False


#: The least weight ``idf`` of a rare gram: about a twentieth of the references have it.
RARE = 4.0


def gram_counts(docs: DataFrame, n: int) -> DataFrame:
    """``doc, gram, tf`` of distinct documents ``doc``."""
    return docs.select("doc", F.explode(ngrams("doc", n)).alias("gram")).groupBy("doc", "gram").agg(F.count(F.lit(1)).alias("tf"))


def _dealt(docs: DataFrame) -> DataFrame:
    """By number, so that adaptive execution does not join partitions: rows are short, and what is made of each is long work. One more than Spark's own
    partitions, else Spark would take the exchange that made documents distinct in place of this one."""
    return docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, "doc")


def fit_weights(refs: DataFrame, params: StringMatchParams) -> DataFrame:
    """``gram, df, idf`` over reference documents ``doc, copies``: ln((1 + N) / (1 + df)) + 1."""
    weight = F.col("copies") if params.as_given else F.lit(1)
    grams = _dealt(refs).select("copies", F.explode(F.array_distinct(ngrams("doc", params.n))).alias("gram"))
    df = grams.groupBy("gram").agg(F.sum(weight).alias("df"))
    total = refs.agg(F.sum(weight).alias("total"))  # one row
    return df.crossJoin(F.broadcast(total)).select("gram", "df", (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1).alias("idf"))


def vectors(docs: DataFrame, weights: DataFrame, params: StringMatchParams) -> DataFrame:
    """``doc, terms``: the known grams of each document with unit-length weights, rarest first, with ``tail``, the length
    of what is left from each on, and with ``rare``, whether few references have the gram.

    Documents are dealt before they are cut, so grams are not shuffled unless there are too many weights to broadcast."""
    rows = gram_counts(_dealt(docs).select("doc"), params.n).join(weights, "gram")
    rows = rows.select("doc", "gram", "df", (F.col("tf") * F.col("idf")).alias("w"), (F.col("idf") >= RARE).alias("rare"))
    terms = F.array_sort(F.collect_list(F.struct("df", "gram", "w", "rare"))).alias("terms")
    rows = _dealt(rows)  # falls away where they are dealt by it
    rows = rows.groupBy("doc").agg(terms, F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    start = F.struct(F.lit(1.0).alias("left"), F.array().cast("array<struct<gram: string, w: double, tail: double, rare: boolean>>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        w = t["w"] / F.col("norm")
        term = F.struct(t["gram"].alias("gram"), w.alias("w"), F.sqrt(F.greatest(s["left"], F.lit(0.0))).alias("tail"), t["rare"].alias("rare"))
        return F.struct((s["left"] - w * w).alias("left"), F.concat(s["out"], F.array(term)).alias("out"))

    return rows.select("doc", F.aggregate("terms", start, step, lambda s: s["out"]).alias("terms"))


def _distinct(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("doc")).agg(F.count(F.lit(1)).alias("copies"))


# A matcher: what is known of the references


@dataclass(frozen=True)
class Matcher:
    """``weights``: ``gram, df, idf``. ``vectors``: ``id, doc, terms`` of the references. ``postings``: ``gram, ref, w, tail, rest``, a
    row for each term; ``rest`` is the length of what is left after it."""

    params: StringMatchParams
    weights: DataFrame
    vectors: DataFrame
    postings: DataFrame


def _postings(side: DataFrame, name: str, *more: str) -> DataFrame:
    after = lambda i: F.coalesce(F.try_element_at("terms", i + 2)["tail"], F.lit(0.0))  # noqa: E731  (i counts from 0, places from 1)
    rows = F.transform("terms", lambda t, i: F.struct(t["gram"].alias("gram"), t["w"].alias("w"), t["tail"].alias("tail"), after(i).alias("rest")))
    return side.select(F.col("id").alias(name), *more, F.inline(rows))


def _vectors(docs: DataFrame, weights: DataFrame, params: StringMatchParams, name: str) -> DataFrame:
    return written(vectors(docs, weights, params).withColumn("id", F.monotonically_increasing_id()), name)


def fit_matcher(refs: DataFrame, ref_col: str = "doc", params: StringMatchParams = StringMatchParams()) -> Matcher:
    """Weights and vectors of the references. Null references are left out; repeated ones count once, or as often as they occur
    (``as_given``)."""
    docs = _distinct(refs, ref_col)
    weights = written(fit_weights(docs, params), "gram-weights")
    found = _vectors(docs, weights, params, "reference-vectors")
    return Matcher(params, weights, found, _postings(found, "ref"))


#: The tables of a saved matcher and what each is bucketed and sorted by.
SAVED = {"weights": "gram", "postings": "gram", "vectors": "id"}


def save_matcher(matcher: Matcher, path: str, buckets: int | None = None) -> None:
    """Writes the tables below ``path``, bucketed by gram (vectors by id). ``params`` comes last: a folder without it is not a
    matcher. With as many buckets as the queries' joins have partitions (the default), a match below ``PAIRED`` moves no row of the references."""
    spark = matcher.weights.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, key in SAVED.items():
        table = f"matcher_{uuid.uuid4().hex}"
        rows = getattr(matcher, name).repartition(buckets, key)
        rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{name}").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay; a matcher is its folder
    p = matcher.params
    row = spark.range(1).select(*(F.lit(v).cast(t).alias(n) for n, v, t in (
        ("threshold", p.threshold, "double"), ("k", p.k, "int"), ("n", p.n, "int"), ("as_given", p.as_given, "boolean"), ("buckets", buckets, "int"),
    )))
    row.coalesce(1).write.parquet(f"{path}/params")


def load_matcher(spark: SparkSession, path: str) -> Matcher:
    """A saved matcher, in this session or another; its tables are known to Spark as bucketed."""
    given = spark.read.parquet(f"{path}/params").first().asDict()
    buckets = given.pop("buckets")
    tables = {}
    for name, key in SAVED.items():
        table = f"matcher_{uuid.uuid4().hex}"
        kinds = ", ".join(f"`{c}` {t}" for c, t in spark.read.parquet(f"{path}/{name}").dtypes)
        where = f"{path}/{name}".replace("'", r"\'")
        spark.sql(f"CREATE TABLE {table} ({kinds}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{where}'")
        tables[name] = spark.table(table)
    return Matcher(StringMatchParams(**given), **tables)


def _asked(matcher: Matcher, queries: DataFrame, query_col: str) -> DataFrame:
    """The vectors of queries: ``id, doc, terms``. Grams that no reference has are left out."""
    return _vectors(_distinct(queries, query_col), matcher.weights, matcher.params, "query-vectors")


def candidates(q: DataFrame, postings: DataFrame, once: bool = False) -> DataFrame:
    """``query, ref, met, bound``: the pairs that may reach the query's threshold ``least`` (a column of ``q``).

    Grams are in one order on both sides, rarest first; a pair that reaches the threshold shares a leading gram, one from which on
    both vectors are at least that long. Products of weights are added up while leading grams meet (``met``). All other shared
    grams come after the last of these, and where one side's leading grams end they are past them: what is left of the two
    vectors bounds the rest, so ``bound`` is at least the cosine. Pairs below the threshold by their bound go before any vector
    is fetched. With ``once``, q and the references are one table, and a pair is made in one order only.
    """
    end = F.coalesce(F.array_max(F.transform(F.filter("terms", lambda t: t["tail"] < F.col("least") - 1e-9), lambda t: t["tail"])), F.lit(0.0))
    asked = _postings(q.withColumn("end", end), "query", "least", "end").where(F.col("tail") >= F.col("least") - 1e-9)
    asked = asked.select("gram", "query", "least", "end", F.col("w").alias("query_w"), F.col("rest").alias("query_rest"))
    both = asked.join(postings, "gram").where(F.col("tail") >= F.col("least") - 1e-9)
    if once:
        both = both.where(F.col("query") <= F.col("ref"))
    met = both.groupBy("query", "ref").agg(
        F.sum(F.col("query_w") * F.col("w")).alias("met"),
        F.min("query_rest").alias("query_rest"), F.min("rest").alias("rest"), F.first("least").alias("least"), F.first("end").alias("end"),
    )
    later = F.greatest(F.col("end") * F.col("rest"), F.col("query_rest") * F.least("rest", F.greatest("least", F.lit(0.0))))
    bounded = met.select("query", "ref", "met", (F.col("met") + later).alias("bound"), "least")
    return bounded.where(F.col("bound") >= F.col("least") - 1e-9).drop("least")


#: Thresholds from which pairs meet on two grams at once (see ``meetings``); below, half of a vector may be missing and single grams lead.
PAIRED = 0.55
#: Where queries times references are no more, single grams lead at any threshold: keys of two grams are made of all references, however few queries are left.
FEW = 1_000_000_000
#: The first and the ``FAR``-th shared gram of a pair are its key.
FAR = 5


#: Rows of keys that meet at once. More are dealt into turns, so that disk holds the shuffled rows of one turn only.
TURN = 15_000_000


#: 64-bit words of an outline, and the bits of a place.
WORDS, BITS = 2, 3
OUTLINE = [*(f"p{w}_{j}" for w in range(WORDS) for j in range(BITS)), "unit"]


def _outline() -> Column:
    """A struct of ``OUTLINE`` for a vector: its rare grams dealt to places by hash. The bits of a place count how many ``unit`` the squared weight
    there has at least: the lightest rare gram has two, seven is the most. So every rare gram sets a bit of its place, and where grams share a
    place, joined bits are no more than their sum."""
    grams = F.transform(F.filter("terms", lambda t: t["rare"]), lambda t: F.struct(F.pmod(F.hash(t["gram"]), F.lit(64 * WORDS)).alias("p"), (t["w"] * t["w"]).alias("m")))
    unit = F.array_min(F.transform(grams, lambda t: t["m"])) / 2

    def coded(s: Column) -> Column:
        return F.transform(s["g"], lambda t: F.struct(t["p"].alias("p"), F.least(F.floor(t["m"] / s["u"]), F.lit((1 << BITS) - 1)).cast("long").alias("c")))

    def word(s: Column, w: int, j: int) -> Column:
        own = F.filter(s["c"], lambda t: F.shiftright(t["p"], 6) == w)
        bit = lambda t: F.call_function("shiftleft", F.shiftright(t["c"], j).bitwiseAND(F.lit(1).cast("long")), F.pmod(t["p"], F.lit(64)))
        return F.aggregate(own, F.lit(0).cast("long"), lambda x, t: x.bitwiseOR(bit(t))).alias(f"p{w}_{j}")

    codes = let({"g": grams, "u": unit}, lambda s: F.struct(coded(s).alias("c"), F.coalesce(s["u"], F.lit(0.0)).cast("float").alias("unit")))
    return let({"s": codes}, lambda s: F.struct(*(word(s["s"], w, j) for w in range(WORDS) for j in range(BITS)), s["s"]["unit"].alias("unit")))


def _meeting_keys(side: DataFrame, least: float) -> DataFrame:
    """``key, id, reach`` and ``OUTLINE``: the keys under which a vector meets others, the length of what they may share there (see
    ``meetings``), and its outline. Keys are hashes: two that agree by chance only let more pairs meet. Rows of a vector stand together, so its
    outline takes little room in a file."""
    need = least * least - 1e-9
    start = F.array().cast("array<struct<gram: string, after: int, m: double, left: double, next: double, peak: double, two: double, three: double>>")

    def step(out: Column, t: Column) -> Column:  # from the last gram to the first
        m, before = t["w"] * t["w"], lambda k, c: F.coalesce(F.try_element_at(out, F.lit(k))[c], F.lit(0.0))
        two = before(1, "peak") + before(2, "peak")
        known = {"gram": t["gram"], "after": F.size(out), "m": m, "left": t["tail"] * t["tail"], "next": before(1, "left"), "peak": F.greatest(m, before(1, "peak")), "two": two, "three": two + before(3, "peak")}
        return F.concat(F.array(F.struct(*(v.alias(n) for n, v in known.items()))), out)

    made = lambda kind, mass, *grams: F.struct(F.xxhash64(F.lit(kind), *grams).alias("key"), F.sqrt(mass).cast("float").alias("reach"))
    far = lambda a, b: b["left"] + a["m"] + F.least(a["three"], a["next"] - b["left"])
    near = lambda a, b: F.least(b["left"] + a["m"], a["m"] + b["m"] + b["two"])

    def pairs(s: Column, first: Callable[[Column], Column], gap: int, mass: Callable[[Column, Column], Column], kind: str) -> Column:
        n = F.size(s["t"])
        others = lambda a: F.filter(F.slice(s["t"], n - a["after"] + gap, n), lambda b: mass(a, b) >= need)
        return F.flatten(F.transform(F.filter(s["t"], first), lambda a: F.transform(others(a), lambda b: made(kind, mass(a, b), a["gram"], b["gram"]))))

    def keys(s: Column) -> Column:
        five = pairs(s, lambda a: a["left"] >= need, FAR - 1, far, "5")
        small = pairs(s, lambda a: (a["left"] >= need) & (a["m"] + a["three"] >= need), 1, near, "2")
        alone = F.transform(F.filter(s["t"], lambda a: (a["left"] >= need) & (a["m"] >= need)), lambda a: made("1", a["m"], a["gram"]))
        return F.concat(five, small, alone)

    rows = side.select("id", let({"t": F.aggregate(F.reverse("terms"), start, step)}, keys).alias("k"), _outline().alias("o"))
    return rows.select("id", "o.*", F.inline("k")).select("key", "id", "reach", *OUTLINE)


def _overlap(least: float) -> Column:
    """Whether two outlines allow ``least``: a place that the other leaves empty holds no shared gram, and the cosine is at most the product of the lengths
    of what is left of both vectors."""
    bits = lambda x, w: [F.col(f"{x}p{w}_{j}") for j in range(BITS)]

    def left(x: str, other: str) -> Column:
        lost = [F.bit_count(p.bitwiseAND(F.bitwise_not(reduce(Column.bitwiseOR, bits(other, w))))) * (1 << j) for w in range(WORDS) for j, p in enumerate(bits(x, w))]
        return 1 - F.col(f"{x}unit") * reduce(Column.__add__, lost)

    return left("", "_") * left("_", "") >= least * least - 1e-5


def meetings(q: DataFrame, r: DataFrame, least: float, once: bool = False) -> DataFrame:
    """``query, ref``: the pairs that may reach ``least``, by two grams at once; exact for any threshold above 0.

    Let S be the grams that a pair shares, in the order of grams. The cosine is at most the product of the lengths of both vectors on S, so
    each length is at least the threshold. Vectors meet on the first and the fifth gram of S, which say more than two that
    overlap. What lies before the fifth is not in S, but for the first and three more: the three heaviest bound these, and
    the length of all that may be in S is the vector's ``reach`` there. The product of both reaches bounds the cosine, so one of them is
    at least the root of the threshold: of vectors with less, none meets another. Where S has fewer than five grams, these must hold
    enough of the vector; such short documents also meet on the first two, or on one gram.

    Pairs are not written as they meet, however many do: outlines of both vectors come with their keys, and only pairs that these allow leave the join.
    Keys go in turns of some ``TURN`` rows.
    """
    strong = least**0.5 - 1e-6
    left = written(_meeting_keys(q, least), "keys")
    right = left if q is r else written(_meeting_keys(r, least), "keys")
    turns = -(-(left.count() + right.count()) // TURN) or 1
    found = []
    for turn in range(turns):
        a, b = (side.where(F.pmod("key", F.lit(turns)) == turn) if turns > 1 else side for side in (left, right))
        found.append(written(_met(a, b, least, strong, once), "meetings"))
    for side in {id(x): x for x in (left, right)}.values():
        discard(side)
    return reduce(DataFrame.unionByName, found).distinct() if turns > 1 else found[0]


def _met(left: DataFrame, right: DataFrame, least: float, strong: float, once: bool) -> DataFrame:
    """``query, ref``, each pair once: of two tables of keys, those that meet and may reach ``least``."""
    right = right.select("key", F.col("id").alias("ref"), *(F.col(c).alias(f"_{c}") for c in ("reach", *OUTLINE)))
    left = left.withColumnRenamed("id", "query")
    if once:  # each pair in one order: what is strong meets all that is weak, and the strong ones of a higher id
        left, on = left.where(F.col("reach") >= strong), ["key"]
        fits = ((F.col("_reach") < strong) | (F.col("query") < F.col("ref"))) & (F.col("query") != F.col("ref"))
    else:  # strong queries meet all references, weak ones the strong
        left, on = left.withColumn("kind", F.col("reach") >= strong), ["key", "kind"]
        kinds = F.when(F.col("_reach") >= strong, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
        right, fits = right.withColumn("kind", F.explode(kinds)), F.lit(True)
    both = left.join(right.hint("merge"), on).where(fits & (F.col("reach") * F.col("_reach") >= least - 1e-6) & _overlap(least))
    if once:
        both = both.select(F.least("query", "ref").alias("query"), F.greatest("query", "ref").alias("ref"))
    return both.select("query", "ref").distinct()


#: From this threshold on outlines leave hardly a pair that sketches do not, and no sketch is made.
SKETCHED = 0.7
#: Parts of a sketch.
PARTS = 64


def _sketch() -> Column:
    """The lengths of a vector's parts, its grams dealt by hash, in 127ths and rounded up."""
    dealt = F.transform("terms", lambda t: F.struct(F.pmod(F.hash(t["gram"]), F.lit(PARTS)).alias("p"), (t["w"] * t["w"]).alias("m")))
    mass = lambda s, p: F.aggregate(s["d"], F.lit(0.0), lambda x, t: x + F.when(t["p"] == p, t["m"]).otherwise(0.0))
    size = lambda s, p: F.least(F.ceil(F.sqrt(mass(s, p)) * 127 - 1e-6), F.lit(127)).cast("tinyint")
    return let({"d": dealt}, lambda s: F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: size(s, p)))


def likely(pairs: DataFrame, q: DataFrame, r: DataFrame, least: float) -> DataFrame:
    """The pairs whose sketches allow ``least``: by parts, products of lengths bound the cosine. So most pairs go without their vectors."""
    left = q.select(F.col("id").alias("query"), _sketch().alias("_a"))
    right = r.select(F.col("id").alias("ref"), _sketch().alias("_b"))
    bound = F.aggregate(F.zip_with("_a", "_b", lambda x, y: x.cast("int") * y.cast("int")), F.lit(0), lambda s, x: s + x)
    both = pairs.join(left, "query").join(right, "ref")
    return both.where(bound >= (least - 1e-4) * 127 * 127).select("query", "ref")


def _dots(pairs: DataFrame, q: DataFrame, r: DataFrame) -> DataFrame:
    """``query, ref, original_doc, matched_doc, conf1`` of pairs of ids."""
    slim = F.transform("terms", lambda t: F.struct(t["gram"].alias("gram"), t["w"].alias("w")))
    left = q.select(F.col("id").alias("query"), F.col("doc").alias("original_doc"), slim.alias("_q"))
    right = r.select(F.col("id").alias("ref"), F.col("doc").alias("matched_doc"), slim.alias("_r"))
    both = pairs.join(left, "query").join(right, "ref")
    known = F.map_from_entries(F.transform("_r", lambda t: F.struct(t["gram"], t["w"])))
    dot = lambda s: F.aggregate(s["q"], F.lit(0.0), lambda x, t: x + t["w"] * F.coalesce(F.try_element_at(s["r"], t["gram"]), F.lit(0.0)))
    return both.select("query", "ref", "original_doc", "matched_doc", let({"q": F.col("_q"), "r": known}, dot).alias("conf1"))


def _scored(q: DataFrame, matcher: Matcher, least: float, once: bool = False) -> DataFrame:
    """All pairs that reach ``least``."""
    few = not once and q.count() * matcher.vectors.count() <= FEW
    if least >= PAIRED and not few:
        pairs = meetings(q, matcher.vectors, least, once)
        if least < SKETCHED:
            pairs = likely(pairs, q, matcher.vectors, least)
    else:
        postings = matcher.postings.where(F.col("tail") >= least - 1e-9)
        pairs = candidates(q.withColumn("least", F.lit(least)), postings, once)
    found = _dots(pairs, q, matcher.vectors).where(F.col("conf1") >= least - 1e-9)
    if once:
        found = written(found, "scored-once")
        turned = found.where("original_doc <> matched_doc").select(F.col("ref").alias("query"), F.col("query").alias("ref"), F.col("matched_doc").alias("original_doc"), F.col("original_doc").alias("matched_doc"), "conf1")
        found = found.unionByName(turned)
        if least >= PAIRED:  # a vector is its own match
            found = found.unionByName(q.select(F.col("id").alias("query"), F.col("id").alias("ref"), F.col("doc").alias("original_doc"), F.col("doc").alias("matched_doc"), F.lit(1.0).alias("conf1")))
    return found


def similar_pairs(refs: DataFrame, queries: DataFrame, ref_col: str, query_col: str, params: StringMatchParams) -> DataFrame:
    """``original_doc, matched_doc, conf1`` (cosine) for distinct documents that share a gram and reach the threshold.

    Exact. The rarest grams lead, so the postings that meet are short, whatever the corpus' most frequent grams are; most pairs that
    meet go by a bound on their cosine (see ``candidates``), and the others are scored once from both vectors. A threshold is needed: without one, every
    document that shares a gram with another would be its pair.
    """
    if params.threshold is None:
        raise ValueError("similar_pairs needs a threshold; match_strings finds the nearest without one")
    matcher = fit_matcher(refs, ref_col, params)
    same = refs is queries and ref_col == query_col
    q = matcher.vectors if same else _asked(matcher, queries, query_col)
    return _scored(q, matcher, params.threshold, same).drop("query", "ref")


#: Thresholds of the search for the nearest, in steps: most documents have their ``k`` nearest above the first ones.
STEPS = (0.7, 0.5, 0.3)
#: Rarest grams by which the queries that are left look for some references, any of which bounds their search.
PROBES = 2


def _nearest(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; what is equal in twelve digits goes by the document."""
    order = Window.partitionBy("original_doc").orderBy(F.round("conf1", 12).desc(), "matched_doc")
    return scored.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)


def _stepped(q: DataFrame, matcher: Matcher, k: int, steps: Sequence[float], same: bool) -> tuple[list[DataFrame], DataFrame]:
    """The ``k`` nearest of the queries that have so many at a step's threshold, and the queries that no step gave enough. Only the first step makes
    each pair in one order where the queries are the references (``same``)."""
    done = []
    for i, threshold in enumerate(steps):
        top = written(_nearest(_scored(q, matcher, threshold, same and i == 0), k), "nearest")
        full = top.groupBy("query").agg(F.count(F.lit(1)).alias("_n"), F.min("conf1").alias("_least")).where((F.col("_n") == k) & (F.col("_least") >= threshold)).select("query")
        done.append(top.join(full, "query", "left_semi"))
        q = written(q.join(full.withColumnRenamed("query", "id"), "id", "left_anti"), "query-vectors")
    return done, q


def nearest(q: DataFrame, matcher: Matcher, k: int, same: bool = False) -> DataFrame:
    """The ``k`` nearest references of each query that share a gram with it, exactly: a query that has ``k`` at or above a
    step's threshold is done, since no other can be nearer. Those that are left score the references of their rarest grams; the
    ``k``-th best of these is a threshold of their own for the last step. Only a query with fewer meets on all of its grams. ``same``: the queries are the
    references, so the first step makes each pair in one order."""
    done, q = _stepped(q, matcher, k, STEPS, same)
    probes = _postings(q.withColumn("terms", F.slice("terms", 1, PROBES)), "query").select("query", "gram")
    pairs = probes.join(matcher.postings.select("gram", "ref"), "gram").select("query", "ref").distinct()
    reached = _nearest(_dots(pairs, q, matcher.vectors), k).groupBy("query").agg(F.min("conf1").alias("least"), F.count(F.lit(1)).alias("_n"))
    reached = reached.select(F.col("query").alias("id"), F.when(F.col("_n") == k, F.col("least")).otherwise(0.0).alias("least"))
    q = written(q.join(reached, "id", "left").withColumn("least", F.coalesce("least", F.lit(0.0))), "query-vectors")
    done.append(_nearest(_dots(candidates(q, matcher.postings), q, matcher.vectors), k))
    return reduce(DataFrame.unionByName, done).drop("query", "ref")


def match_with(matcher: Matcher, queries: DataFrame, query_col: str = "doc", params: StringMatchParams | None = None) -> DataFrame:
    """``match_strings`` for queries that come later than the references; ``params`` may set another threshold or ``k``."""
    return _matches(_asked(matcher, queries, query_col), matcher, params or matcher.params, False)


def match_strings(refs: DataFrame, queries: DataFrame, ref_col: str = "doc", query_col: str = "doc", params: StringMatchParams = StringMatchParams(), in_order: bool = True) -> DataFrame:
    """``original_doc, matched_doc, conf, ldist, conf1``: for each query its ``k`` nearest references (itself among them, if
    it is one). With a threshold, equal strings, equal gram weights and all at or below the threshold are left out.

    Best last, unless ``in_order`` is False. Null documents are left out; repeated ones count once.
    """
    matcher = fit_matcher(refs, ref_col, params)
    same = refs is queries and ref_col == query_col
    return _matches(matcher.vectors if same else _asked(matcher, queries, query_col), matcher, params, same, in_order)


def _matches(q: DataFrame, matcher: Matcher, params: StringMatchParams, same: bool, in_order: bool = True) -> DataFrame:
    if params.threshold is None:
        top = nearest(q, matcher, params.k, same)
    else:  # queries that have their nearest at a higher threshold do not look for more: pairs that meet are far fewer there
        steps = [s for s in STEPS if s > params.threshold]
        done, q = _stepped(q, matcher, params.k, steps, same)
        found = _nearest(_scored(q, matcher, params.threshold, same and not steps), params.k)
        top = reduce(DataFrame.unionByName, [*done, found])
    found = top.select(
        "original_doc", "matched_doc", (1 - F.col("conf1")).alias("conf"), F.levenshtein("original_doc", "matched_doc").alias("ldist"), "conf1"
    )
    if params.threshold is not None:
        found = found.where((F.col("ldist") > 0) & (F.col("conf1") < 1 - 1e-9) & (F.col("conf1") > params.threshold))
    return found.orderBy("conf1", "original_doc", "matched_doc") if in_order else found


def pair_similarity(first: Column, second: Column, threshold: float | None = None, n: int = 3) -> Column:
    """The cosine of the second string's grams, among those of the first, to the first's. Null for equal strings, where
    nothing overlaps, where the grams of the first weigh the same in both, and up to the threshold."""


    def cosine(s: Column) -> Column:
        own = _total(s, "both", lambda x, y: F.when(x > 0, y * y).otherwise(0.0))
        return F.try_divide(_total(s, "both", lambda x, y: x * y), F.sqrt(_total(s, "x", lambda x, y: x * x) * own))

    score = _counted(first, second, n, cosine)
    values = {"cosine": score, "far": F.levenshtein(first, second)}
    good = lambda s: (s["far"] > 0) & (s["cosine"] < 1 - 1e-9) & (s["cosine"] > (threshold or 0.0))
    return let(values, lambda s: F.when(good(s), s["cosine"]))


def _counted(first: Column, second: Column, n: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of two strings' grams: ``x`` and ``y`` different ones, ``both`` shared ones, and ``again``, how often each gram that
    either repeats is in both. So only repeated grams are counted one by one; most are in no string twice."""
    times = lambda x, k: F.array_size(F.filter(x, lambda g: g == k)).cast("double")

    def repeated(grams: Column) -> Column:
        seen = let({"s": F.sort_array(grams)}, lambda s: F.array_distinct(F.filter(s["s"], lambda g, i: (i > 0) & F.coalesce(g == F.get(s["s"], i - 1), F.lit(False)))))
        return F.when(F.array_size(F.array_distinct(grams)) == F.array_size(grams), F.array().cast("array<string>")).otherwise(seen)

    def counts(s: Column) -> Column:
        size = lambda x: F.array_size(x).cast("double")
        again = F.transform(F.array_union(repeated(s["a"]), repeated(s["b"])), lambda k: F.struct(times(s["a"], k).alias("x"), times(s["b"], k).alias("y")))
        return F.struct(size(F.array_distinct(s["a"])).alias("x"), size(F.array_distinct(s["b"])).alias("y"), size(F.array_intersect(s["a"], s["b"])).alias("both"), again.alias("again"))

    return let({"counts": let({"a": ngrams(first, n), "b": ngrams(second, n)}, counts)}, lambda s: body(s["counts"]))


def _total(counts: Column, different: str, value: Callable[[Column, Column], Column]) -> Column:
    """The sum of ``value`` over grams, which is 1 for each of ``different`` unless a gram is repeated."""
    one = lambda v: F.least(v, F.lit(1.0))
    return F.aggregate(counts["again"], counts[different], lambda t, c: t + value(c["x"], c["y"]) - value(one(c["x"]), one(c["y"])))


def cosine_trigram(first: Column, second: Column, n: int = 3) -> Column:
    """The symmetric cosine of two strings' gram counts; 1 for equal strings."""

    def cosine(s: Column) -> Column:
        return F.try_divide(_total(s, "both", lambda x, y: x * y), F.sqrt(_total(s, "x", lambda x, y: x * x) * _total(s, "y", lambda x, y: y * y)))

    return F.when(first == second, 1.0).otherwise(F.coalesce(_counted(first, second, n, cosine), F.lit(0.0)))


def match_groups(matches: DataFrame) -> DataFrame:
    """``node, component, fuzzy_match_name, fuzzy_match_combo`` for each matched document: the shortest one of its group, and
    what stands before the dash in the three shortest, joined, with the group's smallest document at the end.

    A group's three shortest come from a bounded top-three aggregation, so groups may be of any size.
    """
    groups = written(connected_components(matches, "original_doc", "matched_doc"), "match-groups")
    order = F.struct(F.length("node").alias("size"), "node")
    short = groups.withColumn("_bucket", F.pmod(F.xxhash64("node"), F.lit(64)))
    inner = Window.partitionBy("component", "_bucket").orderBy(order)
    outer = Window.partitionBy("component").orderBy(order)
    best = short.withColumn("_r", F.row_number().over(inner)).where("_r <= 3").withColumn("_r", F.row_number().over(outer)).where("_r <= 3")
    named = best.groupBy("component").agg(F.array_sort(F.collect_list(order)).alias("_three"))
    heads = F.transform("_three", lambda x: F.trim(F.split_part(x["node"], F.lit("-"), F.lit(1))))
    named = named.select(
        F.struct("component").alias("_c"),
        F.col("_three")[0]["node"].alias("fuzzy_match_name"),
        F.concat(F.array_join(heads, " -- "), F.lit(" -- "), F.col("component")).alias("fuzzy_match_combo"),
    )
    return groups.join(named, F.struct("component") == F.col("_c")).drop("_c")


def with_match_groups(matches: DataFrame) -> DataFrame:
    """The matches with the names of their groups. Matches are written first, so that they are found once."""
    matches = written(matches, "matches")
    groups = match_groups(matches).select(F.col("node").alias("original_doc"), "fuzzy_match_name", "fuzzy_match_combo")
    return matches.join(groups, "original_doc")


# Verdicts on pairs of addresses


def is_match_street(a: str = "original_doc", b: str = "matched_doc") -> Column:
    return token_at(tokens(a), 1) == token_at(tokens(b), 1)


def is_match_zip(a: str = "original_doc", b: str = "matched_doc") -> Column:
    return token_at(tokens(a), -1) == token_at(tokens(b), -1)


def is_match_secondary(number: str = "secondary_number", doc: str = "original_doc") -> Column:
    """Whether the number is a word of the street part; null without a number."""
    return F.array_contains(tokens(F.split_part(doc, F.lit(","), F.lit(1))), F.trim(number))


def set_match_verdict(df: DataFrame) -> DataFrame:
    """Whether a property's own address is its taxpayer's: ``is_match_number_street_zip``, ``is_match_number_zip`` (null where
    the former holds), ``match_conf`` (likeness of the addresses where it may decide) and ``is_match``."""
    valid, words = F.col("clean_address_v1").isNotNull(), tokens("clean_address")
    own = lambda c, i: F.when(valid, F.col(c)).otherwise(token_at(words, i))
    same = lambda a, b: F.coalesce(F.col(a) == b, F.lit(False))
    number, code = same("number", own("number_validated", 1)), same("zip_code", own("zip_code_validated", -1))
    exact = number & code & same("street", own("street_validated", 2))
    df = df.withColumns({"is_match_number_street_zip": exact})
    df = df.withColumn("is_match_number_zip", F.when(~F.col("is_match_number_street_zip"), number & code))
    alike = pair_similarity(F.coalesce("clean_address_v1", "clean_address"), F.col("formatted_address_prop"))
    df = df.withColumn("match_conf", F.when(F.col("is_match_number_zip") & F.col("formatted_address_prop").isNotNull(), alike))
    close = F.coalesce(F.col("is_match_number_zip") & (F.col("match_conf") > 0.9), F.lit(False))
    return df.withColumn("is_match", F.col("is_match_number_street_zip") | close)
