"""Connected components of an edge table, by rounds of contraction in which nodes are numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from deedweb.scratch import discard, written

MAX_ROUNDS = 120
#: Salts for the numbers of nodes; one that gives two nodes the same number is not used.
SALTS = 8
#: Choices of so many nodes at most are broadcast.
SMALL = 100_000


def _numbers(ends: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``node, id`` of all nodes, the table that these are read from, and the edges as ``a, b`` of ids. An id is a hash of its node: no join is needed to number the
    ends. Whether all differ is counted, and else another salt is taken."""
    nodes = written(ends.select(F.explode("e").alias("node")).distinct(), "nodes")
    for salt in range(SALTS):
        number = lambda c: F.xxhash64(F.lit(salt), c)  # noqa: B023, E731
        names = nodes.select("node", number(F.col("node")).alias("id"))
        n, different = names.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
        if n == different:
            return names, nodes, ends.select(number(F.col("e")[0]).alias("a"), number(F.col("e")[1]).alias("b"))
    raise RuntimeError("nodes keep sharing numbers")


def _round(edges: DataFrame) -> tuple[DataFrame, int]:
    """The edges between different ends, each once, written, with their number."""
    seen = Observation()
    kept = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    table = written(kept.observe(seen, F.count(F.lit(1)).alias("n")), "edges")
    return table, seen.get["n"]


def _chosen(edges: DataFrame, turn: int) -> DataFrame:
    """``id, to``: each node chooses the least of itself and its neighbours in an order that is new in each round. Nodes get
    new numbers, which are their places in that order: the hash of one 64-bit number is another for each."""
    place = lambda c: F.xxhash64(F.lit(turn), F.col(c))
    both = F.array(F.struct(F.col("a").alias("id"), F.least(place("a"), place("b")).alias("to")), F.struct(F.col("b").alias("id"), F.least(place("a"), place("b")).alias("to")))
    return edges.select(F.explode(both).alias("x")).select("x.id", "x.to").groupBy("id").agg(F.min("to").alias("to"))


def _renamed(edges: DataFrame, chosen: DataFrame, small: bool) -> DataFrame:
    """The edges between what their ends chose. Keys are wrapped in structs, so that joins get plain exchanges on both sides, which
    adaptive execution can split where one node holds most edges."""
    hint = F.broadcast if small else lambda df: df
    named = lambda end: hint(chosen.select(F.struct(F.col("id").alias(end)).alias(f"of_{end}"), F.col("to").alias(f"to_{end}")))
    both = edges.join(named("a"), F.struct("a") == F.col("of_a")).join(named("b"), F.struct("b") == F.col("of_b"))
    return both.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))


def _followed(first: DataFrame, then: DataFrame, small: bool) -> DataFrame:
    """Where nodes are after two choices; one without neighbours after the first stays. ``turn`` is the round of the last choice: numbers
    of different rounds may agree by chance."""
    later = then.select(F.struct(F.col("id").alias("to")).alias("of"), F.col("to").alias("last"), F.col("turn").alias("later"))
    both = first.join(F.broadcast(later) if small else later, F.struct("to") == F.col("of"), "left")
    return both.select("id", F.coalesce("last", "to").alias("to"), F.coalesce("later", "turn").alias("turn"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node that occurs in ``edges``; the component is its smallest node.

    Ends may be of any orderable type. Self-loops label their node; an edge with a null end is ignored, and so are
    repeated edges. An empty input gives an empty result. In each round every node chooses the least of itself and its
    neighbours in a random order, and edges are drawn between what their ends chose: a constant part of the nodes that have edges goes in
    each round, so edges shrink geometrically, all rounds together cost a few passes over them, and the number of rounds grows with the
    logarithm of the nodes. Rounds carry 64-bit numbers only; nodes come back at the end. Each round is written to the shared folder
    and its edges are deleted after the next.
    """
    pairs = edges.select(F.array(F.col(src), F.col(dst)).alias("e")).where("e[0] is not null and e[1] is not null")
    pairs = written(pairs, "ends")
    names, nodes, ends = _numbers(pairs)
    table, n = _round(ends)
    discard(pairs)
    choices: list[tuple[DataFrame, bool]] = []
    for turn in range(MAX_ROUNDS):
        if n == 0:
            break
        small = 2 * n <= SMALL
        choices.append((written(_chosen(table, turn), "choices"), small))
        before, (table, n) = table, _round(_renamed(table, choices[-1][0], small))
        discard(before)
    else:
        raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
    if not choices:
        return names.select("node", F.col("node").alias("component"))
    last, joins = None, 0  # from the last choices, the smallest tables; plans stay short
    followed = []
    for turn, (own, _) in reversed([*enumerate(choices)]):
        own = own.withColumn("turn", F.lit(turn))
        last, joins = (own, 0) if last is None else (_followed(own, last, choices[turn + 1][1]), joins + 1)
        if joins == 6 and turn > 0:
            last, joins = written(last, "followed"), 0
            followed.append(last)
    last = last.select(F.struct("id").alias("of"), F.struct("to", "turn").alias("part"))
    found = written(names.join(last, F.struct("id") == F.col("of"), "left").select("node", "part"), "labels")
    for done in (nodes, *followed, *(c for c, _ in choices)):
        discard(done)
    shared = found.where("part is not null")
    least = shared.groupBy(F.struct("part").alias("of")).agg(F.min("node").alias("component"))
    joined = shared.join(least, F.struct("part") == F.col("of")).select("node", "component")
    return joined.unionByName(found.where("part is null").select("node", F.col("node").alias("component")))
