"""Components that grow: edges are added to a saved labelling, and the edges it was made from are not read again.

A node keeps the component that it had when it came; when components merge, a second table says what became of them. New edges are
looked up in the buckets of their own nodes, contracted to edges between components, and only these go through the rounds of
the component search. The cost follows the new edges and the merged components, not what is there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedweb.operators.components import connected_components
from deedweb.scratch import written
from deedweb.sources.snapshots import Snapshot, publish, snapshot

BUCKETS = 64


@dataclass(frozen=True)
class Growth:
    """What adding edges did: the version it made, the buckets of nodes that it read (of how many), and how many nodes came and
    components went."""

    snapshot: Snapshot
    read: int
    buckets: int
    new_nodes: int
    merged: int


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)).cast("int"))


def save_components(spark: SparkSession, labels: DataFrame, root: str, buckets: int = BUCKETS) -> Snapshot:
    """Publishes the labelling ``node, component`` as the first version below ``root``."""
    rows = labels.select("node", F.col("component").alias("base"))
    none = rows.select("base", F.col("base").alias("component")).limit(0)
    size = spark.range(1).select(F.lit(buckets).alias("buckets"))
    by = {"labels": ["bucket"]}
    return publish(spark, root, {"labels": _bucketed(rows, buckets).repartition("bucket"), "merges": none, "layout": size}, partition_by=by)


def read_components(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``node, component`` of the last version, or of an earlier one."""
    at = snapshot(spark, root, version)
    labels, merges = at.read(spark, "labels"), at.read(spark, "merges")
    found = labels.join(merges.select(F.struct("base").alias("of"), "component"), F.struct("base") == F.col("of"), "left")
    return found.select("node", F.coalesce("component", "base").alias("component"))


def grow_components(spark: SparkSession, edges: DataFrame, root: str, src: str = "src", dst: str = "dst", source: str | None = None, batch: int = 0) -> Growth:
    """Adds edges to the labelling below ``root`` and publishes the result; components are named by their smallest node, as in
    ``connected_components``. A self-loop adds its node, an edge with a null end is ignored. Edges may repeat old ones. With
    ``source`` and ``batch``, a batch that runs again changes nothing."""
    at = snapshot(spark, root)
    buckets = at.read(spark, "layout").first()[0]
    if source is not None and batch <= at.batches.get(source, -1):
        return Growth(at, 0, buckets, 0, 0)
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null").distinct()
    ends = written(ends, "added-edges")
    nodes = written(_bucketed(ends.select(F.explode(F.array("a", "b")).alias("node")).distinct(), buckets), "added-nodes")
    touched = sorted(r[0] for r in nodes.select("bucket").distinct().collect())  # no more than there are buckets
    merges = at.read(spark, "merges")
    labels = at.read(spark, "labels").where(F.col("bucket").isin(touched))  # a filter of folders
    old = nodes.join(labels.select("node", "base"), "node", "left")
    old = old.join(merges.select(F.struct("base").alias("of"), "component"), F.struct("base") == F.col("of"), "left").drop("of")
    known = written(old.select("node", "bucket", F.col("base").isNull().alias("new"), F.coalesce("component", "base", "node").alias("now")), "known-nodes")
    named = lambda end: known.select(F.struct(F.col("node").alias(end)).alias(f"of_{end}"), F.col("now").alias(f"now_{end}"))
    both = ends.join(named("a"), F.struct("a") == F.col("of_a")).join(named("b"), F.struct("b") == F.col("of_b"))
    contracted = both.select(F.col("now_a").alias("src"), F.col("now_b").alias("dst")).distinct()
    found = connected_components(contracted)
    moved = written(found.where("node <> component").select(F.col("node").alias("was"), F.col("component").alias("is")), "moved")
    of = moved.select(F.struct("was").alias("of"), "is")
    later = merges.join(of, F.struct("component") == F.col("of"), "left").select("base", F.coalesce("is", "component").alias("component"))
    later = later.unionByName(moved.select(F.col("was").alias("base"), F.col("is").alias("component")))
    fresh = known.where("new").join(of, F.struct("now") == F.col("of"), "left").select("node", F.coalesce("is", "now").alias("base"), "bucket")
    counts = known.agg(F.count_if("new")).first()[0], moved.count()
    after = publish(spark, root, {"merges": later}, {"labels": fresh.repartition("bucket")}, source, batch, {"labels": ["bucket"]}, since=at)
    return Growth(after, len(touched), buckets, *counts)


def compact_components(spark: SparkSession, root: str) -> Snapshot:
    """Folds the merges into the nodes' labels, which become one folder again."""
    at = snapshot(spark, root)
    buckets = at.read(spark, "layout").first()[0]
    rows = read_components(spark, root).select("node", F.col("component").alias("base"))
    none = rows.select("base", F.col("base").alias("component")).limit(0)
    return publish(spark, root, {"labels": _bucketed(rows, buckets).repartition("bucket"), "merges": none}, partition_by={"labels": ["bucket"]}, since=at)
