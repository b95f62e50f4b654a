"""Statistics that merge: each batch leaves its counts and a sketch of each column's distinct values, and totals over any number of
batches are taken from these, without their rows.

A theta sketch is exact up to its capacity and then keeps a sample by hash: its relative error is about one part in the square root of
the capacity (0.4 % at 2^16 values), and sketches have unions, intersections and differences, so values that two tables share
can be counted across batches too. Of an intersection, the error is relative to the union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedweb.sources.snapshots import Snapshot, publish, snapshot

#: Distinct values up to which a sketch is exact, as a power of two.
CAPACITY = 16
STATISTICS = "statistics"


def batch_statistics(df: DataFrame, columns: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``column, n_rows, n_missing`` (nulls and empty strings), ``sketch`` for each column, in one pass; sketches are filled where rows
    are read. Nulls and empty strings are no values."""
    values = F.array(*(F.struct(F.lit(c).alias("column"), F.nullif(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns))
    each = df.select(F.inline(values))
    sketch = F.theta_sketch_agg("value", capacity)
    return each.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_missing"), sketch.alias("sketch"))


def add_statistics(spark: SparkSession, root: str, df: DataFrame, columns: list[str], source: str, batch: int, capacity: int = CAPACITY) -> Snapshot:
    """Publishes the statistics of a batch beside those of others; a batch that runs again is not counted again."""
    rows = batch_statistics(df, columns, capacity).select(F.lit(source).alias("source"), F.lit(batch).cast("long").alias("batch"), "*")
    return publish(spark, root, append={STATISTICS: rows.coalesce(1)}, source=source, batch=batch)


def statistics(spark: SparkSession, root: str) -> DataFrame:
    """All that batches have left: a few rows for each."""
    return snapshot(spark, root).read(spark, STATISTICS)


def total_statistics(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``source, column, n_batches, n_rows, n_missing, n_distinct`` over all batches."""
    whole = parts.groupBy("source", "column").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"), F.theta_union_agg("sketch", capacity).alias("sketch")
    )
    return whole.select("source", "column", "n_batches", "n_rows", "n_missing", F.theta_sketch_estimate("sketch").cast("long").alias("n_distinct"))


def linked_values(parts: DataFrame, left: tuple[str, str], right: tuple[str, str], capacity: int = CAPACITY) -> DataFrame:
    """``n_linked, n_left_only, n_right_only``: distinct values of one source's column that another's has, and that either has alone."""
    of = lambda x: F.when((F.col("source") == x[0]) & (F.col("column") == x[1]), F.col("sketch"))
    row = parts.agg(F.theta_union_agg(of(left), capacity).alias("a"), F.theta_union_agg(of(right), capacity).alias("b"))
    count = lambda s, name: F.theta_sketch_estimate(s).cast("long").alias(name)
    return row.select(
        count(F.theta_intersection("a", "b"), "n_linked"), count(F.theta_difference("a", "b"), "n_left_only"), count(F.theta_difference("b", "a"), "n_right_only")
    )
