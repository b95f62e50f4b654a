"""Masters that take deliveries one by one: the duplicates of all deliveries are merged as if they had come together.

What ``merge_duplicates`` says of a group can be kept and merged: of each column, the first value that is not null and the row that it is
from; of the status, whether a 0 or a 1 was there. The master is a table of such states, laid out in buckets of the groups' keys. A
delivery is made into states first, and only the buckets that it touches are read, merged and written again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedweb.scratch import written
from deedweb.sources.snapshots import Snapshot, publish_parts, snapshot

BUCKETS, MASTER = 64, "master"


def states(df: DataFrame, subset: list[str], row_id: str, status: str = "status") -> DataFrame:
    """The state of each group: a struct of row and value for each column; for the status, also ``zero`` and ``one``. Groups with
    a null key go."""
    known = df.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in subset)))
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(row_id).alias("row"), F.col(c).alias("value")))).alias(c)
    marks = [F.max(F.coalesce(F.col(status) == v, F.lit(False))).alias(n) for v, n in (("0", "_zero"), ("1", "_one"))] if status in df.columns else []
    return known.groupBy(*subset).agg(*(first(c) for c in df.columns if c not in subset), *marks)


def merged_states(parts: DataFrame, subset: list[str]) -> DataFrame:
    """The states of the same groups, put together."""
    marks = [c for c in ("_zero", "_one") if c in parts.columns]
    rest = [c for c in parts.columns if c not in (*subset, *marks)]
    return parts.groupBy(*subset).agg(*(F.min(c).alias(c) for c in rest), *(F.max(c).alias(c) for c in marks))


def finished(found: DataFrame, columns: list[str], subset: list[str], status: str = "status") -> DataFrame:
    """The rows that states stand for."""
    value = lambda c: F.col(c) if c in subset else F.col(f"{c}.value")
    best = lambda c: F.when(F.col("_zero"), "0").when(F.col("_one"), "1").otherwise(value(c))
    return found.select(*((best(c) if c == status and "_zero" in found.columns else value(c)).alias(c) for c in columns))


def apply_delivery(
    spark: SparkSession,
    root: str,
    delivery: DataFrame,
    subset: list[str],
    row_id: str,
    status: str = "status",
    buckets: int = BUCKETS,
    source: str | None = None,
    batch: int = 0,
) -> Snapshot:
    """Merges a delivery into the master below ``root`` and publishes it; the first one makes it. All deliveries have the same columns, and
    ``buckets`` does not change. ``row_id`` orders rows across deliveries. A batch that runs again changes nothing."""
    at = snapshot(spark, root)
    if source is not None and batch <= at.batches.get(source, -1):
        return at
    place = F.pmod(F.xxhash64(*subset), F.lit(buckets)).cast("int")
    new = written(states(delivery, subset, row_id, status).withColumn("_bucket", place), "delivery")
    touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())  # no more than there are buckets
    if MASTER in at.folders:
        old = at.part(spark, MASTER, touched)
        rows = merged_states(old.unionByName(new.drop("_bucket")), subset).withColumn("_bucket", place)
    else:
        rows = new
    return publish_parts(spark, root, MASTER, rows, "_bucket", touched, source, batch, since=at)


def read_master(spark: SparkSession, root: str, columns: list[str], subset: list[str], status: str = "status", version: int | None = None) -> DataFrame:
    """The merged rows: what ``merge_duplicates`` gives for all deliveries together."""
    return finished(snapshot(spark, root, version).part(spark, MASTER), columns, subset, status)
