"""Exact duplicates with a heavy-hitter split.

A Misra-Gries pass over the digests finds the few that may hold a large share of all rows. Their groups are counted
exactly, and the verified winners are broadcast, so that the rows of huge groups are decided where they are read. All
other digests are shuffled; no such group holds more than a small part of a partition's usual load.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deedweb.scratch import written

WHITE = " \t\n\x0b\x0c\r"


def _without_white(text: F.Column) -> F.Column:
    for char in WHITE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def misra_gries(digests: DataFrame, counters: int) -> DataFrame:
    """``(digest, estimate)``: in each partition at most ``counters`` digests stay, added up over the partitions.

    With n rows, the estimate of a digest is at most its count, and lower by n / (counters + 1) at most.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for x in pa.array(batch.column(0)).value_counts().to_pylist():
                held[x["values"]] = held.get(x["values"], 0) + x["counts"]
            if len(held) > counters:
                less = sorted(held.values(), reverse=True)[counters]
                held = {k: v - less for k, v in held.items() if v > less}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["digest", "estimate"]
        )

    return (
        digests.select("digest")
        .mapInArrow(summary, "digest binary, estimate long")
        .groupBy("digest")
        .agg(F.sum("estimate").alias("estimate"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest`` (binary SHA-256 of the text without ASCII
    white space), ``n_chars`` (code points of the original text).

    Texts are equal when they are identical without ASCII white space; null counts as empty, so all null, empty and
    blank texts are one group. Of a group, the row with the most code points stays, then the smallest id (a null id
    comes last), then any one of wholly equal rows: exactly one row of a group has ``kept``. Other columns of ``docs``
    are not read. An empty table gives an empty result.

    ``share``: a digest counts as a heavy hitter from this share of the rows on. The default is a quarter of a
    shuffle partition's share, which bounds both the broadcast table (its size is 2 / share rows at most) and the
    largest group that is shuffled.
    """
    spark = docs.sparkSession
    share = share or 1 / max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = written(
        docs.select(
            docs[id_col].alias("doc_id"),
            F.unhex(F.sha2(_without_white(text), 256)).alias("digest"),
            F.length(text).cast("long").alias("n_chars"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    least = rows.count() * share
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    suspects = misra_gries(rows, int(2 / share)).where(F.col("estimate") >= least / 2).select("digest")
    heavy = written(
        rows.join(F.broadcast(suspects), "digest")
        .groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") >= least),
        "heavy",
    )
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    group = Window.partitionBy("digest")
    rest = (
        marked.where("best is null")
        .drop("best", "group_size")
        .withColumns({"best": best.over(group), "group_size": F.count(F.lit(1)).over(group)})
    )
    return (
        marked.where("best is not null")
        .unionByName(rest)
        .select(
            "doc_id",
            F.col("best.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("best.row")).alias("kept"),
            "digest",
            "n_chars",
        )
    )
