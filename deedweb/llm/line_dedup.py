"""Cross-site boilerplate lines by distinct-site spread.

A HyperLogLog sketch of sites for each line hash is filled where the lines are read, and sketches merge in the aggregation.
Lines whose estimate is far from the threshold are decided by it; those near it get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedweb.llm.rows import others, row_id, row_key, spare
from deedweb.scratch import written

MIN_SITES, LOG2_REGISTERS, BAND = 5, 10, 0.2


#: What is cut from both ends of a line before it is compared.
EDGES = " \t\r"


def line_hash(line: F.Column) -> F.Column:
    """A line's identity, without the spaces, tabs and carriage returns around it: 128 bits, from two seeds."""
    bare = F.trim(line, F.lit(EDGES))
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def _lines(docs: DataFrame, text_col: str, *columns: F.Column) -> DataFrame:
    """``columns``, ``at`` (place in the text), ``line`` (hash) for each line that is not blank."""
    lines = F.posexplode(F.split(docs[text_col], "\n")).alias("at", "line")
    rows = docs.select(*columns, lines).where(F.trim("line", F.lit(EDGES)) != "")
    return rows.withColumn("line", line_hash(F.col("line")))


def boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    band: float = BAND,
) -> DataFrame:
    """``line`` (hash), ``keeper`` (smallest id that has it), ``sites`` for each line found on ``min_sites`` sites or more.

    The sketches have 2^10 registers (relative error about 3 %). They are made where the lines are read and merge by line.
    Estimates within ``band`` of the threshold, six times that error, count as near, and the sites of these lines alone are
    made distinct and counted; ``sites`` is the exact count for them and the rounded estimate otherwise.
    """
    site = F.coalesce(docs[site_col], F.lit("")).alias("site")
    rows = _lines(docs, text_col, row_id(docs, id_col).alias("id"), site)
    # Sketches pass over empty strings, so each site gets a letter.
    sketch = F.hll_sketch_agg(F.concat(F.lit("="), "site"), F.lit(LOG2_REGISTERS))
    sketched = rows.groupBy("line").agg(sketch.alias("sketch"), F.min("id").alias("keeper"))
    low, high = min_sites * (1 - band), min_sites * (1 + band)
    rated = sketched.select("line", "keeper", F.hll_sketch_estimate("sketch").alias("estimate"))
    rated = written(rated.where(F.col("estimate") >= low), "line-spread")
    near = rated.where(F.col("estimate") <= high).select(F.struct("line").alias("near"), "keeper")
    pairs = rows.join(near, F.struct("line") == F.col("near")).select("line", "keeper", "site").distinct()
    exact = pairs.groupBy("line", "keeper").agg(F.count(F.lit(1)).alias("sites"))
    far = rated.where(F.col("estimate") > high).select("line", "keeper", F.col("estimate").alias("sites"))
    return far.unionByName(exact.where(F.col("sites") >= min_sites).select("line", "keeper", "sites"))


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    band: float = BAND,
) -> DataFrame:
    """The rows and columns of ``docs``, plus ``n_lines``, ``n_removed`` (long) and ``kept_text``.

    Texts are split at newlines. A line, without the spaces, tabs and carriage returns around it, that occurs on
    ``min_sites`` sites or more is boilerplate: it stays in the document with the smallest id and goes from all others, so
    what is copied across sites survives once. Blank lines stay. A null text stays null and has no lines; a null site is a
    site of its own. A null id is never the smallest; where no document with the line has an id, the line stays. Repeated
    rows are repeated in the result and count once for a site. An empty table gives an empty result. Ids may be of any
    type that can be ordered. A column of ``docs`` that has the name of a new one, in whatever case, is replaced. The work
    on a very long text grows with its length only: lines to be removed are told by their places.
    """
    found = written(boilerplate(docs, id_col, text_col, site_col, min_sites, band).where("keeper is not null"), "boilerplate")
    found = found.select(F.struct("line").alias("_line"), "keeper")
    key = row_key(docs, id_col, text_col)
    hits = _lines(docs, text_col, key.alias("key")).join(found, F.struct("line") == F.col("_line"))
    hits = hits.where(~F.col("key.id").eqNullSafe(F.col("keeper")))
    by_key, gone, text = (spare(docs, x) for x in ("key", "gone", "text_before"))
    columns = others(docs, "n_lines", "n_removed", "kept_text")
    joined = docs.select(*columns, docs[text_col].alias(text), key.alias(by_key)).join(
        hits.groupBy(F.col("key").alias(by_key)).agg(F.collect_set("at").alias(gone)), by_key, "left"
    )
    lines, same = F.split(text, "\n"), F.col(gone).isNull()
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.transform(stay, lambda i: F.get(lines, i))
    return joined.select(
        *columns,
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(same, 0).otherwise(F.size(gone)).cast("long").alias("n_removed"),
        F.when(same, F.col(text)).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
