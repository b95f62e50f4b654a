"""Keys of rows: ids may be null or repeated, so a row goes by its id and a hash of its text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer ids are widened to this; ids of other types that can be ordered stay as they are.
WHOLE = ("tinyint", "smallint", "int", "bigint")


def id_type(df: DataFrame, id_col: str) -> str:
    """The type that ids have in results."""
    kind = df.select(df[id_col].alias("id")).schema["id"].dataType.simpleString()
    return "bigint" if kind in WHOLE else kind


def row_id(df: DataFrame, id_col: str) -> Column:
    return df[id_col].cast(id_type(df, id_col))


def text_hash(text: Column) -> Column:
    """64 bits of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """Never null, and equal for rows that repeat id and text, also where the id is null."""
    return F.struct(row_id(df, id_col).alias("id"), text_hash(df[text_col]).alias("text_hash"))


def key_type(df: DataFrame, id_col: str) -> str:
    return f"struct<id: {id_type(df, id_col)}, text_hash: bigint>"


def rank(df: DataFrame, id_col: str) -> Column:
    """Orders rows by their ids; those without one come last and are all equal."""
    if id_type(df, id_col) == "bigint":
        return F.coalesce(row_id(df, id_col), F.lit((1 << 63) - 1))
    return F.struct(df[id_col].isNull().alias("none"), df[id_col].alias("id"))


def rank_type(df: DataFrame, id_col: str) -> str:
    kind = id_type(df, id_col)
    return kind if kind == "bigint" else f"struct<none: boolean, id: {kind}>"


def others(df: DataFrame, *new: str) -> list[str]:
    """The columns of ``df`` whose names, in whatever case, are not those of new columns."""
    return [c for c in df.columns if c.lower() not in {n.lower() for n in new}]


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Rows and bytes of an Arrow batch: texts are some kilobytes, and a batch is held in the JVM and in Python. Bytes of text that
#: a worker turns into results at once.
BATCH_ROWS, BATCH_BYTES, BLOCK_BYTES = 1000, 16 << 20, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, for ``mapInArrow``. Spark reads the sizes of batches from the session when a plan runs, so this lowers them
    for good in the session of ``df``: at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` bytes. Lower settings stay."""
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = conf.get(name).removesuffix("b")
        if now.isdigit() and not 0 < int(now) <= most:
            conf.set(name, str(most))
    return df


def blocks(batches: Iterable[pa.RecordBatch], column: int, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches whose texts (or lists of ids) in that column have ``most`` bytes (ids) together, or one row that
    has more."""
    for batch in batches:
        if batch.num_rows:
            values = batch.column(column)
            length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
            sizes = pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                yield batch.slice(a, b - a)
