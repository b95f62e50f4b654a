"""Vectors as short codes: each part of a vector is replaced by its nearest codebook entry, found by Orchard's search.

For each entry, the other entries are listed by their distance from it. A search starts at one entry and walks along its list;
where an entry is nearer to the part than the current one, the search jumps to that entry's list. Entries that were measured
are marked and not measured again. The walk ends where the list's distance is over twice the current distance: by the triangle
inequality, whatever comes later is farther from the part. All parts of a block of vectors walk at once, in numpy; the vectors
themselves stay where Spark put them, and a round of training sends back sums of entries only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedweb.llm.rows import blocks, small_batches
from deedweb.scratch import discard, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components up to this are worked on in 64 bits; a block or codebook with larger ones takes Python's integers.
NARROW = 1 << 20
LONGEST = (1 << 63) - 1
#: Sums travel in digits of this many bits, so that totals of any size fit longs.
DIGIT = 32


@dataclass(frozen=True)
class Codebooks:
    """``entries`` (parts x entries x width, integers, zeros beyond a part's end) and where each part begins in a vector."""

    entries: np.ndarray
    cuts: tuple[int, ...]

    def components(self) -> Iterator[int]:
        """All components by part, entry and place."""
        for p, part in enumerate(self.entries):
            for entry in part:
                yield from (int(x) for x in entry[: self.cuts[p + 1] - self.cuts[p]])

    def sha256(self) -> str:
        """Of the components' decimal digits, joined by commas; lowercase hexadecimal digits."""
        return hashlib.sha256(",".join(map(str, self.components())).encode()).hexdigest()


def cut_points(dims: int, parts: int = PARTS) -> tuple[int, ...]:
    """Where parts begin and end: equal parts, or parts that differ by one component."""
    return tuple(dims * i // parts for i in range(parts + 1))


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) for rows of finite floats: 64-bit integers where all are small, else Python's integers."""
    if not values.size or np.abs(values).max() * scale <= NARROW:
        return np.floor(values.astype(np.float64) * scale).astype(np.int64)
    exact = [floor(x * scale) if abs(x) < 1e15 else int(x) * scale for x in values.ravel().tolist()]
    out = np.empty(values.size, object)
    out[:] = exact
    return out.reshape(values.shape)


def as_parts(rows: np.ndarray, cuts: tuple[int, ...]) -> np.ndarray:
    """Rows x parts x width."""
    width = max(b - a for a, b in zip(cuts, cuts[1:], strict=False))
    out = np.zeros((len(rows), len(cuts) - 1, width), rows.dtype)
    for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        out[:, p, : b - a] = rows[:, a:b]
    return out


def _squared(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


class OrchardLists:
    """The neighbour lists of one part's entries: for each entry, all entries by their distance from it, itself first."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.apart = _squared(entries[:, None, :] - entries[None, :, :])
        self.lists = np.array([sorted(range(len(entries)), key=lambda j: (row[j], j)) for row in self.apart])
        self.start = int(min(range(len(entries)), key=lambda j: (self.apart[j].sum(), j)))

    def search(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part and its squared distance; of entries that are as near, the first."""
        n, size = len(parts), len(self.entries)
        best = np.full(n, self.start)
        near = _squared(parts - self.entries[self.start])
        seen = np.zeros((n, size), bool)
        seen[:, self.start] = True
        at = np.zeros(n, np.int64)  # place in the list of the current entry
        walking = np.arange(n if size > 1 else 0)
        while len(walking):
            here = best[walking]
            there = self.lists[here, at[walking]]
            on = (self.apart[here, there] <= 4 * near[walking]).astype(bool)  # squares, so twice the distance
            walking, there = walking[on], there[on]
            at[walking] += 1
            new = ~seen[walking, there]
            rows, there = walking[new], there[new]
            seen[rows, there] = True
            found = _squared(parts[rows] - self.entries[there])
            nearer = ((found < near[rows]) | ((found == near[rows]) & (there < best[rows]))).astype(bool)
            moved = rows[nearer]
            best[moved], near[moved], at[moved] = there[nearer], found[nearer], 0
            walking = walking[at[walking] < size]
        return best, near


def _searches(books: Codebooks) -> list[OrchardLists]:
    return [OrchardLists(part) for part in books.entries]


def assign(parts: np.ndarray, searches: list[OrchardLists]) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part of every row."""
    found = [s.search(parts[:, p]) for p, s in enumerate(searches)]
    return np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a column of lists, none of which is null, as rows of floats."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _block_parts(column: pa.Array, books: Codebooks) -> np.ndarray:
    rows = whole_numbers(_matrix(column, books.cuts[-1]))
    if books.entries.dtype == object and rows.dtype != object:
        rows = rows.astype(object)
    return as_parts(rows, books.cuts)


def _digits(total: int) -> Iterator[tuple[int, int]]:
    """A number as digits of ``DIGIT`` bits, the last with the sign."""
    at = 0
    while not -(1 << DIGIT) < total < 1 << DIGIT:
        yield at, total & ((1 << DIGIT) - 1)
        total, at = total >> DIGIT, at + 1
    yield at, total


def _sums(kept: DataFrame, books: Codebooks) -> tuple[dict, dict]:
    """For each (part, entry): the sum of its parts' components and their number. What comes to the driver has a row for each
    component of the codebooks and digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _searches(books)
        shape = books.entries.shape
        totals, counts = np.zeros(shape, object), np.zeros(shape[:2], np.int64)
        for batch in blocks(batches, 0, 1 << 18):
            parts = _block_parts(batch.column(0), books)
            codes, _ = assign(parts, searches)
            for p in range(shape[0]):
                counts[p] += np.bincount(codes[:, p], minlength=shape[1])
                for e in np.unique(codes[:, p]):
                    totals[p, e] += parts[codes[:, p] == e, p].sum(axis=0).astype(object)
        rows = [(p, e, -1, 0, int(counts[p, e])) for p, e in np.argwhere(counts).tolist()]
        rows += [(p, e, i, d, x) for p, e, *_ in rows for i in range(shape[2]) for d, x in _digits(int(totals[p, e, i]))]
        columns = [pa.array([r[k] for r in rows], pa.int64() if k == 4 else pa.int32()) for k in range(5)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "place", "digit", "total"])

    parts = small_batches(kept.select("vector")).mapInArrow(run, "part int, entry int, place int, digit int, total long")
    sums: dict = {}
    counts: dict = {}
    for r in parts.groupBy("part", "entry", "place", "digit").agg(F.sum("total").alias("total")).collect():
        if r.place < 0:
            counts[r.part, r.entry] = r.total
        else:
            sums[r.part, r.entry, r.place] = sums.get((r.part, r.entry, r.place), 0) + (r.total << DIGIT * r.digit)
    return sums, counts


def _improved(kept: DataFrame, books: Codebooks) -> Codebooks:
    """A round: entries move to the floor of the mean of their parts; those that no part chose stay."""
    sums, counts = _sums(kept, books)
    entries = books.entries.astype(object)
    for (p, e, i), total in sums.items():
        entries[p, e, i] = total // counts[p, e]
    small = all(abs(x) <= NARROW for x in entries.ravel().tolist())
    return Codebooks(entries.astype(np.int64) if small else entries, books.cuts)


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all of its components are finite numbers."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & F.forall(vector, good), F.lit(False))


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks from rows ``vec_id, vector`` of usable vectors of one length; None without rows. They start as the parts of
    the vectors with the smallest ids (equal ids by their vectors; rows without an id come last)."""
    first = kept.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return None
    rows = whole_numbers(np.array([r.vector for r in first], np.float64).reshape(len(first), -1))
    cuts = cut_points(rows.shape[1], parts)
    books = Codebooks(np.ascontiguousarray(as_parts(rows, cuts).transpose(1, 0, 2)), cuts)
    for _ in range(rounds):
        books = _improved(kept, books)
    return books


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """The rows of ``kept`` with ``code`` (two hexadecimal digits for each part) and ``error`` in place of ``vector``."""
    keep = [c for c in kept.columns if c != "vector"]
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.select(*keep).dtypes) + ", code string, error long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _searches(books)
        for batch in blocks(batches, batch_at, 1 << 18):
            codes, apart = assign(_block_parts(batch.column(batch_at), books), searches)
            texts = [bytes(row).hex() for row in codes.astype(np.uint8)]
            errors = [min(int(x), LONGEST) for x in apart.sum(axis=1).tolist()]
            rest = [c for i, c in enumerate(batch.columns) if i != batch_at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string()), pa.array(errors, pa.int64())], [*keep, "code", "error"])

    batch_at = kept.columns.index("vector")
    return small_batches(kept).mapInArrow(run, schema)


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` for each usable vector.

    ``error`` is the sum of the squared distances between the parts and their entries; ``label_error`` its sum over the rows of
    equal label, those without a label together; a sum beyond the range of a long is given as the largest long.

    A vector that is null, or that holds a null, a NaN or an infinity, is left out. Vectors whose length is not that of the one
    with the smallest id cannot be compared with it and are left out too; if the length is no multiple of ``parts``, parts
    differ by one component. With fewer vectors than ``entries``, codebooks are as small as that. Rows may repeat: each is
    encoded and counts in the means. Rows without an id are encoded too. Ids and labels may be of any type that can be ordered;
    other columns are not read. Very large components are exact, since they are worked on as Python's integers. An empty table gives an
    empty result. Training sends a few sums for each codebook component to the driver, whatever the number of vectors.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hexadecimal digits a part: 1 to 256 entries")
    named = vectors.select(vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), vectors[vector_col].alias("vector"))
    named = named.where(usable(F.col("vector"))).withColumn("vector", F.col("vector").cast("array<double>"))
    least = named.orderBy(F.col("vec_id").asc_nulls_last(), F.size("vector"), "vector").select(F.size("vector").alias("n")).head(1)
    kept = written(named.where(F.size("vector") == (least[0].n if least else 0)), "vectors")
    books = train(kept, parts, entries, rounds)
    if books is None:
        empty = kept.drop("vector").select("*", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty.withColumn("codebooks_sha256", F.lit(""))
    codes = written(encode(kept, books), "codes")
    discard(kept)
    # Few labels may hold most rows: sums are taken before the shuffle, and both sides of the join can be split.
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    sums = codes.groupBy("label").agg(total.alias("label_error")).select(F.struct("label").alias("of"), "label_error")
    found = codes.join(sums, F.struct("label") == F.col("of")).drop("of")
    return found.withColumn("codebooks_sha256", F.lit(books.sha256()))

