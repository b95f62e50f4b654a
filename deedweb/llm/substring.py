"""Repeated passages by seed and extend.

Winnowing picks one anchor, a run of ``SEED_WORDS`` words, out of every window of ``window`` words; equal windows pick
equal anchors. Documents are joined on the anchors that occur in two of them or more. Around each shared anchor the match
extends both ways, as far as the windows that picked the anchor reach: first all at once (the zone, most of the repeated
text), then, where zones differ, window by window. Matched windows that touch make one maximal repeat. Extension compares
128-bit digests of the words, so that no two documents of a large group need to be laid side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedweb.llm.hashing import WORD_BASE, run_hashes, span_hashes
from deedweb.llm.rows import blocks, others, rank, row_key, small_batches, spare
from deedweb.scratch import discard, written

#: The type of a digest: 128 bits.
DIGEST = "struct<a: bigint, b: bigint>"

WINDOW, SEED_WORDS = 50, 8


def spaced(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a UTF-8 text, which ASCII white space splits, joined by one space; where each begins and ends."""
    data = b" ".join(data.split())
    if not data:
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return data, np.append(0, gaps + 1), np.append(gaps, len(data))


def digests(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH3 of 128 bits of each span of bytes, as two signed numbers. It stands for the words of the span: among 10^12 spans,
    the chance that any two that differ have equal digests is below 10^-14."""
    view = memoryview(data)
    found = b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(found, "<i8").reshape(-1, 2)


def zones(data: bytes, window: int) -> tuple[np.ndarray, ...]:
    """The anchors of one text: hash of the anchor, digest of its zone, first window and number of windows that picked it.

    Of the windows' seeds, the smallest hash is picked, the first of equal ones. The zone is all words of these windows. The
    hash of an anchor only brings zones together; whether they are equal, the digest of their words says.
    """
    data, starts, ends = spaced(data)
    n = len(starts) - window + 1
    size = min(SEED_WORDS, window)
    if n <= 0:
        return tuple(np.zeros(s, np.int64) for s in (0, (0, 2), 0, 0))
    words = span_hashes(np.frombuffer(data, np.uint8), starts, ends)
    at = np.arange(len(words) - size + 1)
    seeds = run_hashes(words, WORD_BASE, at, at + size)
    picked = np.arange(n) + np.lib.stride_tricks.sliding_window_view(seeds, window - size + 1).argmin(axis=1)
    first = np.flatnonzero(np.diff(picked, prepend=-1))
    count = np.diff(first, append=n)
    return seeds[picked[first]].view(np.int64), digests(data, starts[first], ends[first + count + window - 2]), first, count


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key`` (of the row: id and text), ``rank`` (of the id), ``text``."""
    return docs.select(
        row_key(docs, id_col, text_col).alias("key"), rank(docs, id_col).alias("rank"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def _types(keyed: DataFrame) -> str:
    return ", ".join(f"{n} {keyed.schema[n].dataType.simpleString()}" for n in ("key", "rank"))


def anchors(keyed: DataFrame, window: int) -> DataFrame:
    """``key, rank, anchor, zone`` (struct of two longs), ``first, count`` for each zone of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, 2):
            found = [zones(x.as_buffer().to_pybytes(), window) for x in part.column(2)]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            anchor, zone, first, count = (np.concatenate([f[i] for f in found]) for i in range(4))
            columns = [pa.array(anchor), _pairs(zone), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(1).take(rows), *columns], ["key", "rank", "anchor", "zone", "first", "count"]
            )

    return small_batches(keyed).mapInArrow(run, f"{_types(keyed)}, anchor long, zone {DIGEST}, first int, count int")


def _pairs(found: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(found[:, i])) for i in (0, 1)], ["a", "b"])


def _windows(open_zones: DataFrame, keyed: DataFrame, window: int) -> DataFrame:
    """``key, rank, start, words`` (digest) for each window of the zones ``key, at array<struct<first, count>>``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, 2):
            rows, starts, found = [], [], []
            for i, (text, spans) in enumerate(zip(part.column(2), part.column(3).to_pylist(), strict=True)):
                data, begins, ends = spaced(text.as_buffer().to_pybytes())
                own = np.concatenate([np.arange(s["first"], s["first"] + s["count"]) for s in spans])
                rows.append(np.full(len(own), i))
                starts.append(own)
                found.append(digests(data, begins[own], ends[own + window - 1]))
            take = pa.array(np.concatenate(rows))
            columns = [pa.array(np.concatenate(starts).astype(np.int32)), _pairs(np.concatenate(found))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), part.column(1).take(take), *columns], ["key", "rank", "start", "words"]
            )

    with_text = keyed.join(open_zones, "key").select("key", "rank", "text", "at")
    return small_batches(with_text).mapInArrow(run, f"{_types(keyed)}, start int, words {DIGEST}")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``key`` (struct of the row's id and text hash), ``spans`` (array of word positions [start, end)): the maximal runs of
    words that are covered by windows which also start in a document with a smaller id. Spans are in order, apart from each
    other, and at least ``window`` words long. Rows without such windows are left out.
    """
    keyed = _keyed(docs, id_col, text_col)
    table = written(anchors(keyed, window), "anchors")
    # Seeds: the anchors that two documents or more hold, and whether their zones differ.
    limits = (f(c).alias(f"{c.replace('.', '_')}_{k}") for c in ("rank", "zone.a") for f, k in ((F.min, "low"), (F.max, "high")))
    shared = table.groupBy("anchor").agg(*limits).where("rank_low <> rank_high")
    shared = shared.select(F.struct("anchor").alias("seed"), (F.col("zone_a_low") != F.col("zone_a_high")).alias("mixed"))
    seeds = written(table.join(shared, F.struct("anchor") == shared["seed"]).drop("seed", "anchor"), "seeds")
    discard(table)
    # Extension, all at once: zones whose words are those of a zone in a smaller document.
    lowest = seeds.groupBy("zone").agg(F.min("rank").alias("zone_rank"))
    lowest = lowest.select(F.struct("zone").alias("same"), "zone_rank")
    held = written(seeds.join(lowest, F.struct("zone") == lowest["same"]).drop("same"), "zones")
    discard(seeds)
    covered = held.where("zone_rank < rank").select("key", F.col("first").alias("start"), (F.col("first") + F.col("count")).alias("end"))
    # Extension, window by window: the first document of each zone, where the anchor has other zones. A zone in the
    # smallest document of its anchor has no smaller one to match, but others match it.
    open_zones = held.where("mixed and zone_rank = rank").groupBy("key").agg(F.collect_set(F.struct("first", "count")).alias("at"))
    windows = written(_windows(open_zones, keyed, window), "windows")
    first = windows.groupBy("words").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).where("low <> high")
    first = first.select(F.struct("words").alias("same"), "low")
    hits = windows.join(first, F.struct("words") == first["same"]).where("low < rank")
    hits = hits.select("key", "start", (F.col("start") + 1).alias("end"))
    # Windows [start, end) to words, and touching runs to one.
    starts = covered.unionByName(hits).distinct()
    spans = starts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("end") + window - 1).alias("end")))).alias("spans"))
    return spans.select("key", _joined(F.col("spans")).alias("spans"))


def _joined(spans: F.Column) -> F.Column:
    """Sorted spans, with those that touch or overlap joined."""
    none = F.array().cast("array<struct<start: int, end: int>>")

    def step(done: F.Column, span: F.Column) -> F.Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, none, step)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows and columns of ``docs``, plus ``n_words``, ``n_removed`` (long) and ``kept_text`` (the words that stay,
    joined by one space).

    Words are runs of characters other than ASCII white space, unchanged. A word goes if a window of ``window``
    consecutive words covers it whose words, in order, also start in a document with a smaller id; the input decides, not
    what is left of it. So the document with the smallest id keeps every passage, and repeats inside one document stay. A
    null text has no words (``kept_text`` is empty). A null id comes after all others; rows with the same id, or both
    without one, take nothing from each other. Repeated rows are repeated in the result. An empty table gives an empty
    result. A column of ``docs`` that has the name of a new one, in whatever case, is replaced. Ids may be of any type that
    can be ordered. A very long text is worked on by itself, in memory that grows with it.
    """
    found = repeats(docs, id_col, text_col, window)
    columns = others(docs, "n_words", "n_removed", "kept_text")
    text = F.coalesce(docs[text_col], F.lit(""))
    key, spans_at, text_at = spare(docs, "key"), len(columns) + 1, len(columns)
    keyed = docs.select(*columns, text.alias(spare(docs, "text_before")), row_key(docs, id_col, text_col).alias(key))
    spans = found.select(F.col("key").alias(key), F.col("spans").alias(spare(docs, "spans")))
    joined = keyed.join(spans, key, "left").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text_at):
            all_words, removed, kept = [], [], []
            for text, spans in zip(part.column(text_at), part.column(spans_at), strict=True):
                words = text.as_buffer().to_pybytes().split()
                all_words.append(len(words))
                for span in reversed(spans.as_py() or []):
                    del words[span["start"] : span["end"]]
                removed.append(all_words[-1] - len(words))
                kept.append(b" ".join(words))
            new = [pa.array(all_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*part.columns[:text_at], *new], schema.names)

    schema = docs.select(*columns).schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return small_batches(joined).mapInArrow(run, schema)
