"""Document fingerprints from improbable features.

Every window of ``WINDOW`` bytes has an entropy; the rarer its entropy is in the corpus, the better the window marks a
document. Windows that are the rarest of enough of their neighbourhoods are selected and inserted into a chain of Bloom
filters, and two chains are compared by how far their filters' bits overlap beyond chance.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedweb.llm.hashing import BYTE_BASE, mixed, run_hashes
from deedweb.llm.rows import BLOCK_BYTES, id_type, row_id, small_batches

#: Bytes of a window; windows of a neighbourhood; of how many neighbourhoods a selected window is the rarest.
WINDOW, AROUND, POPULAR = 32, 64, 16
#: Bins of the entropy histogram; bits and features of a Bloom filter, and bits for each feature.
BINS, FILTER_BITS, FILTER_FEATURES, HASHES = 512, 2048, 160, 5
_COUNTS = np.arange(1, WINDOW + 1)
#: c log2 c in units of 2^-16, for each number of times that a byte is in the window.
_TERMS = np.concatenate(([0], np.round(_COUNTS * np.log2(_COUNTS) * 65536))).astype(np.int64)


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The histogram bin of each window's byte entropy. For a text shorter than a window: of its bytes, once."""
    n = len(data)
    if n < WINDOW:
        total = int(_TERMS[np.bincount(data, minlength=1)].sum()) if n else 0
        return np.array([_bin(np.array([total]))[0]]) if n else np.zeros(0, np.int64)
    # How often each byte is in the WINDOW - 1 bytes before it, and after it.
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, WINDOW):
        same = data[k:] == data[:-k]
        before[k:] += same
        after[:-k] += same
    gains = _TERMS[1:] - _TERMS[:-1]
    first = int(_TERMS[np.bincount(data[:WINDOW])].sum())
    steps = gains[before[WINDOW:]] - gains[after[: n - WINDOW]]
    return _bin(first + np.concatenate(([0], np.cumsum(steps))))


def _bin(terms: np.ndarray) -> np.ndarray:
    most = int(_TERMS[WINDOW])
    return terms * (BINS - 1) // most


def histogram(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many windows of all whole texts fall in each bin: ``BINS`` numbers, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(entropy_bins(np.frombuffer(text.as_buffer(), np.uint8)), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(total)], ["bin", "n"])

    texts = docs.select(docs[text_col].alias("text")).where("text <> ''")
    rows = small_batches(texts).mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BINS, np.int64)
    for r in rows:
        out[r["bin"]] = r["n"]
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Ranks of the bins, 0 for the rarest. Windows of little entropy (runs of one byte, under 1 bit) rank last."""
    rank = np.empty(BINS, np.int64)
    rank[np.lexsort((np.arange(BINS), counts))] = np.arange(BINS)
    dull = np.arange(BINS) > (BINS - 1) * (1 - 1 / np.log2(WINDOW))
    return rank + BINS * dull


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values, by running minima inside blocks, forwards and backwards."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.int64).max)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def features(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Hashes of the selected windows, in order, each once. A text with fewer windows than a neighbourhood has one
    feature, its rarest window; a text shorter than a window is a feature itself; an empty one has none."""
    bins = entropy_bins(data)
    if not len(bins):
        return np.zeros(0, np.uint64)
    if len(data) < WINDOW:
        return run_hashes(data.astype(np.uint64) + np.uint64(1), BYTE_BASE, np.array([0]), np.array([len(data)]))
    keys = (ranks[bins] << 40) + np.arange(len(bins))
    if len(keys) < AROUND:
        chosen = np.array([keys.min() & ((1 << 40) - 1)])
    else:
        picked, times = np.unique(_lowest(keys, AROUND) & ((1 << 40) - 1), return_counts=True)
        chosen = picked[times >= POPULAR]
        if not len(chosen):
            chosen = picked[[times.argmax()]]
    at = chosen[:, None] + np.arange(WINDOW)
    values = (data[at].astype(np.uint64) + np.uint64(1)).reshape(-1)
    ends = np.arange(1, len(chosen) + 1) * WINDOW
    hashes = run_hashes(values, BYTE_BASE, ends - WINDOW, ends)
    return hashes[np.sort(np.unique(hashes, return_index=True)[1])]


def chain(hashes: np.ndarray) -> np.ndarray:
    """A Bloom filter for each ``FILTER_FEATURES`` features, as rows of bits."""
    filters = np.zeros((-(-len(hashes) // FILTER_FEATURES), FILTER_BITS), bool)
    which = np.arange(len(hashes)) // FILTER_FEATURES
    for i in range(HASHES):
        filters[which, (mixed(hashes + np.uint64(i)) % np.uint64(FILTER_BITS)).astype(np.int64)] = True
    return filters


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the mean, over the filters of the shorter chain, of the best overlap with a filter of the other, where 0 is
    what chance gives and 1 is all that the emptier filter has. Two empty chains are alike, an empty one and another not."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(not len(b))
    x, y = a.astype(np.float32), b.astype(np.float32)
    ones_a, ones_b = x.sum(1)[:, None], y.sum(1)[None, :]
    chance, most = ones_a * ones_b / FILTER_BITS, np.minimum(ones_a, ones_b)
    score = np.clip((x @ y.T - chance) / np.maximum(most - chance, 1), 0, 1)
    score[most <= chance] = 1.0
    return float(score.max(axis=1).mean())


def packed(filters: np.ndarray) -> str:
    """A chain as text: base64 of its filters' bits."""
    return base64.b64encode(np.packbits(filters, axis=1).tobytes()).decode()


def unpacked(text: str) -> np.ndarray:
    return np.unpackbits(np.frombuffer(base64.b64decode(text), np.uint8)).reshape(-1, FILTER_BITS).astype(bool)


def digest(text: str, ranks: np.ndarray) -> np.ndarray:
    return chain(features(np.frombuffer(text.encode(), np.uint8), ranks))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: np.ndarray | None = None) -> DataFrame:
    """``doc_id, fingerprint`` for each row; the ranks are those of the corpus itself unless given.

    Equal texts have equal fingerprints; a null text counts as empty, and the fingerprint of an empty text is empty. Null ids
    and repeated rows pass through; other columns are not read; an empty table gives an empty result.
    """
    known = rarity(histogram(docs, text_col)) if ranks is None else ranks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [packed(digest(x.as_py() or "", known)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return small_batches(plain).mapInArrow(run, f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, fingerprint string")


#: Rows sampled for each shuffle partition, to cut the order of all rows.
SAMPLED = 40


def _placed(rows: list[tuple]) -> list[tuple]:
    """(id, hash) in descending order of ids, without one last, and of equal ids in ascending order of hashes."""
    rows = sorted(rows, key=lambda r: r[1])
    return sorted((r for r in rows if r[0] is not None), key=lambda r: r[0], reverse=True) + [r for r in rows if r[0] is None]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, slot, ahead``, sorted inside each partition so that the row after each one is the next document in
    descending order of ids; the last is followed by the first. Rows with ``ahead`` only follow.

    A bounded sample of the rows' places cuts the order into slots of even size, and texts are shuffled once, by slot. The
    first row of each slot also goes to the end of the slot before it: one row more for each slot. Null ids come last; rows
    with equal ids are ordered, and dealt to slots, by a hash of their texts. Ids may be of any type that can be ordered.
    """
    kind = id_type(docs, id_col)
    rows = docs.select(row_id(docs, id_col).alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("order", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = rows.select("doc_id", "order").orderBy(F.xxhash64("doc_id", "order")).limit(SAMPLED * parts).collect()
    sample = _placed([(r["doc_id"], r["order"]) for r in sample])
    cuts = [sample[i * len(sample) // (2 * parts)] for i in range(1, 2 * parts)] if sample else []
    cuts = list(dict.fromkeys(cuts))
    edge_type = f"array<struct<id: {kind}, order: bigint>>"
    edges = (F.array(*(F.struct(F.lit(i).cast(kind).alias("id"), F.lit(h).alias("order")) for i, h in cuts)) if cuts else F.array()).cast(edge_type)
    none = F.col("doc_id").isNull()

    def reached(c: F.Column) -> F.Column:
        """Whether a row is at a cut or after it."""
        later = (c["id"] > F.col("doc_id")) | ((c["id"] == F.col("doc_id")) & (c["order"] <= F.col("order")))
        return F.when(none != c["id"].isNull(), none).when(none, c["order"] <= F.col("order")).otherwise(later)

    rows = rows.withColumn("slot", F.size(F.filter(edges, reached)))
    # The first row of a slot: the largest id, and of its rows the smallest hash.
    first = F.max(F.struct((~none).alias("known"), "doc_id", F.bitwise_not("order").alias("less"))).alias("head")
    found = rows.groupBy("slot").agg(first).collect()
    heads = sorted(((r["slot"], r["head"]["doc_id"], ~r["head"]["less"]) for r in found), key=lambda h: h[0])
    before = {head[0]: heads[i - 1][0] for i, head in enumerate(heads)}  # the first slot's head follows the last slot
    if not heads:
        return rows.select("doc_id", "text", "slot", F.lit(False).alias("ahead"))
    schema = f"slot int, head_id {kind}, head_order long, before int"
    table = docs.sparkSession.createDataFrame([(*h, before[h[0]]) for h in heads], schema)
    keyed = rows.join(F.broadcast(table), "slot", "left")
    places = F.when(
        F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("order") == F.col("head_order")),
        F.array(
            F.struct(F.col("slot").alias("slot"), F.lit(False).alias("ahead")),
            F.struct(F.col("before").alias("slot"), F.lit(True).alias("ahead")),
        ),
    ).otherwise(F.array(F.struct(F.col("slot").alias("slot"), F.lit(False).alias("ahead"))))
    dealt = keyed.select("doc_id", "text", "order", F.explode(places).alias("at")).select("doc_id", "text", "order", "at.*")
    return (
        dealt.repartition(parts, "slot")
        .sortWithinPartitions("slot", "ahead", F.col("doc_id").desc_nulls_last(), "order")
        .select("doc_id", "text", "slot", "ahead")
    )


def edited(text: str, after: str) -> str:
    """``text`` with its second half (rounded down) replaced by as many of the first code points of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def edit_probe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How fingerprints stand an edit: one row per input row with ``doc_id, n_chars, edited_text, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text has its second half replaced by the beginning of the next document, in descending order of ids (see
    ``with_next``). ``near_edited`` and ``near_next`` say how like the document's fingerprint is to that of its edited text,
    and of the next document. A null text counts as empty. A table of one row has that row as the next one. Repeated rows
    are neighbours; an empty table gives an empty result. Very long texts: a task holds two of them and some ``BLOCK_BYTES`` of results.
    """
    known = rarity(histogram(docs, text_col))
    names = ("doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # a row that waits for the next one
        out: list[tuple] = []
        waiting = 0  # characters of edited texts in out

        def row(now: tuple, after: tuple) -> tuple:
            changed = edited(now[1], after[1])
            again = digest(changed, known)
            return (
                now[0], len(now[1]), changed, packed(now[2]), packed(again), likeness(now[2], again), likeness(now[2], after[2])
            )

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            out.clear()
            kinds = (None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, k or own) for c, k in zip(columns, kinds, strict=True)], list(names))

        own = pa.null()
        for batch in batches:
            own = batch.column(0).type
            for doc_id, text, slot, ahead in zip(*batch.columns, strict=True):
                text = text.as_py()
                here = (doc_id.as_py(), text, digest(text, known), slot.as_py())
                if held and held[3] == here[3]:
                    out.append(row(held, here))
                    waiting += len(out[-1][2])
                held = None if ahead.as_py() else here
                if len(out) >= 500 or waiting > BLOCK_BYTES:
                    yield flush()
                    waiting = 0
        if out:
            yield flush()

    schema = (
        f"doc_id {id_type(docs, id_col)}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return small_batches(with_next(docs, id_col, text_col)).mapInArrow(run, schema)
