"""Best-fit packing by hierarchical residual packing.

Documents become pieces of at most ``limit`` tokens. Each partition packs its pieces by best fit, longest first, and emits
the bins that are nearly full. What is left under-full goes up a tree: whole bins are the items of the next round of best
fit, in fewer and fewer tasks, until a round joins none.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deedweb.llm.bpe import byte_letters, lists_of_ids
from deedweb.llm.rows import blocks, small_batches
from deedweb.llm.words import PATTERN, cutter, pieces
from deedweb.scratch import written

LIMIT = 2048
#: The pattern's library gives up on runs of white space of about a million characters, so from far below that on, a part with such a
#: run is left to the tokenizers library.
LONG_SPACE = re.compile(r"\s{65536}")
#: Items that one call of best fit holds at most.
CHUNK = 1 << 16


class Encoder:
    """A tokenizers file. If it is of the byte-level kind with the usual pattern, and its merges are in the order of the ids
    that they make, the ids are computed by the tiktoken library from the same vocabulary, which gives the same and takes a
    fifth of the time; other files are left to the tokenizers library."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        kind, model, added = spec["pre_tokenizer"] or {}, spec["model"], spec["added_tokens"]
        self.added = {x["content"]: x["id"] for x in added}
        self.cut = cutter(self.added)
        self.ranks = None
        made = [x.replace(" ", "") if isinstance(x, str) else "".join(x) for x in model.get("merges", [])]
        if (
            spec["normalizer"] is None
            and kind.get("type") == "ByteLevel"
            and kind.get("use_regex")
            and not kind.get("add_prefix_space")
            and model["type"] == "BPE"
            and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
            and [*map(model["vocab"].get, made)] == [*range(256, 256 + len(made))]
        ):
            back = {x: i for i, x in enumerate(byte_letters())}
            ranks = {bytes(map(back.__getitem__, t)): i for t, i in model["vocab"].items() if i not in self.added.values()}
            self.ranks = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self.ranks:
            return self._by_library(text)
        return b"".join([self.added[x].to_bytes(4, "little") if special else self._plain(x) for x, special in pieces(text, self.added, self.cut)])

    def _by_library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, part: str) -> bytes:
        if len(part) >= 1 << 16 and LONG_SPACE.search(part):
            return self._by_library(part)
        return self.ranks.encode_to_numpy(part, disallowed_special=()).astype("<u4").tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each worker and path."""
    return Encoder(path)


def cuts(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: as few as there can be; only the first may be shorter than the limit."""
    first = length % limit or min(length, limit)
    return [(0, first), *((at, limit) for at in range(first, length, limit))]


def token_pieces(
    docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", crc32: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids array<int>`` for each piece of each row's text, whose ids end with ``end_id``.
    A null text counts as empty, so it has one piece of one id. With ``crc32``, ``ids_crc32`` (of the ids as little-endian
    unsigned 32-bit integers) takes the place of ``ids``, in the same pass: a second one would hold a second Python worker
    for each task."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32" if crc32 else "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = encoder(path), end_id.to_bytes(4, "little")
        for part in blocks(batches, 1):
            rows: list[tuple] = []
            for i, text in enumerate(part.column(1)):
                ids = known.encode(text.as_py() or "") + end
                rows += (
                    (i, k, start, n, ids[4 * start : 4 * (start + n)]) for k, (start, n) in enumerate(cuts(len(ids) // 4, limit))
                )
            which, piece, start, n, ids = zip(*rows, strict=True)
            last = pa.array(map(zlib.crc32, ids), pa.int64()) if crc32 else lists_of_ids(ids)
            columns = [part.column(0).take(pa.array(which)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), last]
            yield pa.RecordBatch.from_arrays(columns, names)

    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    last = "ids_crc32 long" if crc32 else "ids array<int>"
    return small_batches(plain).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, {last}")


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best fit, longest first: the bin and the offset of each item, and what each bin holds.

    ``open_bins`` has the bins by the room they have left; the bits of ``rooms`` say which rooms occur, so the smallest
    room that is large enough is found with two integer operations.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(limit + 1)]
    held: list[int] = []
    rooms = 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = limit, len(held)
            held.append(0)
        bins[i], offsets[i] = b, held[b]
        held[b] += need
        left = room - need
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, held


def _round(items: DataFrame, number: int, limit: int) -> DataFrame:
    """``item, bin, offset, filled`` for the rows ``item long, length long``: best fit inside each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = number << 56 | TaskContext.get().partitionId() << 36
        held: list[pa.RecordBatch] = []

        def pack() -> pa.RecordBatch:
            nonlocal base
            table = pa.Table.from_batches(held)
            held.clear()
            bins, offsets, filled = best_fit(table["length"].to_numpy(), limit)
            columns = [table["item"].combine_chunks(), pa.array(base + bins), pa.array(offsets), pa.array(np.array(filled, np.int64)[bins])]
            base += len(filled)
            return pa.RecordBatch.from_arrays(columns, ["item", "bin", "offset", "filled"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= CHUNK:
                yield pack()
        if sum(x.num_rows for x in held):
            yield pack()

    return items.select("item", "length").mapInArrow(run, "item long, bin long, offset long, filled long")


def place(items: DataFrame, limit: int = LIMIT, slack: int = 16, fan_in: int = 8) -> DataFrame:
    """``item, sequence_id, offset`` for the rows ``item long`` (no two alike), ``length long`` (1 to ``limit``).

    A bin is nearly full when at most ``slack`` tokens are left. Each round has ``fan_in`` times fewer tasks than the one
    before, but enough that none gets more than about ``CHUNK`` bins, so time and memory of a task are bounded at any
    number of bins. The tree ends with a round of one task or one that joins nothing.
    """
    now = written(_round(items, 0, limit), "bins-0")
    placed = now.select("item", "bin", "offset")
    tasks = items.rdd.getNumPartitions()
    for number in count(1):
        low = now.where(F.col("filled") < limit - slack)
        left = written(low.select(F.col("bin").alias("item"), F.col("filled").alias("length")).distinct(), f"left-{number}")
        n = left.count()
        if not n:
            break
        tasks = max(1, tasks // fan_in, math.ceil(n / CHUNK))
        now = written(_round(left.repartition(tasks), number, limit), f"bins-{number}")
        up = now.select(F.col("item").alias("bin"), F.col("bin").alias("up"), F.col("offset").alias("more"))
        placed = placed.join(up, "bin", "left").select(
            "item", F.coalesce("up", "bin").alias("bin"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset")
        )
        if tasks == 1 or now.select("bin").distinct().count() == n:
            break
    return placed.select("item", F.col("bin").alias("sequence_id"), "offset")


def pack(
    docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", slack: int = 16
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``start`` counts the ids of the document before the piece; a sequence holds at most ``limit`` tokens, without gaps
    from offset 0. A null or empty text is one piece, the end id. Every row is a document of its own: repeated rows and
    null ids are packed like others. Other columns are not read; an empty table gives an empty result. The tokenizer file
    at ``path`` must be readable on every executor.
    """
    pieces = token_pieces(docs, path, limit, end_id, id_col, text_col, crc32=True)
    pieces = written(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    return pieces.join(place(pieces, limit, slack), "item").drop("item")
