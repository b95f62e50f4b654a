"""Byte-pair encoding and decoding.

A text is cut at added tokens and then into pretokens; a pretoken's bytes become a doubly linked list of symbols, and a
priority queue of merge ranks says which neighbours join next. Entries whose neighbours have changed since are stale and
skipped.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from deedweb.llm.rows import blocks, small_batches
from deedweb.llm.words import WordTokens


#: Bytes of a pretoken from which on typed arrays take the place of lists, and ids that are decoded at once.
LONG_PIECE, DECODED = 1 << 16, 1 << 18


def byte_letters() -> list[str]:
    """The printable stand-in for each byte: itself where it is printable Latin-1, else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    odd = [b for b in range(256) if b not in plain]
    return [chr(b if b in plain else 0x100 + odd.index(b)) for b in range(256)]


class Vocabulary:
    """The vocabulary, merges and added tokens of a tokenizer file of the byte-level BPE kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        back = {x: i for i, x in enumerate(letters)}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.text = [b""] * (1 + max([*ids.values(), *self.added.values()]))
        for token, i in ids.items():
            self.text[i] = bytes(back[x] for x in token) if all(x in back for x in token) else token.encode()
        for token, i in self.added.items():
            self.text[i] = token.encode()
        self.byte_ids = [ids[x] for x in letters]
        #: For each left symbol, the right symbols that it joins with: rank of the merge and symbol that it makes.
        self.merges: list[dict[int, tuple[int, int]]] = [{} for _ in self.text]
        #: The pair of each merge and the symbol that it makes, by rank.
        self.pairs: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a]].setdefault(ids[b], (rank, ids[a + b]))
            self.pairs.append((ids[a], ids[b], ids[a + b]))
        self.words = WordTokens(self._ids, self.added)

    def _ids(self, pretoken: str) -> bytes:
        piece = pretoken.encode()
        return array("I", self.merged(piece)).tobytes() if len(piece) <= LONG_PIECE else self.merged_long(piece).tobytes()

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one pretoken."""
        symbols = [self.byte_ids[b] for b in piece]
        n, merges = len(symbols), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i, (left, right) in enumerate(pairwise(symbols)):
            if found := merges[left].get(right):
                queue.append((found[0], i, left, right, found[1]))
        heapify(queue)
        while queue:
            _, i, left, right, made = heappop(queue)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # stale: a neighbour has changed
            symbols[i], symbols[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges[made].get(symbols[k]):
                    heappush(queue, (found[0], i, made, symbols[k], found[1]))
            if (h := before[i]) >= 0 and (found := merges[symbols[h]].get(made)):
                heappush(queue, (found[0], h, symbols[h], made, found[1]))
        return [x for x in symbols if x >= 0] if -1 in symbols else symbols

    def merged_long(self, piece: bytes) -> np.ndarray:
        """The same for a very long pretoken, in some forty bytes for each of its own: lists are typed arrays, and the queue holds the
        ranks that wait, each with an array of the places where its pair was seen."""
        n, merges = len(piece), self.merges
        symbols = array("i", np.array(self.byte_ids, np.int32)[np.frombuffer(piece, np.uint8)].tobytes())
        after, before = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes()), array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
        waiting: dict[int, array] = {}
        ranks: list[int] = []

        def wait(rank: int, i: int) -> None:
            if rank not in waiting:
                waiting[rank] = array("i")
                heappush(ranks, rank)
            waiting[rank].append(i)

        for i in range(n - 1):
            if found := merges[symbols[i]].get(symbols[i + 1]):
                wait(found[0], i)
        while ranks:
            rank = heappop(ranks)
            left, right, made = self.pairs[rank]
            places = array("i", np.sort(np.frombuffer(waiting.pop(rank), np.int32)).tobytes())
            for at, i in enumerate(places):
                j = after[i]
                if symbols[i] != left or j >= n or symbols[j] != right:
                    continue  # stale: a neighbour has changed
                symbols[i], symbols[j] = made, -1
                after[i] = k = after[j]
                if k < n:
                    before[k] = i
                    if found := merges[made].get(symbols[k]):
                        wait(found[0], i)
                if (h := before[i]) >= 0 and (found := merges[symbols[h]].get(made)):
                    wait(found[0], h)
                if ranks and ranks[0] < rank:  # that one comes first
                    for rest in places[at + 1 :]:
                        wait(rank, rest)
                    break
        found = np.frombuffer(symbols, np.int32)
        return found[found >= 0].astype("<u4")

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.words.encode(text)

    def decode(self, ids: Sequence[int]) -> str:
        parts = (ids[i : i + DECODED] for i in range(0, len(ids), DECODED))
        return b"".join([b"".join(map(self.text.__getitem__, x.tolist() if isinstance(x, np.ndarray) else x)) for x in parts]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One for each worker and path."""
    return Vocabulary(path)


def lists_of_ids(found: list[bytes]) -> pa.Array:
    """An Arrow list array of the ids, four bytes each."""
    ends = np.cumsum([0, *map(len, found)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` for each row, as the tokenizer file at ``path`` encodes its whole text, with its added
    tokens recognised and none put around it. The path must be readable on every executor.

    A null or empty text has no ids. A very long text is split into parts between words; a very long run without a break takes some
    forty bytes for each of its own. Null ids and repeated rows pass
    through; ids may be of any type; other columns are not read; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for part in blocks(batches, 1):
            found = [known.encode(x.as_py() or "") for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), lists_of_ids(found)], ["doc_id", "ids"])

    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return small_batches(plain).mapInArrow(run, f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` for the rows of ``encode``: the strings of the ids, joined. Special tokens are not skipped;
    bytes that are no UTF-8 become U+FFFD. Null ids count as none; an id outside the vocabulary raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for part in blocks(batches, 1):
            texts = [known.decode(x.values.to_numpy() if x.is_valid else []) for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    plain = encoded.select("doc_id", "ids")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return small_batches(plain).mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (binary: little-endian unsigned 32-bit integers), ``text``: what ``encode`` gives for each
    row and what ``decode`` makes of it, in one pass, so that a task holds one Python worker and one vocabulary. Rows are
    handled as by ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for part in blocks(batches, 1):
            found = [known.encode(x.as_py() or "") for x in part.column(1)]
            texts = [known.decode(np.frombuffer(x, "<u4")) for x in found]
            n = pa.array([len(x) // 4 for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), n, pa.array(found, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "text"]
            )

    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return small_batches(plain).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, text string")
