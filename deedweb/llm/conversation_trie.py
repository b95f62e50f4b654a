"""A prefix trie over conversations: what they share, and how much of it need not be computed again.

A conversation is a sequence of turns; a turn is a digest of its role and text with the number of the text's code points. Each
distinct sequence of first turns is a node. Conversations of equal turns are folded first. Then they are cut into shards by their first
turns: one more turn for as long as more than ``SHARD_TURNS`` turns share them. A task packs its shards into double arrays
(``BASE`` and ``CHECK`` over dense ids of the turns), follows each sequence through them to fill the nodes, and sums nodes up from
the leaves. The nodes above the shards are few; their sums are merged globally from those of the shards' tops.

Nothing gathers a whole conversation or group of copies: turns get their places from a sort by range, sequences are cut into segments of
``SEGMENT`` turns, and lists of ids are hashed as a stream of chunks. A segment that begins in the middle of a conversation
belongs to the trie below the prefix that it continues; the sums of tries below others move up along one conversation each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedweb.llm.rows import small_batches
from deedweb.scratch import discard, written

#: Turns of a segment, turns that a shard has at most if its sequences part there, turns of the shards that share a double array.
SEGMENT, SHARD_TURNS, ARRAY_TURNS = 512, 1 << 12, 1 << 15
#: Ids of a chunk, as bits.
CHUNK_BITS = 12
#: Free slots that are tried for a node with several children before its children go to the end.
TRIES = 8
ROOT = b""
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _digest(x: Column) -> Column:
    """128 bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(x, 256)), 1, 16)


def _chained(key: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(key + turn).digest()[:16]


def _on(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """A join on columns that both have, through exchanges that can be split where one key has many rows."""
    of = right.select(F.struct(*keys).alias("_of"), *(c for c in right.columns if c not in keys))
    return left.join(of, F.struct(*keys) == F.col("_of"), how).drop("_of")


# Turns in their places


class Turns(NamedTuple):
    """``ordered``: ``conv, digest, size, at``, sorted across partitions; ``starts``: for each conversation and partition, where
    it begins there and how many of its turns are in partitions before; ``convs``: ``conv, n``."""

    ordered: DataFrame
    starts: DataFrame
    convs: DataFrame


def ordered_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> Turns:
    """The turns by conversation and number (a null first); equal numbers go by the turns' digests. The sort is by range, so one
    conversation may reach over many partitions."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(conversations[conv_col].isNotNull()).select(
        conversations[conv_col].cast("long").alias("conv"),
        conversations[turn_col].alias("turn"),
        _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "turn-digests")
    order = ("conv", F.col("turn").asc_nulls_first(), "digest", "row")
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = written(ordered.select("conv", "digest", "size", F.monotonically_increasing_id().alias("at")), "ordered-turns")
    discard(rows)
    starts = ordered.groupBy("conv", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    along = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(starts.withColumn("before", F.coalesce(F.sum("k").over(along), F.lit(0))), "turn-starts")
    return Turns(ordered, starts, starts.groupBy("conv").agg(F.sum("k").alias("n")))


def placed_turns(turns: Turns, convs: DataFrame) -> DataFrame:
    """``conv, place`` (from 0), ``digest, size`` and the other columns of ``convs``."""
    starts = turns.starts.join(convs, "conv").drop("k")
    rows = _on(turns.ordered.withColumn("part", F.shiftright("at", 33)), starts, "conv", "part")
    return rows.withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def plain_sequences(turns: Turns) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: ``conv, length`` and ``conv, place, digest, size, length``."""
    convs = written(turns.convs.withColumnRenamed("n", "length"), "conversations")
    return convs, placed_turns(turns, convs)


def grafted_sequences(turns: Turns, base: Column, taken: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that are rebuilt: the first ``taken`` turns of the conversation ``base`` (all if it has fewer, none if there
    is none), then their own turns after their first ``taken``. Both are columns over ``conv``; ``taken`` is small."""
    convs = turns.convs.select("conv", "n", base.alias("base"), taken.cast("long").alias("taken"))
    bases = turns.convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("lead", F.least("taken", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("length", F.col("lead") + F.greatest(F.lit(0), F.col("n") - F.col("taken")))
    convs = written(convs.select("conv", "base", "taken", "lead", "length"), "conversations")
    placed = written(placed_turns(turns, convs), "placed-turns")
    own = placed.where("place >= taken").withColumn("place", F.col("place") - F.col("taken") + F.col("lead"))
    most = convs.agg(F.max("lead")).first()[0] or 0
    heads = placed.where(F.col("place") < most).select(F.col("conv").alias("base"), "place", "digest", "size")
    given = heads.join(convs, "base").where("place < lead")
    columns = ("conv", "place", "digest", "size", "length")
    return convs.select("conv", "length"), own.select(*columns).unionByName(given.select(*columns))


# Double arrays


class Sequence(NamedTuple):
    """What a shard has of a folded segment. ``more``: (children, leaves, saved) of the trie below its last turn, if any of its
    conversations go on and that is known; None: they go on, and it is not."""

    top: bytes
    turns: list[bytes]
    sizes: list[int]
    n: int
    low: int
    end_key: bytes | None
    more: tuple[int, int, int] | None


class DoubleArray:
    """A trie of sequences of hashable symbols. From slot s, symbol x leads to slot t = base[s] + ids[x] if check[t] is s."""

    def __init__(self, sequences: list[list]):
        self.ids: dict = {}
        self.base, self.check, self.order = [0], [-2], []
        self._low = 1
        queue = [(0, range(len(sequences)), 0)]
        for slot, members, depth in queue:
            groups: dict[int, list[int]] = {}
            for m in members:
                if len(sequences[m]) > depth:
                    groups.setdefault(self.ids.setdefault(sequences[m][depth], len(self.ids)), []).append(m)
            if groups:
                self.base[slot] = base = self._fit(sorted(groups))
                for x, group in groups.items():
                    self.check[base + x] = slot
                    self.order.append(base + x)
                    queue.append((base + x, group, depth + 1))

    def _free(self, slot: int) -> bool:
        return slot >= len(self.check) or self.check[slot] == -1

    def _fit(self, symbols: list[int]) -> int:
        """A base that leads all symbols to free slots, which are added where the arrays end."""
        while not self._free(self._low):
            self._low += 1
        slot, tries = self._low, 0
        while slot < len(self.check) and tries < TRIES and not all(self._free(slot + x - symbols[0]) for x in symbols):
            slot, tries = slot + 1, tries + 1
            while not self._free(slot):
                slot += 1
        if tries == TRIES:
            slot = len(self.check)
        short = slot + symbols[-1] - symbols[0] + 1 - len(self.check)
        if short > 0:
            self.base += [0] * short
            self.check += [-1] * short
        return slot - symbols[0]

    def path(self, sequence: Iterable) -> Iterator[int]:
        """The slots of a sequence's prefixes; a KeyError where the trie does not have it."""
        slot = 0
        for symbol in sequence:
            at = self.base[slot] + self.ids[symbol]
            if not 0 < at < len(self.check) or self.check[at] != slot:
                raise KeyError(symbol)
            slot = at
            yield slot


NODE = ("depth", "low", "parent", "n", "children", "leaves", "saved", "end_key", "top")


def trie_nodes(sequences: list[Sequence], depths: dict[bytes, int]) -> Iterator[tuple]:
    """Rows ``NODE`` for all nodes of some shards; ``depths`` has the depth of each top. A top has no parent here; other
    nodes name no top."""
    keyed = [[s.top, *s.turns] for s in sequences]
    trie = DoubleArray(keyed)
    size = len(trie.check)
    n, low, text, depth, children, leaves, saved = ([0] * size for _ in range(7))
    end_key: list[bytes | None] = [None] * size
    top: list[bytes | None] = [None] * size
    goes_on = [False] * size
    for s, symbols in zip(sequences, keyed, strict=True):
        here = depths[s.top]
        for slot, length in zip(trie.path(symbols), s.sizes, strict=True):
            low[slot] = min(low[slot], s.low) if n[slot] else s.low
            n[slot], text[slot], depth[slot] = n[slot] + s.n, length, here
            here += 1
        top[next(trie.path(symbols))] = s.top
        if s.end_key is not None:
            end_key[slot] = s.end_key
        if s.more is None or s.more[0]:
            goes_on[slot] = True
            children[slot], leaves[slot], saved[slot] = (a + b for a, b in zip((children[slot], leaves[slot], saved[slot]), s.more or (0, 0, 0), strict=True))
    for slot in reversed(trie.order):  # parents come before their children
        if not children[slot] and not goes_on[slot]:
            leaves[slot] = 1
        saved[slot] += (n[slot] - 1) * text[slot]
        above = trie.check[slot]
        children[above], leaves[above], saved[above] = children[above] + 1, leaves[above] + leaves[slot], saved[above] + saved[slot]
    for slot in trie.order:
        parent = None if top[slot] is not None else low[trie.check[slot]]
        yield depth[slot], low[slot], parent, n[slot], children[slot], leaves[slot], saved[slot], end_key[slot], top[slot]


# Segments and shards


def _segments(rows: DataFrame) -> DataFrame:
    """``conv, seg, turns, sizes, content, last``: at most ``SEGMENT`` turns each."""
    seg = F.floor(F.col("place") / SEGMENT).cast("long").alias("seg")
    each = F.array_sort(F.collect_list(F.struct("place", "digest", "size"))).alias("each")
    found = rows.groupBy("conv", seg).agg(each, F.max("length").alias("length"))
    turns = F.transform("each", lambda x: x["digest"])
    return found.select(
        "conv",
        "seg",
        turns.alias("turns"),
        F.transform("each", lambda x: x["size"]).alias("sizes"),
        _digest(F.array_join(F.transform(turns, F.hex), "")).alias("content"),
        ((F.col("seg") + 1) * SEGMENT >= F.col("length")).alias("last"),
    )


def _next(key: Column | str, content: Column | str) -> Column:
    return _digest(F.concat(key, content))


def _with_keys(segments: DataFrame, long: DataFrame) -> DataFrame:
    """The segments with ``key``, the prefix that they continue. Of a long conversation, a digest for each segment is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = ROOT
                for part in parts:
                    rows.append((conv, part["seg"], key))
                    key = _chained(key, part["content"])
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["conv", "seg", "key"])

    parts = segments.select("conv", "seg", "content").join(long, "conv")
    chains = parts.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "content"))).alias("parts"))
    keys = small_batches(chains).mapInArrow(run, "conv long, seg long, key binary")
    return _on(segments, keys, "conv", "seg", how="left").withColumn("key", F.coalesce("key", F.lit(ROOT)))


def _prefixes(hot: DataFrame) -> DataFrame:
    """A row for each prefix of the sequences ``hot``: ``own, d, depth, q, up, below, n, low, size, end_key``."""
    kinds = {"own": "binary", "d": "int", "depth": "long", "q": "binary", "up": "binary", "below": "long", "n": "long", "low": "long", "size": "int", "end_key": "binary"}
    types = [{"binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}[t] for t in kinds.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, key, seg, turns, sizes, n, low, end_key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, q = [], key
                for d, (turn, size) in enumerate(zip(turns, sizes, strict=True), 1):
                    up, q = q, _chained(q, turn)
                    below = len(turns) - d
                    rows.append((own, d, seg * SEGMENT + d, q, up, below, n, low, size, None if below else end_key))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], list(kinds))

    columns = ("own", "key", "seg", "turns", "sizes", "n", "low", "end_key")
    return small_batches(hot.select(*columns)).mapInArrow(run, ", ".join(f"{c} {t}" for c, t in kinds.items()))


def _packed(shards: DataFrame) -> DataFrame:
    """The nodes of shards: ``NODE`` without ``top``, and for tops the prefix ``up`` that they stand below and all upper ones, ``above``."""
    types = (*[pa.int64()] * 7, pa.binary())

    def out(held: list[Sequence], about: dict[bytes, tuple]) -> pa.RecordBatch:
        rows = list(trie_nodes(held, {top: x[0] for top, x in about.items()}))
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        tops = [about.get(r[-1], (None, None, None)) for r in rows]
        columns += [pa.array([t[1] for t in tops], pa.binary()), pa.array([t[2] for t in tops], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, [*NODE[:-1], "up", "above"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Sequence] = []
        about: dict[bytes, tuple] = {}
        packed = 0
        for batch in batches:
            for top, p, seg, up, above, turns, sizes, n, low, end_key, goes_on, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if top not in about and packed >= ARRAY_TURNS:
                    yield out(held, about)
                    held, about, packed = [], {}, 0
                about.setdefault(top, (seg * SEGMENT + p, up, above))
                known = (more["children"], more["leaves"], more["saved"]) if more else None if goes_on else (0, 0, 0)
                held.append(Sequence(top, turns[p:], sizes[p - 1 :], n, low, end_key, known))
                packed += len(turns) - p + 1
        if held:
            yield out(held, about)

    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ("top", "p", "seg", "up", "above", "turns", "sizes", "n", "low", "end_key", "goes_on", "more")
    dealt = small_batches(shards.select(*columns).repartition(parts, "top").sortWithinPartitions("top"))
    kinds = ", ".join(f"{c} long" for c in NODE[:7])
    return dealt.mapInArrow(run, f"{kinds}, end_key binary, up binary, above array<binary>")


class Trie(NamedTuple):
    """``nodes``: all but the root; ``parent`` is null where a node stands below the upper prefix ``up``. ``uppers``: the ``low`` of
    the upper prefixes ``q`` that are nodes. ``sums``: ``q, children, leaves, saved`` below each upper prefix."""

    nodes: DataFrame
    uppers: DataFrame
    sums: DataFrame


def _trie(folded: DataFrame) -> Trie:
    """Shards, their arrays, and what stands above them, from folded segments."""
    folded = folded.withColumn("top", _next("key", F.col("turns")[0]))
    hot = folded.groupBy("top").agg(F.sum(F.size("turns")).alias("weight")).where(F.col("weight") > SHARD_TURNS)
    hot = written(hot.select(F.struct("top").alias("of")), "hot-tops")
    cold = folded.join(hot, F.struct("top") == F.col("of"), "left_anti")
    cold = cold.withColumns({"p": F.lit(1), "up": F.col("key"), "above": F.array("key")})
    shared = written(folded.join(hot, F.struct("top") == F.col("of"), "left_semi"), "hot-sequences")
    prefixes = written(_prefixes(shared), "prefixes")
    low, first = F.min("low").alias("low"), lambda c: F.first(c).alias(c)
    big = prefixes.groupBy("q").agg(
        first("d"), first("depth"), first("up"), F.sum("below").alias("below"), F.sum("n").alias("n"), low, first("size"), F.max("end_key").alias("end_key"), F.min("own").alias("rep")
    )
    big = written(big.where(F.col("below") > SHARD_TURNS), "upper-prefixes")
    marks = _on(prefixes.select("own", "d", "q"), big.select("q"), "q")
    marks = marks.groupBy("own").agg(F.array_sort(F.collect_list(F.struct("d", "q"))).alias("marks"))
    marks = written(marks, "upper-paths")  # as long as a segment at most
    parted = _on(shared, marks, "own", how="left").withColumns({"p": F.coalesce(F.size("marks"), F.lit(0)) + 1})
    above = F.concat(F.array("key"), F.coalesce(F.transform("marks", lambda x: x["q"]), F.array().cast("array<binary>")))
    parted = parted.where(F.col("p") <= F.size("turns")).withColumn("above", above).withColumn("up", F.element_at("above", -1))
    parted = parted.withColumn("top", _next("up", F.element_at("turns", F.col("p")))).drop("marks")
    packed = written(_packed(cold.unionByName(parted)), "packed-nodes")
    tops = packed.where(F.col("up").isNotNull())
    keys = folded.select(F.col("own").alias("rep"), "key")
    ways = _on(_on(big, marks.withColumnRenamed("own", "rep"), "rep"), keys, "rep")
    way = F.concat(F.array("key"), F.transform(F.filter("marks", lambda x: x["d"] <= F.col("d")), lambda x: x["q"]))
    own = ways.select(F.explode(way).alias("q"), F.lit(0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("size")).alias("saved"))
    gained = tops.select(F.explode("above").alias("q"), "leaves", "saved").unionByName(own)
    sums = gained.groupBy("q").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    children = tops.select("up").unionByName(big.select("up")).groupBy("up").agg(F.count(F.lit(1)).alias("children"))
    sums = written(sums.join(children, F.col("q") == F.col("up")).drop("up"), "upper-sums")
    upper = big.join(sums, "q").select("depth", "low", F.lit(None).cast("long").alias("parent"), "n", "children", "leaves", "saved", "end_key", "up")
    return Trie(packed.drop("above").unionByName(upper), big.select("q", "low"), sums)


def _below(keyed: DataFrame, sums: DataFrame) -> DataFrame:
    """``own, more``: what is in the whole trie below the segments ``own`` that conversations go on from. A trie's own sums are
    put on its smallest conversation, summed up along conversations from their ends, and then over the conversations of a trie."""
    way = keyed.where(F.col("key") != F.lit(ROOT)).select("conv", "seg", "key")
    first = way.groupBy("key").agg(F.min("conv").alias("rep"))
    way = _on(_on(way, first, "key"), sums.withColumnRenamed("q", "key"), "key")
    along = Window.partitionBy("conv").orderBy(F.col("seg").desc())
    mine = lambda c: F.sum(F.when(F.col("conv") == F.col("rep"), F.col(c)).otherwise(0)).over(along)
    way = way.withColumns({"leaves": mine("leaves"), "saved": mine("saved")})
    whole = way.groupBy("key").agg(F.first("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return whole.select(F.col("key").alias("own"), F.struct("children", "leaves", "saved").alias("more"))


def _ends(ends: DataFrame) -> DataFrame:
    """``end_key, ends_sha256`` from rows ``end_key, conv``. Ids are joined in chunks, and the chunks of a key hashed as they come
    by, so a key may have any number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if key == now:
                    digest.update(b"," + ids.encode())
                else:
                    if digest:
                        rows.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["end_key", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["end_key", "ends_sha256"])

    chunks = ends.groupBy("end_key", F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    chunks = chunks.select("end_key", "chunk", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(parts, "end_key").sortWithinPartitions("end_key", "chunk")
    return small_batches(dealt).mapInArrow(run, "end_key binary, ends_sha256 string")


RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def conversation_trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """``RESULT`` for each node, from ``conv, length`` and ``conv, place, digest, size, length`` (see ``plain_sequences`` and
    ``grafted_sequences``).

    ``conv_id`` is the smallest conversation that begins with the node's turns (with ``depth`` it names the node), ``parent_conv_id``
    that of its parent, ``n_convs`` their number, ``n_leaves`` the childless nodes of its subtree, itself included;
    ``saved_tokens`` sums, over its subtree, the code points of each node's last text for all of its conversations but one;
    ``ends_sha256`` is the hash of the ids of those that have no further turn.

    A conversation without turns is one of the root's. No conversations: no nodes, not even a root. Rows without a conversation
    are left out before (``ordered_turns``); null roles and texts are empty ones; a repeated row is one more turn; a turn without a
    number comes first, and equal numbers go by the turns' digests. Texts may be very long: only digests of 128 bits are
    shuffled. Other columns are not read.
    """
    spark = convs.sparkSession
    n, least = convs.agg(F.count(F.lit(1)), F.min("conv")).first()
    if not n:
        return spark.createDataFrame([], RESULT)
    segments = written(_segments(rows), "segments")
    long = convs.where(F.col("length") > SEGMENT).select("conv")
    deep = not long.isEmpty()
    keyed = _with_keys(segments, long) if deep else segments.withColumn("key", F.lit(ROOT))
    keyed = written(keyed.withColumn("own", _next("key", "content")), "keyed-segments")
    discard(segments)
    folded = keyed.groupBy("own").agg(
        *(F.first(c).alias(c) for c in ("key", "seg", "turns", "sizes")), F.count(F.lit(1)).alias("n"), F.min("conv").alias("low"), F.max("last").alias("ends"), F.min("last").alias("all")
    )
    nothing = F.lit(None).cast("struct<children: long, leaves: long, saved: long>")
    folded = folded.withColumns({"end_key": F.when(F.col("ends"), F.col("own")), "goes_on": ~F.col("all"), "more": nothing}).drop("ends", "all")
    folded = written(folded, "folded")
    trie = _trie(folded)
    uppers = trie.uppers
    if deep:
        more = written(_below(keyed, trie.sums), "below")
        trie = _trie(_on(folded.drop("more"), more, "own", how="left"))
        uppers = trie.uppers.unionByName(folded.where("goes_on").select(F.col("own").alias("q"), "low"))
    below_root = F.coalesce(F.col("up") == F.lit(ROOT), F.lit(False))
    known = trie.nodes.where(F.col("up").isNull() | below_root).withColumn("parent", F.when(below_root, F.lit(least)).otherwise(F.col("parent")))
    named = _on(trie.nodes.where(~below_root & F.col("up").isNotNull()).drop("parent"), uppers.select(F.col("q").alias("up"), F.col("low").alias("parent")), "up")
    top = trie.sums.where(F.col("q") == F.lit(ROOT)).agg(*(F.max(c).alias(c) for c in ("children", "leaves", "saved")))
    zero = lambda c, x=0: F.coalesce(c, F.lit(x)).cast("long").alias(c)
    root = top.select(
        F.lit(0).cast("long").alias("depth"), F.lit(least).alias("low"), F.lit(None).cast("long").alias("parent"), F.lit(n).alias("n"), zero("children"), zero("leaves", 1), zero("saved"), F.lit(ROOT).alias("end_key")
    )
    nodes = known.drop("up").unionByName(named.drop("up")).unionByName(root)
    ends = keyed.where("last").select(F.col("own").alias("end_key"), "conv")
    ends = _ends(ends.unionByName(convs.where("length = 0").select(F.lit(ROOT).alias("end_key"), "conv")))
    nodes = written(nodes, "trie-nodes")
    inner = nodes.where(F.col("end_key").isNull()).withColumn("ends_sha256", F.lit(None).cast("string"))
    final = inner.unionByName(_on(nodes.where(F.col("end_key").isNotNull()), ends, "end_key", how="left"))
    return final.select(
        F.col("low").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
