"""Documents whose sets of word n-grams have a high Jaccard similarity, by a prefix-filtered join.

Sets that link at a similarity of p per cent share all but d = n - ceil(p n / 100) n-grams of either. So, in any one order of n-grams, they
share one of their first d + 1, their prefixes; the order is from rare to frequent. Sets meet on n-grams of their prefixes; what meets must
pass three filters, each a necessary condition: sizes (length), places of the shared n-gram (position), and the sizes of the
parts that hashes cut the sets into (suffix). What passes is verified once on the whole sets.

- A set can only link if all but d of its n-grams are in another set. That is tested first on one n-gram in ``SAMPLE`` (by hash, so
  the same ones in all documents): no set that links fails, and most others never go further.
- Frequencies are counted in buckets of hashes. Each block of documents asks a bucket for its distinct n-grams and is answered with
  a byte for each, in the same order, so a very frequent n-gram is one entry of a block, whatever the number of documents.
- Groups of near copies would make all their pairs. So candidates are taken in rounds, one for each component that is met, the most
  alike first, and components grow in between; at last, all that is left between different components is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedweb.llm.rows import blocks, id_type, row_id, row_key, small_batches, text_hash
from deedweb.operators.components import connected_components
from deedweb.scratch import discard, written

#: One n-gram in this many is looked at first.
SAMPLE = 6
#: N-grams that a bucket of hashes has, about.
BUCKET = 1 << 21
#: Parts of a set in the suffix filter.
PARTS = 64
#: Rows of a tile of postings.
TILE = 1024
#: Pairs of postings that are looked at together.
CELLS = 1 << 18
#: Rounds in which each component takes its best candidate only.
ROUNDS = 2
#: Bits of the filter that keeps rows from a shuffle, whatever the input.
FILTER_BITS = 1 << 23


def shingle_digests(text: str | None, size: int) -> set[bytes]:
    """XXH3 digests (128 bits) of the distinct runs of ``size`` words; of all words if there are fewer; none without words."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z and ASCII white space only
    if len(words) < size:
        return {xxhash.xxh3_128_digest(b" ".join(words))} if words else set()
    return {xxhash.xxh3_128_digest(b" ".join(x)) for x in zip(*(words[i:] for i in range(size)), strict=False)}


def as_tokens(digests: set[bytes]) -> np.ndarray:
    """The first 64 bits of digests, ascending: what sets are made of from here on."""
    return np.unique(np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)[:, 0])


def allowed(n: Column | np.ndarray | int, percent: int):
    """How many n-grams of a set of ``n`` another may lack: n - ceil(percent * n / 100)."""
    return (100 - percent) * n // 100 if not isinstance(n, Column) else F.floor((100 - percent) * n / 100)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block_id(number: int) -> int:
    return (TaskContext.get().partitionId() << 32) + number


def _document_blocks(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """A row for each block of documents: their ids, hashes of texts, sizes and digests of sets, and the sampled n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(blocks(batches, 2)):
            sizes, digests, sampled = [], [], []
            for x in batch.column(2):
                found = shingle_digests(x.as_py(), shingle)
                tokens = as_tokens(found)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                sampled.append(tokens[tokens % np.uint64(SAMPLE) == 0])
            ends = np.cumsum([len(x) for x in sampled])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_block_id(number)], pa.int64()),
                    *(_one_list(c) for c in (batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()))),
                    _one_list(pa.array(ends, pa.int64())),
                    pa.array([np.concatenate(sampled).tobytes()], pa.binary()),
                ],
                ["block", "ids", "hashes", "sizes", "digests", "ends", "tokens"],
            )

    plain = docs.select(row_id(docs, id_col).alias("doc_id"), text_hash(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
    lists = f"ids array<{id_type(docs, id_col)}>, hashes array<long>, sizes array<int>, digests array<binary>, ends array<long>"
    return small_batches(plain).mapInArrow(run, f"block long, {lists}, tokens binary")


def frequency_class(counts: np.ndarray) -> np.ndarray:
    """A byte that grows with a count: counts below 128 themselves, then four steps for each doubling."""
    high = 128 + np.floor(4 * np.log2(np.maximum(counts, 128) / 128))
    return np.where(counts < 128, counts, np.minimum(high, 255)).astype(np.uint8)


def with_frequencies(table: DataFrame) -> DataFrame:
    """The rows of ``table`` (``block``, unique, and ``tokens``, 64-bit words) with ``classes``: parts that together have the
    frequency class of each distinct token of the block in ascending order.

    A frequency is the number of times that a token is in the blocks (up to 255 in each). Tokens are counted by the first
    bits, which name the bucket, and 32 more; two that agree in these are counted as one, which may only make them frequent.
    """
    total = table.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    bits = max(4, int(np.ceil(np.log2(max(1, total / 8 / BUCKET)))))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens, counts = np.unique(np.frombuffer(raw.as_buffer() or b"", np.uint64), return_counts=True)
                if len(tokens):
                    bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64)
                    keys = (tokens >> np.uint64(32 - bits)).astype(np.uint32)
                    counts = np.minimum(counts, 255).astype(np.uint8)
                    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                    spans = list(zip(cuts, [*cuts[1:], len(tokens)], strict=True))
                    columns = [
                        pa.array(bucket[cuts], pa.int64()),
                        pa.array([block] * len(cuts), pa.int64()),
                        *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (keys, counts)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "keys", "counts"])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(bucket: int, held: list) -> pa.RecordBatch:
            keys = np.concatenate([np.frombuffer(x[1], np.uint32) for x in held])
            counts = np.concatenate([np.frombuffer(x[2], np.uint8) for x in held])
            _, place = np.unique(keys, return_inverse=True)
            classes = frequency_class(np.bincount(place, counts)[place])
            ends = np.cumsum([0, *(len(x[2]) for x in held)])
            parts = [classes[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            columns = [pa.array([x[0] for x in held], pa.int64()), pa.array([bucket] * len(held), pa.int64()), pa.array(parts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "bucket", "classes"])

        now, held = None, []
        for batch in batches:
            for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and held:
                    yield answer(now, held)
                    held = []
                now = bucket
                held.append(rest)
        if held:
            yield answer(now, held)

    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    requests = small_batches(table.select("block", "tokens")).mapInArrow(asked, "bucket long, block long, keys binary, counts binary")
    requests = requests.repartition(parts, "bucket").sortWithinPartitions("bucket")
    answers = requests.mapInArrow(answered, "block long, bucket long, classes binary")
    answers = answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "classes"))).alias("parts"))
    answers = answers.select("block", F.transform("parts", lambda x: x["classes"]).alias("classes"))
    return table.join(answers, "block", "left")


def _block_tokens(raw: pa.Scalar, classes: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a block and the frequency class of each."""
    tokens = np.frombuffer(raw.as_buffer() or b"", np.uint64)
    _, place = np.unique(tokens, return_inverse=True)
    found = np.frombuffer(b"".join(classes.as_py() or []), np.uint8)
    return tokens, found[place] if len(tokens) else found


def _tested(table: DataFrame, kind: str, percent: int) -> DataFrame:
    """``doc_id, text_hash, n, digest, open`` for each document; ``open``: enough of its sampled n-grams are elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, hashes, sizes, digests, ends = (batch.column(k)[i].values for k in range(5))
                _, classes = _block_tokens(batch.column(5)[i], batch.column(6)[i])
                ends = np.concatenate([[0], ends.to_numpy()])
                shared = np.concatenate([[0], np.cumsum(classes >= 2)])[ends]
                n = sizes.to_numpy()
                stays = (np.diff(shared) >= np.diff(ends) - allowed(n, percent)) & (n > 0)
                yield pa.RecordBatch.from_arrays([ids, hashes, sizes, digests, pa.array(stays)], ["doc_id", "text_hash", "n", "digest", "open"])

    counted = with_frequencies(table).select("ids", "hashes", "sizes", "digests", "ends", "tokens", "classes")
    return small_batches(counted).mapInArrow(run, f"doc_id {kind}, text_hash long, n int, digest binary, open boolean")


def maybe_among(rows: DataFrame, h: Column, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose 64-bit hash ``h`` is not in the one column of ``keys``; what is left goes to an exact join.
    The filter is a broadcast table of ``FILTER_BITS`` bits, whatever the number of keys; with very many of them, more rows pass."""
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(FILTER_BITS))
    at = keys.select(place(F.col(keys.columns[0])).alias("at"))
    bits = at.select(F.shiftright("at", 6).alias("_word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit"))
    words = written(bits.groupBy("_word").agg(F.bit_or("bit").alias("_bits")), "filter")  # FILTER_BITS / 64 rows at most
    test = rows.withColumn("_at", place(h)).join(F.broadcast(words), F.shiftright("_at", 6) == F.col("_word"))
    return test.where("shiftright(_bits, cast(_at % 64 as int)) & 1 = 1").drop("_at", "_word", "_bits")


def _set_blocks(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """A row for each block of the documents ``chosen`` (``key, node``): their nodes and whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(blocks(batches, 1)):
            sets = [as_tokens(shingle_digests(x.as_py(), shingle)) for x in batch.column(1)]
            ends = np.cumsum([len(x) for x in sets])
            columns = [
                pa.array([_block_id(number)], pa.int64()),
                _one_list(batch.column(0)),
                _one_list(pa.array(ends, pa.int64())),
                pa.array([np.concatenate(sets).tobytes()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "nodes", "ends", "tokens"])

    texts = docs.select(row_key(docs, id_col, text_col).alias("key"), docs[text_col].alias("text"))
    texts = maybe_among(texts, F.xxhash64("key"), chosen.select(F.xxhash64("key")))
    found = texts.join(chosen, "key").select("node", "text")
    return small_batches(found).mapInArrow(run, "block long, nodes array<long>, ends array<long>, tokens binary")


def _postings(table: DataFrame, percent: int) -> DataFrame:
    """``token, node, n, pos, parts`` for the n-grams of prefixes that another set has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, classes = _block_tokens(batch.column(2)[i], batch.column(3)[i])
                start, rows = 0, []
                for node, end in zip(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), strict=True):
                    own, often = tokens[start:end], classes[start:end]
                    start, n = end, end - start
                    order = np.lexsort((own, often))[: allowed(n, percent) + 1]  # rare first
                    at = np.flatnonzero(often[order] >= 2)
                    parts = np.minimum(np.bincount((own & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS), 255).astype(np.uint8)
                    rows.append((own[order[at]].view(np.int64), node, n, at, parts.tobytes()))
                each = [len(r[3]) for r in rows]
                columns = [
                    pa.array(np.concatenate([r[0] for r in rows])),
                    pa.array(np.repeat([r[1] for r in rows], each), pa.int64()),
                    pa.array(np.repeat([r[2] for r in rows], each), pa.int32()),
                    pa.array(np.concatenate([r[3] for r in rows]), pa.int32()),
                    pa.array([p for r, k in zip(rows, each, strict=True) for p in [r[4]] * k], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["token", "node", "n", "pos", "parts"])

    counted = with_frequencies(table).select("nodes", "ends", "tokens", "classes")
    return small_batches(counted).mapInArrow(run, "token long, node long, n int, pos int, parts binary").distinct()  # rows may repeat


def surviving(left: tuple, right: tuple, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the pairs of two tiles of postings of one n-gram that pass all filters, and how unlike their parts are. A tile: sizes,
    positions, parts and components."""
    n1, p1, parts1, c1 = left
    n2, p2, parts2, c2 = right
    out = []
    step = max(1, CELLS // max(1, len(n2)))
    for at in range(0, len(n1), step):
        rows = slice(at, at + step)
        a, b = n1[rows, None], n2[None, :]
        need = -(-percent * (a + b) // (100 + percent))  # shared by two sets of these sizes at least
        good = (c1[rows, None] != c2[None, :]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
        good &= np.minimum(a - p1[rows, None], b - p2[None, :]) >= need  # taking this as the first shared one, as in one meeting it is
        if same:
            good &= np.arange(len(n2))[None, :] > np.arange(at, at + good.shape[0])[:, None]
        i, j = np.nonzero(good)
        for k in range(0, len(i), CELLS >> 4):
            x, y = i[k : k + (CELLS >> 4)] + at, j[k : k + (CELLS >> 4)]
            apart = np.abs(parts1[x].astype(np.int16) - parts2[y]).sum(axis=1)
            total = n1[x] + n2[y]
            near = apart <= total - 2 * -(-percent * total // (100 + percent))
            out.append((x[near], y[near], apart[near]))
    return tuple(np.concatenate([o[k] for o in out] or [np.zeros(0, np.int64)]) for k in range(3))


def best_for_each(first: np.ndarray, second: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Of pairs of components, the places of those that are the least unlike for one of the two."""
    ends, place = np.concatenate([first, second]), np.tile(np.arange(len(first)), 2)
    order = np.lexsort((place, apart[place], ends))
    return np.unique(place[order[np.flatnonzero(np.diff(ends[order], prepend=-1))]]) if len(first) else place


def _compared(percent: int, every: bool):
    """Rows ``meet, side, node, n, pos, parts, comp``, sorted by meeting and side, to pairs of nodes: side 1 against side 2,
    any other within itself."""

    def pairs(held: list[tuple]) -> pa.RecordBatch:
        side, node, n, pos, parts, comp = zip(*held, strict=True)
        node, comp = np.array(node, np.int64), np.array(comp, np.int64)
        tile = (np.array(n, np.int64), np.array(pos, np.int64), np.frombuffer(b"".join(parts), np.uint8).reshape(-1, PARTS), comp)
        split = int(np.searchsorted(np.array(side), 2)) if side[0] == 1 else 0
        left = tuple(x[:split] for x in tile) if split else tile
        right = tuple(x[split:] for x in tile) if split else tile
        i, j, apart = surviving(left, right, not split, percent)
        j = j + split
        if not every:
            _, named = np.unique(comp, return_inverse=True)
            best = best_for_each(named[i], named[j], apart)
            i, j = i[best], j[best]
        src, dst = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        return pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for meet, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if meet != now and held:
                    if len(held) > 1:
                        yield pairs(held)
                    held = []
                now = meet
                held.append(row)
        if len(held) > 1:
            yield pairs(held)

    return run


def _candidates(postings: DataFrame, labels: DataFrame, percent: int, every: bool) -> DataFrame:
    """``src, dst``: pairs of different components that pass all filters. With ``every``, all of them; else one, the most alike,
    for each component in each tile.

    Postings of an n-gram are cut into tiles along their sizes. Those of its largest component make tiles of their own, which
    only meet the tiles of others; n-grams that one component has alone are passed over.
    """
    named = postings.join(labels.select(F.struct("node").alias("of"), "component"), F.struct("node") == F.col("of"), "left").drop("of")
    named = named.withColumn("comp", F.coalesce("component", "node")).drop("component")
    named = written(named, "named-postings")
    counts = named.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    tokens = counts.groupBy("token").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("k").alias("m"))
    tokens = written(tokens.where("comps > 1").select(F.struct("token").alias("of"), "main", "m"), "met-tokens")
    live = named.join(tokens, F.struct("token") == F.col("of")).drop("of")
    columns = ("meet", "side", "node", "n", "pos", "parts", "comp")
    small = live.where(F.col("m") <= TILE).withColumns({"meet": F.col("token"), "side": F.lit(0)}).select(*columns)
    big = live.where(F.col("m") > TILE).withColumn("rest", (F.col("comp") != F.col("main")) | F.lit(not every))
    cells = big.groupBy("token", "rest", "n").agg(F.count(F.lit(1)).alias("k"))
    along = Window.partitionBy("token", "rest").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(cells.withColumn("before", F.coalesce(F.sum("k").over(along), F.lit(0))), "posting-cells")
    of = cells.select(F.struct("token", "rest", "n").alias("of"), "k", "before")
    placed = big.join(of, F.struct("token", "rest", "n") == F.col("of")).drop("of")
    placed = placed.withColumn("tile", F.floor((F.col("before") + F.pmod(F.xxhash64("node"), F.col("k"))) / TILE).cast("long"))
    first, last = F.floor(F.col("before") / TILE).cast("long"), F.floor((F.col("before") + F.col("k") - 1) / TILE).cast("long")
    span = cells.select("token", "rest", "n", F.explode(F.sequence(first, last)).alias("tile"))
    span = written(span.groupBy("token", "rest", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high")), "posting-tiles")
    meets = span.where("rest").select("token", "rest", "tile", F.lit(3).alias("side"), F.xxhash64("token", "rest", "tile").alias("meet"))
    if every:
        other = span.select("token", *(F.col(c).alias(f"{c}2") for c in ("rest", "tile", "low", "high")))
        close = (percent * F.col("low2") <= 100 * F.col("high")) & (percent * F.col("low") <= 100 * F.col("high2"))
        cross = span.where("rest").join(other, "token").where((~F.col("rest2") | (F.col("tile") < F.col("tile2"))) & close)
        meet = F.xxhash64("token", "rest", "tile", "rest2", "tile2").alias("meet")
        ends = F.array(
            F.struct("rest", "tile", F.lit(1).alias("side")),
            F.struct(F.col("rest2").alias("rest"), F.col("tile2").alias("tile"), F.lit(2).alias("side")),
        )
        meets = meets.unionByName(cross.select("token", meet, F.explode(ends).alias("at")).select("token", "at.*", "meet"))
    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.join(meets, ["token", "rest", "tile"]).select(*columns).unionByName(small)
    dealt = small_batches(dealt.repartition(parts, "meet").sortWithinPartitions("meet", "side"))
    return dealt.mapInArrow(_compared(percent, every), "src long, dst long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nodes, ends, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                tokens = np.frombuffer(raw.as_buffer() or b"", np.uint64).view(np.int64)
                offsets = pa.array(np.array([0, *ends]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(tokens))], ["node", "tokens"])

    rows = small_batches(sets.select("nodes", "ends", "tokens")).mapInArrow(run, "node long, tokens array<long>")
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("h"))
    rows = maybe_among(rows, F.col("node"), ends).dropDuplicates(["node"])
    side = lambda end, name: rows.select(F.struct(F.col("node").alias(end)).alias(f"{name}_key"), F.col("tokens").alias(name))
    both = pairs.join(side("src", "a"), F.struct("src") == F.col("a_key")).join(side("dst", "b"), F.struct("dst") == F.col("b_key"))
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(100 * shared >= percent * (F.size("a") + F.size("b") - shared)).select("src", "dst")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90
) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, n`` (distinct shingles), ``component_id``, the smallest id that is reachable over
    links between texts whose sets of shingles have a Jaccard similarity of ``percent`` per cent or more.

    A text with fewer words than a shingle has one shingle, of all of them. A text without words, or a null one, has none and links with
    nothing, not even its like. Equal sets are one node, whatever the number of their documents, so copies make no pairs. A very long text is
    worked on by itself. Null ids never become a component id unless a component has no other; ids may be of any type that can be
    ordered; repeated rows are repeated in the result, in one component; other columns are not read. An empty table gives an empty
    result. Sets are compared by 64 bits of their shingles' digests.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent: 50 to 100")
    table = written(_document_blocks(docs, id_col, text_col, shingle), "document-blocks")
    found = written(_tested(table, id_type(docs, id_col), percent), "tested")
    discard(table)
    key = F.struct(F.col("doc_id").alias("id"), "text_hash")
    classes = found.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull(), key.alias("key"))).alias("f"), F.max("open").alias("open"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "least", "f.key", "open"), "set-classes")
    sets = written(_set_blocks(docs, classes.where("open").select("key", "node"), id_col, text_col, shingle), "set-blocks")
    postings = written(_postings(sets, percent), "postings")
    spark = docs.sparkSession
    labels = spark.createDataFrame([], "node long, component long")
    tried: list[DataFrame] = []
    links: list[DataFrame] = []
    for i in range(ROUNDS + 1):
        every = i == ROUNDS
        pairs = _candidates(postings, labels, percent, every)
        for old in tried:
            pairs = pairs.join(old, ["src", "dst"], "left_anti")
        tried.append(written(pairs, "candidates"))
        good = written(_verified(tried[-1], sets, percent), "links")
        if good.isEmpty():
            if every:
                break
            continue
        links.append(good)
        union = links[0]
        for more in links[1:]:
            union = union.unionByName(more)
        labels = written(connected_components(union), "labels")
    named = classes.join(labels, "node", "left").select("digest", "least", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(named.join(least, "component").select(F.struct("digest").alias("of"), "component_id"), "named")
    out = found.join(named, F.when(F.col("n") > 0, F.struct("digest")) == F.col("of"), "left")
    return out.select("doc_id", "text_hash", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
