"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared in tiles with numpy exclusive-or and bit counts. Inside a lane, tiles are cut along the
fingerprints' population counts; a pair of tiles whose counts differ by more than the radius cannot hold a link and is
never made. A tile pair returns a spanning forest of its links, not the links, so a dense group costs one edge for each
fingerprint.

Lanes: cut into b blocks of bits, two fingerprints within a radius of r bits agree in b - r blocks at least, so comparing
where any b - r blocks agree finds every link. Where the radius is too wide for blocks, ``near_copies`` deals lanes by bands
of minima over the shingles: sets of similarity s meet in a band of k minima with probability s^k, so a fixed number of
bands is enough at any number of documents. What meets there is still compared by fingerprints, and what it joins is
decided by the exact Jaccard similarity of the sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deedweb.llm.jaccard_join import jaccard_components
from deedweb.llm.rows import blocks, id_type, row_id, row_key, small_batches, spare, text_hash
from deedweb.operators.components import connected_components
from deedweb.scratch import discard, written

SEED = 42
TILE = 4096
CELLS = 1 << 21
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, repeats included; of all words if there are fewer; nothing without words."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z and ASCII white space only
    runs = zip(*(words[i:] for i in range(size)), strict=False) if len(words) > size else [words] if words else []
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in runs), np.uint64)


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """``lanes`` words of 64 bits: a bit is set if it is in over half the hashes. Words after the first count the bits
    of hashes that are mixed again."""
    total = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(hashes), CELLS >> 7):
        part = hashes[at : at + (CELLS >> 7)]
        wide = np.stack([part, *(_mixed(part + np.uint64(i) * MIX[0]) for i in range(1, lanes))], axis=1)
        total += np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)


#: Bands of minima over the hashes of shingles, and minima of a band. At a similarity of 0.8, all bands of two sets differ with a
#: probability of (1 - 0.8^4)^20, three in a hundred thousand.
BANDS, BAND = 20, 4
_FACTORS = _mixed(np.arange(1, BANDS * BAND + 1, dtype=np.uint64) * MIX[0]) | np.uint64(1)


def minima_bands(hashes: np.ndarray) -> np.ndarray:
    """``BANDS`` hashes, each of ``BAND`` minima of the set under factors of its own. Those of no shingles are equal."""
    least = np.full(BANDS * BAND, ~np.uint64(0))
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at : at + 512, None] * _FACTORS).min(axis=0), out=least)
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND).T:
        out = _mixed(out * MIX[0] + column)
    return out


def simhash(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    lanes: int = 1,
    distinct: bool = False,
    bands: bool = False,
) -> DataFrame:
    """``doc_id, text_hash, fp`` (``lanes`` longs), ``size`` (number of distinct shingles), ``set_hash`` (of the set of shingles),
    ``bands`` (see ``minima_bands``; empty unless asked for) for each row. A null text counts as empty; a text without words
    has fingerprint zero. With ``distinct``, a repeated shingle counts once in the fingerprint."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 2):
            found = [shingle_hashes(x.as_py(), shingle) for x in batch.column(2)]
            sets = [np.unique(h) for h in found]
            lists = [minima_bands(h) if bands else np.zeros(0, np.uint64) for h in sets]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            bits = np.array([fingerprint(h, lanes) for h in (sets if distinct else found)], np.uint64).reshape(-1).view(np.int64)
            starts = np.arange(0, len(bits) + 1, lanes, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.ListArray.from_arrays(pa.array(starts), pa.array(bits)),
                    pa.array([len(h) for h in sets], pa.int32()),
                    pa.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in sets], pa.uint64()).view(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).view(np.int64))),
                ],
                ["doc_id", "text_hash", "fp", "size", "set_hash", "bands"],
            )

    plain = docs.select(row_id(docs, id_col).alias("doc_id"), text_hash(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
    kind = id_type(docs, id_col)
    return small_batches(plain).mapInArrow(prints, f"doc_id {kind}, text_hash long, fp array<long>, size int, set_hash long, bands array<long>")


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _unite(parent: np.ndarray, i: int, hits: np.ndarray, edges: list[tuple[int, int]]) -> None:
    """Join i with all hits; an edge is added for each union."""
    while len(hits):  # one union, then all hits that it joined go
        a, b = _find(parent, i), _find(parent, int(hits[0]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            edges.append((i, int(hits[0])))
        roots = parent[hits]
        while not np.array_equal(roots, higher := parent[roots]):
            roots = higher
        parent[hits] = roots
        hits = hits[roots != min(a, b)]


def tile_forest(left: np.ndarray, right: np.ndarray, sizes: tuple | None, radius: int, ratio: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between the rows of two tiles (n x lanes words; right may be left itself), as
    pairs of positions in left followed by right."""
    same = right is left
    shift = 0 if same else len(left)
    parent = np.arange(len(left) + (0 if same else len(right)))
    edges = []
    step = max(1, CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        apart = np.zeros((len(rows), len(right)), np.uint16)
        for lane in range(left.shape[1]):
            apart += np.bitwise_count(rows[:, lane, None] ^ right[None, :, lane])
        near = apart <= radius
        if ratio:
            a, b = sizes[0][at : at + step, None], sizes[1][None, :]
            near &= np.minimum(a, b) >= ratio * np.maximum(a, b)
        if same:
            near &= np.arange(len(right))[None, :] > np.arange(at, at + len(rows))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            _unite(parent, int(at + i), np.flatnonzero(near[i]) + shift, edges)
    return edges


def _compared(radius: int, ratio: float, tile: int):
    """Groups of rows, sorted by meeting, side and arrival, to forests. Small whole lanes (side 0) share a tile."""

    def forest(rows: list, split: int) -> Iterator[tuple]:
        fps = np.array([r[0] for r in rows], np.int64).view(np.uint64).reshape(len(rows), -1)
        sizes = np.array([r[1] for r in rows])
        left = fps[:split] if split else fps
        right = fps[split:] if split else left
        pair = (sizes[:split], sizes[split:]) if split else (sizes, sizes)
        for a, b in tile_forest(left, right, pair, radius, ratio):
            yield rows[a][2], rows[b][2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list, split: int) -> pa.RecordBatch:
            pairs = list(forest(rows, split))
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["src", "dst"]
            )

        held: list = []
        key, split, whole = None, 0, True
        for batch in batches:
            for meet, side, fp, size, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if meet != key:
                    if held and (not whole or side or len(held) >= tile // 4):
                        yield out(held, split)
                        held = []
                    key, split, whole = meet, 0, side == 0
                if side == 2 and not split:
                    split = len(held)
                held.append((fp, size, node))
        if held:
            yield out(held, split)

    return run


def block_lanes(radius: int, n: int, tile: int = TILE) -> list[int]:
    """Masks of 64 bits: two words within the radius are equal under one of them at least. There are as few blocks as make
    lanes of ``tile`` of ``n`` even words or fewer, so lanes stay small at any number of words: four masks of 16 bits for a
    radius of 3, ten of 25 bits from 2^28 words on, and so on."""
    blocks = radius + 1
    while n >> 64 * (blocks - radius) // blocks > tile and blocks < 2 * radius + 2:
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in pairwise(cuts)]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(
    prints: DataFrame, radius: int, ratio: float = 0.0, tile: int = TILE, lanes: DataFrame | None = None, star: bool = False
) -> DataFrame:
    """``(src, dst)``: a spanning forest, in each meeting of tiles, of the links between the rows ``(node long, fp, size)``.

    Rows link at ``radius`` differing bits or fewer and, with ``ratio``, only if the smaller size is that part of the
    larger. Every link joins two nodes of one tree; the trees of different meetings overlap. ``lanes`` (``node, lane``) says
    which rows are compared; without it, fingerprints of one word are compared in all lanes of blocks, so no link is lost.
    With ``star``, each tile of a crowded lane meets itself and one tile in the lane's middle only. Rows whose lane says ``known``
    (a boolean, if the column is there) meet all but one another.
    """
    by = ["lane", "known"] if lanes is not None and "known" in lanes.columns else ["lane"]
    known = len(by) > 1
    count = F.aggregate("fp", F.lit(0), lambda n, x: n + F.bit_count(x))
    rows = prints.select("node", "fp", "size", count.alias("ones"))
    if lanes is None:
        masks = block_lanes(radius, prints.count(), tile)
        keys = (F.struct(F.lit(i).alias("block"), F.col("fp")[0].bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(masks))
        rows = rows.withColumn("lane", F.explode(F.array(*keys)))
    else:
        rows = rows.join(lanes.select(F.struct("node").alias("of"), *by), F.struct("node") == F.col("of")).drop("of")
        rows = written(rows.withColumn("lane", F.struct(F.lit(0).alias("block"), F.col("lane").alias("bits"))), "dealt")
    # Cells: the rows of a lane with one population count. There are few per lane, whatever the input.
    rows = rows.withColumn("cell", F.col("ones"))
    cells = rows.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(
        cells.withColumns(
            {"before": F.coalesce(F.sum("n").over(along), F.lit(0)), "lane_n": F.sum("n").over(Window.partitionBy("lane"))}
        ),
        "cells",
    )
    spread = F.pmod(F.xxhash64("node"), F.col("n"))
    # Tiles of known rows have odd numbers.
    number = (lambda t: 2 * t + F.col("known").cast("int")) if known else (lambda t: t)
    placed = number(F.floor((F.col("before") + spread) / F.lit(tile)).cast("int"))
    crowded = cells.where(F.col("lane_n") > tile)
    # A lane that fits a tile is compared whole; only the lanes above are looked up and cut.
    big = rows.join(crowded, [*by, "cell"]).withColumn("tile", placed)
    small = rows.join(crowded.select("lane").distinct(), "lane", "left_anti")
    reach = F.sequence(F.floor(F.col("before") / tile).cast("int"), F.floor((F.col("before") + F.col("n") - 1) / tile).cast("int"))
    span = crowded.select(*by, "cell", F.explode(reach).alias("tile")).withColumn("tile", number(F.col("tile"))).groupBy("lane", "tile").agg(F.min("cell").alias("low"), F.max("cell").alias("high"))
    span = written(span, "tiles")
    other = span.select("lane", F.col("tile").alias("tile2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    close = (F.col("low2") - F.col("high") <= radius) & (F.col("low") - F.col("high2") <= radius)
    alone = span.where("tile % 2 = 0") if known else span
    if star:  # an equal join: pairs of tiles grow with the tiles
        middle = span.groupBy("lane").agg(F.floor(F.max("tile") / 2).cast("int").alias("tile2"))
        meets = span.join(middle.join(other, ["lane", "tile2"]), "lane").where((F.col("tile") != F.col("tile2")) & close)
    else:
        once = F.col("tile") < F.col("tile2")
        meets = alone.join(other, "lane").where(((F.col("tile2") % 2 == 1) | once if known else once) & close)
    sides = F.explode(F.array(F.struct(F.col("tile").alias("tile"), F.lit(1).alias("side")), F.struct(F.col("tile2").alias("tile"), F.lit(2).alias("side"))))
    meets = meets.select("lane", F.xxhash64("lane", "tile", "tile2").alias("meet"), sides.alias("at")).select("lane", "at.*", "meet")
    own = alone.select("lane", "tile", F.lit(3).alias("side"), F.xxhash64("lane", "tile").alias("meet"))
    dealt = big.join(meets.unionByName(own), ["lane", "tile"]).select("meet", "side", "fp", "size", "node")
    whole = small.select(F.xxhash64("lane").alias("meet"), F.lit(0).alias("side"), "fp", "size", "node")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.unionByName(whole)
        .repartition(parts, "meet")
        .sortWithinPartitions("meet", "side")
        .mapInArrow(_compared(radius, ratio, tile), "src long, dst long")
    )


def lane_links(prints: DataFrame, radius: int, ratio: float, tile: int, lanes: DataFrame) -> DataFrame:
    """Links with the components of ``fingerprint_links`` over ``lanes``, in two passes, so that a crowded lane of near copies does
    not meet in all its pairs of tiles.

    The first pass compares each tile of a crowded lane with itself and with the lane's middle tile. What that joins into the
    lane's largest component is known to be connected, so in the second pass only the other rows meet, each other and all the rest: n
    rows of which all but a few are near copies cost about n, and a lane that is one component after the first pass has no second.
    """
    first = written(fingerprint_links(prints, radius, ratio, tile, lanes, star=True).distinct(), "candidates")
    crowded = written(lanes.groupBy("lane").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile).select("lane"), "crowded")
    if crowded.isEmpty():
        return first
    inside = lanes.join(crowded, "lane").join(connected_components(first), "node", "left")
    inside = written(inside.select("lane", "node", F.coalesce("component", "node").alias("component")), "inside")
    largest = inside.groupBy("lane", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("lane")
    largest = largest.agg(F.count(F.lit(1)).alias("several"), F.max(F.struct("n", "component"))["component"].alias("largest"))
    open_rows = inside.join(largest.where("several > 1"), "lane").select("node", "lane", (F.col("component") == F.col("largest")).alias("known"))
    more = fingerprint_links(prints, radius, ratio, tile, written(open_rows, "open"))
    found = written(first.unionByName(more).distinct(), "candidates")
    discard(first)
    discard(inside)
    return found


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, tile: int = TILE
) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, fp`` (array of one 64-bit word), ``component_id``, the smallest id that is
    reachable over links between fingerprints at ``radius`` bits or fewer. For near copies by similarity, see
    ``near_copies``.

    Equal fingerprints are compared once, whatever the number of their documents. A null text counts as empty; texts without
    words have fingerprint zero and link like any other; a very long text is worked on by itself. Null ids never become a
    component id unless a component has no other; ids may be of any type that can be ordered; repeated rows are repeated in
    the result, in the same component. An empty table gives an empty result; other columns are not read.
    """
    prints = written(simhash(docs, id_col, text_col, shingle).drop("set_hash", "bands"), "prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = written(classes.select("fp", F.lit(0).alias("size"), "least", F.col("fp")[0].alias("node")), "classes")
    links = fingerprint_links(classes, radius, tile=tile)
    found = written(connected_components(links), "components")
    named = classes.join(found, "node", "left").select("fp", "least", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(named.join(least, "component").select(F.struct("fp").alias("of"), "component_id"), "named")
    return prints.join(named, F.struct("fp") == F.col("of")).select("doc_id", "text_hash", "fp", "component_id")


def hex_fingerprint(fp: F.Column) -> F.Column:
    """The words of a fingerprint as lowercase hexadecimal digits."""
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _shingle_sets(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``node, component, shingles`` (distinct hashes) for the rows ``chosen`` (``key, node, component``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 2):
            found = [np.unique(shingle_hashes(x.as_py(), shingle)).view(np.int64) for x in batch.column(2)]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *found]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.ListArray.from_arrays(pa.array(ends), flat)], ["node", "component", "shingles"]
            )

    texts = docs.select(row_key(docs, id_col, text_col).alias("key"), docs[text_col].alias("text"))
    texts = texts.join(chosen, "key").select("node", "component", "text")
    found = small_batches(texts).mapInArrow(run, "node long, component long, shingles array<long>")
    return found.dropDuplicates(["node"])  # rows may repeat


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``src, dst`` whose sets have that Jaccard similarity at least."""
    side = lambda end, name: sets.select(F.struct(F.col("node").alias(end)).alias(f"{name}_key"), F.col("shingles").alias(name))
    both = pairs.join(side("src", "a"), F.struct("src") == F.col("a_key")).join(side("dst", "b"), F.struct("dst") == F.col("b_key"))
    shared, total = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    return both.where((total == 0) | (shared >= similarity * (total - shared) - 1e-9)).select("src", "dst")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set of left, the number of hashes that it shares with each set of right, from an inverted index of right."""
    tokens = np.concatenate([np.zeros(0, np.int64), *right])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], np.repeat(np.arange(len(right)), [len(x) for x in right])[order]
    for own in left:
        low = np.searchsorted(tokens, own, "left")
        n = np.searchsorted(tokens, own, "right") - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield np.bincount(owner[at], minlength=len(right))


def set_forest(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sets have that Jaccard similarity at least, between two tiles of sets of hashes
    (right may be left itself), as pairs of positions in left followed by right. Sets without hashes are alike."""
    same = right is left
    shift = 0 if same else len(left)
    sizes = np.array([len(x) for x in right])
    parent = np.arange(len(left) + (0 if same else len(right)))
    edges = []
    for i, shared in enumerate(_overlaps(left, right)):
        total = len(left[i]) + sizes
        near = (total == 0) | (shared >= similarity * (total - shared) - 1e-9)
        _unite(parent, i, np.flatnonzero(near) + shift, edges)
    return edges


def _compared_sets(similarity: float):
    """Rows ``meet, side, node, shingles``, sorted by meeting and side, to forests: sides 1 and 2 against each other, one side
    within itself."""

    def forest(nodes: list[int], sets: list[np.ndarray], split: int) -> pa.RecordBatch:
        left = sets[:split] if split else sets
        found = set_forest(left, sets[split:] if split else left, similarity)
        return pa.RecordBatch.from_arrays([pa.array([nodes[p[i]] for p in found], pa.int64()) for i in (0, 1)], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, split, nodes, sets = None, 0, [], []
        for batch in batches:
            for meet, side, node, shingles in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
                if meet != key:
                    if nodes:
                        yield forest(nodes, sets, split)
                    key, split, nodes, sets = meet, 0, [], []
                if side == 2 and not split:
                    split = len(nodes)
                nodes.append(node)
                sets.append(shingles.values.to_numpy())
        if nodes:
            yield forest(nodes, sets, split)

    return run


#: Hashes of a tile of sets, and the growth of set sizes from one cell to the next.
SET_TILE, SET_CELL = 1 << 15, 1.05


def set_links(sets: DataFrame, similarity: float, tile: int = SET_TILE) -> DataFrame:
    """``(src, dst)``: a spanning forest, in each meeting of tiles, of the pairs of a component whose sets have that Jaccard
    similarity at least, from the rows ``node, component, shingles``.

    The sets of a component are cut into tiles of about ``tile`` hashes along their sizes, whatever their number; tile pairs
    whose sizes cannot have the similarity are never made, and no pairs of sets leave a task but links. Sets that are ``known``
    (a boolean, if the column is there) meet all but one another: they are connected already.
    """
    size = F.size("shingles")
    known = F.col("known") if "known" in sets.columns else F.lit(False)
    rows = sets.select("node", "component", known.alias("known"), (size + 1).cast("long").alias("weight"), F.floor(F.log(size + F.lit(1.0)) / np.log(SET_CELL)).alias("cell"))
    by = ("component", "known", "cell")
    cells = rows.groupBy(*by).agg(F.sum("weight").alias("n"))
    along = Window.partitionBy("component", "known").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    place = 2 * F.floor((F.col("before") + F.pmod(F.xxhash64("node"), F.col("n"))) / tile) + F.col("known").cast("int")  # known: odd
    placed = rows.join(cells.select(F.struct(*by).alias("of"), "n", "before"), F.struct(*by) == F.col("of"))
    placed = written(placed.select("node", "component", "cell", place.alias("tile")), "placed")
    span = placed.groupBy("component", "tile").agg(F.min("cell").alias("low"), F.max("cell").alias("high"))
    span = written(span, "tiles")
    other = span.select("component", F.col("tile").alias("tile2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    apart = int(np.ceil(np.log(1 / similarity) / np.log(SET_CELL))) + 2  # of cells; sizes count one more, hence one of slack
    close = (F.col("low2") - F.col("high") <= apart) & (F.col("low") - F.col("high2") <= apart)
    alone = span.where("tile % 2 = 0")
    meets = alone.join(other, "component").where(((F.col("tile2") % 2 == 1) | (F.col("tile") < F.col("tile2"))) & close)
    sides = F.explode(F.array(F.struct(F.col("tile").alias("tile"), F.lit(1).alias("side")), F.struct(F.col("tile2").alias("tile"), F.lit(2).alias("side"))))
    meets = meets.select("component", F.xxhash64("component", "tile", "tile2").alias("meet"), sides.alias("at")).select("component", "at.*", "meet")
    own = alone.select("component", "tile", F.lit(3).alias("side"), F.xxhash64("component", "tile").alias("meet"))
    dealt = placed.join(meets.unionByName(own), ["component", "tile"]).select(F.struct("node").alias("of"), "meet", "side")
    dealt = sets.select("node", "shingles").join(dealt, F.struct("node") == F.col("of")).select("meet", "side", "node", "shingles")
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small_batches(dealt.repartition(parts, "meet").sortWithinPartitions("meet", "side"))
    return dealt.mapInArrow(_compared_sets(similarity), "src long, dst long")


def meeting_lanes(lanes: DataFrame) -> DataFrame:
    """The rows ``node, lane`` of lanes that several nodes share; of lanes with the same nodes, one stays."""
    shared = lanes.groupBy("lane").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("mark"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    shared = shared.where("low <> high").groupBy("n", "mark", "low", "high").agg(F.min("lane").alias("lane"))
    return lanes.join(shared.select(F.struct("lane").alias("of")), F.struct("lane") == F.col("of")).select("node", "lane")


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    radius: int = 72,
    lanes: int = 4,
    similarity: float = 0.8,
    tile: int = TILE,
    exact: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, component_id``, the smallest id that is reachable over links between
    texts whose sets of shingles have a Jaccard similarity of ``similarity`` or more.

    Texts meet in lanes, by bands of minima over their shingles, and fingerprints within ``radius`` make candidate components.
    This is approximate: two sets of similarity 0.8 miss all lanes with a probability of 0.00003, and in 256 bits they differ in
    38.8 bits with a standard deviation of 5.7 (sets of four and five shingles in 48 and 6.3), of which a radius of 72 takes all
    but 5 standard deviations (3.8). The forest of candidates is verified first; where that leaves a component in several clusters,
    its whole sets are compared in tiles, but for those of its largest cluster among themselves. Every link is verified on the whole sets.

    ``exact``: candidates come from the prefix filters of ``jaccard_join`` instead, which lose no link; ``similarity`` is taken in
    whole per cent of 50 or more then.

    Equal sets are one node, whatever the number of their documents. Texts without words are alike; a very long text is worked
    on by itself. Null ids never become a component id unless a component has no other; ids may be of any type that can be
    ordered; repeated rows are repeated in the result.
    """
    if exact:
        found = written(jaccard_components(docs, id_col, text_col, shingle, round(100 * similarity)), "joined")
        wordless = found.where("n = 0").agg(F.min("doc_id").alias("wordless"))  # texts without words are alike
        found = found.crossJoin(F.broadcast(wordless))
        return found.select("doc_id", "text_hash", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("wordless")).alias("component_id"))
    prints = written(simhash(docs, id_col, text_col, shingle, lanes, distinct=True, bands=True), "prints")
    key = F.struct(F.col("doc_id").alias("id"), "text_hash")
    nodes = prints.groupBy("set_hash", "fp").agg(F.min("doc_id").alias("least"), F.min(F.struct(key.alias("key"), "size", "bands")).alias("first"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "set_hash", "fp", "least", "first.*"), "nodes")
    met = written(meeting_lanes(nodes.select("node", F.explode("bands").alias("lane"))), "lanes")
    forest = lane_links(nodes.select("node", "fp", "size"), radius, similarity, tile, met)
    discard(met)
    groups = connected_components(forest)
    chosen = nodes.join(groups, "node").select("key", "node", "component")
    sets = written(_shingle_sets(docs, chosen, id_col, text_col, shingle), "shingle-sets")
    links = written(_alike(forest, sets, similarity), "links")
    clusters = written(connected_components(links).select("node", F.col("component").alias("cluster")), "clusters")
    named = sets.select("node", "component").join(clusters, "node", "left")
    named = written(named.select("node", "component", F.coalesce("cluster", "node").alias("cluster")), "clustered")
    several = named.groupBy("component", "cluster").agg(F.count(F.lit(1)).alias("n")).groupBy("component")
    several = several.agg(F.count(F.lit(1)).alias("clusters"), F.max(F.struct("n", "cluster"))["cluster"].alias("largest")).where("clusters > 1")
    known = named.join(several.select("component", "largest"), "component")
    known = written(known.select(F.struct("node").alias("of"), (F.col("cluster") == F.col("largest")).alias("known")), "known")
    searched = sets.join(known, F.struct("node") == F.col("of")).select("node", "component", "known", "shingles")
    searched = written(searched, "searched")
    discard(sets)
    more = written(set_links(searched, similarity), "more")
    discard(searched)
    ends = named.select(F.col("node").alias("a"), "cluster")
    joins = more.join(ends, F.col("src") == F.col("a")).select(F.col("cluster").alias("src"), "dst")
    joins = joins.join(ends, F.col("dst") == F.col("a")).select("src", F.col("cluster").alias("dst"))
    merged = written(connected_components(joins), "components").withColumnRenamed("node", "cluster")
    same = ("set_hash", "fp")
    whole = nodes.join(clusters, "node", "left").select("node", *same, "least", F.coalesce("cluster", "node").alias("cluster"))
    whole = whole.join(merged, "cluster", "left").select(*same, "least", F.coalesce("component", "cluster").alias("component"))
    whole = written(whole, "whole")
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    whole = written(whole.join(least, "component").select(F.struct(*same).alias("of"), "component_id"), "named")
    return prints.join(whole, F.struct(*same) == F.col("of")).select("doc_id", "text_hash", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component in ``near_copies``, so one document of each group
    stays. Rows that repeat both id and text stay as one. A row without an id goes if its component has an id; a component
    without any id keeps one row for each of its texts."""
    found = near_copies(docs, id_col, text_col, **options)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    key, n = spare(docs, "key"), spare(docs, "n")
    stay = written(stay.groupBy(F.struct(F.col("doc_id").alias("id"), "text_hash").alias(key)).agg(F.count(F.lit(1)).alias(n)), "stay")
    kept = docs.select("*", row_key(docs, id_col, text_col).alias(key)).join(stay, key)
    repeated = kept.where(F.col(n) > 1).dropDuplicates([key])  # of few rows: texts are shuffled once
    return kept.where(F.col(n) == 1).unionByName(repeated).select(*docs.columns)
