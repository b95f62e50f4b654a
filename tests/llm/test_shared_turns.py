"""Vector codes, conversation tries and the Jaccard join against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedweb.llm import conversation_trie as trie
from deedweb.llm import jaccard_join as jaccard
from deedweb.llm.queries import QUERIES
from deedweb.llm.vector_codes import LONGEST, OrchardLists, vector_codes, whole_numbers

# Vector codes


def brute_codes(rows):
    """Contract: id -> (code, error, label_error, hash of the codebooks)."""
    rows = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))[:16]
    width = len(first[0][1]) // 8
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(r[1], p) for r in first] for p in range(8)]
    nearest = lambda v, p: min((sum((x - y) ** 2 for x, y in zip(part(v, p), e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(6):
        chosen = [[nearest(r[1], p)[1] for r in rows] for p in range(8)]
        for p in range(8):
            for k in range(len(books[p])):
                if mine := [part(r[1], p) for r, c in zip(rows, chosen[p], strict=True) if c == k]:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, [nearest(v, p) for p in range(8)], label) for i, v, label in rows]
    by_label = defaultdict(int)
    for _, best, label in found:
        by_label[label] += sum(d for d, _ in best)
    return sorted(
        (str(i), "".join(f"{k:02x}" for _, k in best), min(sum(d for d, _ in best), LONGEST), min(by_label[label], LONGEST), digest) for i, best, label in found
    )


def coded(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes(df).collect())


VECTORS = "vec_id long, embedding array<double>, label int, Code string, ERROR int"


def odd_vectors():
    rng = random.Random(4)
    rows = [(i, [rng.randrange(-3, 4) / 4 for _ in range(16)], None if i % 3 else i % 2) for i in range(60)]
    rows[5] = (5, None, 1)
    rows[6] = (6, [None, *rows[6][1][1:]], 1)
    rows[7] = (7, [math.nan] * 16, 1)
    rows[10] = (10, [-math.inf] * 16, 0)
    return rows + rows[20:24] + [(None, rows[30][1], 5)]


@pytest.mark.parametrize("extra", [[], [(9, [1e300] * 16, 1), (3, [3e5] * 16, 0)]])
def test_codes_of_odd_vectors(spark, extra):
    """Nulls, infinities, ties, repeated rows, missing ids, and components beyond 64 bits."""
    rows = odd_vectors() + extra
    assert coded(spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)) == brute_codes(rows)


def test_codes_of_a_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert coded(df) == brute_codes([(r.vec_id, r.embedding, r.label) for r in df.collect()])


def test_codes_of_few_vectors(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert vector_codes(frame([])).collect() == []
    assert vector_codes(frame([(1, None, 1)])).collect() == []
    assert coded(frame([(1, [0.5] * 8, 1)])) == brute_codes([(1, [0.5] * 8, 1)])
    uneven = vector_codes(frame([(1, [0.5] * 11, 1), (2, [0.5] * 8, 1), (3, [0.25] * 11, None)])).collect()
    assert sorted(r.vec_id for r in uneven) == [1, 3] and all(r.error == 0 for r in uneven)
    assert [r.code for r in vector_codes(frame([(1, [], 1)])).collect()] == ["00" * 8]


def test_orchard_search_is_exact():
    """With ties and equal entries; and it measures fewer entries than there are."""
    rng = np.random.default_rng(2)
    for spread in (2, 2000):
        entries, parts = rng.integers(-spread, spread, (16, 4)), rng.integers(-spread, spread, (500, 4))
        entries[7] = entries[3]
        apart = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        best, near = OrchardLists(entries).search(parts)
        assert (best == apart.argmin(axis=1)).all() and (near == apart.min(axis=1)).all()
    assert whole_numbers(np.array([[-0.0001, 1e20]])).tolist() == [[-1, int(1e20) * 4096]]


# Conversations


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    taken = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return own, {c: own.get(c - c % 100, [])[: taken[c]] + own[c][taken[c] :] for c in own}


def brute_nodes(sequences):
    nodes, kids, sums = defaultdict(list), defaultdict(list), {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(nodes, key=len, reverse=True):
        saved = (len(nodes[k]) - 1) * len(k[-1][1]) if k else 0
        sums[k] = (sum(sums[x][0] for x in kids[k]) or 1, saved + sum(sums[x][1] for x in kids[k]))
    ends = lambda k: ",".join(map(str, sorted(c for c in nodes[k] if len(sequences[c]) == len(k))))
    return sorted(
        (str((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(kids[k]), *sums[k], hashlib.sha256(ends(k).encode()).hexdigest())) for k, m in nodes.items())
    )


def made_up(spark, n=150, longest=12):
    rng = random.Random(3)
    rows = []
    for c in range(n):
        shared = rng.choice([0, 3, 5])
        for t in range(rng.randrange(1, longest)):
            text = f"p{shared}-{t}é𝄞" if t < shared else rng.choice("abe")
            rows.append((c, t if t else None, "u" if t % 2 else None, None if text == "e" else text, "x"))
    return spark.createDataFrame([*rows, (None, 0, "u", "lost", "x")], "conv_id long, turn long, role string, text string, Digest string")


def nodes_of(df, plain=False):
    turns = trie.ordered_turns(df, "conv_id", "turn", "role", "text")
    conv = F.col("conv")
    found = trie.plain_sequences(turns) if plain else trie.grafted_sequences(turns, conv - conv % 100, F.crc32(conv.cast("string")) % 6)
    return sorted(str(tuple(r)) for r in trie.conversation_trie(*found).collect())


@pytest.mark.parametrize("setting", [None, (512, 20, 40, 2), (3, 20, 40, 2), (2, 1000, 7, 1)])
@pytest.mark.parametrize("plain", [False, True])
def test_trie(spark, monkeypatch, setting, plain):
    """Shards that are split along shared turns, segments, arrays and chunks of any size give the same nodes."""
    if setting:
        for name, value in zip(("SEGMENT", "SHARD_TURNS", "ARRAY_TURNS", "CHUNK_BITS"), setting, strict=True):
            monkeypatch.setattr(trie, name, value)
    df = made_up(spark)
    assert nodes_of(df, plain) == brute_nodes(rebuilt([tuple(r)[:4] for r in df.collect()])[0 if plain else 1])


def test_trie_of_a_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    got = sorted(str(tuple(r)) for r in QUERIES["op12_conversation_trie"](spark, sf).collect())
    assert got == brute_nodes(rebuilt([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])[1])


def test_trie_of_little(spark):
    kind = "conv_id long, turn long, role string, text string"
    frame = lambda rows: spark.createDataFrame(rows, kind)
    assert nodes_of(frame([])) == [] == nodes_of(frame([(None, 1, "a", "b")]))
    for rows in ([(101, 0, "u", "x")], [(101, 0, "u", "x"), (102, 0, None, None)], [(7, 1, "u", "x" * 200_000)] * 3 + [(8, 1, "u", "x" * 200_000)]):
        assert nodes_of(frame(rows)) == brute_nodes(rebuilt(rows)[1])
        assert nodes_of(frame(rows), True) == brute_nodes(rebuilt(rows)[0])


def test_double_array():
    rng = random.Random(8)
    sequences = [[rng.randrange(40) for _ in range(rng.randrange(6))] for _ in range(300)]
    array = trie.DoubleArray(sequences)
    paths = defaultdict(set)
    for s in sequences:
        for d, slot in enumerate(array.path(s), 1):
            paths[tuple(s[:d])].add(slot)
    slots = [x for v in paths.values() for x in v]
    assert all(len(v) == 1 for v in paths.values()) and len(set(slots)) == len(slots) == len(array.order)
    assert len(array.check) < 3 * len(slots)
    with pytest.raises(KeyError):
        list(array.path([1, 2, 99]))


# Jaccard join


def brute_jaccard(rows, percent=90):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            shared = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in keys}


def near_texts():
    """Clusters of near copies around the threshold, with one passage that all texts share, short and empty texts."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(4000)}"
    common = " ".join(f"c{i}" for i in range(25))
    texts = [None, "", " \n", "one", "ONE", "one two", "one two", "one two three", "one\ttwo three", "a b c d e f g h i j k l", "a b c d e f g h i j k l m"]
    for _ in range(6):
        base = [word() for _ in range(rng.randrange(60, 300))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, len(base) // 30)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + " " + common)
        texts += [" ".join(base), " ".join(base).upper()]
    return [(i, t) for i, t in enumerate(texts)]


def joined(df, **options):
    return {r.doc_id: (r.n, r.component_id) for r in jaccard.jaccard_components(df, **options).collect()}


@pytest.mark.parametrize("percent", [70, 90, 100])
@pytest.mark.parametrize("tile", [1024, 5])
def test_jaccard_of_near_texts(spark, monkeypatch, tile, percent):
    """Also with tiles so small that every n-gram is cut into many."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = near_texts()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, N int, Component_ID string")
    assert joined(df, percent=percent) == brute_jaccard(rows, percent)


def test_jaccard_of_a_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert joined(df) == brute_jaccard([(r.doc_id, r.text) for r in df.collect()])


def test_jaccard_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(3, long), (5, long + " more"), (None, "p q r s"), (7, "p q r s"), (None, "lone one here"), (3, long), (9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n, str(r.component_id)) for r in jaccard.jaccard_components(df).collect())
    want = [("3", 119998, "3"), ("3", 119998, "3"), ("5", 119999, "3"), ("7", 2, "7"), ("9", 0, "9"), ("9", 0, "9"), ("None", 1, "None"), ("None", 2, "7")]
    assert got == want
    assert jaccard.jaccard_components(df.limit(0)).collect() == []
    named = df.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    assert {r.component_id for r in jaccard.jaccard_components(named).collect()} == {"3", "7", "9", None}
    with pytest.raises(ValueError):
        jaccard.jaccard_components(df, percent=40)


def test_filters_lose_no_pair():
    """Tiles of postings of one n-gram, against the sets themselves."""
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(300)]
    sets = []
    for _ in range(80):
        size = rng.randrange(30, 300)
        own = set(base[:size])
        for _ in range(rng.randrange(0, size // 8)):
            own.discard(rng.choice(base))
            own.add(rng.getrandbits(64))
        sets.append(sorted(own))
    for token in base[:5]:
        held = [s for s in sets if token in s]
        at = np.array([s.index(token) for s in held])
        n = np.array([len(s) for s in held])
        parts = np.stack([np.minimum(np.bincount(np.array(s, np.uint64).astype(np.int64) & (jaccard.PARTS - 1), minlength=jaccard.PARTS), 255) for s in held]).astype(np.uint8)
        tile = (n, at, parts, np.arange(len(held)))
        i, j, _ = jaccard.surviving(tile, tile, True, 90)
        found = set(zip(i.tolist(), j.tolist(), strict=True))
        for a in range(len(held)):
            for b in range(a + 1, len(held)):
                both = set(held[a]) & set(held[b])
                if 100 * len(both) >= 90 * len(set(held[a]) | set(held[b])) and min(both) == token:
                    assert (a, b) in found
