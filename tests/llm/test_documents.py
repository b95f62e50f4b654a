"""The document operators against brute force: on the smallest table, and on the cases that tables seldom hold."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deedweb.llm import bpe, fingerprints, packing, queries, simhash, words
from deedweb.llm.exact_dedup import exact_dedup
from deedweb.llm.line_dedup import line_dedup
from deedweb.llm.substring import substring_dedup
from deedweb.operators.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, slot int"
PATH = public_tokenizers.path("byte_bpe_50k.json")
A = " ".join(f"a{i}" for i in range(80))
B = " ".join(f"b{i}" for i in range(70))
CASES = [
    (1, A, "en", "s1"),
    (2, f"x {A[: A.index('a60')]}y z", "en", "s2"),
    (3, A, "en", "s3"),
    (3, A, "en", "s3"),
    (4, None, None, None),
    (5, "", "en", "s1"),
    (6, " \t\n\x0b\x0c\r ", "en", "s2"),
    (7, f"{B}\n{A}", "de", "s4"),
    (None, f"{B} tail", "de", "s5"),
    (None, A, "de", None),
    (8, f"{B} {B}", "de", "s5"),
    (9, "ÀÉ one TWO  three four <|endoftext|> it's\x1c 12345 日本語 🙂", "en", "s1"),
    (10, "word " * 30_000, "en", "s1"),
    (11, "One Two", "en", "s6"),
    (12, "one two", "en", "s6"),
    (13, "shared line\nmine 13\n\n shared line\t", "en", "s1"),
    (14, "shared line\r\nmine 14", "en", "s2"),
    (15, "shared line", "en", "s3"),
    (16, "mine 16\nshared line", "en", "s4"),
    (17, "shared line\nshared line\nmine 17", "en", "s5"),
    (18, A, "en", "s3"),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(*r, len(r[1] or ""), "clash", 1) for r in CASES]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def rows_of(df, text="text"):
    return [(r["doc_id"], r[text]) for r in df.collect()]


def counted(rows):
    return Counter(tuple(r) for r in rows)


EMPTY = [
    exact_dedup,
    simhash.simhash_components,
    simhash.keep_one,
    line_dedup,
    fingerprints.fingerprints,
    fingerprints.edit_probe,
    substring_dedup,
    lambda d: packing.pack(d, PATH),
    lambda d: bpe.decode(bpe.encode(d, PATH), PATH),
    lambda d: bpe.round_trip(d, PATH),
]


@pytest.mark.parametrize("operator", EMPTY)
def test_empty_table(cases, operator):
    assert operator(cases.where("false")).collect() == []


def thue_morse(n):
    """Two words of n letters that polynomial hashes modulo 2^64 do not tell apart, from 1024 letters on."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_of_equal_polynomials(spark, library, n):
    one, two = thue_morse(n)
    rest = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{rest} {one}"), (4, f"{rest} {two}"), (5, f"x {one} {rest}"), (6, " ".join([one, two] * 40)), (7, " ".join([two, one] * 40))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert counted(got) == counted(brute_substrings(rows, 50))
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 50, 6: 0, 7: 80}
    ids = {d: np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for d, t in rows}
    found = bpe.round_trip(df, PATH).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in found} == ids and {r["doc_id"]: r["text"] for r in found} == dict(rows)
    pieces = packing.pack(df, PATH, limit=1 << 20).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in pieces} == {d: zlib.crc32(x + bytes(4)) for d, x in ids.items()}


def test_ids_of_other_types(spark, cases):
    """String ids are compared as strings; a column may clash with a new one in another case."""
    rows = [(f"d{i}", f"{A}\nline {i}", f"s{i}", "clash") for i in range(6)] + [(None, f"{A} tail", "s1", None)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string, N_Removed string")
    lines = line_dedup(df)
    assert {r["doc_id"]: r["n_removed"] for r in lines.collect()} == {"d0": 0, **{f"d{i}": 1 for i in range(1, 6)}, None: 0}
    subs = substring_dedup(df)
    assert {r["doc_id"]: r["n_removed"] for r in subs.collect()} == {"d0": 0, **{f"d{i}": 81 for i in range(1, 6)}, None: 80}
    for found in (lines, subs):
        assert [c.lower() for c in found.columns].count("n_removed") == 1 and found.schema["n_removed"].dataType.typeName() == "long"
    assert [r["doc_id"] for r in simhash.keep_one(df).collect()] == ["d0"]
    assert {r["keep_id"] for r in exact_dedup(df).collect()} == {None, *(f"d{i}" for i in range(6))}
    assert {r["doc_id"] for r in packing.pack(df, PATH).collect()} == {r[0] for r in rows}
    probed = fingerprints.edit_probe(df).collect()
    order = [*sorted((r for r in rows if r[0]), reverse=True), rows[-1]]
    assert {r["doc_id"]: r["edited_text"] for r in probed} == {
        a[0]: fingerprints.edited(a[1], b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True)
    }


# Exact duplicates


def plain(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def brute_exact(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[plain(text)].append((-len(text or ""), doc is None, doc or 0, i, doc))
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda m: m[:3])
        digest = hashlib.sha256(text.encode()).digest()
        out += [(m[4], best[4], len(members), m[:3] == best[:3], digest) for m in members]
    return out


@pytest.mark.parametrize("share", [None, 0.05])
@pytest.mark.parametrize("which", ["docs", "cases"])
def test_exact_dedup(request, which, share):
    df = request.getfixturevalue(which)
    got = exact_dedup(df, share=share).collect()
    want = brute_exact(rows_of(df))
    assert counted((r["doc_id"], r["keep_id"], r["group_size"], bytes(r["digest"])) for r in got) == counted((w[0], w[1], w[2], w[4]) for w in want)
    assert sum(r["kept"] for r in got) == len({bytes(r["digest"]) for r in got})  # one of wholly equal rows
    assert counted((r["doc_id"], bytes(r["digest"])) for r in got if r["kept"]) == Counter({(w[0], w[4]): 1 for w in want if w[3]})


# SimHash


def brute_prints(text, size):
    words = (text or "").encode().lower().split()
    runs = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("tile", [8, 4096])
@pytest.mark.parametrize("which", ["docs", "cases"])
def test_simhash(request, which, tile):
    df = request.getfixturevalue(which)
    rows = rows_of(df)
    prints = [brute_prints(t, 3) for _, t in rows]
    roots = brute_components(prints, 3)
    least = {r: min((d for (d, _), x in zip(rows, roots, strict=True) if x == r and d is not None), default=None) for r in roots}
    want = counted((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, roots, strict=True))
    got = simhash.simhash_components(df, shingle=3, radius=3, tile=tile)
    got = got.select("doc_id", simhash.hex_fingerprint(got["fp"]).alias("f"), "component_id")
    assert counted(got.collect()) == want


def test_links_of_dense_groups(spark):
    """Near fingerprints by the hundred, over several lanes and tiles: the components are those of all pairs."""
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    prints = {int(c ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))) if True else 0 for c in centres for _ in range(60)}
    prints = sorted(prints)
    roots = brute_components(prints, 3)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(s, [s], 1) for s in signed], "node long, fp array<long>, size int")
    for tile in (16, 4096):
        links = simhash.fingerprint_links(df, 3, tile=tile)
        assert links.count() < 64 * len(prints)
        found = {r["node"]: r["component"] for r in connected_components(links).collect()}
        groups = defaultdict(set)
        for s, r in zip(signed, roots, strict=True):
            groups[r].add(s)
        got = defaultdict(set)
        for s in signed:
            got[found.get(s, s)].add(s)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("n", [100, 1 << 30, 1 << 36, 1 << 44])
def test_lanes_of_blocks(n):
    """Two words within the radius are equal under a mask, and lanes of even words are small."""
    rng = np.random.default_rng(10)
    for radius in (0, 3, 6):
        masks = [m % (1 << 64) for m in simhash.block_lanes(radius, n)]
        assert len(set(masks)) == len(masks) and (n >> min(m.bit_count() for m in masks) <= 2 * simhash.TILE or radius != 3)
        for _ in range(500):
            flips = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
            assert any(not flips & m for m in masks)


def test_bands_of_minima():
    """Sets of similarity 0.8 meet in a band; sets that share little do not."""
    rng = np.random.default_rng(11)
    met = far = 0
    for n in (9, 18, 45, 180, 900):
        for _ in range(200):
            both, one, two = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (8 * n // 9 or 1, n - 8 * n // 9, n - 8 * n // 9))
            a, b = (simhash.minima_bands(np.unique(np.concatenate((both, x)))) for x in (one, two))
            met += bool((a == b).any())
            far += bool((simhash.minima_bands(one) == simhash.minima_bands(two)).any())
    assert met == 1000 and far == 0


def test_near_copies_of_five_word_shingles(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(rng.choice(words, 200)) for _ in range(30)]
    rows = list(enumerate(texts))
    for i in range(10):  # Jaccard similarity of 0.9: two words in two hundred are others
        changed = texts[i].split()
        changed[50], changed[51] = "new", "words"
        rows.append((100 + i, " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == list(range(30))


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_near(rows, similarity=0.8):
    """The component id of each row, by the Jaccard similarity of all pairs of distinct sets."""
    sets = [shingle_set(t) for _, t in rows]
    order = sorted(set(sets), key=len)
    parent = {x: x for x in order}

    def find(x):
        while parent[x] is not x:
            x = parent[x]
        return x

    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if len(a) < similarity * len(b) - 1e-9:
                break
            shared = len(a & b)
            if shared >= similarity * (len(a) + len(b) - shared) - 1e-9:
                parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for (d, _), x in zip(rows, sets, strict=True):
        if d is not None and (least[find(x)] is None or d < least[find(x)]):
            least[find(x)] = d
    return [least[find(x)] for x in sets]


def at_jaccard(rng, n, similarity, name):
    """Two texts of about n five-word shingles each, of which the first ones are shared."""
    words = [f"{name}{i}" for i in rng.permutation(n + 4)]
    shared = round(2 * n * similarity / (1 + similarity))
    return " ".join(words), " ".join([*words[: shared + 4], *(f"x{w}" for w in words[shared + 4 :])])


def test_near_copies_by_exact_jaccard(spark):
    """Pairs at 0.7 stay, pairs at 0.8 and above go, and a chain below the threshold does not hold together."""
    rng = np.random.default_rng(6)
    rows, near = [], set()
    for k, similarity in enumerate((0.7, 0.78, 0.8, 0.85)):
        for i in range(25):
            a, b = at_jaccard(rng, 360, similarity, f"p{k}-{i}-")
            rows += [(len(rows), a), (len(rows) + 1, b)]
            if similarity >= 0.8:
                near.add(len(rows) - 1)
    for i in range(10):  # near copies and a text at 0.7 of them, in one candidate component
        a, b = at_jaccard(rng, 360, 0.7, f"m{i}-")
        rows += [(len(rows), a), (len(rows) + 1, b), (len(rows) + 2, a + " end"), (len(rows) + 3, b + " end")]
        near |= {len(rows) - 1, len(rows) - 2}
    want = brute_near(rows)
    assert {d for (d, _), w in zip(rows, want, strict=True) if d != w} == near
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (8, 4096):
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(df, tile=tile).collect()}
        assert got == {d: w for (d, _), w in zip(rows, want, strict=True)}
    assert {r["doc_id"] for r in simhash.keep_one(df).collect()} == {d for d, _ in rows} - near


def test_repeated_shingles_count_once(spark):
    """A run of equal tokens decides nothing: neither ties unrelated texts nor parts texts that are alike without it."""
    rng = np.random.default_rng(7)
    (a, _), (b, _), (c, _) = (at_jaccard(rng, 400, 0.8, x) for x in "abc")
    rule = " ".join("-" * 60)
    rows = [(1, f"{a} {rule}"), (2, f"{b} {rule}"), (3, f"{c} {'x ' * 900}"), (4, f"{c} {'y ' * 900}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fps = {r["doc_id"]: np.array(r["fp"], np.int64).view(np.uint64) for r in simhash.simhash(df, lanes=4, distinct=True).collect()}
    assert np.bitwise_count(fps[1] ^ fps[2]).sum() > 90
    assert brute_near(rows) == [1, 2, 3, 3]
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == [1, 2, 3]


def test_doubled_text(spark):
    """A text and the same text twice have nearly equal sets of shingles."""
    text, _ = at_jaccard(np.random.default_rng(8), 300, 0.8, "t")
    df = spark.createDataFrame([(1, text), (2, f"{text} {text}")], "doc_id long, text string")
    assert [r["size"] for r in simhash.simhash(df).orderBy("doc_id").collect()] == [300, 304]
    assert [r["doc_id"] for r in simhash.keep_one(df).collect()] == [1]


@pytest.mark.parametrize("which", ["docs", "cases"])
def test_near_copies_of_tables(request, which):
    df = request.getfixturevalue(which)
    rows = rows_of(df)
    got = counted((r["doc_id"], r["component_id"]) for r in simhash.near_copies(df).collect())
    assert got == counted(zip((d for d, _ in rows), brute_near(rows), strict=True))


def test_near_copies_of_a_crowded_lane(spark):
    """Near copies of two templates, chains and strangers, in lanes of many tiles: pairs of tiles that meet grow with the tiles
    where one component holds a lane, and the components stay those of all pairs."""
    rng = np.random.default_rng(21)
    base = rng.integers(0, 2**63, 4, dtype=np.uint64)
    rows = []
    for i in range(640):
        flips = rng.choice(256, 30 if i % 40 else 128, replace=False)  # one in forty is a stranger
        fp = base.copy()
        for b in flips:
            fp[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
        rows.append((i, fp.view(np.int64).tolist(), 100))
    prints = spark.createDataFrame(rows, "node long, fp array<long>, size int")
    lanes = prints.select("node", F.explode(F.array(F.lit(1).cast("long"), 2 + F.col("node") % 2)).alias("lane"))
    fps = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    apart = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2)
    for radius in (72, 58):
        want = np.arange(len(rows))
        while (lower := np.where(apart <= radius, want[None], len(rows)).min(axis=1)).tolist() != want.tolist():
            want = np.minimum(want, lower)
        for tile in (16, 4096) if radius == 72 else (40,):
            found = simhash.lane_links(prints, radius, 0.0, tile, lanes)
            assert all(apart[r["src"], r["dst"]] <= radius for r in found.collect())
            labels = {r["node"]: r["component"] for r in connected_components(found).collect()}
            assert [labels.get(i, i) for i in range(len(rows))] == want.tolist(), (radius, tile)


def test_near_copies_exact_mode(spark, cases):
    """Candidates by prefix filters give brute force over all pairs: at 0.8, in tables of odd rows, and in empty ones."""
    rng = np.random.default_rng(22)
    rows = [(None, None), (1, ""), (2, " \t")]
    for k, similarity in enumerate((0.7, 0.78, 0.8, 0.85)):
        for i in range(8):
            rows += [(len(rows) + j, t) for j, t in enumerate(at_jaccard(rng, 180, similarity, f"e{k}-{i}-"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for table in (df, cases):
        want = counted(zip((d for d, _ in rows_of(table)), brute_near(rows_of(table)), strict=True))
        assert counted((r["doc_id"], r["component_id"]) for r in simhash.near_copies(table, exact=True).collect()) == want
    assert simhash.near_copies(df.where("false"), exact=True).count() == 0


def test_known_sets_meet_the_others(spark):
    """Sets that are connected already are not compared with one another, and all others still find them."""
    rng = np.random.default_rng(23)
    sets = [[*range(i, i + 90)] for i in range(0, 60, 2)] + [[*rng.choice(150, 95, replace=False).tolist()] for _ in range(20)]
    sets += [[*s[3:], -i - 1] for i, s in enumerate(sets[:10])]
    df = spark.createDataFrame([(i, 1, i < 30, s) for i, s in enumerate(sets)], "node long, component long, known boolean, shingles array<long>")
    alike = lambda a, b: len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))
    chain = [(i, i + 1) for i in range(29)]
    want = spark.createDataFrame([*chain, *((i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j]))], "src long, dst long")
    want = {(r["node"], r["component"]) for r in connected_components(want).collect()}
    for tile in (200, 1 << 15):
        found = simhash.set_links(df, 0.8, tile)
        assert not found.where("src < 30 and dst < 30").count()
        joined = found.unionByName(spark.createDataFrame(chain, "src long, dst long"))
        assert {(r["node"], r["component"]) for r in connected_components(joined).collect()} == want


def test_set_links_of_tiles(spark):
    """Tiles of whatever size give the components of all pairs: chains at 0.8, many sets that share much but do not link, and
    empty sets."""
    rng = np.random.default_rng(12)
    base = np.arange(100)
    sets = [[]] * 3 + [[i] for i in (7, 7, 8)]
    for i in range(40):  # 30 hashes of 100 are own: no two link
        sets.append([*rng.choice(base, 70, replace=False).tolist(), *range(1000 + 50 * i, 1030 + 50 * i)])
    for i in range(20):  # each links with the next: 95 of 105
        sets.append(list(range(5000 + 5 * i, 5100 + 5 * i)))
    component = [1 + (i >= 50) for i in range(len(sets))]
    df = spark.createDataFrame([(i, c, s) for i, (c, s) in enumerate(zip(component, sets, strict=True))], "node long, component long, shingles array<long>")

    def least(links):
        root = list(range(len(sets)))
        while any(root[a] != root[b] for a, b in links):
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root

    def alike(a, b):
        return len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))

    want = least([(i, j) for i in range(len(sets)) for j in range(i) if component[i] == component[j] and alike(sets[i], sets[j])])
    for tile in (150, 1000, 1 << 15):
        found = [(r["src"], r["dst"]) for r in simhash.set_links(df, 0.8, tile).collect()]
        assert all(alike(sets[a], sets[b]) for a, b in found)
        assert least(found) == want


def test_keep_one_of_cases(cases):
    got = [(r["doc_id"], r["text"]) for r in simhash.keep_one(cases).collect()]
    texts = [t for _, t in got]
    assert texts.count(A) == 1 and (1, A) in got
    assert (None, f"{B} tail") not in got or (7, f"{B}\n{A}") in got
    assert len(got) == len(set(got)) and {d for d, _ in got} >= {1, 4, 9, 10, 11}


# Line dedup


def test_line_dedup(cases):
    rows = cases.collect()
    sites, least = defaultdict(set), {}
    cut = lambda x: x.strip(" \t\r")
    for r in rows:
        for line in (r["text"] or "").split("\n") if r["text"] is not None else []:
            sites[cut(line)].add(r["source"] or "")
            if r["doc_id"] is not None:
                least[cut(line)] = min(least.get(cut(line), 1 << 60), r["doc_id"])
    want = []
    for r in rows:
        lines = r["text"].split("\n") if r["text"] is not None else []
        kept = [x for x in lines if not cut(x) or len(sites[cut(x)]) < 4 or least.get(cut(x), r["doc_id"]) == r["doc_id"]]
        want.append((r["doc_id"], len(lines), len(lines) - len(kept), None if r["text"] is None else "\n".join(kept), "clash"))
    got = line_dedup(cases, min_sites=4).select("doc_id", "n_lines", "n_removed", "kept_text", "_key").collect()
    assert counted(got) == counted(want)
    assert any(w[2] for w in want)


# Substrings


def brute_substrings(rows, window):
    first = {}
    docs = [((1 << 63) - 1 if d is None else d, d, (t or "").encode().split()) for d, t in rows]
    for rank, _, words in docs:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, rank), rank)
    out = []
    for rank, d, words in docs:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < rank:
                gone |= set(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((d, len(words), len(gone), kept))
    return out


@pytest.mark.parametrize("window", [5, 12, 50])
@pytest.mark.parametrize("which", ["docs", "cases"])
def test_substring_dedup(request, which, window):
    df = request.getfixturevalue(which)
    got = substring_dedup(df, window=window).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert counted(got) == counted(brute_substrings(rows_of(df), window))


# Fingerprints


def test_edit_probe(cases, docs):
    for df in (cases, docs):
        rows = rows_of(df)
        got = fingerprints.edit_probe(df).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
        prints = {}
        for r in got:
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            prints.setdefault(r["doc_id"], r["fingerprint"])
    order = [(d, t or "") for d, t in sorted(rows_of(docs), reverse=True)]
    want = {}
    for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        want[d] = (len(t), t[: len(t) - half] + after[:half])
    assert {r["doc_id"]: (r["n_chars"], r["edited_text"]) for r in got} == want
    by_text = {}
    for d, t in rows_of(docs):
        assert by_text.setdefault(t, prints[d]) == prints[d]
    ranks = fingerprints.rarity(fingerprints.histogram(docs))
    for d, t in rows_of(docs)[:20]:
        assert fingerprints.packed(fingerprints.digest(t, ranks)) == prints[d]
    long = [r for r in got if r["n_chars"] > 2000]
    assert np.mean([r["near_edited"] for r in long]) > 0.35 > 0.15 > np.mean([r["near_next"] for r in long])


def brute_features(data, ranks):
    """The windows that are the rarest of enough of their neighbourhoods, first of equals, by their bytes."""
    w, around, popular = fingerprints.WINDOW, fingerprints.AROUND, fingerprints.POPULAR
    if len(data) < w:
        return [data] if data else []
    bins = []
    for i in range(len(data) - w + 1):
        counts = Counter(data[i : i + w])
        bins.append(sum(round(c * np.log2(c) * 65536) for c in counts.values()) * (fingerprints.BINS - 1) // int(fingerprints._TERMS[w]))
    best = lambda a, b: min(range(a, b), key=lambda i: (ranks[bins[i]], i))
    if len(bins) < around:
        return [data[best(0, len(bins)) :][:w]]
    votes = Counter(best(a, a + around) for a in range(len(bins) - around + 1))
    chosen = sorted(i for i, n in votes.items() if n >= popular) or [min(votes, key=lambda i: (-votes[i], i))]
    return list(dict.fromkeys(data[i : i + w] for i in chosen))


def test_fingerprints_against_brute_force(docs):
    """Selection of windows, the chain of filters and likeness, each recomputed plainly."""
    ranks = fingerprints.rarity(fingerprints.histogram(docs))
    chains = []
    for _, text in sorted(rows_of(docs), key=lambda r: len(r[1] or ""))[:60]:
        data = (text or "").encode()[:1500]
        raw = np.frombuffer(data, np.uint8)
        want, got = brute_features(data, ranks), fingerprints.features(raw, ranks)
        alone = [fingerprints.run_hashes(np.frombuffer(x, np.uint8).astype(np.uint64) + np.uint64(1), fingerprints.BYTE_BASE, np.array([0]), np.array([len(x)]))[0] for x in want]
        assert got.tolist() == [int(x) for x in alone]
        filters = [set() for _ in range(-(-len(want) // fingerprints.FILTER_FEATURES))]
        for i, x in enumerate(got):
            for k in range(fingerprints.HASHES):
                filters[i // fingerprints.FILTER_FEATURES].add(int(fingerprints.mixed(x + np.uint64(k))) % fingerprints.FILTER_BITS)
        chain = fingerprints.chain(got)
        assert [set(np.flatnonzero(f).tolist()) for f in chain] == filters
        assert np.array_equal(fingerprints.unpacked(fingerprints.packed(chain)), chain)
        chains.append((chain, filters))
    for (a, fa), (b, fb) in zip(chains, chains[1:], strict=False):
        fa, fb = (fa, fb) if len(fa) <= len(fb) else (fb, fa)
        if not fa:
            want = float(not fb)
        else:
            def score(x, y):
                chance, most = len(x) * len(y) / fingerprints.FILTER_BITS, min(len(x), len(y))
                return 1.0 if most <= chance else min(1.0, max(0.0, (len(x & y) - chance) / max(most - chance, 1)))

            want = float(np.mean([max(score(x, y) for y in fb) for x in fa]))
        assert abs(fingerprints.likeness(a, b) - want) < 1e-5


def test_equal_and_missing_ids_are_dealt_to_slots(spark):
    """Many rows without an id, or with one id, do not share a slot, and keep their order."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} {'x' * (i % 50)}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed = fingerprints.with_next(df).collect()
    own = [r for r in placed if not r["ahead"]]
    assert counted((r["doc_id"], r["text"]) for r in own) == counted(rows)
    for chosen in (None, 7):
        slots = Counter(r["slot"] for r in own if r["doc_id"] == chosen)
        assert len(slots) > 2 and max(slots.values()) < 250
    probed = fingerprints.edit_probe(df).collect()
    assert counted((r["doc_id"], r["n_chars"]) for r in probed) == counted((d, len(t)) for d, t in rows)


def test_entropy_of_windows():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 110, 500).astype(np.uint8)
    bins = fingerprints.entropy_bins(data)
    for i in range(len(bins)):
        counts = np.bincount(data[i : i + fingerprints.WINDOW])
        total = sum(round(c * np.log2(c) * 65536) for c in counts if c)
        assert bins[i] == total * (fingerprints.BINS - 1) // int(fingerprints._TERMS[fingerprints.WINDOW])


# Tokens


def test_bpe(cases, docs, library):
    for df in (cases, docs):
        rows = rows_of(df)
        got = bpe.decode(bpe.encode(df, PATH), PATH).collect()
        ids = [tuple(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
        texts = [library.decode(list(x), skip_special_tokens=False) for x in ids]
        want = Counter(zip((d for d, _ in rows), ids, texts, strict=True))
        assert Counter((r["doc_id"], tuple(r["ids"]), r["text"]) for r in got) == want
        both = bpe.round_trip(df, PATH).collect()
        assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["text"]) for r in both) == want
        assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in both)


def test_bpe_of_odd_texts(library):
    known, fast = bpe.vocabulary(PATH), packing.encoder(PATH)
    rng = np.random.default_rng(4)
    letters = [*"ab c'sS tll\n\t  .,9", " ", " ", "\x1c", "\x85", "é", "日", "🙂", "<|endoftext|>", "́", "²", "Ⅷ", "​"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(4000)]
    texts += ["".join(f"{chr(c)} {chr(c)}a " for c in range(a, a + 256) if not 0xD800 <= c < 0xE000) for a in range(0, 0x3000, 256)]
    texts += [f"one two\nthree {x}\nfour" for x in ("a,b", "", "don't", "\u2028", "<|endoftext|>")]
    texts += [x * 30_000 for x in ("a", " ", "\n", "^", "1", "ab", "x ")] + [f"{' ' * 30_000}x", *thue_morse(2048)]
    for text in texts:
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert known.encode(text) == want, repr(text)[:200]
        assert fast.encode(text) == want, repr(text)[:200]
        assert known.decode(np.frombuffer(want, "<u4").tolist()) == text


def test_other_files():
    """Files of another kind are left to the library."""
    path = public_tokenizers.path("word_bpe_49k.json")
    own, other = packing.encoder(path), Tokenizer.from_file(path)
    for text in ("One two, three!", "", "<|endoftext|> x"):
        assert own.encode(text) == np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert own.ranks is None and packing.encoder(PATH).ranks


def test_long_texts_in_segments(library, monkeypatch):
    """Where a long text is cut changes nothing."""
    monkeypatch.setattr(words, "SEGMENT", 7)
    rng = np.random.default_rng(9)
    known, fast = bpe.vocabulary(PATH), packing.encoder(PATH)
    for _ in range(1500):
        text = "".join(rng.choice([*"ab's\n ., ", " ", " ", "  ", "é", "<|endoftext|>"], 60))
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert known.encode(text) == fast.encode(text) == want, repr(text)
        assert "".join(words.segments(text)) == text


def test_forgotten_pretokens(library):
    """A full store of pretokens forgets, and gives the same."""
    known = bpe.Vocabulary(PATH)
    known.words.kept.most = 5000
    for text in [f"{A} {B}", B, A, f"{A} {A}"] * 2:
        assert known.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert known.words.kept.held <= 5000 + 400


# Packing


def test_packing(cases, docs, library):
    for df in (cases, docs):
        got = packing.pack(df, PATH, limit=512).collect()
        want = Counter()
        for d, t in rows_of(df):
            ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
            at = 0
            for k in range(-(-len(ids) // 512)):
                n = len(ids) % 512 or min(512, len(ids)) if k == 0 else 512
                want[d, k, at, n, zlib.crc32(ids[at : at + n].tobytes())] += 1
                at += n
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        bins = defaultdict(list)
        for r in got:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for members in bins.values():
            end = 0
            for offset, length in sorted(members):
                assert offset == end
                end += length
            assert end <= 512
        lengths = np.array([r["length"] for r in got])
        assert len(bins) <= max(len(packing.best_fit(lengths, 512)[2]), -(-lengths.sum() // 512)) * 1.03 + 1


def test_best_fit():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 100, 3000)
    bins, offsets, held = packing.best_fit(lengths, 100)
    assert np.array_equal(np.bincount(bins, lengths), held) and max(held) <= 100
    room = []
    for n in sorted(lengths, reverse=True):  # the plain rule: the fullest bin that has room
        fit = [i for i, r in enumerate(room) if r >= n]
        if fit:
            room[min(fit, key=lambda i: room[i])] -= n
        else:
            room.append(100 - n)
    assert len(held) == len(room)


# Queries


def test_queries_run(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        df = query(spark, sf)
        assert df.columns and (name in ("op1_url_filters", "op6_packing", "op8_warc", "op11_vector_codes", "op12_conversation_trie") or df.count() == n)


def test_long_white_space_is_encoded_as_the_library_does(spark):
    """The pattern's own library gives up on runs of a million characters and more."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = [" " * 1_200_000 + "a", "x" + "\n" * 1_100_000, "b \n\t" * 3 + " \n" * 600_000 + "c d", "\t" * 70_000 + " e<|endoftext|>" + " " * 1_050_000]
    for text in texts:
        want = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert packing.encoder(path).encode(text) == want
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sizes = {r["doc_id"]: r["n"] for r in packing.pack(df, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert sizes == {i: len(whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_long_pretokens(monkeypatch):
    """Typed arrays give what lists give, and what the library gives; ranks that come back below the present one are taken first."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    known, whole, rng = bpe.Vocabulary(path), Tokenizer.from_file(path), np.random.default_rng(1)
    letters = [b"a" * 3000, b"the" * 700, "éèü".encode() * 500, bytes(rng.choice(list(b"etaoinshr"), 5000)), b"ab", b"q", b""]
    for piece in letters:
        assert known.merged_long(piece).tolist() == known.merged(piece)
    text = "x" + "".join(rng.choice(list("etaoinshrdlu"), 300_000)) + " end"
    assert np.frombuffer(known.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert known.decode(np.frombuffer(known.encode(text), "<u4")) == text
    # A file in which a merge makes a symbol that an earlier merge takes.
    known.merges, known.pairs = [{} for _ in range(9)], [(3, 2, 4), (0, 1, 3), (4, 4, 5)]
    known.byte_ids = [0, 1, 2]
    for rank, (a, b, made) in enumerate(known.pairs):
        known.merges[a][b] = (rank, made)
    piece = bytes(rng.integers(0, 3, 4000, np.uint8))
    assert known.merged_long(piece).tolist() == known.merged(piece)
