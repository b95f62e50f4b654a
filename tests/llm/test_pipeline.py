"""The pipeline's stages on the smallest tables and on odd ones."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from deedweb.llm import packing, simhash
from test_documents import brute_near, brute_substrings
from tokenizers import Tokenizer


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0").collect()}
    before, kept = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns, name
        kept.append({r["doc_id"]: r["text"] for r in after.collect()})
        before = after
    assert len(clean - kept[0].keys()) <= 1 and len(toxic & kept[0].keys()) <= 0.4 * len(toxic)
    assert kept[1].keys() == kept[0].keys()
    assert kept[1] == brute_lines(kept[0], {r["doc_id"]: r["source"] or "" for r in docs.collect()})
    rows = list(kept[1].items())
    assert kept[2] == {d: t for (d, t), least in zip(rows, brute_near(rows), strict=True) if d == least}
    want = {d: (n, k) for d, _, n, k in brute_substrings(list(kept[2].items()), 50)}
    assert kept[3] == {d: want[d][1] if want[d][0] else t for d, t in kept[2].items()}
    placed = corpus_pipeline.run(spark, sf).collect()
    library, pieces, held = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter(), defaultdict(list)
    for d, t in kept[3].items():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, (start, n) in enumerate(packing.cuts(len(ids), 2048)):
            pieces[d, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed) == pieces
    for r in placed:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in held.values():
        ends = [0, *(a + n for a, n in sorted(members))]
        assert [a for a, _ in sorted(members)] == ends[:-1] and ends[-1] <= 2048


def brute_lines(texts, source):
    """The texts without lines of five sources or more, but in the document with the smallest id."""
    cut = lambda x: x.strip(" \t\r")
    sites, least = defaultdict(set), {}
    for d, text in sorted(texts.items()):
        for line in (text or "").split("\n"):
            sites[cut(line)].add(source[d])
            least.setdefault(cut(line), d)
    stays = lambda x, d: not cut(x) or len(sites[cut(x)]) < 5 or least[cut(x)] == d
    return {d: None if t is None else "\n".join(x for x in t.split("\n") if stays(x, d)) for d, t in texts.items()}


def test_odd_documents(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b c", None, "s", 5), (3, "a b c", None, "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == {1: 1, 2: 1}
    assert simhash.keep_one(docs).count() == 2
