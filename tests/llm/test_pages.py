"""URL filters and WARC bundles."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from deedweb.llm import warc
from deedweb.llm.queries import URL_RULES
from deedweb.llm.url_filters import alias_edges, filter_urls, rule_table
from deedweb.scratch import fresh_path

PAGES = "page_id long, url string, html string, host string, _digest string"


def link(to):
    return f'<html><link href="{to}" rel="canonical"></html>'


def refresh(to):
    return f'<META http-equiv="refresh" content="0; URL={to}">'


URLS = [
    (1, "https://WWW.Example.com/en/a", None),
    (2, "https://blog.example.com/en/a?x=://y", ""),
    (3, "http://x.net/es/", "<p>"),
    (4, "http://free.org/a#top", refresh("http://x.net/es/")),
    (5, "http://free.org/b", link("/a")),
    (6, "http://free.org/c", link("http://fine.org/")),
    (7, "http://fine.com/", link("http://free.org/b")),  # allowed by a rule, though an alias of a blocked page
    (8, "http://via.fine.org/x/y", link("../z")),
    (9, None, link("http://x.net/es/")),
    (10, "no scheme", link("http://x.net/es/")),
    (None, "http://free.org/b", None),
    (None, "http://free.org/b", None),
    (11, "http://example.com", None),
    (12, "http://notexample.com/en/", None),
    (13, "http://free.org/d", link("http://FREE.org/b#part")),
    (14, "://host/p", None),
    (15, "http://h?://q/es/", None),
]


def test_filter_urls(spark):
    pages = spark.createDataFrame([(*x, "h", "d") for x in URLS], PAGES)
    more = spark.createDataFrame([("http://fine.org/", "http://very.org/"), (None, "http://x.org/")], "src string, dst string")
    got = {(r["page_id"], r["url"]): r for r in filter_urls(pages, rule_table(spark, URL_RULES), more).collect()}
    found = {k[0]: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in got.items()}
    assert found == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        2: ("blog.example.com", "/en/a", "example.com/en/", "block"),
        3: ("x.net", "/es/", "net/es/", "block"),
        4: ("free.org", "/a", None, "block"),
        5: ("free.org", "/b", None, "block"),
        6: ("free.org", "/c", None, "allow"),
        7: ("fine.com", "/", "com/", "allow"),
        8: ("via.fine.org", "/x/y", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("", "", None, "allow"),
        None: ("free.org", "/b", None, "block"),
        11: ("example.com", "", None, "allow"),
        12: ("notexample.com", "/en/", "com/", "allow"),
        13: ("free.org", "/d", None, "block"),
        14: ("host", "/p", None, "allow"),
        15: ("h", "", None, "allow"),
    }
    assert filter_urls(pages, rule_table(spark, URL_RULES)).count() == len(URLS)
    assert filter_urls(pages.where("false"), rule_table(spark, URL_RULES)).count() == 0


def test_url_inside_a_relative_link(spark):
    """A link is absolute only if it begins with a scheme; an address in its query does not count."""
    urls = [
        (1, "http://free.org/a", refresh("/go?to=https://example.com/en/")),
        (2, "http://free.org/go?to=https://example.com/en/", link("http://x.net/es/")),
        (3, "http://fine.org/a", refresh("/go?to=https://example.com/en/")),
        (4, "http://free.org/b/c", refresh("go?to=https://example.com/en/")),
        (5, "http://x.net/es/", None),
    ]
    pages = spark.createDataFrame([(*x, "h", "d") for x in urls], PAGES)
    got = {r["page_id"]: r["verdict"] for r in filter_urls(pages, rule_table(spark, URL_RULES)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block"}
    edges = {tuple(r) for r in alias_edges(pages).collect()}
    assert ("http://free.org/a", "http://free.org/go?to=https://example.com/en/") in edges
    assert ("http://free.org/b/c", "http://free.org/b/go?to=https://example.com/en/") in edges


BIG, SAME = "é" * 300_000, "same payload " * 20
HTML = [
    (1, "http://a/", "x" * 99),
    (2, "http://b/\r\nx", "x" * 99),
    (3, None, None),
    (4, "http://c/", ""),
    (5, "http://d/", SAME),
    (6, "http://e/", SAME),
    (6, "http://e/", SAME),
    (None, "http://f/", SAME),
    (7, "http://g/", BIG),
    (8, "http://h/", BIG),
    (None, "http://i/", "n" * 200),
    (None, "http://j/", "n" * 200),
    (9, "http://k/", "\r\n\r\nWARC/1.1\r\n\r\n"),
]


@pytest.fixture(scope="module")
def bundles(spark):
    pages = spark.createDataFrame([(*x, "h", "d") for x in HTML], PAGES).coalesce(2)
    path = fresh_path(spark, "test-warc")
    warc.write_bundles(pages, path, frame_bytes=2000, bundle_bytes=3000)
    return spark.read.parquet(path)


def test_warc_round_trip(bundles):
    first = {SAME: 5, BIG: 7}
    want = []
    for i, url, html in HTML:
        data = (html or "").encode()
        to = first.get(html) if html in first and first[html] != i else None
        uri = " ".join(url.split()) if url else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if to else "response", to, uri, None if to else html or ""))
    got = [
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["url"], r["payload"])
        for r in warc.read_bundles(bundles).collect()
    ]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_warc_seeks(spark, bundles):
    assert bundles.count() > 1
    for r in bundles.collect():
        content = bytes(r["content"])
        frames = {(a, n) for a, n, _ in warc.read_seek_table(content)}
        assert len(frames) > 1 or len(r["records"]) <= 2
        assert {(x["frame_offset"], x["frame_size"]) for x in r["records"]} == frames
    ids = spark.createDataFrame([(warc.record_id(i),) for i in (7, 9, 4, 99)], "record_id string")
    got = {r["page_id"]: r["payload"] for r in warc.read_at(bundles, ids).collect()}
    assert got == {7: BIG, 9: HTML[-1][2], 4: ""}


def test_warc_empty(spark):
    path = fresh_path(spark, "test-warc")
    warc.write_bundles(spark.createDataFrame([], PAGES), path)
    assert warc.read_bundles(spark.read.schema("content binary").parquet(path)).count() == 0


def test_very_long_hosts(spark):
    """A host of very many labels is judged by its end, in time that grows with its length."""
    long = ".".join(f"x{i}" for i in range(60_000))
    rows = [(1, f"http://{long}.Example.com/en/a", None), (2, f"http://{long}.www.example.com/en/a", None), (3, f"http://{long}.net/fr/{'p' * 500_000}", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in filter_urls(pages, rule_table(spark, URL_RULES)).collect()}
    assert got == {1: ("example.com/en/", "block"), 2: ("www.example.com/en/", "allow"), 3: ("net/fr/", "block")}


PLAIN = "page_id long, url string, html string"
TARGETS = [
    ("https://b.org/p?a=1&b=2", '<meta http-equiv=refresh content="0;url=https://b.org/p?a=1&amp;b=2">'),
    ("https://b.org/p;v=1", "<META content='5; URL=\"/p;v=1\"' http-equiv='Refresh'>"),
    ("https://b.org/x y", '<link rel = "canonical" data-href="/no" href=" https://B.org/x y#top ">'),
    ("https://b.org/q", "<link href=/q rel=canonical>"),
    ("https://b.org/url=/z", '<meta name="refresh" content="0;url=/no"><meta http-equiv="refresh" content="1, url=/url=/z">'),
    (None, '<meta http-equiv="refresh" content="30"><link rel="stylesheet" href="/s"><link rel="canonical">'),
    (None, '<link rel="canonical" href="/never closed'),
    (None, '<link rel="canonical" href="mailto:a@b.org">'),
]


def test_targets_are_whole(spark):
    """Semicolons, escaped ampersands, quotes in quotes, attributes in any order."""
    rows = [(i, f"https://b.org/from{i}", html) for i, (_, html) in enumerate(TARGETS)]
    found = {r.src: r.dst for r in alias_edges(spark.createDataFrame(rows, PLAIN)).collect()}
    assert found == {f"https://b.org/from{i}": to for i, (to, _) in enumerate(TARGETS) if to}


def test_an_alias_by_a_target_with_a_semicolon_is_blocked(spark):
    rows = [
        (1, "https://b.org/p;a=1&b=2", link("https://example.com/en/")),
        (2, "https://c.org/", refresh("https://b.org/p;a=1&amp;b=2")),
        (3, "https://b.org/p", None),
    ]
    got = filter_urls(spark.createDataFrame(rows, PLAIN), rule_table(spark, URL_RULES)).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "block", 3: "allow"}


def test_malformed_pages_take_linear_time(spark):
    """A megabyte each of tags that never close, of one open tag, and of spaces where a value is looked for."""
    pages = ["<link " * 170_000, '<meta http-equiv="refresh" ' + "a=1 " * 250_000, "<link rel=canonical href" + " " * 10**6 + ">", "<meta content='url=" * 50_000]
    df = spark.createDataFrame([(i, f"https://b.org/{i}", p) for i, p in enumerate(pages)], PLAIN)
    began = time.perf_counter()
    assert len(filter_urls(df, rule_table(spark, URL_RULES)).collect()) == len(pages)
    assert time.perf_counter() - began < 60


def test_a_domain_with_very_many_rules(spark):
    """No row holds all rules of a domain; the longest that fits decides, on ties an allow."""
    paths = spark.range(20_000).select(F.lit("b.org").alias("host"), F.concat(F.lit("/p"), "id", F.lit("/")).alias("path"), F.lit("block").alias("verdict"))
    more = spark.createDataFrame([("org", "", "allow"), ("b.org", "/p7/x", "allow"), ("b.org", "/p9/", "allow")], "host string, path string, verdict string")
    urls = ["https://b.org/p5/", "https://a.b.org/p7/xy", "https://b.org/p7/y", "https://b.org/p9/", "https://b.org/none", "https://org/", "https://b.org/p19999/z"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PLAIN)
    got = {r.page_id: (r.rule, r.verdict) for r in filter_urls(df, paths.unionByName(more)).collect()}
    assert got == {
        0: ("b.org/p5/", "block"), 1: ("b.org/p7/x", "allow"), 2: ("b.org/p7/", "block"), 3: ("b.org/p9/", "allow"),
        4: ("org", "allow"), 5: ("org", "allow"), 6: ("b.org/p19999/", "block"),
    }
