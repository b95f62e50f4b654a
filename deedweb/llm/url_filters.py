"""URL filters with redirect equivalence, in DataFrame operations only.

A rule names a host and the beginning of a path; the longest that fits a url decides it. Urls that redirect to each other
or name each other as canonical are one site under several names: they form connected components, and a block of one
alias holds for the aliases that no rule decides. An explicit allow is never overruled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deedweb.operators.components import connected_components
from deedweb.scratch import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host is group 1, the path group 2.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: A tag ends before the next one begins, so what is never closed is passed over once.
TAGS = r"(?is)<(?:link|meta)\b[^<>]*+>"
CANONICAL = r"(?is)^<link\b.*[\s\"'/]rel\s*=\s*[\"']?\s*canonical\b"
REFRESH = r"(?is)^<meta\b.*[\s\"'/]http-equiv\s*=\s*[\"']?\s*refresh\b"
#: The rest of a refresh header after ``url=``.
TARGET = r"(?is)(?:^|[;,\s])url\s*=\s*(.*)$"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one, or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``host, path, verdict`` from a list; a large list is better read from a file into the same columns."""
    rows = F.array(*(F.struct(*(F.lit(x).alias(n) for x, n in zip(r, ("host", "path", "verdict"), strict=True))) for r in rules))
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``host, path``) plus ``rule`` and ``ruled``, the rule that decides the url and its verdict, or nulls.

    Distinct hosts learn of each domain above them, themselves included, that has rules how long these rules' paths are; distinct
    urls then look up the beginnings of their paths of those lengths. So a domain may have any number of rules, and a host or url any
    number of rows. Only domains of as many labels as some rule has are made, so the work on a very long host grows with its
    length. Of equally long rules, an allow comes first.
    """
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    pairs = urls.where("host <> ''").select("host", "path").distinct()
    labels = F.split("_host", r"\.")
    ends = F.sequence(F.greatest(F.lit(1), F.size(labels) - (most - 1)), F.size(labels))
    above = F.transform(ends, lambda i: F.array_join(F.slice(labels, i, F.lit(most)), "."))
    hosts = pairs.select(F.col("host").alias("_host")).distinct().select("_host", F.explode(above).alias("_domain"))
    sizes = rules.groupBy(F.col("host").alias("_domain")).agg(F.collect_set(F.length("path")).alias("_sizes"))  # up to the longest path
    known = hosts.join(sizes, "_domain").select(F.struct(F.col("_host").alias("host")).alias("_of"), "_domain", "_sizes")
    looked = pairs.join(known, F.struct("host") == F.col("_of")).select("host", "path", "_domain", F.explode("_sizes").alias("_size"))
    looked = looked.where(F.length("path") >= F.col("_size")).withColumn("_start", F.substring("path", F.lit(1), F.col("_size")))
    rule = rules.select(F.struct(F.col("host").alias("_domain"), F.col("path").alias("_start")).alias("_rule"), "verdict")
    fits = looked.join(rule, F.struct("_domain", "_start") == F.col("_rule"))
    text = F.concat("_domain", "_start")
    best = F.max(F.struct(F.length(text).alias("size"), (F.col("verdict") == "allow").alias("allows"), text.alias("rule"), "verdict"))
    found = fits.groupBy(F.struct("host", "path").alias("_url")).agg(best.alias("_best"))
    joined = urls.join(found, F.struct("host", "path") == F.col("_url"), "left")
    return joined.select(*urls.columns, F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("ruled"))


def _absolute(url: Column, link: Column) -> Column:
    """A link as seen from a page; links that are no address of a page (``mailto:`` and the like) give null."""
    scheme, root = F.regexp_extract(url, r"(?s)^(.*?:)//", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    slash = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:|^#|^$"), None)
        .otherwise(F.concat(slash, link))
    )


def _node(url: Column) -> Column:
    """Fragments do not make another page; the host's case does not matter."""
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    return F.when(bare.contains("://"), F.concat(F.regexp_extract(bare, r"(?s)^(.*?://)", 1), host_of(bare), F.regexp_replace(bare, r"(?s)^.*?://[^/?#]*", "")))


def _value(tag: Column, name: str) -> Column:
    """The value of an attribute: all between its quotes, or up to a space; ``&amp;`` stands for ``&``. Empty without one."""
    found = [F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*{value}", 1) for value in (r'"([^"]*)"', r"'([^']*)'", r"([^\s\"'>]+)")]
    return F.trim(F.regexp_replace(F.coalesce(*(F.nullif(x, F.lit("")) for x in found), F.lit("")), "(?i)&(?:amp|#38|#x26);", "&"))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src, dst``: from each page to its canonical link and to where its refresh header sends the reader, by the first tag of
    either kind. Targets are taken whole. The work on a page grows with its length, however malformed it is."""
    url = pages[url_col]
    rows = pages.select(_node(url).alias("src"), url.alias("url"), F.regexp_extract_all(pages[html_col], F.lit(TAGS), F.lit(0)).alias("tags"))
    first = lambda kind: F.coalesce(F.get(F.filter("tags", lambda t: t.rlike(kind)), 0), F.lit(""))
    rows = rows.where(F.size("tags") > 0).select("src", "url", first(CANONICAL).alias("link"), first(REFRESH).alias("meta"))
    rows = rows.select("src", "url", _value(F.col("link"), "href").alias("href"), F.regexp_extract(_value(F.col("meta"), "content"), TARGET, 1).alias("target"))
    quoted = F.regexp_extract("target", r"(?s)^[\"']([^\"']*)", 1)
    target = F.trim(F.when(F.col("target").rlike("^[\"']"), quoted).otherwise(F.col("target")))
    rows = rows.select("src", "url", F.explode(F.array("href", target)).alias("link")).where("link <> ''")
    return rows.select("src", _node(_absolute(F.col("url"), F.col("link"))).alias("dst")).where("src is not null and dst is not null and src <> dst")


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, host, path, rule, verdict, alias_of_blocked``.

    ``rule`` is the longest rule that fits, or null, and its verdict is final. Without a rule, a url is blocked if its
    component over redirects and canonical links holds a url that a rule blocks, and else allowed. ``redirects`` has further
    edges ``src, dst``. A null url, or one without ``://``, has an empty host and path, no aliases, and is allowed. Of rules that
    are equally long, an allow decides. Urls and html may be of any length. Null ids and html, and repeated rows, pass through; a url that occurs again has the same verdict. An empty table gives an
    empty result.
    """
    edges = [alias_edges(pages, url_col, html_col)] if html_col else []
    if redirects is not None:
        edges.append(redirects.select(_node(F.col("src")).alias("src"), _node(F.col("dst")).alias("dst")))
    names = ["src", "dst"]
    none = pages.sparkSession.range(0).select(*(F.lit("").alias(n) for n in names))
    found = written(connected_components(reduce(DataFrame.unionByName, edges, none)), "aliases")
    parts = lambda df, url: df.withColumns({"host": host_of(url), "path": path_of(url)})
    nodes = judged(parts(found, F.col("node")), rules)
    blocked = nodes.where("ruled = 'block'").select("component").distinct()
    aliases = found.join(blocked, "component", "left_semi").select(F.struct(F.col("node")).alias("_alias"))
    urls = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))
    rows = judged(parts(urls, F.col("url")), rules).withColumn("node", _node(F.col("url")))
    rows = rows.join(aliases, F.struct("node") == F.col("_alias"), "left")
    is_alias = F.col("_alias").isNotNull()
    return rows.select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("ruled", F.when(is_alias, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        is_alias.alias("alias_of_blocked"),
    )
