"""The network of owners and addresses, its components and their names."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from deedweb.functions import constants as K
from deedweb.operators.components import connected_components
from deedweb.scratch import written


@dataclass(frozen=True)
class NetworkParams:
    """What goes into a network. ``suffix`` is the address variant (``v1`` ...) of tables that have several."""

    name_col: str = "clean_name"
    match_col: str | None = None
    include_unvalidated: bool = False
    include_unresearched: bool = False
    include_orgs: bool = False
    include_missing_suites: bool = False
    include_problem_suites: bool = False
    suffix: str | None = None
    ignored_entities: list[str] = field(default_factory=lambda: list(K.IGNORED_ENTITIES))
    ignored_names: list[str] = field(default_factory=list)


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def address_counts(address: str, params: NetworkParams, end: str = "") -> Column:
    """Whether an address is part of the network, from the flags that have ``end`` in their names: it is there, validated
    (or that is waived), not excluded, and researched (or that is waived); a researched address of an organisation needs
    ``include_orgs``."""
    there = F.col(address).isNotNull() & (F.col(address) != "")
    known = F.lit(params.include_unvalidated) | _flag(f"is_validated{end}")
    org = ~_flag(f"is_org_address{end}") | F.lit(params.include_orgs)
    researched = F.lit(params.include_unresearched) | (_flag(f"is_researched{end}") & org)
    return F.coalesce(there & known & ~_flag(f"exclude_address{end}") & researched, F.lit(False))


def address_counts_by_suite(address: str, params: NetworkParams, end: str = "") -> Column:
    """The same for tables with suite flags; the first rule that fits decides."""
    suites = params.suffix in ("v2", "v4")
    return (
        F.when(F.col(address).isNull() | (F.col(address) == ""), False)
        .when(~_flag(f"is_validated{end}"), params.include_unvalidated and params.include_unresearched)
        .when(~_flag(f"is_researched{end}"), params.include_unresearched)
        .when(_flag(f"exclude_address{end}"), False)
        .when(F.lit(suites) & _flag(f"is_missing_suite{end}"), params.include_missing_suites)
        .when(F.lit(suites) & _flag(f"is_problem_suite{end}"), params.include_problem_suites)
        .when(_flag(f"is_org_address{end}"), params.include_orgs)
        .otherwise(True)
    )


def _pairs(df: DataFrame, pairs: list[tuple[Column, Column]]) -> DataFrame:
    """``src, dst`` rows; a missing end gives a lone node, two missing ones give nothing."""
    rows = F.explode(F.array(*(F.struct(a.alias("a"), b.alias("b")) for a, b in pairs)))
    ends = df.select(rows.alias("p")).select("p.a", "p.b").where("a is not null or b is not null")
    return ends.select(F.coalesce("a", "b").alias("src"), F.coalesce("b", "a").alias("dst"))


def taxpayer_edges(df: DataFrame, params: NetworkParams) -> DataFrame:
    """Edges of one taxpayer table (columns with ``_t`` and ``_e1`` to ``_e3``): name and address; name, address and string
    match; entity name and each of its addresses. An excluded name or an address that does not count leaves the other as a
    lone node."""
    name = F.when(~_flag("exclude_name"), F.col(params.name_col))
    address = F.when(address_counts("match_address_t", params, "_t"), F.col("match_address_t"))
    pairs = [(name, address)]
    if params.match_col:
        match = F.col(params.match_col)
        pairs += [(F.when(match.isNotNull(), name), F.when(name.isNotNull(), match)), (F.when(match.isNotNull(), address), F.when(address.isNotNull(), match))]
    entity = F.when(F.col("entity_clean_name").isNotNull() & ~F.col(params.name_col).isin(params.ignored_entities), F.col(params.name_col))
    for i in (1, 2, 3):
        own = F.when(address_counts(f"match_address_e{i}", params, f"_e{i}"), F.col(f"match_address_e{i}"))
        pairs.append((F.when(own.isNotNull(), entity), F.when(entity.isNotNull(), own)))
    return _pairs(df, pairs).distinct()


def taxpayer_edges_with_filings(df: DataFrame, filings: DataFrame, params: NetworkParams, uid: str = "uid", spanning: bool = False) -> DataFrame:
    """Edges of a taxpayer table with address variants, and of business filings that share its ``uid``. A filing's address is
    judged by the filing's own flags. A uid ties each of its names to each of its addresses; with ``spanning``, its names to its first
    address and its addresses to its first name, which gives the same components from as many edges as there are names and addresses."""
    address_col = f"match_address_{params.suffix}"
    ignored = F.col(params.name_col).isin([*params.ignored_names, "UNKNOWN"])
    name = F.when(~_flag("exclude_name") & ~ignored, F.col(params.name_col))
    address = F.when(address_counts_by_suite(address_col, params), F.col(address_col))
    pairs = [(name, address)]
    if params.match_col:
        match = F.col(params.match_col)
        pairs += [(F.when(match.isNotNull(), name), F.when(name.isNotNull(), match)), (F.when(match.isNotNull(), address), F.when(address.isNotNull(), match))]
    own = filings.where(address_counts_by_suite(address_col, params)).select(uid, F.col(address_col).alias("dst")).distinct()
    entities = df.where(F.col(uid).isNotNull() & F.col(params.name_col).isNotNull()).select(uid, F.col(params.name_col).alias("src")).distinct()
    if spanning:
        key = lambda: F.struct(F.col(uid).alias("uid"))  # noqa: E731  (plain exchanges, which can be split where a uid is frequent)
        address = own.groupBy(key().alias("_of")).agg(F.min("dst").alias("dst"))
        first = entities.groupBy(key().alias("_of")).agg(F.min("src").alias("src"))
        tied = entities.join(address, key() == F.col("_of")).select("src", "dst").unionByName(own.join(first, key() == F.col("_of")).select("src", "dst"))
    else:
        tied = entities.join(own, uid).select("src", "dst")
    return _pairs(df, pairs).unionByName(tied).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node)."""
    return written(connected_components(edges), "network")


def numbered(parts: DataFrame) -> DataFrame:
    """``parts`` plus ``component_id``: 0, 1, ... in the order of the components' names. Names are sorted into ranges and
    numbered inside each; what is added up centrally is one count for each range."""
    names = parts.select("component").distinct()
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = written(names.repartitionByRange(n, "component").withColumn("part", F.spark_partition_id()), "numbers")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # a row for each partition
    before = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("component")) - 1
    found = ranges.withColumn("place", place).join(F.broadcast(before), "part")
    return parts.join(found.select("component", (F.col("before") + F.col("place")).alias("component_id")), "component")


def network_counts(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """``components, nodes, edges`` (without lone nodes; each edge once, whichever way round)."""
    ends = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    nodes = parts.agg(F.count_distinct("component").alias("components"), F.count(F.lit(1)).alias("nodes"))
    return nodes.crossJoin(ends.agg(F.count(F.lit(1)).alias("edges")))


def assign_components(df: DataFrame, parts: DataFrame, keys: list[str | Column], row_id: str, number: int = 1) -> DataFrame:
    """``final_component_<number>``: the component of the first key of a row that is a node. Rows that a key finds are done; only the
    others are looked up by the next, so a row is moved about once and not once for each key. Rows have different ``row_id``s."""
    name = f"final_component_{number}"
    named = parts.select(F.struct(F.col("node").alias("_key")).alias("_node"), F.col("component").alias(name))
    rest, done = df.drop(name), []
    for key in keys:
        wanted = F.col(key) if isinstance(key, str) else key
        missed = Observation()
        looked = rest.join(named, F.struct(wanted.alias("_key")) == F.col("_node"), "left").drop("_node")
        looked = written(looked.observe(missed, F.count_if(F.col(name).isNull()).alias("n")), "assigned")
        done.append(looked.where(F.col(name).isNotNull()))
        rest = looked.where(F.col(name).isNull()).drop(name)
        if missed.get["n"] == 0:
            break
    none = rest.withColumn(name, F.lit(None).cast(parts.schema["component"].dataType))
    return reduce(DataFrame.unionByName, [*done, none])


def assign_components_with_filings(
    df: DataFrame, filings: DataFrame, parts: DataFrame, params: NetworkParams, row_id: str, number: int = 1, uid: str = "uid"
) -> DataFrame:
    """The same with the addresses of a row's filings after its own keys."""
    address = f"match_address_{params.suffix}"
    keys = [params.name_col, address, *([params.match_col] if params.match_col else [])]
    own = assign_components(df, parts, keys, row_id, number)
    name = f"final_component_{number}"
    known = filings.select(uid, F.col(address).alias("_key")).distinct()
    by_uid = known.join(parts.select(F.col("node").alias("_key"), "component"), "_key").groupBy(F.struct(uid).alias("_uid"))
    by_uid = by_uid.agg(F.min_by("component", "_key").alias("_more"))
    joined = own.join(by_uid, F.struct(uid) == F.col("_uid"), "left")
    return joined.withColumn(name, F.coalesce(name, "_more")).drop("_uid", "_more")


def set_network_names(df: DataFrame, number: int = 1, name_col: str = "clean_name") -> DataFrame:
    """``network_<number>``: the three most frequent names of the component, its label and the number; ``..._short``: the most
    frequent name. Of equally frequent names the smaller comes first."""
    part = f"final_component_{number}"
    counts = df.where(F.col(part).isNotNull()).groupBy(F.col(part).alias("_part"), F.col(name_col).alias("_name")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    order = F.struct((-F.col("_n")).alias("less"), F.col("_name").alias("name"))
    named = F.col("_name").isNotNull()
    # Three by rank from each of some buckets, then three of these: no component's names meet in one task.
    dealt = counts.withColumn("_bucket", F.pmod(F.xxhash64("_name"), F.lit(32)))
    dealt = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_part", "_bucket").orderBy(~named, order))).where("_r <= 3")
    top = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_part").orderBy(~named, order))).where("_r <= 3")
    top = top.groupBy("_part").agg(F.array_sort(F.collect_list(F.when(named, order))).alias("_top"))
    texts = F.transform("_top", lambda x: x["name"])
    ending = F.concat(F.lit(" -- "), F.col("_part").cast("string"), F.lit(f" -- ({number})"))
    first = F.try_element_at(texts, F.lit(1))
    short = F.when(first.isNotNull(), F.concat(first, F.lit(" Etc."))).otherwise(F.concat(F.lit(f"Network {number} - "), F.col("_part").cast("string")))
    names = top.select(
        F.struct("_part").alias("_key"), F.concat(F.array_join(texts, " -- "), ending).alias(f"network_{number}"), short.alias(f"network_{number}_short")
    )
    return df.join(names, F.struct(F.col(part).alias("_part")) == F.col("_key"), "left").drop("_key")


#: Edges in one chunk of a network's text.
CHUNK = 1000


def network_text(parts: DataFrame, edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``component, chunk, network_text``: JSON of the component's edges in order, ``chunk`` of them in each row, or of its node
    if there is none.

    Edges are sorted by range over all components and numbered by way of the counts of the ranges, so no component's edges
    meet in one task or one value.
    """
    ends = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    rows = ends.join(parts.select(F.struct(F.col("node")).alias("_node"), "component"), F.struct("a") == F.col("_node")).select("component", "a", "b")
    ranged = written(rows.repartitionByRange("component", "a", "b").withColumn("_part", F.spark_partition_id()), "ranges")
    # How many edges of a component are in earlier ranges: one row for each range and component in it.
    counts = ranged.groupBy("_part", "component").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("component").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("_part").alias("_p"), F.col("component").alias("_c"), F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part", "component").orderBy("a", "b"))
    numbered_rows = ranged.withColumn("_own", own).join(counts, (F.col("_part") == F.col("_p")) & (F.col("component") == F.col("_c")))
    at = F.floor((F.col("_before") + F.col("_own") - 1) / chunk).cast("long")
    shown = numbered_rows.groupBy("component", at.alias("chunk")).agg(F.to_json(F.sort_array(F.collect_list(F.array("a", "b")))).alias("_edges"))
    lone = parts.groupBy("component").agg(F.min("node").alias("_node"))
    return lone.join(shown, "component", "left").select(
        "component", F.coalesce("chunk", F.lit(0).cast("long")).alias("chunk"), F.coalesce("_edges", F.to_json(F.array("_node"))).alias("network_text")
    )


def taxpayer_networks(df: DataFrame, params: list[NetworkParams], row_id: str) -> DataFrame:
    """Components and names of a taxpayer table for each set of parameters, numbered from 1."""

    def one(found: DataFrame, numbered_params: tuple[int, NetworkParams]) -> DataFrame:
        number, own = numbered_params
        parts = components(taxpayer_edges(df, own))
        keys = [own.name_col, "match_address_t", *([own.match_col] if own.match_col else []), *(f"match_address_e{i}" for i in (1, 2, 3))]
        return set_network_names(assign_components(found, parts, keys, row_id, number), number)

    return reduce(one, enumerate(params, 1), df)
