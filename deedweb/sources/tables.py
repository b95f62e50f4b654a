"""Readers and writers of datasets. Everything is read as strings; contracts say which columns are boolean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from deedweb.functions.clean import coerce_boolean, null_tokens
from deedweb.scratch import written

#: Zones of a dataset root, and the datasets of each.
CATALOG = {
    "raw": ("props_taxpayers", "corps", "llcs", "class_codes"),
    "pre_process": ("properties", "taxpayer_records", "corps", "llcs", "unvalidated_addrs"),
    "process": ("props_taxpayers", "class_codes", "fixing_addrs", "fixing_tax_names", "address_analysis", "frequent_tax_names"),
    "geocodio": ("gcd_validated", "gcd_unvalidated", "gcd_failed", "partials"),
    "analysis": ("address_analysis", "frequent_tax_names", "fixing_addrs", "fixing_tax_names"),
    "outputs": ("taxpayers_prepped", "taxpayers_string_matched", "taxpayers_networked", "corps_subsetted", "llcs_subsetted"),
    "summary_stats": ("data_load", "data_clean", "address_clean", "address_geocodio", "clean_merge", "string_match", "network_graph"),
    "schema": ("validation_errors",),
}


def dataset_path(root: str, zone: str, name: str) -> str:
    """Where a dataset of the catalog is."""
    if name not in CATALOG.get(zone, ()):
        raise KeyError(f"no dataset {name} in zone {zone}")
    return f"{root.rstrip('/')}/{zone}/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there and holds anything, in any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(at) and files.getContentSummary(at).getLength() > 0


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


def coerce_booleans(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: coerce_boolean(c) for c in cols if c in df.columns})


def load(spark: SparkSession, path: str, kind: str = "parquet", contract: StructType | None = None, na_tokens: list[str] | None = None) -> DataFrame | None:
    """A dataset of Parquet, CSV, JSON or ORC with string columns, and booleans where the contract has them. Strings that mean a
    missing value in CSV become null. None where there is nothing at the path."""
    if not exists(spark, path):
        return None
    if kind == "csv":
        reader = spark.read.options(header=True, multiLine=True, escape='"', inferSchema=False)
        df = reader.csv(path)
        df = df.select(*(null_tokens(c, na_tokens).alias(c) for c in df.columns))
    elif kind == "json":
        df = all_strings(spark.read.json(path, primitivesAsString=True))
    else:
        df = all_strings(spark.read.format(kind).load(path))
    booleans = [f.name for f in contract if isinstance(f.dataType, BooleanType)] if contract else []
    return coerce_booleans(df, booleans)


def load_with_quarantine(spark: SparkSession, path: str, schema: StructType, kind: str = "csv", required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV or JSON files that fit, in the columns of ``schema``, and those that do not: ``file, reason, record``.

    A record that does not fit the schema (a field too few or too many, a value of another type, broken JSON) is ``malformed`` and kept as
    it was read; one without a value in a ``required`` column is ``missing: `` and the columns' names, and kept as JSON. The files
    are read once, and what was read is written before it is divided, so both tables speak of the same read. No row is lost:
    good and bad ones add up to the records of the files. An empty CSV line is no record.
    """
    raw = "_malformed"
    reader = spark.read.schema(StructType([*schema.fields, StructField(raw, StringType())])).options(mode="PERMISSIVE", columnNameOfCorruptRecord=raw)
    rows = reader.options(header=True, enforceSchema=True, escape='"').csv(path) if kind == "csv" else reader.json(path)
    rows = written(rows.select("*", F.col("_metadata.file_path").alias("_file")), "loaded")
    absent = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required or []))) if required else F.array().cast("array<string>")
    reason = F.when(F.col(raw).isNotNull(), F.lit("malformed")).when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", ")))
    marked = rows.withColumn("_reason", reason)
    names = schema.fieldNames()
    bad = marked.where("_reason is not null")
    record = F.coalesce(F.col(raw), F.to_json(F.struct(*names)))
    return marked.where("_reason is null").select(*names), bad.select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), record.alias("record"))


def save(df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> None:
    """The whole table at ``path``."""
    writer = df.write.mode(mode)
    (writer.options(header=True, escape='"') if kind == "csv" else writer).format(kind).save(path)


def save_partial(df: DataFrame, path: str, batch: str) -> None:
    """Appends a batch of results as a partition of its own."""
    df.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("batch").parquet(path)


def store(df: DataFrame, root: str, name: str) -> str:
    """A Parquet dataset by identifier; returns where it is."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def retrieve(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def read_dataset(spark: SparkSession, root: str, zone: str, name: str, contract: StructType | None = None) -> DataFrame | None:
    return load(spark, dataset_path(root, zone, name), contract=contract)


def write_dataset(df: DataFrame, root: str, zone: str, name: str) -> None:
    save(df, dataset_path(root, zone, name))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
