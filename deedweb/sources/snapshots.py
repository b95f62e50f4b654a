"""Published tables: versions that a reader sees whole or not at all.

A version is a manifest, a small file that names the data folders of each table. Data is written first, to folders that nobody knows of; then
the manifest is moved to its name, which fails if that version is there already. So a reader never sees half a write, a
write that fails leaves the version before, and of two writers one is told. A batch is numbered by its source; one that
runs again after it was published changes nothing. On a store without an atomic move that refuses to overwrite (some object stores), keep
manifests on one that has it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MANIFESTS, DATA = "manifests", "data"


@dataclass(frozen=True)
class Snapshot:
    """A version of the tables below ``root``: the folders of each, and the last batch of each source."""

    root: str
    version: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A table as it was when this version was published."""
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(json.loads(self.schemas[name]))
        paths = [f"{self.root}/{p}" for p in self.folders[name]]
        return spark.read.schema(schema).parquet(*paths) if len(paths) == 1 else _united(spark, schema, paths)


    def part(self, spark: SparkSession, name: str, buckets: list[int] | None = None) -> DataFrame:
        """A table that ``publish_parts`` made, or only some of its buckets, without the column that says which."""
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(json.loads(self.schemas[name]))
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.root}/{p}" for p in self.folders[name] if wanted is None or bucket_of(p) in wanted]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def bucket_of(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def _united(spark: SparkSession, schema, paths: list[str]) -> DataFrame:
    """Folders that may be partitioned by the same columns: each is read from its own base, so that their names do not clash."""
    found = spark.read.schema(schema).parquet(paths[0])
    for path in paths[1:]:
        found = found.unionByName(spark.read.schema(schema).parquet(path))
    return found


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions, ascending."""
    _, at, fs = _fs(spark, f"{root}/{MANIFESTS}")
    names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n) for n in names if n.isdigit())


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The last version, or the one asked for; version 0, without tables, if none was published."""
    root = root.rstrip("/")
    there = versions(spark, root)
    version = (there[-1] if there else 0) if version is None else version
    if not version:
        return Snapshot(root)
    text = "".join(r.value for r in spark.read.text(f"{root}/{MANIFESTS}/{version:012d}", wholetext=True).collect())
    return Snapshot(root, **json.loads(text))


def publish(
    spark: SparkSession,
    root: str,
    replace: dict[str, DataFrame] | None = None,
    append: dict[str, DataFrame] | None = None,
    source: str | None = None,
    batch: int = 0,
    partition_by: dict[str, list[str]] | None = None,
    since: Snapshot | None = None,
) -> Snapshot:
    """A new version in which the tables of ``replace`` are new, those of ``append`` have more rows, and all others are as they were.

    With ``source``, batches are counted: a batch up to the last one published is not written again, and the version that is there
    is returned. ``since`` is the version that the tables were made from (the last one, if not given); if another was published
    meanwhile, this raises and nothing is published. ``partition_by`` names the columns that tables are laid out by.
    """
    before = since or snapshot(spark, root)
    if source is not None and batch <= before.batches.get(source, -1):
        return before
    root, folders, schemas = before.root, dict(before.folders), dict(before.schemas)
    for name, df in {**(replace or {}), **(append or {})}.items():
        folder = f"{DATA}/{name}-{uuid.uuid4().hex}"
        df.write.partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{root}/{folder}")
        folders[name] = [*([] if name in (replace or {}) else folders.get(name, [])), folder]
        schemas[name] = df.schema.json()
    batches = before.batches | ({source: batch} if source is not None else {})
    after = Snapshot(root, before.version + 1, folders, batches, schemas)
    _commit(spark, after)
    return after


def publish_parts(
    spark: SparkSession, root: str, name: str, rows: DataFrame, bucket: str, touched: list[int], source: str | None = None, batch: int = 0, since: Snapshot | None = None
) -> Snapshot:
    """A new version in which the buckets ``touched`` of a table have the rows given, whose column ``bucket`` says where they
    belong; its other buckets are the folders that they were. Batches count as in ``publish``."""
    before = since or snapshot(spark, root)
    if source is not None and batch <= before.batches.get(source, -1):
        return before
    folder = f"{DATA}/{name}-{uuid.uuid4().hex}"
    rows.repartition(bucket).write.partitionBy(bucket).parquet(f"{before.root}/{folder}")
    _, at, fs = _fs(spark, f"{before.root}/{folder}")
    new = [f"{folder}/{x.getPath().getName()}" for x in fs.listStatus(at) if x.isDirectory() and "=" in x.getPath().getName()]
    kept = [f for f in before.folders.get(name, []) if bucket_of(f) not in set(touched)]
    batches = before.batches | ({source: batch} if source is not None else {})
    schemas = before.schemas | {name: rows.drop(bucket).schema.json()}
    after = Snapshot(before.root, before.version + 1, before.folders | {name: kept + sorted(new)}, batches, schemas)
    _commit(spark, after)
    return after


def _commit(spark: SparkSession, after: Snapshot) -> None:
    text = json.dumps({k: getattr(after, k) for k in ("version", "folders", "batches", "schemas")})
    jvm, draft, fs = _fs(spark, f"{after.root}/{MANIFESTS}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, final, _ = _fs(spark, f"{after.root}/{MANIFESTS}/{after.version:012d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)  # fails if the version is there


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forgets all but the last ``keep`` versions, deletes the data folders that none of these has, and says which. Not for
    a time when others write: data that is not published yet would go too."""
    there = versions(spark, root)
    kept = [snapshot(spark, root, v) for v in there[-keep:]]
    used = {"/".join(f.split("/")[:2]) for s in kept for paths in s.folders.values() for f in paths}
    for version in there[:-keep]:
        _, at, fs = _fs(spark, f"{root}/{MANIFESTS}/{version:012d}")
        fs.delete(at, False)
    _, at, fs = _fs(spark, f"{root}/{DATA}")
    found = [f"{DATA}/{x.getPath().getName()}" for x in fs.listStatus(at)] if fs.exists(at) else []
    gone = sorted(f for f in found if f not in used)
    for folder in gone:
        _, at, fs = _fs(spark, f"{root}/{folder}")
        fs.delete(at, True)
    return gone
