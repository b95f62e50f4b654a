"""Intermediate tables in the folder that the cluster shares (``spark.checkpoint.dir``).

A written table cuts the lineage: what follows reads files that every executor can see, so a lost executor costs the
tasks it was running and nothing before them.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where the setting is absent, a new temporary folder is set in a session of one
    process (tests); on a cluster, where executors would each see another folder, that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="deedweb-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used."""
    return f"{shared_dir(spark).rstrip('/')}/deedweb/{name}-{uuid.uuid4().hex}"


#: With it, Spark deletes the shuffle files of a job when the job is over, and not when the driver happens to collect its garbage.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again. What was shuffled for it is deleted, since the table takes its place."""
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
