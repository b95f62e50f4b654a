"""Geocoder answers that arrive in parts and in any order: an address is settled once its answers are in, or late.

What is known of an address is kept in tables beside the results: ``waiting`` has the parts of open addresses, ``closed`` the addresses
that left and until when they are remembered, ``clock`` the watermark. A batch meets ``waiting`` in one shuffle by address. When all parts
are there, or when the watermark passes the time that they were waited for, the address leaves with all candidates of its parts
together, and is settled by the same steps as a whole table. A settled address is remembered until its time is over, so a part that
is sent again does not settle it twice. What a batch settles and what it leaves waiting are published at once and once, however often the
batch runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deedweb.operators.geocode import flatten_results, process_results, split_results
from deedweb.operators.tables import remove_listed
from deedweb.scratch import discard, written
from deedweb.sources.snapshots import Snapshot, publish, snapshot

TABLES = ("validated", "unvalidated", "failed")
#: An answer as ``as_parts`` gives it, and an address that left.
PART, CLOSED = "address string, parts int, answer string, at timestamp", "address string, until timestamp"


def open_addresses(master: DataFrame, *settled: DataFrame, address: str = "clean_address") -> DataFrame:
    """The addresses of the master list that are in none of the settled tables."""
    for table in settled:
        master = remove_listed(master, table, address)
    return master


def as_parts(answers: DataFrame, address: str = "clean_address", part: str | None = None, parts: str | None = None, at: str | None = None) -> DataFrame:
    """``address, parts, answer, at``: an answer row as the stream keeps it. Without columns for its part and their number, an address has one."""
    number = F.coalesce(F.col(part) if part else F.lit(None), F.lit(1)).cast("int")
    total = F.coalesce(F.col(parts) if parts else F.lit(None), F.lit(1)).cast("int")
    results = F.to_json(F.struct(F.coalesce("results", F.array()).alias("results")))
    text = F.concat(F.lpad(number.cast("string"), 9, "0"), F.lit(" "), results)  # sorts by part
    when = F.coalesce(F.col(at).cast("timestamp") if at else F.lit(None).cast("timestamp"), F.timestamp_seconds(F.lit(1)))  # a time of 0 would be late from the start
    rows = answers.where(F.col(address).isNotNull()) if at is None else answers
    return rows.select(F.col(address).alias("address"), total.alias("parts"), text.alias("answer"), when.alias("at"))


def gathered(rows: DataFrame) -> DataFrame:
    """``address, parts, answers, complete`` of a whole table of ``as_parts``, as the stream gives them at its end."""
    # By address first, so that parts meet in one shuffle.
    each = rows.where("address is not null").repartition("address").groupBy("address")
    each = each.agg(F.max("parts").alias("parts"), F.array_sort(F.collect_set("answer")).alias("answers"), F.max("at").alias("at"))
    seen = F.size(F.array_distinct(F.transform("answers", lambda x: F.substring(x, 1, 9))))
    return each.select("address", "parts", "answers", (seen >= F.col("parts")).alias("complete"), "at")


def _flat(found: DataFrame, schema: str, address: str) -> DataFrame:
    """The candidates of gathered addresses, numbered through; equal ones once."""
    rows = found.repartition("address").select(F.col("address").alias(address), F.posexplode("answers").alias("_part", "_answer"))
    results = F.from_json(F.substring("_answer", 11, 1 << 30), f"results {schema}")["results"]
    flat = flatten_results(rows.select(address, "_part", results.alias("results")), [address, "_part"])
    same = [c for c in flat.columns if c not in ("_part", "candidate")]
    place = F.shiftleft(F.col("_part").cast("long"), 32) + F.col("candidate")  # one number, so that rows are hashed and not sorted
    flat = flat.groupBy(*same).agg(F.min(place).alias("_place"))
    order = Window.partitionBy(address).orderBy("_place")
    return flat.withColumn("candidate", F.row_number().over(order) - 1).drop("_place")


def settled(found: DataFrame, schema: str, address: str = "clean_address") -> dict[str, DataFrame]:
    """The tables ``TABLES`` of gathered addresses; ``schema`` is the type of ``results``. Candidates of all parts are numbered through, and
    equal ones count once. An address without any candidate is failed. Answers are read once, for all three tables."""
    resolved = written(process_results(_flat(found, schema, address), address), "resolved")
    parts = split_results(found.select(F.col("address").alias(address)), resolved, address)
    return dict(zip(TABLES, parts, strict=True))


def by_closed(rows: DataFrame, closed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The answers to addresses that are not closed, and those to closed ones. As many addresses may be closed as were ever asked, in files
    that seem small: they are never broadcast."""
    keys = closed.select(F.struct("address").alias("_closed")).distinct().hint("merge")
    return tuple(rows.join(keys, F.struct("address") == F.col("_closed"), how) for how in ("left_anti", "left_semi"))


def _add(spark: SparkSession, rows: DataFrame, at: Snapshot, schema: str, address: str, wait_seconds: int, delay: str, source: str, number: int) -> None:
    """Publishes what a batch of ``as_parts`` settles, and what it leaves waiting.

    An address leaves when all of its parts are in, or when ``wait_seconds`` after its last one have passed by the watermark, which is
    ``delay`` behind the latest ``at``. Answers up to the watermark of the batches before are late and dropped. Rows without an address only
    move the time on."""
    there = lambda name, kinds: at.read(spark, name) if name in at.folders else spark.createDataFrame([], kinds)
    was = at.read(spark, "clock").first()[0] if "clock" in at.folders else 0
    now = max(was, rows.agg(F.unix_micros(F.max("at") - F.expr(f"INTERVAL {delay}"))).first()[0] or 0)
    before, after = F.timestamp_micros(F.lit(was)), F.timestamp_micros(F.lit(now))
    until = (F.greatest(F.col("at"), before) + F.make_dt_interval(secs=F.lit(wait_seconds))).alias("until")
    closed = there("closed", CLOSED)
    fresh, again = rows.where("address is not null").where(F.col("at") > before), None
    if "closed" in at.folders:  # where nothing has closed yet, nothing is looked up
        fresh, again = by_closed(fresh, closed)
        again = again.select("address", until)
    found = written(gathered(fresh.unionByName(there("waiting", PART))).withColumn("over", until < after), "gathered")
    leaving = found.where("complete or over")
    stay = found.where("not complete and not over").select("address", "parts", F.explode("answers").alias("answer"), "at")
    left = found.where("complete and not over").select("address", until)
    left = left if again is None else left.unionByName(again)
    tables = settled(leaving, schema, address)
    replace = {"waiting": stay, "clock": spark.range(1).select(F.lit(now).cast("long").alias("micros"))}
    append = dict(tables)
    if now > was:  # what is over is forgotten
        replace["closed"] = closed.unionByName(left).groupBy("address").agg(F.max("until").alias("until")).where(~(F.col("until") < after))
    else:
        append["closed"] = left
    publish(spark, at.root, replace, append, source, number, since=at)
    for table in (found, tables["validated"]):
        discard(table)


def resolve_stream(
    answers: DataFrame,
    root: str,
    checkpoint: str,
    address: str = "clean_address",
    part: str | None = None,
    parts: str | None = None,
    at: str | None = None,
    wait_seconds: int = 3600,
    delay: str = "10 minutes",
) -> StreamingQuery:
    """Settles a stream of ``address, results`` and adds each batch to the tables ``TABLES`` published below ``root`` (see
    ``snapshots``). ``part`` and ``parts`` say which of how many parts an answer is, ``at`` when it came; without them an address has
    one part. Any cut of the stream into batches gives the tables of one batch, as long as no part comes later than ``delay``."""
    schema = answers.schema["results"].dataType.simpleString()

    spark = answers.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        before = snapshot(spark, root)
        if number <= before.batches.get(checkpoint, -1):
            return
        # Written once, and read by the user's session: the stream's own runs without adaptive execution.
        rows = written(batch, "answers")
        rows = spark.read.schema(rows.schema).parquet(*{f.rsplit("/", 1)[0] for f in rows.inputFiles()})
        _add(spark, rows, before, schema, address, wait_seconds, delay, checkpoint, number)
        discard(rows)

    found = as_parts(answers, address, part, parts, at)
    return found.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def settled_tables(spark, root: str) -> dict[str, DataFrame]:
    """The published tables."""
    at: Snapshot = snapshot(spark, root)
    return {name: at.read(spark, name) for name in TABLES if name in at.folders}
