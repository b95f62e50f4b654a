from deedweb.operators import geocode
from deedweb.sources.snapshots import snapshot
from deedweb.streaming.resolve import by_closed, resolve_stream, settled_tables


def test_open_addresses_wait_in_a_table(spark, tmp_path):
    """What a batch leaves open is a published table, which the next batch meets; what left is remembered."""
    schema = f"clean_address string, part int, parts int, results {geocode.RESULTS}"
    one = (("1", None, None, "MAIN", None, None, None, None, "X", None, "IL", "60601", "US"), "1 main", (1.0, 2.0), 0.9, "roof", "s")
    give = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        resolve_stream(stream, f"{tmp_path}/out", f"{tmp_path}/check", part="part", parts="parts").awaitTermination()
        at = snapshot(spark, f"{tmp_path}/out")
        kept = [sorted(r[0] for r in at.read(spark, t).select("address").collect()) for t in ("waiting", "closed")]
        return kept, {n: sorted(r[0] for r in t.select("clean_address").collect()) for n, t in settled_tables(spark, f"{tmp_path}/out").items()}

    give([("1 MAIN", 1, 2, [one]), ("2 MAIN", 1, 1, [])])
    assert run() == ([["1 MAIN"], ["2 MAIN"]], {"validated": [], "unvalidated": [], "failed": ["2 MAIN"]})
    give([("1 MAIN", 2, 2, [one]), ("2 MAIN", 1, 1, [one])])
    kept, tables = run()
    assert kept[0] == [] and set(kept[1]) == {"1 MAIN", "2 MAIN"}
    assert tables == {"validated": ["1 MAIN"], "unvalidated": [], "failed": ["2 MAIN"]}


def test_addresses_are_not_broadcast(spark):
    """Addresses that may be as many as were ever asked do not pass through the driver, however small their files seem."""
    many = spark.range(40).selectExpr("concat('MAIN ST ', id) AS clean_address", "'1' AS number", "id AS candidate", "'x' AS formatted_address")
    closed = many.selectExpr("clean_address AS address", "timestamp_seconds(9) AS until").where("candidate < 30")
    rows = many.selectExpr("clean_address AS address")
    _, _, failed = geocode.split_results(many.select("clean_address"), many.where("candidate < 30"))
    fresh, again = by_closed(rows, closed)
    for found, n in ((failed, 10), (fresh, 10), (again, 30)):
        assert found.count() == n
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
