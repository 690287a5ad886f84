"""First-seen rows by state that Spark keeps itself: no Python call per id."""

from premia.streaming import arrivals


def test_state_is_an_aggregate(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda *r: spark.createDataFrame(list(r), "id int, n int, v string").coalesce(1).write.mode("append").parquet(f"{root}/in")
    rows((1, 5, "late"), (1, None, "first"), (2, 1, "b"), (2, 1, "a"), (None, 1, "none"))
    schema = spark.read.parquet(f"{root}/in").schema
    stream = lambda: arrivals.read_arrivals(spark, f"{root}/in", schema, max_files=1)
    assert "InPandas" not in arrivals.first_of_each(stream(), "id", "n")._jdf.queryExecution().analyzed().toString()
    arrivals.start_exact_first_seen(stream(), f"{root}/out", f"{root}/state", "id", "n").awaitTermination()
    rows((1, 0, "again"), (3, 1, "c"), (None, 0, "again"))
    arrivals.start_exact_first_seen(stream(), f"{root}/out", f"{root}/state", "id", "n").awaitTermination()
    got = {(r["id"], r["v"], r["batch"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {(1, "first", 0), (2, "a", 0), (None, "none", 0), (3, "c", 1)}
