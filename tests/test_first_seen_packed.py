"""The first-seen state packs only what it does not hold already, and rows come back as they were."""

import re

from premia.streaming import arrivals


def _stored(spark, root, schema, batches, id_col="id", order="n"):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        arrived = arrivals.read_arrivals(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema, max_files=1)
        query = arrivals.start_exact_first_seen(arrived, f"{root}/out", f"{root}/state", id_col, order)
        query.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return sorted((tuple(r) for r in out.select(*arrived.columns, "batch").collect()), key=str), query


def test_id_and_order_are_neither_packed_nor_parsed(spark):
    rows = spark.createDataFrame([], "id bigint, ts timestamp, n double, v string")
    plan = arrivals.first_of_each(rows, "id", "ts")._jdf.queryExecution().analyzed().toString()
    assert re.findall(r"StructField\((\w+),", plan[plan.index("from_json("):].split("first", 1)[0]) == ["n", "v"]
    packed = plan[plan.index("to_json("):].split("AS row", 1)[0]
    assert "struct(n, n#" in packed and "id#" not in packed and "ts#" not in packed
    floats = arrivals.first_of_each(rows, "n", "n")._jdf.queryExecution().analyzed().toString()  # -0.0 equals 0.0
    assert "struct(id, id#" in floats[floats.index("to_json("):] and "n, n#" in floats[floats.index("to_json("):].split("AS row", 1)[0]


def test_ties_are_broken_by_the_text_of_the_row_as_before(spark, tmp_path):
    first = [
        (1, 1, 10, "a"), (1, 1, 9, "a"), (2, 1, None, "x"), (2, 1, 5, "x"), (3, None, 1, "b"), (3, 0, 0, "a"),
        (4, 1, 1, "a!"), (4, 1, 1, "a"), (None, 1, 1, "z"), (None, 1, 1, "y"), (5, 1, 1, "twice"), (5, 1, 1, "twice"),
    ]
    got, _ = _stored(spark, str(tmp_path), "id int, n int, v int, w string", [first, [(1, 0, 0, "again"), (6, 2, 2, "\n")]])
    assert got == sorted([
        (1, 1, 10, "a", 0), (2, 1, 5, "x", 0), (3, None, 1, "b", 0), (4, 1, 1, "a!", 0), (None, 1, 1, "y", 0), (5, 1, 1, "twice", 0), (6, 2, 2, "\n", 1),
    ], key=str)


def test_floating_zeros_and_missing_columns(spark, tmp_path):
    got, _ = _stored(spark, f"{tmp_path}/a", "id double, n double, v float", [[(0.0, 1.0, 2.5), (-0.0, 0.5, 1.5), (7.0, 0.0, 0.5), (7.0, -0.0, 0.75)]])
    assert str(got) == "[(-0.0, 0.5, 1.5, 0), (7.0, -0.0, 0.75, 0)]"
    got, _ = _stored(spark, f"{tmp_path}/b", "id int", [[(1,), (1,), (None,)], [(2,), (1,)]], order="id")
    assert got == [(1, 0), (2, 1), (None, 0)]
    got, _ = _stored(spark, f"{tmp_path}/c", "Id int, n int", [[(1, 3), (1, 2)]])
    assert got == [(1, 2, 0)]


def test_ids_are_not_counted_unless_asked_for(spark, tmp_path):
    counted = lambda q: q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert spark.conf.get(arrivals.STATE_ROWS, None) is None
    provider = spark.conf.get(arrivals.STATE_STORE)
    assert counted(_stored(spark, f"{tmp_path}/a", "id int, n int", [[(1, 1), (2, 1)]])[1]) != 2
    assert spark.conf.get(arrivals.STATE_ROWS, None) is None and spark.conf.get(arrivals.STATE_STORE) == provider
    spark.conf.set(arrivals.STATE_ROWS, "true")
    try:
        assert counted(_stored(spark, f"{tmp_path}/b", "id int, n int", [[(1, 1), (2, 1)]])[1]) == 2
        assert spark.conf.get(arrivals.STATE_ROWS) == "true"
    finally:
        spark.conf.unset(arrivals.STATE_ROWS)
