"""Pairwise suggestions are dealt over tasks by the rows they open, and come out as before on odd rows."""

import re

from premia.operators import recommend as rec


def _pairs(spark):
    rows = [(["a", "b"], 10.0, 1), (["a", "c"], 4.0, 3), (["b", "c"], 1.0, 1), (["b", "d"], None, 9), (["a", "b", "c"], 7.0, 2)]
    return spark.createDataFrame(rows, "items array<string>, adjusted_premium double, n_with bigint")


def test_tasks_follow_the_rows_that_profiles_open(spark, monkeypatch):
    profiles = spark.createDataFrame([(i, ["a"]) for i in range(30)], "profile bigint, known array<string>")
    for most, tasks in ((60, 1), (25, 3), (10, 6)):  # each profile meets two priced pairs: 60 rows
        monkeypatch.setattr(rec, "WAYS_PER_TASK", most)
        plan = rec.pairwise(profiles, _pairs(spark))._jdf.queryExecution().optimizedPlan().toString()
        assert re.findall(r"RepartitionByExpression \[profile#\w+\], (\d+)", plan) == [str(tasks)]
    assert rec.pairwise(profiles, _pairs(spark)).count() == 60


def test_odd_profiles_and_those_left_out(spark):
    rows = [(1, ["a", None, "a"]), (1, ["c"]), (2, None), (3, []), (4, ["x"]), (None, ["b"]), (5, ["a"]), (6, ["c"]), (6, ["a"])]
    profiles = spark.createDataFrame(rows, "profile bigint, known array<string>")
    without = spark.createDataFrame([(5,), (5,), (None,)], "profile bigint")
    got = {(r["profile"], r["suggested"]): (r["adjusted_premium"], r["n_with"], r["based_on"]) for r in rec.pairwise(profiles, _pairs(spark), without=without).collect()}
    assert got == {
        (1, "a"): (4.0, 3, "c"), (1, "b"): (1.0, 1, "c"),  # a known null is not told from any suggestion
        (6, "a"): (4.0, 3, "c"), (6, "b"): (5.5, 2, "a, c"), (6, "c"): (4.0, 3, "a"),
        (None, "a"): (10.0, 1, "b"), (None, "c"): (1.0, 1, "b"),
    }
    assert {r["profile"] for r in rec.pairwise(profiles, _pairs(spark)).collect()} == {1, 5, 6, None}
    assert rec.pairwise(profiles.where("profile = 4"), _pairs(spark)).count() == 0
