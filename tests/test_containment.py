"""Counting baskets that hold a known set: subsets by equality, large baskets by the containment join."""

import random

from premia.operators import recommend


def test_counts_of_small_and_large_baskets(spark, monkeypatch):
    rng = random.Random(3)
    baskets = [rng.sample("abcdefghijklmnop", rng.randint(1, 13)) for _ in range(300)] + [[], None, ["a", "a", "b"], ["a", None]]
    known = {i: rng.sample("abcdefghijklmnop", rng.randint(1, 12)) for i in range(80)} | {80: ["b", "a", "a"], 81: ["z"], 82: [], 83: ["a", None], 84: ["a"]}
    joined = []
    plain = recommend.contained
    monkeypatch.setattr(recommend, "contained", lambda rows, *args, **kw: joined.append(rows.selectExpr("min(size(items))").first()[0]) or plain(rows, *args, **kw))
    frame = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    got = recommend.count_rows_with_all(frame, spark.createDataFrame(list(known.items()), "profile int, known array<string>"))
    want = {p: sum(set(k) <= set(b or ()) for b in baskets) for p, k in known.items() if k and None not in k}
    assert {r["profile"]: r["rows"] for r in got.collect()} == {p: n for p, n in want.items() if n}
    assert joined == [recommend.SUBSETS_OF + 1]  # baskets of up to that many items meet no set but by equality
