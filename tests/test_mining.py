"""Itemsets level by level over distinct baskets, against brute force and FP-growth."""

import random
from itertools import combinations

import pytest

from premia.operators import baskets


@pytest.mark.parametrize("by_levels", [True, False])
def test_itemsets_by_brute_force(spark, monkeypatch, by_levels):
    rng = random.Random(9)
    rows = [sorted({rng.choice("aaabbbccdefgh") for _ in range(rng.randint(1, 7))}) for _ in range(400)] + [[]]
    plain, used = baskets.FPGrowth, []
    monkeypatch.setattr(baskets, "FPGrowth", lambda **kw: used.append(1) or plain(**kw))
    if not by_levels:
        monkeypatch.setattr(baskets, "SUBSETS_PER_ITEM", 1)
    found = baskets.mine(spark.createDataFrame([(r,) for r in rows] + [(None,)], "items array<string>"), min_support=0.02).itemsets
    want = {c: n for k in range(1, 8) for c in combinations("abcdefgh", k) if (n := sum(set(c) <= set(r) for r in rows)) >= 0.02 * len(rows)}
    assert {tuple(r["items"]): r["freq"] for r in found.collect()} == want and max(map(len, want)) >= 4
    assert all(r["size"] == len(r["items"]) for r in found.collect())
    assert used == ([] if by_levels else [1])
