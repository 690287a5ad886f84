"""Premiums, mining, stability, recommendation: known answers and brute force."""

import itertools
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.operators import bias, premium, recommend, stability
from premia.operators.baskets import association_rules, collect_baskets, cooccurrence, mine, top_items
from premia.operators.ordered import average_ranks, dense_index, distinct_values, exact_quantiles, min_ranks, row_ranks, running_totals
from premia.operators.textstats import leakage, tfidf

FACTS = [("X", 100.0, ["a"]), ("X", 120.0, ["a"]), ("X", 80.0, []), ("Y", 50.0, ["a"]), ("Y", 40.0, []), ("Y", 60.0, [])]


def facts_of(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, s string, y double, items array<string>")


def single(spark, item="a"):
    return spark.createDataFrame([(item, [item], 1)], "itemset string, items array<string>, freq bigint")


def price(spark, rows, **kw):
    f = facts_of(spark, rows)
    return premium.stratified_premium(f, premium.contained(f, single(spark)), value="y", strata=["s"], **kw).first()


def test_adjusted_premium_known_answer(spark):
    r = price(spark, FACTS, min_n=1, min_strata=1)
    assert (r["adjusted_premium"], r["strata_used"], r["raw_premium"], r["n_with"]) == (20.0, 2, 30.0, 3)


def test_defaults_leave_thin_strata_unpriced(spark):
    r = price(spark, FACTS)
    assert r["adjusted_premium"] is None and r["strata_used"] == 0


def test_null_stratum_counts_in_n_with_only(spark):
    r = price(spark, [*FACTS, (None, 999.0, ["a"])], min_n=1, min_strata=1)
    assert (r["adjusted_premium"], r["n_with"]) == (20.0, 4)


def test_item_held_by_every_row_has_no_premium(spark):
    f = facts_of(spark, [("X", 1.0, ["a"]), ("Y", 2.0, ["a"])])
    assert premium.stratified_premium(f, premium.contained(f, single(spark)), value="y", strata=["s"]).count() == 0


def random_facts(n=400, seed=1, items="abcdef"):
    rng = random.Random(seed)
    return [
        (rng.choice(["X", "Y", "Z", None]), float(rng.randint(10, 99)), sorted(i for i in items if rng.random() < 0.4)) for _ in range(n)
    ]


def brute_premium(rows, itemset, min_n=5, min_strata=2):
    has = [set(itemset) <= set(r[2]) for r in rows]
    weighted = total = used = 0
    for s in {r[0] for r in rows} - {None}:
        yes = [r[1] for r, h in zip(rows, has) if h and r[0] == s]
        no = [r[1] for r, h in zip(rows, has) if not h and r[0] == s]
        if len(yes) >= min_n and len(no) >= min_n:
            weighted += (statistics.mean(yes) - statistics.mean(no)) * len(yes)
            total, used = total + len(yes), used + 1
    return sum(has), used, weighted / total if used >= min_strata else None


def all_itemsets(rows, min_count):
    out = {}
    for size in range(1, 7):
        for c in itertools.combinations("abcdef", size):
            freq = sum(set(c) <= set(r[2]) for r in rows)
            if freq >= min_count:
                out[c] = freq
    return out


def test_mining_and_value_table_against_brute_force(spark):
    rows = random_facts()
    f = facts_of(spark, rows).cache()
    mined = mine(f, min_support=0.05, min_confidence=0.3)
    want = all_itemsets(rows, 20)
    assert {tuple(r["items"]): r["freq"] for r in mined.itemsets.collect()} == want
    rules = {(tuple(r["antecedent"]), r["consequent"][0]): r for r in mined.rules.collect()}
    expected = {}
    for c, freq in want.items():
        for last in c if len(c) > 1 else ():
            rest = tuple(i for i in c if i != last)
            if freq / want[rest] >= 0.3:
                expected[rest, last] = (freq / want[rest], freq / want[rest] / (want[(last,)] / 400), freq / 400)
    assert rules.keys() == expected.keys()
    for k, v in expected.items():
        assert (rules[k]["confidence"], rules[k]["lift"], rules[k]["support"]) == pytest.approx(v)

    values = {tuple(r["items"]): r for r in premium.value_table(f, mined.itemsets, value="y", strata=["s"]).collect()}
    assert values.keys() == want.keys()
    for c, r in values.items():
        n, used, adjusted = brute_premium(rows, c)
        assert (r["n_with"], r["strata_used"]) == (n, used)
        assert r["adjusted_premium"] == (None if adjusted is None else pytest.approx(adjusted))
        if len(c) > 1:
            best = max((values[(i,)]["adjusted_premium"] for i in c if values[(i,)]["adjusted_premium"] is not None), default=None)
            assert r["best_individual_premium"] == best
            if best is not None and adjusted is not None:
                assert r["synergy"] == pytest.approx(adjusted - best)


def test_own_rules_equal_sparks(spark):
    from pyspark.ml.fpm import FPGrowth

    f = facts_of(spark, random_facts(seed=5)).cache()
    model = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.4).fit(f)
    theirs = {(tuple(sorted(r[0])), tuple(r[1])): (round(r[2], 9), round(r[3], 9), round(r[4], 9)) for r in model.associationRules.collect()}
    mined = mine(f, min_support=0.05, min_confidence=0.4)
    ours = {(tuple(r[0]), tuple(r[1])): (round(r[2], 9), round(r[3], 9), round(r[4], 9)) for r in mined.rules.collect()}
    assert ours == theirs


def test_containment_is_the_same_without_broadcast(spark):
    f = facts_of(spark, random_facts(seed=2)).cache()
    named = mine(f, min_support=0.05).itemsets.withColumn("itemset", F.array_join("items", "+"))
    small = {tuple(r) for r in premium.contained(f.select("id", "items"), named).collect()}
    large = {tuple(r) for r in premium.contained(f.select("id", "items"), named, max_broadcast_rows=0).collect()}
    assert small == large and len(small) > 500


def test_collect_baskets_keeps_emptied_ids_and_prunes(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "z")], "id int, item string")
    vocabulary = spark.createDataFrame([("a",), ("b",)], "item string")
    got = {r["id"]: r["items"] for r in collect_baskets(rows, "id", "item", vocabulary=vocabulary).collect()}
    assert got == {1: ["a", "b"], 2: []}


def test_top_items_skips_unusable_and_orders_ties(spark):
    d = spark.createDataFrame([(["b", "b", "a", "a", "unknown", "", "unknown", "unknown"],), ([None, "c"],)], "items array<string>")
    assert [r["item"] for r in top_items(d, 2).collect()] == ["a", "b"]


def test_cooccurrence_pruning_is_exact_with_repeats(spark):
    rng = random.Random(3)
    weights = [1 / (i + 1) for i in range(30)]
    rows = [(b, f"i{rng.choices(range(30), weights)[0]:02d}") for b in range(300) for _ in range(rng.randint(1, 7))]
    rows += [(300, "i00")] * 40 + [(300, "i29")] * 9
    want = {}
    for b in range(301):
        mentions = sorted(i for k, i in rows if k == b)
        for p in itertools.combinations(mentions, 2):
            want[p] = want.get(p, 0) + 1
    top = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    d = spark.createDataFrame(rows, "id int, item string")
    got = [((r["a"], r["b"]), r["pairs"]) for r in cooccurrence(d, "id", "item", 10, seed_items=6).collect()]
    assert got == top


@pytest.mark.parametrize("rows_per_range", [10**6, 7])
def test_running_totals_ranks_and_quantiles(spark, rows_per_range):
    rng = np.random.default_rng(0)
    rows = [(g, float(v)) for g in "pq" for v in rng.integers(0, 60, 200)] + [("p", None)]
    d = spark.createDataFrame(rows, "g string, v double").cache()
    totals = running_totals(
        distinct_values(d, ["g"], "v", {"n": F.lit(1)}), ["g"], "v", ["n"], descending=True, rows_per_range=rows_per_range).collect()
    for r in totals:
        assert r["cum_n"] == sum(1 for g, v in rows if g == r["g"] and v is not None and v >= r["v"]) and r["all_n"] == 200
    q = {r["g"]: r for r in exact_quantiles(d, ["g"], "v", {"lo": 0.025, "mid": 0.5, "hi": 0.9}, rows_per_range=rows_per_range).collect()}
    for g in "pq":
        values = [v for k, v in rows if k == g and v is not None]
        assert [q[g]["lo"], q[g]["mid"], q[g]["hi"]] == pytest.approx(list(np.percentile(values, [2.5, 50, 90])))
    for r in average_ranks(d, ["g"], "v", rows_per_range=rows_per_range).collect():
        values = [v for k, v in rows if k == r["g"] and v is not None]
        want = None if r["v"] is None else sum(v < r["v"] for v in values) + (values.count(r["v"]) + 1) / 2
        assert r["avg_rank"] == want
    for r in min_ranks(d, ["g"], "v", rows_per_range=rows_per_range).collect():
        assert r["rank"] == (None if r["v"] is None else 1 + sum(v > r["v"] for k, v in rows if k == r["g"] and v is not None))


def test_quantiles_known_answer_and_row_ranks(spark):
    d = spark.createDataFrame([(1.0, "d"), (2.0, "c"), (3.0, "b"), (10.0, "a"), (3.0, "z")], "v double, t string")
    r = exact_quantiles(d.where("t <> 'z'"), [], "v", {"a": 0.025, "b": 0.975}).first()
    assert (r["a"], r["b"]) == pytest.approx((1.075, 9.475))
    assert {x["t"]: x["rank"] for x in row_ranks(d, [], "v", "t").collect()} == {"a": 1, "b": 2, "z": 3, "c": 4, "d": 5}


def test_dense_index_is_gapless(spark):
    from premia.functions.hashing import hash_int

    d = spark.range(5000).withColumn("h", hash_int(F.col("id"), "md5"))
    got = sorted((r["idx"], r["h"], r["id"]) for r in dense_index(d, "h", "id", rows_per_range=400).collect())
    assert [g[0] for g in got] == list(range(5000)) and [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_sensitivity_base_reproduces_the_premium_and_coverage(spark):
    rows = random_facts(seed=7)
    f = facts_of(spark, rows).cache()
    named = mine(f, min_support=0.05).itemsets.withColumn("itemset", F.array_join("items", "+"))
    cells = premium.cell_table(f, premium.contained(f, named), key="itemset", value="y", strata=["s"])
    for r in stability.premium_by_threshold(cells).collect():
        for k in (3, 5, 10):
            n, used, adjusted = brute_premium(rows, tuple(r["itemset"].split("+")), k)
            assert r[f"cells_{k}"] == used and r[f"premium_{k}"] == (None if adjusted is None else pytest.approx(adjusted))
        assert 0 <= r["coverage_10"] <= r["coverage_5"] <= r["coverage_3"] <= 1


@pytest.mark.parametrize("method", ["multinomial", "poisson"])
def test_bootstrap_centres_on_the_estimate(spark, method):
    rng = random.Random(11)
    rows = [(rng.choice("XYZ"), 100 + 50 * h + rng.gauss(0, 5), ["a"] if h else []) for h in (rng.random() < 0.4 for _ in range(600))]
    f = facts_of(spark, rows).cache()
    replicated = stability.replicate_premiums(
        f, lambda d: premium.contained(d, single(spark)), id_col="id", value="y", strata=["s"], replicates=60, method=method)
    r = stability.bootstrap_intervals(replicated, replicates=60).first()
    _, _, point = brute_premium(rows, ("a",))
    assert r["excludes_zero"] and r["n_valid"] == 60
    assert r["ci_low"] < point < r["ci_high"] and abs(r["boot_mean"] - point) < 1 and 0.5 < r["ci_high"] - r["ci_low"] < 4


def test_multinomial_draws_n_rows_per_replicate(spark):
    got = stability.multinomial_draws(spark, 500, 4).groupBy("rep").agg(F.sum("w").alias("n"), F.max("idx").alias("m")).collect()
    assert all(r["n"] == 500 and r["m"] < 500 for r in got) and len(got) == 4


COMBOS = [(["A", "B"], 10.0, 100), (["A", "C"], 30.0, 50), (["B", "C"], 20.0, 150), (["A", "B", "D"], 40.0, 60)]


def advise(spark, **known):
    profiles = spark.createDataFrame(list(known.items()), "profile string, known array<string>")
    combos = spark.createDataFrame(COMBOS, "items array<string>, adjusted_premium double, n_with bigint")
    out = recommend.recommend(profiles, combos)
    return out.orderBy(F.desc("adjusted_premium")).collect(), {r["profile"]: (r["mode"], r["n"]) for r in recommend.modes(profiles, out).collect()}


def test_recommendation_modes_known_answers(spark):
    rows, modes = advise(spark, one=["A"], two=["B", "A"], pair=["A", "C"], none=["Z"])
    by = lambda p: [(r["suggested"], r["adjusted_premium"], r["n_with"], r["based_on"]) for r in rows if r["profile"] == p]
    assert by("one") == [("C", 30.0, 50, None), ("B", 10.0, 100, None)]
    assert by("two") == [("D", 40.0, 60, None)]
    assert by("pair") == [("B", 16.0, 250, "A, C")]
    assert by("none") == [] and modes == {"one": ("exact", 2), "two": ("exact", 1), "pair": ("pairwise", 1), "none": ("none", 0)}


def test_rules_and_unpaired_for_profiles(spark):
    rules = spark.createDataFrame([(["A"], ["B"], 1.0), (["A"], ["C"], 2.0), (["B"], ["A"], 1.0)], "antecedent array<string>, consequent array<string>, lift double")
    profiles = spark.createDataFrame([("p", ["A", "B"])], "profile string, known array<string>")
    assert [(r["antecedent"], r["consequent"]) for r in recommend.rules_for(profiles, rules).collect()] == [(["A"], ["C"])]
    combos = spark.createDataFrame(COMBOS[:1], "items array<string>, adjusted_premium double, n_with bigint")
    lost = recommend.unpaired(spark.createDataFrame([("p", ["A", "Q"])], "profile string, known array<string>"), combos)
    assert [r["item"] for r in lost.collect()] == ["Q"]


def test_recommendation_invariants_on_random_profiles(spark):
    f = facts_of(spark, random_facts(seed=9)).cache()
    mined = mine(f, min_support=0.1)
    values = premium.value_table(f, mined.itemsets, value="y", strata=["s"]).cache()
    rng = random.Random(42)
    known = {f"p{i}": rng.sample("abcdefgh", rng.randint(1, 5)) for i in range(120)}
    profiles = spark.createDataFrame(list(known.items()), "profile string, known array<string>")
    out = recommend.recommend(profiles, values.where("size >= 2"))
    modes = {r["profile"]: r["mode"] for r in recommend.modes(profiles, out).collect()}
    suggested = {}
    for r in out.collect():
        assert r["suggested"] not in known[r["profile"]] and r["adjusted_premium"] is not None
        suggested.setdefault(r["profile"], set()).add(r["mode"])
    assert set(modes) == set(known) and set(modes.values()) <= {"exact", "pairwise", "none"}
    assert {p for p, m in modes.items() if m != "none"} == set(suggested) and all(v == {modes[p]} for p, v in suggested.items())


def test_rows_with_all_items(spark):
    f = facts_of(spark, random_facts(seed=4)).select("id", "items").cache()
    profiles = spark.createDataFrame([("p", ["b", "a"]), ("q", ["c"])], "profile string, known array<string>")
    got = {(r["profile"], r["id"]) for r in recommend.rows_with_all(f, profiles).collect()}
    rows = {r["id"]: set(r["items"]) for r in f.collect()}
    assert got == {(p, i) for p, k in (("p", {"a", "b"}), ("q", {"c"})) for i, s in rows.items() if k <= s}


def test_chi_square_known_answer(spark):
    shares = spark.createDataFrame([("a", 25.0, 15, 10), ("b", 25.0, 15, 20), ("c", 50.0, 30, 30), ("new", 0.0, 0, 0)], "c string, full_pct double, n_full bigint, n_subset bigint")
    r = bias.chi_square(shares).first()
    assert (r["statistic"], r["dof"], r["p_value"], r["differs"]) == (pytest.approx(10 / 3), 2, pytest.approx(0.18888, abs=1e-5), False)
    for x, df, p in ((3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (100.0, 5, 5.285e-20), (0.0, 3, 1.0)):
        assert bias.chi2_sf(x, df) == pytest.approx(p, rel=1e-3)


def test_category_shares_align_missing_categories(spark):
    full = spark.createDataFrame([("a",)] * 3 + [("b",), (None,)], "c string")
    subset = spark.createDataFrame([("a",), ("z",)], "c string")
    got = {r["c"]: (r["n_full"], r["n_subset"], r["full_pct"], r["subset_pct"]) for r in bias.category_shares(full, subset, "c").collect()}
    assert got == {"a": (3, 1, 75.0, 50.0), "b": (1, 0, 25.0, 0.0), "z": (0, 1, 0.0, 50.0)}


def test_relational_tfidf_equals_spark_ml(spark):
    from pyspark.ml.feature import IDF, CountVectorizer

    rng = random.Random(0)
    docs = [(i, [rng.choice("abcdefghij") for _ in range(rng.randint(0, 12))]) for i in range(60)]
    d = spark.createDataFrame(docs, "id int, t array<string>").cache()
    cv = CountVectorizer(inputCol="t", outputCol="c", vocabSize=10, minDF=5).fit(d)
    out = IDF(inputCol="c", outputCol="w").fit(cv.transform(d)).transform(cv.transform(d))
    want = {(r["id"], cv.vocabulary[j]): round(float(v), 9) for r in out.collect() for j, v in zip(r["w"].indices, r["w"].values)}
    got = {(r["id"], r["term"]): round(r["tfidf"], 9) for r in tfidf(d, "id", "t", size=10, min_df=5).collect()}
    assert got == want


def test_leakage_shares(spark):
    d = spark.createDataFrame([(["Python", "SQL"], "we use python"), (["Go"], "GO home"), ([], "x"), (["a"], None)], "i array<string>, t string")
    r = leakage(d, "i", "t").first()
    assert (r["mean_share"], r["all_found"], r["rows"]) == (pytest.approx(0.5), pytest.approx(1 / 3), 3)


def test_itemsets_with_equal_print_stay_apart(spark):
    from premia.functions.items import itemset_key, printed

    rows = [(i, 10 + i % 2 * 20, "s" if i % 4 < 2 else "t", ["a + b"] if i % 2 else ["a", "b"]) for i in range(80)]
    f = spark.createDataFrame(rows, "id int, y bigint, s string, items array<string>")
    named = mine(f, min_support=0.05).itemsets.withColumn("itemset", itemset_key(F.col("items")))
    cells = premium.cell_table(f, premium.contained(f, named), key="itemset", value="y", strata=["s"])
    rolled = cells.groupBy("itemset").agg(F.sum("n_with").alias("n")).select(printed("itemset").alias("itemset"), "n")
    assert sorted((r["itemset"], r["n"]) for r in rolled.collect() if "+" in r["itemset"]) == [("a + b", 40), ("a + b", 40)]
