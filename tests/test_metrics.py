"""Metrics of scored frames and attribution tables."""

import random

import pytest
from pyspark.sql import functions as F

from premia.operators import attribute, metrics

TINY = [("i", "m", 1, 0.9), ("i", "m", 0, 0.8), ("i", "m", 1, 0.7), ("i", "m", 0, 0.2)]
SCHEMA = "item string, model string, y int, score double"


def test_known_threshold_precision_and_auc(spark):
    r = metrics.ranking_metrics(spark.createDataFrame(TINY, SCHEMA), min_positives=1).first()
    assert (r["threshold"], r["f1"], r["roc_auc"]) == (0.7, pytest.approx(0.8), 0.75)
    assert r["average_precision"] == pytest.approx(5 / 6)
    assert metrics.ranking_metrics(spark.createDataFrame(TINY, SCHEMA)).first()["threshold"] == 0.5


def test_sparks_evaluator_uses_another_definition(spark):
    from premia.operators.classify import spark_auc

    assert spark_auc(spark.createDataFrame(TINY, SCHEMA)) == pytest.approx(0.79167, abs=1e-4)


def test_one_class_groups_are_defined(spark):
    d = spark.createDataFrame([("n", "m", 0, 0.1), ("n", "m", 0, 0.2), ("p", "m", 1, 0.1)], SCHEMA)
    got = {r["item"]: r for r in metrics.ranking_metrics(d).collect()}
    assert got["n"]["average_precision"] == 0.0 and got["n"]["roc_auc"] is None and got["p"]["roc_auc"] is None


@pytest.mark.parametrize("rows_per_range", [10**6, 11])
def test_ranking_metrics_against_brute_force(spark, rows_per_range):
    rng = random.Random(1)
    rows = [(i, "m", int(rng.random() < 0.3), round(rng.random(), 2)) for i in "ab" for _ in range(300)]
    got = {r["item"]: r for r in metrics.ranking_metrics(spark.createDataFrame(rows, SCHEMA), rows_per_range=rows_per_range).collect()}
    for item in "ab":
        mine = [(s, y) for i, _, y, s in rows if i == item]
        pos = sum(y for _, y in mine)
        neg = len(mine) - pos
        auc = sum((p > q) + 0.5 * (p == q) for p, y in mine if y for q, z in mine if not z) / (pos * neg)
        ap, last, best = 0.0, 0, (-1.0, 0.0)
        for t in sorted({s for s, _ in mine}, reverse=True):
            tp, pp = sum(y for s, y in mine if s >= t), sum(s >= t for s, _ in mine)
            ap += (tp - last) / pos * tp / pp
            last = tp
            best = max(best, (2 * tp / (pp + pos), -t))
        r = got[item]
        assert (r["roc_auc"], r["average_precision"], r["f1"], r["threshold"]) == pytest.approx((auc, ap, best[0], -best[1]))


def test_confusion_guards_empty_denominators(spark):
    d = spark.createDataFrame([("i", "m", 0, 0.1), ("i", "m", 1, 0.2)], SCHEMA)
    r = metrics.confusion_metrics(metrics.with_threshold(d, spark.createDataFrame([("x", "m", 0.3)], "item string, model string, threshold double"))).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (0, 0, 1, 1) and (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_class_weights_and_representative_items(spark):
    d = spark.createDataFrame([("a", y) for y in (1, 0, 0, 0)] + [("b", 1)], "item string, y int")
    got = {(r["item"], r["y"]): r["weight"] for r in metrics.class_weights(d).collect()}
    assert got == {("a", 1): 2.0, ("a", 0): pytest.approx(2 / 3), ("b", 1): 1.0}
    assert [r["item"] for r in metrics.evaluable(d).collect()] == ["a"]
    assert metrics.with_class_weight(d).agg(F.sum("class_weight")).first()[0] == pytest.approx(5.0)
    rates = spark.createDataFrame([("x", 0.1), ("y", 0.45), ("z", 0.9)], "item string, positive_rate double")
    assert [r["item"] for r in metrics.representative(rates, 1).collect()] == ["y"]


def test_best_model_ties_go_to_the_first_name(spark):
    d = spark.createDataFrame([("i", "b", 0.5), ("i", "a", 0.5), ("i", "c", 0.1), ("j", "c", None), ("j", "b", 0.2)], "item string, model string, m double")
    assert {r["item"]: r["model"] for r in metrics.best_per_item(d, "m").collect()} == {"i": "a", "j": "b"}


def test_spearman_uses_average_ranks(spark):
    means = spark.createDataFrame(
        [("g", i, a, p, 30) for i, a, p in (("w", 0.1, 0.2), ("x", 0.1, 0.1), ("y", 0.3, 0.4), ("z", 0.4, 0.3))],
        "grp string, item string, actual double, predicted double, n int")
    overall = spark.createDataFrame([("w", 0.4), ("x", 0.3), ("y", 0.2), ("z", 0.1)], "item string, actual double")
    r = metrics.spearman_by_group(means, overall, group="grp").first()
    assert r["model_corr"] == pytest.approx(0.737865, abs=1e-6) and r["baseline_corr"] == pytest.approx(-0.948683, abs=1e-6)


def test_regression_metrics(spark):
    d = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, prediction double")
    r = metrics.regression_metrics(d).first()
    assert (r["r2"], r["rmse"], r["mae"]) == pytest.approx((0.5, (1 / 3) ** 0.5, 1 / 3))


def test_attribution_needs_rows_in_every_segment(spark):
    rows = [("a", s, v) for s, v in (("x", 1.0), ("y", 3.0)) for _ in range(10)] + [("b", "x", 1.0)] * 30
    d = spark.createDataFrame(rows, "item string, segment string, contribution double")
    got = attribute.by_segment(d, ["x", "y"]).collect()
    assert [(r["item"], r["mean_0"], r["n_1"], r["spread"]) for r in got] == [("a", 1.0, 10, 2.0)]
