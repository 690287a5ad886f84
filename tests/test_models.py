"""Features, classifiers, ridge, tree attribution."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from premia.functions.hashing import split_label
from premia.operators import attribute, classify, prep, regress
from premia.operators import features as feat
from premia.plans import models
from premia.session import materialize


@pytest.fixture(scope="module")
def posts(spark):
    """Postings whose item 'py' follows from the title, with an employer and a city."""
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "Senior Python developer").otherwise("Менеджер по продажам").alias("name"),
        F.concat(F.lit("<p>python команда проект "), F.col("id") % 7, F.lit("</p>")).alias("description"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit("py"))).otherwise(F.array().cast("array<string>")).alias("items"),
        F.when(F.col("id") % 2 == 0, "Москва").otherwise("Казань").alias("city"),
        F.concat(F.lit("e"), F.col("id") % 9).alias("employer"),
        F.when(F.col("id") % 3 == 0, "Senior").otherwise("Unknown").alias("seniority"),
        F.lit("noExperience").alias("experience_bucket"),
        F.size(F.array()).alias("items_count"),
        *[F.lit(0).alias(f"work_format_{w.lower()}") for w in prep.WORK_FORMATS],
    )
    return materialize(rows.withColumn("split", split_label(F.col("id"))))


@pytest.fixture(scope="module")
def space(posts, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("space") / "pipeline")
    spec = feat.posting_spec(["e0", "e1"], ["python"], prep.WORK_FORMATS)
    for t in spec.texts:
        t.vector_size = 4
    model = feat.fit_once(spark, path, feat.feature_pipeline(spec), posts)
    return path, model


def test_feature_space_is_saved_once_and_reused(spark, posts, space):
    path, model = space
    again = feat.fit_once(spark, path, feat.feature_pipeline(feat.posting_spec(["other"], [], prep.WORK_FORMATS)), posts.limit(1))
    a = model.transform(posts).select("id", vector_to_array("scaled_features").alias("x")).orderBy("id").first()
    b = again.transform(posts).select("id", vector_to_array("scaled_features").alias("x")).orderBy("id").first()
    assert a == b


def test_rare_employers_share_one_slot_and_exclusions_leave_the_vocabulary(posts, space):
    _, model = space
    out = model.transform(posts)
    got = dict(out.select("employer", "employer_index").distinct().collect())
    assert got["e0"] == 0.0 and got["e1"] == 1.0 and {got[f"e{i}"] for i in range(2, 9)} == {2.0}
    tokens = {t for r in out.select("description_tokens").collect() for t in r[0]}
    assert "команда" in tokens and "python" not in tokens and "p" not in tokens
    scaled = np.array([r[0] for r in out.select(vector_to_array("scaled_features")).collect()])
    assert np.allclose(scaled.mean(axis=0), 0, atol=1e-9) and set(np.round(scaled.std(axis=0, ddof=1), 6)) <= {0.0, 1.0}


def test_title_only_rows_go_through_the_same_space(spark, space):
    _, model = space
    titles = spark.createDataFrame([("q", "Senior Python developer"), ("r", "Менеджер")], "id string, name string")
    rows = prep.basic_features(feat.title_rows(titles))
    out = feat.title_features(model.transform(rows)).select("id", vector_to_array("title_features").alias("x")).collect()
    assert len(out) == 2 and len(out[0]["x"]) == len(out[1]["x"]) and any(out[0]["x"])


def test_leaky_baseline_contains_the_items(posts):
    model = feat.leaky_pipeline().fit(posts)
    assert "py" in [s for s in model.stages if type(s).__name__ == "CountVectorizerModel"][0].vocabulary


def test_train_evaluate_resume_files(spark, posts, space, tmp_path):
    rows = materialize(space[1].transform(posts).select("id", "items", "split", "scaled_features"))
    seen = []
    params = {"random_forest": {"numTrees": 5, "maxDepth": 3}, "gbt": {"maxIter": 3, "maxDepth": 2}, "logistic_regression": {"maxIter": 10}}
    scored = classify.train(rows, ["py", "absent/item"], params=params, models_dir=str(tmp_path), on_scored=lambda i, m, s: seen.append((i, m)))
    assert seen == [("py", m) for m in classify.DEFAULTS]  # the one-class item is skipped
    report = {r["model"]: r for r in classify.evaluate(scored).collect()}
    assert set(report) == set(classify.DEFAULTS)
    for r in report.values():
        assert r["roc_auc"] == 1.0 and r["f1"] == 1.0 and 0 <= r["threshold"] <= 1 and r["majority_baseline_acc"] >= 0.5
    from pyspark.ml.classification import GBTClassificationModel

    loaded = GBTClassificationModel.load(classify.model_path(str(tmp_path), "gbt", "py"))
    again = classify.scores(loaded, rows.where("split = 'test'"), "py", "gbt")
    old = {r["id"]: r["score"] for r in scored.where("model = 'gbt' and split = 'test'").collect()}
    assert {r["id"]: r["score"] for r in again.collect()} == old
    assert classify.model_path("r", "gbt", "c/c++: x") == "r/gbt/c_c++_ x"


def test_tuning_and_parameter_averaging(posts, space):
    rows = materialize(space[1].transform(posts).select("id", "items", "split", "scaled_features"))
    weights = classify.weights_of(rows, ["py"])["py"]
    weighted = classify.labelled(rows, "py", weights)
    found = classify.grid_search(weighted, "logistic_regression", values={"regParam": [0.01, 0.1], "maxIter": [3, 5]}, draws=2, folds=2)
    assert set(found) == {"regParam", "maxIter"} and found["maxIter"] in (3, 5)
    averaged = classify.average_params([{"maxDepth": 5, "regParam": 0.001}, {"maxDepth": 10, "regParam": 0.01}, {"maxDepth": 10, "regParam": 0.01}])
    assert averaged == {"maxDepth": 8, "regParam": pytest.approx(0.007)}


def test_refit_on_united_batches(posts, space):
    old, new = posts.where("split = 'train'"), posts.where("split <> 'train'").drop("split")
    models = classify.refit(
        space[1], [old, new, new], ["py"], ["logistic_regression"], dedupe=lambda d: prep.dedupe(d, ["name", "employer", "description"]))
    scored = classify.scores(models["py", "logistic_regression"], space[1].transform(posts), "py", "lr").collect()
    assert all((r["score"] > 0.5) == bool(r["y"]) for r in scored)


@pytest.fixture(scope="module")
def priced(spark):
    """Two cities, an experience level, two items, a noisy linear outcome."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        city, exp, items = rng.choice(["M", "S"]), rng.choice(["lo", "hi"]), [k for k in "abc" if rng.random() < 0.4]
        y = 100 + 30 * (city == "M") + 20 * (exp == "hi") + 15 * ("a" in items) * (1 + (city == "S")) - 5 * ("b" in items) + rng.normal(0, 3)
        rows.append((str(i), city, exp, items, bool(i % 2), float(y)))
    return spark.createDataFrame(rows, "id string, city string, exp string, items array<string>, flag boolean, y double")


CATS = {"exp": ["lo", "hi"]}


def matrices(df, segment=None):
    rows = df.where(F.col("city") == segment).collect() if segment else df.collect()
    x = np.array([r["x"] for r in rows])
    return x, np.array([r["y"] for r in rows])


def brute_ridge(x, y, alpha):
    mean = x.mean(axis=0)
    w = np.linalg.solve((x - mean).T @ (x - mean) + alpha * np.eye(x.shape[1]), (x - mean).T @ (y - y.mean()))
    return w, y.mean() - mean @ w


def brute_loo(x, y, alpha):
    out = 0.0
    for i in range(len(y)):
        keep = np.arange(len(y)) != i
        w, b = brute_ridge(x[keep], y[keep], alpha)
        out += (y[i] - x[i] @ w - b) ** 2
    return out


def test_ridge_equals_closed_form_and_spark(priced):
    names = regress.feature_names({"city": ["M", "S"], **CATS}, ["flag"], ["a", "b", "c"])
    rows = regress.design(priced, {"city": ["M", "S"], **CATS}, ["flag"], ["a", "b", "c"]).cache()
    x, y = matrices(rows.withColumn("x", vector_to_array("features")))
    assert x.shape[1] == len(names) == 8 and set(np.unique(x)) == {0.0, 1.0}
    fitted = regress.ridge(rows, names).first()
    errors = [brute_loo(x, y, a) for a in regress.ALPHAS]
    alpha = regress.ALPHAS[int(np.argmin(errors))]
    w, b = brute_ridge(x, y, alpha)
    assert fitted["alpha"] == pytest.approx(alpha) and fitted["n_train"] == 240
    assert np.allclose(fitted["coefficients"], w, atol=1e-6) and fitted["intercept"] == pytest.approx(b, abs=1e-5)
    spark_fit = LinearRegression(
        featuresCol="features", labelCol="y", elasticNetParam=0.0, standardization=False, solver="normal", regParam=alpha * y.std() / len(y),
    ).fit(rows)
    assert np.allclose(spark_fit.coefficients.toArray(), w, atol=1e-6) and spark_fit.intercept == pytest.approx(b, abs=1e-5)
    predicted = {r["id"]: r["prediction"] for r in regress.predict(rows, regress.ridge(rows, names)).collect()}
    order = [r["id"] for r in rows.collect()]
    assert np.allclose([predicted[i] for i in order], x @ w + b, atol=1e-5)


def test_ridge_per_segment_in_one_pass(priced):
    names = regress.feature_names(CATS, [], ["a", "b", "c"])
    rows = regress.design(priced, CATS, [], ["a", "b", "c"]).withColumn("x", vector_to_array("features")).cache()
    fitted = {r["segment"]: r for r in regress.ridge_by_segment(rows, names, segment="city", segments=["M", "S", "empty"]).collect()}
    assert set(fitted) == {"M", "S"}
    for s, r in fitted.items():
        x, y = matrices(rows, s)
        w, b = brute_ridge(x, y, r["alpha"])
        assert np.allclose(r["coefficients"], w, atol=1e-6) and r["intercept"] == pytest.approx(b, abs=1e-5) and r["n_train"] == len(y)
    a = {s: dict(zip(names, r["coefficients"]))["item=a"] for s, r in fitted.items()}
    assert a["S"] > a["M"] + 5
    long = regress.coefficients_long(regress.ridge_by_segment(rows, names, segment="city", segments=["M", "S"]), names)
    assert long.count() == 2 * len(names)


def test_enough_rows(spark):
    d = spark.range(300).select(F.when(F.col("id") < 250, "big").otherwise("small").alias("s"), F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))
    assert [r["s"] for r in regress.enough_rows(d, "s").collect()] == ["big"]


def test_linear_contributions_are_additive(priced):
    names = regress.feature_names(CATS, [], ["a", "b", "c"])
    rows = regress.design(priced, CATS, [], ["a", "b", "c"]).withColumn("x", vector_to_array("features")).cache()
    x, y = matrices(rows)
    fitted = regress.ridge(rows, names).cache()
    out = regress.predict(attribute.linear_contributions(rows, fitted, x.mean(axis=0)), fitted).collect()
    for r in out:
        assert sum(r["contributions"]) + y.mean() == pytest.approx(r["prediction"], abs=1e-6)


def brute_shapley(nodes, x, weight, width):
    """Shapley values of one tree under path-dependent expectations, by enumerating all feature subsets."""
    def expect(node_id, known):
        n = nodes[node_id]
        if n["leftChild"] < 0:
            return weight * n["prediction"]
        f, values = n["split"]["featureIndex"], list(n["split"]["leftCategoriesOrThreshold"])
        if f in known:
            left = x[f] <= values[0] if n["split"]["numCategories"] < 0 else x[f] in values
            return expect(n["leftChild"] if left else n["rightChild"], known)
        share = nodes[n["leftChild"]]["rawCount"] / n["rawCount"]
        return share * expect(n["leftChild"], known) + (1 - share) * expect(n["rightChild"], known)

    phi = np.zeros(width)
    for f in range(width):
        others = [j for j in range(width) if j != f]
        for m in range(width):
            for s in itertools.combinations(others, m):
                w = math.factorial(m) * math.factorial(width - m - 1) / math.factorial(width)
                phi[f] += w * (expect(0, {*s, f}) - expect(0, set(s)))
    return phi


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_tree_contributions_are_additive_and_equal_brute_force(spark, priced, tmp_path, kind):
    rng = np.random.default_rng(1)
    dense = spark.createDataFrame([(i, *map(float, rng.normal(size=3)), float(rng.normal())) for i in range(150)], "id int, a double, b double, c double, e double")
    rows = dense.withColumn("y", F.col("a") * 3 + F.when(F.col("b") > 0, F.col("c")).otherwise(0.0) + F.col("e") * 0.1)
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).cache()
    est = GBTRegressor(labelCol="y", maxIter=3, maxDepth=3, stepSize=0.5) if kind == "gbt" else RandomForestRegressor(labelCol="y", numTrees=3, maxDepth=3, seed=1)
    model = est.fit(rows)
    explained, base = attribute.tree_contributions(model, rows)
    phi = {r["id"]: r["contributions"] for r in explained.collect()}
    for r in model.transform(rows).collect():
        assert sum(phi[r["id"]]) + base == pytest.approx(r["prediction"], abs=1e-9)
    model.write().save(str(tmp_path / "m"))
    trees = {}
    for r in spark.read.parquet(str(tmp_path / "m" / "data")).collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    scale = 1.0 if kind == "gbt" else 1.0 / len(trees)
    for r in rows.limit(5).collect():
        want = sum(brute_shapley(nodes, r["features"].toArray(), model.treeWeights[t] * scale, 3) for t, nodes in trees.items())
        assert np.allclose(phi[r["id"]], want, atol=1e-9)


def test_item_contributions_of_held_items(spark):
    explained = spark.createDataFrame([("1", [1.0, 2.0]), ("2", [3.0, 4.0])], "id string, contributions array<double>")
    held = spark.createDataFrame([("1", "b"), ("2", "a"), ("2", "b"), ("2", "zz")], "id string, item string")
    positions = spark.createDataFrame([("a", 0), ("b", 1)], "item string, position int")
    assert {tuple(r) for r in attribute.item_contributions(explained, held, positions).collect()} == {("1", "b", 2.0), ("2", "a", 3.0), ("2", "b", 4.0)}


def test_boosting_keeps_the_best_prefix(priced):
    rows = regress.design(priced, {"city": ["M", "S"], **CATS}, [], ["a", "b", "c"]).withColumn("split", split_label(F.col("id")))
    val = rows.where("split = 'val'")
    slow = regress.boosted(rows, iterations=40, depth=2, step=0.03)
    errors = slow.evaluateEachIteration(val, "squared")
    assert slow.getNumTrees > 22 and min(errors) == errors[-1]  # a gain of a few per cent a round is no reason to stop
    eager = regress.boosted(rows, iterations=12, depth=6, step=1.0)
    errors = eager.evaluateEachIteration(val, "squared")
    assert 1 <= eager.getNumTrees <= 12 and min(errors) == errors[-1]
    assert regress.forest(rows, trees=4, depth=3).getNumTrees == 4


def test_boosting_stops_after_its_patience_and_is_as_good_as_one_fit(priced, tmp_path):
    from pyspark.ml.regression import GBTRegressionModel, GBTRegressor

    rows = regress.design(priced, {"city": ["M", "S"], **CATS}, [], ["a", "b", "c"]).withColumn("split", split_label(F.col("id"))).cache()
    short = regress.boosted(rows, iterations=60, depth=5, step=1.0, patience=3)
    val = rows.where("split = 'val'")
    errors = GBTRegressor(featuresCol="features", labelCol="y", maxIter=12, maxDepth=5, stepSize=1.0, seed=42).fit(rows.where("split = 'train'")).evaluateEachIteration(val, "squared")
    own = short.evaluateEachIteration(val, "squared")
    assert len(own) < 12 and own[0] == pytest.approx(errors[0]) and own[-1] == min(own) <= 1.02 * min(errors)
    short.save(f"{tmp_path}/trees")
    again = GBTRegressionModel.load(f"{tmp_path}/trees").transform(val).select("id", "prediction")
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in short.transform(val).select("id", "prediction").collect()}


def test_tree_attribution_boosts_at_the_settings_of_the_jobs(spark, tmp_path, monkeypatch):
    from premia.plans import models

    rng = np.random.default_rng(5)
    orders = [(k, str(rng.choice(models.PRIORITIES)), str(rng.choice(models.STATUSES)), float(rng.integers(100, 900))) for k in range(300)]
    lines = [(k, int(p)) for k in range(300) for p in rng.choice(4, 2, replace=False)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p, f"Brand#{p}") for p in range(4)], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    plain, asked = regress.boosted, []
    monkeypatch.setattr(models.regress, "boosted", lambda rows, **settings: asked.append(settings) or plain(rows, **settings | {"iterations": 2}))
    rows = models.tree_attribution(spark, str(tmp_path)).collect()
    assert asked == [{}] and {r["item"] for r in rows} == {f"Brand#{p}" for p in range(4)}


def test_pair_without_val_rows_gets_the_default_threshold(spark):
    rows = [("val", "a", "m", 1, 0.9), ("val", "a", "m", 0, 0.2), ("test", "a", "m", 1, 0.95), ("test", "a", "m", 0, 0.1)]
    rows += [("test", "b", "m", 1, 0.6), ("test", "b", "m", 0, 0.4)]
    out = classify.evaluate(spark.createDataFrame(rows, "split string, item string, model string, y int, score double"))
    got = {r["item"]: r for r in out.collect()}
    assert set(got) == {"a", "b"} and got["b"]["threshold"] == 0.5 and got["b"]["f1"] == 1.0


def test_held_contributions_join_nothing_by_id(spark):
    explained = spark.createDataFrame([("1", ["b"], [1.0, 2.0]), ("2", ["a", "b", "zz"], [3.0, 4.0]), ("3", [], [5.0, 6.0])], "id string, items array<string>, contributions array<double>")
    positions = spark.createDataFrame([("a", 0), ("b", 1)], "item string, position int")
    own = attribute.held_contributions(explained, positions)
    assert {tuple(r) for r in own.collect()} == {("1", "b", 2.0), ("2", "a", 3.0), ("2", "b", 4.0)}
    assert "hashpartitioning" not in own._jdf.queryExecution().executedPlan().toString()


def test_document_features_hold_only_what_is_not_zero(spark):
    """Centred vectors would be dense: 6 KB a row, read again by every iteration of every fit."""
    rows = [r[0] for r in models._doc_features(spark, "/root/testdata/sf0.001").select("scaled_features").collect()]
    assert rows and all(v.numNonzeros() < v.size for v in rows)
    assert any(isinstance(v, SparseVector) for v in rows)


def test_logistic_scores_are_those_of_centred_features(spark):
    rng = random.Random(5)
    rows = [(i, "train" if i % 3 else "test", ["y"] if rng.random() < (0.7 if i % 2 else 0.2) else [], float(i % 2), rng.random() * (i % 5 == 0)) for i in range(600)]
    made = VectorAssembler(inputCols=["p", "q"], outputCol="v").transform(spark.createDataFrame(rows, "id long, split string, items array<string>, p double, q double"))
    found = []
    for center in (True, False):
        scaled = StandardScaler(inputCol="v", outputCol="scaled_features", withMean=center).fit(made).transform(made).select("id", "split", "items", "scaled_features")
        found.append({r["id"]: r["score"] for r in classify.train(scaled, ["y"], ["logistic_regression"]).collect()})
    assert found[0].keys() == found[1].keys() and max(abs(found[0][k] - found[1][k]) for k in found[0]) < 1e-5
