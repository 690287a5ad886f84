"""End-to-end jobs over a generated posting file."""

import pytest
from pyspark.sql import functions as F

from premia.operators import classify
from premia.plans import jobs, serving
from premia.streaming import versions


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    """900 postings: item 'py' pays more, item 'c/c++' follows it, seniority and city confound."""
    h = lambda salt, n: F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(n))
    py, senior = h("py", 2) == 0, h("senior", 3) == 0
    names = F.array_compact(F.array(
        F.when(py, F.lit("py")), F.when(py & (h("c", 4) > 0), F.lit("c/c++")), F.when(h("sql", 2) == 0, F.lit("sql")),
        F.when(h("excel", 3) == 0, F.lit(" excel ")), F.lit("english"),
    ))
    low = 1000.0 + F.when(py, 300).otherwise(0) + F.when(senior, 200).otherwise(0) + h("noise", 50)
    rows = spark.range(900).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.when(senior, "Senior ").otherwise(""), F.when(py, "Python developer").otherwise("Office manager")).alias("name"),
        F.concat(F.lit("<p>команда проект номер "), F.col("id"), F.lit("</p>")).alias("description"),
        F.transform(names, lambda s: F.struct(s.alias("name"))).alias("key_skills"),
        F.struct(F.lit("1").alias("id"), F.when(h("city", 2) == 0, "Москва").otherwise("Казань").alias("name")).alias("area"),
        F.struct(F.lit("1").alias("id"), F.concat(F.lit("e"), h("e", 6)).alias("name")).alias("employer"),
        F.struct(low.alias("from"), F.when(h("top", 5) > 0, low + 200).alias("to"), F.lit("RUR").alias("currency"), F.lit(False).alias("gross")).alias("salary"),
        F.struct(F.when(senior, "moreThan6").otherwise("noExperience").alias("id")).alias("experience"),
        F.array(F.struct(F.lit("REMOTE").alias("id"))).alias("work_format"),
        F.timestamp_seconds(F.col("id")).alias("published_at"), F.lit(None).cast("string").alias("alternate_url"),
    )
    target = str(tmp_path_factory.mktemp("jobs") / "postings.parquet")
    rows.write.parquet(target)
    return target


@pytest.fixture(scope="module")
def postings(spark, path):
    return jobs.Postings(spark, path, require_ceiling=False)


def read(spark, path):
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def test_value_and_stability_jobs(spark, postings, tmp_path):
    out = str(tmp_path)
    jobs.value_of_combinations(postings, out)
    jobs.bootstrap(postings, out, replicates=20, method="poisson")
    jobs.cell_sensitivity(postings, out)
    singles = {r["skill"]: r for r in read(spark, f"{out}/skill_single_value").collect()}
    assert singles["py"]["adjusted_premium"] == pytest.approx(300, abs=15) and "english" not in singles  # held by every row
    combos = {r["combination"]: r for r in read(spark, f"{out}/skill_combo_value").collect()}
    pair = combos["c/c++ + py"]
    assert pair["synergy"] == pair["adjusted_premium"] - max(singles[s]["adjusted_premium"] for s in ("c/c++", "py"))
    rules = {(r["antecedent"], r["consequent"]): r for r in read(spark, f"{out}/skill_combo_rules").collect()}
    assert rules["c/c++", "py"]["confidence"] == 1.0 and rules["c/c++", "py"]["lift"] > 1.5
    ci = {r["name"]: r for r in read(spark, f"{out}/skill_combo_bootstrap_ci").collect()}
    assert ci["py"]["excludes_zero"] and ci["py"]["ci_low_95"] <= ci["py"]["point_estimate"] <= ci["py"]["ci_high_95"]
    summary = read(spark, f"{out}/skill_combo_cell_sensitivity_summary").collect()
    assert {(r["population"], r["threshold"]) for r in summary} == {(p, k) for p in ("all", "single", "combo") for k in (3, 5, 10)}


def test_bias_and_quality_jobs(spark, postings, path, tmp_path):
    out = str(tmp_path)
    jobs.selection_bias(postings, out)
    jobs.quality_report(spark, path, out)
    tests = {r["dimension"]: r for r in read(spark, f"{out}/selection_bias_tests").collect()}
    assert set(tests) == {"experience_bucket", "city_bucket"} and all(0 <= r["p_value"] <= 1 for r in tests.values())
    ratios = [r["ratio"] for r in read(spark, f"{out}/selection_bias_skill_mix").collect()]
    assert ratios == sorted(ratios, reverse=True) and all(0.9 < r < 1.1 for r in ratios)
    assert read(spark, f"{out}/quality_funnel").first()["total"] == 900


def test_regression_jobs(spark, postings, tmp_path):
    out = str(tmp_path)
    jobs.salary_regression(postings, out)
    jobs.salary_by_city(postings, out)
    jobs.salary_trees(postings, out, iterations=10, depth=3, step=0.3)
    evals = {r["model"]: r for r in read(spark, f"{out}/skill_salary_regression_eval").collect()}
    assert evals["full_with_skills"]["r2"] > 0.95 > evals["baseline_experience_city"]["r2"]
    coefs = {r["skill"]: r["coef"] for r in read(spark, f"{out}/skill_salary_regression_coefs").collect()}
    assert coefs["py"] == pytest.approx(300, abs=15)
    by_city = {r["skill"]: r for r in read(spark, f"{out}/skill_salary_by_city").collect()}
    assert by_city["py"]["Other"] == pytest.approx(300, abs=15) and by_city["py"]["spread"] < 15
    gain = read(spark, f"{out}/skill_salary_regression_gain").first()
    assert gain["r2_gain"] == pytest.approx(evals["full_with_skills"]["r2"] - evals["baseline_experience_city"]["r2"]) and gain["rmse_saved"] > 0
    cities = {(r["city_bucket"], r["model"]): r for r in read(spark, f"{out}/skill_salary_by_city_eval").collect()}
    gains = {r["city_bucket"]: r for r in read(spark, f"{out}/skill_salary_by_city_gain").collect()}
    assert len(cities) == 2 * len(gains) and len(gains) >= 2
    for city, g in gains.items():
        assert g["r2_gain"] == pytest.approx(cities[city, "full_with_skills"]["r2"] - cities[city, "baseline_experience"]["r2"]) and g["r2_gain"] > 0.3
    ranking = read(spark, f"{out}/skill_salary_gbm_comparison").collect()
    assert {r["model"] for r in ranking} == {"boosted_trees", "random_forest", "ridge"} and ranking[0]["r2"] > 0.9
    shap = {r["item"]: r for r in read(spark, f"{out}/skill_salary_shap_by_ceiling").collect()}
    assert shap["py"]["mean_0"] > 50 and shap["py"]["mean_1"] > 50


def test_item_models_resume_and_title_scoring(spark, path, tmp_path):
    out = str(tmp_path)
    settings = dict(top_skills=3, top_employers=2, models=("logistic_regression",), params={"logistic_regression": {"maxIter": 10}}, word_vectors=False)
    first = jobs.item_models(spark, path, out, **settings)
    assert first.count() == 2  # 'english' is in every posting
    report = {r["item"]: r for r in first.collect()}
    assert report["py"]["roc_auc"] == 1.0 and report["sql"]["roc_auc"] < 0.8
    before = spark.read.parquet(f"{out}/results").count()
    assert jobs.item_models(spark, path, out, **settings).count() == 2 and spark.read.parquet(f"{out}/results").count() == before

    titles = spark.createDataFrame([("a", "Python developer"), ("b", "Office manager")], "id string, name string")
    got = serving.score_titles(spark, out, titles, "logistic_regression").where("item = 'py'")
    assert {r["id"]: r["predicted"] for r in got.collect()} == {"a": True, "b": False}

    deltas = {r["item"]: r for r in serving.retrain(spark, path, path, out, items=["py", "sql"], models=("logistic_regression",), params=settings["params"]).collect()}
    assert set(deltas) == {"py", "sql"} and deltas["py"]["roc_auc_delta"] == 0 and deltas["py"]["roc_auc_after"] == 1.0
    assert classify.load("logistic_regression", f"{out}/models_refitted", "py").numFeatures > 3

    grid = {"logistic_regression": {"regParam": [0.01, 0.1], "maxIter": [5]}}
    found = serving.tune(spark, path, out, models=("logistic_regression",), n_items=2, grids=grid, folds=2)
    assert serving.tuned(spark, out) == found and 0.01 <= found["logistic_regression"]["regParam"] <= 0.1 and found["logistic_regression"]["maxIter"] == 5

    judged = {r["item"]: r for r in serving.accuracy_report(spark, path, out, models=("logistic_regression",)).collect()}
    assert set(judged) == {"py", "sql"} and judged["py"]["accuracy"] == report["py"]["accuracy"] and judged["py"]["above_baseline"] > 0.3
    serving.compare_results(spark, [f"{out}/results"], f"{tmp_path}/compared")
    assert {r["item"]: r["model"] for r in read(spark, f"{tmp_path}/compared/results_best_model").collect()} == {"py": "logistic_regression", "sql": "logistic_regression"}
    macro = read(spark, f"{tmp_path}/compared/results_by_model").first()
    assert macro["f1"] == pytest.approx((report["py"]["f1"] + report["sql"]["f1"]) / 2)

    by_title, summary = serving.market_signal(spark, path, out, model="logistic_regression", min_rows=5)
    assert {r["name"] for r in by_title.collect()} >= {"Python developer", "Office manager"} and summary.first()["groups"] == by_title.count()


def test_arrivals_leave_one_model_version_a_batch(spark, path, tmp_path):
    out, root, incoming = f"{tmp_path}/out", f"{tmp_path}/follow", f"{tmp_path}/in"
    settings = dict(top_skills=3, top_employers=2, models=("logistic_regression",), params={"logistic_regression": {"maxIter": 5}}, word_vectors=False)
    jobs.item_models(spark, path, out, **settings)
    rows = spark.read.parquet(path)
    slices = [rows.where(F.col("id") < 200), rows.where((F.col("id") >= 100) & (F.col("id") < 300)), rows.where(F.col("id") < 300)]

    def arrive(part):
        part.coalesce(1).write.mode("append").parquet(incoming)

    def run():
        q = serving.follow_arrivals(spark, incoming, out, root, query="python", area=1, models=("logistic_regression",), items=["py", "sql"])
        q.awaitTermination()

    arrive(slices[0])
    arrive(slices[1])
    run()
    notes = [versions.note(spark, f"{root}/models", i) for i in versions.published(spark, f"{root}/models")]
    assert [(n["batch"], n["new_rows"]) for n in notes] == [(0, 200), (1, 100)] and all(len(n["fitted"]) == 2 for n in notes)
    stored = spark.read.parquet(f"{root}/store")
    assert stored.count() == 300 and set(stored.select("_search_query").distinct().toPandas()["_search_query"]) == {"python"}
    arrive(slices[2])  # nothing new
    run()
    assert versions.published(spark, f"{root}/models") == [0, 1]
    # the last commit is lost: the stream replays its batch, which keeps its version
    commits = sorted((tmp_path / "follow" / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    before = (tmp_path / "follow" / "models" / "batch=1" / "note.json").stat().st_mtime_ns
    for commit in commits[1:]:
        commit.unlink()
        (commit.parent / f".{commit.name}.crc").unlink(missing_ok=True)
    run()
    assert versions.published(spark, f"{root}/models") == [0, 1] and (tmp_path / "follow" / "models" / "batch=1" / "note.json").stat().st_mtime_ns == before
    assert spark.read.parquet(f"{root}/store").count() == 300
    deltas = serving.compare_refit(spark, path, out, versions.latest(spark, f"{root}/models"), models=("logistic_regression",))
    assert {r["item"] for r in deltas.collect()} == {"py", "sql"}


def test_title_only_models(spark, path, tmp_path):
    settings = dict(top_skills=2, top_employers=2, models=("logistic_regression",), params={"logistic_regression": {"maxIter": 5}}, word_vectors=False)
    report = {r["item"]: r for r in jobs.item_models(spark, path, str(tmp_path), title_only=True, **settings).collect()}
    assert report and all(r["roc_auc"] is not None for r in report.values())
    assert classify.load("logistic_regression", f"{tmp_path}/models", next(iter(report))).numFeatures < 30


def test_advice_for_sets_of_any_size(spark, postings):
    known = [("one", ["py"]), ("four", ["c/c++", "excel", "py", "sql"]), ("none", ["zzz"]), ("all", ["c/c++", "english", "excel", "py", "sql"])]
    out = serving.advise(postings, spark.createDataFrame(known, "profile string, known array<string>"))
    modes = {r["profile"]: r["mode"] for r in out["modes"].collect()}
    suggested = {(r["profile"], r["suggested"]) for r in out["suggestions"].collect()}
    assert modes["one"] == "exact" and modes["none"] == modes["all"] == "none" and ("one", "c/c++") in suggested
    assert modes["four"] in ("exact", "pairwise") and all(s not in dict(known)[p] for p, s in suggested)
    assert {(r["profile"], r["item"]) for r in out["unpaired"].collect()} == {("none", "zzz")}
    assert {r["item"] for r in out["own_values"].where("profile = 'four'").collect()} == {"c/c++", "excel", "py", "sql"}


def test_advice_shows_only_intervals_of_the_same_data(spark, postings):
    prices = {r["items"][0]: round(r["adjusted_premium"]) for r in postings.values.where("size = 1 and adjusted_premium is not null").collect()}
    rows = [("py", float(prices["py"]), 1.0, 2.0, True), ("sql", prices["sql"] + 5.0, 3.0, 4.0, True)]
    intervals = spark.createDataFrame(rows, "name string, point_estimate double, ci_low_95 double, ci_high_95 double, excludes_zero boolean")
    out = serving.advise(postings, spark.createDataFrame([("p", ["py", "sql"])], "profile string, known array<string>"), intervals)
    own = {r["item"]: r for r in out["own_values"].collect()}
    assert (own["py"]["ci_low_95"], own["py"]["ci_high_95"]) == (1.0, 2.0) and own["sql"]["ci_low_95"] is None
    assert [r["name"] for r in out["stale"].collect()] == ["sql"]


def test_profile_of_a_chosen_set(spark, postings, path):
    got = serving.posting_profile(postings, ["py", "sql"])
    usable = postings.usable.collect()
    subset = [r for r in usable if {"py", "sql"} <= set(r["items"])]
    profile = {(r["population"], r["measure"]): r["value"] for r in got["profile"].collect()}
    assert profile["subset", "has_ceiling"] == pytest.approx(sum(r["has_ceiling"] for r in subset) / len(subset))
    import statistics

    assert profile["subset", "median"] == pytest.approx(statistics.median(r["salary_net"] for r in subset))
    assert profile["all", "median"] == pytest.approx(statistics.median(r["salary_net"] for r in usable))
    listed = {r["item"]: r["share"] for r in got["colisted"].collect()}
    assert listed["english"] == 1.0 and not {"py", "sql"} & set(listed)
    recent = got["recent"].collect()
    raw = {r["id"]: r for r in spark.read.parquet(path).collect()}
    newest = {}
    for r in subset:
        newest[raw[r["id"]]["employer"]["name"]] = max(newest.get(raw[r["id"]]["employer"]["name"], -1), int(r["id"]))
    assert [int(r["id"]) for r in recent] == sorted(newest.values(), reverse=True)[:5] and all("RUB" in r["posted_salary"] for r in recent)
