"""End-to-end jobs over a file of nested postings. Each reads the raw table and writes result tables.

Result money columns are rounded half-even to whole units, as published tables are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.hashing import split_label
from premia.functions.items import itemset_key, joined, printed
from premia.operators import attribute, bias, classify, metrics, prep, quality, regress, stability
from premia.operators import features as feat
from premia.operators.baskets import floor_items, mine, top_items
from premia.operators.ordered import row_ranks
from premia.operators.premium import cell_table, contained, value_table
from premia.operators.textstats import exclusion_tokens
from premia.session import materialize
from premia.sources import results
from premia.sources.postings import read_postings

STRATA = ["experience_bucket", "city_bucket", "has_ceiling"]
MIN_ITEM_COUNT = 45
CITIES = [*prep.MAJOR_CITIES, "Other"]
EXPERIENCE = ["noExperience", "between1And3", "between3And6", "moreThan6"]


def whole(column: str) -> Column:
    return F.bround(F.col(column), 0)


class Postings:
    """One raw posting table and the intermediate tables its jobs share; each is written on first use."""

    def __init__(self, spark: SparkSession, path: str, *, require_ceiling: bool = True) -> None:
        self.spark, self.path, self.require_ceiling = spark, path, require_ceiling

    @cached_property
    def usable(self) -> DataFrame:
        columns = ["id", "name", "employer", "description", "key_skills", "salary", "area", "experience"]
        raw = read_postings(self.spark, self.path, columns)
        return materialize(prep.usable_postings(raw, require_ceiling=self.require_ceiling))

    @cached_property
    def mined(self):
        return mine(self.usable)

    @cached_property
    def values(self) -> DataFrame:
        return materialize(value_table(self.usable, self.mined.itemsets, value="salary_net", strata=STRATA))

    @cached_property
    def itemsets(self) -> DataFrame:
        """Mined itemsets with kind; the key is made of the array and printed only when a table is written."""
        kind = F.when(F.col("size") == 1, "single").otherwise("combo")
        return materialize(self.mined.itemsets.select(itemset_key(F.col("items")).alias("itemset"), "items", "freq", "size", kind.alias("kind")))

    @cached_property
    def cells(self) -> DataFrame:
        matches = contained(self.usable, self.itemsets)
        return materialize(cell_table(self.usable, matches, key="itemset", value="salary_net", strata=STRATA))


def value_of_combinations(p: Postings, out: str) -> None:
    """Priced singles and combinations, association rules."""
    published = p.values.withColumns({c: whole(c) for c in ("raw_premium", "adjusted_premium", "best_individual_premium")})
    published = published.withColumn("synergy", F.col("adjusted_premium") - F.col("best_individual_premium"))
    best_first = F.desc_nulls_last("adjusted_premium")
    combos = published.where(F.col("size") >= 2).select(
        joined(F.col("items")).alias("combination"), "size", F.col("freq").alias("freq_count"), "n_with", "raw_premium",
        "adjusted_premium", "strata_used", "best_individual_premium", "synergy",
    )
    singles = published.where(F.col("size") == 1).select(F.element_at("items", 1).alias("skill"), "n_with", "adjusted_premium")
    results.write_csv(combos.orderBy(best_first, "combination"), f"{out}/skill_combo_value")
    results.write_csv(singles.orderBy(best_first, "skill"), f"{out}/skill_single_value")
    results.write_csv(p.mined.rules.orderBy(F.desc("lift"), joined(F.col("antecedent"))), f"{out}/skill_combo_rules")


def bootstrap(p: Postings, out: str, *, replicates: int = 1000, method: str = "poisson") -> None:
    """Point estimate, resample mean and 95 % interval of every priced itemset."""
    replicated = stability.replicate_premiums(
        p.usable, lambda rows: contained(rows, p.itemsets), id_col="id", value="salary_net", strata=STRATA, replicates=replicates, method=method,
    )
    intervals = stability.bootstrap_intervals(replicated, replicates=replicates)
    points = p.values.select(itemset_key(F.col("items")).alias("itemset"), "adjusted_premium")
    table = intervals.join(points, "itemset").select(
        printed("itemset").alias("name"), whole("adjusted_premium").alias("point_estimate"), whole("boot_mean").alias("boot_mean"),
        whole("ci_low").alias("ci_low_95"), whole("ci_high").alias("ci_high_95"), "excludes_zero", F.col("n_valid").alias("n_valid_resamples"),
    )
    results.write_csv(table.orderBy(F.desc_nulls_last(F.abs("point_estimate")), "name"), f"{out}/skill_combo_bootstrap_ci")


def cell_sensitivity(p: Postings, out: str, *, top_n: int = 10) -> None:
    """Premiums, cells and coverage at every cell threshold; summary; ranks of the top combinations."""
    saved = materialize(p.values.select(itemset_key(F.col("items")).alias("itemset"), "adjusted_premium", "strata_used"))
    named = p.itemsets.join(saved, "itemset", "left_semi").select("itemset", "kind", "size")
    wide = materialize(stability.premium_by_threshold(p.cells).join(named, "itemset"))
    again = wide.join(saved, "itemset", "full")
    same = F.col("cells_5").eqNullSafe(F.col("strata_used")) & F.round("premium_5", 4).eqNullSafe(F.round("adjusted_premium", 4))
    mismatches = again.where(~same).count()
    if mismatches:
        raise ValueError(f"{mismatches} itemsets do not reproduce the saved premiums; the comparison would not be valid")
    ranked, overlap = stability.top_overlap(wide.where(F.col("kind") == "combo"), top_n=top_n)
    results.write_csv(wide.withColumn("itemset", printed("itemset")), f"{out}/skill_combo_cell_sensitivity")
    results.write_csv(stability.sensitivity_summary(wide), f"{out}/skill_combo_cell_sensitivity_summary")
    results.write_csv(ranked.where(F.col("rank_5") <= top_n + 5).orderBy("rank_5", "itemset"), f"{out}/skill_combo_cell_sensitivity_top")
    results.write_csv(overlap, f"{out}/skill_combo_cell_sensitivity_overlap")


def selection_bias(p: Postings, out: str, *, dedup_population: bool = True) -> None:
    """Category shares, chi-square tests and item ratios of the usable rows against the population.

    ``dedup_population=False`` compares with the rows as they came, reposts included.
    """
    raw = read_postings(p.spark, p.path, ["id", "name", "employer", "description", "key_skills", "salary", "area", "experience"])
    columns = ["items", "_tagged", "experience_bucket", "city_bucket"]
    flagged = prep.usable_flags(raw, require_ceiling=p.require_ceiling).withColumns(
        {"experience_bucket": F.col("experience.id"), "city_bucket": prep.major_or_other(F.col("area.name"))})
    full = materialize((prep.dedupe(flagged, keep=columns) if dedup_population else flagged).select(*columns))
    tests = []
    for c in ("experience_bucket", "city_bucket"):
        shares = materialize(bias.category_shares(full, p.usable, c))
        results.write_csv(shares, f"{out}/selection_bias_{c}")
        tests.append(bias.chi_square(shares).withColumn("dimension", F.lit(c)))
    results.write_csv(results.merge_results(tests), f"{out}/selection_bias_tests")
    ratio = bias.item_ratio(full.where("_tagged"), p.usable, min_count=MIN_ITEM_COUNT)
    results.write_csv(ratio.orderBy(F.desc("ratio"), "item"), f"{out}/selection_bias_skill_mix")


def _vocabulary(p: Postings, min_count: int) -> list[str]:
    """Items frequent enough to be regressors (bounded by basket mentions / min_count), most frequent first."""
    return [r["item"] for r in floor_items(p.usable, min_count).orderBy(F.desc("freq"), "item").collect()]


def salary_regression(p: Postings, out: str, *, min_count: int = MIN_ITEM_COUNT) -> None:
    """Held-out ridge with and without items; item coefficients."""
    vocabulary = _vocabulary(p, min_count)
    categories, flags = {"city_bucket": CITIES, "experience_bucket": EXPERIENCE}, ["has_ceiling"]
    rows = p.usable.withColumn("y", F.col("salary_net")).withColumn("split", split_label(F.col("id"), val=0))
    evals = []
    for name, items in (("baseline_experience_city", []), ("full_with_skills", vocabulary)):
        design = materialize(regress.design(rows, categories, flags, items).select("id", "y", "split", "features"))
        names = regress.feature_names(categories, flags, items)
        fitted = regress.ridge(design.where("split = 'train'"), names)
        scored = regress.predict(design.where("split = 'test'"), fitted)
        evals.append(metrics.regression_metrics(scored).withColumn("model", F.lit(name)).withColumn("n_train", fitted.select("n_train").scalar()))
    judged = materialize(results.merge_results(evals))
    results.write_csv(judged, f"{out}/skill_salary_regression_eval")
    results.write_csv(metrics.gain_over(judged, "baseline_experience_city", "full_with_skills"), f"{out}/skill_salary_regression_gain")
    coefficients = regress.coefficients_long(fitted, names).where(F.startswith("name", F.lit("item=")))
    table = coefficients.select(F.substring("name", 6, 1 << 20).alias("skill"), F.col("coefficient").alias("coef"))
    results.write_csv(table.orderBy(F.desc("coef")), f"{out}/skill_salary_regression_coefs")


def salary_by_city(p: Postings, out: str, *, top: int = 15) -> None:
    """One ridge per city over a shared item vocabulary; coefficients side by side with their spread."""
    items = [r["item"] for r in top_items(p.usable, top).collect()]
    categories = {"experience_bucket": EXPERIENCE}
    rows = p.usable.withColumn("y", F.col("salary_net")).withColumn("split", split_label(F.col("id"), val=0))
    design = materialize(regress.design(rows, categories, [], items).select("id", "y", "split", "city_bucket", "features"))
    cities = sorted(r["city_bucket"] for r in regress.enough_rows(design, "city_bucket").collect())  # at most the three buckets
    names = regress.feature_names(categories, [], items)
    fitted = materialize(regress.ridge_by_segment(design.where("split = 'train'"), names, segment="city_bucket", segments=cities))
    plain = materialize(regress.design(rows, categories, [], []).select("y", "split", "city_bucket", "features"))
    base = regress.ridge_by_segment(plain.where("split = 'train'"), regress.feature_names(categories, [], []), segment="city_bucket", segments=cities)
    both = [
        regress.predict(frame.where("split = 'test'"), model, segment="city_bucket").select("city_bucket", F.lit(name).alias("model"), "y", "prediction")
        for name, frame, model in (("baseline_experience", plain, base), ("full_with_skills", design, fitted))
    ]
    judged = materialize(metrics.regression_metrics(results.merge_results(both), group=["city_bucket", "model"]))
    results.write_csv(judged.orderBy("city_bucket", "model"), f"{out}/skill_salary_by_city_eval")
    results.write_csv(metrics.gain_over(judged, "baseline_experience", "full_with_skills", group=["city_bucket"]), f"{out}/skill_salary_by_city_gain")
    wide = regress.coefficients_long(fitted, names).where(F.startswith("name", F.lit("item="))).groupBy(
        F.substring("name", 6, 1 << 20).alias("skill")).pivot("segment", cities).agg(F.first("coefficient"))
    results.write_csv(attribute.spread_of(wide, cities).orderBy(F.desc("spread")), f"{out}/skill_salary_by_city")


def salary_trees(p: Postings, out: str, *, min_count: int = MIN_ITEM_COUNT, iterations: int = 1000, depth: int = 6, step: float = 0.03) -> None:
    """Boosted trees with early stopping, a forest and the ridge on one split; item attribution by city and ceiling."""
    vocabulary = _vocabulary(p, min_count)
    categories, flags = {"city_bucket": CITIES, "experience_bucket": EXPERIENCE}, ["has_ceiling"]
    names = regress.feature_names(categories, flags, vocabulary)
    rows = p.usable.withColumn("y", F.col("salary_net")).withColumn("split", split_label(F.col("id")))
    design = materialize(regress.design(rows, categories, flags, vocabulary).select("id", "y", "split", "city_bucket", "has_ceiling", "items", "features"))
    test = design.where("split = 'test'")
    trees = regress.boosted(design, iterations=iterations, depth=depth, step=step)
    scored = [
        trees.transform(test).select(F.lit("boosted_trees").alias("model"), "y", "prediction"),
        regress.forest(design).transform(test).select(F.lit("random_forest").alias("model"), "y", "prediction"),
        regress.predict(test, regress.ridge(design.where("split <> 'test'"), names)).select(F.lit("ridge").alias("model"), "y", "prediction"),
    ]
    evals = metrics.regression_metrics(results.merge_results(scored), group=["model"])
    results.write_csv(evals.orderBy(F.desc("r2"), "model"), f"{out}/skill_salary_gbm_comparison")

    explained, _ = attribute.tree_contributions(trees, design)
    positions = p.spark.createDataFrame([(i, names.index(f"item={i}")) for i in vocabulary], "item string, position int")
    held = design.select("id", F.explode("items").alias("item"))
    own = materialize(attribute.item_contributions(explained, held, positions).join(design.select("id", "city_bucket", "has_ceiling"), "id"))
    by_city = attribute.by_segment(own.withColumnRenamed("city_bucket", "segment"), CITIES)
    by_ceiling = attribute.by_segment(own.withColumnRenamed("has_ceiling", "segment"), [False, True])
    for name, table in (("shap_by_city", by_city), ("shap_by_ceiling", by_ceiling)):
        results.write_csv(table.orderBy(F.desc("spread"), "item"), f"{out}/skill_salary_{name}")


def quality_report(spark: SparkSession, path: str, out: str) -> None:
    """Missing values, duplicates, blended score, funnel."""
    raw = read_postings(spark, path)
    fields = quality.posting_missing()
    results.write_csv(quality.missing_by_field(raw, fields), f"{out}/quality_missing")
    results.write_csv(quality.duplicate_counts(raw), f"{out}/quality_duplicates")
    results.write_csv(quality.quality_score(raw, fields), f"{out}/quality_score")
    results.write_csv(prep.funnel(raw), f"{out}/quality_funnel")


def ranked_vocabulary(items: DataFrame, n: int) -> DataFrame:
    return row_ranks(top_items(items, n), [], "freq", "item").select("rank", "item", "freq")


def item_models(
    spark: SparkSession, path: str, out: str, *, top_skills: int = 20, top_employers: int = 50,
    models: Sequence[str] = tuple(classify.DEFAULTS), params: dict[str, dict] | None = None, title_only: bool = False, **feature_overrides,
) -> DataFrame:
    """Tag postings: features, vocabularies, one classifier per (item, model), results appended item by item.

    Finished items are skipped when the job is started again; the vocabularies, the fitted feature space and
    the models stay under ``out``. With ``title_only`` the models see the title's vectors and the seniority alone.
    """
    rows = prep.dedupe(prep.basic_features(read_postings(spark, path)), ["name", "employer", "description"])
    rows = materialize(rows.withColumn("split", split_label(F.col("id"))))
    vocabulary = results.vocabulary(spark, f"{out}/top_skills", lambda: ranked_vocabulary(rows, top_skills), top_skills)
    employers = results.vocabulary(
        spark, f"{out}/top_employers",
        lambda: ranked_vocabulary(rows.select(F.array("employer").alias("items")), top_employers), top_employers,
    )
    excluded = [r["term"] for r in exclusion_tokens(vocabulary, "item").collect()]  # tokens of a top-n list
    names = [r["item"] for r in employers.orderBy("rank").collect()]
    spec = feat.posting_spec(names, excluded, prep.WORK_FORMATS, **feature_overrides)
    space = feat.fit_once(spark, f"{out}/feature_space", feat.feature_pipeline(spec), rows)
    ready, features = space.transform(rows), "scaled_features"
    if title_only:
        features = "title_features"
        ready = feat.title_features(ready, ["seniority_vector", *feat.text_columns(spec.texts[0], spec.word_vectors)], features)
    ready = materialize(ready.select("id", "items", "split", features))

    table = f"{out}/results"
    blank = spark.createDataFrame([], "item string, model string")
    skipped = f"{out}/one_class"
    done = blank
    for finished in (t for t in (table, skipped) if _exists(spark, t)):
        done = done.unionByName(spark.read.parquet(finished).select("item", "model"))
    todo = results.pending(vocabulary, done, key="item", variant="model", needed=len(models)).orderBy("rank")
    for item in [r["item"] for r in todo.collect()]:  # a top-n list
        if not classify.weights_of(ready.where("split = 'train'"), [item]):
            blank_rows = [(item, m) for m in models]  # one class only: finished without a model
            results.append_results(spark.createDataFrame(blank_rows, "item string, model string"), skipped)
            continue
        scored = classify.train(ready, [item], models, params=params, models_dir=f"{out}/models", features_col=features)
        results.append_results(classify.evaluate(scored).withColumn("at", F.current_timestamp()), table)
    return results.compact(spark.read.parquet(table), vocabulary, key="item", variant="model", seq="at")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
