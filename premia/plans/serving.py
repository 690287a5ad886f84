"""Jobs on what training left behind: scoring, advice, retraining, tuning, market signal."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.hashing import split_label
from premia.functions.items import joined
from premia.operators import classify, metrics, prep, recommend
from premia.operators import features as feat
from premia.plans.jobs import EXPERIENCE, Postings, whole
from premia.session import materialize
from premia.sources import results
from premia.sources.postings import POSTING_SCHEMA, read_postings
from premia.streaming import arrivals, versions

REPORTED = ("average_precision", "roc_auc", "f1", "precision", "recall", "accuracy")


def saved_thresholds(spark: SparkSession, out: str) -> DataFrame:
    """(item, model, threshold) of the last result of every finished pair."""
    return results.keep_last(spark.read.parquet(f"{out}/results"), ["item", "model"], "at").select("item", "model", "threshold")


def saved_models(spark: SparkSession, out: str, model: str, items: Sequence[str] | None = None) -> dict[str, tuple[Any, float]]:
    """The saved classifier and stored threshold of every finished item (or of those asked for)."""
    known = {r["item"]: r["threshold"] for r in saved_thresholds(spark, out).where(F.col("model") == model).collect()}
    wanted = known if items is None else [i for i in items if i in known]
    return {i: (classify.load(model, f"{out}/models", i), known[i]) for i in wanted}


def score_titles(spark: SparkSession, out: str, titles: DataFrame, model: str, **defaults) -> DataFrame:
    """titles(id, name) under every saved model: (id, item, score, threshold, predicted). Only the saved space is used, nothing is refitted."""
    space = PipelineModel.load(f"{out}/feature_space")
    ready = materialize(space.transform(prep.basic_features(feat.title_rows(titles, **defaults))).select("id", "scaled_features"))
    return classify.predict_items(ready, saved_models(spark, out, model))


def advise(p: Postings, profiles: DataFrame, intervals: DataFrame | None = None) -> dict[str, DataFrame]:
    """profiles(profile, known): suggestions with mode, rules to follow, own values with rank, known items without a partner.

    ``intervals``: the table that the bootstrap job writes (name, point_estimate, ci_low_95, ci_high_95, excludes_zero, ..).
    Own values then carry their interval. It is checked first: an interval whose point estimate is not the one
    priced from these postings comes from other data, and its row is reported in ``stale`` instead of being shown.
    """
    combos = materialize(p.values.where(F.col("size") >= 2))
    singles = p.values.where(F.col("size") == 1).select(F.element_at("items", 1).alias("item"), "adjusted_premium")
    found = materialize(recommend.recommend(profiles, combos))
    own = recommend.own_values(profiles, singles)
    out = {
        "suggestions": found,
        "modes": recommend.modes(profiles, found),
        "rules": recommend.rules_for(profiles, p.mined.rules).withColumns({c: joined(F.col(c)) for c in ("antecedent", "consequent")}),
        "own_values": own,
        "unpaired": recommend.unpaired(profiles, combos),
    }
    if intervals is not None:
        priced = p.values.select(joined(F.col("items")).alias("name"), whole("adjusted_premium").alias("priced"))
        told = materialize(intervals.select("name", "point_estimate", "ci_low_95", "ci_high_95", "excludes_zero").join(priced, "name", "left"))
        same = F.col("point_estimate").cast("double").eqNullSafe(F.col("priced").cast("double"))
        fresh = told.where(same).select(F.col("name").alias("item"), "ci_low_95", "ci_high_95", "excludes_zero")
        out["own_values"] = own.join(fresh, "item", "left")
        out["stale"] = told.where(~same).select("name", "point_estimate", "priced")
    return out


def posting_profile(p: Postings, chosen: Sequence[str], *, colisted: int = 8, recent: int = 5) -> dict[str, DataFrame]:
    """The postings that list all of ``chosen``: quartiles and shares next to all postings, co-listed items, newest postings.

    Newest postings: the last one of each employer, newest employers first, with the salary as it was posted.
    """
    holds = F.size(F.array_except(F.array(*[F.lit(i) for i in chosen]), F.col("items"))) == 0
    shares = {f"experience={e}": F.col("experience_bucket") == e for e in EXPERIENCE} | {"has_ceiling": F.col("has_ceiling")}
    subset = materialize(p.usable.where(holds))
    raw = read_postings(p.spark, p.path, ["id", "name", "employer", "salary", "published_at"])
    posted = prep.posted_salary(F.col("salary.from"), F.col("salary.to"), F.col("salary.gross"))
    shown = raw.join(subset.select("id"), "id", "left_semi").select("id", "name", F.col("employer.name").alias("employer"), posted.alias("posted_salary"), "published_at")
    return {
        "profile": recommend.subset_profile(p.usable, holds, value="salary_net", shares=shares),
        "colisted": recommend.colisted(subset, chosen, top=colisted),
        "recent": recommend.most_recent(shown, "employer", "published_at", "id", recent),
    }


def compare_results(spark: SparkSession, paths: Sequence[str], out: str, *, metric: str = "f1") -> None:
    """Result tables of several runs merged: the mean of every metric by model, and the best model of each item."""
    merged = materialize(results.merge_results([results.keep_last(spark.read.parquet(path), ["item", "model"], "at") for path in paths]))
    results.write_csv(merged.orderBy("item", "model"), f"{out}/results_merged")
    results.write_csv(metrics.macro_by_model(merged, REPORTED).orderBy("model"), f"{out}/results_by_model")
    results.write_csv(metrics.best_per_item(merged, metric).orderBy("item"), f"{out}/results_best_model")


def accuracy_report(spark: SparkSession, path: str, out: str, *, models: Sequence[str] = tuple(classify.DEFAULTS)) -> DataFrame:
    """Saved models at their stored thresholds on the test slice of ``path``, next to always saying the commoner class."""
    rows = _posting_rows(spark, path).withColumn("split", split_label(F.col("id"))).where("split = 'test'")
    report = _judged(spark, materialize(_ready(spark, out, rows)), out, out, models)
    return report.withColumn("above_baseline", F.col("accuracy") - F.col("majority_baseline_acc"))


def _judged(spark: SparkSession, ready: DataFrame, out: str, folder: str, models: Sequence[str]) -> DataFrame:
    """All metrics of the models under ``folder`` on ``ready``, at the thresholds stored under ``out``."""
    known = saved_thresholds(spark, out)
    pairs = known.where(F.col("model").isin(list(models))).select("item", "model").orderBy("model", "item").collect()
    scored = [classify.scores(classify.load(r["model"], f"{folder}/models", r["item"]), ready, r["item"], r["model"]) for r in pairs]
    long = materialize(results.merge_results(scored))
    return metrics.metric_report(long, known, metrics.ranking_metrics(long))


def _ready(spark: SparkSession, out: str, rows: DataFrame) -> DataFrame:
    return PipelineModel.load(f"{out}/feature_space").transform(rows).select("id", "items", "split", "scaled_features")


CONTENT = ["name", "employer", "description"]


def _posting_rows(spark: SparkSession, path: str) -> DataFrame:
    return prep.dedupe(prep.basic_features(read_postings(spark, path)), CONTENT)


def retrain(spark: SparkSession, old: str, new: str, out: str, *, items: Sequence[str], models: Sequence[str] = tuple(classify.DEFAULTS),
            params: dict[str, dict] | None = None) -> DataFrame:
    """Refit on the train slice of old and new postings in the saved feature space; metrics before and after on one held-out
    part of the new ones. For models of all rows see `refit_all`.

    The held-out part is the test slice of the new batch and takes part in no fit. The saved models and thresholds
    judge it first; the refitted ones, with thresholds from the val slice of both batches, go to ``models_refitted``.
    """
    arrived = materialize(_posting_rows(spark, new).withColumn("split", split_label(F.col("id"))))
    held = arrived.where("split = 'test'")
    both = prep.dedupe(_posting_rows(spark, old).unionByName(arrived.where("split <> 'test'").drop("split")), CONTENT)
    fit = both.join(held.select("id"), "id", "left_anti").withColumn("split", split_label(F.col("id"), test=0.0))
    ready = materialize(_ready(spark, out, fit.unionByName(held)))
    test = ready.where("split = 'test'")
    before = []
    for model in models:
        for item, (fitted, _) in saved_models(spark, out, model, items).items():
            before.append(classify.scores(fitted, test, item, model))
    if not before:
        raise ValueError(f"no saved model under {out} for the items asked for")
    scored = materialize(results.merge_results(before))
    old_report = metrics.metric_report(scored, saved_thresholds(spark, out), metrics.ranking_metrics(scored))
    again = classify.train(ready, items, models, params=params, models_dir=f"{out}/models_refitted")
    return metrics.before_after(old_report, classify.evaluate(again), REPORTED)


def refit_all(spark: SparkSession, old: DataFrame, new: DataFrame, out: str, target: str, *, items: Sequence[str] | None = None,
              models: Sequence[str] = tuple(classify.DEFAULTS), params: dict[str, dict] | None = None) -> list[tuple[str, str]]:
    """Fit every (item, model) on all rows of the old and new raw postings, in the saved feature space, under ``target``/models.

    Items default to those that have a result, parameters to the tuned ones stored under ``out``, if any. Returns the
    (item, model) pairs that were fitted: items with one class in the united rows are left out.
    """
    items = items or [r["item"] for r in saved_thresholds(spark, out).select("item").distinct().orderBy("item").collect()]
    space = PipelineModel.load(f"{out}/feature_space")
    fitted = classify.refit(
        space, [prep.basic_features(b) for b in (old, new)], items, models, dedupe=lambda rows: prep.dedupe(rows, CONTENT),
        params=tuned(spark, out) | (params or {}), models_dir=f"{target}/models",
    )
    return sorted(fitted)


def compare_refit(spark: SparkSession, judge: str, out: str, target: str, *, models: Sequence[str] = tuple(classify.DEFAULTS)) -> DataFrame:
    """Metrics of the saved models and of those under ``target`` on the postings of ``judge``, which no fit may have seen.

    Both use the stored thresholds; the deltas are those of the models alone.
    """
    ready = materialize(_ready(spark, out, _posting_rows(spark, judge).withColumn("split", F.lit("test"))))
    return metrics.before_after(_judged(spark, ready, out, out, models), _judged(spark, ready, out, target, models), REPORTED)


def follow_arrivals(spark: SparkSession, incoming: str, out: str, root: str, *, query: str = "", area: int = 0, least: int = 1,
                    models: Sequence[str] = tuple(classify.DEFAULTS), items: Sequence[str] | None = None, params: dict[str, dict] | None = None,
                    max_files: int | None = 1, interval: str | None = None):
    """Poll a folder of raw postings: tag them, store each id once under ``root``/store, refit after every batch.

    A batch with at least ``least`` new postings leaves one model version under ``root``/models, fitted on everything
    stored so far; a replayed batch leaves the version it has (`versions.once`). Returns the running query.
    """
    def refit(new: DataFrame, stored: DataFrame, batch_id: int) -> None:
        own = new.sparkSession
        rows = new.count()
        if rows < least:
            return

        def work(folder: str) -> dict[str, Any]:
            columns = POSTING_SCHEMA.names
            done = refit_all(own, stored.select(columns), new.select(columns), out, folder, items=items, models=models, params=params)
            return {"batch": batch_id, "new_rows": rows, "fitted": done}

        versions.once(own, f"{root}/models", batch_id, work)

    stream = arrivals.with_provenance(arrivals.read_arrivals(spark, incoming, POSTING_SCHEMA, max_files=max_files), query=query, area=area)
    return arrivals.start_exact_first_seen(stream, f"{root}/store", f"{root}/state", "id", "published_at", interval=interval, on_batch=refit)


def tune(spark: SparkSession, path: str, out: str, *, models: Sequence[str] = tuple(classify.DEFAULTS), n_items: int = 3,
         grids: dict[str, dict[str, list]] | None = None, draws: dict[str, int] | None = None, folds: int = 3) -> dict[str, dict[str, Any]]:
    """Grid search on the items whose share is nearest to one half, averaged over them; stored under ``out`` and returned."""
    rows = _posting_rows(spark, path).withColumn("split", split_label(F.col("id")))
    ready = materialize(_ready(spark, out, rows)).where("split = 'train'")
    n = ready.count()
    rates = ready.select(F.explode(F.array_distinct("items")).alias("item")).groupBy("item").agg((F.count(F.lit(1)) / n).alias("positive_rate"))
    chosen = [r["item"] for r in metrics.representative(rates.where("positive_rate < 1"), n_items).collect()]
    weights = classify.weights_of(ready, chosen)
    found = {}
    for model in models:
        searched = [
            classify.grid_search(classify.labelled(ready, item, weights[item]), model, values=(grids or classify.GRIDS)[model], draws=(draws or {}).get(model), folds=folds)
            for item in chosen
        ]
        found[model] = classify.average_params(searched)
    spark.createDataFrame([(m, json.dumps(v)) for m, v in found.items()], "model string, params string").write.mode("overwrite").json(f"{out}/tuned_params")
    return found


def tuned(spark: SparkSession, out: str) -> dict[str, dict[str, Any]]:
    """What `tune` stored, in the form that training takes; nothing if it never ran."""
    try:
        stored = spark.read.schema("model string, params string").json(f"{out}/tuned_params").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["model"]: json.loads(r["params"]) for r in stored}


def market_signal(spark: SparkSession, path: str, out: str, *, model: str, min_rows: int = 20) -> tuple[DataFrame, DataFrame]:
    """Per title, do the saved models rank its items as the test postings do? (per title, summary)."""
    rows = _posting_rows(spark, path).withColumn("split", split_label(F.col("id"))).where("split = 'test'")
    ready = materialize(_ready(spark, out, rows))
    scored = [classify.scores(fitted, ready, item, model) for item, (fitted, _) in saved_models(spark, out, model).items()]
    titled = materialize(results.merge_results(scored).join(rows.select("id", "name"), "id"))
    means = materialize(metrics.group_means(titled, group="name", min_rows=min_rows))
    overall = titled.groupBy("item").agg(F.avg("y").alias("actual"))
    by_title = materialize(metrics.spearman_by_group(means, overall, group="name"))
    return by_title, metrics.signal_summary(by_title)
