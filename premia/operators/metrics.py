"""Classification, ranking and regression metrics of scored frames, all groups in one pass.

Scored frames are long: group columns (item, model), a 0/1 label and a score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.ordered import ROWS_PER_RANGE, average_ranks, distinct_values, running_totals
from premia.session import materialize

MIN_POSITIVES = 5
DEFAULT_THRESHOLD = 0.5
GROUP = ("item", "model")


def _sweep(scored: DataFrame, group: Sequence[str], score: str, label: str, rows_per_range: int) -> DataFrame:
    """One row per distinct score, highest first: positives and rows at it and down to it, and group totals."""
    table = distinct_values(scored, group, score, {"pos": F.col(label).cast("bigint"), "cnt": F.lit(1)})
    return running_totals(table, group, score, ["pos", "cnt"], descending=True, rows_per_range=rows_per_range)


def ranking_metrics(
    scored: DataFrame,
    *,
    group: Sequence[str] = GROUP,
    score: str = "score",
    label: str = "y",
    min_positives: int = MIN_POSITIVES,
    default: float = DEFAULT_THRESHOLD,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per group: F1-optimal threshold, its F1, step-wise average precision, ROC-AUC, rows, positives.

    The threshold is the lowest score among the best ones, or ``default`` with too few positives. Average
    precision is the sum of recall steps times precision; ROC-AUC counts ties as one half (null with one class).
    """
    rows = _sweep(scored, group, score, label, rows_per_range)
    f1 = 2 * F.col("cum_pos") / (F.col("cum_cnt") + F.col("all_pos"))
    best = F.max_by(F.struct(F.col(score).alias("s"), f1.alias("f1")), F.struct(f1, -F.col(score)))
    all_neg = F.col("all_cnt") - F.col("all_pos")
    below = all_neg - (F.col("cum_cnt") - F.col("cum_pos"))  # negatives with a lower score
    tied = F.col("cnt") - F.col("pos")
    out = rows.groupBy(*group).agg(
        best.alias("_best"),
        F.sum(F.col("pos") * (F.col("cum_pos") / F.col("cum_cnt"))).alias("_ap"),
        F.sum(F.col("pos") * (below + tied / F.lit(2.0))).alias("_auc"),
        F.max("all_pos").alias("positives"),
        F.max("all_cnt").alias("n"),
    )
    enough = F.col("positives") >= min_positives
    negatives = F.col("n") - F.col("positives")
    return out.select(
        *group,
        F.when(enough, F.col("_best.s")).otherwise(F.lit(default)).alias("threshold"),
        F.when(enough, F.col("_best.f1")).alias("f1"),
        F.coalesce(F.try_divide("_ap", "positives"), F.lit(0.0)).alias("average_precision"),
        F.try_divide(F.col("_auc"), F.col("positives") * negatives).alias("roc_auc"),
        "positives",
        "n",
    )


def with_threshold(
    scored: DataFrame, thresholds: DataFrame, *, group: Sequence[str] = GROUP, default: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Scored rows with their group's threshold; groups without one get the default."""
    known = thresholds.select(*group, "threshold")
    return scored.join(known, list(group), "left").withColumn("threshold", F.coalesce("threshold", F.lit(default)))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_metrics(
    scored: DataFrame, *, group: Sequence[str] = GROUP, score: str = "score", label: str = "y", threshold: str = "threshold"
) -> DataFrame:
    """Per group: confusion counts at the threshold, precision, recall, F1, accuracy (undefined ones are 0)."""
    hit, pos = F.col(score) >= F.col(threshold), F.col(label) == 1

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    counts = scored.groupBy(*group).agg(
        n(hit & pos).alias("tp"), n(hit & ~pos).alias("fp"), n(~hit & pos).alias("fn"), n(~hit & ~pos).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )


def class_counts(labelled: DataFrame, *, group: Sequence[str] = ("item",), label: str = "y") -> DataFrame:
    return labelled.groupBy(*group, label).agg(F.count(F.lit(1)).alias("n_class"))


def evaluable(labelled: DataFrame, *, group: Sequence[str] = ("item",), label: str = "y") -> DataFrame:
    """Groups that show both classes."""
    return labelled.groupBy(*group).agg(F.countDistinct(label).alias("_k")).where(F.col("_k") == 2).select(*group)


def class_weights(labelled: DataFrame, *, group: Sequence[str] = ("item",), label: str = "y") -> DataFrame:
    """Balanced weight n / (classes * n_class) per (group, label): one aggregate for all groups."""
    counts = class_counts(labelled, group=group, label=label)
    totals = counts.groupBy(*group).agg(F.sum("n_class").alias("_n"), F.count(F.lit(1)).alias("_k"))
    weight = F.col("_n") / (F.col("_k") * F.col("n_class"))
    return counts.join(totals, list(group)).select(*group, label, "n_class", weight.alias("weight"))


def with_class_weight(
    labelled: DataFrame, *, group: Sequence[str] = ("item",), label: str = "y", name: str = "class_weight"
) -> DataFrame:
    """Rows with their balanced weight."""
    weights = class_weights(labelled, group=group, label=label).select(*group, label, F.col("weight").alias(name))
    return labelled.join(weights, [*group, label])


def positive_rates(labelled: DataFrame, *, group: Sequence[str] = ("item",), label: str = "y") -> DataFrame:
    """Positive rate and majority-class accuracy per group."""
    rate = F.avg(F.col(label).cast("double"))
    return labelled.groupBy(*group).agg(
        rate.alias("positive_rate"), F.greatest(rate, 1 - rate).alias("majority_baseline_acc")
    )


def representative(rates: DataFrame, n: int = 3, *, item: str = "item") -> DataFrame:
    """The n items whose positive rate is nearest to one half."""
    return rates.orderBy(F.abs(F.col("positive_rate") - 0.5), item).limit(n)


def best_per_item(results: DataFrame, metric: str, *, item: str = "item", model: str = "model") -> DataFrame:
    """The winning model per item (ties: the model that sorts first)."""
    ordered = F.struct(F.col(metric), F.col(model))
    top = results.where(F.col(metric).isNotNull()).groupBy(item).agg(F.max(metric).alias(metric))
    winners = results.join(top, [item, metric]).groupBy(item).agg(F.min_by(F.struct(model, metric), ordered).alias("_w"))
    return winners.select(item, "_w.*")


def macro_by_model(results: DataFrame, metrics: Sequence[str], *, model: str = "model") -> DataFrame:
    return results.groupBy(model).agg(*[F.avg(m).alias(m) for m in metrics])


def metric_report(
    scored: DataFrame, thresholds: DataFrame, ranking: DataFrame, *, group: Sequence[str] = GROUP
) -> DataFrame:
    """Accuracy, precision, recall, F1, baseline, positive rate, and the ranking metrics joined on."""
    at = confusion_metrics(with_threshold(scored, thresholds, group=group), group=group).drop("tp", "fp", "fn", "tn")
    rates = positive_rates(scored, group=group)
    kept = ranking.select(*group, "average_precision", "roc_auc")
    return at.join(rates, list(group)).join(kept, list(group), "left")


def before_after(before: DataFrame, after: DataFrame, metrics: Sequence[str], *, keys: Sequence[str] = GROUP) -> DataFrame:
    """Metric changes per key present on both sides."""
    old = before.select(*keys, *[F.col(m).alias(f"{m}_before") for m in metrics])
    new = after.select(*keys, *[F.col(m).alias(f"{m}_after") for m in metrics])
    deltas = [(F.col(f"{m}_after") - F.col(f"{m}_before")).alias(f"{m}_delta") for m in metrics]
    return old.join(new, list(keys)).select("*", *deltas)


def group_means(scored: DataFrame, *, group: str, item: str = "item", label: str = "y", score: str = "score", min_rows: int) -> DataFrame:
    """(group, item, actual, predicted, n) over groups with enough rows; ``n`` counts rows per (group, item)."""
    means = scored.groupBy(group, item).agg(
        F.avg(label).alias("actual"), F.avg(score).alias("predicted"), F.count(F.lit(1)).alias("n")
    )
    enough = means.groupBy(group).agg(F.min("n").alias("_least")).where(F.col("_least") >= min_rows).select(group)
    return means.join(enough, group, "left_semi")


def spearman_by_group(
    means: DataFrame, overall: DataFrame, *, group: str, item: str = "item", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Rank correlation of actual with predicted, and with the overall actual rates, per group."""
    rows = materialize(means.join(overall.select(item, F.col("actual").alias("overall")), item))
    for c in ("actual", "predicted", "overall"):
        rows = average_ranks(rows, [group], c, f"_r_{c}", rows_per_range=rows_per_range)
    return rows.groupBy(group).agg(
        F.max("n").alias("n"),
        F.corr("_r_actual", "_r_predicted").alias("model_corr"),
        F.corr("_r_actual", "_r_overall").alias("baseline_corr"),
    )


def signal_summary(by_group: DataFrame) -> DataFrame:
    """Mean correlations and the number of groups in which the model beats the overall rates."""
    wins = F.count(F.when(F.col("model_corr") > F.col("baseline_corr"), 1))
    return by_group.agg(
        F.avg("model_corr").alias("model_corr"), F.avg("baseline_corr").alias("baseline_corr"),
        wins.alias("wins"), F.count(F.lit(1)).alias("groups"),
    )


def regression_metrics(
    predicted: DataFrame, *, group: Sequence[str] = (), label: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """R2, RMSE, MAE and the row count per group, from one aggregate.

    The total sum of squares uses the population variance, which Spark merges in a numerically stable way.
    """
    error = F.col(label) - F.col(prediction)
    sse, total = F.sum(error * error), F.var_pop(label) * F.count(F.lit(1))
    return predicted.groupBy(*group).agg(
        (1 - F.try_divide(sse, total)).alias("r2"),
        F.sqrt(sse / F.count(F.lit(1))).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )


def gain_over(evals: DataFrame, base: str, full: str, *, model: str = "model", group: Sequence[str] = ()) -> DataFrame:
    """R2 gained and RMSE saved by the full model over the base model, per ``group`` if any."""
    def of(name: str, metric: str) -> Column:
        return F.max(F.when(F.col(model) == name, F.col(metric)))

    saved = of(base, "rmse") - of(full, "rmse")
    return evals.groupBy(*group).agg(
        (of(full, "r2") - of(base, "r2")).alias("r2_gain"), saved.alias("rmse_saved"),
        (saved / of(base, "rmse")).alias("rmse_saved_share"),
    )
