"""Held-out regressions: ridge with leave-one-out choice of the penalty (whole table or per segment), trees."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml.feature import CountVectorizerModel, Interaction, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, RandomForestRegressor
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.session import materialize

# Searched penalties, and the least rows a segment needs.
ALPHAS = np.logspace(-2, 4, 30)
MIN_TRAIN, MIN_TEST = 100, 20
_ROUNDS_WRITTEN = 10


def feature_names(categories: dict[str, Sequence[str]], flags: Sequence[str], items: Sequence[str]) -> list[str]:
    """Names of the 0/1 design columns, in order."""
    return [f"{c}={v}" for c, values in categories.items() for v in values] + list(flags) + [f"item={i}" for i in items]


def design(
    df: DataFrame, categories: dict[str, Sequence[str]], flags: Sequence[str], items: Sequence[str], *,
    items_col: str = "items", out: str = "features",
) -> DataFrame:
    """Sparse 0/1 design vector: every category value, every boolean flag, every listed item (no level dropped)."""
    names = feature_names(categories, flags, items)
    parts: list[Column] = [F.array(F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in categories]
    parts += [F.array(F.when(F.col(f), F.lit(f))) for f in flags]
    if items:
        parts.append(F.transform(items_col, lambda i: F.concat(F.lit("item="), i)))
    named = df.withColumn("_active", F.array_compact(F.concat(*parts)))
    return CountVectorizerModel.from_vocabulary(names, "_active", out).setBinary(True).transform(named).drop("_active")


def segment_grams(df: DataFrame, features: str, label: str, segment: str, segments: Sequence[str]) -> dict[str, np.ndarray]:
    """Per segment the matrix [X 1 y]'[X 1 y], from one distributed pass over sparse block vectors.

    Every row is placed in its segment's block, so one covariance job serves all segments. Only the
    (segments x columns) squared matrix reaches the driver; it does not grow with the rows.
    """
    key = F.col(segment).cast("string")
    rows = df.where(key.isin(list(segments))).withColumn("_one", F.lit(1.0))
    wide = VectorAssembler(inputCols=[features, "_one", label], outputCol="_row").transform(rows)
    if len(segments) == 1:
        blocks = wide.select(F.col("_row").alias("_block"))
    else:
        coded = CountVectorizerModel.from_vocabulary(list(segments), "_name", "_seg").transform(wide.withColumn("_name", F.array(key)))
        blocks = Interaction(inputCols=["_seg", "_row"], outputCol="_block").transform(coded).select("_block")
    stats = blocks.select(Summarizer.metrics("mean", "std", "count").summary(F.col("_block")).alias("s")).select("s.*").first()
    n, mean, std = stats["count"], stats["mean"].toArray(), stats["std"].toArray()
    corr = np.nan_to_num(Correlation.corr(blocks, "_block").first()[0].toArray())
    np.fill_diagonal(corr, 1.0)
    gram = corr * np.outer(std, std) * (n - 1) + n * np.outer(mean, mean)
    width = len(mean) // len(segments)
    return {s: gram[i * width:(i + 1) * width, i * width:(i + 1) * width] for i, s in enumerate(segments)}


class _Solved:
    """Eigen form of one segment's centred normal equations."""

    def __init__(self, gram: np.ndarray) -> None:
        d = gram.shape[0] - 2
        self.n = gram[d, d]
        sums, sum_y = gram[:d, d], gram[d, d + 1]
        self.mean, self.mean_y = sums / self.n, sum_y / self.n
        centred = gram[:d, :d] - np.outer(sums, sums) / self.n
        self.values, self.vectors = np.linalg.eigh((centred + centred.T) / 2)
        self.values = np.clip(self.values, 0.0, None)
        self.target = self.vectors.T @ (gram[:d, d + 1] - sums * self.mean_y)

    def coefficients(self, alpha: float) -> np.ndarray:
        return self.vectors @ (self.target / (self.values + alpha))

    def intercept(self, coefficients: np.ndarray) -> float:
        return float(self.mean_y - self.mean @ coefficients)


def loo_errors(df: DataFrame, features: str, label: str, segment: str, solved: dict[str, _Solved], alphas: np.ndarray) -> DataFrame:
    """(segment, alpha, sse): squared leave-one-out errors of every penalty, all from one pass over the rows."""
    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for name, part in pdf.groupby("segment"):
                s = solved[name]
                z = (np.vstack(part["x"].to_numpy()) - s.mean) @ s.vectors
                shrink = 1.0 / (s.values[:, None] + alphas[None, :])
                leverage = 1.0 / s.n + (z * z) @ shrink
                predicted = s.mean_y + z @ (s.target[:, None] * shrink)
                e = (part["y"].to_numpy()[:, None] - predicted) / (1.0 - leverage)
                total[name] = total.get(name, 0.0) + (e * e).sum(axis=0)
        for name, sse in total.items():
            yield pd.DataFrame({"segment": name, "alpha": alphas, "sse": sse})

    rows = df.where(F.col(segment).cast("string").isin(list(solved))).select(
        F.col(segment).cast("string").alias("segment"), vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")
    )
    partial = rows.mapInPandas(errors, "segment string, alpha double, sse double")
    return partial.groupBy("segment", "alpha").agg(F.sum("sse").alias("sse"))


def ridge_by_segment(
    train: DataFrame, names: Sequence[str], *, features: str = "features", label: str = "y", segment: str, segments: Sequence[str],
    alphas: np.ndarray = ALPHAS,
) -> DataFrame:
    """One row per segment: chosen alpha, intercept and coefficients (array, in ``names`` order).

    The penalty is the one with the least mean squared leave-one-out error; segments without rows are left out.
    """
    spark = train.sparkSession
    grams = segment_grams(train, features, label, segment, segments)
    width = len(names)
    solved = {s: _Solved(g) for s, g in grams.items() if round(g[width, width]) > 1}
    sse: dict[str, dict[float, float]] = {}
    for row in loo_errors(train, features, label, segment, solved, alphas).collect():  # segments x alphas rows
        sse.setdefault(row["segment"], {})[row["alpha"]] = row["sse"]
    out = []
    for s, by_alpha in sse.items():
        alpha = min(by_alpha, key=lambda a: (by_alpha[a], a))
        coefficients = solved[s].coefficients(alpha)
        out.append((s, float(alpha), solved[s].intercept(coefficients), [float(c) for c in coefficients], int(round(solved[s].n))))
    return spark.createDataFrame(out, "segment string, alpha double, intercept double, coefficients array<double>, n_train bigint")


def ridge(train: DataFrame, names: Sequence[str], *, features: str = "features", label: str = "y", alphas: np.ndarray = ALPHAS) -> DataFrame:
    """The same for the whole table, as one segment 'all'."""
    return ridge_by_segment(
        train.withColumn("_whole", F.lit("all")), names, features=features, label=label, segment="_whole", segments=["all"], alphas=alphas
    )


def predict(df: DataFrame, fitted: DataFrame, *, features: str = "features", segment: str | None = None) -> DataFrame:
    """Linear predictions on the JVM side; ``fitted`` holds one row per segment and is broadcast."""
    key = F.col(segment).cast("string") if segment else F.lit("all")
    model = F.broadcast(fitted.select(F.col("segment").alias("_s"), "intercept", "coefficients"))
    terms = F.zip_with(vector_to_array(features), F.col("coefficients"), lambda x, c: x * c)
    scored = df.withColumn("_key", key).join(model, F.col("_key") == F.col("_s"))
    return scored.withColumn("prediction", F.col("intercept") + F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)).drop(
        "_key", "_s", "intercept", "coefficients"
    )


def coefficients_long(fitted: DataFrame, names: Sequence[str]) -> DataFrame:
    """(segment, name, coefficient)."""
    listed = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("name"), F.col("coefficients").alias("coefficient"))
    return fitted.select("segment", F.explode(listed).alias("c")).select("segment", "c.*")


def enough_rows(rows: DataFrame, segment: str, split: str = "split", *, min_train: int = MIN_TRAIN, min_test: int = MIN_TEST) -> DataFrame:
    """Segments with enough train and test rows to fit and judge a model of their own."""
    counts = rows.groupBy(segment).agg(
        F.count(F.when(F.col(split) != "test", 1)).alias("n_train"), F.count(F.when(F.col(split) == "test", 1)).alias("n_test")
    )
    return counts.where((F.col("n_train") >= min_train) & (F.col("n_test") >= min_test))


def _ensemble(trees: list, weights: list[float], features: str, label: str) -> GBTRegressionModel:
    """The boosted model of the given trees, as if one fit had grown them."""
    context = SparkContext._active_spark_context
    regression = context._jvm.org.apache.spark.ml.regression
    held = context._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    numbers = context._gateway.new_array(context._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        held[i], numbers[i] = tree._java_obj, float(weight)
    grown = regression.GBTRegressionModel(f"boosted-{uuid.uuid4().hex}", held, numbers, trees[0].numFeatures)
    grown.set(grown.getParam("labelCol"), label)
    return GBTRegressionModel(grown).setFeaturesCol(features)


def boosted(
    rows: DataFrame, *, features: str = "features", label: str = "y", iterations: int = 1000, depth: int = 6, step: float = 0.03, seed: int = 42,
    patience: int = 50,
):
    """Boosted trees for squared error on the train rows, round by round, up to the best round on the val rows (column ``split``).

    A round fits one tree to the residuals of the rounds before; it ends with the val error of the ensemble so far. After
    ``patience`` rounds without a better one the trees up to the best round are kept: nothing is fitted twice, and no round
    beyond the patience is fitted at all. Without val rows all rounds stay. Predictions so far are a column that is kept
    from round to round, so that the scans of a fit apply no earlier tree, and written every ``_ROUNDS_WRITTEN`` rounds, so plans stay short.
    """
    kept = rows.where("split in ('train', 'val')").select(features, F.col(label).cast("double").alias("_y"), (F.col("split") == "val").alias("_val"))
    state = materialize(kept.withColumn("_sum", F.lit(0.0)))
    judged = not state.where("_val").isEmpty()
    trees, weights, best, at, held = [], [], float("inf"), 0, []
    for m in range(iterations):
        residual = F.col("_y") if m == 0 else 2.0 * (F.col("_y") - F.col("_sum"))
        tree = DecisionTreeRegressor(featuresCol=features, labelCol="_residual", predictionCol="_tree", maxDepth=depth, seed=seed + m).fit(
            state.where("not _val").withColumn("_residual", residual)
        )
        weight = 1.0 if m == 0 else step
        trees.append(tree)
        weights.append(weight)
        state = tree.transform(state).withColumn("_sum", F.col("_sum") + weight * F.col("_tree")).drop("_tree").persist()
        held.append(state)
        if m % _ROUNDS_WRITTEN == _ROUNDS_WRITTEN - 1:
            state = materialize(state)
        error = state.agg(F.avg(F.when(F.col("_val"), (F.col("_y") - F.col("_sum")) ** 2))).first()[0]  # reads, so keeps, every row
        for known in held[:-1]:
            known.unpersist()
        del held[:-1]
        if judged:
            if error < best:
                best, at = error, m
            elif m - at >= patience:
                break
    for known in held:
        known.unpersist()
    keep = at + 1 if judged else len(trees)
    return _ensemble(trees[:keep], weights[:keep], features, label)


def forest(rows: DataFrame, *, features: str = "features", label: str = "y", trees: int = 100, depth: int = 10, seed: int = 42):
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(
        rows.where("split = 'train'")
    )
