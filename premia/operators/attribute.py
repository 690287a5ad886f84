"""Attribution tables: mean contribution of an item by segment, spread between segments."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.session import scratch_path

MIN_ITEM_ROWS = 15
MIN_SEGMENT_ROWS = 10


def by_segment(
    contributions: DataFrame,
    segments: Sequence[str],
    *,
    item: str = "item",
    segment: str = "segment",
    value: str = "contribution",
    min_item_rows: int = MIN_ITEM_ROWS,
    min_segment_rows: int = MIN_SEGMENT_ROWS,
) -> DataFrame:
    """Per item: mean contribution and rows in each listed segment, and the spread between the means.

    ``contributions`` holds one row per (row having the item, item). Items with too few rows in all, or in
    any listed segment, are left out. Column names are positional: mean_0, n_0, mean_1, ...
    """
    aggregates: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, s in enumerate(segments):
        here = F.col(segment) == s
        aggregates += [F.avg(F.when(here, F.col(value))).alias(f"mean_{i}"), F.count(F.when(here, 1)).alias(f"n_{i}")]
    out = contributions.groupBy(item).agg(*aggregates).where(F.col("_rows") >= min_item_rows)
    for i in range(len(segments)):
        out = out.where(F.col(f"n_{i}") >= min_segment_rows)
    means = [F.col(f"mean_{i}") for i in range(len(segments))]
    return out.drop("_rows").withColumn("spread", F.greatest(*means) - F.least(*means))


def spread_of(table: DataFrame, columns: Sequence[str], name: str = "spread") -> DataFrame:
    """Largest minus smallest of the columns, nulls ignored (coefficients of segment models)."""
    cols = [F.col(c) for c in columns]
    return table.withColumn(name, F.greatest(*cols) - F.least(*cols))


def linear_contributions(df: DataFrame, fitted: DataFrame, means: Sequence[float], *, features: str = "features") -> DataFrame:
    """Additive contributions coefficient * (x - mean) of a whole-table linear fit, as an array column."""
    centred = F.zip_with(vector_to_array(features), F.array(*[F.lit(float(m)) for m in means]), lambda x, m: x - m)
    known = df.withColumn("_coefficients", fitted.select("coefficients").scalar())
    return known.withColumn("contributions", F.zip_with(centred, "_coefficients", lambda x, c: x * c)).drop("_coefficients")


# A leaf as plain data: its distinct path features, their conditions (rule, goes left), and the contributions
# of those features for every bit mask of conditions met.
Leaf = tuple[list[int], list[list[tuple[object, bool]]], np.ndarray]


def _leaf(value: float, edges: list[tuple[int, object, bool, float]]) -> tuple[Leaf, float]:
    """The leaf's lookup table, and its share of the expected prediction."""
    shares: dict[int, float] = {}
    tests: dict[int, list[tuple[object, bool]]] = {}
    for feature, rule, left, share in edges:
        shares[feature] = shares.get(feature, 1.0) * share
        tests.setdefault(feature, []).append((rule, left))
    features = list(shares)
    k = len(features)
    z = np.array([shares[f] for f in features])
    weights = np.array([math.factorial(m) * math.factorial(k - m - 1) / math.factorial(k) for m in range(k)])
    table = np.zeros((1 << k, k))
    for mask in range(1 << k):
        met = np.array([(mask >> i) & 1 for i in range(k)], dtype=float)
        for f in range(k):
            poly = np.array([1.0])  # coefficient m sums over the subsets of m other features
            for j in range(k):
                if j != f:
                    poly = np.append(poly * z[j], 0.0) + np.append(0.0, poly * met[j])
            table[mask, f] = value * (met[f] - z[f]) * float(poly @ weights)
    return (features, [tests[f] for f in features], table), value * float(np.prod(z))


def _masks(leaf: Leaf, x: np.ndarray) -> np.ndarray:
    """Per row the bit mask of the leaf's path features whose conditions hold."""
    out = np.zeros(len(x), dtype=np.int64)
    for i, (feature, tests) in enumerate(zip(leaf[0], leaf[1])):
        met = np.ones(len(x), dtype=bool)
        for rule, left in tests:
            goes_left = np.isin(x[:, feature], list(rule)) if isinstance(rule, frozenset) else x[:, feature] <= rule
            met &= goes_left if left else ~goes_left
        out |= met.astype(np.int64) << i
    return out


def _leaves(nodes: dict[int, Row], weight: float) -> list[tuple[Leaf, float]]:
    out = []

    def walk(node_id: int, edges: list) -> None:
        node = nodes[node_id]
        if node["leftChild"] < 0:
            out.append(_leaf(weight * node["prediction"], edges))
            return
        split = node["split"]
        values = list(split["leftCategoriesOrThreshold"])
        rule = values[0] if split["numCategories"] < 0 else frozenset(values)
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            share = nodes[child]["rawCount"] / node["rawCount"]
            walk(child, [*edges, (split["featureIndex"], rule, left, share)])

    walk(0, [])
    return out


def tree_contributions(
    model, df: DataFrame, *, features: str = "features", keep: Sequence[str] = ("id",)
) -> tuple[DataFrame, float]:
    """Path-dependent tree SHAP values of a fitted tree ensemble (regression): array column, and the base value.

    contributions + base = prediction for every row. The trees are read from the saved model, shipped to the
    tasks, and turned into per-leaf lookup tables over 'which path conditions hold' - no recursion per row.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "trees")
    model.write().save(path)
    weights = list(model.treeWeights)
    trees: dict[int, dict[int, Row]] = {}
    for row in spark.read.parquet(f"{path}/data").collect():  # the model itself: bounded by trees x 2^depth
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    share = 1.0 / len(weights) if type(model).__name__.startswith("RandomForest") else 1.0
    leaves = [leaf for t, nodes in sorted(trees.items()) for leaf in _leaves(nodes, weights[t] * share)]
    base = float(sum(part for _, part in leaves))
    shipped = spark.sparkContext.broadcast([leaf for leaf, _ in leaves if leaf[0]])
    width, kept = model.numFeatures, list(keep)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.vstack(pdf["_x"].to_numpy()) if len(pdf) else np.zeros((0, width))
            phi = np.zeros((len(pdf), width))
            for leaf in shipped.value:
                phi[:, leaf[0]] += leaf[2][_masks(leaf, x)]
            yield pdf[kept].assign(contributions=list(phi))

    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("contributions", T.ArrayType(T.DoubleType()))])
    return df.select(*kept, vector_to_array(features).alias("_x")).mapInPandas(explain, schema), base


def item_contributions(explained: DataFrame, held: DataFrame, positions: DataFrame, *, id_col: str = "id") -> DataFrame:
    """(id, item, contribution) for the items each row has; ``positions(item, position)`` maps items to vector slots."""
    own = held.join(F.broadcast(positions), "item")
    return own.join(explained, id_col).select(
        id_col, "item", F.element_at("contributions", F.col("position") + 1).alias("contribution")
    )


def held_contributions(explained: DataFrame, positions: DataFrame, *, items: str = "items", keep: Sequence[str | Column] = ("id",)) -> DataFrame:
    """(keep, item, contribution) as `item_contributions`, for rows that `tree_contributions` kept together with their items: nothing is joined by id."""
    held = explained.select(*keep, "contributions", F.explode(items).alias("item"))
    own = held.join(F.broadcast(positions), "item")
    named = [c for c in held.columns if c != "contributions"]
    return own.select(*named, F.element_at("contributions", F.col("position") + 1).alias("contribution"))
