"""Baskets, frequent itemsets, association rules, co-occurrence."""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.items import pairs_of
from premia.session import broadcast_checked, materialize

# How far itemsets are counted level by level.
SUBSETS_PER_ITEM = 64
FILTER_ITEMS = 5_000


class Mined(NamedTuple):
    itemsets: DataFrame  # items array<string> (sorted), freq bigint, size int
    rules: DataFrame  # antecedent, consequent array<string>; confidence, lift, support
    n: int  # number of baskets


def item_counts(baskets: DataFrame, items: str = "items") -> DataFrame:
    """How many baskets (or mentions, if repeats are kept) hold each item."""
    return baskets.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("freq"))


def top_items(baskets: DataFrame, n: int, items: str = "items") -> DataFrame:
    """The n most frequent usable items; equal counts are ordered by name."""
    usable = F.col("item").isNotNull() & ~F.col("item").isin("", "unknown")
    return item_counts(baskets, items).where(usable).orderBy(F.desc("freq"), "item").limit(n)


def floor_items(baskets: DataFrame, min_count: int, items: str = "items") -> DataFrame:
    """Items in at least ``min_count`` baskets."""
    return item_counts(baskets, items).where(F.col("freq") >= min_count)


def collect_baskets(
    rows: DataFrame, id_col: str, item_col: str, *, vocabulary: DataFrame | None = None
) -> DataFrame:
    """(id, item) rows to one sorted distinct array per id, combined map-side.

    With a ``vocabulary(item)`` only its items are kept (ids left without any stay, with an empty array),
    which bounds every array by the vocabulary whatever the number of rows of one id.
    """
    keyed = rows.select(id_col, F.col(item_col).alias("item"))
    if vocabulary is not None:
        known = broadcast_checked(materialize(vocabulary.select("item").distinct()).withColumn("_known", F.lit(True)))
        keyed = keyed.join(known, "item", "left").withColumn("item", F.when(F.col("_known"), F.col("item")))
    return keyed.groupBy(id_col).agg(F.array_sort(F.collect_set("item")).alias("items"))


def mine(
    baskets: DataFrame, *, items: str = "items", min_support: float = 0.01, min_confidence: float = 0.4
) -> Mined:
    """Frequent itemsets and one-consequent rules.

    Equal baskets are counted first, and itemsets are counted level by level over distinct baskets, combined map-side. Where
    baskets are so long that a level would open more than ``SUBSETS_PER_ITEM`` subsets per item, or items so many that they
    do not fit a filter, Spark's parallel FP-growth finds the same itemsets.

    ``baskets`` is read more than once: pass a written table (`materialize`) or a cached frame.
    The itemsets come back written, so that every later step reads the finished table.
    """
    found = _by_levels(baskets, items, min_support)
    if found is None:
        model = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence).fit(baskets.select(items))
        found = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    itemsets = materialize(found.select("items", "freq", F.size("items").alias("size")))
    n = baskets.count()
    return Mined(itemsets, association_rules(itemsets, n, min_confidence), n)


def _by_levels(baskets: DataFrame, items: str, min_support: float) -> DataFrame | None:
    """(items, freq) of all frequent itemsets, or None where FP-growth is the better way."""
    plain = F.array_distinct(F.array_compact(items))
    known = baskets.where(F.col(items).isNotNull())
    least = min_count_for(min_support, known.count())
    singles = materialize(item_counts(known.select(plain.alias("items"))).where(F.col("freq") >= least))
    if singles.count() > FILTER_ITEMS:
        return None
    frequent = [r["item"] for r in singles.select("item").collect()]
    levels = [singles.select(F.array("item").cast(baskets.schema[items].dataType).alias("items"), "freq")]
    rest = known.select(plain.alias("items"), F.lit(1).alias("w"))
    k = 2
    while len(frequent) >= k:
        kept = F.array_sort(F.filter("items", lambda x: x.isin(frequent)))  # noqa: B023
        rest = rest.select(kept.alias("items"), "w").where(F.size("items") >= k).groupBy("items").agg(F.sum("w").alias("w"))
        rest = materialize(rest)
        opened = sum((_binomial(F.size("items"), j) for j in range(1, k + 1)), F.lit(0.0))
        work = rest.agg(F.sum(opened).alias("subsets"), F.sum(F.size("items")).alias("items")).first()
        if not work["items"]:
            break
        if work["subsets"] > SUBSETS_PER_ITEM * work["items"]:
            return None
        if k == 2:
            each = F.transform(pairs_of(F.col("items")), lambda p: F.array(p["a"], p["b"]))
        else:
            none = F.array(F.array().cast(rest.schema["items"].dataType))
            longer = lambda made, x: F.concat(made, F.transform(F.filter(made, lambda s: F.size(s) < k), lambda s: F.concat(s, F.array(x))))  # noqa: B023, E731
            each = F.filter(F.aggregate("items", none, longer), lambda s: F.size(s) == k)  # noqa: B023
        spread_out = rest.repartition(2 * baskets.sparkSession.sparkContext.defaultParallelism)
        counted = spread_out.select(F.explode(each).alias("items"), "w").groupBy("items").agg(F.sum("w").alias("freq"))
        level = materialize(counted.where(F.col("freq") >= least))
        levels.append(level.select(F.col("items").cast(baskets.schema[items].dataType).alias("items"), "freq"))
        # an itemset of k + 1 needs each of its items in k frequent ones of k
        frequent = [r["item"] for r in item_counts(level).where(F.col("freq") >= k).select("item").collect()]
        k += 1
    return reduce(DataFrame.unionByName, levels)


def _binomial(n: Column, k: int) -> Column:
    out = F.lit(1.0)
    for i in range(k):
        out = out * (n - i) / (i + 1)
    return F.greatest(out, F.lit(0.0))


def association_rules(itemsets: DataFrame, n: int, min_confidence: float = 0.4) -> DataFrame:
    """Rules antecedent -> one item from a frequent-itemset table, by equi-joins on the sorted arrays."""
    known = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_freq_a"))
    single = itemsets.where(F.size("items") == 1).select(
        F.col("items").alias("consequent"), F.col("freq").alias("_freq_c")
    )
    candidates = itemsets.where(F.size("items") >= 2).select(
        "items", "freq", F.explode("items").alias("_c")
    ).select(
        F.array_except("items", F.array("_c")).alias("antecedent"), F.array("_c").alias("consequent"), "freq"
    )
    confidence = F.col("freq") / F.col("_freq_a")
    return (
        candidates.join(known, "antecedent")
        .join(single, "consequent")
        .where(confidence >= min_confidence)
        .select(
            "antecedent",
            "consequent",
            confidence.alias("confidence"),
            (confidence / (F.col("_freq_c") / F.lit(n))).alias("lift"),
            (F.col("freq") / F.lit(n)).alias("support"),
        )
    )


def min_count_for(min_support: float, n: int) -> int:
    return math.ceil(min_support * n)


def cooccurrence(
    rows: DataFrame, id_col: str, item_col: str, top_n: int, *, seed_items: int = 64
) -> DataFrame:
    """The ``top_n`` item pairs (a <= b) by number of co-mentions, exactly, repeats inside an id counted.

    An item's pairs can never outnumber its own bound (mentions times the id's largest repeat count), so the
    pairs among the ``seed_items`` most frequent items give a floor, and only items whose bound reaches the
    floor take part in the full count. Baskets are paired by an equi-join on the id after that pruning.
    """
    per_id = materialize(rows.groupBy(id_col, F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("m")))
    largest = F.max("m").over(Window.partitionBy(id_col))  # over an id's distinct items
    bounds = materialize(
        per_id.withColumn("_top", largest).groupBy("item").agg(F.sum(F.col("m") * F.col("_top")).alias("bound"))
    )

    def count_pairs(items: DataFrame) -> DataFrame:
        kept = per_id.join(broadcast_checked(items), "item", "left_semi")
        left = kept.select(id_col, F.col("item").alias("a"), F.col("m").alias("ma"))
        right = kept.select(id_col, F.col("item").alias("b"), F.col("m").alias("mb"))
        twice = F.when(F.col("a") == F.col("b"), F.col("ma") * (F.col("ma") - 1) / 2).otherwise(F.col("ma") * F.col("mb"))
        return (
            left.join(right, id_col)
            .where(F.col("a") <= F.col("b"))
            .groupBy("a", "b")
            .agg(F.sum(twice).cast("bigint").alias("pairs"))
            .where(F.col("pairs") > 0)
        )

    def best(items: DataFrame) -> DataFrame:
        return count_pairs(items).orderBy(F.desc("pairs"), "a", "b").limit(top_n)

    total_items = bounds.count()
    if total_items > seed_items:
        seed = bounds.orderBy(F.desc("bound"), "item").limit(seed_items).select("item")
        floor = best(materialize(seed)).agg(F.count(F.lit(1)).alias("n"), F.min("pairs").alias("least")).first()
        if floor["n"] == top_n:
            bounds = bounds.where(F.col("bound") >= floor["least"])
    return best(materialize(bounds.select("item")))
