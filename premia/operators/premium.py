"""Set containment and stratified (confound-adjusted) mean differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.session import BROADCAST_MAX_ROWS, broadcast_checked, materialize

# Rows needed on each side of a stratum, strata needed for an adjusted value.
MIN_STRATUM_N = 5
MIN_STRATA_USED = 2


def with_anchor(itemsets: DataFrame, key: str, rarity: DataFrame | None = None) -> DataFrame:
    """Each itemset with its rarest member: the one item every match has to hold.

    Rarity is read from ``rarity(item, freq)``, or from the one-item sets of the table itself (mined tables
    are downward closed).
    """
    if rarity is None:
        single = itemsets.where(F.size("items") == 1).select(
            F.element_at("items", 1).alias("_item"), F.col("freq").alias("_freq")
        )
    else:
        single = rarity.select(F.col("item").alias("_item"), F.col("freq").alias("_freq"))
    members = itemsets.select(key, "items", F.explode("items").alias("_item"))
    rarest = F.min_by("_item", F.struct(F.coalesce("_freq", F.lit(0)), "_item"))
    return members.join(single, "_item", "left").groupBy(key, "items").agg(rarest.alias("anchor"))


def contained(
    baskets: DataFrame,
    itemsets: DataFrame,
    *,
    key: str = "itemset",
    items: str = "items",
    rarity: DataFrame | None = None,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Rows of ``baskets`` paired with every itemset they contain (itemset is a subset of the basket).

    Equi-join on the itemset's rarest member, then a row-local check: each pair is met once, so neither a
    nested loop nor a counting shuffle is needed. Counted-small itemset tables are broadcast; larger ones
    are shuffled on the anchor. Output: the basket columns except ``items``, plus ``key``.
    """
    anchored = with_anchor(itemsets, key, rarity)
    others = F.array_except("items", F.array("anchor"))
    small = broadcast_checked(materialize(anchored.select(key, "anchor", others.alias("_others"))), max_broadcast_rows)
    kept = [c for c in baskets.columns if c != items]
    # Most candidates fail on their first other member: one cheap look-up before the full difference.
    first = F.array_contains(items, F.try_element_at("_others", F.lit(1)))
    whole = (F.size("_others") == 1) | (F.size(F.array_except("_others", items)) == 0)
    return (
        baskets.withColumn("anchor", F.explode(items))
        .join(small, "anchor")
        .where(F.when(F.size("_others") == 0, True).otherwise(first & whole))
        .select(*kept, key)
    )


def summable(df: DataFrame, value: str) -> Column:
    """Integral values are summed as decimals: exact, and no overflow at any table size."""
    if isinstance(df.schema[value].dataType, T.IntegralType):
        return F.col(value).cast("decimal(20,0)")
    return F.col(value)


def stratum_key(strata: Sequence[str], name: str = "stratum") -> Column:
    """One struct of the stratum columns, for use as a group key."""
    return F.struct(*strata).alias(name)


def cell_table(
    facts: DataFrame, matches: DataFrame, *, key: str, value: str, strata: Sequence[str], weight: str | None = None,
    by: Sequence[str] = (), weighted: str | None = None,
) -> DataFrame:
    """Per (itemset, stratum): rows and value sums with the itemset, and of the whole stratum.

    The 'without' side is the difference, so the facts are read once for the totals and never per itemset.
    ``weight`` counts a row several times; ``by`` adds leading group columns (bootstrap replicates). ``weighted`` names
    a column that already holds value times weight, summed over equal rows.
    Strata with a null part keep their 'with' counts but have no totals.
    """
    strata, by = list(strata), list(by)
    w = F.col(weight) if weight else F.lit(1)

    def sums(df: DataFrame, n: str, s: str) -> list[Column]:
        if weighted:
            return [F.sum(w).cast("bigint").alias(n), F.sum(weighted).alias(s)]
        v = summable(df, value)
        return [F.sum(w).cast("bigint").alias(n), F.sum(v * w if weight else v).alias(s)]

    complete = F.lit(True)
    for c in strata:
        complete = complete & F.col(c).isNotNull()
    totals = facts.where(complete).groupBy(*by, *strata).agg(*sums(facts, "n_all", "sum_all"))
    having = matches.groupBy(*by, key, *strata).agg(*sums(matches, "n_with", "sum_with"))
    return having.join(totals, [*by, *strata], "left").withColumn("n_out", F.col("n_all") - F.col("n_with"))


def mean_difference() -> Column:
    """mean(with) - mean(without) of a cell; null unless both sides have rows."""
    mean_with = F.col("sum_with").cast("double") / F.col("n_with")
    mean_out = (F.col("sum_all") - F.col("sum_with")).cast("double") / F.col("n_out")
    return F.when(F.col("n_out") > 0, mean_with - mean_out)


def adjusted_at(min_n: int, min_strata: int) -> dict[str, Column]:
    """Aggregates of a cell table: strata used, rows covered and the weighted mean difference at one threshold."""
    used = F.coalesce((F.col("n_with") >= min_n) & (F.col("n_out") >= min_n), F.lit(False))
    n_used = F.sum(F.when(used, F.col("n_with")))
    cells = F.sum(F.when(used, 1).otherwise(0)).cast("bigint")
    weighted = F.sum(F.when(used, F.col("n_with") * mean_difference()))
    return {
        "cells": cells,
        "covered": F.coalesce(n_used, F.lit(0)),
        "premium": F.when((cells >= min_strata) & (n_used > 0), weighted / n_used),
    }


def stratified_premium(
    facts: DataFrame,
    matches: DataFrame,
    *,
    key: str = "itemset",
    value: str,
    strata: Sequence[str],
    min_n: int = MIN_STRATUM_N,
    min_strata: int = MIN_STRATA_USED,
) -> DataFrame:
    """Raw and stratum-adjusted mean difference of ``value`` with vs without each itemset.

    ``facts`` holds one row per entity, ``matches`` the same rows once per itemset they contain.
    Entities with a null stratum count in ``n_with`` and the raw difference but in no stratum.
    Itemsets held by every entity have no 'without' side and are left out.
    """
    cells = cell_table(facts, matches, key=key, value=value, strata=strata)
    whole = facts.agg(
        F.count(F.lit(1)).alias("n"), F.sum(summable(facts, value)).alias("s")
    )
    n_with, sum_with = F.sum("n_with"), F.sum("sum_with")
    at = adjusted_at(min_n, min_strata)
    rolled = cells.groupBy(key).agg(
        n_with.alias("n_with"),
        sum_with.alias("_sum_with"),
        at["premium"].alias("adjusted_premium"),
        at["cells"].alias("strata_used"),
    ).withColumn("_n", whole.select("n").scalar()).withColumn("_s", whole.select("s").scalar())
    without = F.col("_n") - F.col("n_with")
    raw = F.col("_sum_with").cast("double") / F.col("n_with") - (F.col("_s") - F.col("_sum_with")).cast("double") / without
    return rolled.where(without > 0).select(key, "n_with", raw.alias("raw_premium"), "adjusted_premium", "strata_used")


def synergy(priced: DataFrame, itemsets: DataFrame, *, key: str = "itemset") -> DataFrame:
    """Priced combinations (two items and more) against their best individually priced member."""
    named = priced.join(itemsets.select(key, "items"), key)
    single = named.where(F.size("items") == 1).select(
        F.element_at("items", 1).alias("_item"), F.col("adjusted_premium").alias("_single")
    )
    best = (
        named.where(F.size("items") >= 2)
        .select(key, F.explode("items").alias("_item"))
        .join(single, "_item", "left")
        .groupBy(key)
        .agg(F.max("_single").alias("best_individual_premium"))
    )
    return (
        named.where(F.size("items") >= 2)
        .join(best, key)
        .withColumn("synergy", F.col("adjusted_premium") - F.col("best_individual_premium"))
    )


def value_table(
    facts: DataFrame, itemsets: DataFrame, *, value: str, strata: Sequence[str], items: str = "items", **thresholds
) -> DataFrame:
    """Mined itemsets (items, freq, size) priced end to end; singles carry a null synergy.

    ``facts`` is read three times (matches, stratum totals, grand total): pass a written table.
    """
    named = itemsets.withColumn("itemset", F.array_join("items", "\u0001"))
    narrow = facts.select(value, *strata, items)
    priced = materialize(
        stratified_premium(narrow, contained(narrow, named, items=items), value=value, strata=strata, **thresholds)
    )
    singles = priced.join(named.where(F.size("items") == 1), "itemset").select(
        "items", "size", "freq", "n_with", "raw_premium", "adjusted_premium", "strata_used",
        F.lit(None).cast("double").alias("best_individual_premium"), F.lit(None).cast("double").alias("synergy"),
    )
    combos = synergy(priced, named).join(named.select("itemset", "freq", "size"), "itemset").select(*singles.columns)
    return singles.unionByName(combos)
