"""Which item to add next, for whole batches of profiles at once."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.ordered import exact_quantiles, row_ranks
from premia.operators.premium import contained
from premia.session import broadcast_checked, materialize
from premia.sources.results import keep_last

# Baskets of up to this many items are opened into their subsets, at most 1,023; a task of the pairwise step sorts
# about this many rows, some 120 bytes each.
SUBSETS_OF = 10
WAYS_PER_TASK = 500_000


def normalized(profiles: DataFrame) -> DataFrame:
    """profiles(profile, known) with sorted distinct known items."""
    return profiles.withColumn("known", F.array_sort(F.array_distinct("known")))


def exact(profiles: DataFrame, combos: DataFrame) -> DataFrame:
    """One more item: priced combinations that hold all known items and exactly one other.

    Every combination is turned into its (rest -> left-out item) steps; the match is then a plain
    equi-join of the sorted known array with the rest.
    """
    steps = combos.where(F.col("adjusted_premium").isNotNull()).select(
        "items", "adjusted_premium", "n_with", F.explode("items").alias("suggested")
    )
    steps = steps.select(
        F.array_sort(F.array_except("items", F.array("suggested"))).alias("known"), "suggested", "adjusted_premium", "n_with"
    )
    return normalized(profiles).join(broadcast_checked(materialize(steps)), "known").select(
        "profile", "suggested", "adjusted_premium", "n_with"
    )


def pairwise(profiles: DataFrame, combos: DataFrame, *, without: DataFrame | None = None) -> DataFrame:
    """Candidates from priced pairs with a known item: premium weighted by the pairs' row counts.

    A profile meets every priced pair of each known item and is opened into far more rows than its bytes tell. These rows are
    counted first, and profiles are dealt over as many tasks as that takes; the groups keep this partitioning. Profiles
    that ``without`` holds are left out. ``profiles`` is read twice: pass a written table.
    """
    pairs = combos.where((F.size("items") == 2) & F.col("adjusted_premium").isNotNull())
    a, b = F.element_at("items", 1), F.element_at("items", 2)
    ways = F.explode(F.array(F.struct(a.alias("item"), b.alias("suggested")), F.struct(b.alias("item"), a.alias("suggested"))))
    steps = pairs.select("adjusted_premium", "n_with", ways.alias("w")).select("w.*", "adjusted_premium", "n_with")
    steps = materialize(steps)
    listed = profiles.select(F.explode(F.array_distinct("known")).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("profiles"))
    ways = listed.join(steps, "item").agg(F.coalesce(F.sum("profiles"), F.lit(0)).alias("n")).first()["n"]
    if without is not None:
        profiles = profiles.join(without.select("profile").distinct(), "profile", "left_anti")
    dealt = normalized(profiles).repartition(max(1, math.ceil(ways / WAYS_PER_TASK)), "profile")
    known = dealt.select("profile", "known", F.explode("known").alias("item"))
    return (
        known.join(broadcast_checked(steps), "item")
        .where(~F.array_contains("known", F.col("suggested")))
        .groupBy("profile", "suggested")
        .agg(
            (F.sum(F.col("adjusted_premium") * F.col("n_with")) / F.sum("n_with")).alias("adjusted_premium"),
            F.sum("n_with").alias("n_with"),
            F.array_join(F.array_sort(F.collect_set("item")), ", ").alias("based_on"),
        )
    )


def recommend(profiles: DataFrame, combos: DataFrame) -> DataFrame:
    """All suggestions with their mode: exact where a profile has any, pairwise for the others."""
    profiles, combos = materialize(profiles), materialize(combos)
    first = materialize(exact(profiles, combos))
    second = pairwise(profiles, combos, without=first)
    return first.withColumn("based_on", F.lit(None).cast("string")).withColumn("mode", F.lit("exact")).unionByName(
        second.withColumn("mode", F.lit("pairwise"))
    )


def modes(profiles: DataFrame, recommended: DataFrame) -> DataFrame:
    """(profile, mode, n): exact / pairwise / none for every profile."""
    per = recommended.groupBy("profile").agg(F.first("mode").alias("mode"), F.count(F.lit(1)).alias("n"))
    return profiles.select("profile").join(per, "profile", "left").select(
        "profile", F.coalesce("mode", F.lit("none")).alias("mode"), F.coalesce("n", F.lit(0)).alias("n")
    )


def rules_for(profiles: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules whose antecedent is known and whose consequent is not (entirely). Order by lift when reporting."""
    keyed = rules.withColumn("_member", F.element_at("antecedent", 1))
    known = normalized(profiles).select("profile", "known", F.explode("known").alias("_member"))
    return (
        known.join(broadcast_checked(materialize(keyed)), "_member")
        .where((F.size(F.array_except("antecedent", "known")) == 0) & (F.size(F.array_except("consequent", "known")) > 0))
        .drop("_member", "known")
    )


def own_values(profiles: DataFrame, singles: DataFrame) -> DataFrame:
    """Known items with their own premium and its position among all priced single items."""
    ranked = row_ranks(singles.where(F.col("adjusted_premium").isNotNull()), [], "adjusted_premium", "item")
    known = normalized(profiles).select("profile", F.explode("known").alias("item"))
    return known.join(ranked.select("item", "adjusted_premium", "rank"), "item")


def unpaired(profiles: DataFrame, combos: DataFrame) -> DataFrame:
    """Known items that no priced combination holds."""
    held = combos.where(F.col("adjusted_premium").isNotNull()).select(F.explode("items").alias("item")).distinct()
    return normalized(profiles).select("profile", F.explode("known").alias("item")).join(held, "item", "left_anti")


def rows_with_all(baskets: DataFrame, profiles: DataFrame, *, rarity: DataFrame | None = None) -> DataFrame:
    """Basket rows holding every known item of a profile, per profile."""
    wanted = normalized(profiles).select("profile", F.col("known").alias("items"), F.lit(0).alias("freq"))
    return contained(baskets, wanted, key="profile", rarity=rarity)


def count_rows_with_all(baskets: DataFrame, profiles: DataFrame, *, items: str = "items", rarity: DataFrame | None = None) -> DataFrame:
    """(profile, rows): how many basket rows hold every known item of a profile.

    Equal baskets and equal known sets are counted first. A distinct basket of up to ``SUBSETS_OF`` items is opened into its
    subsets, which are added up and met by equality: the work grows with the baskets, not with baskets times known sets. Larger
    baskets go through the containment join.
    """
    known = materialize(normalized(profiles).select("profile", F.col("known").alias("_set")))
    whole = baskets.schema[items].dataType.simpleString()
    plain = F.array_sort(F.array_distinct(F.array_compact(items))).cast(whole)
    distinct = materialize(baskets.groupBy(plain.alias("items")).agg(F.count(F.lit(1)).alias("_n")).where(F.size("items") > 0))
    none = F.array(F.array().cast(whole))
    subsets = F.aggregate("items", none, lambda made, x: F.concat(made, F.transform(made, lambda s: F.concat(s, F.array(x)))))
    small = distinct.where(F.size("items") <= SUBSETS_OF).repartition(2 * baskets.sparkSession.sparkContext.defaultParallelism)
    found = small.select(F.explode(subsets).alias("_set"), "_n").where(F.size("_set") > 0).groupBy("_set").agg(F.sum("_n").alias("rows"))
    large = distinct.where(F.size("items") > SUBSETS_OF)
    if not large.isEmpty():
        wanted = known.groupBy("_set").agg(F.lit(0).alias("freq")).withColumn("items", F.col("_set"))
        more = contained(large, wanted, key="_set", rarity=rarity).groupBy("_set").agg(F.sum("_n").alias("rows"))
        found = found.unionByName(more).groupBy("_set").agg(F.sum("rows").alias("rows"))
    return known.join(found, "_set").select("profile", "rows")


def subset_profile(
    rows: DataFrame, in_subset: Column, *, value: str, shares: dict[str, Column]
) -> DataFrame:
    """(population, measure, value): exact quartiles of the value and shares of conditions, subset next to all rows."""
    populations = F.filter(F.array(F.lit("all"), F.when(in_subset, F.lit("subset"))), lambda p: p.isNotNull())
    tagged = rows.select(F.col(value), *[c.alias(n) for n, c in shares.items()], F.explode(populations).alias("population"))
    quartiles = exact_quantiles(tagged, ["population"], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    rates = tagged.groupBy("population").agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        *[F.avg(F.when(F.col(n), 1.0).otherwise(0.0)).alias(n) for n in shares],
    )
    wide = quartiles.drop("n").join(rates, "population")
    measures = [c for c in wide.columns if c != "population"]
    return wide.unpivot("population", measures, "measure", "value")


def colisted(rows: DataFrame, chosen: Sequence[str], *, items: str = "items", top: int = 8) -> DataFrame:
    """The items most often listed next to the chosen ones, with their share of the rows."""
    n = rows.agg(F.count(F.lit(1))).scalar()
    listed = rows.select(F.explode(items).alias("item")).where(~F.col("item").isin(list(chosen)))
    counted = listed.groupBy("item").agg(F.count(F.lit(1)).alias("rows"))
    return counted.orderBy(F.desc("rows"), "item").limit(top).withColumn("share", F.col("rows") / n)


def most_recent(rows: DataFrame, group: str, time: str, id_col: str, n: int = 5) -> DataFrame:
    """The newest row of every group, then the n newest of those."""
    return keep_last(rows, [group], time, id_col).orderBy(F.desc(time), F.desc(id_col)).limit(n)
