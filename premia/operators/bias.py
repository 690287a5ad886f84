"""Does the usable subset look like the population it came from?"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_ITEM_COUNT = 45


def category_shares(full: DataFrame, subset: DataFrame, category: str) -> DataFrame:
    """(category, n_full, n_subset, shares in percent, difference in points); a category absent on a side counts 0."""
    a = full.where(F.col(category).isNotNull()).groupBy(category).agg(F.count(F.lit(1)).alias("n_full"))
    b = subset.where(F.col(category).isNotNull()).groupBy(category).agg(F.count(F.lit(1)).alias("n_subset"))
    both = a.join(b, category, "full").na.fill(0, ["n_full", "n_subset"])
    all_full, all_subset = both.agg(F.sum("n_full")).scalar(), both.agg(F.sum("n_subset")).scalar()
    full_pct = F.try_divide(F.col("n_full") * F.lit(100.0), all_full)
    subset_pct = F.try_divide(F.col("n_subset") * F.lit(100.0), all_subset)
    return both.select(
        category, "n_full", "n_subset", full_pct.alias("full_pct"), subset_pct.alias("subset_pct"),
        (subset_pct - full_pct).alias("point_diff"),
    )


def chi2_sf(statistic: float, df: int) -> float:
    """Upper tail of the chi-square distribution, by the series / continued fraction of the incomplete gamma."""
    a, x = df / 2.0, statistic / 2.0
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * scale)
    b = x + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        step = c * d
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return scale * h


def p_value(statistic: str, dof: str) -> Column:
    """Chi-square p-value column (a Python helper: it sees one row per test, never the data)."""
    def tail(s: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([chi2_sf(x, int(k)) if k > 0 else float("nan") for x, k in zip(s, d)])

    return F.pandas_udf(tail, "double")(statistic, dof)


def chi_square(shares: DataFrame, *, alpha: float = 0.05) -> DataFrame:
    """Goodness of fit of the subset's counts to the full shares: statistic, degrees of freedom, p, verdict.

    Categories the population does not hold (expected 0) are left out.
    """
    expected = F.col("full_pct") / 100 * shares.agg(F.sum("n_subset")).scalar()
    cell = shares.where(F.col("n_full") > 0).select("n_subset", expected.alias("e"))
    stat = F.sum((F.col("n_subset") - F.col("e")) * (F.col("n_subset") - F.col("e")) / F.col("e"))
    out = cell.agg(stat.alias("statistic"), (F.count(F.lit(1)) - 1).alias("dof"))
    return out.withColumn("p_value", p_value("statistic", "dof")).withColumn("differs", F.col("p_value") < alpha)


def item_ratio(
    tagged: DataFrame, subset: DataFrame, *, items: str = "items", min_count: int = MIN_ITEM_COUNT,
    rounded: bool = True,
) -> DataFrame:
    """Share of baskets holding each item, in the subset against all tagged rows, and their ratio.

    ``rounded`` divides the shares after rounding them to two decimals, as the published tables do.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias(name))

    n_tagged, n_subset = tagged.agg(F.count(F.lit(1))).scalar(), subset.agg(F.count(F.lit(1))).scalar()
    joined = (
        counts(tagged, "n_t").where(F.col("n_t") >= min_count)
        .join(counts(subset, "n_s"), "item", "left").na.fill(0, ["n_s"])
    )
    tagged_pct, subset_pct = F.col("n_t") * 100.0 / n_tagged, F.try_divide(F.col("n_s") * F.lit(100.0), n_subset)
    if rounded:
        tagged_pct, subset_pct = F.round(tagged_pct, 2), F.round(subset_pct, 2)
    out = joined.select("item", tagged_pct.alias("tagged_pct"), subset_pct.alias("subset_pct"))
    return out.withColumn("ratio", F.try_divide("subset_pct", "tagged_pct"))


def extremes(df: DataFrame, column: str, tie: str, n: int = 10) -> DataFrame:
    """The n highest and the n lowest rows, labelled; two top-k scans, no global sort."""
    high = df.where(F.col(column).isNotNull()).orderBy(F.desc(column), tie).limit(n).withColumn("side", F.lit("top"))
    low = df.where(F.col(column).isNotNull()).orderBy(F.asc(column), tie).limit(n).withColumn("side", F.lit("bottom"))
    return high.unionByName(low)
