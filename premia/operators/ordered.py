"""Order statistics that never sort one group in one task.

Every operator first collapses equal values by a partial aggregate, then - only if the collapsed table is
counted to be large - cuts the value range at approximate quantiles. Running totals are then exact: totals
of the earlier ranges plus a window inside the own range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.hashing import HASH_SPACE
from premia.session import materialize

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 4096
MAX_HASH_RANGES = 1 << 17


def _with_range(df: DataFrame, value: str, ranges: int) -> DataFrame:
    cuts = df.approxQuantile(value, [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    number = df.withColumn("_double", F.col(value).cast("double"))
    cut = Bucketizer(splits=splits, inputCol="_double", outputCol="_range").transform(number)
    return cut.drop("_double")


def distinct_values(df: DataFrame, group: Sequence[str], value: str, sums: dict[str, Column]) -> DataFrame:
    """One row per (group, distinct non-null value) with its sums; written, as every order statistic reads it twice."""
    aggregates = [F.sum(c).alias(name) for name, c in sums.items()]
    return materialize(df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(*aggregates))


def running_totals(
    table: DataFrame,
    group: Sequence[str],
    value: str,
    sums: Sequence[str],
    *,
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """`distinct_values` with ``cum_<sum>`` (up to and including the value, in value order) and ``all_<sum>``."""
    group = list(group)
    ranges = min(MAX_RANGES, table.count() // rows_per_range + 1)
    order = F.col(value).desc() if descending else F.col(value).asc()
    if ranges == 1:
        whole = Window.partitionBy(*group)
        upto = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return table.select(
            "*", *[F.sum(n).over(upto).alias(f"cum_{n}") for n in sums], *[F.sum(n).over(whole).alias(f"all_{n}") for n in sums]
        )

    table = _with_range(table, value, ranges)
    # Offsets: one row per (group, range), so at most `ranges` rows per group.
    per_range = table.groupBy(*group, "_range").agg(*[F.sum(n).alias(f"_t_{n}") for n in sums])
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(F.col("_range").desc() if descending else F.col("_range").asc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_range.select(
        *group, "_range",
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(whole).alias(f"all_{n}") for n in sums],
    )
    inside = Window.partitionBy(*group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        table.select("*", *[F.sum(n).over(inside).alias(f"_i_{n}") for n in sums])
        .join(offsets, [*group, "_range"])
        .select(
            *group, value, *sums, *[(F.col(f"_i_{n}") + F.col(f"_o_{n}")).alias(f"cum_{n}") for n in sums], *[f"all_{n}" for n in sums]
        )
    )


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    *,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one output column per named probability, and ``n``."""
    keyed, keys = _keyed(df, group)
    table = distinct_values(keyed, keys, value, {"cnt": F.lit(1)})
    placed = running_totals(table, keys, value, ["cnt"], rows_per_range=rows_per_range).withColumnRenamed("all_cnt", "n")
    first, last = F.col("cum_cnt") - F.col("cnt"), F.col("cum_cnt") - 1
    picks = []
    for name, p in probabilities.items():
        low = F.floor(F.lit(p) * (F.col("n") - 1))
        high = F.least(low + 1, F.col("n") - 1)
        for tag, position in (("lo", low), ("hi", high)):
            hit = (first <= position) & (position <= last)
            picks.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{tag}_{name}"))
    found = placed.groupBy(*keys).agg(F.max("n").alias("n"), *picks)
    outputs = []
    for name, p in probabilities.items():
        position = F.lit(p) * (F.col("n") - 1)
        fraction = position - F.floor(position)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outputs.append((lo + (hi - lo) * fraction).alias(name))
    return found.select(*group, "n", *outputs)


def average_ranks(
    df: DataFrame, group: Sequence[str], value: str, name: str = "avg_rank", *, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``df`` with the average rank of its value inside the group (ties share the mean rank); nulls unranked."""
    keyed, keys = _keyed(df, group)
    table = distinct_values(keyed, keys, value, {"cnt": F.lit(1)})
    totals = running_totals(table, keys, value, ["cnt"], rows_per_range=rows_per_range)
    rank = F.col("cum_cnt") - F.col("cnt") + (F.col("cnt") + 1) / F.lit(2.0)
    ranks = totals.select(*keys, value, rank.alias(name))
    return keyed.join(ranks, [*keys, value], "left").select(*df.columns, name)


def min_ranks(
    df: DataFrame, group: Sequence[str], value: str, name: str = "rank", *, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``df`` with the descending competition rank of its value (ties share the best rank); nulls unranked."""
    keyed, keys = _keyed(df, group)
    table = distinct_values(keyed, keys, value, {"cnt": F.lit(1)})
    totals = running_totals(table, keys, value, ["cnt"], descending=True, rows_per_range=rows_per_range)
    ranks = totals.select(*keys, value, (F.col("cum_cnt") - F.col("cnt") + 1).alias(name))
    return keyed.join(ranks, [*keys, value], "left").select(*df.columns, name)


def row_ranks(
    df: DataFrame, group: Sequence[str], value: str, tie: str, name: str = "rank", *, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``df`` (values not null) with its position by descending value, equal values ordered by ``tie``.

    For vocabulary-sized tables: the rows of one exact value are ordered within one task.
    """
    first = min_ranks(df.where(F.col(value).isNotNull()), group, value, "_first", rows_per_range=rows_per_range)
    among_equal = Window.partitionBy(*group, value).orderBy(tie)
    return first.withColumn(name, F.col("_first") + F.row_number().over(among_equal) - 1).drop("_first")


def dense_index(
    df: DataFrame, hash_col: str, tie: str, name: str = "idx", *, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Global row numbers 0..n-1 in (hash, tie) order, numbered range by range of the uniform 32-bit hash.

    The number of ranges follows the counted rows, so a task sorts about ``rows_per_range`` of them.
    """
    ranges = min(MAX_HASH_RANGES, df.count() // rows_per_range + 1)
    ranged = df.withColumn("_range", F.floor(F.col(hash_col) * F.lit(ranges) / F.lit(HASH_SPACE)).cast("int"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy(hash_col, tie)
    return (
        ranged.withColumn("_pos", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_pos") + F.col("_before")).cast("bigint"))
        .drop("_range", "_pos", "_before")
    )


def _keyed(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame and its group keys; a constant key stands in when there is none."""
    return (df, list(group)) if group else (df.withColumn("_all", F.lit(0)), ["_all"])
