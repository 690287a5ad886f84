"""Completeness by inner value, duplicates by id and content, blended score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.prep import DEDUP_KEY, content_key


def posting_missing() -> dict[str, Column]:
    """When a posting field counts as missing: the value inside decides, never the container."""
    low, high = F.col("salary")["from"], F.col("salary")["to"]
    return {
        "id": F.col("id").isNull(),
        "name": F.col("name").isNull(),
        "employer": F.col("employer.name").isNull(),
        "area": F.col("area.name").isNull(),
        "salary": low.isNull() | high.isNull(),
        "items": F.col("key_skills").isNull() | (F.size("key_skills") == 0),
    }


def missing_by_field(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, missing, rows, rate), one pass over the frame."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(cond, 1)).alias(name) for name, cond in fields.items()]
    )
    rows = [F.struct(F.lit(n).alias("field"), F.col(n).alias("missing"), F.col("_rows").alias("rows")) for n in fields]
    return counted.select(F.explode(F.array(*rows)).alias("x")).select(
        "x.*", F.try_divide(F.col("x.missing"), F.col("x.rows")).alias("rate")
    )


def duplicate_counts(df: DataFrame, *, id_col: str = "id", columns: Sequence[str] = DEDUP_KEY) -> DataFrame:
    """One row: rows, rows beyond the first of their id, rows beyond the first of their content (nulls equal)."""
    keyed = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("\u0002")).alias("_id"), content_key(columns).alias("_c"))
    rows = F.count(F.lit(1))
    return keyed.agg(
        rows.alias("rows"),
        (rows - F.countDistinct("_id")).alias("id_duplicates"),
        (rows - F.countDistinct("_c")).alias("content_duplicates"),
    )


def quality_score(df: DataFrame, fields: dict[str, Column], **duplicates) -> DataFrame:
    """One row: completeness, duplicate rate and 100 * (completeness + uniqueness) / 2."""
    totals = missing_by_field(df, fields).agg(F.sum("missing").alias("m"), F.sum("rows").alias("cells"))
    counted = duplicate_counts(df, **duplicates)
    return (
        counted.withColumn("_m", totals.select("m").scalar())
        .withColumn("_cells", totals.select("cells").scalar())
        .select(
            (1 - F.try_divide("_m", "_cells")).alias("completeness"),
            F.try_divide("content_duplicates", "rows").alias("duplicate_rate"),
        )
        .withColumn("score", (F.col("completeness") * 0.5 + (1 - F.col("duplicate_rate")) * 0.5) * 100)
    )
