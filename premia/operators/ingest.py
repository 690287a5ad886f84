"""Arriving batches: first-seen rows, provenance tags, batch statistics (shared by batch and streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.sources.results import keep_first


def new_rows(arrived: DataFrame, stored: DataFrame, id_col: str, *order: str) -> DataFrame:
    """Arrived rows not stored before, each id once (the first in ``order``)."""
    return keep_first(arrived, [id_col], *order).join(stored.select(id_col), id_col, "left_anti")


def tagged(df: DataFrame, *, query: str, area: int) -> DataFrame:
    """Provenance columns. They describe how a row was found and must never become features."""
    return df.withColumns(
        {"_search_query": F.lit(query), "_area_id": F.lit(area), "_collected_at": F.current_timestamp()}
    )


def batch_statistics(arrived: DataFrame, accepted: DataFrame) -> DataFrame:
    """One row: accepted rows and their JSON bytes, attempts, duplicates, share of attempts that were new."""
    taken = accepted.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct(*accepted.columns)))).alias("b")
    )
    out = arrived.agg(F.count(F.lit(1)).alias("attempts"))
    out = out.withColumn("rows", taken.select("n").scalar()).withColumn("bytes", taken.select("b").scalar())
    return out.select(
        "rows", "bytes", "attempts", (F.col("attempts") - F.col("rows")).alias("duplicates"),
        (F.col("rows") / F.greatest(F.lit(1), "attempts") * 100).alias("efficiency_percent"),
        F.try_divide("bytes", "rows").alias("bytes_per_row"),
    )
