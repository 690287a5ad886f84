"""Result tables: CSV and parquet sinks, append-as-you-go, resume, compaction, vocabulary cache."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.functions.items import joined


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with header; array columns become sorted ' + ' strings."""
    flat = [
        joined(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(paths)


def merge_results(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; columns a frame lacks are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def append_results(df: DataFrame, path: str, partition: str = "model") -> None:
    """Append one finished batch; every earlier batch stays readable if a later one fails."""
    df.write.mode("append").partitionBy(partition).parquet(path)


def pending(work: DataFrame, results: DataFrame, *, key: str, variant: str, needed: int = 3) -> DataFrame:
    """Work items not yet finished: those with fewer than ``needed`` distinct variants among the results."""
    done = results.groupBy(key).agg(F.countDistinct(variant).alias("_n")).where(F.col("_n") >= needed).select(key)
    return work.join(done, key, "left_anti")


def keep_last(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row per key in ``order``; a map-side combined aggregate, so a hot key is no hot task."""
    others = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The first row per key in ``order``."""
    others = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def compact(results: DataFrame, vocabulary: DataFrame, *, key: str, variant: str, seq: str) -> DataFrame:
    """Last row per (key, variant), in vocabulary order; keys outside the vocabulary come last."""
    last = keep_last(results, [key, variant], seq)
    return last.join(vocabulary.select(key, "rank"), key, "left").orderBy(F.asc_nulls_last("rank"), key, variant)


def vocabulary(spark: SparkSession, path: str, compute: Callable[[], DataFrame], expected: int | None = None) -> DataFrame:
    """The vocabulary table at ``path``; computed and written on the first call, reused afterwards.

    ``compute`` returns ranked rows (rank, item, freq). A size other than ``expected`` is reported, not refused.
    """
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        compute().write.parquet(path)
        table = spark.read.parquet(path)
    if expected is not None:
        found = table.count()
        if found != expected:
            print(f"vocabulary at {path} holds {found} items, {expected} asked for")
    return table
