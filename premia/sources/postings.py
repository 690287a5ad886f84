"""Nested postings: declared schemas, scans by file suffix, schema contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("key_skills", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("area", T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])),
    T.StructField("employer", T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])),
    T.StructField("salary", T.StructType([
        T.StructField("from", T.DoubleType()),
        T.StructField("to", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("gross", T.BooleanType()),
    ])),
    T.StructField("experience", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("work_format", T.ArrayType(T.StructType([T.StructField("id", T.StringType())]))),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("alternate_url", T.StringType()),
])

# The strict contract: leaves that may not be null, and the types the named columns must have.
CONTRACT = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("key_skills", T.ArrayType(T.StringType()), True),
    T.StructField("area", T.StructType([
        T.StructField("id", T.StringType(), True), T.StructField("name", T.StringType(), False)]), False),
    T.StructField("employer", T.StructType([
        T.StructField("id", T.StringType(), True), T.StructField("name", T.StringType(), False)]), False),
    T.StructField("salary", T.StructType([
        T.StructField("from", T.DoubleType(), True), T.StructField("to", T.DoubleType(), True)]), True),
    T.StructField("published_at", T.TimestampType(), False),
])


def read_postings(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType = POSTING_SCHEMA
) -> DataFrame:
    """A JSON array file (``.json``) against the declared schema, anything else as parquet; pruned to ``columns``."""
    if path.rstrip("/").endswith(".json"):
        df = spark.read.schema(schema).option("multiLine", True).json(path)
    else:
        df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def required_leaves(contract: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of the non-nullable leaf fields."""
    out: list[str] = []
    for f in contract.fields:
        name = prefix + f.name
        if isinstance(f.dataType, T.StructType):
            out += required_leaves(f.dataType, name + ".")
        elif not f.nullable:
            out.append(name)
    return out


def schema_differences(df: DataFrame, contract: T.StructType) -> list[tuple[str, str, str]]:
    """(column, wanted type, found type) of every contract leaf that is absent or of another type."""
    def leaves(s: T.StructType, prefix: str = "") -> dict[str, str]:
        out: dict[str, str] = {}
        for f in s.fields:
            if isinstance(f.dataType, T.StructType):
                out |= leaves(f.dataType, f"{prefix}{f.name}.")
            else:
                out[prefix + f.name] = f.dataType.simpleString()
        return out

    found = leaves(df.schema)
    return [(c, t, found.get(c, "absent")) for c, t in leaves(contract).items() if found.get(c) != t]


def contract_violations(df: DataFrame, leaves: Sequence[str]) -> DataFrame:
    """(field, missing, rows): null counts of the leaves, in one pass over the frame."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(leaves)]
    )
    cells: list[Column] = [
        F.struct(F.lit(c).alias("field"), (F.col("_rows") - F.col(f"c{i}")).alias("missing"), F.col("_rows").alias("rows"))
        for i, c in enumerate(leaves)
    ]
    return counts.select(F.explode(F.array(*cells)).alias("x")).select("x.*")
