"""The driver tables in the shape the operators take: facts, baskets, nested postings, scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators.baskets import collect_baskets
from premia.session import materialize, spread

STRATA = ["s1", "s2"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """A pruned table of long texts, spread for row-local work."""
    return spread(table(spark, sf, name).select(*columns))


def cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def line_items(spark: SparkSession, sf: str, item: str) -> DataFrame:
    """(k, item): the item of every order line; repeats kept."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf, "part").select("p_partkey", F.col(item).cast("string").alias("item"))
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("k"), "item")


def order_facts(spark: SparkSession, sf: str, item: str = "p_brand") -> DataFrame:
    """(k, s1, s2, y, items): every order with lines, its strata, its total in cents and its basket. Written once."""
    baskets = collect_baskets(line_items(spark, sf, item), "k", "item")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderpriority").alias("s1"),
        F.col("o_orderstatus").alias("s2"),
        cents("o_totalprice").alias("y"),
    )
    return materialize(orders.join(baskets, "k"))


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as nested postings (schema of `premia.sources.postings`), with gaps in every optional field."""
    baskets = collect_baskets(line_items(spark, sf, "p_brand"), "k", "item")
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(baskets, key == F.col("k"), "left")
        .select(
            key.cast("string").alias("id"),
            F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("name"),
            F.concat(F.lit("<p>"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</p>")).alias("description"),
            F.transform("items", lambda s: F.struct(s.alias("name"))).alias("key_skills"),
            F.struct(F.col("o_orderstatus").alias("id"), F.col("c_mktsegment").alias("name")).alias("area"),
            F.struct(F.col("o_custkey").cast("string").alias("id"), F.col("c_name").alias("name")).alias("employer"),
            F.struct(
                F.when(key % 11 != 0, price).alias("from"),
                F.when(key % 3 != 0, price + 1000.0).alias("to"),
                F.when(key % 5 == 0, "USD").otherwise("RUR").alias("currency"),
                F.when(key % 4 == 0, True).when(key % 4 == 1, False).alias("gross"),
            ).alias("salary"),
            F.struct(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("id")).alias("experience"),
            F.when(
                key % 7 != 0,
                F.array(
                    F.struct(F.when(F.col("o_orderstatus") == "F", "ON_SITE").otherwise("REMOTE").alias("id")),
                    F.struct(F.when(key % 2 == 0, "HYBRID").otherwise("FIELD_WORK").alias("id")),
                ),
            ).alias("work_format"),
            F.col("o_orderdate").cast("timestamp").alias("published_at"),
        )
    )


# The same nested frame for the SQL side, flattened to one row per order.
POSTINGS_SQL = """
p as (select o_orderkey as k, cast(o_orderkey as varchar) as id, o_orderpriority || ' ' || o_orderstatus as name,
  '<p>' || strftime(o_orderdate, '%Y-%m-%d') || '</p>' as description,
  o_orderstatus as area_id, c_mktsegment as area_name, cast(o_custkey as varchar) as employer_id, c_name as employer_name,
  case when o_orderkey % 11 <> 0 then o_totalprice end as s_from,
  case when o_orderkey % 3 <> 0 then o_totalprice + 1000.0 end as s_to,
  case when o_orderkey % 5 = 0 then 'USD' else 'RUR' end as currency,
  case when o_orderkey % 4 = 0 then true when o_orderkey % 4 = 1 then false end as gross,
  case when o_orderpriority <> '5-LOW' then o_orderpriority end as experience,
  case when o_orderkey % 7 <> 0 then o_orderstatus = 'F' end as on_site,
  case when o_orderkey % 7 <> 0 then o_orderstatus <> 'F' end as remote,
  case when o_orderkey % 7 <> 0 then o_orderkey % 2 = 0 end as hybrid,
  case when o_orderkey % 7 <> 0 then o_orderkey % 2 <> 0 end as field_work,
  o_orderdate as published_at
  from orders left join customer on o_custkey = c_custkey),
items as (select distinct l_orderkey as k, p_brand as item from lineitem join part on l_partkey = p_partkey),
sizes as (select k, count(*) as n_items from items group by k)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, source, item, model, y, score): every labelled document under two labels and two score columns."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    labels = table(spark, sf, "labels")
    item = F.explode(F.array(
        F.struct(F.lit("quality").alias("item"), F.col("quality").alias("y")),
        F.struct(F.lit("toxic").alias("item"), F.col("toxic").alias("y")),
    ))
    model = F.explode(F.array(
        F.struct(F.lit("m97").alias("model"), F.round((F.col("n_chars") % 97) / 97.0, 4).alias("score")),
        F.struct(F.lit("m53").alias("model"), F.round(((F.col("n_chars") + 7 * F.col("doc_id")) % 53) / 53.0, 4).alias("score")),
    ))
    return (
        docs.join(labels, "doc_id")
        .select("doc_id", "source", "n_chars", item.alias("i"))
        .select("doc_id", "source", "n_chars", "i.*")
        .select("doc_id", "source", "item", "y", model.alias("m"))
        .select("doc_id", "source", "item", "m.model", "y", "m.score")
    )


SCORED_SQL = """
scored as (select doc_id, source, item, model, y, score from (
  select d.doc_id, source, i.item, case when i.item = 'quality' then quality else toxic end as y, m.model,
    case when m.model = 'm97' then round((n_chars % 97) / 97.0, 4) else round(((n_chars + 7 * d.doc_id) % 53) / 53.0, 4) end as score
  from documents d join labels l on d.doc_id = l.doc_id
  cross join (values ('quality'), ('toxic')) i(item) cross join (values ('m97'), ('m53')) m(model)))"""
