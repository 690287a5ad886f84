"""Registered queries: result-table upkeep, ingestion, single column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.items import basket_items, joined, label_items, split_joined
from premia.functions.text import safe_name, strip_whitespace
from premia.operators import ingest
from premia.operators.ordered import row_ranks
from premia.plans.tables import table
from premia.session import scratch_path
from premia.sources import results


def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Users with fewer than three distinct event types among the stored large events."""
    events = table(spark, sf, "events")
    work = events.select("user_id").distinct()
    stored = events.where(F.col("value") > 120).select("user_id", "event_type")
    return results.pending(work, stored, key="user_id", variant="event_type", needed=3)


def compact_last(spark: SparkSession, sf: str) -> DataFrame:
    """Last event per (user, type); users ranked by activity, the ranking cut at fifty as a top-k vocabulary."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    active = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user_id").limit(50)
    ranked = row_ranks(active, [], "n", "user_id")
    out = results.compact(events, ranked, key="user_id", variant="event_type", seq="event_id")
    return out.select("event_id", "user_id", "event_type", "value", "rank")


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Old and new orders with different columns, stacked by name."""
    orders = table(spark, sf, "orders")
    old = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    new = orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderpriority")
    return results.merge_results([old, new])


def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Category keys of either side, each once."""
    docs, events = table(spark, sf, "documents"), table(spark, sf, "events")
    return docs.select(F.col("lang").alias("key")).union(events.select("event_type")).distinct()


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored ids, and an arriving batch that repeats some of them and repeats itself."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    stored = events.where(F.col("event_id") % 3 == 0)
    arrived = events.where(F.col("event_id") % 2 == 0).unionByName(events.where(F.col("event_id") % 5 == 0))
    return events, stored, arrived


def ingest_dedup(spark: SparkSession, sf: str) -> DataFrame:
    _, stored, arrived = _batches(spark, sf)
    return ingest.new_rows(arrived, stored, "event_id", "cents").select("event_id", "user_id", "event_type")


def ingest_stats(spark: SparkSession, sf: str) -> DataFrame:
    _, stored, arrived = _batches(spark, sf)
    out = ingest.batch_statistics(arrived, ingest.new_rows(arrived, stored, "event_id", "cents"))
    return out.select("rows", "bytes", "attempts", "duplicates", F.round("efficiency_percent", 6).alias("efficiency_percent"), F.round("bytes_per_row", 6).alias("bytes_per_row"))


def keep_last(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return results.keep_last(events, ["user_id", "event_type"], "event_id")


def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return results.keep_first(events, ["user_id"], "event_id")


def employer_topn(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent customers with null counted as a value, then taken out again."""
    name = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    counts = table(spark, sf, "orders").groupBy(name.alias("employer")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last("employer")).limit(20).where(F.col("employer").isNotNull())


def array_ops(spark: SparkSession, sf: str) -> DataFrame:
    """Set algebra and clean-up of the first words of every part name, type and brand."""
    part = table(spark, sf, "part")
    words = F.split("p_name", " ")
    raw = F.concat(words, F.array(F.lower("p_type"), F.concat(F.lit(" "), "p_brand", F.lit(" ")), F.lit("unknown"), F.lit("")))
    return part.select(
        "p_partkey",
        F.array_join(basket_items(raw), "|").alias("basket"),
        F.array_join(label_items(raw), "|").alias("label"),
        F.size(label_items(raw)).cast("bigint").alias("n"),
        F.array_join(F.array_sort(F.array_intersect(words, F.array(F.lit("red"), F.lit("ring")))), "|").alias("both"),
        F.array_join(F.array_sort(F.array_except(words, F.array(F.lit("red"), F.lit("ring")))), "|").alias("only"),
        F.arrays_overlap(words, F.array(F.lit("red"), F.lit("ring"))).cast("int").alias("overlap"),
    )


def string_ops(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.select(
        "p_partkey", F.lower(F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" ")))).alias("low"),
        strip_whitespace(F.concat(F.lit("\t "), "p_type", F.lit("\n"))).alias("stripped"),
    )


def regex_find(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.col("text").rlike("(?i)THE |QUE ").cast("int").alias("folded"), F.col("text").rlike("the ").cast("int").alias("exact"))


def parse_utc(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps printed with an offset and read back as instants, as seconds."""
    orders = table(spark, sf, "orders")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0300"))
    return orders.select("o_orderkey", F.unix_timestamp(F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ssZ")).alias("seconds"))


def range_bin(spark: SparkSession, sf: str) -> DataFrame:
    h = F.col("o_orderkey") % 100
    return table(spark, sf, "orders").select("o_orderkey", F.when(h <= 64, "train").when(h <= 79, "val").otherwise("test").alias("bin"))


def join_names(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted distinct brands per part type as one string, split again and counted."""
    grouped = table(spark, sf, "part").groupBy("p_type").agg(joined(F.collect_set("p_brand")).alias("brands"))
    return grouped.select("p_type", "brands", F.size(split_joined(F.col("brands"))).cast("bigint").alias("n"))


def safe_names(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.select("p_partkey", safe_name(F.concat_ws(":", F.concat("p_brand", F.lit("/c?")), F.concat(F.lit("<"), "p_name", F.lit(">")))).alias("name"))


def json_bytes(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return events.groupBy("event_type").agg(F.sum(F.length(F.to_json(F.struct(*events.columns)))).alias("bytes"))


def rounding(spark: SparkSession, sf: str) -> DataFrame:
    """Half-even rounding of halves (as the published tables round) next to half-up."""
    half = F.col("p_size") + 0.5
    return table(spark, sf, "part").select(
        "p_partkey", F.bround(half, 0).cast("bigint").alias("even"), F.round(half, 0).cast("bigint").alias("up"),
        F.greatest("p_size", F.lit(25)).alias("hi"), F.least("p_size", F.lit(25)).alias("lo"), F.abs(F.col("p_size") - 25).alias("off"),
    )


def join_details(spark: SparkSession, sf: str) -> DataFrame:
    """Usable rows joined back to their details by id."""
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return orders.join(customer, "o_custkey")


def drop_unpriced(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose value is present: discounted lines only."""
    value = F.when(F.col("l_discount") > 0, F.col("l_discount"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", value.alias("premium"))
    return lines.na.drop(subset=["premium"]).groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"))


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers written as CSV and read again under their schema."""
    path = scratch_path(spark, "csv")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    results.write_csv(rows, path)
    return results.read_csv(spark, path, rows.schema)


def appended_results(spark: SparkSession, sf: str) -> DataFrame:
    """Nations appended region by region, as finished batches are, and read as one table."""
    path = scratch_path(spark, "appended")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for region in range(5):
        results.append_results(nations.where(F.col("n_regionkey") == region), path, partition="n_regionkey")
    return spark.read.parquet(path).withColumn("n_regionkey", F.col("n_regionkey").cast("bigint"))


QUERIES = {
    "csv_round_trip": (csv_round_trip, "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier"),
    "appended_results": (appended_results, "select n_nationkey, n_name, cast(n_regionkey as bigint) as n_regionkey from nation"),
    "resume_pending": (resume_pending, """
select distinct user_id from events where user_id not in (select user_id from events where value > 120 group by 1 having count(distinct event_type) >= 3)"""),
    "compact_last": (compact_last, """
with l as (select event_id, user_id, event_type, value from events qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1),
v as (select user_id, row_number() over (order by count(*) desc, user_id) as rank from events group by 1 qualify rank <= 50)
select event_id, user_id, event_type, value, rank from l left join v using (user_id)"""),
    "union_by_name": (union_by_name, """
select o_orderkey, o_totalprice, null as o_orderpriority from orders where o_orderstatus = 'F'
union all select o_orderkey, null, o_orderpriority from orders where o_orderstatus <> 'F'"""),
    "union_distinct": (union_distinct, "select lang as key from documents union select event_type from events"),
    "ingest_dedup": (ingest_dedup, """
select distinct event_id, user_id, event_type from events where (event_id % 2 = 0 or event_id % 5 = 0) and event_id % 3 <> 0"""),
    "ingest_stats": (ingest_stats, """
with e as (select event_id, user_id, event_type, cast(round(value * 100) as bigint) as cents from events),
n as (select *, length('{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '","cents":' || cents || '}') as len
  from e where (event_id % 2 = 0 or event_id % 5 = 0) and event_id % 3 <> 0),
a as (select count(*) filter (where event_id % 2 = 0) + count(*) filter (where event_id % 5 = 0) as attempts from e)
select count(*) as rows, cast(sum(len) as bigint) as bytes, any_value(attempts) as attempts, any_value(attempts) - count(*) as duplicates,
  round(count(*) / any_value(attempts) * 100, 6) as efficiency_percent, round(sum(len) / count(*), 6) as bytes_per_row from n, a"""),
    "keep_last": (keep_last, "select max(event_id) as event_id, user_id, event_type from events group by user_id, event_type"),
    "keep_first": (keep_first, "select event_id, user_id, event_type from events qualify row_number() over (partition by user_id order by event_id) = 1"),
    "employer_topn": (employer_topn, """
select * from (select case when o_orderstatus <> 'P' then o_custkey end as employer, count(*) as n from orders group by 1
  order by n desc, employer nulls last limit 20) where employer is not null"""),
    "array_ops": (array_ops, """
with r as (select p_partkey, string_split(p_name, ' ') as w, list_concat(string_split(p_name, ' '), [lower(p_type), ' ' || p_brand || ' ', 'unknown', '']) as raw from part),
x as (select p_partkey, w, list_transform(raw, lambda s: trim(s)) as t from r)
select p_partkey, array_to_string(list_sort(list_distinct(list_filter(t, lambda s: s <> ''))), '|') as basket,
  array_to_string(list_filter(list_transform(t, lambda s: lower(s)), lambda s: s not in ('unknown', '')), '|') as label,
  len(list_filter(t, lambda s: s not in ('unknown', ''))) as n,
  array_to_string(list_sort(list_distinct(list_filter(w, lambda s: s in ('red', 'ring')))), '|') as both,
  array_to_string(list_sort(list_distinct(list_filter(w, lambda s: s not in ('red', 'ring')))), '|') as "only",
  cast(list_has_any(w, ['red', 'ring']) as int) as overlap from x"""),
    "string_ops": (string_ops, "select p_partkey, lower(p_brand) as low, p_type as stripped from part"),
    "regex_find": (regex_find, "select doc_id, cast(regexp_matches(text, '(?i)THE |QUE ') as int) as folded, cast(regexp_matches(text, 'the ') as int) as exact from documents"),
    "parse_utc": (parse_utc, "select o_orderkey, cast(epoch(o_orderdate) as bigint) - 10800 as seconds from orders"),
    "range_bin": (range_bin, "select o_orderkey, case when o_orderkey % 100 <= 64 then 'train' when o_orderkey % 100 <= 79 then 'val' else 'test' end as bin from orders"),
    "join_names": (join_names, "select p_type, string_agg(distinct p_brand, ' + ' order by p_brand) as brands, count(distinct p_brand) as n from part group by 1"),
    "safe_name": (safe_names, "select p_partkey, regexp_replace(p_brand || '/c?:<' || p_name || '>', '[<>:\"/\\\\|?*]', '_', 'g') as name from part"),
    "json_bytes": (json_bytes, """
select event_type, cast(sum(length('{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}')) as bigint) as bytes from events group by 1"""),
    "rounding": (rounding, """
select p_partkey, cast(case when p_size % 2 = 0 then p_size else p_size + 1 end as bigint) as even, cast(p_size + 1 as bigint) as up,
  greatest(p_size, 25) as hi, least(p_size, 25) as lo, abs(p_size - 25) as off from part"""),
    "join_details": (join_details, "select o_custkey, o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey where o_orderstatus = 'O'"),
    "drop_unpriced": (drop_unpriced, "select l_linenumber, count(*) as n from lineitem where l_discount > 0 group by 1"),
}
