"""Registered queries: usable rows, features, bucketing, splits, data quality, selection bias."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.hashing import percent_bucket, split_label
from premia.functions.items import multi_hot
from premia.functions.text import seniority
from premia.operators import bias, prep, quality
from premia.operators.baskets import item_counts, top_items
from premia.operators.premium import stratum_key
from premia.plans.tables import POSTINGS_SQL, line_items, order_facts, postings, table, texts
from premia.session import materialize
from premia.sources.postings import CONTRACT, contract_violations, required_leaves

MAJORS = ["BUILDING", "MACHINERY"]


def usable_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return prep.funnel(postings(spark, sf))


def _usable(spark: SparkSession, sf: str, require_ceiling: bool) -> DataFrame:
    out = prep.usable_postings(postings(spark, sf), require_ceiling=require_ceiling, majors=MAJORS)
    return out.select(
        "id", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", "|").alias("items"),
        F.round("salary_net", 4).alias("salary_net"), F.col("has_ceiling").cast("int").alias("has_ceiling"),
        "city_bucket", "experience_bucket",
    )


def usable_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _usable(spark, sf, True)


def usable_floor(spark: SparkSession, sf: str) -> DataFrame:
    return _usable(spark, sf, False)


# Lowest id (as text) of each content, then the funnel conditions on that row.
DEDUPED = POSTINGS_SQL + """,
d as (select * exclude (rn) from (select *, row_number() over (partition by name, employer_name, description order by id) as rn from p) where rn = 1),
u as (select d.*, coalesce(n_items, 0) >= 2 as tagged, s_from is not null and s_to is not null and currency = 'RUR' as full_salary,
        s_from is not null and currency = 'RUR' as floor_salary
      from d left join sizes using (k)),
names as (select k, count(*) as n_items, string_agg(item, '|' order by item) as items from items group by k)"""


def _usable_sql(cond: str, gross: str) -> str:
    return f"""with {DEDUPED}
select id, n_items, items, round(case when coalesce(gross, false) then {gross} * 0.87 else {gross} end, 4) as salary_net,
  cast(s_to is not null as int) as has_ceiling, case when area_name in ('BUILDING', 'MACHINERY') then area_name else 'Other' end as city_bucket,
  experience as experience_bucket
from u join names using (k) where tagged and {cond}"""


def net_value(spark: SparkSession, sf: str) -> DataFrame:
    """Net value of every line by the gross rule; extended price as the amount, return flag as the flag."""
    gross = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "N", False)
    net = F.when(F.coalesce(gross, F.lit(False)), F.col("l_extendedprice") * prep.NET_OF_GROSS).otherwise(F.col("l_extendedprice"))
    lines = table(spark, sf, "lineitem").select("l_returnflag", F.round(net * 10000).cast("bigint").alias("net"))
    return lines.groupBy("l_returnflag").agg(F.sum("net").cast("bigint").alias("net"), F.count(F.lit(1)).alias("n"))


def bucket_topn_other(spark: SparkSession, sf: str) -> DataFrame:
    out = prep.top_n_or_other(table(spark, sf, "documents").select("doc_id", "source"), "source", 5, "bucket")
    return out.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


def bucket_major_other(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", prep.major_or_other(F.col("lang"), ["en", "fr"]).alias("bucket"))
    return docs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


def regex_class(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", seniority(F.col("text")).alias("seniority"))


def multi_hot_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = multi_hot("work_format", prep.WORK_FORMATS, "work_format_")
    return postings(spark, sf).select("id", *flags)


def basic_features(spark: SparkSession, sf: str) -> DataFrame:
    out = prep.basic_features(postings(spark, sf), ["Customer#000000001", "Customer#000000002"])
    return out.select(
        "id", F.array_join(F.array_sort("items"), "|").alias("items"), F.col("items_count").cast("bigint").alias("items_count"), "city",
        "employer", F.round("salary_avg", 4).alias("salary_avg"), "has_salary", "is_top_employer", "experience_bucket",
    )


def labels_wide(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(spark, sf)
    vocabulary = [r["item"] for r in top_items(facts, 5).collect()]
    return prep.item_labels_wide(facts, vocabulary).drop("items", "s1", "s2", "y")


def labels_long(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(spark, sf)
    return prep.item_labels_long(facts, top_items(facts, 5), id_col="k")


def split_three_way(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", split_label(F.col("o_orderkey"), method="md5").alias("split"))


def split_two_way(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", split_label(F.col("o_orderkey"), val=0, method="md5").alias("split"))


def split_crc(spark: SparkSession, sf: str) -> DataFrame:
    """The split as shipped (crc32)."""
    keys = table(spark, sf, "orders").select("o_orderkey")
    return keys.select("o_orderkey", percent_bucket(F.col("o_orderkey")).alias("bucket"), split_label(F.col("o_orderkey")).alias("split"))


def split_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the slices used for fitting and refitting."""
    split = split_three_way(spark, sf)
    fit, refit = split.where("split = 'train'"), split.where("split in ('train', 'val')")
    return fit.agg(F.count(F.lit(1)).alias("n")).withColumn("slice", F.lit("fit")).unionByName(
        refit.agg(F.count(F.lit(1)).alias("n")).withColumn("slice", F.lit("refit")))


def batch_split(spark: SparkSession, sf: str) -> DataFrame:
    batches = {"old": 240, "new": 100, "eval": 60}
    return prep.sample_batches(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", batches)


def dummies_pivot(spark: SparkSession, sf: str) -> DataFrame:
    types = line_items(spark, sf, "p_type")
    values = [r["item"] for r in item_counts(types.select(F.array("item").alias("items"))).orderBy(F.desc("freq"), "item").limit(3).collect()]
    names = {v: f"d{i}" for i, v in enumerate(values)}
    return prep.dummies(types, "k", "item", values).withColumnsRenamed(names)


def stratum_groups(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    grouped = orders.groupBy(stratum_key(["o_orderpriority", "o_orderstatus"])).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.concat_ws("|", "stratum.o_orderpriority", "stratum.o_orderstatus").alias("stratum"), "n")


def posted_salary(spark: SparkSession, sf: str) -> DataFrame:
    p = postings(spark, sf)
    low, high = F.col("salary")["from"], F.col("salary")["to"]
    has = low.isNotNull() | high.isNotNull()
    return p.where(has).select("id", prep.posted_salary(F.floor(low), F.floor(high), F.col("salary.gross")).alias("posted"))


def nested_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Pruned scan of nested fields, null structs giving nulls."""
    return postings(spark, sf).select("id", "area.name", F.col("employer.id").alias("employer_id"), F.col("experience.id").alias("experience"))


def missing_by_field(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.missing_by_field(postings(spark, sf), quality.posting_missing())
    return out.withColumn("rate", F.round("rate", 6))


def duplicate_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("id", F.col("doc_id") % 900)
    return quality.duplicate_counts(docs, columns=["lang", "text"])


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.quality_score(materialize(postings(spark, sf)), quality.posting_missing())
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text", "source")
    return prep.dedupe(docs, ["lang", "text"], "doc_id").select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


def dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before and after dropping repeated contents."""
    out = quality.duplicate_counts(table(spark, sf, "documents"), id_col="doc_id", columns=["lang", "text"])
    return out.select(F.col("rows").alias("before"), (F.col("rows") - F.col("content_duplicates")).alias("after"))


def schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    return contract_violations(postings(spark, sf), required_leaves(CONTRACT))


def _population(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    full = materialize(prep.usable_flags(postings(spark, sf), require_ceiling=False))
    full = full.withColumn("city", prep.major_or_other(F.col("area.name"), MAJORS)).withColumn("exp", F.col("experience.id"))
    return full, full.where("_usable")


BIAS = POSTINGS_SQL + """,
full_t as (select p.*, case when area_name in ('BUILDING', 'MACHINERY') then area_name else 'Other' end as city,
    coalesce(n_items, 0) >= 2 as tagged, coalesce(n_items, 0) >= 2 and s_from is not null and currency = 'RUR' as usable
  from p left join sizes using (k)),
cats as (select 'city' as dim, city as category, usable from full_t union all select 'exp', experience, usable from full_t where experience is not null),
shares as (select dim, category, count(*) as n_full, count(*) filter (where usable) as n_subset from cats group by all),
sums as (select dim, sum(n_full) as nf, sum(n_subset) as ns from shares group by dim)"""


def category_share_full_vs_subset(spark: SparkSession, sf: str) -> DataFrame:
    full, subset = _population(spark, sf)
    parts = [
        bias.category_shares(full, subset, c).withColumnRenamed(c, "category").withColumn("dim", F.lit(c)) for c in ("city", "exp")
    ]
    out = parts[0].unionByName(parts[1])
    return out.select("dim", "category", "n_full", "n_subset", *[F.round(c, 6).alias(c) for c in ("full_pct", "subset_pct", "point_diff")])


def chi_square_stat(spark: SparkSession, sf: str) -> DataFrame:
    full, subset = _population(spark, sf)
    parts = [
        bias.chi_square(bias.category_shares(full, subset, c)).select(F.lit(c).alias("dim"), F.round("statistic", 6).alias("statistic"), "dof")
        for c in ("city", "exp")
    ]
    return parts[0].unionByName(parts[1])


def chi_square_p(spark: SparkSession, sf: str) -> DataFrame:
    """p-value and verdict; the incomplete gamma function has no SQL form, so rows only."""
    full, subset = _population(spark, sf)
    return bias.chi_square(bias.category_shares(full, subset, "exp")).withColumn("dim", F.lit("exp"))


def chi_square_p_city(spark: SparkSession, sf: str) -> DataFrame:
    """p-value with two degrees of freedom, where the tail is exp(-x / 2)."""
    full, subset = _population(spark, sf)
    out = bias.chi_square(bias.category_shares(full, subset, "city"))
    return out.select(F.round("statistic", 6).alias("statistic"), "dof", F.round("p_value", 9).alias("p_value"))


def _ratio(spark: SparkSession, sf: str) -> DataFrame:
    full, subset = _population(spark, sf)
    return bias.item_ratio(full.where("_tagged"), subset)


def item_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _ratio(spark, sf).withColumn("ratio", F.round("ratio", 6))


def ratio_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return bias.extremes(item_ratio(spark, sf), "ratio", "item", 5).select("side", "item", "ratio")


RATIO = BIAS + """,
ratio as (select item, round(count(*) filter (where tagged) * 100.0 / (select count(*) from full_t where tagged), 2) as tagged_pct,
    round(count(*) filter (where usable) * 100.0 / (select count(*) from full_t where usable), 2) as subset_pct
  from items join full_t using (k) group by item having count(*) filter (where tagged) >= 45)"""
HASH32 = "cast('0x' || substr(md5({}), 1, 8) as bigint)"
_SPLIT = HASH32.format("cast(o_orderkey as varchar)") + " % 100"

QUERIES = {
    "usable_funnel": (usable_funnel, f"""with {DEDUPED}
select (select count(*) from p) as total, count(*) as deduplicated, count(*) filter (where tagged) as tagged,
  count(*) filter (where tagged and full_salary) as usable from u"""),
    "usable_strict": (usable_strict, _usable_sql("full_salary", "((s_from + s_to) / 2)")),
    "usable_floor": (usable_floor, _usable_sql("floor_salary", "s_from")),
    "net_value": (net_value, """
select l_returnflag, cast(sum(cast(round(case when l_returnflag = 'R' then l_extendedprice * 0.87 else l_extendedprice end * 10000) as bigint)) as bigint) as net,
  count(*) as n from lineitem group by 1"""),
    "bucket_topn_other": (bucket_topn_other, """
with top as (select source from (select source, count(*) as n from documents group by 1 order by n desc, source limit 5) where source is not null)
select coalesce(top.source, 'Other') as bucket, count(*) as n, cast(sum(doc_id) as bigint) as ids from documents d left join top on d.source = top.source group by 1"""),
    "bucket_major_other": (bucket_major_other, """
select case when lang in ('en', 'fr') then lang else 'Other' end as bucket, count(*) as n, cast(sum(doc_id) as bigint) as ids from documents group by 1"""),
    "regex_class": (regex_class, """
select doc_id, case when regexp_matches(text, '(?i)junior|trainee|intern|entry|начальный') then 'Junior'
  when regexp_matches(text, '(?i)senior|lead|principal|head|старший|ведущий') then 'Senior'
  when regexp_matches(text, '(?i)middle|mid') then 'Middle' else 'Unknown' end as seniority from documents"""),
    "multi_hot": (multi_hot_flags, f"""with {POSTINGS_SQL}
select id, cast(coalesce(on_site, false) as int) as work_format_on_site, cast(coalesce(remote, false) as int) as work_format_remote,
  cast(coalesce(hybrid, false) as int) as work_format_hybrid, cast(coalesce(field_work, false) as int) as work_format_field_work from p"""),
    "basic_features": (basic_features, f"""with {POSTINGS_SQL},
names as (select k, count(*) as n_items, string_agg(lower(item), '|' order by lower(item)) as items from items group by k)
select id, coalesce(items, '') as items, coalesce(n_items, 0) as items_count, area_name as city, employer_name as employer,
  round((s_from + s_to) / 2, 4) as salary_avg, cast(s_from is not null and s_to is not null as int) as has_salary,
  cast(employer_name in ('Customer#000000001', 'Customer#000000002') as int) as is_top_employer, experience as experience_bucket
from p left join names using (k)"""),
    "labels_wide": (labels_wide, """
with b as (select distinct l_orderkey as k, p_brand as item from lineitem join part on l_partkey = p_partkey),
v as (select item, row_number() over (order by count(*) desc, item) - 1 as r from b group by item)
select k, """ + ", ".join(f"max(case when r = {i} then 1 else 0 end) as label_{i}" for i in range(5)) + """
from b join v using (item) group by k"""),
    "labels_long": (labels_long, """
with b as (select distinct l_orderkey as k, p_brand as item from lineitem join part on l_partkey = p_partkey),
v as (select item from b group by item order by count(*) desc, item limit 5)
select k, item, 1 as y from b semi join v using (item)"""),
    "split_three_way": (split_three_way, f"""
select o_orderkey, case when {_SPLIT} < 65 then 'train' when {_SPLIT} < 80 then 'val' else 'test' end as split from orders"""),
    "split_two_way": (split_two_way, f"""
select o_orderkey, case when {_SPLIT} < 80 then 'train' else 'test' end as split from orders"""),
    "split_crc": (split_crc, """
with recursive t(i, k, c) as (
  select range, 0, range from range(256)
  union all select i, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from t where k < 8),
tab as (select list(c order by i) as tab from t where k = 8),
h as (select o_orderkey, xor(4294967295, list_reduce(list_transform(string_split(cast(o_orderkey as varchar), ''), lambda ch: cast(ascii(ch) as bigint)),
  lambda acc, x: xor(tab[(xor(acc, x) & 255) + 1], acc >> 8), cast(4294967295 as bigint))) % 100 as bucket from orders, tab)
select o_orderkey, bucket, case when bucket < 65 then 'train' when bucket < 80 then 'val' else 'test' end as split from h"""),
    "split_filter": (split_filter, f"""
select 'fit' as slice, count(*) filter (where {_SPLIT} < 65) as n from orders
union all select 'refit', count(*) filter (where {_SPLIT} < 80) from orders"""),
    "batch_split": (batch_split, f"""
select o_orderkey, case when r <= 240 then 'old' when r <= 340 then 'new' else 'eval' end as batch from (
  select o_orderkey, row_number() over (order by {HASH32.format("'42:' || cast(o_orderkey as varchar)")}, o_orderkey) as r from orders) where r <= 400"""),
    "dummies_pivot": (dummies_pivot, """
with t as (select distinct l_orderkey as k, p_type as item from lineitem join part on l_partkey = p_partkey),
v as (select p_type as item, row_number() over (order by count(*) desc, p_type) - 1 as r from lineitem join part on l_partkey = p_partkey group by 1)
select k, """ + ", ".join(f"max(case when r = {i} then 1 else 0 end) as d{i}" for i in range(3)) + " from t join v using (item) group by k"),
    "stratum_key": (stratum_groups, "select o_orderpriority || '|' || o_orderstatus as stratum, count(*) as n from orders group by 1"),
    "posted_salary": (posted_salary, f"""with {POSTINGS_SQL},
t as (select *, replace(format('{{:,}}', cast(floor(s_from) as bigint)), ',', ' ') as a, replace(format('{{:,}}', cast(floor(s_to) as bigint)), ',', ' ') as b from p)
select id, case when s_from is not null and s_to is not null then a || '-' || b || ' RUB' when s_from is not null then 'from ' || a || ' RUB'
  else 'up to ' || b || ' RUB' end || case when gross then ', before tax' when not gross then ', after tax' else '' end as posted
from t where s_from is not null or s_to is not null"""),
    "nested_fields": (nested_fields, f"with {POSTINGS_SQL} select id, area_name as name, employer_id, experience from p"),
    "missing_by_field": (missing_by_field, f"""with {POSTINGS_SQL},
m as (select count(*) as n, count(*) filter (where id is null) as c_id, count(*) filter (where name is null) as c_name,
  count(*) filter (where employer_name is null) as c_employer, count(*) filter (where area_name is null) as c_area,
  count(*) filter (where s_from is null or s_to is null) as c_salary, count(*) filter (where n_items is null) as c_items from p left join sizes using (k))
select field, missing, n as rows, round(missing / n, 6) as rate from (
  select 'id' as field, c_id as missing, n from m union all select 'name', c_name, n from m union all select 'employer', c_employer, n from m
  union all select 'area', c_area, n from m union all select 'salary', c_salary, n from m union all select 'items', c_items, n from m)"""),
    "duplicate_counts": (duplicate_counts, """
select count(*) as rows, count(*) - count(distinct doc_id % 900) as id_duplicates,
  count(*) - (select count(*) from (select distinct lang, text from documents)) as content_duplicates from documents"""),
    "quality_score": (quality_score, f"""with {POSTINGS_SQL},
m as (select count(*) as n, count(*) filter (where id is null) + count(*) filter (where name is null) + count(*) filter (where employer_name is null)
  + count(*) filter (where area_name is null) + count(*) filter (where s_from is null or s_to is null) + count(*) filter (where n_items is null) as missing
  from p left join sizes using (k)),
c as (select count(*) as n from (select distinct name, employer_name, description from p))
select round(1 - missing / (6 * m.n), 6) as completeness, round((m.n - c.n) / m.n, 6) as duplicate_rate,
  round((0.5 * (1 - missing / (6 * m.n)) + 0.5 * (1 - (m.n - c.n) / m.n)) * 100, 6) as score from m, c"""),
    "dedup_keep_first": (dedup_keep_first, """
select doc_id, lang, source, md5(text) as text_md5 from (
  select *, row_number() over (partition by lang, text order by doc_id) as r from documents) where r = 1"""),
    "dedup_report": (dedup_report, """
select count(*) as before, (select count(*) from (select distinct lang, text from documents)) as after from documents"""),
    "schema_contract": (schema_contract, f"""with {POSTINGS_SQL},
m as (select count(*) as n, count(id) as a, count(name) as b, count(area_name) as c, count(employer_name) as d, count(published_at) as e from p)
select 'id' as field, n - a as missing, n as rows from m union all select 'name', n - b, n from m union all select 'area.name', n - c, n from m
union all select 'employer.name', n - d, n from m union all select 'published_at', n - e, n from m"""),
    "category_share_full_vs_subset": (category_share_full_vs_subset, f"""with {BIAS}
select dim, category, n_full, n_subset, round(n_full * 100.0 / nf, 6) as full_pct, round(n_subset * 100.0 / ns, 6) as subset_pct,
  round(n_subset * 100.0 / ns - n_full * 100.0 / nf, 6) as point_diff from shares join sums using (dim)"""),
    "chi_square_stat": (chi_square_stat, f"""with {BIAS}
select dim, round(sum((n_subset - n_full / nf * ns) * (n_subset - n_full / nf * ns) / (n_full / nf * ns)), 6) as statistic, count(*) - 1 as dof
from shares join sums using (dim) where n_full > 0 group by dim"""),
    "chi_square_p": (chi_square_p, None),
    "chi_square_p_city": (chi_square_p_city, f"""with {BIAS},
stat as (select sum((n_subset - n_full / nf * ns) * (n_subset - n_full / nf * ns) / (n_full / nf * ns)) as x, count(*) - 1 as dof
  from shares join sums using (dim) where n_full > 0 and dim = 'city')
select round(x, 6) as statistic, dof, round(exp(-x / 2), 9) as p_value from stat"""),
    "item_ratio": (item_ratio, f"with {RATIO} select item, tagged_pct, subset_pct, round(subset_pct / tagged_pct, 6) as ratio from ratio"),
    "ratio_extremes": (ratio_extremes, f"""with {RATIO}, r as (select item, round(subset_pct / tagged_pct, 6) as ratio from ratio)
(select 'top' as side, item, ratio from r order by ratio desc, item limit 5) union all (select 'bottom', item, ratio from r order by ratio, item limit 5)"""),
}
