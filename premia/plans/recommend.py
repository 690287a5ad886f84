"""Registered queries: next-item recommendation for whole batches of profiles, subset profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.items import joined
from premia.operators import recommend as rec
from premia.operators.baskets import item_counts, mine
from premia.operators.premium import value_table
from premia.plans.tables import STRATA, line_items, order_facts, table
from premia.plans.value import HELD, TYPE_MASKS
from premia.session import materialize
from premia.sources.results import keep_last


def _setting(spark: SparkSession, sf: str, item: str = "p_type") -> tuple[DataFrame, DataFrame]:
    """Priced itemsets of every mined size, and one profile per customer: the items of the newest order."""
    facts = order_facts(spark, sf, item)
    values = materialize(value_table(facts, mine(facts).itemsets, value="y", strata=STRATA))
    return values, _profiles(spark, sf, facts)


def _profiles(spark: SparkSession, sf: str, facts: DataFrame) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate")
    bought = facts.select("k", "items").join(orders, "k")
    return keep_last(bought, ["o_custkey"], "o_orderdate", "k").select(
        F.col("o_custkey").alias("profile"), F.col("items").alias("known")
    )


def recommend_exact(spark: SparkSession, sf: str) -> DataFrame:
    values, profiles = _setting(spark, sf)
    out = rec.exact(profiles, values.where(F.col("size") >= 2))
    return out.withColumn("adjusted_premium", F.round(F.col("adjusted_premium") / 100, 4))


def recommend_pairwise(spark: SparkSession, sf: str) -> DataFrame:
    values, profiles = _setting(spark, sf, "p_brand")
    out = rec.recommend(profiles, values.where(F.col("size") >= 2)).where(F.col("mode") == "pairwise").drop("mode")
    return out.withColumn("adjusted_premium", F.round(F.col("adjusted_premium") / 100, 4))


def recommend_mode(spark: SparkSession, sf: str) -> DataFrame:
    values, profiles = _setting(spark, sf, "p_brand")
    return rec.modes(profiles, rec.recommend(profiles, values.where(F.col("size") >= 2)))


def rules_for_profiles(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(spark, sf, "p_type")
    out = rec.rules_for(_profiles(spark, sf, facts), mine(facts).rules)
    return out.select(
        "profile", joined(F.col("antecedent")).alias("antecedent"), joined(F.col("consequent")).alias("consequent"), F.round("lift", 6).alias("lift")
    )


def own_rank(spark: SparkSession, sf: str) -> DataFrame:
    values, profiles = _setting(spark, sf)
    singles = values.where(F.col("size") == 1).select(F.element_at("items", 1).alias("item"), "adjusted_premium")
    out = rec.own_values(profiles, singles)
    return out.withColumn("adjusted_premium", F.round(F.col("adjusted_premium") / 100, 4))


def unpaired_items(spark: SparkSession, sf: str) -> DataFrame:
    """Known sizes of the newest orders that no priced combination of sizes holds."""
    facts = order_facts(spark, sf, "p_size")
    values = value_table(facts, mine(facts).itemsets, value="y", strata=STRATA)
    return rec.unpaired(_profiles(spark, sf, facts), materialize(values.where(F.col("size") >= 2)))


def orders_with_all_items(spark: SparkSession, sf: str) -> DataFrame:
    """How many orders hold the whole basket of each customer's newest order."""
    facts = order_facts(spark, sf)
    found = rec.count_rows_with_all(facts.select("items"), _profiles(spark, sf, facts), rarity=item_counts(facts))
    return found.withColumnRenamed("rows", "orders")


def _chosen(facts: DataFrame) -> list[str]:
    return [r["item"] for r in item_counts(facts).orderBy(F.desc("freq"), "item").limit(2).collect()]


def subset_profile(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(spark, sf, "p_type")
    chosen = F.array(*[F.lit(c) for c in _chosen(facts)])
    shares = {f"status_{s}": F.col("s2") == s for s in ("F", "O", "P")} | {"urgent": F.col("s1") == "1-URGENT"}
    out = rec.subset_profile(facts, F.size(F.array_except(chosen, F.col("items"))) == 0, value="y", shares=shares)
    return out.withColumn("value", F.round("value", 4))


def colisted_items(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(spark, sf)
    chosen = _chosen(facts)
    rows = facts.where(F.array_contains("items", chosen[0]))
    return rec.colisted(rows, chosen[:1]).withColumn("share", F.round("share", 6))


def recent_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Newest order of each customer among the orders holding the two most common types; the five newest."""
    facts = order_facts(spark, sf, "p_type")
    chosen = _chosen(facts)
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate")
    rows = facts.where(F.array_contains("items", chosen[0]) & F.array_contains("items", chosen[1])).select("k").join(orders, "k")
    return rec.most_recent(rows, "o_custkey", "o_orderdate", "k").select("k", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def date_range(spark: SparkSession, sf: str) -> DataFrame:
    out = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return out.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) for c in out.columns])


def order_by_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 most recent orders, newest date first, then highest key."""
    orders = table(spark, sf, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20)
    return orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


VALUES = TYPE_MASKS + """,
f as (select o_orderkey as k, o_orderpriority as s1, o_orderstatus as s2, cast(round(o_totalprice*100) as bigint) as y
      from orders where o_orderkey in (select k from masks)),
tot as (select s1, s2, count(*) as n, sum(y) as sy from f group by s1, s2),
w as (select s, s1, s2, count(*) as nw, sum(y) as sw from freqs join masks on (mask & s) = s join f using (k) group by s, s1, s2),
j as (select s, nw, n - nw as nn, cast(sw as double)/nw as mw, cast(sy - sw as double)/nullif(n - nw, 0) as mn from w join tot using (s1, s2)),
priced as (select s, sum(nw) as n_with, case when count(*) filter (where nw >= 5 and nn >= 5) >= 2
    then sum(nw*(mw-mn)) filter (where nw >= 5 and nn >= 5) / sum(nw) filter (where nw >= 5 and nn >= 5) end as adj
  from j group by s),
combos as (select s, itemset, size, n_with, adj from priced join named using (s) where adj is not null),
profiles as (select o_custkey as profile, mask as known from orders join masks on o_orderkey = k
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
exact as (select profile, bits.item as suggested, adj, n_with from profiles
  join combos on (s & known) = known and size = bit_count(known) + 1 join bits on bit = s - known)"""
# The same for brands, item by item.
ADVICE = HELD + """,
newest as (select o_custkey as profile, o_orderkey as k from orders where o_orderkey in (select k from b)
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
known as (select profile, item from newest join b using (k)),
psize as (select profile, count(*) as m from known group by profile),
combos as (select itemset, size, n_with, adj from priced where size >= 2 and adj is not null),
mem as (select distinct itemset, unnest(string_split(itemset, ' + ')) as item from combos),
exact as (select profile, itemset from known join mem using (item) join combos using (itemset) join psize using (profile)
  group by profile, itemset, size, m having count(*) = m and size = m + 1),
pairwise as (select kn.profile, o.item as suggested, sum(adj * n_with) / sum(n_with) as adj, sum(n_with) as n_with, string_agg(kn.item, ', ' order by kn.item) as based_on
  from known kn join mem a on a.item = kn.item join combos c on c.itemset = a.itemset and size = 2
  join mem o on o.itemset = a.itemset and o.item <> a.item left join known also on also.profile = kn.profile and also.item = o.item
  where also.item is null and kn.profile not in (select profile from exact) group by 1, 2)"""
SIZES = ADVICE.replace("p_brand as item", "cast(p_size as varchar) as item")
BRANDS = """
b as (select distinct l_orderkey as k, p_brand as item from lineitem join part on l_partkey = p_partkey),
newest as (select o_custkey as profile, o_orderkey as k from orders where o_orderkey in (select k from b)
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
known as (select profile, item from newest join b using (k))"""
TOP2 = """
b as (select distinct l_orderkey as k, p_type as item from lineitem join part on l_partkey = p_partkey),
top as (select item from b group by item order by count(*) desc, item limit 2),
hit as (select k from b semi join top using (item) group by k having count(*) = 2)"""

QUERIES = {
    "recommend_exact": (recommend_exact, f"with {VALUES} select profile, suggested, round(adj/100, 4) as adjusted_premium, cast(n_with as bigint) as n_with from exact"),
    "recommend_pairwise": (recommend_pairwise, f"""with {ADVICE}
select profile, suggested, round(adj/100, 4) as adjusted_premium, cast(n_with as bigint) as n_with, based_on from pairwise"""),
    "recommend_mode": (recommend_mode, f"""with {ADVICE},
r as (select profile, 'exact' as mode, count(*) as n from exact group by 1 union all select profile, 'pairwise', count(*) from pairwise group by 1)
select profile, coalesce(mode, 'none') as mode, coalesce(n, 0) as n from psize left join r using (profile)"""),
    "rules_for_profiles": (rules_for_profiles, f"""with {VALUES}, n as (select count(*) as n from masks)
select profile, a.itemset as antecedent, c.itemset as consequent, round((ab.freq/fa.freq) / (fc.freq/(select n from n)), 6) as lift
from freqs ab join bits on (ab.s & bit) <> 0 and ab.s <> bit
join freqs fa on fa.s = ab.s - bit join named a on a.s = fa.s join freqs fc on fc.s = bit join named c on c.s = bit
join profiles on (fa.s & known) = fa.s and (bit & known) = 0 where ab.freq/fa.freq >= 0.4"""),
    "own_rank": (own_rank, f"""with {VALUES},
singles as (select s, itemset as item, adj, row_number() over (order by adj desc, itemset) as rank from combos where size = 1)
select profile, item, round(adj/100, 4) as adjusted_premium, rank from profiles join singles on (s & known) <> 0"""),
    "unpaired_items": (unpaired_items, f"""with {SIZES},
paired as (select distinct item from mem)
select profile, item from known anti join paired using (item)"""),
    "orders_with_all_items": (orders_with_all_items, f"""with {BRANDS},
sz as (select profile, count(*) as n from known group by profile),
hits as (select profile, b.k, count(*) as n from known join b using (item) group by 1, 2)
select profile, count(*) as orders from hits join sz using (profile, n) group by 1"""),
    "subset_profile": (subset_profile, f"""with {TOP2},
f as (select o_orderkey as k, o_orderpriority as s1, o_orderstatus as s2, cast(round(o_totalprice*100) as bigint) as y from orders where o_orderkey in (select k from b)),
pop as (select 'all' as population, * from f union all select 'subset', f.* from f semi join hit using (k)),
a as (select population, quantile_cont(y, 0.25) as q1, quantile_cont(y, 0.5) as median, quantile_cont(y, 0.75) as q3, cast(count(*) as double) as rows,
  avg(case when s2 = 'F' then 1.0 else 0 end) as status_F, avg(case when s2 = 'O' then 1.0 else 0 end) as status_O,
  avg(case when s2 = 'P' then 1.0 else 0 end) as status_P, avg(case when s1 = '1-URGENT' then 1.0 else 0 end) as urgent from pop group by 1)
select population, measure, round(value, 4) as value from (
  select population, unnest(['q1', 'median', 'q3', 'rows', 'status_F', 'status_O', 'status_P', 'urgent']) as measure,
    unnest([q1, median, q3, rows, status_F, status_O, status_P, urgent]) as value from a)"""),
    "colisted_items": (colisted_items, """
with b as (select distinct l_orderkey as k, p_brand as item from lineitem join part on l_partkey = p_partkey),
top as (select item from b group by item order by count(*) desc, item limit 1),
hit as (select k from b semi join top using (item))
select item, count(*) as rows, round(count(*) / (select count(*) from hit), 6) as share
from b semi join hit using (k) where item not in (select item from top) group by item order by rows desc, item limit 8"""),
    "recent_per_group": (recent_per_group, f"""with {TOP2}
select k, o_custkey, strftime(o_orderdate, '%Y-%m-%d') as day from hit join orders on o_orderkey = k
qualify row_number() over (partition by o_custkey order by o_orderdate desc, k desc) = 1 order by o_orderdate desc, k desc limit 5"""),
    "date_range": (date_range, "select strftime(min(o_orderdate), '%Y-%m-%d') as first, strftime(max(o_orderdate), '%Y-%m-%d') as last from orders"),
    "order_by_two_keys": (order_by_two_keys, "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders order by o_orderdate desc, o_orderkey desc limit 20"),
}
