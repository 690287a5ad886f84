"""Registered queries: premiums of single items and combinations, mining, rules, co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.items import joined, pairs_of
from premia.operators.baskets import (
    collect_baskets,
    cooccurrence,
    floor_items,
    item_counts,
    mine,
    top_items,
)
from premia.operators.premium import contained, stratified_premium, value_table
from premia.plans.tables import STRATA, line_items, order_facts

BASE = """
b as (select distinct l_orderkey as k, p_brand as item from lineitem join part on l_partkey = p_partkey),
f as (select o_orderkey as k, o_orderpriority as s1, o_orderstatus as s2, cast(round(o_totalprice*100) as bigint) as y
      from orders where o_orderkey in (select k from b)),
n as (select count(*) as n, sum(y) as sy from f),
tot as (select s1, s2, count(*) as n, sum(y) as sy from f group by s1, s2)"""

# Every itemset of one to three brands above the support floor, with the orders that hold it.
HELD = BASE + """,
held_all as (
  select k, item as itemset, 1 as size from b
  union all select x.k, x.item || ' + ' || y.item, 2 from b x join b y on x.k = y.k and x.item < y.item
  union all select x.k, x.item || ' + ' || y.item || ' + ' || z.item, 3
    from b x join b y on x.k = y.k and x.item < y.item join b z on x.k = z.k and y.item < z.item),
mined as (select itemset, size, count(*) as freq from held_all group by itemset, size
          having count(*) >= ceil(0.01 * (select n from n))),
held as (select k, itemset, size from held_all semi join mined using (itemset)),
w as (select itemset, size, s1, s2, count(*) as nw, sum(y) as sw from held join f using (k) group by itemset, size, s1, s2),
j as (select w.*, tot.n - nw as nn, cast(sw as double)/nw as mw, cast(sy - sw as double)/nullif(tot.n - nw, 0) as mn
      from w join tot using (s1, s2)),
priced as (select itemset, size, sum(nw) as n_with,
    sum(cast(sw as double))/sum(nw) - cast((select sy from n) - sum(sw) as double)/((select n from n) - sum(nw)) as raw,
    case when sum(case when nw >= 5 and nn >= 5 then 1 else 0 end) >= 2
      then sum(case when nw >= 5 and nn >= 5 then nw*(mw-mn) end)/sum(case when nw >= 5 and nn >= 5 then nw end) end as adj,
    sum(case when nw >= 5 and nn >= 5 then 1 else 0 end) as strata_used
  from j group by itemset, size having sum(nw) < (select n from n)),
members as (select distinct itemset, unnest(string_split(itemset, ' + ')) as item from priced where size >= 2),
best as (select m.itemset, max(s.adj) as best from members m left join priced s on s.itemset = m.item and s.size = 1 group by m.itemset)"""


def money(name: str) -> F.Column:
    return F.round(F.col(name) / 100, 2).alias(name)


def premium_single(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: stratum-adjusted price difference of every item."""
    facts = order_facts(spark, sf)
    singles = item_counts(facts).select(F.col("item").alias("itemset"), F.array("item").alias("items"), "freq")
    narrow = facts.select("y", *STRATA, "items")
    priced = stratified_premium(narrow, contained(narrow, singles), value="y", strata=STRATA)
    return priced.where(F.col("adjusted_premium").isNotNull()).select(
        F.col("itemset").alias("item"), "strata_used", money("adjusted_premium")
    )


def _values(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(spark, sf)
    mined = mine(facts)
    return value_table(facts, mined.itemsets, value="y", strata=STRATA).withColumn("itemset", joined(F.col("items")))


def premium_pair(spark: SparkSession, sf: str) -> DataFrame:
    return _values(spark, sf).where(F.col("size") == 2).select(
        "itemset", "n_with", "strata_used", money("adjusted_premium")
    )


def premium_raw_vs_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    return _values(spark, sf).select(
        "itemset", F.col("size").cast("bigint").alias("size"), "n_with", money("raw_premium"), money("adjusted_premium"),
        "strata_used",
    )


def synergy_pair(spark: SparkSession, sf: str) -> DataFrame:
    return _values(spark, sf).where(F.col("size") >= 2).select(
        "itemset", "freq", "n_with", money("adjusted_premium"), money("best_individual_premium"), money("synergy")
    )


def confound_gap_top(spark: SparkSession, sf: str) -> DataFrame:
    gap = F.abs(F.col("raw_premium") - F.col("adjusted_premium"))
    return (
        _values(spark, sf)
        .where((F.col("size") >= 2) & F.col("adjusted_premium").isNotNull())
        .withColumn("gap", F.round(gap / 100, 2))
        .select("itemset", "n_with", "gap")
        .orderBy(F.desc("gap"), "itemset")
        .limit(10)
    )


def itemsets_brand(spark: SparkSession, sf: str) -> DataFrame:
    mined = mine(order_facts(spark, sf))
    return mined.itemsets.select(joined(F.col("items")).alias("itemset"), F.col("size").cast("bigint").alias("size"), "freq")


def itemsets_type(spark: SparkSession, sf: str) -> DataFrame:
    mined = mine(order_facts(spark, sf, "p_type"))
    return mined.itemsets.select(joined(F.col("items")).alias("itemset"), F.col("size").cast("bigint").alias("size"), "freq")


def rules_type(spark: SparkSession, sf: str) -> DataFrame:
    mined = mine(order_facts(spark, sf, "p_type"))
    return mined.rules.select(
        joined(F.col("antecedent")).alias("antecedent"),
        joined(F.col("consequent")).alias("consequent"),
        *[F.round(c, 6).alias(c) for c in ("confidence", "lift", "support")],
    )


# All subsets of the (six) part types by bit mask: type number i is bit i-1.
TYPE_MASKS = """
t as (select distinct l_orderkey as k, p_type as item from lineitem join part on l_partkey = p_partkey),
bits as (select item, cast(1 as bigint) << cast(row_number() over (order by item) - 1 as integer) as bit from (select distinct item from t)),
masks as (select k, cast(sum(bit) as bigint) as mask from t join bits using (item) group by k),
subsets as (select range as s from range(1, (select cast(sum(bit) as bigint) + 1 from bits))),
named as (select s, string_agg(item, ' + ' order by item) as itemset, count(*) as size from subsets join bits on (s & bit) <> 0 group by s),
freqs as (select s, count(*) as freq from subsets join masks on (mask & s) = s group by s
          having count(*) >= ceil(0.01 * (select count(*) from masks)))"""


def cooccurrence_top(spark: SparkSession, sf: str) -> DataFrame:
    return cooccurrence(line_items(spark, sf, "p_brand"), "k", "item", 20, seed_items=8)


def cooccurrence_row_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The same for distinct items, by pairing inside each (bounded) sorted basket."""
    baskets = collect_baskets(line_items(spark, sf, "p_type"), "k", "item")
    pairs = baskets.select(F.explode(pairs_of(F.col("items"))).alias("p")).groupBy("p.a", "p.b")
    return pairs.agg(F.count(F.lit(1)).alias("pairs"))


def item_topn(spark: SparkSession, sf: str) -> DataFrame:
    mentions = line_items(spark, sf, "p_brand").select(F.array("item").alias("items"))
    return top_items(mentions, 10).select("item", "freq")


def item_floor(spark: SparkSession, sf: str) -> DataFrame:
    return floor_items(line_items(spark, sf, "p_name").select(F.array("item").alias("items")), 45)


QUERIES = {
    "premium_single": (premium_single, f"""with {BASE},
w as (select item, s1, s2, count(*) as nw, sum(y) as sw from b join f using (k) group by item, s1, s2),
j as (select item, nw, n - nw as nn, cast(sw as double)/nw as mw, cast(sy - sw as double)/(n - nw) as mn
      from w join tot using (s1, s2) where n - nw > 0),
u as (select item, sum(nw*(mw-mn))/sum(nw) as prem, count(*) as strata_used from j
      where nw >= 5 and nn >= 5 group by item having count(*) >= 2)
select item, strata_used, round(prem/100, 2) as adjusted_premium from u"""),
    "premium_pair": (premium_pair, f"""with {HELD}
select itemset, cast(n_with as bigint) as n_with, cast(strata_used as bigint) as strata_used, round(adj/100, 2) as adjusted_premium
from priced where size = 2"""),
    "premium_raw_vs_adjusted": (premium_raw_vs_adjusted, f"""with {HELD}
select itemset, cast(size as bigint) as size, cast(n_with as bigint) as n_with, round(raw/100, 2) as raw_premium,
  round(adj/100, 2) as adjusted_premium, cast(strata_used as bigint) as strata_used from priced"""),
    "synergy_pair": (synergy_pair, f"""with {HELD}
select p.itemset, freq, cast(n_with as bigint) as n_with, round(adj/100, 2) as adjusted_premium,
  round(best/100, 2) as best_individual_premium, round((adj - best)/100, 2) as synergy
from priced p join best using (itemset) join mined m on m.itemset = p.itemset"""),
    "confound_gap_top": (confound_gap_top, f"""with {HELD}
select itemset, cast(n_with as bigint) as n_with, round(abs(raw - adj)/100, 2) as gap from priced
where size >= 2 and adj is not null order by gap desc, itemset limit 10"""),
    "itemsets_brand": (itemsets_brand, f"""with {HELD} select itemset, cast(size as bigint) as size, freq from mined"""),
    "itemsets_type": (itemsets_type, f"""with {TYPE_MASKS}
select itemset, size, freq from freqs join named using (s)"""),
    "rules_type": (rules_type, f"""with {TYPE_MASKS},
n as (select count(*) as n from masks)
select a.itemset as antecedent, c.itemset as consequent, round(ab.freq/fa.freq, 6) as confidence,
  round((ab.freq/fa.freq) / (fc.freq/(select n from n)), 6) as lift, round(ab.freq/(select n from n), 6) as support
from freqs ab join bits on (ab.s & bit) <> 0 and ab.s <> bit
join freqs fa on fa.s = ab.s - bit join named a on a.s = fa.s
join freqs fc on fc.s = bit join named c on c.s = bit
where ab.freq/fa.freq >= 0.4"""),
    "cooccurrence_top": (cooccurrence_top, """
with m as (select l_orderkey as k, p_brand as item, count(*) as m from lineitem join part on l_partkey = p_partkey group by 1, 2)
select x.item as a, y.item as b, cast(sum(case when x.item = y.item then x.m * (x.m - 1) // 2 else x.m * y.m end) as bigint) as pairs
from m x join m y on x.k = y.k and x.item <= y.item group by 1, 2 having pairs > 0 order by pairs desc, a, b limit 20"""),
    "array_pairs": (cooccurrence_row_pairs, """
with t as (select distinct l_orderkey as k, p_type as item from lineitem join part on l_partkey = p_partkey)
select x.item as a, y.item as b, count(*) as pairs from t x join t y on x.k = y.k and x.item < y.item group by 1, 2"""),
    "item_topn": (item_topn, """
select p_brand as item, count(*) as freq from lineitem join part on l_partkey = p_partkey
group by 1 order by freq desc, item limit 10"""),
    "item_floor": (item_floor, """
select p_name as item, count(*) as freq from lineitem join part on l_partkey = p_partkey group by 1 having count(*) >= 45"""),
}
