"""Registered queries: metrics of scored frames, market signal, regression scores, attribution tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.hashing import split_label
from premia.operators import attribute, metrics
from premia.operators.baskets import item_counts
from premia.plans.prep import HASH32
from premia.plans.tables import SCORED_SQL, order_facts, scored, table
from premia.session import materialize

METRICS = ["precision", "recall", "f1", "accuracy"]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.ranking_metrics(scored(spark, sf))
    return rounded(out.select("item", "model", "threshold", "f1"), "f1")


def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.ranking_metrics(scored(spark, sf))
    return rounded(out.select("item", "model", "average_precision"), "average_precision")


def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.ranking_metrics(scored(spark, sf))
    return rounded(out.select("item", "model", "roc_auc", "positives", "n"), "roc_auc")


def roc_auc_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same on every order line: does the discounted price rank returned lines?"""
    lines = table(spark, sf, "lineitem").select(
        "l_linestatus", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 10000).cast("bigint").alias("score"),
    )
    out = metrics.ranking_metrics(lines, group=["l_linestatus"], default=0)
    return rounded(out.select("l_linestatus", F.col("threshold").cast("bigint").alias("threshold"), "average_precision", "roc_auc", "n"), "average_precision", "roc_auc")


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf).withColumn("threshold", F.lit(0.5))
    return rounded(metrics.confusion_metrics(rows), *METRICS)


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    labelled = scored(spark, sf).where(F.col("model") == "m97")
    return rounded(metrics.class_weights(labelled), "weight")


def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per (source, item, label) and only where both classes occur."""
    labelled = scored(spark, sf).where(F.col("model") == "m97")
    both = metrics.evaluable(labelled, group=["source", "item"])
    return metrics.class_counts(labelled, group=["source", "item"]).join(both, ["source", "item"], "left_semi")


def majority_baseline(spark: SparkSession, sf: str) -> DataFrame:
    rates = metrics.positive_rates(scored(spark, sf).where(F.col("model") == "m97"))
    return rounded(rates, "positive_rate", "majority_baseline_acc")


def representative_items(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(spark, sf, "p_type")
    n = facts.agg(F.count(F.lit(1))).scalar()
    rates = item_counts(facts).select("item", (F.col("freq") / n).alias("positive_rate"))
    return rounded(metrics.representative(rates), "positive_rate")


def _results(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.ranking_metrics(scored(spark, sf), group=["source", "item", "model"], min_positives=1)


def best_model_per_item(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.best_per_item(_results(spark, sf).withColumn("key", F.concat_ws("/", "source", "item")), "average_precision", item="key")
    return rounded(out, "average_precision")


def macro_by_model(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.macro_by_model(_results(spark, sf), ["average_precision", "roc_auc"]), "average_precision", "roc_auc")


def metric_report(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds chosen on the val slice (default where it is too thin), everything else on the test slice."""
    rows = materialize(scored(spark, sf).withColumn("split", split_label(F.col("doc_id"), method="md5")))
    thresholds = metrics.ranking_metrics(rows.where("split = 'val'")).where(F.col("model") == "m97")
    test = rows.where("split = 'test'")
    out = metrics.metric_report(test, thresholds, metrics.ranking_metrics(test))
    return rounded(out, *METRICS, "positive_rate", "majority_baseline_acc", "average_precision", "roc_auc")


def before_after_delta(spark: SparkSession, sf: str) -> DataFrame:
    results = materialize(_results(spark, sf))
    before, after = results.where("model = 'm97'"), results.where("model = 'm53'")
    out = metrics.before_after(before, after, ["average_precision", "roc_auc"], keys=["source", "item"])
    return rounded(out, *[c for c in out.columns if c not in ("source", "item")])


def _line_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line as a scored row: brand = item, returned = label, discount percent = score, stratum = group."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_discount")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("grp"), F.col("p_brand").alias("item"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"), F.round(F.col("l_discount") * 100).cast("int").alias("score"),
    )


def _signal(spark: SparkSession, sf: str) -> DataFrame:
    rows = _line_scores(spark, sf)
    means = metrics.group_means(rows, group="grp", min_rows=5)
    overall = rows.groupBy("item").agg(F.avg("y").alias("actual"))
    return metrics.spearman_by_group(means, overall, group="grp")


def group_means(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.group_means(_line_scores(spark, sf), group="grp", min_rows=10), "actual", "predicted")


def group_vs_overall(spark: SparkSession, sf: str) -> DataFrame:
    """Each group's rate next to the whole table's."""
    rows = _line_scores(spark, sf)
    whole = rows.agg(F.avg("y")).scalar()
    out = rows.groupBy("grp").agg(F.avg("y").alias("rate"), F.count(F.lit(1)).alias("n"))
    return out.select("grp", "n", F.round("rate", 6).alias("rate"), F.round(F.col("rate") - whole, 6).alias("over_all"))


def spearman_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_signal(spark, sf), "model_corr", "baseline_corr")


def signal_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.signal_summary(_signal(spark, sf)), "model_corr", "baseline_corr")


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    """Two given predictions of the line price: 1500 per unit, and the mean price."""
    lines = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), "l_quantity", "l_returnflag")
    mean = table(spark, sf, "lineitem").agg(F.round(F.avg("l_extendedprice"), 2)).scalar()
    model = F.explode(F.array(
        F.struct(F.lit("per_unit").alias("model"), (F.col("l_quantity") * 1500.0).alias("prediction")),
        F.struct(F.lit("mean").alias("model"), F.col("_mean").alias("prediction")),
    ))
    return lines.withColumn("_mean", mean).select("y", "l_returnflag", model.alias("m")).select("y", "l_returnflag", "m.*")


def regression_scores(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.regression_metrics(_predicted(spark, sf), group=["model", "l_returnflag"])
    return rounded(rounded(out, "r2"), "rmse", "mae", digits=3)


def incremental_gain(spark: SparkSession, sf: str) -> DataFrame:
    evals = metrics.regression_metrics(_predicted(spark, sf), group=["model"])
    out = metrics.gain_over(evals, "mean", "per_unit")
    return rounded(rounded(out, "r2_gain", "rmse_saved_share"), "rmse_saved", digits=3)


def _contributions(spark: SparkSession, sf: str) -> DataFrame:
    """Given contributions: the line's discount points, for the brands of every line, by return flag."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus", F.round(F.col("l_discount") * 100).cast("int").alias("contribution"))
    part = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("item"))
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey"))


def attribution_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    out = attribute.by_segment(_contributions(spark, sf).withColumnRenamed("l_returnflag", "segment"), ["A", "N", "R"])
    return rounded(out, "mean_0", "mean_1", "mean_2", "spread")


def attribution_by_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = _contributions(spark, sf).withColumn("segment", F.col("l_linestatus") == "O")
    return rounded(attribute.by_segment(flagged, [False, True]), "mean_0", "mean_1", "spread")


def coefficient_spread(spark: SparkSession, sf: str) -> DataFrame:
    """Mean discount points per brand in each return-flag segment as given coefficients, and their spread."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", F.round(F.col("l_discount") * 100).cast("int").alias("c"))
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    wide = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").pivot("l_returnflag", ["A", "N", "R"]).agg(F.avg("c"))
    return rounded(attribute.spread_of(wide, ["A", "N", "R"]), "A", "N", "R", "spread")


SWEEP = """
{name} as (select {g}, score, sum(y) as pos, count(*) as cnt from {src} group by all),
{name}_c as (select *, sum(pos) over w as tp, sum(cnt) over w as pp, sum(pos) over (partition by {g}) as p, sum(cnt) over (partition by {g}) as n
  from {name} window w as (partition by {g} order by score desc)),
{name}_f as (select *, 2 * tp / (pp + p) as f1 from {name}_c),
{name}_t as (select {g}, case when max(p) >= {minpos} then arg_max(score, (f1, -score)) else 0.5 end as threshold, case when max(p) >= {minpos} then max(f1) end as f1,
  case when max(p) = 0 then 0.0 else sum(pos * (tp / pp)) / max(p) end as average_precision,
  sum(pos * ((n - p) - (pp - tp) + (cnt - pos) / 2.0)) / nullif(max(p) * (max(n) - max(p)), 0) as roc_auc, cast(max(p) as bigint) as positives, cast(max(n) as bigint) as n
  from {name}_f group by {g})"""
ALL_SWEEP = SCORED_SQL + "," + SWEEP.format(name="sw", g="item, model", src="scored", minpos=5)
BY_SOURCE = SCORED_SQL + "," + SWEEP.format(name="sw", g="source, item, model", src="scored", minpos=1)
CONFUSION = """count(*) filter (where score >= threshold and y = 1) as tp, count(*) filter (where score >= threshold and y = 0) as fp,
  count(*) filter (where score < threshold and y = 1) as fn, count(*) filter (where score < threshold and y = 0) as tn"""
RATES = """round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy"""
LINES = """
r as (select o_orderpriority || '|' || o_orderstatus as grp, p_brand as item, case when l_returnflag = 'R' then 1 else 0 end as y, cast(round(l_discount * 100) as int) as score
  from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey),
gm as (select grp, item, avg(y) as actual, avg(score) as predicted, count(*) as n from r group by all)"""
SIGNAL = LINES + """,
ok as (select grp from gm group by grp having min(n) >= 5),
ov as (select item, avg(y) as overall from r group by item),
rk as (select grp, n, rank() over (partition by grp order by actual) + (count(*) over (partition by grp, actual) - 1) / 2.0 as ra,
    rank() over (partition by grp order by predicted) + (count(*) over (partition by grp, predicted) - 1) / 2.0 as rp,
    rank() over (partition by grp order by overall) + (count(*) over (partition by grp, overall) - 1) / 2.0 as ro
  from gm semi join ok using (grp) join ov using (item)),
sig as (select grp, max(n) as n, corr(ra, rp) as model_corr, corr(ra, ro) as baseline_corr from rk group by grp)"""
PREDICTED = """
l as (select l_extendedprice as y, l_quantity, l_returnflag from lineitem),
pr as (select y, l_returnflag, 'per_unit' as model, l_quantity * 1500.0 as prediction from l
  union all select y, l_returnflag, 'mean', (select round(avg(y), 2) from l) from l)"""
REGRESSION = "1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) as r2, sqrt(avg((y - prediction) * (y - prediction))) as rmse, avg(abs(y - prediction)) as mae, count(*) as n"

QUERIES = {
    "best_threshold": (best_threshold, f"with {ALL_SWEEP} select item, model, threshold, round(f1, 6) as f1 from sw_t"),
    "average_precision": (average_precision, f"with {ALL_SWEEP} select item, model, round(average_precision, 6) as average_precision from sw_t"),
    "roc_auc": (roc_auc, f"with {ALL_SWEEP} select item, model, round(roc_auc, 6) as roc_auc, positives, n from sw_t"),
    "roc_auc_lines": (roc_auc_lines, "with ln as (select l_linestatus, case when l_returnflag = 'R' then 1 else 0 end as y, cast(round(l_extendedprice * (1 - l_discount) * 10000) as bigint) as score from lineitem),"
        + SWEEP.format(name="sw", g="l_linestatus", src="ln", minpos=5) + """
select l_linestatus, cast(threshold as bigint) as threshold, round(average_precision, 6) as average_precision, round(roc_auc, 6) as roc_auc, n from sw_t"""),
    "confusion_metrics": (confusion_metrics, f"""with {SCORED_SQL},
t as (select item, model, {CONFUSION.replace('threshold', '0.5')} from scored group by item, model)
select item, model, tp, fp, fn, tn, {RATES} from t"""),
    "class_weights": (class_weights, f"""with {SCORED_SQL}, c as (select item, y, count(*) as n_class from scored where model = 'm97' group by all)
select item, y, n_class, round(sum(n_class) over (partition by item) / (count(*) over (partition by item) * n_class), 6) as weight from c"""),
    "class_counts": (class_counts, f"""with {SCORED_SQL}, c as (select source, item, y, count(*) as n_class from scored where model = 'm97' group by all)
select * from c qualify count(*) over (partition by source, item) = 2"""),
    "majority_baseline": (majority_baseline, f"""with {SCORED_SQL}
select item, round(avg(y), 6) as positive_rate, round(greatest(avg(y), 1 - avg(y)), 6) as majority_baseline_acc from scored where model = 'm97' group by item"""),
    "representative_items": (representative_items, """
with b as (select distinct l_orderkey as k, p_type as item from lineitem join part on l_partkey = p_partkey),
r as (select item, count(*) / (select count(distinct k) from b) as rate from b group by item)
select item, round(rate, 6) as positive_rate from r order by abs(rate - 0.5), item limit 3"""),
    "best_model_per_item": (best_model_per_item, f"""with {BY_SOURCE}
select source || '/' || item as key, model, round(average_precision, 6) as average_precision from sw_t
qualify row_number() over (partition by source, item order by average_precision desc, model) = 1"""),
    "macro_by_model": (macro_by_model, f"""with {BY_SOURCE}
select model, round(avg(average_precision), 6) as average_precision, round(avg(roc_auc), 6) as roc_auc from sw_t group by model"""),
    "metric_report": (metric_report, f"""with
sp as (select r.range as g, case when r.range % 2 = 0 then quality else toxic end as y,
    case when r.range < 2 then round((n_chars % 97) / 97.0, 4) else round(((n_chars + 7 * d.doc_id) % 53) / 53.0, 4) end as score,
    {HASH32.format('cast(d.doc_id as varchar)')} % 100 as h from documents d join labels l on d.doc_id = l.doc_id cross join range(4) r),
val as (select * from sp where h >= 65 and h < 80), test as (select * from sp where h >= 80),
{SWEEP.format(name="v", g="g", src="val", minpos=5)},
{SWEEP.format(name="t", g="g", src="test", minpos=5)},
w as (select test.*, coalesce(case when test.g < 2 then v_t.threshold end, 0.5) as threshold from test left join v_t using (g)),
c as (select g, {CONFUSION}, avg(y) as rate from w group by g)
select case when g % 2 = 0 then 'quality' else 'toxic' end as item, case when g < 2 then 'm97' else 'm53' end as model, {RATES},
  round(rate, 6) as positive_rate, round(greatest(rate, 1 - rate), 6) as majority_baseline_acc,
  round(average_precision, 6) as average_precision, round(roc_auc, 6) as roc_auc from c join (select g, average_precision, roc_auc from t_t) using (g)"""),
    "before_after_delta": (before_after_delta, f"""with {BY_SOURCE}
select source, item, round(b.average_precision, 6) as average_precision_before, round(b.roc_auc, 6) as roc_auc_before,
  round(a.average_precision, 6) as average_precision_after, round(a.roc_auc, 6) as roc_auc_after,
  round(a.average_precision - b.average_precision, 6) as average_precision_delta, round(a.roc_auc - b.roc_auc, 6) as roc_auc_delta
from (select * from sw_t where model = 'm97') b join (select * from sw_t where model = 'm53') a using (source, item)"""),
    "group_means": (group_means, f"""with {LINES}
select grp, item, round(actual, 6) as actual, round(predicted, 6) as predicted, n from gm semi join (select grp from gm group by grp having min(n) >= 10) using (grp)"""),
    "group_vs_overall": (group_vs_overall, f"""with {LINES}
select grp, count(*) as n, round(avg(y), 6) as rate, round(avg(y) - (select avg(y) from r), 6) as over_all from r group by grp"""),
    "spearman_by_group": (spearman_by_group, f"with {SIGNAL} select grp, n, round(model_corr, 6) as model_corr, round(baseline_corr, 6) as baseline_corr from sig"),
    "signal_summary": (signal_summary, f"""with {SIGNAL}
select round(avg(model_corr), 6) as model_corr, round(avg(baseline_corr), 6) as baseline_corr, count(*) filter (where model_corr > baseline_corr) as wins, count(*) as groups from sig"""),
    "regression_scores": (regression_scores, f"""with {PREDICTED}, m as (select model, l_returnflag, {REGRESSION} from pr group by all)
select model, l_returnflag, round(r2, 6) as r2, round(rmse, 3) as rmse, round(mae, 3) as mae, n from m"""),
    "incremental_gain": (incremental_gain, f"""with {PREDICTED}, m as (select model, {REGRESSION} from pr group by all)
select round(f.r2 - b.r2, 6) as r2_gain, round(b.rmse - f.rmse, 3) as rmse_saved, round((b.rmse - f.rmse) / b.rmse, 6) as rmse_saved_share
from m f, m b where f.model = 'per_unit' and b.model = 'mean'"""),
    "attribution_by_segment": (attribution_by_segment, """
with c as (select p_name as item, l_returnflag as seg, cast(round(l_discount * 100) as int) as v from lineitem join part on l_partkey = p_partkey),
a as (select item, avg(v) filter (where seg = 'A') as m0, count(*) filter (where seg = 'A') as n0, avg(v) filter (where seg = 'N') as m1,
  count(*) filter (where seg = 'N') as n1, avg(v) filter (where seg = 'R') as m2, count(*) filter (where seg = 'R') as n2 from c group by item having count(*) >= 15)
select item, round(m0, 6) as mean_0, n0 as n_0, round(m1, 6) as mean_1, n1 as n_1, round(m2, 6) as mean_2, n2 as n_2,
  round(greatest(m0, m1, m2) - least(m0, m1, m2), 6) as spread from a where n0 >= 10 and n1 >= 10 and n2 >= 10"""),
    "attribution_by_flag": (attribution_by_flag, """
with c as (select p_name as item, l_linestatus = 'O' as seg, cast(round(l_discount * 100) as int) as v from lineitem join part on l_partkey = p_partkey),
a as (select item, avg(v) filter (where not seg) as m0, count(*) filter (where not seg) as n0, avg(v) filter (where seg) as m1, count(*) filter (where seg) as n1
  from c group by item having count(*) >= 15)
select item, round(m0, 6) as mean_0, n0 as n_0, round(m1, 6) as mean_1, n1 as n_1, round(abs(m0 - m1), 6) as spread from a where n0 >= 10 and n1 >= 10"""),
    "coefficient_spread": (coefficient_spread, """
with a as (select p_brand, avg(cast(round(l_discount * 100) as int)) filter (where l_returnflag = 'A') as a, avg(cast(round(l_discount * 100) as int)) filter (where l_returnflag = 'N') as n,
  avg(cast(round(l_discount * 100) as int)) filter (where l_returnflag = 'R') as r from lineitem join part on l_partkey = p_partkey group by 1)
select p_brand, round(a, 6) as "A", round(n, 6) as "N", round(r, 6) as "R", round(greatest(a, n, r) - least(a, n, r), 6) as spread from a"""),
}
