"""Registered queries: tokens, TF-IDF, HTML, exclusion terms, leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.functions.text import strip_html, tokens
from premia.operators import textstats
from premia.plans.tables import order_facts, table, texts

# A short list given to the operator; the feature fit uses Spark ML's full lists.
STOP = ["the", "and", "of", "to", "in", "is", "for", "der", "die", "und", "les", "des", "que", "los"]


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "documents", "doc_id", "lang", "text").select("doc_id", "lang", tokens(F.col("text")).alias("tokens"))


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return textstats.term_stats(_tokens(spark, sf), "tokens", group=["lang"])


def tfidf_terms(spark: SparkSession, sf: str) -> DataFrame:
    out = textstats.tfidf(_tokens(spark, sf), "doc_id", "tokens", size=300, min_df=5)
    return out.withColumn("tfidf", F.round("tfidf", 6))


def page_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """Description features: HTML stripped, exclusion terms out, then TF-IDF."""
    pages = texts(spark, sf, "pages", "page_id", "html").select("page_id", tokens(strip_html(F.col("html"))).alias("tokens"))
    excluded = textstats.exclusion_tokens(table(spark, sf, "part"), "p_name")
    out = textstats.tfidf(pages, "page_id", "tokens", size=800, min_df=10, excluded=excluded)
    return out.withColumn("tfidf", F.round("tfidf", 6))


def html_strip_len(spark: SparkSession, sf: str) -> DataFrame:
    stripped = strip_html(F.col("html"))
    return texts(spark, sf, "pages", "page_id", "html").select(
        "page_id", F.length(stripped).cast("bigint").alias("n"), F.md5(stripped).alias("text_md5")
    )


def exclusion_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return textstats.exclusion_tokens(table(spark, sf, "part"), "p_name")


def stopword_removed(spark: SparkSession, sf: str) -> DataFrame:
    excluded = spark.createDataFrame([(w,) for w in STOP], "term string")
    kept = textstats.without_terms(_tokens(spark, sf), "doc_id", "tokens", excluded)
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("term")).alias("chars"))


def leakage_probe(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf, "documents", "lang", "source", "text").select(F.array("lang", F.substring("source", 1, 3), "source").alias("items"), "text")
    out = textstats.leakage(docs, "items", "text")
    return out.select(F.round("mean_share", 6).alias("mean_share"), F.round("all_found", 6).alias("all_found"), "rows")


def item_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """TF-IDF of the items themselves - the leaky baseline, kept for contrast."""
    out = textstats.tfidf(order_facts(spark, sf).select("k", "items"), "k", "items", size=500, min_df=5)
    return out.select("k", F.col("term").alias("item"), F.round("tfidf", 6).alias("tfidf"))


def tok(source: str, text: str, key: str) -> str:
    """CTE of (key, term), one row per mention."""
    return f"""tk as (select {key}, term from (select {key}, unnest(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+')) as term from {source}) where length(term) >= 2)"""


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
QUERIES = {
    "tokens_df": (token_counts, f"""with {tok('documents', 'text', 'doc_id, lang')}
select lang, term, cast(count(*) as bigint) as total, count(distinct doc_id) as df from tk group by all"""),
    "tfidf_terms": (tfidf_terms, f"""with {tok('documents', 'text', 'doc_id')},
v as (select term, count(*) as total, count(distinct doc_id) as df from tk group by term having df >= 5 order by total desc, term limit 300)
select doc_id, term, round(count(*) * ln(((select count(*) from documents) + 1.0) / (any_value(df) + 1.0)), 6) as tfidf from tk join v using (term) group by doc_id, term"""),
    "page_tfidf": (page_tfidf, f"""with {tok('pages', "regexp_replace(html, '<[^>]+>', ' ', 'g')", 'page_id')},
ex as (select distinct term from (select unnest(string_split_regex(lower(p_name), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+')) as term from part) where length(term) >= 2),
c as (select page_id, term, count(*) as tf from tk anti join ex using (term) group by all),
v as (select term, sum(tf) as total, count(*) as df from c group by term having df >= 10 order by total desc, term limit 800)
select page_id, term, round(tf * ln(((select count(*) from pages) + 1.0) / (df + 1.0)), 6) as tfidf from c join v using (term)"""),
    "html_strip_len": (html_strip_len, """
select page_id, length(regexp_replace(html, '<[^>]+>', ' ', 'g')) as n, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) as text_md5 from pages"""),
    "exclusion_tokens": (exclusion_tokens, f"with {tok('part', 'p_name', 'p_partkey')} select distinct term from tk"),
    "stopword_removed": (stopword_removed, f"""with {tok('documents', 'text', 'doc_id')}
select doc_id, count(*) as n, cast(sum(length(term)) as bigint) as chars from tk where term not in ({_STOP_SQL}) group by doc_id"""),
    "leakage_probe": (leakage_probe, """
with s as (select (cast(contains(lower(text), lang) as int) + cast(contains(lower(text), substr(source, 1, 3)) as int) + cast(contains(lower(text), source) as int)) / 3.0 as share from documents)
select round(avg(share), 6) as mean_share, round(avg(case when share = 1 then 1.0 else 0 end), 6) as all_found, count(*) as rows from s"""),
    "item_tfidf": (item_tfidf, """
with b as (select distinct l_orderkey as k, p_brand as item from lineitem join part on l_partkey = p_partkey),
v as (select item, count(*) as df from b group by item having df >= 5 order by df desc, item limit 500)
select k, item, round(ln(((select count(distinct k) from b) + 1.0) / (df + 1.0)), 6) as tfidf from b join v using (item)"""),
}
