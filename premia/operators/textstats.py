"""Relational text statistics: term counts, TF-IDF, stop-word removal, label leakage into text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.text import tokens
from premia.session import materialize


def term_stats(df: DataFrame, tokens_col: str, *, group: Sequence[str] = ()) -> DataFrame:
    """(term, total, df): mentions and rows holding the term, in one scan.

    Each row emits its mentions and then its distinct terms, combined map-side by term: no shuffle by
    (row, term).
    """
    both = F.posexplode(F.array(F.col(tokens_col), F.array_distinct(tokens_col))).alias("kind", "terms")
    terms = df.select(*group, both).select(*group, "kind", F.explode("terms").alias("term"))
    mentions, rows = F.count(F.when(F.col("kind") == 0, 1)), F.count(F.when(F.col("kind") == 1, 1))
    return terms.groupBy(*group, "term").agg(mentions.alias("total"), rows.alias("df"))


def vocabulary(stats: DataFrame, size: int, min_df: int) -> DataFrame:
    """The ``size`` most mentioned terms held by at least ``min_df`` rows; ties by term."""
    return stats.where(F.col("df") >= min_df).orderBy(F.desc("total"), "term").limit(size)


def idf(n_rows: int | Column, df: Column) -> Column:
    n = F.lit(n_rows) if isinstance(n_rows, int) else n_rows
    return F.log((n + 1.0) / (df + 1.0))


def tfidf(
    df: DataFrame, id_col: str, tokens_col: str, *, size: int, min_df: int, excluded: DataFrame | None = None
) -> DataFrame:
    """(id, term, tfidf) for the vocabulary terms of every row.

    ``excluded(term)`` is taken out of the term statistics, which leaves every other term's counts as they
    are, so no text is joined. Tokens outside the vocabulary (a top-``size`` table, so broadcast) are dropped
    before rows are counted.
    """
    stats = term_stats(df, tokens_col)
    if excluded is not None:
        stats = stats.join(excluded.select("term"), "term", "left_anti")
    vocab = materialize(vocabulary(stats, size, min_df))
    weight = idf(df.count(), F.col("df"))
    known = F.broadcast(vocab.select("term", weight.alias("_idf")))
    terms = df.select(id_col, F.explode(tokens_col).alias("term")).join(known, "term")
    return terms.groupBy(id_col, "term").agg((F.count(F.lit(1)) * F.first("_idf")).alias("tfidf"))


def exclusion_tokens(names: DataFrame, column: str) -> DataFrame:
    """Distinct word tokens of a vocabulary's names: what a text vocabulary must not contain."""
    return names.select(F.explode(tokens(F.col(column))).alias("term")).distinct()


def without_terms(df: DataFrame, id_col: str, tokens_col: str, excluded: DataFrame) -> DataFrame:
    """(id, term) mentions that are not among the excluded terms."""
    return df.select(id_col, F.explode(tokens_col).alias("term")).join(excluded.select("term"), "term", "left_anti")


def leakage(df: DataFrame, items_col: str, text_col: str) -> DataFrame:
    """One row: share of a row's own items found verbatim in its text, on average, and share of rows with all found."""
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    # The item loop runs inside the row: texts are neither copied per item nor shuffled.
    found = F.size(F.filter(items_col, lambda i: F.contains(text, F.lower(i))))
    rows = df.where(F.size(items_col) > 0).select((found / F.size(items_col)).alias("share"))
    return rows.agg(
        F.avg("share").alias("mean_share"),
        F.avg(F.when(F.col("share") == 1, 1.0).otherwise(0.0)).alias("all_found"),
        F.count(F.lit(1)).alias("rows"),
    )
