"""Quality rules: thresholds from mergeable quantile sketches per language and source, then a joined filter.

Everything is DataFrame functions. One scan reduces each text to a few numbers; KLL sketches of these are built per
(language, source), merged per language and overall, and a document is judged by the fences of the smallest of these
groups that holds enough documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.session import broadcast_checked, materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Share, its least spread, and the sides that are judged.
MEASURES = {
    "symbol_share": (0.02, "upper"),
    "mark_share": (0.04, "upper"),
    "capital_share": (0.10, "upper"),
    "dup_line_share": (0.10, "upper"),
    "repeat_share": (0.10, "upper"),
    "word_length": (1.50, "both"),
}
WIDTH = 3.0
LEAST_ROWS = 200
SKETCH_K = 4096


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_marks, n_capitals (long) of whole texts.

    Null text has no words. Repeats are found by the 64-bit hashes of 3-word windows: equal windows meet after sorting
    (hash, place), and the words covered are the union of the repeated windows. The work stays in the row.
    """
    t = F.coalesce(docs[text], F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    bare = lambda chars: F.length(F.translate(t, chars, ""))
    df = docs.withColumns({"_w": F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), "_l": lines})
    n = F.size("_w")
    window = lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
    df = df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": bare(" \t\n\x0b\x0c\r").cast("long"),
        "n_symbols": (F.length(t) - bare(SYMBOLS)).cast("long"),
        "n_marks": F.length(F.regexp_replace(t, r"[\p{L}\p{M}\p{N}\x20\x09-\x0D]+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_h": F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)),
    }).drop("_w", "_l")
    placed = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), placed)).drop("_h")
    twice = F.filter("_s", lambda x, j: (F.get("_s", j - 1)["h"] == x["h"]) | (F.get("_s", j + 1)["h"] == x["h"]))
    df = df.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_s")
    steps = F.zip_with("_p", F.slice("_p", F.lit(2), F.greatest(F.size("_p"), F.lit(0))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_p")


def _shares() -> dict[str, Column]:
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "symbol_share": F.col("n_symbols") / chars,
        "mark_share": F.col("n_marks") / chars,
        "capital_share": F.col("n_capitals") / chars,
        "dup_line_share": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "word_length": chars / words,
    }


def fences(measured: DataFrame, width: float = WIDTH, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Per (lang, source) the lower and upper fence of each measure, ``<measure>_low`` and ``<measure>_high``.

    Fence: quartile -/+ ``width`` x the quartile distance, which counts as no less than the measure's least spread.
    Sketches of groups under ``least_rows`` documents give way to their language's, then to all documents'.
    """
    names = list(MEASURES)
    per_group = materialize(measured.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(m, SKETCH_K).alias(m) for m in names]
    ))
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, SKETCH_K).alias(m) for m in names]]
    by_lang = per_group.groupBy("lang").agg(*merged)
    points = [(m, q) for m in names for q in (0.25, 0.75)]
    quartile = lambda m, q: F.kll_sketch_get_quantile_double(m, F.lit(q))
    overall = [0.0] * len(points)  # an empty table is judged by nothing
    if not per_group.isEmpty():
        overall = per_group.agg(*merged).select(*[quartile(m, q) for m, q in points]).first()
    quartiles = lambda df, tag: df.select(
        *[c for c in ("lang", "source") if c in df.columns], F.col("n").alias(f"n_{tag}"),
        *[quartile(m, q).alias(f"{m}_{q * 100:.0f}_{tag}") for m, q in points],
    )
    group = quartiles(per_group, "g").join(quartiles(by_lang, "l"), "lang")
    usual = dict(zip(points, overall))

    def pick(m: str, q: float) -> Column:
        at = lambda tag: F.col(f"{m}_{q * 100:.0f}_{tag}")
        return F.when(F.col("n_g") >= least_rows, at("g")).when(F.col("n_l") >= least_rows, at("l")).otherwise(F.lit(usual[m, q]).cast("double"))

    out = []
    for m, (spread, sides) in MEASURES.items():
        reach = width * F.greatest(pick(m, 0.75) - pick(m, 0.25), F.lit(spread))
        if sides == "both":
            out.append((pick(m, 0.25) - reach).alias(f"{m}_low"))
        out.append((pick(m, 0.75) + reach).alias(f"{m}_high"))
    return group.select("lang", "source", *out)


def _failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _within() -> Column:
    """Is a counted row with its group's fences inside all of them?"""
    within = F.lit(True)
    for m, (_, sides) in MEASURES.items():
        within &= F.col(m) <= F.col(f"{m}_high")
        if sides == "both":
            within &= F.col(m) >= F.col(f"{m}_low")
    return within


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    base_failed: under 50 words, or more than half the words in repeated 3-word windows. kept: not base_failed and
    within all fences of the row's group; fences come from the rows that pass the base rules. Null and empty labels are
    one group. Null and empty texts fail. Rows are judged one by one, so repeated rows and null ids come back as they
    are; other columns are ignored. An empty table gives an empty result.
    """
    slim = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[lang], F.lit("")).alias("lang"), F.coalesce(docs[source], F.lit("")).alias("source"), docs[text].alias("text"))
    counted = materialize(text_counts(slim).drop("text").withColumn("base_failed", _failed()))
    passing = counted.where("not base_failed").withColumns(_shares())
    limits = materialize(fences(passing))
    joined = passing.join(broadcast_checked(limits), ["lang", "source"], "left")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    good = joined.select(F.col("_id").alias(id_col), *columns, _within().alias("kept"))
    return good.unionByName(counted.where("base_failed").select(F.col("_id").alias(id_col), *columns, F.lit(False).alias("kept")))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` without the rows that `judge` rejects; all columns stay.

    Rows are judged by their own text, so null and repeated ids do not matter. The counted rows are written once with all
    their columns, so that the verdict needs no join back.
    """
    labels = [F.coalesce(docs[lang], F.lit("")).alias("lang"), F.coalesce(docs[source], F.lit("")).alias("source")]
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), *labels, docs[text].alias("text"))
    counted = materialize(text_counts(rows).drop("text"))
    passing = counted.where(~_failed()).withColumns(_shares())
    limits = materialize(fences(passing))
    return passing.join(broadcast_checked(limits), ["lang", "source"]).where(_within()).select("_row.*")
