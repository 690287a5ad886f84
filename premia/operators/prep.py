"""Row preparation: features of a posting, usable rows, bucketing, duplicates, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.hashing import hash_int
from premia.functions.items import basket_items, item_column, item_names, label_items, multi_hot
from premia.functions.text import seniority
from premia.operators.ordered import dense_index
from premia.sources.results import keep_first

# Fixed values of the posting domain.
TOP_EMPLOYERS = ["СБЕР", "Яндекс", "Ozon", "Т-Банк", "VK", "МТС"]
MAJOR_CITIES = ["Москва", "Санкт-Петербург"]
WORK_FORMATS = ["ON_SITE", "REMOTE", "HYBRID", "FIELD_WORK"]
NET_OF_GROSS = 0.87
CURRENCY = "RUR"
DEDUP_KEY = ["name", "employer.name", "description"]


def basic_features(df: DataFrame, top_employers: Sequence[str] = TOP_EMPLOYERS) -> DataFrame:
    """Posting columns plus seniority, cleaned items, city, employer name, mid salary, flags."""
    names = item_names(df, item_column(df))
    low, high = F.col("salary")["from"], F.col("salary")["to"]
    return df.select(
        *[c for c in df.columns if c != "employer"],
        F.coalesce(seniority(F.col("name")), F.lit("Unknown")).alias("seniority"),
        label_items(names).alias("items"),
        F.col("area.name").alias("city"),
        F.col("employer.name").alias("employer"),
        F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2).alias("salary_avg"),
        F.when(low.isNotNull() & high.isNotNull(), 1).otherwise(0).alias("has_salary"),
        F.when(F.col("employer.name").isin(list(top_employers)), 1).otherwise(0).alias("is_top_employer"),
        F.col("experience.id").alias("experience_bucket"),
        *multi_hot("work_format", WORK_FORMATS, "work_format_"),
    ).withColumn("items_count", F.size("items"))


def content_key(columns: Sequence[str]) -> Column:
    """Null-safe digest of the content columns: nulls equal each other and differ from every text."""
    parts = [
        F.concat(F.lit("\u0001"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))
        for c in columns
    ]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("\u0002")) for p in parts]), 256)


def dedupe(
    df: DataFrame, columns: Sequence[str] = DEDUP_KEY, id_col: str = "id", *, keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per distinct content: the one with the lowest id.

    Rows are grouped by a digest, so texts are not compared, and copies are dropped before the shuffle: a text that
    makes up a third of the table costs one row per task. The columns that travel are sorted along with the digest;
    with ``keep`` only those travel - leave the texts out when they are needed for the comparison alone.
    """
    keyed = df.withColumn("_content", F.unhex(content_key(columns)))  # half the bytes of the hex text
    if keep is not None:
        keyed = keyed.select("_content", *dict.fromkeys([id_col, *keep]))
    return keep_first(keyed, ["_content"], id_col).drop("_content")


def major_or_other(column: Column, majors: Sequence[str] = MAJOR_CITIES, other: str = "Other") -> Column:
    return F.when(column.isin(list(majors)), column).otherwise(F.lit(other))


def top_n_or_other(df: DataFrame, column: str, n: int, out: str, other: str = "Other") -> DataFrame:
    """Values outside the n most frequent (ties by name), and nulls, become 'Other'.

    Nulls compete for a place in the top n and are then removed from it, as in a frequency table that counts them.
    """
    top = (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), F.asc_nulls_last(column)).limit(n)
        .where(F.col(column).isNotNull()).select(F.col(column), F.col(column).alias(out))
    )
    return df.join(F.broadcast(top), column, "left").withColumn(out, F.coalesce(out, F.lit(other)))


def usable_flags(df: DataFrame, *, require_ceiling: bool = True, currency: str = CURRENCY) -> DataFrame:
    """The frame with its basket and the two funnel flags: enough items, and a usable salary."""
    names = item_names(df, item_column(df))
    low, high = F.col("salary")["from"], F.col("salary")["to"]
    priced = low.isNotNull() & (F.col("salary.currency") == currency)
    if require_ceiling:
        priced = priced & high.isNotNull()
    return (
        df.withColumn("items", basket_items(names))
        .withColumn("_tagged", F.size("items") >= 2)
        .withColumn("_usable", F.col("_tagged") & F.coalesce(priced, F.lit(False)))
    )


def usable_postings(
    df: DataFrame, *, require_ceiling: bool = True, majors: Sequence[str] = MAJOR_CITIES, dedup: bool = True
) -> DataFrame:
    """(id, items, salary_net, has_ceiling, city_bucket, experience_bucket) of the rows that can be priced.

    ``require_ceiling``: the outcome is the middle of the salary range; otherwise it is the lower bound of every row.
    """
    low, high = F.col("salary")["from"], F.col("salary")["to"]
    gross = (low + high) / 2 if require_ceiling else low
    rows = usable_flags(df, require_ceiling=require_ceiling).withColumns({
        "salary_net": F.when(F.coalesce(F.col("salary.gross"), F.lit(False)), gross * NET_OF_GROSS).otherwise(gross),
        "has_ceiling": high.isNotNull(),
        "city_bucket": major_or_other(F.col("area.name"), majors),
        "experience_bucket": F.col("experience.id"),
    })
    columns = ["id", "items", "salary_net", "has_ceiling", "city_bucket", "experience_bucket"]
    if not dedup:
        return rows.where("_usable").select(*columns)
    # A row that is not usable may still be the lowest of its content, but then only its id and digest matter.
    rows = dedupe(rows.withColumn("_row", F.when(F.col("_usable"), F.struct(*columns[1:]))), keep=["_row"])
    return rows.where(F.col("_row").isNotNull()).select("id", "_row.*")


def funnel(df: DataFrame, *, require_ceiling: bool = True) -> DataFrame:
    """One row: all rows, distinct contents, those with two items and more, those usable - one aggregate."""
    flagged = usable_flags(df, require_ceiling=require_ceiling).withColumn("_content", content_key(DEDUP_KEY))
    # Flags belong to the kept (lowest-id) row of each content.
    kept = flagged.groupBy("_content").agg(
        F.count(F.lit(1)).alias("_copies"), F.min_by(F.struct("_tagged", "_usable"), "id").alias("_kept")
    )
    return kept.agg(
        F.sum("_copies").alias("total"),
        F.count(F.lit(1)).alias("deduplicated"),
        F.count(F.when(F.col("_kept._tagged"), 1)).alias("tagged"),
        F.count(F.when(F.col("_kept._usable"), 1)).alias("usable"),
    )


def item_labels_long(df: DataFrame, vocabulary: DataFrame, *, id_col: str = "id") -> DataFrame:
    """(id, item, y) positives only: absent pairs are zeros. ``vocabulary(item)`` is a top-n table."""
    held = df.select(id_col, F.explode(F.array_distinct("items")).alias("item"))
    return held.join(vocabulary.select("item"), "item", "left_semi").select(id_col, "item", F.lit(1).alias("y"))


def item_labels_wide(df: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """One 0/1 column per vocabulary item, named by position, all in one projection."""
    flags = [F.when(F.array_contains("items", v), 1).otherwise(0).alias(f"label_{i}") for i, v in enumerate(vocabulary)]
    return df.select("*", *flags)


def sample_batches(df: DataFrame, id_col: str, sizes: dict[str, int], *, seed: int = 42) -> DataFrame:
    """Disjoint random batches of fixed sizes, tagged ``batch``; rows outside them are left out.

    Rows are ranked by a seeded hash of the id. Small totals use a top-k; larger ones number the whole table.
    """
    total = sum(sizes.values())
    keyed = df.withColumn("_h", hash_int(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), "md5"))
    if total <= 100_000:
        first = keyed.orderBy("_h", id_col).limit(total)
        placed = first.withColumn("_i", F.row_number().over(Window.orderBy("_h", id_col)) - 1)
    else:
        placed = dense_index(keyed, "_h", id_col, "_i").where(F.col("_i") < total)
    label, upto = F.lit(None).cast("string"), total
    for name, size in reversed(sizes.items()):
        label = F.when(F.col("_i") < upto, F.lit(name)).otherwise(label)
        upto -= size
    return placed.withColumn("batch", label).drop("_h", "_i")


def posted_salary(low: Column, high: Column, gross: Column, currency: str = "RUB") -> Column:
    """Salary as posted, in words, with the tax note when known."""
    def number(c: Column) -> Column:
        return F.translate(F.format_number(F.bround(c, 0), 0), ",", " ")

    text = (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(number(low), F.lit("-"), number(high), F.lit(f" {currency}")))
        .when(low.isNotNull(), F.concat(F.lit("from "), number(low), F.lit(f" {currency}")))
        .otherwise(F.concat(F.lit("up to "), number(high), F.lit(f" {currency}")))
    )
    return F.concat_ws(", ", text, F.when(gross, "before tax").when(~gross, "after tax"))


def dummies(df: DataFrame, id_col: str, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per listed value of a (id, value) table, by pivot."""
    out = df.groupBy(id_col).pivot(column, list(values)).agg(F.lit(1))
    return out.na.fill(0, list(values))
