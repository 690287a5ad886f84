"""Item-array column expressions. Two clean-up modes exist on purpose: labels and baskets differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.functions.text import strip_whitespace

KEY_SEPARATOR = "\u0001"

# Item columns in order of preference.
ITEM_COLUMNS = ["key_skills_translated", "skills_translated", "key_skills"]


def item_column(df: DataFrame, candidates: list[str] = ITEM_COLUMNS) -> str:
    """First candidate present in the frame; the last one is the fallback."""
    return next((c for c in candidates if c in df.columns), candidates[-1])


def item_names(df: DataFrame, column: str, field: str = "name") -> Column:
    """Plain array<string> of names, whether the column holds strings or structs; decided from the schema."""
    element = df.schema[column].dataType.elementType
    if isinstance(element, T.StructType):
        return F.transform(F.col(column), lambda s: s[field])
    return F.col(column)


def label_items(names: Column) -> Column:
    """Lower-cased trimmed names without 'unknown' and ''; repeats and order kept, null array gives []."""
    cleaned = F.transform(names, lambda s: F.lower(F.trim(s)))
    kept = F.filter(cleaned, lambda s: s.isNull() | ~s.isin("unknown", ""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def basket_items(names: Column) -> Column:
    """Sorted distinct stripped names, case kept, empty ones dropped, null array gives []."""
    stripped = F.transform(names, strip_whitespace)
    kept = F.filter(stripped, lambda s: s.isNotNull() & (s != ""))
    return F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<string>"))


def joined(names: Column, separator: str = " + ") -> Column:
    """Sorted names as one string."""
    return F.array_join(F.array_sort(names), separator)


def itemset_key(names: Column) -> Column:
    """Sorted names as one group key: names may hold any printed separator, so the key uses one that no name has."""
    return joined(names, KEY_SEPARATOR)


def printed(key: str) -> Column:
    """An `itemset_key` column as it is shown."""
    return F.replace(F.col(key), F.lit(KEY_SEPARATOR), F.lit(" + "))


def split_joined(text: Column) -> Column:
    """Inverse of `joined` for names that hold no ' + ' themselves."""
    return F.transform(F.split(text, r" \+ "), lambda s: F.trim(s))


def pairs_of(names: Column) -> Column:
    """All two-item combinations of one short array, in array order."""
    def with_later(item: Column, i: Column) -> Column:
        later = F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0)))
        return F.transform(later, lambda other: F.struct(item.alias("a"), other.alias("b")))

    return F.flatten(F.transform(names, with_later))


def multi_hot(array_col: str, ids: list[str], prefix: str, field: str = "id") -> list[Column]:
    """One 0/1 column per id: is it among the array's structs? A null array gives 0."""
    def flag(wanted: str) -> Column:
        return F.when(F.exists(F.col(array_col), lambda x: x[field] == wanted), 1).otherwise(0)

    return [flag(i).alias(prefix + i.lower()) for i in ids]
