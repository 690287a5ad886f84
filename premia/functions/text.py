"""Text column expressions: ordered regex classes, HTML stripping, Unicode tokens, safe names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Seniority patterns in match order, ASCII case folding.
SENIORITY = [
    ("junior|trainee|intern|entry|начальный", "Junior"),
    ("senior|lead|principal|head|старший|ведущий", "Senior"),
    ("middle|mid", "Middle"),
]
# Unicode-aware word splitting, HTML tags, characters unsafe in a path.
TOKEN_SPLIT = r"(?U)\W+"
HTML_TAG = "<[^>]+>"
UNSAFE_IN_PATH = r'[<>:"/\\|?*]'
MIN_TOKEN_LENGTH = 2


def classify_by_regex(
    text: Column, rules: Sequence[tuple[str, str]], default: str, *, unicode_case: bool = False
) -> Column:
    """Label of the first pattern found anywhere in the text. ``unicode_case`` folds non-ASCII letters too."""
    flags = "(?iu)" if unicode_case else "(?i)"
    out = F.lit(default)
    for pattern, label in reversed(list(rules)):
        out = F.when(text.rlike(flags + pattern), F.lit(label)).otherwise(out)
    return out


def seniority(title: Column, *, unicode_case: bool = False) -> Column:
    return classify_by_regex(title, SENIORITY, "Unknown", unicode_case=unicode_case)


def strip_html(text: Column) -> Column:
    return F.regexp_replace(text, HTML_TAG, " ")


def tokens(text: Column, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Lower-cased Unicode word tokens of at least ``min_length`` characters, in order, repeats kept."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: F.length(t) >= min_length)


def safe_name(name: Column) -> Column:
    """Item name usable as a path component."""
    return F.regexp_replace(name, UNSAFE_IN_PATH, "_")


def stop_words(languages: Sequence[str] = ("english", "russian")) -> list[str]:
    """Spark ML's own stop-word lists, concatenated."""
    return [w for lang in languages for w in StopWordsRemover.loadDefaultStopWords(lang)]


def strip_whitespace(text: Column) -> Column:
    """Trim every Unicode space, not only U+0020 as ``trim`` does."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
