"""Sizes, excerpts and terms of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.unicode import collapse, let, rstrip, spaced

TERM = r"[a-z][a-z\-]{3,}"

# fixed values: words that say nothing of a theme
STOPWORDS = (
    "about", "after", "also", "among", "because", "between", "could", "from", "have", "into", "more", "other", "paper",
    "papers", "research", "such", "than", "that", "their", "there", "these", "this", "with", "were", "which", "will",
)


def count_words(text: Column) -> Column:
    return F.regexp_count(spaced(text), F.lit("[^ ]+"))


def tokens_of_words(words: Column) -> Column:
    """Five tokens for four words, rounded down, but at least one."""
    return F.greatest(F.lit(1), F.floor(words * 5 / 4)).cast("int")


def estimate_tokens(text: Column) -> Column:
    """Estimated tokens of a text, 0 for null and empty ones."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(tokens_of_words(count_words(text)))


def excerpt(text: Column, most: int) -> Column:
    """The text in one line, cut to ``most`` characters with a mark of the cut."""
    cut = lambda line: F.concat(rstrip(F.left(line, F.lit(most - 15))), F.lit(" [truncated]"))
    return let(collapse(F.coalesce(text, F.lit(""))), lambda line: F.when(F.length(line) <= most, line).otherwise(cut(line)))


def terms(text: Column) -> Column:
    """The terms of the lower-cased text in their order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), 1)


def count_phrase(text: Column, phrase: str) -> Column:
    """Places of a phrase in a text, in lower case both, that do not overlap."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(phrase), F.lit("")))) / len(phrase)).cast("long")


def last_words(text: Column, most: int) -> Column:
    """The last ``most`` words, joined by single blanks."""
    if most <= 0:
        return F.lit("")
    words = F.split(F.trim(spaced(text)), " +")
    return let(words, lambda w: F.array_join(F.slice(w, F.greatest(F.lit(1), F.size(w) - most + 1), most), " "))


def rounded(numerator: Column, denominator: Column, digits: int) -> Column:
    """A quotient of whole numbers rounded to so many decimals, halves to the even one, exactly; 0 for
    a denominator of 0."""
    power = 10**digits
    parts, scaled = denominator * 2, numerator * (2 * power) + denominator
    up = F.call_function("div", scaled, parts)
    even = (scaled % parts == 0) & (up % 2 == 1)
    return F.when(denominator > 0, (up - F.when(even, 1).otherwise(0)) / float(power)).otherwise(0.0)
