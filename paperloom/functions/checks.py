"""Conditions on sources, sections and files."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.unicode import collapse, strip

# fixed values: traces of production software in a source name, and words of journal names
TOOL_FRAGMENTS = ("3b2", "acrobat", "distiller", "microsoft word", "original paper", "publishing system", "research paper", "total publishing", "unicode")
JOURNAL_WORDS = (
    "buildings", "computers", "ecology", "energy", "journal", "management", "operations", "policy", "reports",
    "research", "review", "reviews", "science", "sustainability", "systems",
)
#: Characters of a source name above which it must have a word of a journal name.
LONG_SOURCE = 45
#: Characters of text on a page below which a file counts as scanned, and bytes of a huge file.
SCANNED_BELOW, HUGE_FROM = 200, 25 * 1024 * 1024

# fixed values: rank of a section in a selection of excerpts, by the first word found in its name
SECTION_RANKS = (
    ("abstract", 0), ("introduction", 1), ("method", 2), ("results", 3), ("findings", 3), ("discussion", 4),
    ("conclusion", 5), ("body", 6), ("references", 90), ("bibliography", 90),
)
OTHER_SECTION_RANK = 50


def contains_any(text: Column, parts) -> Column:
    return reduce(or_, [F.contains(text, F.lit(p)) for p in parts])


def suspicious_source(source: Column) -> Column:
    """Whether a source names software rather than a journal; never for null and blank ones."""
    name = collapse(F.coalesce(source, F.lit("")))
    low = F.lower(name)
    return (name != "") & (contains_any(low, TOOL_FRAGMENTS) | ((F.length(name) > LONG_SOURCE) & ~contains_any(low, JOURNAL_WORDS)))


def reference_section(section: Column) -> Column:
    name = F.lower(strip(F.coalesce(section, F.lit(""))))
    return name.isin("references", "bibliography") | F.startswith(name, F.lit("references"))


def section_rank(section: Column) -> Column:
    name = F.lower(F.coalesce(section, F.lit("")))
    ranks = F.when(F.lit(False), 0)
    for word, rank in SECTION_RANKS:
        ranks = ranks.when(F.contains(name, F.lit(word)), rank)
    return ranks.otherwise(OTHER_SECTION_RANK)


def likely_scanned(pages: Column, chars_per_page: Column) -> Column:
    return (pages > 0) & (chars_per_page < SCANNED_BELOW)


def layout_incomplete(layout_length: Column, layout_has_references: Column, text_length: Column, text_has_references: Column) -> Column:
    """Whether the text layer should replace the output of a layout converter: that lacks the
    references, or the text layer is longer by more than a third and above 2000 characters."""
    much_longer = text_length > F.greatest(F.lit(2000), F.floor(layout_length * 1.35))
    return (text_has_references & ~layout_has_references) | much_longer


def local_url(url: Column) -> Column:
    host = F.lower(F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?(\[[^\]]*\]|[^:/?#]*)", 1), r"[\[\]]", ""))
    return host.isin("localhost", "127.0.0.1", "::1", "0.0.0.0")
