"""Repairs of text that was extracted from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.unicode import let, lines, nfkc, rstrip, strip

#: Pages on which a first or last line must stand to be taken for a header or footer.
REPEATED_ON = 3


def join_divided_words(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)(\w)-\n(\w)", "$1$2")


def join_divided_urls(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\b(https?://)[\s\x1c-\x1f]*\n[\s\x1c-\x1f]*", "$1")


def drop_headers_footers(text: Column) -> Column:
    """Without the lines that are first or last on three or more pages; pages end with a form feed.

    A line counts once as first and once as last. Short lines and numbers stay. Blank lines go only
    if any line is dropped; then pages are joined by a blank line. Texts of fewer pages stay.
    """
    full = lambda p: F.filter(F.transform(lines(p), strip), lambda x: x != "")

    def cleaned(pages):
        filled = F.filter(pages, lambda p: F.size(p) > 0)
        ends = F.concat(F.transform(filled, lambda p: F.element_at(p, 1)), F.transform(filled, lambda p: F.element_at(p, -1)))
        often = lambda found: F.filter(
            F.array_distinct(found),
            lambda x: (F.length(x) > 5) & ~x.rlike(r"(?U)\A\d+\z") & (F.size(F.filter(found, lambda y: y == x)) >= REPEATED_ON),
        )
        kept = lambda gone: F.array_join(F.transform(pages, lambda p: F.array_join(F.filter(p, lambda x: ~F.array_contains(gone, x)), "\n")), "\n\n")
        return let(let(ends, often), lambda gone: F.when(F.size(gone) > 0, kept(gone)))

    several = F.length(text) - F.length(F.replace(text, F.lit("\f"), F.lit(""))) >= 2
    found = F.when(several, let(F.transform(F.split(text, "\f", -1), full), cleaned))
    return F.coalesce(found, text)


def drop_page_numbers(text: Column) -> Column:
    return F.regexp_replace(text, r"(?mdU)^[\s\x1c-\x1f]*\d{1,4}[\s\x1c-\x1f]*$", "")


def tidy_space(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return let(text, lambda t: strip(F.array_join(F.transform(lines(t), rstrip), "\n")))


def clean_texts(df: DataFrame, column: str = "text", urls: bool = False) -> DataFrame:
    """All repairs of a column in their order, and addresses wrapped with ``urls``; null becomes the
    empty string. Each repair is a step of its own, so none is computed more than once."""
    steps = (nfkc, join_divided_words, join_divided_urls, drop_headers_footers, drop_page_numbers, tidy_space)
    for repair in (*steps, wrap_urls) if urls else steps:
        df = df.withColumn(column, repair(F.col(column)))
    return df


def wrap_urls(text: Column) -> Column:
    """Bare addresses in angle brackets, marks at their end outside."""
    return F.regexp_replace(text, r"(?U)(?<![<(])\b(?=https?://[^\s\x1c-\x1f<>)])(https?://[^\s\x1c-\x1f<>)]*?)([.,;:\]]*)(?=[\s\x1c-\x1f<>)]|\z)", "<$1>$2")


def escape_headings(text: Column) -> Column:
    """A backslash before number signs that would make a line a heading."""
    return F.array_join(F.transform(lines(text), lambda x: F.regexp_replace(x, r"(?U)\A([\s\x1c-\x1f]{0,3})(#{1,6})(?=[\s\x1c-\x1f])", r"$1\\$2")), "\n")


def page_markdown(page_no: Column, text: Column) -> Column:
    """The Markdown of one page, or null if it has no text."""
    plain = wrap_urls(let(strip(F.coalesce(text, F.lit(""))), escape_headings))
    head = F.concat(F.lit("<!-- page "), page_no.cast("string"), F.lit(" -->\n\n"))
    return let(plain, lambda x: F.when(x != "", F.concat(head, x)))
