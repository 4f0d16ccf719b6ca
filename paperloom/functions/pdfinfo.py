"""Title, year, DOI and source of a paper from its information fields and first pages."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.checks import JOURNAL_WORDS, contains_any
from paperloom.functions.unicode import collapse, let, lines, strip

#: Lines that are searched for a source and for a title, lines and characters of a title, and
#: characters of text that are searched for a year.
SOURCE_LINES, TITLE_LINES, MOST_TITLE_LINES, LONG_TITLE, YEAR_CHARACTERS = 100, 35, 3, 160, 2500

# fixed values: parts of lines that are not a title, end one, or are not a source
NOT_TITLE = ("contents lists available", "journal homepage", "original paper", "research paper", "article info")
STOP_LINES = ("article info", "article history:", "abstract", "keywords:")
STOP_PARTS = (
    "accepted ", "available online", "chair of ", "chair for ", "doi ", "e-mail", "institute ", "published online", "received", "university",
)
BAD_TITLE = ("microsoft word", "untitled", ".pdf", "acrobat", "original paper")
BAD_SOURCE = (
    "3b2", "doi:", "http://", "https://", "acrobat", "distiller", "microsoft word", "publishing system", "research paper", "total publishing", "unicode",
)
TEXT_SOURCE_WORDS = ("buildings", "ecology", "journal", "management", "operations", "policy", "reports", "reviews", "science", "sustainability")


def _first(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(1)), F.lit(""))


def _or_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def find_doi(text: Column) -> Column:
    plain = F.regexp_replace(_or_blank(text), r"[\u00ad\u200b]", "")
    plain = F.regexp_replace(plain, r"(?iU)doi[\s\x1c-\x1f]*:[\s\x1c-\x1f]*", "doi:")
    found = F.regexp_extract(plain, r"(?U)\b10\.\d{4,9}/[-._;()/:A-Za-z0-9\u0130\u0131\u017f\u212a]+", 0)
    return F.rtrim(found, F.lit(".,;:)]}"))


def first_year(text: Column) -> Column:
    return F.regexp_extract(_or_blank(text), r"(?U)\b(19\d{2}|20\d{2}|2100)\b", 1)


def find_year(info: Column, text: Column) -> Column:
    """The first year in the subject, the dates and the title, else near the text's start."""
    places = [first_year(F.try_element_at(info, F.lit(k))) for k in ("Subject", "CreationDate", "ModDate", "Title")]
    places.append(first_year(F.left(_or_blank(text), F.lit(YEAR_CHARACTERS))))
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in places], F.lit(""))


def clean_title(title: Column) -> Column:
    title = F.regexp_replace(_or_blank(title), r"(?U)(?<=\w)_[\s\x1c-\x1f]+(?=[A-Z])", ": ")
    title = collapse(F.regexp_replace(title, r"(?U)(?<=\w)_+(?=\w)", " "))
    return let(title, lambda t: F.when((F.length(t) < 8) | contains_any(F.lower(t), BAD_TITLE), "").otherwise(t))


def _not_title(line: Column) -> Column:
    return contains_any(F.lower(line), NOT_TITLE)


def ends_title(line: Column) -> Column:
    low = F.lower(strip(line))
    signs = [
        low.isin(*STOP_LINES),
        contains_any(low, STOP_PARTS),
        strip(line).rlike(r"(?U)\A\d{1,2}[\s\x1c-\x1f]+[A-Z][a-z]+[\s\x1c-\x1f]+\d{4}\z"),
        line.rlike(r"(?U)\A[A-Z]\.[\s\x1c-\x1f]+[A-Z][A-Za-z-]+"),
        F.contains(line, F.lit(" & ")) & ~contains_any(low, JOURNAL_WORDS),
        line.rlike(r"(?U)[\s\x1c-\x1f][n\u2217*][\s\x1c-\x1f]*\z"),
    ]
    return reduce(or_, signs)


def title_of_text(text: Column) -> Column:
    """The first lines that look like a title, from the first pages' text."""
    full = F.filter(F.transform(lines(_or_blank(text)), collapse), lambda x: x != "")
    tried = F.filter(F.slice(full, 1, TITLE_LINES), lambda x: ~_not_title(x))
    start = F.struct(F.lit(False).alias("done"), F.array().cast("array<string>").alias("taken"))

    def step(state, line):
        ended = state["done"] | ((F.size(state["taken"]) > 0) & ends_title(line))
        taken = F.when(ended, state["taken"]).otherwise(F.array_append(state["taken"], line))
        enough = (F.size(taken) >= MOST_TITLE_LINES) | (F.length(F.array_join(taken, " ")) > LONG_TITLE)
        return F.struct((ended | enough).alias("done"), taken.alias("taken"))

    def finish(state):
        kept = state["taken"]
        last = F.array_max(F.transform(kept, lambda x, i: F.when(~ends_title(x), i + 1).otherwise(0)))
        return F.array_join(F.slice(kept, 1, F.coalesce(last, F.lit(0))), " ")

    return let(F.aggregate(tried, start, step, finish), clean_title)


def useful_source(source: Column, title: Column, surnames: tuple[str, ...] = ()) -> Column:
    """Whether a line can be the name of a journal. ``surnames`` are names of people which show
    that a line without a journal's word is a list of authors."""
    low, heading = F.lower(source), F.lower(strip(title))
    journal = contains_any(low, JOURNAL_WORDS)
    first = F.left(source, F.lit(1))
    bad = [
        ~F.length(source).between(4, 120),
        F.startswith(F.regexp_replace(source, r"(?U)\A[\s\x1c-\x1f]+", ""), F.lit(",")),
        first.rlike(r"(?U)\p{Ll}"),
        _not_title(source),
        ends_title(source),
        low.isin("abstract", "keywords", "keywords:", "article history:"),
        F.startswith(low, F.lit("keywords")),
        F.startswith(source, F.lit("#")),
        contains_any(low, ("all rights reserved", "copyright")),
        ~journal & source.rlike(r"(?U)\A[A-Z][A-Za-z-]+(?:[\s\x1c-\x1f]+[A-Z][A-Za-z-]+){1,3}\z"),
        ~journal & F.contains(source, F.lit(" & ")),
        contains_any(low, BAD_SOURCE),
        (heading != "") & (F.contains(heading, low) | F.contains(low, heading)),
    ]
    if surnames:
        bad.append(~journal & contains_any(low, surnames))
    return ~F.coalesce(reduce(or_, bad), F.lit(True))


def find_source(info: Column, text: Column, title: Column, surnames: tuple[str, ...] = (), patterns: tuple[str, ...] = ()) -> Column:
    """The subject up to a comma, else the creator, else the first line that names a journal; of a line
    that one of ``patterns`` is found in, that part alone."""
    subject = strip(F.split(_or_blank(F.try_element_at(info, F.lit("Subject"))), ",").getItem(0))
    creator = strip(_or_blank(F.try_element_at(info, F.lit("Creator"))))
    useful = lambda x: let(x, lambda s: F.when(useful_source(s, title, surnames), s))

    def candidate(line):
        line = collapse(line)
        return F.coalesce(*[F.nullif(F.regexp_extract(line, p, 0), F.lit("")) for p in patterns], line)

    near = F.transform(F.slice(lines(_or_blank(text)), 1, SOURCE_LINES), candidate)
    fit = F.filter(near, lambda x: useful_source(x, title, surnames) & contains_any(F.lower(x), TEXT_SOURCE_WORDS) & ~F.startswith(F.lower(x), F.lit("contents lists")))
    return F.coalesce(useful(subject), useful(creator), _first(fit))


def paper_metadata(info: Column, text: Column, surnames: tuple[str, ...] = (), patterns: tuple[str, ...] = ()) -> Column:
    """struct(title, year, doi, source) from a map of information fields and the first pages' text."""
    searched = F.concat_ws("\n", F.array_join(F.map_values(info), "\n", ""), _or_blank(text))
    title = let(clean_title(F.try_element_at(info, F.lit("Title"))), lambda t: F.when(t != "", t).otherwise(title_of_text(text)))
    return let(title, lambda t: F.struct(
        t.alias("title"), find_year(info, text).alias("year"), find_doi(searched).alias("doi"), find_source(info, text, t, surnames, patterns).alias("source")
    ))
