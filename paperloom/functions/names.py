"""What file names and metadata say of a paper, and the ids made from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.unicode import ascii_letters, blank_to, strip


def stem(path: Column) -> Column:
    """The last part of a path without its extension; a leading dot starts no extension."""
    last = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(last, r"(?s)(?<=.)\.[^.]+\z", "")


def examiner_from_path(path: Column) -> Column:
    """The first folder, or blank for a file at the top."""
    return F.when(F.instr(path, "/") > 0, F.substring_index(path, "/", 1)).otherwise("")


def title_from_path(path: Column) -> Column:
    return F.translate(stem(path), "_-", "  ")


def year_from_path(path: Column) -> Column:
    """The first year of the 20th or 21st century that stands as a word in the stem, else blank."""
    return F.regexp_extract(stem(path), r"(?U)\b(19\d{2}|20\d{2})\b", 1)


def slug(value: Column, fallback: str = "item") -> Column:
    plain = F.regexp_replace(F.lower(ascii_letters(value)), r"[^a-z0-9]+", "-")
    return blank_to(F.btrim(plain, F.lit("-")), fallback)


def paper_slug(title: Column, filename: Column) -> Column:
    title = strip(F.coalesce(title, F.lit("")))
    return slug(F.when(title == "", stem(blank_to(filename, "paper"))).otherwise(title), "paper")


def examiner_slug(examiner: Column) -> Column:
    return slug(blank_to(examiner, "unknown-examiner"), "unknown-examiner")


def paper_id(examiner: Column, year: Column, title: Column, filename: Column) -> Column:
    """Examiner, year as it is recorded, and title, or file name, of a paper."""
    when = blank_to(strip(blank_to(year, "unknown-year")), "unknown-year")
    return F.concat_ws("_", examiner_slug(examiner), when, paper_slug(title, filename))


def parse_year(year: Column) -> Column:
    """An integer from 1500 to 2200, or null."""
    number = F.try_to_number(F.regexp_extract(strip(year.cast("string")), r"\A\+?0*(\d{1,9})\z", 1), F.lit("999999999")).cast("int")
    return F.when(number.between(1500, 2200), number)
