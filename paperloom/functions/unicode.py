"""White space, lines and normal forms as the corpus' text rules count them."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The characters that count as white space in the text rules, and those of them that end a line.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
LINE_ENDS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85  "


def spaced(text: Column) -> Column:
    """Every white space character as a blank. Single characters are mapped, as a regular expression
    with a class of so many ranges takes several times as long."""
    return F.translate(text, SPACES, " " * len(SPACES))


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(text, F.lit(SPACES))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(SPACES))


def collapse(text: Column) -> Column:
    """Each run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(spaced(text), " {2,}", " "))


def blank_to(value: Column, other: str) -> Column:
    """``other`` in place of null and of the empty string, which are the same to the corpus."""
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit(other))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def lines(text: Column) -> Column:
    """The lines of a text; a line end at the very end starts no further line, an empty text has none."""
    ended = F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), LINE_ENDS, "\n" * len(LINE_ENDS))
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(ended, r"\n\z", ""), "\n", -1))


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode NFKC; null becomes the empty string."""
    return text.fillna("").map(lambda x: x if x.isascii() else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def ascii_letters(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without everything outside ASCII."""
    return text.fillna("").map(lambda x: x if x.isascii() else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())
