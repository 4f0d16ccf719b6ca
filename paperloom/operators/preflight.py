"""What can be seen of files before they are converted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.checks import HUGE_FROM, likely_scanned, suspicious_source
from paperloom.functions.names import year_from_path
from paperloom.functions.tokens import rounded
from paperloom.functions.unicode import strip


def measure(pages: DataFrame, files: DataFrame) -> DataFrame:
    """(filename, pages, file_mb, text_chars, chars_per_page, likely_scanned, huge_pdf) of each file.

    ``pages`` holds (filename, page_no, text), ``files`` (filename, length in bytes). A file without
    readable page has 0 pages and is not called scanned.
    """
    of_pages = pages.groupBy("filename").agg(F.count("*").cast("int").alias("pages"), F.sum(F.length(strip(F.coalesce("text", F.lit(""))))).alias("text_chars"))
    rows = files.join(of_pages, "filename", "left")
    n, chars = F.coalesce("pages", F.lit(0)), F.coalesce("text_chars", F.lit(0).cast("bigint"))
    per_page = rounded(chars, n.cast("bigint"), 1)
    rows = rows.select(
        "filename", n.alias("pages"), rounded(F.col("length").cast("bigint"), F.lit(1024 * 1024).cast("bigint"), 2).alias("file_mb"), chars.alias("text_chars"),
        per_page.alias("chars_per_page"), (F.col("length") >= HUGE_FROM).alias("huge_pdf"),
    )
    return rows.withColumn("likely_scanned", likely_scanned(F.col("pages"), F.col("chars_per_page")))


def warnings(row: dict[str, Column], before: Column | None = None) -> Column:
    """The different warnings about a file, those of its extraction, ``before``, first.

    ``row`` gives the columns filename, extracted_year, extracted_title, extracted_source,
    likely_scanned, huge_pdf and file_mb.
    """
    file_year, year = year_from_path(row["filename"]), F.coalesce(row["extracted_year"], F.lit(""))
    differs = (file_year != "") & (year != "") & (file_year != year)
    own = F.array_compact(F.array(
        F.when(differs, F.concat(F.lit("filename year "), file_year, F.lit(" differs from extracted PDF year "), year)),
        F.when(row["likely_scanned"], "very little text layer detected; PDF may be scanned"),
        F.when(row["huge_pdf"], F.concat(F.lit("large PDF file ("), row["file_mb"].cast("string"), F.lit(" MB)"))),
        F.when(F.coalesce(row["extracted_title"], F.lit("")) == "", "title not found in PDF metadata"),
        F.when(suspicious_source(row["extracted_source"]), F.concat(F.lit("source looks suspicious: "), row["extracted_source"])),
    ))
    return F.array_distinct(own if before is None else F.concat(F.coalesce(before, F.array().cast("array<string>")), own))


def totals(rows: DataFrame) -> DataFrame:
    """One row: files, and how many look scanned, are huge, have warnings."""
    return rows.agg(
        F.count("*").alias("files"), F.count_if(F.coalesce("likely_scanned", F.lit(False))).alias("scanned"),
        F.count_if(F.coalesce("huge_pdf", F.lit(False))).alias("huge"), F.count_if(F.size(F.coalesce("warnings", F.array())) > 0).alias("with_warnings"),
    )


def displayed_year(filename: Column, extracted_year: Column) -> Column:
    return F.coalesce(F.nullif(year_from_path(filename), F.lit("")), extracted_year)
