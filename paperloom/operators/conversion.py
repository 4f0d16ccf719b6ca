"""Texts of files from several converters, the best of them for each file."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.checks import layout_incomplete
from paperloom.functions.clean import page_markdown
from paperloom.storage import staged

RESULT = "filename string, markdown string, tool string, fallback_used boolean, warnings array<string>"


@dataclass(frozen=True)
class Converter:
    """A way to get Markdown from files. ``convert`` takes a DataFrame (filename, path) and returns
    (filename, markdown, error): Markdown, or the reason why there is none."""

    name: str
    convert: Callable[[DataFrame], DataFrame]


def pages_to_markdown(pages: DataFrame) -> DataFrame:
    """(filename, markdown) of (filename, page_no, text); null if no page has text."""
    each = pages.select("filename", "page_no", page_markdown(F.col("page_no"), F.col("text")).alias("part"))
    grouped = each.groupBy("filename").agg(F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("page_no", "part")))).alias("parts"))
    return grouped.select("filename", F.when(F.size("parts") > 0, F.array_join(F.transform("parts", lambda x: x["part"]), "\n\n")).alias("markdown"))


def better_of(layout: DataFrame, text: DataFrame) -> DataFrame:
    """(filename, markdown, tool, fallback_used, warnings): the layout converter's Markdown, or the
    text layer's where the layout lacks references or much of the text. Both hold (filename, markdown)."""
    a = layout.select("filename", F.col("markdown").alias("layout"))
    b = text.select("filename", F.col("markdown").alias("plain"))
    both = a.join(b, "filename", "left")
    has = lambda c: F.contains(F.lower(c), F.lit("references"))
    n_layout, n_text = F.length(F.lower("layout")), F.length(F.lower("plain"))
    use_text = F.coalesce(layout_incomplete(n_layout, has("layout"), n_text, has("plain")), F.lit(False))
    lost = has("plain") & ~has("layout")
    longer = n_text > F.greatest(F.lit(2000), F.floor(n_layout * 1.35))
    reasons = F.array_compact(F.array(
        F.when(lost, "references missing from Docling output"),
        F.when(longer, F.concat(F.lit("text layer longer ("), n_text.cast("string"), F.lit(" vs "), n_layout.cast("string"), F.lit(" chars)"))),
    ))
    warning = F.concat(F.lit("Docling output appears incomplete; used pypdfium2 text fallback: "), F.array_join(reasons, ", "))
    return both.select(
        "filename", F.when(use_text, F.col("plain")).otherwise(F.col("layout")).alias("markdown"),
        F.when(use_text, "pypdfium2-text").otherwise("docling").alias("tool"), use_text.alias("fallback_used"),
        F.when(use_text, F.array(warning)).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )


def convert_with_fallbacks(files: DataFrame, converters: list[Converter], primary: str = "pypdfium2-text") -> tuple[DataFrame, DataFrame]:
    """Results (``RESULT``) of the files some converter could read, and (filename, warnings) of the rest.

    The text layer, when it is primary, comes first; then the layout converter, checked against the
    text layer; then the text layer; then the others in their order. A later converter sees only the
    files that all before it failed on. All warnings of a file are kept, also when nothing could read it.
    """
    by_name = {c.name: c for c in converters}
    text, layout = by_name.get("pypdfium2-text"), by_name.get("docling")
    rest = [c for c in converters if c.name not in ("pypdfium2-text", "docling")]
    first = [text] if text and primary == "pypdfium2-text" else []
    # after the layout converter the text layer only comes again if it hasn't been tried
    steps = [*first, *[c for c in (layout,) if c], *([] if first or not text else [text]), *rest]
    left = files.withColumn("warnings", F.array().cast("array<string>"))
    done = files.sparkSession.createDataFrame([], RESULT)
    for step in steps:
        tried = left.join(step.convert(left.drop("warnings")).select("filename", "markdown", "error"), "filename", "left")
        tried = staged(tried, f"convert-{step.name}")
        good = tried.filter(F.trim(F.coalesce("markdown", F.lit(""))) != "")
        result = good.select("filename", "markdown", F.lit(step.name).alias("tool"), F.lit(step not in first and step is not layout).alias("fallback_used"), "warnings")
        if step is layout and text:
            read = text.convert(good.select(*[c for c in files.columns])).filter(F.col("markdown").isNotNull())
            checked = better_of(good.select("filename", "markdown"), read.select("filename", "markdown")).withColumnRenamed("warnings", "more")
            result = checked.join(good.select("filename", "warnings"), "filename").select("filename", "markdown", "tool", "fallback_used", F.array_distinct(F.concat("warnings", "more")).alias("warnings"))
        done = done.unionByName(result)
        why = F.concat(F.lit(f"{step.name} failed or unavailable: "), F.coalesce("error", F.lit("no text")))
        left = tried.filter(F.trim(F.coalesce("markdown", F.lit(""))) == "").select(*files.columns, F.array_append("warnings", why).alias("warnings"))
    return done, left.select("filename", "warnings")
