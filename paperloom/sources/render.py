"""Reports as tables of lines: (report, place, line), ``place`` being an array of keys in order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.names import slug
from paperloom.functions.tokens import excerpt
from paperloom.functions.unicode import blank_to
from paperloom.operators import preflight, reports, terms

_SCHEMA = "report string, place array<string>, line string"


def fixed(spark: SparkSession, report: str, at: int, *lines: str) -> DataFrame:
    """Lines that don't depend on rows."""
    return spark.createDataFrame([(report, [f"{at:04d}", "", "", f"{i:09d}"], x) for i, x in enumerate(lines)], _SCHEMA)


def rows(df: DataFrame, report: Column | str, at: int, line: Column, group: Column | None = None, inner: int = 0, *order: Column) -> DataFrame:
    """A line for each row; rows of one group follow one another, by ``inner`` and then ``order``."""
    keys = [F.lit(f"{at:04d}"), group if group is not None else F.lit(""), F.lit(f"{inner:04d}"), *order]
    name = F.lit(report) if isinstance(report, str) else report
    return df.select(name.alias("report"), F.array(*[k.cast("string") for k in keys]).alias("place"), line.alias("line"))


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def cell(value: Column) -> Column:
    """A value inside a table's row."""
    return F.replace(F.replace(blank_to(value, ""), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def _digits(c: Column) -> Column:
    return F.format_string("%012d", c.cast("bigint"))


def _with_doi(doi: Column) -> Column:
    return F.when(doi != "", F.concat(F.lit(", DOI: "), doi)).otherwise("")


def preflight_report(files: DataFrame) -> DataFrame:
    """Totals, and a table of all files with their warnings."""
    name, spark = "pdf_preflight_report", files.sparkSession
    sums = preflight.totals(files)
    summary = [("PDFs found", "files"), ("Likely scanned PDFs", "scanned"), ("Large PDFs (>25 MB)", "huge"), ("PDFs with warnings", "with_warnings")]
    counts = together(*[rows(sums, name, 1, F.concat(F.lit(f"- {label}: "), F.col(c).cast("string")), None, i) for i, (label, c) in enumerate(summary)])
    year = preflight.displayed_year(F.col("filename"), F.col("extracted_year"))
    cells = [cell(F.col("filename")), F.col("pages"), F.col("text_chars"), F.col("chars_per_page"), cell(year), cell(F.col("extracted_doi")), cell(F.array_join("warnings", "; "))]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]), F.lit(" |"))
    head = ["", "## PDFs", "", "| PDF | Pages | Text chars | Chars/page | Year | DOI | Warnings |", "| --- | ---: | ---: | ---: | --- | --- | --- |"]
    return together(
        fixed(spark, name, 0, "# PDF Preflight Report", "", "This report is generated locally before conversion.", "", "## Summary", ""),
        counts, fixed(spark, name, 2, *head), rows(files, name, 3, line, None, 0, F.col("filename")),
    )


def examiner_overview(chunks: DataFrame) -> DataFrame:
    name = "examiner_overview"
    papers = reports.papers_by_examiner(chunks)
    line = F.concat(F.lit("- "), "year", F.lit(": "), "title", _with_doi(F.col("doi")), F.lit(" ("), F.col("n").cast("string"), F.lit(" chunks)"))
    return together(
        fixed(chunks.sparkSession, name, 0, "# Examiner Overview", ""),
        rows(papers.select("examiner").distinct(), name, 1, F.concat(F.lit("\n## "), "examiner", F.lit("\n")), F.col("examiner"), 0),
        rows(papers, name, 1, line, F.col("examiner"), 1, F.col("title"), F.col("year"), F.col("doi"), _digits(F.col("n"))),
    )


def term_report(counts: DataFrame, examiners: DataFrame, name: str, title: str) -> DataFrame:
    """A heading for each examiner, and the counts (examiner, rank, term, n) below it."""
    without = examiners.join(counts.select("examiner").distinct(), "examiner", "left_anti")
    return together(
        fixed(counts.sparkSession, name, 0, f"# {title}", ""),
        rows(examiners, name, 1, F.concat(F.lit("\n## "), "examiner", F.lit("\n")), F.col("examiner"), 0),
        rows(counts, name, 1, F.concat(F.lit("- "), "term", F.lit(": "), F.col("n").cast("string")), F.col("examiner"), 1, _digits(F.col("rank"))),
        rows(without, name, 1, F.lit("- No configured terms found."), F.col("examiner"), 1),
    )


def defense_reports(chunks: DataFrame, order: list[str]) -> DataFrame:
    """Overview and the theme, method and theory indexes."""
    people = chunks.select(terms.examiner()).distinct()
    return together(
        examiner_overview(chunks),
        term_report(terms.frequent_terms(chunks, order), people, "theme_index", "Theme Index"),
        term_report(terms.phrase_counts(chunks, terms.METHOD_TERMS), people, "method_index", "Method Index"),
        term_report(terms.phrase_counts(chunks, terms.THEORY_TERMS), people, "theory_index", "Theory Index"),
    )


def corpus_overview(chunks: DataFrame) -> DataFrame:
    name, size, papers = "corpus_overview", reports.corpus_size(chunks), reports.corpus_papers(chunks)
    labels = [("Examiners", "examiners"), ("Papers", "papers"), ("Chunks", "chunks"), ("Estimated tokens in exported chunks", "tokens")]
    line = F.concat(F.lit("- "), "year", F.lit(": "), "title", _with_doi(F.col("doi")))
    return together(
        fixed(chunks.sparkSession, name, 0, "# LLM Corpus Overview", "", "## Corpus Size", ""),
        *[rows(size, name, 1, F.concat(F.lit(f"- {label}: "), F.col(c).cast("string")), None, i) for i, (label, c) in enumerate(labels)],
        fixed(chunks.sparkSession, name, 2, "", "## Examiners And Papers", ""),
        rows(papers.select("examiner").distinct(), name, 3, F.concat(F.lit("\n### "), "examiner", F.lit("\n")), F.col("examiner"), 0),
        rows(papers, name, 3, line, F.col("examiner"), 1, F.col("year"), F.col("title"), F.col("doi"), F.col("paper_id")),
    )


def quality_lines(papers: DataFrame) -> DataFrame:
    """(paper_id, title, line): how each paper of the JSON documents was converted."""
    name = F.coalesce(F.nullif("metadata.filename", F.lit("")), "paper_id", F.lit("unknown paper"))
    tool = F.coalesce(F.nullif("conversion.actual_tool", F.lit("")), F.nullif("conversion.primary_tool", F.lit("")), F.lit("unknown"))
    way = F.when(F.coalesce("conversion.fallback_used", F.lit(False)), "fallback used").otherwise("primary conversion")
    notes = F.array_join(F.coalesce("conversion.warnings", F.array().cast("array<string>")), "; ")
    line = F.concat(F.lit("- "), name, F.lit(": "), tool, F.lit(", "), way, F.lit("."), F.when(notes != "", F.concat(F.lit(" Warnings: "), notes)).otherwise(""))
    return papers.select("paper_id", F.coalesce("metadata.title", F.lit("")).alias("title"), line.alias("line"))


def examiner_packs(chunks: DataFrame, papers: DataFrame, order: list[str], most_chunks: int = 24, most_characters: int = 1800) -> DataFrame:
    """A pack for each examiner: quality, papers, terms, sections and selected excerpts."""
    pack = F.concat(F.lit("examiner_pack_"), slug(F.col("examiner")))
    own = chunks.withColumn("examiner", terms.examiner())
    counts = own.groupBy("examiner").agg(F.count("*").alias("chunks"))
    keyed = lambda df, at, line, *order: rows(df, pack, at, line, F.col("examiner"), 0, *order)
    head = lambda at, title: keyed(counts, at, F.lit(f"\n## {title}\n"))
    counted = lambda df, at, what: keyed(df, at, F.concat(F.lit("- "), what, F.lit(": "), F.col("n").cast("string")), _digits(F.col("rank")))
    of_papers = own.select("examiner", "paper_id").distinct().join(quality_lines(papers), "paper_id")
    lines = reports.paper_lines(own)
    line = F.concat(F.lit("- "), "year", F.lit(": "), "title", _with_doi(F.col("doi")), F.lit(" ("), F.col("n").cast("string"), F.lit(" chunks, source: `"), "source_pdf", F.lit("`)"))
    picked = reports.select_chunks(own, most_chunks, order[-1])
    shown = [("Paper", "title"), ("Year", "year"), ("DOI", "doi"), ("Section", "section")]
    labels = [F.concat(F.lit(f"- {label}: "), blank_to(F.col(c), "")) for label, c in shown]
    text = F.concat_ws(
        "\n", F.concat(F.lit("### "), blank_to(F.col("chunk_id"), "unknown chunk")), F.lit(""), *labels, F.concat(F.lit("- Source PDF: `"), blank_to(F.col("source_pdf"), ""), F.lit("`")),
        F.lit(""), F.lit("```text"), excerpt(F.col("text"), most_characters), F.lit("```"), F.lit(""),
    )
    return together(
        keyed(counts, 0, F.concat(F.lit("# LLM Examiner Pack: "), "examiner")),
        head(1, "Quality Note"), keyed(of_papers, 2, F.col("line"), F.col("title"), F.col("paper_id")),
        head(3, "Papers"), keyed(lines, 4, line, F.col("paper_id"), F.col("title"), F.col("year"), F.col("doi"), F.col("source_pdf")),
        head(5, "Theme Signals"), counted(terms.frequent_terms(own, order, 20, without_links=True), 6, F.col("term")),
        head(7, "Method Signals"), counted(terms.phrase_counts(own, terms.METHOD_TERMS, by_count=True, most=20), 8, F.col("term")),
        head(9, "Theory Signals"), counted(terms.phrase_counts(own, terms.THEORY_TERMS, by_count=True, most=20), 10, F.col("term")),
        head(11, "Section Signals"), counted(terms.section_counts(own, order), 12, F.col("section")),
        head(13, "Selected Chunk Excerpts"), keyed(picked, 14, text, _digits(F.col("place"))),
    )


def quality_report(summary: DataFrame, alive: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """The summary row, whether the full-text service was there (the last paper's word), and a section
    for each list of (item)."""
    name, spark = "conversion_quality_report", summary.sparkSession
    labels = (
        ("PDFs found", "pdfs"), ("Successful conversions", "successes"), ("Failed conversions", "failed"), ("Fallbacks used", "fallbacks"),
        ("Chunks generated", "chunks"), ("Average chunk size", "mean_tokens"), ("Tiny chunks (<30 tokens)", "tiny_chunks"),
    )
    parts = [fixed(spark, name, 0, "# Conversion Quality Report", "", "## Summary", "")]
    parts += [rows(summary, name, 1, F.concat(F.lit(f"- {label}: "), F.col(c).cast("string")), None, i) for i, (label, c) in enumerate(labels)]
    parts.append(rows(alive, name, 1, F.concat(F.lit("- GROBID availability: "), "alive"), None, len(labels)))
    for i, (title, items) in enumerate(lists.items()):
        parts += [fixed(spark, name, 2 + 2 * i, "", f"## {title}", ""), rows(items, name, 3 + 2 * i, F.concat(F.lit("- "), "item"), None, 0, F.col("item"))]
    return together(*parts)
