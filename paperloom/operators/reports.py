"""The tables behind the corpus' reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.checks import reference_section, section_rank
from paperloom.functions.tokens import estimate_tokens, excerpt, rounded
from paperloom.functions.unicode import blank_to
from paperloom.operators.terms import examiner

#: Estimated tokens below which a chunk is tiny, and characters below which a paper is short.
TINY_BELOW, SHORT_BELOW = 30, 1200


def _text(column: str, other: str = "") -> Column:
    return blank_to(F.col(column), other).alias(column)


def exported(chunks: DataFrame, with_references: bool = True) -> DataFrame:
    """The chunks for export, without those of reference sections unless these are wanted."""
    return chunks if with_references else chunks.filter(~reference_section(F.col("section")))


def rag_rows(chunks: DataFrame, full_text: bool = True, most_characters: int = 1800) -> DataFrame:
    """The chunks as they are, or with an excerpt in place of the text."""
    return chunks if full_text else chunks.withColumn("text_excerpt", excerpt(F.col("text"), most_characters)).drop("text")


def corpus_size(chunks: DataFrame) -> DataFrame:
    """One row (examiners, papers, chunks, tokens); a paper is a different id, examiner, title, year and DOI."""
    paper = F.struct(_text("paper_id"), examiner(), _text("title", "Untitled"), _text("year"), _text("doi"))
    return chunks.agg(
        F.count_distinct(examiner()).alias("examiners"), F.count_distinct(paper).alias("papers"), F.count("*").alias("chunks"),
        F.coalesce(F.sum(estimate_tokens(F.col("text")).cast("bigint")), F.lit(0)).alias("tokens"),
    )


def corpus_papers(chunks: DataFrame) -> DataFrame:
    """(examiner, year, title, doi) of the different papers."""
    keys = chunks.select(_text("paper_id"), examiner(), _text("title", "Untitled"), _text("year"), _text("doi")).distinct()
    return keys.select("examiner", "year", "title", "doi", "paper_id")


def papers_by_examiner(chunks: DataFrame) -> DataFrame:
    """(examiner, title, year, doi, n): the papers of each examiner with their chunks."""
    return chunks.groupBy(examiner(), _text("title", "Untitled"), _text("year"), _text("doi")).agg(F.count("*").alias("n"))


def paper_lines(chunks: DataFrame) -> DataFrame:
    """(examiner, paper_id, title, year, doi, source_pdf, n) of each paper in an examiner's pack."""
    keys = [examiner(), _text("paper_id"), _text("title", "Untitled"), _text("year"), _text("doi"), _text("source_pdf")]
    return chunks.groupBy(*keys).agg(F.count("*").alias("n"))


def select_chunks(chunks: DataFrame, most: int = 24, tie: str = "row_id") -> DataFrame:
    """The chunks with ``place``, the order of their selection for an examiner's pack, up to ``most``.

    Papers take turns, by the title of their first chunk and their key; within a paper, chunks follow
    by rank of section and index. A null or zero index is 0; equal chunks follow by ``tie``.
    """
    key = F.coalesce(F.nullif(F.col("paper_id"), F.lit("")), F.nullif(F.col("title"), F.lit("")), F.lit("unknown"))
    own = chunks.withColumn("_examiner", examiner()).withColumn("_paper", key).withColumn("_index", F.coalesce("chunk_index", F.lit(0)))
    within = Window.partitionBy("_examiner", "_paper").orderBy(section_rank(F.col("section")), "_index", F.coalesce("title", F.lit("")), tie)
    own = own.withColumn("_turn", F.row_number().over(within)).withColumn("_title", F.coalesce(F.first("title").over(within), F.lit("")))
    turns = Window.partitionBy("_examiner").orderBy("_turn", "_title", "_paper")
    picked = own.filter(F.col("_turn") <= most).withColumn("place", F.row_number().over(turns)).filter(F.col("place") <= most)
    return picked.withColumn("examiner", F.col("_examiner")).drop("_examiner", "_paper", "_index", "_turn", "_title")


def quality_summary(papers: DataFrame, chunks: DataFrame, pdfs: DataFrame) -> DataFrame:
    """One row: PDFs, successes, failures, fallbacks, chunks, their mean tokens and how many are tiny.

    ``papers`` holds (paper_id, fallback_used), ``pdfs`` a row for each file. The mean is over all
    chunks, rounded to a tenth, and 0 without chunks.
    """
    tokens = estimate_tokens(F.col("text")).cast("bigint")
    of_chunks = chunks.agg(F.count("*").alias("chunks"), F.coalesce(F.sum(tokens), F.lit(0)).alias("_tokens"), F.count_if(tokens < TINY_BELOW).alias("tiny_chunks"))
    of_papers = papers.agg(F.count("*").alias("successes"), F.count_if(F.coalesce("fallback_used", F.lit(False))).alias("fallbacks"))
    of_files = pdfs.agg(F.count("*").alias("pdfs"))
    one = [x.withColumn("_one", F.lit(1)) for x in (of_files, of_papers, of_chunks)]
    both = one[0].join(one[1], "_one").join(one[2], "_one")
    return both.select(
        "pdfs", "successes", F.greatest(F.lit(0).cast("bigint"), F.col("pdfs") - F.col("successes")).alias("failed"), "fallbacks", "chunks",
        rounded(F.col("_tokens"), F.col("chunks"), 1).alias("mean_tokens"), "tiny_chunks",
    )


def tiny_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.filter(estimate_tokens(F.col("text")) < TINY_BELOW)


def paper_sizes(sections: DataFrame, id_column: str) -> DataFrame:
    """(id, characters, sections, short): the size of each text over its sections."""
    own = sections.groupBy(id_column).agg(F.sum(F.length("text")).cast("bigint").alias("characters"), F.count("*").alias("sections"))
    return own.withColumn("short", F.col("characters") < SHORT_BELOW)


def chunks_of_papers(papers: DataFrame, chunks: DataFrame) -> DataFrame:
    """The papers with ``n``, the number of their chunks, 0 for those without."""
    counts = chunks.groupBy("paper_id").agg(F.count("*").alias("n"))
    return papers.join(counts, "paper_id", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def current(rows: DataFrame, ids: DataFrame, on: str = "paper_id") -> DataFrame:
    """The rows whose id is among ``ids``; all rows if there are none."""
    return rows.join(ids.select(on).distinct(), on, "left_semi") if not ids.isEmpty() else rows
