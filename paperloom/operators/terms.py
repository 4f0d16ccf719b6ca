"""Terms of the texts of each examiner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.tokens import STOPWORDS, count_phrase, terms
from paperloom.functions.unicode import blank_to
from paperloom.storage import staged

# fixed values: phrases that name methods and theories, in the order in which they are reported
METHOD_TERMS = (
    "case study", "survey", "simulation", "experiment", "field study", "archival", "design science", "interview", "workshop", "literature review",
)
THEORY_TERMS = (
    "contingency theory", "institutional theory", "agency theory", "stakeholder theory", "legitimacy theory", "resource-based view", "transaction cost theory",
)


def examiner(column: str = "examiner") -> Column:
    return blank_to(F.col(column), "Unknown examiner").alias("examiner")


def top(counts: DataFrame, group: str, most: int, *first: str) -> DataFrame:
    """The ``most`` rows of each group with the largest ``n``; of equal ones that with the least ``first``."""
    order = Window.partitionBy(group).orderBy(F.desc("n"), *first)
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def frequent_terms(chunks: DataFrame, order: list[str], most: int = 25, without_links: bool = False) -> DataFrame:
    """(examiner, rank, term, n): the most frequent terms of each examiner's texts, stop words left out.

    Equally frequent terms are ranked by their first place in the texts, which follow one another by
    ``order``. Null and blank examiners are one. Counting starts before the exchange, and no text is
    joined with another, so an examiner with many texts is no larger task. Places are looked up in a
    second pass, and only of the terms that may be chosen and are as frequent as another.
    """
    found = terms(F.coalesce("text", F.lit("")))
    wanted = ~F.col("term").isin(*STOPWORDS)
    if without_links:
        wanted = wanted & ~F.startswith("term", F.lit("http"))
    counts = chunks.select(examiner(), F.explode(found).alias("term")).filter(wanted).groupBy("examiner", "term").agg(F.count("*").alias("n"))
    by_count = Window.partitionBy("examiner").orderBy(F.desc("n"))
    likely = staged(counts.withColumn("rank", F.rank().over(by_count)).filter(F.col("rank") <= most), "likely-terms")
    equal = likely.withColumn("equal", F.count("*").over(Window.partitionBy("examiner", "n"))).filter("equal > 1").select("examiner", "term")
    each = chunks.select(examiner(), F.struct(*order).alias("place"), F.posexplode(found).alias("at", "term"))
    first = each.join(equal, ["examiner", "term"]).groupBy("examiner", "term").agg(F.min(F.struct("place", "at")).alias("first"))
    return top(likely.drop("rank").join(first, ["examiner", "term"], "left"), "examiner", most, "first").select("examiner", "rank", "term", "n")


def phrase_counts(chunks: DataFrame, phrases: tuple[str, ...], by_count: bool = False, most: int | None = None) -> DataFrame:
    """(examiner, rank, term, n): the given phrases that occur in an examiner's texts, in the order
    given or, with ``by_count``, by falling count and then that order."""
    low = chunks.select(examiner(), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    sums = low.groupBy("examiner").agg(*[F.sum(count_phrase(F.col("text"), p)).alias(f"n{i}") for i, p in enumerate(phrases)])
    found = F.array(*[F.struct(F.lit(i + 1).alias("place"), F.lit(p).alias("term"), F.col(f"n{i}").alias("n")) for i, p in enumerate(phrases)])
    counts = sums.select("examiner", F.inline(found)).filter("n > 0")
    order = Window.partitionBy("examiner").orderBy(*([F.desc("n")] if by_count else []), "place")
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return (ranked.filter(F.col("rank") <= most) if most else ranked).select("examiner", "rank", "term", "n")


def section_counts(chunks: DataFrame, order: list[str], most: int = 20) -> DataFrame:
    """(examiner, rank, section, n): the sections with the most chunks of each examiner; ties by first place."""
    counts = chunks.select(examiner(), blank_to(F.col("section"), "Unknown").alias("section"), F.struct(*order).alias("place")).groupBy("examiner", "section")
    return top(counts.agg(F.count("*").alias("n"), F.min("place").alias("first")), "examiner", most, "first").select("examiner", "rank", "section", "n")
