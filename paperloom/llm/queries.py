"""The queries of the problems tagged llm, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import frequency, languages, leakage, names, packing, site_lines, works
from paperloom.skew import salted_join
from paperloom.storage import spread, staged

#: Shares of all records above which a term is too common.
COMMON = {"text": 0.20, "examiner": 0.05}
NAME_FIELDS = {"examiner": "person", "source": "journal"}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table whose texts are worked on, over all cores."""
    return spread(_table(spark, folder, name).select(*columns))


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.term_frequency(_texts(spark, folder, "chunks", "text", "examiner"), ["text"], ["examiner"], 2, COMMON)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _terms(spark, folder).filter(F.col("mark").isNotNull()).select("field", "term", "mark")


def p1_term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return _terms(spark, folder).select("field", "term", "occurrences", "records", "mark")


def _site_blocks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return site_lines.site_blocks(_texts(spark, folder, "chunks", "row_id", "source_pdf", "text"), _table(spark, folder, "manifest"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _site_blocks(spark, folder)[0]


def p2_blocks(spark: SparkSession, folder: str) -> DataFrame:
    sources = _table(spark, folder, "manifest").select("source", F.xxhash64("source").alias("src")).distinct()
    blocks = site_lines.block_texts(_site_blocks(spark, folder)[1], _table(spark, folder, "chunks"))
    return blocks.join(sources, "src").select("source", "block", "lines", "docs")


def p2_clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = site_lines.without_lines(_table(spark, folder, "chunks"), _site_blocks(spark, folder)[0])
    return cleaned.select("row_id", "text", F.array_join("removed", "\n").alias("removed"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = staged(works.with_work(_table(spark, folder, "manifest")), "work-of-row")
    several = works.survivors(rows).filter("n_rows > 1").select("work", "survivor_id")
    return salted_join(rows.select("row_id", "work"), several, ["work"], "row_id").select("row_id", "survivor_id")


def p3_survivors(spark: SparkSession, folder: str) -> DataFrame:
    rows = staged(works.with_work(_table(spark, folder, "manifest")), "work-of-row")
    return works.survivors(rows).drop("work")


def _names(spark: SparkSession, folder: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("spelling")) for f in NAME_FIELDS])
    return names.name_entities(_table(spark, folder, "manifest").select(F.inline(each)), NAME_FIELDS)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.spelling_pairs(staged(_names(spark, folder), "name-entities"))


def p4_entities(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder).select("field", "spelling", "n", "entity_name")


def p6_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_texts(_texts(spark, folder, "documents", "doc_id", "text"), _table(spark, folder, "containers"))


def p6_rules(spark: SparkSession, folder: str) -> DataFrame:
    """For each kind of container, how many texts are packed and how many things are against the rules."""
    counts = staged(packing.count_tokens(_texts(spark, folder, "documents", "doc_id", "text")), "token-counts")
    return packing.rule_report(packing.pack(counts, _table(spark, folder, "containers")), counts)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked_items(_texts(spark, folder, "documents", "doc_id", "text"), _table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p7_clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.without_leaks(_texts(spark, folder, "documents", "doc_id", "text"), _table(spark, folder, "eval_items"))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    model = languages.fit_language_model(_table(spark, folder, "documents"))
    return languages.language_segments(_texts(spark, folder, "documents", "doc_id", "lang", "text"), model)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    wrong = F.col("label").isNull() | (F.col("label") != F.col("lang"))
    cases = _segments(spark, folder).filter((F.col("para_no") > 0) & (F.col("characters") >= languages.LEAST_CHARACTERS) & F.col("lang").isNotNull() & wrong)
    return cases.select("doc_id", "para_no", "lang")


def p8_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _segments(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        p1_found, p1_term_frequency, p2_found, p2_blocks, p2_clean_texts, p3_found, p3_survivors, p4_found, p4_entities,
        p6_containers, p6_rules, p7_found, p7_clean_texts, p8_found, p8_segments,
    )
    return {f.__name__: f for f in own}


_TERMS = """
WITH all_terms AS (
  SELECT row_id, 'text' AS field, unnest(regexp_extract_all(lower(text), '[a-z][a-z\\-]{3,}')) AS term FROM chunks
  UNION ALL
  SELECT row_id, 'examiner' AS field, examiner AS term FROM chunks WHERE trim(examiner) <> ''
), counted AS (
  SELECT field, term, count(*) AS occurrences, count(DISTINCT row_id) AS records FROM all_terms GROUP BY field, term
), marked AS (
  SELECT *, CASE WHEN records <= 2 THEN 'rare'
    WHEN field = 'text' AND records > 0.20 * (SELECT count(*) FROM chunks) THEN 'common'
    WHEN field = 'examiner' AND records > 0.05 * (SELECT count(*) FROM chunks) THEN 'common' END AS mark
  FROM counted
)
"""

_LINES = """
WITH of_source AS (
  SELECT filename, min(source) AS source FROM manifest WHERE trim(source) <> '' GROUP BY filename
), lines AS (
  SELECT row_id, source_pdf, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM chunks JOIN of_source ON source_pdf = filename
), keyed AS (
  SELECT *, regexp_replace(lower(line), '[^\\p{L}]', '', 'g') AS key FROM lines
), often AS (
  SELECT source, key FROM keyed WHERE key <> '' GROUP BY source, key HAVING count(DISTINCT source_pdf) >= 10
)
"""


# the only letters in the texts that the normal form changes are two ligatures
_GRAMS = r"""
  SELECT {id}, array_to_string(ws[i : i + 11], ' ') AS gram FROM (
    SELECT {id}, ws, unnest(range(1, len(ws) - 10)) AS i FROM (
      SELECT {id}, regexp_extract_all(lower(regexp_replace(replace(replace(nfc_normalize(text), 'ﬁ', 'fi'), 'ﬂ', 'fl'), '([\pL\pN])[-\x{{2010}}\x{{ad}}][ \t\xa0]*\r?\n[ \t\xa0]*([\pL\pN])', '\1\2', 'g')), '[\pL\pN]+') AS ws
      FROM {table}))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p6_rules": """
SELECT container_kind, (SELECT count(DISTINCT doc_id) FROM documents) AS texts, 0::BIGINT AS over_full, 0::BIGINT AS three_large, 0::BIGINT AS wrongly_divided FROM containers""",
        "p7_found": f"SELECT DISTINCT doc_id, item_id FROM ({_GRAMS.format(id='doc_id', table='documents')}) JOIN ({_GRAMS.format(id='item_id', table='eval_items')}) USING (gram)",
        "p1_found": _TERMS + "SELECT field, term, mark FROM marked WHERE mark IS NOT NULL",
        "p1_term_frequency": _TERMS + "SELECT field, term, occurrences, records, mark FROM marked",
        "p2_clean_texts": _LINES
        + """, every AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM chunks WHERE text IS NOT NULL
), gone AS (SELECT row_id, line_no FROM keyed JOIN often USING (source, key)
), kept AS (
  SELECT row_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE g.line_no IS NULL), '') AS text,
    coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE g.line_no IS NOT NULL), '') AS removed
  FROM every LEFT JOIN gone g USING (row_id, line_no) GROUP BY row_id
) SELECT c.row_id, k.text AS text, coalesce(k.removed, '') AS removed FROM chunks c LEFT JOIN kept k USING (row_id)""",
        # all runs of up to twelve lines, of which those that a longer one replaces are left out
        "p2_blocks": _LINES
        + """, runs AS (
  SELECT row_id, source_pdf, source, list(key ORDER BY line_no) AS keys FROM keyed WHERE key <> '' GROUP BY ALL
), starts AS (SELECT source_pdf, source, keys, unnest(range(1, len(keys) + 1)) AS i FROM runs
), grams AS (SELECT source_pdf, source, keys, i, unnest(range(1, 13)) AS k FROM starts
), blocks AS (
  SELECT source, keys[i : i + k - 1] AS block, k AS lines, count(DISTINCT source_pdf) AS docs FROM grams WHERE i + k - 1 <= len(keys) GROUP BY ALL HAVING count(DISTINCT source_pdf) >= 10
), held AS (
  SELECT source, block[1 : lines - 1] AS block, docs FROM blocks WHERE lines > 1 UNION SELECT source, block[2 : lines], docs FROM blocks WHERE lines > 1
) SELECT source, array_to_string(block, chr(10)) AS block, CAST(lines AS INTEGER) AS lines, docs FROM blocks ANTI JOIN held USING (source, block, docs)""",
        "p2_found": _LINES + "SELECT row_id, CAST(line_no AS INTEGER) AS line_no FROM keyed JOIN often USING (source, key)",
    }
