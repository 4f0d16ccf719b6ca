"""The queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import rowparse
from paperloom.plans import sqltext as q


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return rowparse.failures(rowparse.parse_rows(spark.read.parquet(f"{folder}/manifest_raw.parquet")))


def p5_valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rowparse.valid_rows(rowparse.parse_rows(spark.read.parquet(f"{folder}/manifest_raw.parquet")))


def p5_broken_fields(spark: SparkSession, folder: str) -> DataFrame:
    parsed = rowparse.parse_rows(spark.read.parquet(f"{folder}/manifest_raw.parquet"))
    return parsed.filter(F.size("reasons") > 0).select("line_id", F.array_join("reasons", ",").alias("reasons"), "broken_field")


QUERIES = {f.__name__: f for f in (p5_found, p5_valid_rows, p5_broken_fields)}

_FIELD = '("[^"]*(?:""[^"]*)*"|[^",][^",]*|)'
_PARSED = f"""
WITH records AS (
  SELECT line_id, regexp_replace(regexp_replace(raw_line, '^\\x{{FEFF}}', ''), '\\r\\z', '') AS record FROM manifest_raw
), shaped AS (
  SELECT line_id, record, regexp_full_match(record, '{_FIELD.replace("(", "(?:", 1)}(?:,{_FIELD.replace("(", "(?:", 1)})*', 's') AS well_formed,
    length(regexp_replace(record, '"[^"]*"', '', 'g')) - length(replace(regexp_replace(record, '"[^"]*"', '', 'g'), ',', '')) + 1 AS fields
  FROM records
), taken AS (
  SELECT *, {", ".join(f"regexp_extract(record, '^{','.join([_FIELD] * 7)}$', {i}, 's') AS f{i}" for i in range(1, 8))} FROM shaped
), unquoted AS (
  SELECT *, {", ".join(f"""CASE WHEN f{i} LIKE '"%' THEN replace(substr(f{i}, 2, length(f{i}) - 2), '""', '"') ELSE f{i} END AS v{i}""" for i in range(1, 8))} FROM taken
), judged AS (
  SELECT *, regexp_full_match({q.strip("v4")}, '(1[5-9][0-9]{{2}}|2[01][0-9]{{2}}|2200)?') AS year_ok,
    regexp_full_match({q.strip("v5")}, '(10\\.[0-9]{{4,9}}/{q.WORD})?') AS doi_ok,
    {" + ".join(f"CAST(regexp_matches(record, '^{','.join([_FIELD] * k)}(,|$)', 's') AS INTEGER)" for k in range(1, 8))} AS sound
  FROM unquoted
)
"""

SQL = {
    "p5_found": _PARSED
    + """
SELECT line_id, 'quoting' AS reason FROM judged WHERE NOT well_formed
UNION ALL SELECT line_id, 'column_count' FROM judged WHERE well_formed AND fields <> 7
UNION ALL SELECT line_id, 'year' FROM judged WHERE well_formed AND fields = 7 AND NOT year_ok
UNION ALL SELECT line_id, 'doi' FROM judged WHERE well_formed AND fields = 7 AND NOT doi_ok
""",
    "p5_valid_rows": _PARSED
    + "SELECT line_id, v1 AS filename, v2 AS examiner, v3 AS title, v4 AS year, v5 AS doi, v6 AS source, v7 AS notes FROM judged WHERE well_formed AND fields = 7 AND year_ok AND doi_ok",
    "p5_broken_fields": _PARSED
    + """
SELECT line_id, 'quoting' AS reasons, CAST(sound + 1 AS INTEGER) AS broken_field FROM judged WHERE NOT well_formed
UNION ALL SELECT line_id, 'column_count', CAST(sound + 1 AS INTEGER) FROM judged WHERE well_formed AND fields <> 7
UNION ALL SELECT line_id, concat_ws(',', CASE WHEN NOT year_ok THEN 'year' END, CASE WHEN NOT doi_ok THEN 'doi' END), CASE WHEN year_ok THEN 5 ELSE 4 END
  FROM judged WHERE well_formed AND fields = 7 AND NOT (year_ok AND doi_ok)
""",
}
