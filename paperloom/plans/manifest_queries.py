"""Queries over the manifest and what preflight found of its files, with the SQL they are checked by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import checks, names, tokens
from paperloom.operators import manifest, preflight, reports
from paperloom.plans import sqltext as q
from paperloom.storage import spread

_FIELDS = ("title", "year", "doi", "source")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _found(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, found): what preflight read from each file."""
    own = _table(spark, folder, "preflight")
    return own.select("filename", F.struct(*[F.coalesce(f"extracted_{c}", F.lit("")).alias(c) for c in _FIELDS]).alias("found"))


def _ids(spark: SparkSession, folder: str) -> DataFrame:
    own = _table(spark, folder, "manifest").filter(F.col("filename") != "")
    return own.select("row_id", names.paper_id(F.col("examiner"), F.col("year"), F.col("title"), F.col("filename")).alias("paper_id"))


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    files = _table(spark, folder, "chunks").select(F.col("source_pdf").alias("filename"), "sha256")
    return manifest.validate(_table(spark, folder, "manifest").select("row_id", *manifest.MANIFEST), files)


def manifest_scan(spark, folder):
    return manifest.scan(_table(spark, folder, "manifest"), _found(spark, folder)).withColumn("changed", F.array_join("changed", ","))


def manifest_validation(spark, folder):
    return _validated(spark, folder)


def missing_metadata(spark, folder):
    return manifest.missing_metadata(_validated(spark, folder)).select("row_id", "filename", "validation_warnings")


def duplicate_files(spark, folder):
    return _validated(spark, folder).filter("duplicate_sha256 = 'true'").select("row_id", "filename", "sha256")


def consistency_warnings(spark, folder):
    one = _found(spark, folder).groupBy("filename").agg(F.min_by("found", F.to_json("found")).alias("found"))
    rows = _table(spark, folder, "manifest").join(one, "filename")
    return manifest.consistency_warnings(rows).filter(F.size("warnings") > 0).select("row_id", F.array_join("warnings", "; ").alias("warnings"))


def missing_files(spark, folder):
    return manifest.not_in(_table(spark, folder, "manifest"), _table(spark, folder, "preflight"), "filename")


def unprocessed_files(spark, folder):
    done = _table(spark, folder, "chunks").select(F.col("source_pdf").alias("filename"))
    return manifest.not_in(_table(spark, folder, "preflight"), done, "filename")


def current_chunks(spark, folder):
    return reports.current(_table(spark, folder, "chunks"), _ids(spark, folder)).select("row_id", "paper_id")


def paper_chunk_counts(spark, folder):
    return reports.chunks_of_papers(_ids(spark, folder).select("paper_id").distinct(), _table(spark, folder, "chunks"))


def filename_parts(spark, folder):
    name = F.col("filename")
    parts = {"examiner": names.examiner_from_path(name), "title": names.title_from_path(name), "year": names.year_from_path(name), "stem": names.stem(name)}
    return _table(spark, folder, "manifest").select("row_id", *[v.alias(k) for k, v in parts.items()])


def paper_ids(spark, folder):
    return _ids(spark, folder)


def parsed_years(spark, folder):
    return _table(spark, folder, "manifest").select("row_id", names.parse_year(F.col("year")).alias("year")).filter(F.col("year").isNotNull())


def suspicious_sources(spark, folder):
    own = _table(spark, folder, "manifest").groupBy("source").agg(F.count("*").alias("n"))
    return own.filter(checks.suspicious_source(F.col("source"))).select("source", "n")


def preflight_totals(spark, folder):
    return preflight.totals(_table(spark, folder, "preflight"))


def preflight_warnings(spark, folder):
    own = _table(spark, folder, "preflight")
    row = {c: F.col(c) for c in ("filename", "extracted_year", "extracted_title", "extracted_source", "likely_scanned", "huge_pdf", "file_mb")}
    notes = preflight.warnings(row | {"file_mb": F.col("file_mb").cast("decimal(18,2)")}, F.col("warnings"))
    year = preflight.displayed_year(F.col("filename"), F.col("extracted_year"))
    return own.select("filename", "pages", "text_chars", year.alias("year"), F.array_join(notes, "; ").alias("warnings"))


def page_density(spark, folder):
    own = _table(spark, folder, "preflight")
    per_page = tokens.rounded(F.col("text_chars"), F.col("pages").cast("bigint"), 1)
    scanned = checks.likely_scanned(F.col("pages"), per_page)
    return own.select("filename", "pages", "text_chars", per_page.alias("chars_per_page"), F.coalesce(scanned, F.lit(False)).alias("likely_scanned"))


def measured_files(spark, folder):
    """What preflight measures of each file, with the file's chunks as its pages."""
    pages = spread(_table(spark, folder, "chunks").select(F.col("source_pdf").alias("filename"), F.col("page_start").alias("page_no"), "text"))
    files = _table(spark, folder, "preflight").groupBy("filename").agg(F.round(F.min("file_mb") * 1_000_000).cast("bigint").alias("length"))
    return preflight.measure(pages, files).withColumn("pages", F.col("pages").cast("bigint"))


QUERIES = {
    f.__name__: f
    for f in (
        manifest_scan, manifest_validation, missing_metadata, duplicate_files, consistency_warnings, missing_files, unprocessed_files, current_chunks,
        paper_chunk_counts, filename_parts, paper_ids, parsed_years, suspicious_sources, preflight_totals, preflight_warnings, page_density, measured_files,
    )
}

_FILE_YEAR = q.year_of_file("filename")
_VALIDATED = f"""
WITH files AS (SELECT source_pdf AS filename, min(sha256) AS sha FROM chunks WHERE source_pdf <> '' GROUP BY source_pdf
), joined AS (
  SELECT row_id, m.filename, examiner, title, year, doi, source, notes, f.filename IS NOT NULL AS there, coalesce(sha, '') AS sha256 FROM manifest m LEFT JOIN files f USING (filename)
), counted AS (SELECT *, sha256 <> '' AND count(*) OVER (PARTITION BY sha256) > 1 AS again FROM joined
), validated AS (
  SELECT row_id, filename, examiner, title, year, doi, source, notes, CAST(there AS VARCHAR) AS "exists", sha256, CAST(again AS VARCHAR) AS duplicate_sha256,
    array_to_string(list_filter([
      CASE WHEN filename = '' THEN 'filename missing' END, CASE WHEN NOT there THEN 'PDF file missing' END,
      {", ".join(f"CASE WHEN {q.strip(c)} = '' THEN '{c} missing' END" for c in ("examiner", "title", "year", "source", "doi"))},
      CASE WHEN {_FILE_YEAR} <> '' AND {q.strip("year")} <> {_FILE_YEAR} THEN 'manifest year differs from filename year ' || {_FILE_YEAR} END,
      CASE WHEN {q.suspicious("source")} THEN 'source looks suspicious: ' || source END, CASE WHEN again THEN 'duplicate PDF hash' END
    ], lambda x: x IS NOT NULL), '; ') AS validation_warnings FROM counted
)"""
_ONE = "one AS (SELECT filename, min(extracted_title) AS t, min(extracted_year) AS y, min(extracted_doi) AS d, min(extracted_source) AS s FROM preflight GROUP BY filename)"
_NEW = {"title": "t", "year": f"CASE WHEN {_FILE_YEAR} <> '' THEN {_FILE_YEAR} ELSE y END", "doi": "d", "source": "s"}
_DRAFT = f"starts_with(notes, '{manifest.DRAFT}')"
_REPLACE = {"examiner": f"(examiner = '' AND {q.folder('filename')} <> '')"} | {
    c: f"(({v}) <> '' AND ({c} = '' OR ({_DRAFT} AND {c} <> ({v})){f' OR {q.strip(c)} = {q.title_of_file(chr(102) + "ilename")}' if c == 'title' else ''}))" for c, v in _NEW.items()
}
_REPLACE["source"] = f"({_REPLACE['source']} OR (s = '' AND {_DRAFT} AND {q.suspicious('source')}))"
_VALUE = {"examiner": q.folder("filename")} | _NEW

SQL = {
    "manifest_scan": f"""
WITH {_ONE}, ordered AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY row_id) = 1 AS first FROM manifest
), joined AS (
  SELECT row_id AS ord, coalesce(m.filename, o.filename) AS filename, coalesce(examiner, {q.folder("o.filename")}) AS examiner, coalesce(title, {q.title_of_file("o.filename")}) AS title,
    coalesce(year, '') AS year, coalesce(doi, '') AS doi, coalesce(source, '') AS source, coalesce(notes, '{manifest.DRAFT}') AS notes, m.filename IS NULL AS new, o.filename IS NOT NULL AS on_disk,
    o.filename IS NOT NULL AND coalesce(first, true) AS used, coalesce(t, '') AS t, coalesce(y, '') AS y, coalesce(d, '') AS d, coalesce(s, '') AS s
  FROM ordered m FULL JOIN one o ON m.filename = o.filename
), merged AS (
  SELECT *, {", ".join(f"used AND {r} AS r_{c}" for c, r in _REPLACE.items())} FROM joined
), done AS (
  SELECT ord, filename, {", ".join(f"CASE WHEN r_{c} THEN {v} ELSE {c} END AS new_{c}" for c, v in _VALUE.items())}, notes, new, on_disk,
    array_to_string(list_filter([{", ".join(f"CASE WHEN r_{c} THEN '{c}' END" for c in _VALUE)}], lambda x: x IS NOT NULL), ',') AS changed FROM merged
)
SELECT ord, filename, {", ".join(f"new_{c} AS {c}" for c in _VALUE)}, CASE WHEN changed <> '' AND notes = '{manifest.DRAFT}' THEN '{manifest.DRAFT_FILLED}' ELSE notes END AS notes, changed,
  CASE WHEN new THEN 'added' WHEN NOT on_disk AND filename <> '' THEN 'missing' WHEN changed <> '' THEN 'updated' ELSE 'kept' END AS state FROM done""",
    "manifest_validation": _VALIDATED + "SELECT * FROM validated",
    "missing_metadata": _VALIDATED + "SELECT row_id, filename, validation_warnings FROM validated WHERE contains(lower(validation_warnings), 'missing')",
    "duplicate_files": _VALIDATED + "SELECT row_id, filename, sha256 FROM validated WHERE duplicate_sha256 = 'true'",
    "consistency_warnings": f"""
WITH {_ONE}, joined AS (
  SELECT row_id, {_FILE_YEAR} AS fy, y, {q.strip("year")} AS year, {q.strip("coalesce(nullif(source, ''), s)")} AS source FROM manifest JOIN one USING (filename)
), noted AS (
  SELECT row_id, array_to_string(list_filter([
    CASE WHEN fy <> '' AND y <> '' AND fy <> y THEN 'filename year ' || fy || ' differs from extracted PDF year ' || y END,
    CASE WHEN fy <> '' AND year <> '' AND fy <> year THEN 'manifest year ' || year || ' differs from filename year ' || fy END,
    CASE WHEN {q.suspicious("source")} THEN 'source looks suspicious: ' || source END
  ], lambda x: x IS NOT NULL), '; ') AS warnings FROM joined
) SELECT row_id, warnings FROM noted WHERE warnings <> ''""",
    "missing_files": "SELECT DISTINCT filename FROM manifest WHERE filename NOT IN (SELECT filename FROM preflight)",
    "unprocessed_files": "SELECT DISTINCT filename FROM preflight WHERE filename NOT IN (SELECT source_pdf FROM chunks)",
    "current_chunks": f"SELECT row_id, paper_id FROM chunks WHERE paper_id IN (SELECT {q.paper_id()} FROM manifest WHERE filename <> '')",
    "paper_chunk_counts": f"""
WITH ids AS (SELECT DISTINCT {q.paper_id()} AS paper_id FROM manifest WHERE filename <> ''), counts AS (SELECT paper_id, count(*) AS n FROM chunks GROUP BY paper_id)
SELECT paper_id, coalesce(n, 0) AS n FROM ids LEFT JOIN counts USING (paper_id)""",
    "filename_parts": f"SELECT row_id, {q.folder('filename')} AS examiner, {q.title_of_file('filename')} AS title, {_FILE_YEAR} AS year, {q.stem('filename')} AS stem FROM manifest",
    "paper_ids": f"SELECT row_id, {q.paper_id()} AS paper_id FROM manifest WHERE filename <> ''",
    "parsed_years": f"""
WITH n AS (SELECT row_id, try_cast(nullif(regexp_extract({q.strip("year")}, '\\A\\+?0*(\\d{{1,9}})\\z', 1), '') AS INTEGER) AS y FROM manifest)
SELECT row_id, y AS year FROM n WHERE y BETWEEN 1500 AND 2200""",
    "suspicious_sources": f"SELECT source, count(*) AS n FROM manifest WHERE {q.suspicious('source')} GROUP BY source",
    "preflight_totals": """
SELECT count(*) AS files, CAST(count_if(likely_scanned) AS BIGINT) AS scanned, CAST(count_if(huge_pdf) AS BIGINT) AS huge, CAST(count_if(len(warnings) > 0) AS BIGINT) AS with_warnings FROM preflight""",
    "preflight_warnings": f"""
WITH noted AS (
  SELECT *, {_FILE_YEAR} AS fy, list_concat(warnings, list_filter([
    CASE WHEN {_FILE_YEAR} <> '' AND extracted_year <> '' AND {_FILE_YEAR} <> extracted_year THEN 'filename year ' || {_FILE_YEAR} || ' differs from extracted PDF year ' || extracted_year END,
    CASE WHEN likely_scanned THEN 'very little text layer detected; PDF may be scanned' END, CASE WHEN huge_pdf THEN 'large PDF file (' || CAST(file_mb AS DECIMAL(18,2)) || ' MB)' END,
    CASE WHEN coalesce(extracted_title, '') = '' THEN 'title not found in PDF metadata' END,
    CASE WHEN {q.suspicious("extracted_source")} THEN 'source looks suspicious: ' || extracted_source END
  ], lambda x: x IS NOT NULL)) AS notes FROM preflight
)
SELECT filename, pages, text_chars, coalesce(nullif(fy, ''), extracted_year) AS year,
  array_to_string(list_filter(notes, lambda x, i: list_position(notes, x) = i), '; ') AS warnings FROM noted""",
    "measured_files": f"""
WITH of_pages AS (SELECT source_pdf AS filename, count(*) AS pages, CAST(sum(length({q.strip("coalesce(text, '')")})) AS BIGINT) AS text_chars FROM chunks GROUP BY source_pdf
), sizes AS (
  SELECT filename, coalesce(pages, 0) AS pages, CAST(round(size_mb * 1000000) AS BIGINT) AS bytes, coalesce(text_chars, 0) AS text_chars
  FROM (SELECT filename, min(file_mb) AS size_mb FROM preflight GROUP BY filename) LEFT JOIN of_pages USING (filename)
), halves AS (
  SELECT *, CASE WHEN pages = 0 THEN 0 ELSE {q.rounded_up('text_chars', 'pages', 10)} END AS tenths, {q.rounded_up('bytes', '1048576', 100)} AS hundredths FROM sizes
) SELECT filename, pages, CAST(hundredths AS DOUBLE) / 100.0 AS file_mb, text_chars, CAST(tenths AS DOUBLE) / 10.0 AS chars_per_page, bytes >= {checks.HUGE_FROM} AS huge_pdf,
  coalesce(pages > 0 AND tenths < 2000, false) AS likely_scanned FROM halves""",
    "page_density": """
WITH halves AS (SELECT filename, pages, text_chars, CASE WHEN pages > 0 THEN (text_chars * 20 + pages) // (pages * 2) - CASE WHEN (text_chars * 20 + pages) % (pages * 2) = 0 AND ((text_chars * 20 + pages) // (pages * 2)) % 2 = 1 THEN 1 ELSE 0 END ELSE 0 END AS tenths FROM preflight)
SELECT filename, pages, text_chars, CAST(tenths AS DOUBLE) / 10.0 AS chars_per_page, coalesce(pages > 0 AND tenths < 2000, false) AS likely_scanned FROM halves""",
}
