"""The manifest of a corpus: scan, merge, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.checks import suspicious_source
from paperloom.functions.names import examiner_from_path, title_from_path, year_from_path
from paperloom.functions.unicode import strip

MANIFEST = ("filename", "examiner", "title", "year", "doi", "source", "notes")
ENRICHED = (*MANIFEST, "exists", "sha256", "duplicate_sha256", "validation_warnings")
DRAFT = "Draft row from scan-pdfs"
DRAFT_FILLED = "Draft row from scan-pdfs; metadata extracted from PDF"
NO_FILES = "raw_pdf_dir empty; add PDFs before validation"


def tidy(rows: DataFrame) -> DataFrame:
    """The manifest's columns only, as text without outer white space; missing ones and nulls are blank."""
    have = set(rows.columns)
    return rows.select(*[(strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in have else F.lit("")).alias(c) for c in MANIFEST])


def merge_extracted(rows: DataFrame, found: str = "found") -> DataFrame:
    """Fill a manifest's rows from the struct column ``found`` (title, year, doi, source).

    Blank fields are filled; rows with a draft note take new values over old ones; the file name's
    year goes before an extracted one; a draft's dubious source is blanked if there is no better.
    Adds ``changed``, the names of the changed fields. Rows whose ``found`` is null stay as they are.
    """
    old = {c: F.coalesce(F.col(c), F.lit("")) for c in MANIFEST}
    new = {c: F.coalesce(F.col(f"{found}.{c}"), F.lit("")) for c in ("title", "year", "doi", "source")}
    file_year = year_from_path(old["filename"])
    new["year"] = F.when(file_year != "", file_year).otherwise(new["year"])
    draft = F.startswith(old["notes"], F.lit(DRAFT))
    folder = examiner_from_path(old["filename"])
    known = F.col(found).isNotNull()
    replace: dict[str, Column] = {"examiner": (old["examiner"] == "") & (folder != "")}
    value: dict[str, Column] = {"examiner": folder}
    for c in ("title", "year", "doi", "source"):
        stale = (old[c] == "") | (draft & (old[c] != new[c]))
        if c == "title":
            stale = stale | (strip(old[c]) == title_from_path(old["filename"]))
        replace[c], value[c] = (new[c] != "") & stale, new[c]
    replace["source"] = replace["source"] | ((new["source"] == "") & draft & suspicious_source(old["source"]))
    changed = F.array_compact(F.array(*[F.when(known & replace[c], F.lit(c)) for c in ("examiner", "title", "year", "doi", "source")]))
    merged = [F.when(known & replace[c], value[c]).otherwise(old[c]).alias(c) for c in replace]
    notes = F.when((F.size(changed) > 0) & (old["notes"] == DRAFT), DRAFT_FILLED).otherwise(old["notes"]).alias("notes")
    rest = [c for c in rows.columns if c not in (*MANIFEST, found)]
    return rows.select(*rest, old["filename"].alias("filename"), *merged, notes, changed.alias("changed"))


def scan(manifest: DataFrame, files: DataFrame, placeholders: tuple[str, ...] = (), order: str = "row_id") -> DataFrame:
    """The manifest after a scan of ``files`` (filename, found): rows of known files updated, the
    first one by ``order`` of each file; rows of other files kept; drafts for new files behind.

    If all rows are ``placeholders``, they are dropped first. Adds ``ord``, ``changed`` and ``state``
    (``added``, ``updated``, ``kept``, ``missing``). No files: all rows kept.
    """
    own = tidy(manifest).withColumn("ord", F.lit(0)) if order not in manifest.columns else manifest.select(F.col(order).alias("ord"), *MANIFEST)
    own = own.select("ord", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in MANIFEST])
    if placeholders:
        real = own.filter(~F.col("filename").isin(*placeholders)).limit(1).count()
        own = own if real else own.limit(0)
    files = files.groupBy("filename").agg(F.min_by("found", F.struct(F.col("found").isNull(), F.to_json("found"))).alias("found"))
    named, blank_names = own.filter("filename <> ''"), own.filter("filename = ''").withColumn("first", F.lit(False))
    named = named.withColumn("first", F.row_number().over(Window.partitionBy("filename").orderBy("ord")) == 1)
    both = named.join(files.filter("filename <> ''").withColumn("on_disk", F.lit(True)), "filename", "full_outer").unionByName(blank_names, allowMissingColumns=True)
    new = F.col("first").isNull()
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in MANIFEST}
    draft = {
        "examiner": examiner_from_path(F.col("filename")), "title": title_from_path(F.col("filename")), "notes": F.lit(DRAFT),
    }
    empty = F.struct(*[F.lit("").alias(c) for c in ("title", "year", "doi", "source")])
    use = F.when(new | (F.col("on_disk") & F.col("first")), F.coalesce("found", empty))
    rows = both.select(
        "ord", "filename", *[F.when(new, draft[c]).otherwise(blank[c]).alias(c) if c in draft else blank[c].alias(c) for c in MANIFEST[1:]],
        use.alias("found"), new.alias("new"), F.coalesce("on_disk", F.lit(False)).alias("on_disk"),
    )
    merged = merge_extracted(rows)
    state = F.when(F.col("new"), "added").when(~F.col("on_disk") & (F.col("filename") != ""), "missing").when(F.size("changed") > 0, "updated").otherwise("kept")
    return merged.select("ord", *MANIFEST, "changed", state.alias("state"))


def consistency_warnings(rows: DataFrame, found: str = "found") -> DataFrame:
    """The rows with ``warnings``: years that contradict each other, and a dubious source."""
    file_year, year = year_from_path(F.col("filename")), strip(F.coalesce("year", F.lit("")))
    extracted = F.coalesce(F.col(f"{found}.year"), F.lit(""))
    source = strip(F.coalesce(F.nullif("source", F.lit("")), F.col(f"{found}.source"), F.lit("")))
    found_differs = (file_year != "") & (extracted != "") & (file_year != extracted)
    row_differs = (file_year != "") & (year != "") & (file_year != year)
    return rows.withColumn("warnings", F.array_compact(F.array(
        F.when(found_differs, F.concat(F.lit("filename year "), file_year, F.lit(" differs from extracted PDF year "), extracted)),
        F.when(row_differs, F.concat(F.lit("manifest year "), year, F.lit(" differs from filename year "), file_year)),
        F.when(suspicious_source(source), F.concat(F.lit("source looks suspicious: "), source)),
    )))


def validate(manifest: DataFrame, files: DataFrame, any_files: bool = True) -> DataFrame:
    """The enriched manifest: ``exists``, ``sha256``, ``duplicate_sha256`` and ``validation_warnings``.

    ``files`` holds (filename, sha256). A hash is a duplicate if two rows have it. Without any file
    every row says so. Other columns of the manifest are kept.
    """
    if not any_files:
        extra = {"exists": "false", "sha256": "", "duplicate_sha256": "false", "validation_warnings": NO_FILES}
        return manifest.withColumns({k: F.lit(v) for k, v in extra.items()})
    files = files.groupBy("filename").agg(F.min("sha256").alias("sha256")).withColumn("there", F.lit(True))
    rows = manifest.join(files.filter(F.col("filename") != ""), "filename", "left")
    there, sha = F.coalesce("there", F.lit(False)), F.coalesce("sha256", F.lit(""))
    counts = rows.filter(sha != "").groupBy("sha256").agg((F.count("*") > 1).alias("again"))
    hashed, other = rows.filter(sha != ""), rows.filter(sha == "").withColumn("again", F.lit(False))
    rows = hashed.join(counts, "sha256").unionByName(other)
    blank = lambda c: strip(F.coalesce(F.col(c), F.lit(""))) == ""
    file_year, source = year_from_path(F.coalesce("filename", F.lit(""))), F.coalesce("source", F.lit(""))
    again = F.coalesce("again", F.lit(False))
    notes = [
        F.when(F.coalesce("filename", F.lit("")) == "", "filename missing"),
        F.when(~there, "PDF file missing"),
        *[F.when(blank(c), f"{c} missing") for c in ("examiner", "title", "year", "source", "doi")],
        F.when((file_year != "") & (strip(F.coalesce("year", F.lit(""))) != file_year), F.concat(F.lit("manifest year differs from filename year "), file_year)),
        F.when(suspicious_source(source), F.concat(F.lit("source looks suspicious: "), source)),
        F.when(again, "duplicate PDF hash"),
    ]
    return rows.select(
        *[c for c in manifest.columns], there.cast("string").alias("exists"), sha.alias("sha256"), again.cast("string").alias("duplicate_sha256"),
        F.array_join(F.array_compact(F.array(*notes)), "; ").alias("validation_warnings"),
    )


def missing_metadata(enriched: DataFrame) -> DataFrame:
    """The rows with a warning that something is missing."""
    return enriched.filter(F.contains(F.lower("validation_warnings"), F.lit("missing")))


def not_in(rows: DataFrame, others: DataFrame, on: str) -> DataFrame:
    """The different values of ``on`` in ``rows`` that ``others`` doesn't have."""
    return rows.select(on).distinct().join(others.select(on), on, "left_anti")
