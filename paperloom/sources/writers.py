"""The corpus' files from tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.manifest import ENRICHED, MANIFEST
from paperloom.storage import staged


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> str:
    """Create a folder and those above it; nothing happens if it is there."""
    where, system = _files(spark, path)
    system.mkdirs(where)
    return path


def _as_one_file(rows: DataFrame, path: str, write) -> None:
    """Write the rows, in their order, and put the part that comes out in place of ``path``."""
    spark = rows.sparkSession
    write(rows.coalesce(1).write.mode("overwrite"), path + ".parts")
    parts, system = _files(spark, path + ".parts")
    target, _ = _files(spark, path)
    system.delete(target, True)
    found = [s.getPath() for s in system.listStatus(parts) if s.getPath().getName().startswith("part-")]
    if found:
        system.rename(found[0], target)
    else:
        system.create(target).close()
    system.delete(parts, True)


def write_manifest(rows: DataFrame, path: str, order: str = "row_id", columns: tuple[str, ...] = MANIFEST) -> None:
    """A CSV file of the manifest's columns in the order of ``order``; nulls and missing columns are blank."""
    have = set(rows.columns)
    own = staged(rows.select(F.col(order).alias("_order"), *[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in columns]), "manifest")
    csv = lambda w, p: w.csv(p, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    _as_one_file(own.orderBy("_order").drop("_order"), path, csv)


def write_enriched(rows: DataFrame, path: str, order: str = "row_id") -> None:
    write_manifest(rows, path, order, ENRICHED)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines with all fields, also null ones, and letters as they are. A folder of parts that
    readers take like one file; rows keep their order by part."""
    rows.write.mode("overwrite").json(path, ignoreNullFields=False)


def front_matter(fields: dict[str, Column], body: Column) -> Column:
    """A text behind a block of ``fields`` in their order, as YAML that quotes every text."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))
    lines = [F.concat(F.lit(f"{name}: "), F.coalesce(quoted(c), F.lit("null"))) for name, c in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n"), F.regexp_replace(body, r"\A\s+|\s+\z", ""), F.lit("\n"))


def file_name(name: str, suffix: str) -> str:
    """The name with its suffix; one too long for a file system is cut and told apart by its hash."""
    if len(name.encode()) + len(suffix) <= 200:
        return name + suffix
    return name.encode()[:150].decode("utf-8", "ignore") + "-" + hashlib.sha256(name.encode()).hexdigest()[:16] + suffix


def single_files(spark: SparkSession, folder: str) -> bool:
    """Whether tasks can write single files: all run on this machine, and the folder is one of its own."""
    return spark.sparkContext.master.startswith("local") and "://" not in folder.removeprefix("file://")


def write_each(rows: DataFrame, folder: str, name: str, content: str, suffix: str) -> None:
    """One file for each row, written by the tasks: ``content`` to ``folder/name + suffix``. On a cluster,
    whose tasks share no local folder, the rows are JSON lines in ``folder/all.jsonl`` instead."""
    make_folder(rows.sparkSession, folder)
    if not single_files(rows.sparkSession, folder):
        rows.select(name, content).filter(F.col(content).isNotNull()).write.mode("overwrite").json(f"{folder}/all.jsonl")
        return
    plain = folder.removeprefix("file://")

    def write(part):
        for row in part:
            if row[1] is not None:
                with open(f"{plain}/{file_name(row[0], suffix)}", "w", encoding="utf-8", newline="\n") as file:
                    file.write(row[1])

    rows.select(name, content).foreachPartition(write)


def paper_table(folder: str) -> str:
    """Where the papers of a folder are as one table."""
    return folder.rstrip("/") + ".jsonl"


def write_papers(papers: DataFrame, folder: str) -> None:
    """All papers as a table of JSON lines, which the later stages read, beside ``folder``; on a single
    machine also the JSON document of each paper, indented, under its id."""
    write_jsonl(papers.drop("file"), paper_table(folder))
    if not single_files(papers.sparkSession, folder):
        return
    shown = papers.select("paper_id", F.to_json(F.struct(*[c for c in papers.columns if c != "file"]), {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))
    write_each(shown, folder, "paper_id", "json", ".json")


def write_report(lines: DataFrame, folder: str) -> None:
    """(report, place, line): a text of its lines, in the order of ``place``, for each report.

    Each is a folder ``report=NAME`` of text parts, to be read in the order of their names, so a report
    of any size is written by many tasks.
    """
    lines.repartitionByRange("report", "place").sortWithinPartitions("report", "place").select("report", "line").write.mode("overwrite").partitionBy("report").text(folder)


def write_warnings(notes: DataFrame, folder: str) -> int:
    """(item, warning) as JSON lines, a folder of parts; returns their number."""
    notes.toDF("item", "warning").write.mode("overwrite").json(folder)
    return notes.sparkSession.read.schema("item string, warning string").json(folder).count()


def clear_generated(spark: SparkSession, folders: dict[str, str]) -> list[str]:
    """Delete the files of each folder that end with its suffix; returns warnings for those that can't be."""
    notes = []
    for folder, suffix in folders.items():
        where, system = _files(spark, folder)
        if not system.exists(where):
            continue
        for status in system.listStatus(where):
            path = status.getPath()
            if path.getName().endswith(suffix):
                try:
                    system.delete(path, True)
                except Exception as exc:
                    notes.append(f"Could not remove stale generated file {path}: {exc}")
    return notes
