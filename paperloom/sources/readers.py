"""Tables from the corpus' files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.manifest import ENRICHED, MANIFEST, tidy
from paperloom.schemas import CHUNK, PAPER


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def uri(path: str) -> str:
    return path if "://" in path else f"file://{path}"


def read_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", with_content: bool = False) -> DataFrame:
    """(filename, path, length[, content, sha256]) of the files below ``folder``; ``filename`` is the
    path from there. A folder that isn't there has no files."""
    content = ", content binary, sha256 string" if with_content else ""
    if not exists(spark, folder):
        return spark.createDataFrame([], f"filename string, path string, length bigint{content}")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    root = folder.rstrip("/").partition("://")[2] or folder.rstrip("/")
    plain = F.regexp_replace("path", r"^[a-z0-9+.-]+:/+", "/")
    name = F.substring(plain, F.lit(len(root if root.startswith("/") else "/" + root) + 2), F.length(plain))
    more = ["content", F.sha2("content", 256).alias("sha256")] if with_content else []
    return found.select(name.alias("filename"), "path", "length", *more)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with ``row_id``, the order of its rows; empty if there is no file.

    Quoted values may hold line ends; a byte order mark is skipped; other columns are dropped, missing
    ones blank.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in MANIFEST) + ", row_id bigint")
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", nullValue="", emptyValue="", inferSchema=False)
    rows = rows.withColumnRenamed("\ufeff" + MANIFEST[0], MANIFEST[0])
    return tidy(rows).withColumn("row_id", F.monotonically_increasing_id())


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """The validated manifest with all its columns, values as written; empty if there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in ENRICHED))
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", inferSchema=False)
    return rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in rows.columns])


def read_papers(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each paper of the table beside ``folder`` and of the JSON files in it, with ``file``,
    the file's stem.

    The paper's id is the stem if the file has none; of files with one id the last by name counts, and
    before all files the row of the table.
    """
    rows = spark.createDataFrame([], PAPER + ", file string, own boolean")
    table = folder.rstrip("/") + ".jsonl"
    if exists(spark, table):
        rows = rows.unionByName(spark.read.schema(PAPER).json(table).withColumn("file", F.col("paper_id")).withColumn("own", F.lit(True)))
    if exists(spark, folder):
        single = spark.read.schema(PAPER).json(folder, multiLine=True, pathGlobFilter="*.json")
        rows = rows.unionByName(single.withColumn("file", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")).withColumn("own", F.lit(False)))
    rows = rows.withColumn("paper_id", F.coalesce(F.nullif("paper_id", F.lit("")), "file"))
    last = rows.groupBy("paper_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("paper_id", "own")]), F.struct("own", "file")).alias("row"))
    return last.select("paper_id", "row.*")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of JSON lines, with ``row_id`` in their order; a broken line raises."""
    if not exists(spark, path):
        return spark.createDataFrame([], CHUNK + ", row_id bigint")
    return spark.read.schema(CHUNK).json(path, mode="FAILFAST").withColumn("row_id", F.monotonically_increasing_id())
