"""Files and records that keep arriving, taken in as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.operators import rowparse
from paperloom.operators.manifest import scan
from paperloom.sources.readers import exists


def watch_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """A stream of (filename, path, length, modified) of new files below ``folder``."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    found = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    root = folder.rstrip("/").removeprefix("file://")
    plain = F.regexp_replace("path", r"^[a-z0-9+.-]+:/+", "/")
    return found.select(F.substring(plain, F.lit(len(root) + 2), F.length(plain)).alias("filename"), "path", "length", F.col("modificationTime").alias("modified"))


def keep_manifest(files: DataFrame, target: str, checkpoint: str, describe: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Merge each batch of files into the manifest at ``target``, a folder of numbered Parquet versions.

    ``describe`` turns a batch into (filename, found). A batch that is repeated after a failure writes
    the same version again, so each file is taken in once.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{target}/version={number - 1}"
        if exists(spark, before):
            old = spark.read.parquet(before)
        else:
            old = spark.createDataFrame([], "row_id bigint, filename string, examiner string, title string, year string, doi string, source string, notes string")
        new = scan(old, describe(batch)).drop("changed", "state")
        new = new.withColumn("row_id", F.coalesce("ord", F.lit(number).cast("bigint") * (1 << 40) + F.abs(F.xxhash64("filename")) % (1 << 40))).drop("ord")
        new.write.mode("overwrite").parquet(f"{target}/version={number}")

    return files.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parse_uploads(records: DataFrame, late_after: str = "30 days") -> DataFrame:
    """A stream of parsed records of a stream (line_id, raw_line, received_at): repeated ids dropped
    within ``late_after`` of their time."""
    once = records.withWatermark("received_at", late_after).dropDuplicatesWithinWatermark(["line_id"])
    return rowparse.parse_rows(once)
