"""Where operators put intermediate tables that later steps read more than once."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; all executors must be able to read it.

    Only a local master may run without the setting: it then gets a folder of its own,
    which is also entered as the session's checkpoint folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="paperloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage at a compressed, columnar table which survives the loss of
    executors, and keeps a table that several steps read from being computed again. The
    tables of a session are deleted at its end, or by ``discard``.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/staged/{spark.sparkContext.applicationId}"
    _deleted_at_end(spark, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@cache
def _deleted_at_end(spark: SparkSession, folder: str) -> None:
    def delete() -> None:
        try:
            _delete(spark, folder)
        except Exception:
            return  # the session is gone, and what deletes files with it

    atexit.register(delete)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(table: DataFrame) -> None:
    """Delete the staged tables that ``table`` reads; nothing may read them after that."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if "/staged/" in path:
            _delete(table.sparkSession, path)


def spread(table: DataFrame) -> DataFrame:
    """A table as read from files, dealt over all cores if its files give fewer parts than these.

    Work on texts is bound by the processor, so a few large files must not keep it on a few cores. A
    table of many files is left as it is, without an exchange. For plain reads only.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores)
