"""Tables written to the folder that driver and executors share, to cut a plan there: later stages restart from them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from litloom.session import shared_dir

#: Tables staged so far, by the application's folder.
_tables: dict[str, set[str]] = {}


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of path, and path as one of its own."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def run_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one; Hadoop deletes it when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/litloom-{spark.sparkContext.applicationId}"
    if path not in _tables:
        _tables[path] = set()
        files, place = file_system(spark, path)
        files.mkdirs(place)
        files.deleteOnExit(place)
    return path


def staged(df: DataFrame, tag: str, *partition_by: str) -> DataFrame:
    """df written as a table in the shared folder, in folders by the columns partition_by, and read back."""
    spark = df.sparkSession
    folder = run_dir(spark)
    path = f"{folder}/{tag}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    _tables[folder].add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def staged_bytes(table: DataFrame) -> int:
    """Bytes of a staged table's files."""
    files, place = file_system(table.sparkSession, table.staged_at)
    return files.getContentSummary(place).getLength()


def forget(*tables: DataFrame) -> None:
    """Deletes staged tables that no plan still to be run reads."""
    for table in tables:
        files, place = file_system(table.sparkSession, table.staged_at)
        files.delete(place, True)
        _tables[run_dir(table.sparkSession)].discard(table.staged_at)


def staged_tables(spark: SparkSession) -> set[str]:
    """The tables that this application has staged and not deleted."""
    return set(_tables[run_dir(spark)])


def release(spark: SparkSession, before: set[str], *keep: DataFrame) -> None:
    """Deletes what was staged since staged_tables() gave `before`, but for keep; for when a result has been written."""
    for path in staged_tables(spark) - before - {t.staged_at for t in keep}:
        files, place = file_system(spark, path)
        files.delete(place, True)
        _tables[run_dir(spark)].discard(path)
