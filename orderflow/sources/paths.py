"""Questions about storage, asked through Spark so that any file system will do."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def load_if_any(reader: DataFrameReader, path: str) -> DataFrame | None:
    """What the path, or everything a glob matches, holds; None when there is no such file."""
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return load_if_any(spark.read.format("binaryFile"), path) is not None


def listing(spark: SparkSession, path: str, names: str) -> DataFrame | None:
    """file (its whole path), folder (the name of the one it lies in), length and modified of all files
    below the path whose names fit the glob; None when there is no such path. No file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = load_if_any(reader.option("pathGlobFilter", names), path)
    if found is None:
        return None
    folder = F.regexp_extract("path", "([^/]*)/[^/]*$", 1)
    return found.select(
        F.col("path").alias("file"), folder.alias("folder"), "length", F.col("modificationTime").alias("modified")
    )


def _at(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def delete(spark: SparkSession, *paths: str) -> None:
    """Files, or folders with all they hold; what is not there is no error."""
    for path in paths:
        system, there = _at(spark, path)
        system.delete(there, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; the folder it goes to is made if need be."""
    system, there = _at(spark, path)
    _, goal = _at(spark, to)
    system.mkdirs(goal.getParent())
    if not system.rename(there, goal):
        raise OSError(f"cannot move {path} to {to}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly in a folder; none when it is not there."""
    system, there = _at(spark, path)
    if not system.exists(there):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(there))
