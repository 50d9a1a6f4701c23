"""The lake: Parquet (or another file format) in date=YYYY-MM-DD folders, append only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schema import DEFAULT_ID_TYPE, lake_schema
from orderflow.sources.paths import listing, path_exists

NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


def by_date(orders: DataFrame) -> DataFrame:
    """Bring each day's rows together before a partitioned write.

    Without it every task opens a file for every day it meets. Rebalancing lets adaptive
    execution cut a hot day into several tasks of advisory size and merge small days, where
    a plain repartition("date") would hand a hot day to one task.
    """
    return orders.hint("rebalance", "date")


def append_by_date(
    orders: DataFrame, path: str, fmt: str = "parquet", name: str | None = None
) -> None:
    """Append cleaned orders. The writer sorts by day anyway; sorting by id as well gives row
    groups narrow id ranges, which lookups by id and the search for known ids skip on.

    With a name, the files begin with it, and the rows stay dealt to tasks as they are.
    """
    writer = (by_date(orders) if name is None else orders).sortWithinPartitions("date", "order_id").write
    if name is not None:
        writer = writer.option("mapreduce.output.basename", name)
    writer.mode("append").format(fmt).partitionBy("date").save(path)


def read_lake(
    spark: SparkSession, path: str, fmt: str = "parquet", id_type: str = DEFAULT_ID_TYPE
) -> DataFrame:
    return spark.read.format(fmt).schema(lake_schema(id_type)).load(path)


def data_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row: the number of data files, from the listing alone."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{fmt}")
        .load(path)
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def files_per_day(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """date, n_files of a lake, from a listing that the cluster shares; no file is opened."""
    found = listing(spark, path, f"*.{fmt}").where(F.col("folder").startswith("date="))
    day = F.regexp_replace("folder", "^date=", "")
    counted = found.groupBy(F.nullif(day, F.lit(NULL_DATE)).cast("date").alias("date"))
    return counted.agg(F.count(F.lit(1)).alias("n_files"))


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink owns this folder. Readers then trust its log alone."""
    return path_exists(spark, f"{path}/_spark_metadata")
