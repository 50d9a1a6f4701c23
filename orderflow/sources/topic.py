"""The message topic: Kafka in deployment, a directory of text files where there is no broker.

Both forms carry one event per record in a column called value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.events import encode
from orderflow.sources.paths import listing


class Topic(Protocol):
    """What poller and stream ask of a topic."""

    def publish(self, orders: DataFrame) -> None: ...

    def stream(self, spark: SparkSession) -> DataFrame: ...


# A backlog is worked off in batches that commit one by one, and a crowded topic partition is
# read by several tasks. The limits only say how the records are cut up; all of them are read.
TOPIC_LIMITS = {"maxOffsetsPerTrigger": "100000000", "maxRecordsPerPartition": "1000000"}
# A file that was listed and is gone when its batch is read is passed over; lost_files tells which.
DIRECTORY_LIMITS = {"maxFilesPerTrigger": "10000", "ignoreMissingFiles": "true"}


@dataclass
class KafkaTopic:
    """options go to the reader and take precedence over TOPIC_LIMITS; those that start with
    "kafka.", such as security settings, go to the writer as well."""

    brokers: str
    name: str
    options: dict = field(default_factory=dict)

    def publish(self, orders: DataFrame) -> None:
        writer = encode(orders).write.format("kafka")
        writer.options(**self.write_options()).mode("append").save()

    def write_options(self) -> dict:
        client = {k: v for k, v in self.options.items() if k.startswith("kafka.")}
        return {"kafka.bootstrap.servers": self.brokers, "topic": self.name, **client}

    def read_options(self) -> dict:
        return {
            "kafka.bootstrap.servers": self.brokers,
            "subscribe": self.name,
            "startingOffsets": "earliest",
            "failOnDataLoss": "false",
            **TOPIC_LIMITS,
            **self.options,
        }

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self.read_options())
        return reader.load().select("value")


@dataclass
class DirectoryTopic:
    """options go to the reader and take precedence over DIRECTORY_LIMITS."""

    path: str
    options: dict = field(default_factory=dict)

    def publish(self, orders: DataFrame) -> None:
        self.publish_raw(encode(orders))

    def publish_raw(self, values: DataFrame) -> None:
        values.select("value").write.mode("append").text(self.path)

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.options(**{**DIRECTORY_LIMITS, **self.options}).text(self.path)

    def stream_with_files(self, spark: SparkSession) -> DataFrame:
        """stream() with the column file, for noting_files."""
        return self.stream(spark).select("value", F.col("_metadata.file_path").alias("file"))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.text(self.path)


def noting_files(write: Callable[[DataFrame, int], None], checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A write for foreachBatch that also keeps, next to the checkpoint, which files a batch was
    read from. The batch has a column file, which write does not get."""

    def noted(batch: DataFrame, batch_id: int) -> None:
        files = batch.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        files.write.mode("overwrite").parquet(f"{checkpoint}_files/batch={batch_id}")
        write(batch.drop("file"), batch_id)

    return noted


def lost_files(spark: SparkSession, topic: DirectoryTopic, checkpoint: str) -> DataFrame:
    """batch, file: the gaps of a directory topic. The checkpoint says which files make up a batch; of
    these, lost are those that were not read and are not there any more. A file that is there and
    empty is none, and neither is one that was removed after it had been read."""
    lines = spark.read.text(f"{checkpoint}/sources/0/[0-9]*")
    entry = F.from_json("value", "path string, batchId bigint")
    path = lambda column: F.regexp_replace(column, "^[a-z0-9]+:/+", "/")
    listed = lines.where(F.col("value").startswith("{")).select(entry.alias("e"))
    listed = listed.select(F.col("e.batchId").alias("batch"), path(F.col("e.path")).alias("file")).distinct()
    read = spark.read.schema("file string, n bigint").parquet(f"{checkpoint}_files/batch=*")
    gone = listed.join(read.select(path(F.col("file")).alias("file")), "file", "left_anti")
    there = listing(spark, topic.path, "*")
    if there is not None:
        gone = gone.join(there.select(path(F.col("file")).alias("file")), "file", "left_anti")
    return gone.select("batch", "file")


def configured_topic(config: dict) -> Topic:
    kafka = config["kafka"]
    options = dict(kafka.get("options") or {})
    if "directory" in kafka:
        return DirectoryTopic(kafka["directory"], options)
    return KafkaTopic(kafka["brokers"], kafka["topic"], options)
