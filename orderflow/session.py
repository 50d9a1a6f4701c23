"""Session settings for the jobs, and scratch folders the whole cluster can see."""

from __future__ import annotations

import logging
import signal
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession


def job_session(app_name: str) -> SparkSession:
    """Event times are wall-clock text stamped with a literal Z, so the jobs run in UTC.

    Adaptive execution is what splits a hot date and merges tiny ones when the lake is written.
    Timestamps are stored as 64-bit microseconds, which have row group statistics.
    Master, memory and connector packages belong to spark-submit.
    """
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .getOrCreate()
    )


def stop_on_signal() -> threading.Event:
    """An event that Ctrl-C and a polite kill set, so that a job can end between two steps."""
    stop = threading.Event()
    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, lambda *_: stop.set())
    return stop


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only a session that names none (a local test) falls back to this machine's disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/orderflow-{uuid.uuid4().hex}/{name}"
