"""Stream order events into the lake: spark-submit orderflow/jobs/stream.py --config F"""

from __future__ import annotations

import argparse
import logging
import math

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderflow.config import load_config
from orderflow.schema import DEFAULT_ID_TYPE
from orderflow.session import job_session, stop_on_signal
from orderflow.sources.topic import configured_topic
from orderflow.streaming.gather import Gather, start_gathered
from orderflow.streaming.ingest import (
    UniqueSink,
    clean_stream,
    start_append,
    start_rejects,
    start_split,
    start_unique,
    stream_name,
)

log = logging.getLogger(__name__)


class QualityLog(StreamingQueryListener):
    """Logs, per micro-batch, how many events were seen, kept and rejected for which reason."""

    def onQueryStarted(self, event):
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event):
        counts = event.progress.observedMetrics.get("events")
        if counts is not None and event.progress.numInputRows:
            log.info("batch %d: %s", event.progress.batchId, counts.asDict())

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info("stream %s ended, error: %s", event.id, event.exception)


def gather_of(spark: SparkSession, config: dict) -> Gather | None:
    """streaming.least_rows and longest_delay (seconds): orders wait until so many are there, or for
    so long; for the duplicate-free sink without datalake.rejects. None without least_rows."""
    lake, streaming = config["datalake"], config["streaming"]
    if "least_rows" not in streaming:
        return None
    if not streaming.get("unique", True) or "rejects" in lake:
        raise ValueError("streaming.least_rows needs the duplicate-free sink, and no datalake.rejects")
    checkpoint = streaming["checkpoint_location"]
    sink = UniqueSink(
        spark,
        lake["path"],
        lake["format"],
        streaming.get("id_type", DEFAULT_ID_TYPE),
        stream_name(spark, checkpoint),
        lake.get("quarantine"),
    )
    delay = streaming.get("longest_delay", math.inf)
    return Gather(spark, sink.write, f"{checkpoint}/orderflow_waiting", streaming["least_rows"], delay)


def start(
    spark: SparkSession, config: dict, gather: Gather | None = None, **trigger
) -> list[StreamingQuery]:
    """Start the configured streams; the trigger defaults to the poll interval.

    streaming.unique: false selects the plain file sink, which keeps copies. datalake.rejects
    names a folder for the events left out: the duplicate-free sink writes them along with the
    lake, the file sink needs a stream of their own. datalake.quarantine names one for orders
    that no file can be written with; without it they stop the stream.
    """
    lake, streaming = config["datalake"], config["streaming"]
    id_type = streaming.get("id_type", DEFAULT_ID_TYPE)
    raw = configured_topic(config).stream(spark)
    checkpoint, fmt, rejected = streaming["checkpoint_location"], lake["format"], lake.get("rejects")
    trigger = trigger or {"processingTime": f"{streaming['batch_interval']} seconds"}
    if gather is not None:
        return [start_gathered(clean_stream(raw, id_type), gather, checkpoint, **trigger)]
    if streaming.get("unique", True):
        options = {"id_type": id_type, "quarantine": lake.get("quarantine"), **trigger}
        if rejected:
            return [start_split(raw, lake["path"], rejected, checkpoint, fmt, **options)]
        return [start_unique(clean_stream(raw, id_type), lake["path"], checkpoint, fmt, **options)]
    queries = [start_append(clean_stream(raw, id_type), lake["path"], checkpoint, fmt, **trigger)]
    if rejected:
        queries.append(start_rejects(raw, rejected, f"{checkpoint}_rejects", id_type, **trigger))
    return queries


def main(argv: list[str] | None = None, **trigger) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    config = load_config(parser.parse_args(argv).config)
    spark = job_session("orderflow-stream")
    spark.streams.addListener(QualityLog())
    stop = stop_on_signal()
    try:
        gather = gather_of(spark, config)
        queries = start(spark, config, gather, **trigger)
        while not stop.is_set() and not all([q.awaitTermination(timeout=1) for q in queries]):
            if gather is not None:
                gather.flush_if_due()
        for query in queries:
            query.stop()
        if gather is not None:
            gather.flush()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
