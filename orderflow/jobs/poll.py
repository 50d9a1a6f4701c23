"""Poll the order table and publish what is new: spark-submit orderflow/jobs/poll.py --config F"""

from __future__ import annotations

import argparse
import logging
import threading

from orderflow.config import load_config
from orderflow.schema import DEFAULT_ID_TYPE
from orderflow.session import job_session, stop_on_signal
from orderflow.sources.state import set_watermark
from orderflow.sources.table import jdbc_table
from orderflow.sources.topic import configured_topic
from orderflow.streaming.poll import poll_until

log = logging.getLogger(__name__)

# Seconds. created_at is when a transaction began, so rows commit behind the watermark.
LOOK_BACK = 60


def main(argv: list[str] | None = None, stop: threading.Event | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    parser.add_argument("--from", dest="moment", help="set the watermark, also back, and go on")
    arguments = parser.parse_args(argv)
    config = load_config(arguments.config)
    spark = job_session("orderflow-poll")
    streaming = config["streaming"]
    id_type = streaming.get("id_type", DEFAULT_ID_TYPE)
    table = jdbc_table(spark, config)
    # Only the sink that removes copies may get some.
    look_back = LOOK_BACK if streaming.get("unique", True) else 0
    try:
        if arguments.moment:
            set_watermark(
                spark, streaming["last_processed_timestamp_location"], arguments.moment
            )
        for difference in table.differences(id_type):
            log.warning("the table differs: %s", difference)
        poll_until(
            stop or stop_on_signal(),
            spark,
            table,
            configured_topic(config),
            streaming["last_processed_timestamp_location"],
            streaming["batch_interval"],
            streaming.get("look_back", look_back),
            id_type,
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
