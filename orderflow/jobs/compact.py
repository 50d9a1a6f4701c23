"""Compact the lake's closed days: spark-submit orderflow/jobs/compact.py --config F

For a lake of the duplicate-free sink, while its stream is stopped. Days before today (UTC) with
several files are rewritten; --before takes another date.
"""

from __future__ import annotations

import argparse
import logging
from datetime import date, datetime, timezone

from orderflow.config import load_config
from orderflow.schema import DEFAULT_ID_TYPE
from orderflow.session import job_session
from orderflow.sources.compaction import compact
from orderflow.sources.ledger import Ledger

log = logging.getLogger(__name__)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    parser.add_argument("--before", type=date.fromisoformat, help="days before this date, today if not given")
    arguments = parser.parse_args(argv)
    config = load_config(arguments.config)
    spark = job_session("orderflow-compact")
    lake = config["datalake"]
    try:
        id_type = config["streaming"].get("id_type", DEFAULT_ID_TYPE)
        before = arguments.before or datetime.now(timezone.utc).date()
        days = compact(Ledger(spark, lake["path"], lake["format"], id_type), before)
        log.info("days rewritten: %d", days)
        return days
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
