"""The poller: table to topic, one bounded slice per poll."""

from __future__ import annotations

import logging
import threading
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from orderflow.operators.increment import beyond, cursor_after
from orderflow.schema import DEFAULT_ID_TYPE, EPOCH, LARGEST_ID
from orderflow.sources.state import read_cursor, read_watermark, save_cursor, save_watermark
from orderflow.sources.table import OrderTable, Reach
from orderflow.sources.topic import Topic

log = logging.getLogger(__name__)


def poll_once(
    spark: SparkSession,
    table: OrderTable,
    topic: Topic,
    state: str,
    look_back: float = 0,
    id_type: str = DEFAULT_ID_TYPE,
    last: Reach | None = None,
) -> Reach:
    """Publish what is new and move the watermark; returns what the poll took.

    The watermark moves after the write. A crash in between publishes the slice again, and the
    lake's duplicate removal takes the second copy out. The same removal makes look_back safe:
    so many seconds before the watermark are published along with what is new, which picks up
    rows committed late with an older created_at, or with the watermark's own. Without anything
    new the look back is published alone, unless it holds what the last poll found in it.

    An id that id_type cannot hold fails the poll before anything is published.
    """
    lo = read_watermark(spark, state)
    reach = table.reach(lo)
    taken = reach
    if look_back and lo != EPOCH:
        start = str(datetime.fromisoformat(lo) - timedelta(seconds=look_back))
        taken = table.extent(start, reach.hi or lo)
        if reach.hi is None:
            reach = replace(reach, back=taken)
    else:
        start = lo
    if reach.hi is None and (not taken.rows or last is not None and last.back == taken):
        return reach
    if taken.max_id is not None and taken.max_id > LARGEST_ID[id_type]:
        raise ValueError(f"order_id {taken.max_id} does not fit {id_type}; set streaming.id_type")
    topic.publish(table.slice(start, taken))
    if reach.hi is not None:
        save_watermark(spark, state, reach.hi)
    return reach


def poll_next(spark: SparkSession, orders: DataFrame, topic: Topic, state: str, rows: int) -> bool:
    """Publish the next rows in the order of (created_at, order_id) and move the cursor; False when
    there are none. A poll ends anywhere in a tie, and the next one goes on from there, so a busy
    moment is cut like any other stretch and no row is published twice or passed over."""
    lo = read_cursor(spark, state)
    hi = cursor_after(orders, lo, rows)
    if hi is None:
        return False
    topic.publish(beyond(orders, lo, hi))
    save_cursor(spark, state, hi)
    return True


def poll_until(
    stop: threading.Event,
    spark: SparkSession,
    table: OrderTable,
    topic: Topic,
    state: str,
    interval: float,
    look_back: float = 0,
    id_type: str = DEFAULT_ID_TYPE,
) -> None:
    """Poll at the interval until the event is set; the poll under way is finished first.

    A failed poll leaves the watermark where it was, so the next one repeats it. While the
    table holds more than a poll takes, the next one follows at once.
    """
    taken = None
    while True:
        more = False
        try:
            taken = poll_once(spark, table, topic, state, look_back, id_type, taken)
            more = taken.more
            log.info("published %d orders", taken.rows)
        except Exception:
            log.exception("poll failed, next try in %s s", interval)
        if stop.wait(0 if more else interval):
            return
