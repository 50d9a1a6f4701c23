"""One query per operator, each over the whole of a given table."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators import quality, reports
from orderflow.operators.events import clean, decode, encode, rejects, with_date
from orderflow.operators.increment import (
    high_watermark,
    increment,
    order_facts,
    with_position,
    write_in_order,
)
from orderflow.plans.views import ID_TYPE, EventTable, event_orders, shop_orders
from orderflow.schema import EPOCH, ORDER_COLS
from orderflow.session import scratch_dir
from orderflow.sources.catalog import create_orders, insert_orders
from orderflow.sources.compaction import compact
from orderflow.sources.lake import append_by_date, files_per_day, read_lake
from orderflow.sources.ledger import Ledger, file_name
from orderflow.sources.paths import delete, listing, path_exists
from orderflow.sources.state import read_watermark
from orderflow.sources.table import FrameTable
from orderflow.sources.topic import DirectoryTopic, lost_files, noting_files
from orderflow.streaming.gather import Gather, start_gathered
from orderflow.streaming.ingest import (
    UniqueSink,
    clean_stream,
    start_append,
    start_split,
    start_unique,
)
from orderflow.streaming.poll import poll_next, poll_once

Query = Callable[[SparkSession, str], DataFrame]

WAVE_CUT = "2024-01-15 00:00:00"
# Orders that one query makes unwritable.
OLD = "order_id IN (3, 101)"
# Five waves by the day of the month; orders without a time are in the first. The same in SQL.
WAVES = 5
WAVE = "CAST(floor(coalesce(day(created_at), 0) / 7) AS BIGINT)"


def _plain_time(events: DataFrame) -> DataFrame:
    """The parsed time without a zone, as the source table has it."""
    return events.withColumn(
        "created_at_timestamp", F.col("created_at_timestamp").cast("timestamp_ntz")
    )


def _decoded(orders: DataFrame) -> DataFrame:
    """Orders after the way over the wire, without a topic in between."""
    on_the_wire = encode(orders).select(F.col("value").cast("binary").alias("value"))
    return decode(on_the_wire, ID_TYPE)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_decoded(event_orders(spark, sf_dir)))


def _lake(spark: SparkSession, path: str) -> DataFrame:
    return read_lake(spark, path, id_type=ID_TYPE)


_built: dict[tuple[str, str], str] = {}


def _event_lake_path(spark: SparkSession, sf_dir: str) -> str:
    """The lake of all event orders, written once per session and read by several queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built or not path_exists(spark, f"{_built[key]}/_SUCCESS"):
        path = scratch_dir(spark, "lake")
        append_by_date(_cleaned(spark, sf_dir), path)
        _built[key] = path
    return _built[key]


def _event_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, _event_lake_path(spark, sf_dir))


# --- polling -------------------------------------------------------------------------------


def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment(event_orders(spark, sf_dir, after=WAVE_CUT), WAVE_CUT)


def incremental_scan_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increment(event_orders(spark, sf_dir, after=EPOCH), EPOCH)


def incremental_scan_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strictly after a moment that many rows share: none of those comes back."""
    return increment(shop_orders(spark, sf_dir), "1995-06-17 00:00:00")


def high_watermark_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_watermark(event_orders(spark, sf_dir))


def _ordered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    folder = scratch_dir(spark, "sorted")
    write_in_order(rows, folder)
    return spark.read.parquet(folder)


def increment_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(_ordered(spark, increment(event_orders(spark, sf_dir))))


def increment_ordered_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(_ordered(spark, increment(shop_orders(spark, sf_dir))))


def increment_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files of both increments show: ends of the order, and nothing out of it."""
    views = {"events": event_orders(spark, sf_dir), "orders": shop_orders(spark, sf_dir)}
    facts = [
        order_facts(_ordered(spark, increment(rows))).withColumn("source", F.lit(name)) for name, rows in views.items()
    ]
    return facts[0].unionByName(facts[1])


def incremental_scan_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven polls of a table whose moments have many rows each: all of them end within a tie. What
    they published, with the number of the poll."""
    orders = shop_orders(spark, sf_dir)
    total = orders.where(F.col("created_at").isNotNull()).count()
    state, polls = scratch_dir(spark, "state"), []
    while True:
        topic = DirectoryTopic(scratch_dir(spark, "topic"))
        if not poll_next(spark, orders, topic, state, max(1, math.ceil(total / 7))):
            break
        polls.append(decode(topic.read(spark), ID_TYPE).withColumn("poll", F.lit(len(polls)).cast("bigint")))
    nothing = decode(spark.createDataFrame([], "value string"), ID_TYPE).withColumn("poll", F.lit(0).cast("bigint"))
    return reduce(DataFrame.unionByName, polls, nothing)


def empty_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = EventTable(spark, sf_dir).reach(EPOCH).hi
    return high_watermark(event_orders(spark, sf_dir, after=newest), newest).select("n")


def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls while the table grows and one idle poll: what the state says, and how many
    rows reached the topic."""
    topic, state = DirectoryTopic(scratch_dir(spark, "topic")), scratch_dir(spark, "state")
    for grown_to in ("2024-01-10 00:00:00", "2024-01-20 00:00:00", None, None):
        poll_once(spark, EventTable(spark, sf_dir, grown_to), topic, state)
    hi = F.lit(read_watermark(spark, state)).cast("timestamp_ntz")
    return topic.read(spark).agg(F.count(F.lit(1)).alias("n")).select(hi.alias("hi"), "n")


# --- wire ----------------------------------------------------------------------------------


def wire_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published to a topic and read back."""
    topic = DirectoryTopic(scratch_dir(spark, "topic"))
    topic.publish(event_orders(spark, sf_dir))
    return decode(topic.read(spark), ID_TYPE)


def wire_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(event_orders(spark, sf_dir))


def parse_created_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(with_date(_decoded(event_orders(spark, sf_dir))))


# --- cleaning ------------------------------------------------------------------------------


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_cleaned(spark, sf_dir))


def clean_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = rejects(_decoded(event_orders(spark, sf_dir)))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- lake ----------------------------------------------------------------------------------


def lake_append_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lake")
    append_by_date(_cleaned(spark, sf_dir), path)
    return _plain_time(_lake(spark, path))


def lake_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_lake(spark, sf_dir).select(
        "order_id", "customer_name", "amount", "order_status", "date"
    )


def lake_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_lake(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def lake_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and data files of each day, of a lake that three batches wrote, each a file for each
    of its days."""
    path = scratch_dir(spark, "lake")
    sink = UniqueSink(spark, path, id_type=ID_TYPE)
    orders = _cleaned(spark, sf_dir)
    for third in range(3):
        sink.write(orders.where(F.col("order_id") % 3 == third))
    counted = _lake(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    listed = files_per_day(spark, path).withColumnRenamed("date", "day")
    joined = counted.join(listed, F.col("date").eqNullSafe(F.col("day")), "full")
    return joined.select("date", "n", "n_files")


def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake of three batches, compacted, after which two of them come again: its orders, and the
    number of files of their day."""
    path = scratch_dir(spark, "lake")
    orders = _cleaned(spark, sf_dir)
    thirds = [orders.where(F.col("order_id") % 3 == third) for third in range(3)]
    sink = UniqueSink(spark, path, id_type=ID_TYPE)
    for rows in thirds:
        sink.write(rows)
    compact(sink.ledger)
    for rows in thirds[:2]:
        UniqueSink(spark, path, id_type=ID_TYPE).write(rows)
    listed = files_per_day(spark, path).withColumnRenamed("date", "day")
    stored = _plain_time(_lake(spark, path))
    return stored.join(listed, F.col("date").eqNullSafe(F.col("day"))).drop("day")


def lake_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(reports.orders_on(_event_lake(spark, sf_dir), "2024-01-20"))


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orders_by_id(_event_lake(spark, sf_dir), 102, 103).select(
        "order_id", "customer_name", "amount", "order_status", "date"
    )


def reconcile_source_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With planted differences: the lake lost the sign-ups and has the clicks twice, and the
    source does not know the purchases."""
    expected = _cleaned(spark, sf_dir).where("item <> 'purchase'")
    lake = _event_lake(spark, sf_dir)
    kept = lake.where("item <> 'signup'").unionByName(lake.where("item = 'click'"))
    return quality.reconcile(expected, kept)


# --- streaming -----------------------------------------------------------------------------


def _drain(
    start: Callable, topic: DirectoryTopic, spark: SparkSession, lake: str, checkpoint: str
) -> None:
    """Run a stream over what the topic holds now, until it is used up."""
    orders = clean_stream(topic.stream(spark), ID_TYPE)
    start(orders, lake, checkpoint, availableNow=True).awaitTermination()


_start_unique = partial(start_unique, id_type=ID_TYPE)


def _mixed_topic(spark: SparkSession, sf_dir: str) -> DirectoryTopic:
    """Events mixed with as many texts of another JSON shape and as many that are not JSON."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    topic = DirectoryTopic(scratch_dir(spark, "topic"))
    topic.publish(event_orders(spark, sf_dir))
    topic.publish_raw(events.select(F.col("props").alias("value")))
    topic.publish_raw(events.select(F.col("event_type").alias("value")))
    return topic


def lake_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = _mixed_topic(spark, sf_dir)
    lake = scratch_dir(spark, "lake")
    _drain(start_append, topic, spark, lake, scratch_dir(spark, "checkpoint"))
    return _plain_time(_lake(spark, lake))


def lake_incremental_two_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll and stream, let the table grow, poll and stream again, and once more for nothing."""
    topic, state = DirectoryTopic(scratch_dir(spark, "topic")), scratch_dir(spark, "state")
    lake, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    for grown_to in (WAVE_CUT, None, None):
        poll_once(spark, EventTable(spark, sf_dir, grown_to), topic, state)
        _drain(start_append, topic, spark, lake, checkpoint)
    return _plain_time(_lake(spark, lake))


def _with_batch(spark: SparkSession, lake: str) -> DataFrame:
    """A lake's orders with the batch that the ledger says has stored them."""
    entries = Ledger(spark, lake, id_type=ID_TYPE).read().where("file IS NOT NULL AND batch IS NOT NULL")
    batches = entries.select("file", "batch").distinct()
    return _lake(spark, lake).withColumn("file", file_name()).join(batches, "file", "left").drop("file")


def _waves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    orders = event_orders(spark, sf_dir).withColumn("_wave", F.expr(WAVE))
    return [orders.where(F.col("_wave") == wave).drop("_wave") for wave in range(WAVES)]


def _topic_of_waves(spark: SparkSession, sf_dir: str) -> DirectoryTopic:
    """A topic with a file for each wave, read one at a time."""
    topic = DirectoryTopic(scratch_dir(spark, "topic"), {"maxFilesPerTrigger": "1"})
    for wave in _waves(spark, sf_dir):
        topic.publish(wave.coalesce(1))
    return topic


def stream_rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of the topic for each micro-batch: every order, with the batch that stored it."""
    lake = scratch_dir(spark, "lake")
    _drain(_start_unique, _topic_of_waves(spark, sf_dir), spark, lake, scratch_dir(spark, "checkpoint"))
    return _plain_time(_with_batch(spark, lake))


def stream_gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of one file each that go on together as soon as they have two fifths of the
    orders, and what is left at the end: every order, with the batch that stored it."""
    lake, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    sink = UniqueSink(spark, lake, id_type=ID_TYPE, stream="gathered")
    least = math.ceil(_cleaned(spark, sf_dir).count() * 2 / 5)
    gather = Gather(spark, sink.write, scratch_dir(spark, "waiting"), least, longest_delay=math.inf)
    orders = clean_stream(_topic_of_waves(spark, sf_dir).stream(spark), ID_TYPE)
    start_gathered(orders, gather, checkpoint, availableNow=True).awaitTermination()
    gather.flush()
    return _plain_time(_with_batch(spark, lake))


def topic_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last file of the topic vanishes while the first batch is written: the stream goes on,
    stores the rest, and the gap is known. Files lost, and orders stored."""
    topic = _topic_of_waves(spark, sf_dir)
    newest = listing(spark, topic.path, "*.txt").orderBy(F.desc("modified")).first()["file"]
    lake, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    sink = UniqueSink(spark, lake, id_type=ID_TYPE, stream="gap")

    def write(batch: DataFrame, batch_id: int) -> None:
        delete(spark, newest)
        sink.write(clean(decode(batch, ID_TYPE)), batch_id)

    raw = topic.stream_with_files(spark).writeStream.option("checkpointLocation", checkpoint)
    raw.foreachBatch(noting_files(write, checkpoint)).trigger(availableNow=True).start().awaitTermination()
    stored = _lake(spark, lake).agg(F.count(F.lit(1)).alias("n_stored"))
    return lost_files(spark, topic, checkpoint).agg(F.count(F.lit(1)).alias("n_lost")).join(stored)


def unique_replay_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two batches breaks off with part of its files written. A new sink gets it
    again, twice, and the first one as well: every order is stored once, by its batch."""
    lake = scratch_dir(spark, "lake")
    orders = _cleaned(spark, sf_dir).withColumn("_wave", F.expr(WAVE.replace("created_at", "created_at_timestamp")))
    first, second = (orders.where(rule).drop("_wave") for rule in ("_wave < 2", "_wave >= 2"))
    UniqueSink(spark, lake, id_type=ID_TYPE, stream="replayed").write(first, 0)
    append_by_date(second.where(F.col("order_id") % 2 == 0), lake, name="replayed-1")
    sink = UniqueSink(spark, lake, id_type=ID_TYPE, stream="replayed")
    for batch_id in (1, 1, 0):
        sink.write((first, second)[batch_id], batch_id)
    UniqueSink(spark, lake, id_type=ID_TYPE, stream="replayed").write(second, 1)
    return _plain_time(_with_batch(spark, lake))


def quarantined_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with events of the year 900, which the writer refuses in this session: all others
    are stored, and those are in the quarantine."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    for kind in ("int96", "datetime"):
        session.conf.set(f"spark.sql.parquet.{kind}RebaseModeInWrite", "EXCEPTION")
    lake, aside = scratch_dir(spark, "lake"), scratch_dir(spark, "quarantine")
    old = F.when(F.expr(OLD), F.lit("0900-01-01T00:00:00Z")).otherwise(F.col("created_at"))
    events = _decoded(event_orders(session, sf_dir)).withColumn("created_at", old)
    UniqueSink(session, lake, id_type=ID_TYPE, stream="refused", quarantine=aside).write(clean(events), 0)
    stored = _lake(spark, lake).select(*ORDER_COLS, F.lit(False).alias("refused"))
    refused = spark.read.schema(", ".join(f"{c} string" for c in ORDER_COLS)).parquet(aside)
    kinds = {"order_id": ID_TYPE, "amount": "double"}
    refused = refused.select(*[F.col(c).cast(kinds.get(c, "string")) for c in ORDER_COLS], F.lit(True).alias("refused"))
    return stored.unionByName(refused)


def dedup_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wave 1, wave 2, then wave 1 published once more: every order is stored once."""
    topic = DirectoryTopic(scratch_dir(spark, "topic"))
    lake, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    first = increment(event_orders(spark, sf_dir, until=WAVE_CUT), hi=WAVE_CUT)
    second = increment(event_orders(spark, sf_dir, after=WAVE_CUT), WAVE_CUT)
    for wave in (first, second, first):
        topic.publish(wave)
        _drain(_start_unique, topic, spark, lake, checkpoint)
    return _plain_time(_lake(spark, lake))


def late_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups of the first wave commit only after its poll, behind the watermark it leaves.
    The second poll looks back over them, and what it repeats is stored once."""
    topic, state = DirectoryTopic(scratch_dir(spark, "topic")), scratch_dir(spark, "state")
    lake, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    in_time = event_orders(spark, sf_dir, until=WAVE_CUT).where("item <> 'signup'")
    month = 31 * 24 * 3600
    for table in (FrameTable(in_time), EventTable(spark, sf_dir)):
        poll_once(spark, table, topic, state, look_back=month)
        _drain(_start_unique, topic, spark, lake, checkpoint)
    return _plain_time(_lake(spark, lake))


def reject_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the cleaning leaves out of a topic of events, other JSON and plain words, written
    along with the lake by one stream.

    Writers space JSON differently, so of an event's own text the fields are compared.
    """
    topic = _mixed_topic(spark, sf_dir)
    lake, path = scratch_dir(spark, "lake"), scratch_dir(spark, "rejects")
    start_split(
        topic.stream(spark), lake, path, scratch_dir(spark, "checkpoint"), id_type=ID_TYPE, availableNow=True
    ).awaitTermination()
    found = spark.read.parquet(path)
    event = F.col("value").startswith('{"order_id"')
    fields = F.from_json("value", "order_id string, amount string, created_at string, customer_name string")
    text = [
        F.when(event, fields["order_id"]).alias("text_id"),
        F.when(event, fields["amount"].cast("double")).alias("text_amount"),
        F.when(event, fields["created_at"]).alias("text_created_at"),
        F.when(event, fields["customer_name"]).alias("text_customer"),
    ]
    return found.select(*ORDER_COLS, "reason", *text, F.when(~event, F.col("value")).alias("value"))


def insert_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh order goes into a catalog table without a time and gets the time of its
    insert; defaulted says so, and its created_at is left out."""
    name = f"orders_{uuid.uuid4().hex}"
    location = scratch_dir(spark, "table")
    start = spark.range(1).select(F.expr("localtimestamp()")).first()[0]
    create_orders(spark, name, location, ID_TYPE, amount="double")
    orders = shop_orders(spark, sf_dir)
    seventh = F.col("order_id") % 7 == 0
    insert_orders(spark, name, orders.where(~seventh))
    insert_orders(spark, name, orders.where(seventh).drop("created_at"))
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    stored = spark.read.schema(schema).parquet(location)
    now = F.col("created_at") >= F.lit(start)
    return stored.select(
        *ORDER_COLS[:-1], F.when(~now, F.col("created_at")).alias("created_at"), F.coalesce(now, F.lit(False)).alias("defaulted")
    )


# --- reports and checks --------------------------------------------------------------------


def orders_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orders_per_date(_event_lake(spark, sf_dir))


def revenue_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report at the end of the whole way: wire, cleaning, lake, read-back."""
    path = scratch_dir(spark, "lake")
    append_by_date(_cleaned(spark, sf_dir), path)
    return reports.orders_per_date(_lake(spark, path))


def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_dates(_event_lake(spark, sf_dir))


def total_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.total_orders(event_orders(spark, sf_dir))


def order_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table against a gate that it passes and one that it does not."""
    return reports.gate(reports.total_orders(event_orders(spark, sf_dir)), 10, 10**9)


def latest_orders_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_orders(event_orders(spark, sf_dir), 5)


def latest_orders_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_orders(event_orders(spark, sf_dir), 3).drop("created_at")


def latest_orders_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_orders(shop_orders(spark, sf_dir), 5)


def status_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.status_violations(event_orders(spark, sf_dir))


def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_violations(event_orders(spark, sf_dir))


def never_polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.never_polled(event_orders(spark, sf_dir))


def registered() -> dict[str, Query]:
    return {
        "incremental_scan": incremental_scan,
        "incremental_scan_epoch": incremental_scan_epoch,
        "incremental_scan_ties": incremental_scan_ties,
        "high_watermark": high_watermark_epoch,
        "increment_ordered": increment_ordered,
        "increment_ordered_ties": increment_ordered_ties,
        "increment_file_order": increment_file_order,
        "incremental_scan_cursor": incremental_scan_cursor,
        "empty_increment": empty_increment,
        "watermark_state": watermark_state,
        "wire_encode": wire_encode,
        "wire_decode": wire_decode,
        "parse_created_at": parse_created_at,
        "clean_orders": clean_orders,
        "clean_count": clean_count,
        "rejects_by_reason": rejects_by_reason,
        "lake_append_by_date": lake_append_by_date,
        "lake_readback": lake_readback,
        "lake_count": lake_count,
        "lake_file_count": lake_file_count,
        "lake_compacted": lake_compacted,
        "lake_partition_prune": lake_partition_prune,
        "point_lookup": point_lookup,
        "reconcile_source_lake": reconcile_source_lake,
        "lake_stream_append": lake_stream_append,
        "lake_incremental_two_waves": lake_incremental_two_waves,
        "stream_rate_limited": stream_rate_limited,
        "stream_gathered": stream_gathered,
        "topic_gap": topic_gap,
        "unique_replay_batch": unique_replay_batch,
        "quarantined_batch": quarantined_batch,
        "dedup_replay": dedup_replay,
        "late_commits": late_commits,
        "reject_table": reject_table,
        "insert_defaults": insert_defaults,
        "orders_per_date": orders_per_date,
        "revenue_per_date": revenue_per_date,
        "distinct_dates": distinct_dates,
        "total_orders": total_orders,
        "order_gate": order_gate,
        "latest_orders_topk": latest_orders_topk,
        "latest_orders_top3": latest_orders_top3,
        "latest_orders_ties": latest_orders_ties,
        "status_violations": status_violations,
        "null_violations": null_violations,
        "never_polled": never_polled,
    }
