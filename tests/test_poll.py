import uuid

import pytest
from pyspark.sql import functions as F

from orderflow.operators.events import decode
from orderflow.schema import EPOCH, ORDER_COLS, STATUSES, table_schema
from orderflow.sources.state import read_watermark, set_watermark
from orderflow.sources.table import FrameTable, JdbcTable, Reach
from orderflow.sources.topic import DirectoryTopic, KafkaTopic, configured_topic
from orderflow.streaming import poll
from orderflow.streaming.poll import poll_once, poll_until
from tests.samples import ids, order

SEED = [order(i, f"2025-11-18 12:00:{i:02d}.5", status=STATUSES[i % 4]) for i in range(1, 11)]
MORE = [order(i, f"2025-11-18 13:00:{i:02d}") for i in range(11, 16)]


class FailingTopic(DirectoryTopic):
    failures = 1

    def publish(self, orders):
        if self.failures:
            self.failures -= 1
            raise ConnectionError("broker away")
        super().publish(orders)


def published(spark, topic):
    return ids(decode(topic.read(spark)))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_only_new_rows_are_published(spark, orders, folder, kind):
    def table(*rows):
        return FrameTable(orders(*rows).withColumn("created_at", F.col("created_at").cast(kind)))

    topic, state = DirectoryTopic(folder("topic")), folder("state")
    assert poll_once(spark, table(*SEED), topic, state).rows == 10
    assert poll_once(spark, table(*SEED), topic, state).rows == 0
    assert poll_once(spark, table(*SEED, *MORE), topic, state).rows == 5
    assert published(spark, topic) == list(range(1, 16))
    assert read_watermark(spark, state) == "2025-11-18 13:00:15"


def test_empty_table_publishes_nothing_and_keeps_the_state(spark, orders, folder, tmp_path):
    assert poll_once(spark, FrameTable(orders()), DirectoryTopic(folder("topic")), folder("s")).rows == 0
    assert not (tmp_path / "topic").exists()
    assert read_watermark(spark, folder("s")) == EPOCH


def test_a_row_inserted_during_the_poll_waits_for_the_next(spark, orders, folder):
    class Growing(FrameTable):
        def slice(self, lo, reach):
            self.orders = orders(*SEED, *MORE)
            return super().slice(lo, reach)

    topic, state = DirectoryTopic(folder("topic")), folder("state")
    table = Growing(orders(*SEED))
    poll_once(spark, table, topic, state)
    assert published(spark, topic) == list(range(1, 11))
    poll_once(spark, table, topic, state)
    assert published(spark, topic) == list(range(1, 16))


def test_poll_retry_publishes_the_same_slice(spark, orders, folder):
    topic, state = FailingTopic(folder("topic")), folder("state")
    waits, marks = [], []

    class ThreeRounds:
        def wait(self, seconds):
            waits.append(seconds)
            marks.append(read_watermark(spark, state))
            return len(waits) == 3

    poll_until(ThreeRounds(), spark, FrameTable(orders(*SEED)), topic, state, 5)
    assert waits == [5, 5, 5]
    assert marks == [EPOCH, "2025-11-18 12:00:10.5", "2025-11-18 12:00:10.5"]
    assert published(spark, topic) == list(range(1, 11))


def test_crash_before_the_state_is_saved_publishes_again(spark, orders, folder, monkeypatch):
    topic, state = DirectoryTopic(folder("topic")), folder("state")

    def crash(*args):
        raise OSError("disk away")

    monkeypatch.setattr(poll, "save_watermark", crash)
    with pytest.raises(OSError):
        poll_once(spark, FrameTable(orders(*SEED)), topic, state)
    monkeypatch.undo()
    poll_once(spark, FrameTable(orders(*SEED)), topic, state)
    assert published(spark, topic) == sorted(list(range(1, 11)) * 2)


LATE = [
    order(50, "2025-11-18 12:00:10.5"),  # ties with the watermark
    order(51, "2025-11-18 12:00:09"),  # before it, within the look-back
    order(52, "2025-11-18 11:00:00"),  # before it, beyond the look-back
]


@pytest.mark.parametrize(("look_back", "found"), [(0, []), (5, [50, 51]), (7200, [50, 51, 52])])
def test_look_back_picks_up_late_commits(spark, orders, folder, look_back, found):
    topic, state = DirectoryTopic(folder("topic")), folder("state")
    poll_once(spark, FrameTable(orders(*SEED)), topic, state, look_back)
    idle = poll_once(spark, FrameTable(orders(*SEED, *LATE)), topic, state, look_back)
    assert idle.rows == 0
    assert sorted(set(published(spark, topic))) == [*range(1, 11), *found]
    # The same look back is not published again, poll after poll.
    before = len(published(spark, topic))
    poll_once(spark, FrameTable(orders(*SEED, *LATE)), topic, state, look_back, last=idle)
    assert len(published(spark, topic)) == before
    assert poll_once(spark, FrameTable(orders(*SEED, *LATE, *MORE)), topic, state, look_back).rows == 5
    assert sorted(set(published(spark, topic))) == [*range(1, 16), *found]


def test_an_id_that_does_not_fit_fails_before_publishing(spark, orders, folder):
    topic, state = DirectoryTopic(folder("topic")), folder("state")
    table = FrameTable(orders(order(1), order(2**31)))
    with pytest.raises(ValueError, match="does not fit int"):
        poll_once(spark, table, topic, state)
    assert read_watermark(spark, state) == EPOCH
    poll_once(spark, table, topic, state, id_type="bigint")
    assert read_watermark(spark, state) != EPOCH


def test_watermark_set_back(spark, orders, folder):
    topic, state = DirectoryTopic(folder("topic")), folder("state")
    poll_once(spark, FrameTable(orders(*SEED)), topic, state)
    set_watermark(spark, state, "2025-11-18 12:00:05.5")
    assert read_watermark(spark, state) == "2025-11-18 12:00:05.5"
    poll_once(spark, FrameTable(orders(*SEED)), topic, state)
    assert sorted(published(spark, topic)) == [*range(1, 6), *[i for i in range(6, 11) for _ in "ab"]]


def test_look_back_is_split_by_the_rows_read(spark, orders, database):
    url, properties, insert = database
    insert(orders(*SEED, *MORE))
    table = JdbcTable(spark, url, "ORDERS", properties, rows_per_read=4)
    taken = table.extent("2025-11-18 00:00:00", "2025-11-18 12:00:10.5")
    assert (taken.rows, taken.min_id, taken.max_id) == (10, 1, 10)
    assert table.slice("2025-11-18 00:00:00", taken).rdd.getNumPartitions() == 3
    assert table.differences("bigint") == []
    assert table.differences("int") == ["order_id: bigint, expected int"]


@pytest.fixture
def database(spark):
    """An embedded database inside this JVM: no server, no port."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    properties = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}

    def insert(frame):
        upper = frame.toDF(*[c.upper() for c in frame.columns])
        upper.write.jdbc(url, "ORDERS", mode="append", properties=properties)

    return url, properties, insert


def test_database_table_is_polled_in_parallel(spark, orders, folder, database):
    url, properties, insert = database
    insert(orders(*SEED, order(99, None)))
    table = JdbcTable(spark, url, "ORDERS", properties, rows_per_read=4)
    reach = table.reach(EPOCH)
    assert (reach.hi, reach.rows, reach.min_id, reach.max_id) == ("2025-11-18 12:00:10.5", 10, 1, 10)
    assert table.slice(EPOCH, reach).rdd.getNumPartitions() == 3

    topic, state = DirectoryTopic(folder("topic")), folder("state")
    assert poll_once(spark, table, topic, state).rows == 10
    insert(orders(*MORE))
    assert poll_once(spark, table, topic, state).rows == 5
    assert poll_once(spark, table, topic, state).rows == 0
    assert published(spark, topic) == list(range(1, 16))


def test_a_database_table_without_times_has_nothing_to_poll(spark, orders, folder, database):
    url, properties, insert = database
    insert(orders())
    table, topic = JdbcTable(spark, url, "ORDERS", properties), DirectoryTopic(folder("topic"))
    for _ in range(2):
        assert table.reach(EPOCH) == Reach(None, 0)
        assert poll_once(spark, table, topic, folder("state")).rows == 0
        assert table.slice(EPOCH, table.reach_to(EPOCH)).count() == 0
        insert(orders(order(1, None)))
    assert table.never_polled().first()["never_polled"] == 2
    assert read_watermark(spark, folder("state")) == EPOCH


def test_a_backlog_is_taken_in_several_polls(spark, orders, folder, database):
    url, properties, insert = database
    tied = [order(i, "2025-11-18 12:00:05.5") for i in range(20, 26)]
    insert(orders(*SEED, *tied))
    table = JdbcTable(spark, url, "ORDERS", properties, rows_per_poll=6)
    topic, state = DirectoryTopic(folder("topic")), folder("state")
    waits = []

    class FourRounds:
        def wait(self, seconds):
            waits.append(seconds)
            return len(waits) == 4

    taken = [r.rows for r in (table.reach(EPOCH), table.reach("2025-11-18 12:00:05.5"))]
    assert taken == [11, 5]  # the tie at the end of the first poll comes along whole
    poll_until(FourRounds(), spark, table, topic, state, 5)
    assert waits == [0, 5, 5, 5]
    assert published(spark, topic) == [*range(1, 11), *range(20, 26)]


def test_late_commits_outside_the_id_bounds_are_still_read(spark, orders, database):
    url, properties, insert = database
    insert(orders(*[order(i) for i in range(100, 110)]))
    table = JdbcTable(spark, url, "ORDERS", properties, rows_per_read=3)
    reach = table.reach(EPOCH)
    insert(orders(order(1), order(500)))
    assert ids(table.slice(EPOCH, reach)) == [1, *range(100, 110), 500]


def test_database_slice_has_the_order_columns(spark, orders, database):
    url, properties, insert = database
    insert(orders(order(7, "2025-11-18 23:59:59.999999")))
    table = JdbcTable(spark, url, "ORDERS", properties)
    rows = table.slice(EPOCH, table.reach(EPOCH))
    assert rows.columns == ORDER_COLS
    assert dict(rows.dtypes)["created_at"] == "timestamp_ntz"
    assert rows.select(F.col("created_at").cast("string")).first()[0] == "2025-11-18 23:59:59.999999"


@pytest.mark.parametrize("name", ["orders; DROP TABLE orders", "orders o", "", "a..b"])
def test_table_names_cannot_carry_sql(spark, name):
    with pytest.raises(ValueError):
        JdbcTable(spark, "jdbc:x", name)


def test_watermarks_cannot_carry_sql(spark, database):
    url, properties, _ = database
    with pytest.raises(ValueError):
        JdbcTable(spark, url, "ORDERS", properties).reach("' OR '1'='1")


def test_topic_forms():
    kafka = {"brokers": "broker:9092", "topic": "orders_raw"}
    options = {"maxOffsetsPerTrigger": "5", "kafka.security.protocol": "SSL"}
    topic = configured_topic({"kafka": {**kafka, "options": options}})
    assert isinstance(topic, KafkaTopic)
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "orders_raw",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
        "maxRecordsPerPartition": "1000000",
        "kafka.security.protocol": "SSL",
    }
    assert topic.write_options() == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "orders_raw",
        "kafka.security.protocol": "SSL",
    }
    assert configured_topic({"kafka": {**kafka, "directory": "/x"}}) == DirectoryTopic("/x")


def test_table_schema_allows_null_only_for_the_time():
    nullable = {f.name for f in table_schema().fields if f.nullable}
    assert nullable == {"created_at"}
    assert table_schema("bigint")["order_id"].dataType.typeName() == "long"
