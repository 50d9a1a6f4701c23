import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow.operators import increment as increments
from orderflow.operators.increment import (
    Cursor,
    beyond,
    cursor_after,
    file_ranges,
    high_watermark,
    in_order,
    increment,
    order_facts,
    with_position,
    write_in_order,
)
from orderflow.schema import EPOCH
from orderflow.sources.state import read_cursor, read_watermark, save_cursor, save_watermark
from tests.samples import ids, order


def test_lower_end_is_open_and_upper_end_closed(orders):
    table = orders(
        order(1, "2025-01-01 00:00:00"),
        order(2, "2025-01-01 00:00:00.000001"),
        order(3, "2025-01-02 00:00:00"),
        order(4, "2025-01-02 00:00:00.000001"),
    )
    assert ids(increment(table, "2025-01-01 00:00:00", "2025-01-02 00:00:00")) == [2, 3]


def test_rows_without_a_time_are_never_polled(orders):
    table = orders(order(1, None), order(2))
    assert ids(increment(table)) == [2]


def test_high_watermark_counts_and_keeps_microseconds(orders):
    table = orders(order(1, "2025-01-01 00:00:00"), order(2, "2025-01-02 03:04:05.000006"))
    row = high_watermark(table).first()
    assert row["hi"] == datetime.datetime(2025, 1, 2, 3, 4, 5, 6)
    assert row["n"] == 2
    nothing = high_watermark(table, "2025-01-02 03:04:05.000006").first()
    assert (nothing["hi"], nothing["n"]) == (None, 0)


def test_order_and_positions(spark, orders, folder):
    day = "2025-03-01 00:00:00"
    table = orders(*[order(i, day) for i in range(400, 0, -1)], order(0, "2025-02-28 00:00:00"))
    table = table.repartition(16)
    expected = list(range(401))
    assert [r["order_id"] for r in in_order(table).collect()] == expected
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_in_order(table, folder("sorted"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(folder("sorted"))
    placed = with_position(stored)
    assert placed.columns == [*table.columns, "pos"]
    assert {r["order_id"]: r["pos"] for r in placed.collect()} == {i: i + 1 for i in expected}
    # One moment holds nearly all rows, and still the sort used several tasks.
    assert file_ranges(stored).count() > 1
    facts = order_facts(stored).first()
    assert (facts["n"], facts["first_id"], facts["last_id"]) == (401, 0, 400)
    assert (facts["rows_out_of_order"], facts["files_that_overlap"]) == (0, 0)


def test_facts_show_what_is_out_of_order(spark, orders, folder):
    rows = [order(i, f"2025-03-01 00:00:{i:02d}") for i in (5, 1, 3, 2)]
    orders(*rows).coalesce(1).write.parquet(folder("one"))
    orders(order(4, "2025-03-01 00:00:04")).coalesce(1).write.mode("append").parquet(folder("one"))
    facts = order_facts(spark.read.parquet(folder("one"))).first()
    assert (facts["n"], facts["rows_out_of_order"], facts["files_that_overlap"]) == (5, 2, 1)


cursors = st.lists(st.tuples(st.integers(0, 3), st.none() | st.integers(0, 20)), max_size=25)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(cursors, st.integers(1, 6))
def test_polls_by_cursor_take_each_row_once(spark, orders, rows, size):
    """Rows of few moments, some without an id: whatever the size of a poll, it ends within ties."""
    table = orders(*[order(i, f"2025-01-01 00:00:0{m}.5") for m, i in rows], order(99, None))
    table = table.persist()
    lo, found = Cursor(), []
    while (hi := cursor_after(table, lo, size)) is not None:
        taken = [(r["created_at"], r["order_id"]) for r in beyond(table, lo, hi).collect()]
        assert taken and hi != lo
        found += sorted(taken, key=lambda r: (r[0], r[1] is not None, r[1]))
        lo = hi
    wanted = table.where("created_at IS NOT NULL").orderBy("created_at", "order_id")
    assert found == [(r["created_at"], r["order_id"]) for r in wanted.collect()]
    table.unpersist()


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.tuples(st.sampled_from([0, 1, 3601, 10**9]), st.none() | st.sampled_from([-(2**63), -1, 0, 7, 2**63 - 1])), min_size=1, max_size=25),
    st.integers(1, 9),
)
def test_a_cursor_among_more_rows_than_may_be_ordered(spark, orders, monkeypatch, rows, size):
    """Rows far apart and rows that are equal, ids at both ends of the range."""
    monkeypatch.setattr(increments, "FEW", 2)
    monkeypatch.setattr(increments, "PART_BITS", 2)
    start = datetime.datetime(2025, 3, 9, 2, 30)
    table = orders(*[order(i, str(start + datetime.timedelta(seconds=m, microseconds=m % 7))) for m, i in rows]).persist()
    found = cursor_after(table, Cursor(), size)
    wanted = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1]))[min(size, len(rows)) - 1]
    moment = datetime.datetime.fromisoformat(found.moment) - start
    assert (moment, found.id) == (datetime.timedelta(seconds=wanted[0], microseconds=wanted[0] % 7), wanted[1])
    table.unpersist()


def test_a_cursor_sends_counts_to_the_driver(spark, orders):
    """The rows of a poll are counted, not ordered there, however many they are."""
    table = spark.range(60_000).select(
        F.col("id").alias("order_id"),
        *[F.lit("x").alias(c) for c in ("customer_name", "restaurant_name", "item", "order_status")],
        F.lit(1.0).alias("amount"),
        F.timestamp_seconds(F.col("id") % 3 + 1).cast("timestamp_ntz").alias("created_at"),
    )
    ordered = []
    in_order = increments.in_order

    def noting(rows):
        ordered.append(rows.count())
        return in_order(rows)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(increments, "in_order", noting)
        found = cursor_after(table, Cursor(), 50_000)
    # Ids 2, 5, 8, ... are the last of the three moments, and the first 40,000 rows are before them.
    assert found == Cursor("1970-01-01 00:00:03", 2 + 3 * 9_999)
    assert ordered and max(ordered) <= increments.FEW


def test_a_cursor_reaches_the_scan_as_a_range(spark, orders, folder):
    orders(order(1), order(2)).write.parquet(folder("table"))
    rows = beyond(spark.read.parquet(folder("table")), Cursor("2025-01-01 00:00:00", 5), Cursor("2025-02-01 00:00:00", 7))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    shown = rows._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(created_at,2025-01-01T00:00)" in shown
    assert "LessThanOrEqual(created_at,2025-02-01T00:00)" in shown


def test_cursor_state(spark, folder):
    assert read_cursor(spark, folder("state")) == Cursor()
    for cursor in (Cursor("2025-01-01 00:00:00.25", -7), Cursor("2025-01-01 00:00:00.25", 12), Cursor("2025-01-02 00:00:00", 3)):
        save_cursor(spark, folder("state"), cursor)
        assert read_cursor(spark, folder("state")) == cursor
    with pytest.raises(ValueError, match="cursor"):
        read_watermark(spark, folder("state"))
    # A watermark is taken over: all rows of its moment have been polled.
    save_watermark(spark, folder("plain"), "2025-01-01 00:00:00")
    assert read_cursor(spark, folder("plain")) == Cursor("2025-01-01 00:00:00", 2**63 - 1)


moments = st.lists(
    st.none() | st.integers(0, 40).map(lambda m: f"2025-01-01 00:{m:02d}:00"), max_size=30
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(moments, st.lists(st.integers(0, 41), max_size=4))
def test_slices_cover_the_source_without_gap_or_overlap(orders, times, cuts):
    table = orders(*[order(i, t) for i, t in enumerate(times)])
    ends = [EPOCH, *[f"2025-01-01 00:{c:02d}:30" for c in sorted(set(cuts))], None]
    found = [i for lo, hi in zip(ends, ends[1:]) for i in ids(increment(table, lo, hi))]
    assert sorted(found) == [i for i, t in enumerate(times) if t is not None]


def test_missing_state_is_the_epoch(spark, folder):
    assert read_watermark(spark, folder("state")) == EPOCH


def test_blank_state_is_the_epoch(spark, folder, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "start.txt").write_text(" \n")
    assert read_watermark(spark, folder("state")) == EPOCH


def test_state_moves_on_and_stays_small(spark, folder, tmp_path):
    for second in range(5):
        hi = f"2025-11-18 12:24:0{second}.294904"
        save_watermark(spark, folder("state"), hi)
        assert read_watermark(spark, folder("state")) == hi
    assert len(list((tmp_path / "state").rglob("*.txt"))) == 2


def test_losing_the_slot_being_written_falls_back_to_the_one_before(spark, folder, tmp_path):
    save_watermark(spark, folder("state"), "2025-01-01 00:00:00")
    save_watermark(spark, folder("state"), "2025-01-02 00:00:00")
    save_watermark(spark, folder("state"), "2025-01-03 00:00:00")
    newest = max((tmp_path / "state").rglob("part-*.txt"), key=lambda p: p.read_text())
    newest.write_text("")  # as after a crash between delete and write
    assert read_watermark(spark, folder("state")) == "2025-01-02 00:00:00"


def test_a_single_timestamp_file_is_taken_over(spark, folder, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "start.txt").write_text("2025-12-03 16:16:04.294904")
    assert read_watermark(spark, folder("state")) == "2025-12-03 16:16:04.294904"
    save_watermark(spark, folder("state"), "2025-12-04 00:00:00")
    assert read_watermark(spark, folder("state")) == "2025-12-04 00:00:00"


def test_unreadable_state_stops_instead_of_starting_over(spark, folder, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "start.txt").write_text("soon")
    with pytest.raises(ValueError):
        read_watermark(spark, folder("state"))
