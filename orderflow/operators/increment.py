"""The bounded increment behind every poll: created_at in (lo, hi], or a cursor's next stretch."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.schema import EPOCH, ORDER_COLS


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def increment(orders: DataFrame, lo: str = EPOCH, hi: str | None = None) -> DataFrame:
    """Rows created after lo and, when given, not after hi.

    The lower end is open, so a row without created_at is never part of an increment.
    """
    rows = orders.where(F.col("created_at") > _moment(lo))
    if hi is not None:
        rows = rows.where(F.col("created_at") <= _moment(hi))
    return rows.select(*ORDER_COLS)


def high_watermark(orders: DataFrame, lo: str = EPOCH) -> DataFrame:
    """One row: the newest created_at after lo (null when there is none) and the row count."""
    return increment(orders, lo).agg(
        F.max("created_at").alias("hi"), F.count(F.lit(1)).alias("n")
    )


class Cursor(NamedTuple):
    """How far a poller has come in the order of (created_at, order_id), also within a tie. A row
    without an id comes before the others of its moment."""

    moment: str = EPOCH
    id: int | None = None


def beyond(orders: DataFrame, lo: Cursor, hi: Cursor | None = None) -> DataFrame:
    """Rows after the cursor lo and, when given, not after hi.

    Each bound is a range on created_at, which a scan or a database can skip by, and a tie branch
    that only rows of that very moment need. The start of a table is the open EPOCH.
    """
    at = F.col("created_at")
    known = F.col("order_id").isNotNull() if lo.id is None else F.col("order_id") > lo.id
    if lo == Cursor():
        rows = orders.where(at > _moment(lo.moment))
    else:
        rows = orders.where((at >= _moment(lo.moment)) & ((at > _moment(lo.moment)) | known))
    if hi is not None:
        upto = F.col("order_id").isNull() | (F.col("order_id") <= F.lit(hi.id))
        rows = rows.where((at <= _moment(hi.moment)) & ((at < _moment(hi.moment)) | upto))
    return rows.select(*ORDER_COLS)


# Parts that rows are counted in at a time, and how many rows may meet on the driver.
PART_BITS = 10
FEW = 10_000


def _micros(at: Column) -> Column:
    """Microseconds since EPOCH by the calendar, whatever the session's zone does in between."""
    since = at.cast("timestamp_ntz") - _moment(EPOCH)
    return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long")


def _narrowed(rows: DataFrame, name: str, number: Column, nth: int) -> tuple[DataFrame, int, bool]:
    """The rows around the nth by a column, null first: FEW at most, or all rows of one value. Also
    its place among them, and whether they are few.

    number is the column as a long. Its range is cut into parts, in which rows are counted, then the
    part that holds the nth is cut again. The driver gets a count for each part and no rows.
    """
    at, shift = F.col(name), 64 - PART_BITS
    while True:
        parts = rows.groupBy(F.shiftright(number, shift).alias("part")).agg(
            F.count(F.lit(1)).alias("n"),
            F.min(number).alias("lo"),
            F.max(number).alias("hi"),
            F.min(at).cast("string").alias("first"),
            F.max(at).cast("string").alias("last"),
        )
        for part in sorted(parts.collect(), key=lambda p: (p["part"] is not None, p["part"])):
            if nth <= part["n"]:
                break
            nth -= part["n"]
        else:
            return rows.limit(0), 1, True
        lo, hi = part["lo"], part["hi"]
        if lo is None:
            rows = rows.where(at.isNull())
        else:
            kind = rows.schema[name].dataType
            rows = rows.where(at.between(F.lit(part["first"]).cast(kind), F.lit(part["last"]).cast(kind)))
        if part["n"] <= FEW or lo == hi:
            return rows, nth, part["n"] <= FEW
        shift = next(s for s in range(64) if (hi >> s) - (lo >> s) < 1 << PART_BITS)


def cursor_after(orders: DataFrame, lo: Cursor, rows: int) -> Cursor | None:
    """The cursor of the last of the next rows after lo, or of the last there is; None when
    there is nothing.

    However many rows a poll takes, FEW of them are ordered at most: those around the last one.
    """
    ahead = beyond(orders, lo).select("created_at", "order_id")
    newest = ahead.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("created_at", "order_id")).alias("m"))
    n, *last = newest.select("n", F.col("m.created_at").cast("string"), "m.order_id").first()
    if n <= rows:
        return Cursor(*last) if n else None
    nth = rows
    for name, number in (("created_at", _micros(F.col("created_at"))), ("order_id", F.col("order_id").cast("long"))):
        ahead, nth, few = _narrowed(ahead, name, number, nth)
        if few:
            break
    else:
        nth = 1  # All that are left are of one moment and id.
    found = in_order(ahead).offset(nth - 1).limit(1).select(F.col("created_at").cast("string"), "order_id").first()
    return Cursor(*(found or last))


def in_order(rows: DataFrame) -> DataFrame:
    """Oldest first. order_id breaks ties, so one busy instant still spreads over many tasks."""
    return rows.orderBy("created_at", "order_id")


def write_in_order(rows: DataFrame, folder: str) -> None:
    """Files that each hold a range of (created_at, order_id), sorted within."""
    in_order(rows).write.parquet(folder)


def file_ranges(rows: DataFrame) -> DataFrame:
    """For each file behind rows: file, n, lo and hi (created_at, order_id), out_of_order (rows
    whose predecessor in the file comes later) and overlaps (whether the file before, by lo,
    reaches beyond lo).

    One row for each file is windowed, never the rows of the whole table.
    """
    key = F.struct("created_at", "order_id")
    placed = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag(key).over(Window.partitionBy("file").orderBy("at"))
    files = (
        placed.select("file", key.alias("key"), before.alias("before"))
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("key").alias("lo"),
            F.max("key").alias("hi"),
            F.count_if(F.col("before") > F.col("key")).alias("out_of_order"),
        )
    )
    reach = F.max("hi").over(Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("overlaps", F.coalesce(reach > F.col("lo"), F.lit(False)))


def order_facts(rows: DataFrame) -> DataFrame:
    """One row: what the files behind rows show of their order. n, first and last, and how many
    rows and files are out of order."""
    return file_ranges(rows).agg(
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum("out_of_order").alias("rows_out_of_order"),
        F.count_if("overlaps").alias("files_that_overlap"),
    ).select(
        "n", F.col("lo.created_at").alias("first_at"), F.col("lo.order_id").alias("first_id"),
        F.col("hi.created_at").alias("last_at"), F.col("hi.order_id").alias("last_id"),
        "rows_out_of_order", "files_that_overlap",
    )


def with_position(rows: DataFrame) -> DataFrame:
    """Rows read from files in order, with a gap-free position from 1: the place in the file plus
    the rows of the files before. No window runs over the rows."""
    files = file_ranges(rows)
    before = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    placed = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_at"))
    return placed.join(starts, "file").select(*rows.columns, (F.col("_before") + F.col("_at") + 1).alias("pos"))
