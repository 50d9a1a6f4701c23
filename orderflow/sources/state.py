"""The high-watermark, kept as text so that its microseconds survive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orderflow.operators.increment import Cursor
from orderflow.schema import EPOCH
from orderflow.sources.paths import load_if_any

SLOTS = ("slot_a", "slot_b")
# Beyond and before all ids of a moment.
LAST_ID, FIRST_ID = 2**63 - 1, -(2**63)


def _cursor(text: str) -> Cursor:
    """A cursor is stored as its moment and, after a blank and a #, its id."""
    moment, _, number = text.partition(" #")
    return Cursor(moment, int(number) if number else None)


def _place(text: str) -> tuple[datetime, bool, int]:
    """What orders stored watermarks and cursors; a moment without an id comes before its ids."""
    cursor = _cursor(text)
    return datetime.fromisoformat(cursor.moment), cursor.id is not None, cursor.id or 0


def _entries(spark: SparkSession, location: str) -> list[tuple[tuple, str, str]]:
    """Every stored watermark as (place, text, file): at most one per slot, plus any text file
    somebody put there to start from."""
    reader = (
        spark.read.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.txt")
    )
    stored = load_if_any(reader, location)
    if stored is None:
        return []
    lines = stored.select(
        F.trim("value").alias("text"), F.col("_metadata.file_path").alias("file")
    ).where(F.col("text") != "")
    return [(_place(r["text"]), r["text"], r["file"]) for r in lines.collect()]


def read_watermark(spark: SparkSession, location: str) -> str:
    """The newest stored watermark; the epoch when nothing, or only blank text, is stored."""
    entries = _entries(spark, location)
    newest = max(entries)[1] if entries else EPOCH
    if "#" in newest:
        raise ValueError(f"{location} holds a cursor within a moment, not a watermark: {newest}")
    return newest


def set_watermark(spark: SparkSession, location: str, moment: str) -> None:
    """Start again from a moment, also an earlier one; both slots get it."""
    datetime.fromisoformat(moment)
    for slot in SLOTS:
        _write(spark, f"{location}/{slot}", moment)
    if read_watermark(spark, location) != moment:
        raise ValueError(f"another file in {location} holds a later moment; remove it first")


def _write(spark: SparkSession, path: str, moment: str) -> None:
    line = spark.range(0, 1, 1, 1).select(F.lit(moment).alias("value"))
    line.write.mode("overwrite").text(path)


def save_watermark(spark: SparkSession, location: str, hi: str) -> None:
    """Overwrite the slot that does not hold the newest watermark.

    Overwriting deletes before it writes. With two slots a crash in between leaves the other
    one, and the next poll repeats a slice instead of the whole table. The state stays at two
    files however long the poller runs.
    """
    entries = _entries(spark, location)
    newest_file = max(entries)[2] if entries else ""
    slot = SLOTS[1] if f"/{SLOTS[0]}/" in newest_file else SLOTS[0]
    _write(spark, f"{location}/{slot}", hi)


def read_cursor(spark: SparkSession, location: str) -> Cursor:
    """The newest stored cursor. A watermark stored without an id stands for all of its moment's
    rows, as the poll that left it took them all."""
    entries = _entries(spark, location)
    if not entries:
        return Cursor()
    cursor = _cursor(max(entries)[1])
    return cursor if cursor.id is not None or cursor.moment == EPOCH else Cursor(cursor.moment, LAST_ID)


def save_cursor(spark: SparkSession, location: str, cursor: Cursor) -> None:
    save_watermark(spark, location, f"{cursor.moment} #{FIRST_ID if cursor.id is None else cursor.id}")
