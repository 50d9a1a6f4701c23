"""The relational table as a polled source.

A table answers two questions: how far does it reach beyond a watermark, and which rows lie in a
bounded slice. The upper end is fixed before any row is read, so a row inserted
while a poll runs is left to the next poll instead of being skipped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.increment import increment
from orderflow.schema import ORDER_COLS, schema_differences


@dataclass(frozen=True)
class Reach:
    """What one poll takes beyond a watermark: newest created_at as text, row count, id range,
    whether the table holds more behind it, and what a look back took on top."""

    hi: str | None
    rows: int
    min_id: int | None = None
    max_id: int | None = None
    more: bool = False
    back: Reach | None = None


class OrderTable(Protocol):
    """What the poller asks of a table."""

    def reach(self, lo: str) -> Reach: ...

    def extent(self, lo: str, hi: str) -> Reach: ...

    def slice(self, lo: str, reach: Reach) -> DataFrame: ...


class FrameTable:
    """Any DataFrame with the order columns; its filters reach a Parquet scan by themselves."""

    def __init__(self, orders: DataFrame):
        self.orders = orders

    def reach(self, lo: str) -> Reach:
        return self._extent(increment(self.orders, lo))

    def extent(self, lo: str, hi: str) -> Reach:
        return replace(self._extent(increment(self.orders, lo, hi)), hi=hi)

    def _extent(self, rows: DataFrame) -> Reach:
        found = rows.agg(
            F.max("created_at").cast("string"),
            F.count(F.lit(1)),
            F.min("order_id"),
            F.max("order_id"),
        )
        return Reach(*found.first())

    def slice(self, lo: str, reach: Reach) -> DataFrame:
        return increment(self.orders, lo, reach.hi)


@dataclass
class JdbcTable:
    """A database table. The database evaluates range and aggregate; Spark reads the slice in
    parallel over ranges of order_id, which is unique, so one busy instant cannot fill a range.

    A backlog of more than rows_per_poll rows is taken in several polls, each with a watermark
    of its own, so that a failure repeats one of them and not all.
    """

    spark: SparkSession
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    rows_per_poll: int = 20_000_000
    rows_per_read: int = 500_000
    max_connections: int = 16

    def __post_init__(self):
        if not re.fullmatch(r"\w+(\.\w+)*", self.table):
            raise ValueError(f"not a table name: {self.table!r}")
        # created_at has no zone; fetchsize keeps a driver from buffering its whole range.
        self.properties = {
            "preferTimestampNTZ": "true",
            "fetchsize": "10000",
            **self.properties,
        }

    def query(self, sql: str, **split) -> DataFrame:
        """What the database answers to a SELECT."""
        return self.spark.read.jdbc(self.url, f"({sql}) q", properties=self.properties, **split)

    def reach(self, lo: str) -> Reach:
        rows = f"FROM {self.table} WHERE created_at > '{_checked(lo)}'"
        # The row this far down the index on created_at ends the poll; its ties come along. The
        # rest of the backlog is neither read nor counted.
        last = (
            self.query(
                f"SELECT created_at AS hi {rows} ORDER BY created_at "
                f"OFFSET {self.rows_per_poll - 1} ROWS FETCH NEXT 1 ROWS ONLY"
            )
            .toDF("hi")
            .selectExpr("cast(hi AS string) AS hi")
            .first()
        )
        if last is None:
            return self._extent(rows)
        return replace(self._extent(f"{rows} AND created_at <= '{last['hi']}'"), more=True)

    def reach_to(self, hi: str) -> Reach:
        """Everything up to a watermark, however much it is."""
        rows = f"FROM {self.table} WHERE created_at <= '{_checked(hi)}'"
        return replace(self._extent(rows), hi=hi)

    def extent(self, lo: str, hi: str) -> Reach:
        """What lies in a slice, so that it is split by the rows really read."""
        rows = f"FROM {self.table} WHERE created_at > '{_checked(lo)}' AND created_at <= '{_checked(hi)}'"
        return replace(self._extent(rows), hi=hi)

    def differences(self, id_type: str) -> list[str]:
        """Where the table's definition differs from the one this job is made for."""
        nothing = f"SELECT {', '.join(ORDER_COLS)} FROM {self.table} WHERE 1 = 0"
        return schema_differences(self.query(nothing).toDF(*ORDER_COLS).schema, id_type)

    def _extent(self, rows: str) -> Reach:
        return Reach(
            *self.query(
                "SELECT MAX(created_at) AS hi, COUNT(*) AS n, MIN(order_id) AS min_id, "
                f"MAX(order_id) AS max_id {rows}"
            )
            .toDF("hi", "n", "min_id", "max_id")
            .selectExpr("cast(hi AS string) AS hi", "n", "min_id", "max_id")
            .first()
        )

    def slice(self, lo: str, reach: Reach) -> DataFrame:
        reads = min(self.max_connections, 1 + reach.rows // self.rows_per_read)
        # The id bounds only place the cuts between the reads; rows outside them, committed
        # since, still fall into the first or last read.
        split = {} if reads == 1 else {
            "column": "order_id",
            "lowerBound": reach.min_id,
            "upperBound": reach.max_id + 1,
            "numPartitions": reads,
        }
        return self.query(
            f"SELECT {', '.join(ORDER_COLS)} FROM {self.table} "
            f"WHERE created_at > '{_checked(lo)}' AND created_at <= '{_checked(reach.hi)}'",
            **split,
        ).toDF(*ORDER_COLS)

    def total_orders(self) -> DataFrame:
        return self.query(f"SELECT COUNT(*) AS n FROM {self.table}").toDF("total_orders")

    def never_polled(self) -> DataFrame:
        return self.query(
            f"SELECT COUNT(*) AS n FROM {self.table} WHERE created_at IS NULL"
        ).toDF("never_polled")

    def latest_orders(self, k: int = 5) -> DataFrame:
        """The k newest orders, from the database's index on created_at if it has one."""
        return self.query(
            f"SELECT {', '.join(ORDER_COLS)} FROM {self.table} WHERE created_at IS NOT NULL "
            f"ORDER BY created_at DESC, order_id FETCH FIRST {int(k)} ROWS ONLY"
        ).toDF(*ORDER_COLS)


def _checked(moment: str) -> str:
    """Watermarks end up inside SQL text, so only a timestamp may pass."""
    datetime.fromisoformat(moment)
    return moment


def jdbc_table(spark: SparkSession, config: dict) -> JdbcTable:
    db = config["postgres"]
    return JdbcTable(
        spark,
        db["jdbc_url"],
        db["table"],
        {
            "user": db["user"],
            "password": db["password"],
            "driver": db.get("driver", "org.postgresql.Driver"),
        },
        **{k: db[k] for k in ("rows_per_poll", "rows_per_read", "max_connections") if k in db},
    )
