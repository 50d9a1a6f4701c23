"""The given tables seen as order tables. Every row of the table becomes one order."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.increment import increment
from orderflow.sources.table import FrameTable, Reach

# The given ids are 64-bit.
ID_TYPE = "bigint"

# events has no dirty rows, so the mapping plants some at fixed places: null ids, null names,
# null, zero, negative, huge and infinite amounts, an unknown status and missing times. It alters values and
# leaves no row out. Spark and the check read the same text.
EVENT_ORDERS = {
    "order_id": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id END",
    "customer_name": "'user_' || CAST(user_id AS STRING)",
    "restaurant_name": (
        "CASE WHEN event_id % 13 = 0 THEN NULL "
        "ELSE 'rest_' || CAST(user_id % 10 AS STRING) END"
    ),
    "item": "event_type",
    "amount": (
        "CASE WHEN event_id % 11 = 0 THEN -value WHEN event_id % 19 = 0 THEN CAST(0 AS DOUBLE) "
        "WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN CAST('1e17' AS DOUBLE) "
        "WHEN event_id % 37 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value END"
    ),
    "order_status": (
        "CASE event_type WHEN 'view' THEN 'PLACED' WHEN 'click' THEN 'PREPARING' "
        "WHEN 'purchase' THEN 'DELIVERED' WHEN 'signup' THEN 'CANCELLED' ELSE 'INVALID' END"
    ),
    "created_at": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE ts END",
}

# orders as it is: whole days only, so many rows share one created_at.
SHOP_ORDERS = {
    "order_id": "o_orderkey",
    "customer_name": "'customer_' || CAST(o_custkey AS STRING)",
    "restaurant_name": "o_orderpriority",
    "item": "o_orderpriority",
    "amount": "o_totalprice",
    "order_status": (
        "CASE o_orderstatus WHEN 'O' THEN 'PLACED' WHEN 'P' THEN 'PREPARING' "
        "WHEN 'F' THEN 'DELIVERED' ELSE o_orderstatus END"
    ),
    "created_at": "o_orderdate",
}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def event_orders(
    spark: SparkSession, sf_dir: str, after: str | None = None, until: str | None = None
) -> DataFrame:
    """The order view of events; with bounds, a superset of the orders created within them.

    created_at is ts or null, so its bounds hold for ts as well. A filter on created_at cannot
    pass its CASE expression, one on ts reaches the Parquet scan.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if after is not None:
        events = events.where(F.col("ts") > F.lit(after).cast("timestamp_ntz"))
    if until is not None:
        events = events.where(F.col("ts") <= F.lit(until).cast("timestamp_ntz"))
    return events.selectExpr(*_select(EVENT_ORDERS))


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(*_select(SHOP_ORDERS))


class EventTable:
    """The order view of events as a polled table, as far as it has grown at some moment."""

    def __init__(self, spark: SparkSession, sf_dir: str, grown_to: str | None = None):
        self._view = partial(event_orders, spark, sf_dir)
        self.grown_to = grown_to

    def reach(self, lo: str) -> Reach:
        orders = increment(self._view(lo, self.grown_to), lo, self.grown_to)
        return FrameTable(orders).reach(lo)

    def extent(self, lo: str, hi: str) -> Reach:
        return FrameTable(increment(self._view(lo, hi), lo, hi)).extent(lo, hi)

    def slice(self, lo: str, reach: Reach) -> DataFrame:
        return increment(self._view(lo, reach.hi), lo, reach.hi)


def view_sql(table: str, columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(_select(columns))} FROM {table}"
