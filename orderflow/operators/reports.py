"""The reports run on the table and on the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_orders(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count(F.lit(1)).alias("total_orders"))


def gate(total: DataFrame, *at_least: int) -> DataFrame:
    """total_orders against each of the limits: at_least, total_orders, passed."""
    limits = F.explode(F.array(*[F.lit(n).cast("bigint") for n in at_least]))
    rows = total.withColumn("at_least", limits)
    return rows.select("at_least", "total_orders", (F.col("total_orders") >= F.col("at_least")).alias("passed"))


def require_orders(total: DataFrame, at_least: int = 10) -> int:
    """The start-up gate: fail unless total_orders found enough rows."""
    found = gate(total, at_least).first()
    if not found["passed"]:
        raise ValueError(f"expected at least {at_least} orders, found {found['total_orders']}")
    return found["total_orders"]


def orders_per_date(lake: DataFrame) -> DataFrame:
    """Rows and revenue per day; a decimal sum does not depend on the order of addition.

    The cleaning keeps amounts that are no sums of money: not a number, infinite, or of more than
    16 digits. They are left out of amt and counted in n_left_out.
    """
    money = F.col("amount").try_cast("decimal(18,2)")
    return lake.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"),
        F.try_sum(money).cast("double").alias("amt"),
        F.count_if(money.isNull()).alias("n_left_out"),
    )


def distinct_dates(lake: DataFrame) -> DataFrame:
    return lake.select("date").distinct()


def latest_orders(orders: DataFrame, k: int = 5) -> DataFrame:
    """The k newest orders; each task keeps k rows, so nothing is sorted as a whole."""
    return (
        orders.where(F.col("created_at").isNotNull())
        .orderBy(F.desc("created_at"), F.asc("order_id"))
        .limit(k)
    )


def orders_by_id(orders: DataFrame, *ids: int) -> DataFrame:
    return orders.where(F.col("order_id").isin(*ids))


def orders_on(lake: DataFrame, day: str) -> DataFrame:
    """One day of the lake; reads that partition's files only."""
    return lake.where(F.col("date") == F.lit(day).cast("date"))
