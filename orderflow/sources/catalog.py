"""The order table as a catalog table: its column default and its rules, kept at insert."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schema import DEFAULT_ID_TYPE, ORDER_COLS, REQUIRED_COLS, STATUSES, table_schema


def create_orders(
    spark: SparkSession, name: str, location: str, id_type: str = DEFAULT_ID_TYPE, amount: str | None = None
) -> None:
    """Make the table unless it is there. created_at is the time of the insert where none is given;
    amount may be given another type than the definition's."""
    columns = []
    for field in table_schema(id_type):
        kind = amount if amount and field.name == "amount" else field.dataType.simpleString()
        rule = " DEFAULT localtimestamp()" if field.name == "created_at" else "" if field.nullable else " NOT NULL"
        columns.append(f"{field.name} {kind}{rule}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_checked(name)} ({', '.join(columns)}) USING parquet LOCATION '{location}'")


def broken_rule() -> Column:
    """The first of the table's rules that a row breaks, null when it keeps them all: an id and five
    columns that must be there, and a status out of four."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in ["order_id", *REQUIRED_COLS]]
    rules.append(F.when(~F.col("order_status").isin(STATUSES), F.lit("order_status is unknown")))
    return F.coalesce(*rules)


def refused(rows: DataFrame) -> DataFrame:
    """The rows that an insert would not take, with the rule they break."""
    return rows.withColumn("rule", broken_rule()).where(F.col("rule").isNotNull())


def insert_orders(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Insert rows of the table's columns. Without a created_at column they get the time of the
    statement, all the same one; a null in that column stays. A row that breaks a rule fails the
    statement, and nothing is inserted."""
    given = [c for c in ORDER_COLS if c in rows.columns]
    rule = broken_rule()
    # Raised while the rows are written, so that they are read once.
    failed = F.raise_error(F.concat(F.lit(f"row refused by {_checked(name)}: "), rule))
    kept = rows.select(*given).where(F.when(rule.isNull(), F.lit(True)).otherwise(failed.cast("boolean")))
    view = f"_rows_for_{name.replace('.', '_')}"
    kept.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {name} ({', '.join(given)}) SELECT {', '.join(given)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def _checked(name: str) -> str:
    if not re.fullmatch(r"\w+(\.\w+)*", name):
        raise ValueError(f"not a table name: {name!r}")
    return name
