"""Column expressions of the order event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.schema import DEFAULT_ID_TYPE, WIRE_TIME, wire_schema


def wire_time(ts: Column | str) -> Column:
    """Timestamp to wire text; seconds are truncated, null stays null."""
    return F.date_format(ts, WIRE_TIME)


def parse_wire_time(text: Column | str) -> Column:
    """Wire text to timestamp; anything else gives null (to_timestamp would stop the stream)."""
    return F.try_to_timestamp(text, F.lit(WIRE_TIME))


def event_json() -> Column:
    """The seven order columns as one JSON object with every key present, nulls included.

    Ids are widened, never narrowed: a narrowing cast would throw on the first large id.
    """
    fields = F.struct(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_name").cast("string").alias("customer_name"),
        F.col("restaurant_name").cast("string").alias("restaurant_name"),
        F.col("item").cast("string").alias("item"),
        F.col("amount").cast("double").alias("amount"),
        F.col("order_status").cast("string").alias("order_status"),
        wire_time("created_at").alias("created_at"),
    )
    return F.to_json(fields, {"ignoreNullFields": "false"})


def parsed_event(value: Column | str, id_type: str = DEFAULT_ID_TYPE) -> Column:
    """Topic value (binary or text) to an order struct; a bad field, or a bad text, gives nulls."""
    text = F.col(value) if isinstance(value, str) else value
    return F.from_json(text.cast("string"), wire_schema(id_type))


def is_clean() -> Column:
    """The cleaning rule: an id, and an amount above zero (NaN counts as above zero)."""
    return F.col("order_id").isNotNull() & (F.col("amount") > 0)


def reject_reason() -> Column:
    """Why an event fails the cleaning rule, null when it passes; the first match wins."""
    return (
        F.when(F.col("order_id").isNull(), "null_order_id")
        .when(F.col("amount").isNull(), "null_amount")
        .when(~(F.col("amount") > 0), "non_positive_amount")
    )
