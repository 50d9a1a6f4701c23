"""Encode, decode and clean order events. Every step works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions import (
    event_json,
    is_clean,
    parse_wire_time,
    parsed_event,
    reject_reason,
)
from orderflow.schema import DEFAULT_ID_TYPE


def encode(orders: DataFrame) -> DataFrame:
    """Order rows to one JSON text per row, in the column a topic calls value."""
    return orders.select(event_json().alias("value"))


def decode(raw: DataFrame, id_type: str = DEFAULT_ID_TYPE, keep_text: bool = False) -> DataFrame:
    """Topic values to the seven event columns, one row out per row in; on request the text too.

    inline() keeps the parse below a Generate node. Written as select("o.*"), the optimizer
    copies from_json into the cleaning filter and every text is parsed three times.
    """
    text = [F.col("value").cast("string").alias("value")] if keep_text else []
    return raw.select(*text, F.inline(F.array(parsed_event("value", id_type))))


def with_date(events: DataFrame) -> DataFrame:
    """Add the parsed time and the day the lake is partitioned by."""
    return events.withColumn(
        "created_at_timestamp", parse_wire_time("created_at")
    ).withColumn("date", F.to_date("created_at_timestamp"))


def clean(events: DataFrame) -> DataFrame:
    return with_date(events.where(is_clean()))


def rejects(events: DataFrame) -> DataFrame:
    """What clean() leaves out, with the reason; the two split the input without rest."""
    return events.withColumn("reason", reject_reason()).where(F.col("reason").isNotNull())


def observe_quality(events: DataFrame, name: str = "events") -> DataFrame:
    """Count accepted and rejected events while they pass, without another read.

    The counts come out in StreamingQueryProgress.observedMetrics, once per micro-batch.
    """
    reason = reject_reason()
    return events.observe(
        name,
        F.count(F.lit(1)).alias("seen"),
        F.count_if(reason.isNull()).alias("kept"),
        F.count_if(reason == "null_order_id").alias("null_order_id"),
        F.count_if(reason == "null_amount").alias("null_amount"),
        F.count_if(reason == "non_positive_amount").alias("non_positive_amount"),
    )
