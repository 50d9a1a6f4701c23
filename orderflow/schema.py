"""The order record, defined once for the table, the wire and the lake."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every producer and consumer of these events has to agree on them.
ORDER_COLS = [
    "order_id",
    "customer_name",
    "restaurant_name",
    "item",
    "amount",
    "order_status",
    "created_at",
]
REQUIRED_COLS = ["customer_name", "restaurant_name", "item", "amount", "order_status"]
STATUSES = ["PLACED", "PREPARING", "DELIVERED", "CANCELLED"]
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EPOCH = "1970-01-01 00:00:00"

# The wire contract's id is a 32-bit integer. A table whose ids outgrow it (BIGSERIAL) passes
# "bigint" wherever an id_type is asked for; with "int" a larger id would decode to null.
DEFAULT_ID_TYPE = "int"
ID_TYPES = {"int": T.IntegerType(), "bigint": T.LongType()}
LARGEST_ID = {"int": 2**31 - 1, "bigint": 2**63 - 1}

# A day as a number, with one that no date has for orders without a date: they match each other by
# plain equality.
NO_DAY = -(2**31)


def day_number(date: Column) -> Column:
    return F.coalesce(F.unix_date(date), F.lit(NO_DAY))


def table_schema(id_type: str = DEFAULT_ID_TYPE) -> T.StructType:
    """The source table; only created_at may be null."""
    return (
        T.StructType()
        .add("order_id", ID_TYPES[id_type], False)
        .add("customer_name", T.StringType(), False)
        .add("restaurant_name", T.StringType(), False)
        .add("item", T.StringType(), False)
        .add("amount", T.DecimalType(10, 2), False)
        .add("order_status", T.StringType(), False)
        .add("created_at", T.TimestampNTZType(), True)
    )


def schema_differences(found: T.StructType, id_type: str = DEFAULT_ID_TYPE) -> list[str]:
    """Columns whose type is not the source table's, one line each."""
    wanted = table_schema(id_type)
    return [
        f"{field.name}: {found[field.name].dataType.simpleString()}, "
        f"expected {field.dataType.simpleString()}"
        for field in wanted
        if found[field.name].dataType != field.dataType
    ]


def wire_schema(id_type: str = DEFAULT_ID_TYPE) -> T.StructType:
    """One JSON event. from_json ignores not-null flags, so everything is nullable here."""
    return (
        T.StructType()
        .add("order_id", ID_TYPES[id_type])
        .add("customer_name", T.StringType())
        .add("restaurant_name", T.StringType())
        .add("item", T.StringType())
        .add("amount", T.DoubleType())
        .add("order_status", T.StringType())
        .add("created_at", T.StringType())
    )


def lake_schema(id_type: str = DEFAULT_ID_TYPE) -> T.StructType:
    """A cleaned event plus its parsed time and the partition column."""
    return (
        wire_schema(id_type)
        .add("created_at_timestamp", T.TimestampType())
        .add("date", T.DateType())
    )
