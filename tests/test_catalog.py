"""The catalog table: its default and its rules."""

import uuid

import pytest

from orderflow.sources.catalog import create_orders, insert_orders, refused
from tests.samples import order


@pytest.fixture
def table(spark, folder):
    name = f"t_{uuid.uuid4().hex}"
    create_orders(spark, name, folder("table"), "bigint")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_missing_time_becomes_the_time_of_the_insert(spark, orders, table):
    rows = orders(order(1, "2025-01-01 00:00:00"), order(2, None))
    insert_orders(spark, table, rows)
    start = spark.sql("SELECT localtimestamp() AS t").first()["t"]
    insert_orders(spark, table, orders(order(3, "2020-01-01 00:00:00"), order(4)).drop("created_at"))
    found = {r["order_id"]: r["created_at"] for r in spark.table(table).collect()}
    assert str(found[1]) == "2025-01-01 00:00:00" and found[2] is None
    assert start <= found[3] == found[4]
    create_orders(spark, table, "/nowhere")  # it is there already
    assert spark.table(table).count() == 4


@pytest.mark.parametrize(
    "bad", [order(None), order(9, amount=None), order(9, status="LOST"), order(9, status=None), order(9, item=None)]
)
def test_a_row_that_breaks_a_rule_fails_the_insert(spark, orders, table, bad):
    with pytest.raises(Exception, match="row refused by"):
        insert_orders(spark, table, orders(order(1), bad))
    assert spark.table(table).count() == 0
    (row,) = refused(orders(order(1), bad)).collect()
    assert row["rule"].endswith(("is null", "is unknown"))


def test_names_are_checked(spark, folder):
    with pytest.raises(ValueError, match="not a table name"):
        create_orders(spark, "t; DROP TABLE x", folder("table"))
