import datetime

import pytest
from pyspark.sql import functions as F

from orderflow.operators.events import with_date
from orderflow.operators.reports import (
    distinct_dates,
    latest_orders,
    orders_by_id,
    orders_on,
    orders_per_date,
    require_orders,
    total_orders,
)
from orderflow.schema import lake_schema, wire_schema
from orderflow.sources.lake import NULL_DATE, append_by_date, data_files, read_lake
from tests.samples import ids, order


@pytest.fixture
def cleaned(spark):
    """(order_id, amount, created_at wire text) to cleaned orders."""

    def build(*rows):
        full = [(i, "c", "r", "x", float(a), "PLACED", t) for i, a, t in rows]
        return with_date(spark.createDataFrame(full, wire_schema()))

    return build


def day(n):
    return f"2025-11-{n:02d}T10:00:00Z"


def test_one_folder_per_day_without_the_day_in_the_file(spark, cleaned, folder, tmp_path):
    append_by_date(cleaned((1, 5, day(18)), (2, 6, day(19)), (3, 7, None)), folder("lake"))
    names = sorted(p.name for p in (tmp_path / "lake").iterdir() if p.is_dir())
    assert names == ["date=2025-11-18", "date=2025-11-19", f"date={NULL_DATE}"]
    one = next((tmp_path / "lake" / "date=2025-11-18").glob("*.parquet"))
    assert "date" not in spark.read.parquet(str(one)).columns


def test_appends_add_up_and_read_back_with_the_schema(spark, cleaned, folder):
    append_by_date(cleaned((1, 5, day(18))), folder("lake"))
    append_by_date(cleaned((2, 6, day(18)), (3, 7, None)), folder("lake"))
    lake = read_lake(spark, folder("lake"))
    assert ids(lake) == [1, 2, 3]
    assert lake.schema.fieldNames() == lake_schema().fieldNames()
    assert [f.dataType for f in lake.schema] == [f.dataType for f in lake_schema()]
    assert lake.where("order_id = 3").first()["date"] is None


def test_other_file_formats(spark, cleaned, folder):
    append_by_date(cleaned((1, 5, day(18)), (2, 6, day(19))), folder("lake"), "orc")
    assert ids(read_lake(spark, folder("lake"), "orc")) == [1, 2]
    assert data_files(spark, folder("lake"), "orc").first()["n_files"] == 2


def test_many_tasks_do_not_make_many_files(spark, cleaned, folder):
    rows = cleaned(*[(i, 1, day(1 + i % 10)) for i in range(400)]).repartition(32)
    append_by_date(rows, folder("lake"))
    assert data_files(spark, folder("lake")).first()["n_files"] == 10


def test_a_hot_day_is_written_by_several_tasks(spark, cleaned, folder, tmp_path):
    rows = cleaned(*[(i, 1, day(18) if i % 10 else day(19)) for i in range(20_000)]).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        append_by_date(rows, folder("lake"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "lake" / "date=2025-11-18").glob("*.parquet"))) > 1
    assert read_lake(spark, folder("lake")).count() == 20_000


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_one_day_prunes_folders_and_ids_prune_row_groups(spark, cleaned, folder):
    append_by_date(cleaned((1, 5, day(18)), (2, 6, day(19))), folder("lake"))
    lake = read_lake(spark, folder("lake"))
    one_day = orders_on(lake, "2025-11-18")
    assert ids(one_day) == [1]
    assert "PartitionFilters: [isnotnull(date" in plan(one_day)
    found = orders_by_id(lake, 2, 9)
    assert ids(found) == [2]
    assert "PushedFilters: [In(order_id, [2,9])]" in plan(found)
    assert "ReadSchema: struct<>" in plan(lake.agg(F.count("*")))


def test_reports(spark, cleaned):
    rows = cleaned((1, 0.1, day(18)), (2, 0.2, day(18)), (3, 7, None))
    found = {r["date"]: tuple(r)[1:] for r in orders_per_date(rows).collect()}
    assert found == {datetime.date(2025, 11, 18): (2, 0.3, 0), None: (1, 7.0, 0)}
    odd = cleaned(*[(i, float(a), day(18)) for i, a in enumerate(("nan", "inf", "1e17", "1e300", "5"))])
    assert [tuple(r)[1:] for r in orders_per_date(odd).collect()] == [(5, 5.0, 4)]
    assert {r["date"] for r in distinct_dates(rows).collect()} == set(found)
    assert total_orders(rows).first()["total_orders"] == 3


def test_newest_first_ties_by_id_and_no_missing_times(orders):
    table = orders(
        order(4, "2025-01-01 00:00:00"),
        order(3, "2025-01-02 00:00:00"),
        order(2, "2025-01-02 00:00:00"),
        order(1, None),
    )
    assert [r["order_id"] for r in latest_orders(table, 3).collect()] == [2, 3, 4]
    assert "TakeOrderedAndProject" in plan(latest_orders(table, 3))


def test_gate_on_the_number_of_orders(orders):
    table = orders(*[order(i) for i in range(10)])
    assert require_orders(total_orders(table)) == 10
    with pytest.raises(ValueError, match="found 10"):
        require_orders(total_orders(table), 11)
