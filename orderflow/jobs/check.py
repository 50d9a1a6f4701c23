"""Compare table and lake after a wave: spark-submit orderflow/jobs/check.py --config F

Exits with status 1 when a polled order is missing in the lake, or the lake holds one it should
not hold or holds it more than once.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.config import load_config
from orderflow.operators.events import clean, decode, encode
from orderflow.operators.quality import reconcile
from orderflow.operators.reports import orders_per_date, require_orders
from orderflow.schema import DEFAULT_ID_TYPE, EPOCH
from orderflow.session import job_session
from orderflow.sources.lake import data_files, read_lake
from orderflow.sources.state import read_watermark
from orderflow.sources.table import jdbc_table


def reports(spark: SparkSession, config: dict) -> dict[str, DataFrame]:
    """What there is to see, by title; the differences come last and are empty if all is well."""
    table, lake_config = jdbc_table(spark, config), config["datalake"]
    id_type = config["streaming"].get("id_type", DEFAULT_ID_TYPE)
    require_orders(table.total_orders())
    hi = read_watermark(spark, config["streaming"]["last_processed_timestamp_location"])
    lake = read_lake(spark, lake_config["path"], lake_config["format"], id_type)

    # Only what was polled can have arrived. Wire and cleaning decide what should have.
    polled = table.slice(EPOCH, table.reach_to(hi))
    expected = clean(decode(encode(polled), id_type))
    differences = reconcile(expected, lake).where(
        (F.col("missing") > 0) | (F.col("unexpected") > 0) | (F.col("repeated") > 0)
    )
    return {
        "orders in the table": table.total_orders(),
        "orders without a time, which no poll sees": table.never_polled(),
        "newest orders": table.latest_orders(3).drop("created_at"),
        "last processed timestamp": spark.range(1).select(F.lit(hi).alias("hi")),
        "lake, per day": orders_per_date(lake).orderBy("date"),
        "lake, data files": data_files(spark, lake_config["path"], lake_config["format"]),
        # One row per day that differs; shown and tested, so kept.
        "differences": differences.orderBy("date").persist(),
    }


def print_all(frame: DataFrame) -> None:
    """Every row, a partition at a time."""
    print(" | ".join(frame.columns))
    for row in frame.toLocalIterator():
        print(" | ".join("" if value is None else str(value) for value in row))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    config = load_config(parser.parse_args(argv).config)
    spark = job_session("orderflow-check")
    try:
        found = reports(spark, config)
        for title, frame in found.items():
            print(title)
            print_all(frame)
        days = found["differences"].count()
        print(f"days that differ: {days}")
        return 1 if days else 0
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
