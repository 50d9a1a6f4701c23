"""Checks of the source table's rules, and of the lake against the source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.schema import NO_DAY, REQUIRED_COLS, STATUSES, day_number


def status_violations(orders: DataFrame) -> DataFrame:
    """Statuses outside the allowed four, with their row counts."""
    return (
        orders.where(~F.col("order_status").isin(STATUSES))
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def null_violations(orders: DataFrame) -> DataFrame:
    """One row: nulls per column that must not be null."""
    return orders.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED_COLS])


def never_polled(orders: DataFrame) -> DataFrame:
    """One row: how many orders no poll can see because they carry no created_at."""
    return orders.agg(F.count_if(F.col("created_at").isNull()).alias("never_polled"))


# Ids of one range meet in one node of the tree of checksums.
RANGE_BITS = 12


def _checksums(frame: DataFrame, side: str, *nodes: str) -> DataFrame:
    """Count and checksums of order_id for each node, in any order of rows. A row counts as often as
    it is there, so copies show."""
    key = F.xxhash64("order_id", "_day")
    return frame.groupBy(*nodes).agg(
        F.count(F.lit(1)).alias(f"n_{side}"),
        F.sum(key.cast("decimal(38,0)")).alias(f"sum_{side}"),
        F.bit_xor(key).alias(f"xor_{side}"),
    )


def _compared(source: DataFrame, lake: DataFrame, *nodes: str) -> DataFrame:
    """nodes, n_source, n_lake and same: whether the checksums of both sides agree."""
    both = _checksums(source, "source", *nodes).join(_checksums(lake, "lake", *nodes), list(nodes), "full")
    same = [F.col(f"{kind}_source").eqNullSafe(F.col(f"{kind}_lake")) for kind in ("n", "sum", "xor")]
    counts = [F.coalesce(f"n_{side}", F.lit(0).cast("bigint")).alias(f"n_{side}") for side in ("source", "lake")]
    return both.select(*nodes, *counts, (same[0] & same[1] & same[2]).alias("same"))


class Reconciliation:
    """Source against lake in two levels: checksums of days, and of ranges of ids in the days that
    differ. Ids are compared only within ranges that differ; where checksums agree, no id is
    shuffled. Each frame has order_id and date."""

    def __init__(self, expected: DataFrame, lake: DataFrame):
        node = F.shiftright(F.col("order_id").cast("bigint"), RANGE_BITS)
        sides = [
            frame.select("order_id", "date", day_number(F.col("date")).alias("_day"), node.alias("_node"))
            for frame in (expected, lake)
        ]
        self.days = _compared(*sides, "_day").persist()
        sides = [self._within(side, self.days, "_day") for side in sides]
        self.nodes = _compared(*sides, "_day", "_node").persist()
        self.suspects = [self._within(side, self.nodes, "_day", "_node") for side in sides]

    @staticmethod
    def _within(side: DataFrame, compared: DataFrame, *nodes: str) -> DataFrame:
        return side.join(compared.where("NOT same").select(*nodes), list(nodes), "left_semi")

    def per_day(self) -> DataFrame:
        """date, n_source, n_lake, missing, unexpected and repeated ids, of every day."""
        one = [
            side.select("order_id", "_day", F.lit(s).cast("bigint").alias("s"), F.lit(1 - s).cast("bigint").alias("l"))
            for s, side in zip((1, 0), self.suspects)
        ]
        # Copies of an id collapse before the shuffle.
        per_id = one[0].unionByName(one[1]).groupBy("order_id", "_day").agg(F.sum("s").alias("s"), F.sum("l").alias("l"))
        found = per_id.groupBy("_day").agg(
            F.count_if(F.col("l") == 0).alias("missing"),
            F.count_if(F.col("s") == 0).alias("unexpected"),
            F.count_if((F.col("l") > 1) & (F.col("l") > F.col("s"))).alias("repeated"),
        )
        return self.days.join(found, "_day", "left").select(
            F.date_from_unix_date(F.nullif("_day", F.lit(NO_DAY))).alias("date"),
            "n_source",
            "n_lake",
            *[F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in ("missing", "unexpected", "repeated")],
        )


def reconcile(expected: DataFrame, lake: DataFrame) -> DataFrame:
    """Per day: rows expected and found, ids missing, unexpected or stored more often than the
    source has them."""
    return Reconciliation(expected, lake).per_day()
