"""Batches by count or by time, whichever comes first."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderflow.sources.paths import delete, names_in


class Gather:
    """Collects micro-batches and hands them on as one batch when they have least_rows rows or the
    oldest has waited longest_delay seconds.

    A micro-batch is written to a folder of its own before the stream commits it, so what waits
    survives a restart. A batch handed on is numbered by the newest micro-batch in it: handed on
    again after a crash it has the same number and the same rows, as what waits is only dropped
    after it, and later micro-batches are not mixed in.
    """

    def __init__(
        self,
        spark: SparkSession,
        write: Callable[[DataFrame, int], None],
        folder: str,
        least_rows: int,
        longest_delay: float,
        clock: Callable[[], float] = time.time,
    ):
        self.spark, self.write, self.folder = spark, write, folder.rstrip("/")
        self.least_rows, self.longest_delay, self.clock = least_rows, longest_delay, clock
        self.lock = threading.Lock()
        self._begun()
        self.waiting = {int(n.split("=")[1]): self._rows(n) for n in self._names()}
        self.since = clock() if self.waiting else None

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """For foreachBatch. A micro-batch that comes again replaces itself."""
        with self.lock:
            if batch_id in self.waiting or not batch.isEmpty():
                batch.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")
                self.waiting[batch_id] = self._rows(f"batch={batch_id}")
                if self.since is None:
                    self.since = self.clock()
            self._flush(due_only=True)

    def flush(self) -> bool:
        """Hand on what waits, as at the end."""
        with self.lock:
            return self._flush(due_only=False)

    def flush_if_due(self) -> bool:
        with self.lock:
            return self._flush(due_only=True)

    def _flush(self, due_only: bool) -> bool:
        if not self.waiting:
            return False
        late = self.clock() - self.since >= self.longest_delay
        if due_only and not late and sum(self.waiting.values()) < self.least_rows:
            return False
        self._hand_on(sorted(self.waiting))
        return True

    def _hand_on(self, ids: list[int]) -> None:
        # The list is written first: after a crash the same micro-batches go on together.
        begun = f"{self.folder}/_begun"
        self.spark.createDataFrame([(",".join(map(str, ids)),)], "ids string").coalesce(1).write.mode(
            "overwrite"
        ).text(begun)
        self._finish(ids)

    def _finish(self, ids: list[int]) -> None:
        paths = [f"{self.folder}/batch={i}" for i in ids]
        self.write(self.spark.read.parquet(*paths), ids[-1])
        delete(self.spark, *paths, f"{self.folder}/_begun")
        self.waiting = {i: n for i, n in getattr(self, "waiting", {}).items() if i not in ids}
        self.since = None

    def _begun(self) -> None:
        """Finish the batch that was being handed on when the last run broke off."""
        if "_SUCCESS" not in names_in(self.spark, f"{self.folder}/_begun"):
            return
        line = self.spark.read.text(f"{self.folder}/_begun").first()
        ids = [int(i) for i in line["value"].split(",")] if line else []
        there = [i for i in ids if f"batch={i}" in self._names()]
        if there == ids and ids:
            self._finish(ids)
        else:
            # It was written, and dropping what had waited broke off.
            delete(self.spark, *[f"{self.folder}/batch={i}" for i in there], f"{self.folder}/_begun")

    def _names(self) -> list[str]:
        return [n for n in names_in(self.spark, self.folder) if n.startswith("batch=")]

    def _rows(self, name: str) -> int:
        return self.spark.read.parquet(f"{self.folder}/{name}").agg(F.count(F.lit(1))).first()[0]


def start_gathered(frame: DataFrame, gather: Gather, checkpoint: str, **trigger) -> StreamingQuery:
    """Feed a stream to a Gather. Whoever waits for the query calls flush_if_due() now and then, as
    Spark calls nobody while nothing arrives, and flush() when it has ended."""
    return (
        frame.writeStream.foreachBatch(gather.add)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
