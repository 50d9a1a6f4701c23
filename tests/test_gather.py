"""Batches by count or by time, refused orders, and files that vanish."""

import math

import pytest

from orderflow.operators.events import clean, decode, encode
from orderflow.sources.lake import read_lake
from orderflow.sources.paths import names_in
from orderflow.sources.topic import DirectoryTopic, lost_files, noting_files
from orderflow.streaming import ingest
from orderflow.streaming.gather import Gather
from orderflow.streaming.ingest import UniqueSink
from tests.samples import ids, order


@pytest.fixture
def batch(orders):
    return lambda *numbers: clean(decode(encode(orders(*[order(i) for i in numbers]))))


@pytest.fixture
def gathered(spark, folder):
    """A Gather with a clock that the test sets, and what it has handed on."""

    class Site:
        now, handed = 0.0, []

        def gather(self, least=4, delay=10.0, write=None):
            def take(frame, number):
                self.handed.append((number, ids(frame)))

            return Gather(spark, write or take, folder("waiting"), least, delay, clock=lambda: self.now)

    site = Site()
    site.handed = []
    return site


def test_by_count_or_by_time_whichever_comes_first(gathered, batch):
    gather = gathered.gather()
    for number, rows in enumerate([(1,), (2, 3), (4,), (5,)]):
        gather.add(batch(*rows), number)
    assert gathered.handed == [(2, [1, 2, 3, 4])]
    gathered.now = 9.0
    assert not gather.flush_if_due()
    gathered.now = 10.0
    assert gather.flush_if_due() and gathered.handed[-1] == (3, [5])
    assert not gather.flush_if_due() and not gather.flush()
    gather.add(batch(6), 4)
    assert gather.flush() and gathered.handed[-1] == (4, [6])


def test_what_waits_survives_a_restart(spark, gathered, batch, folder):
    gathered.gather().add(batch(1), 0)
    again = gathered.gather()
    again.add(batch(1), 0)  # the stream had not committed it
    again.add(batch(None), 1)  # nothing in it
    again.add(batch(2, 3, 4), 2)
    assert gathered.handed == [(2, [1, 2, 3, 4])]
    assert names_in(spark, folder("waiting")) == []


@pytest.mark.parametrize("written", [True, False])
def test_a_batch_handed_on_again_has_the_same_rows(spark, gathered, batch, folder, written):
    lake = folder("lake")
    sink = UniqueSink(spark, lake, stream="s")

    def die(frame, number):
        if written:
            sink.write(frame, number)
        raise OSError("driver lost")

    gather = gathered.gather(least=2, write=die)
    gather.add(batch(1), 0)
    with pytest.raises(OSError):
        gather.add(batch(2), 1)
    seen = []
    sink = UniqueSink(spark, lake, stream="s")
    again = gathered.gather(least=2, write=lambda f, n: (seen.append((n, ids(f))), sink.write(f, n)))
    assert seen == [(1, [1, 2])] and not again.waiting
    again.add(batch(2, 3), 2)
    assert ids(read_lake(spark, lake)) == [1, 2, 3]


# --- orders that no file can be written with -------------------------------------------------


def failing(monkeypatch, *numbers):
    """A writer that fails on some orders, in the task that writes them."""
    plain = ingest.append_by_date

    def append(rows, *how):
        bad = rows.sparkSession.sql(f"SELECT array({','.join(map(str, numbers))}) AS bad").first()["bad"]
        check = f"IF(order_id IN ({','.join(map(str, bad))}), CAST(raise_error('refused') AS INT), order_id)"
        plain(rows.selectExpr(*[f"{check} AS order_id" if c == "order_id" else c for c in rows.columns]), *how)

    monkeypatch.setattr(ingest, "append_by_date", append)


def test_only_the_orders_that_fail_are_set_aside(spark, batch, folder, monkeypatch):
    failing(monkeypatch, 3, 17)
    sink = UniqueSink(spark, folder("lake"), stream="s", quarantine=folder("aside"))
    sink.write(batch(*range(20), 3), 0)
    sink.write(batch(30), 1)
    assert ids(read_lake(spark, folder("lake"))) == [*[i for i in range(20) if i not in (3, 17)], 30]
    aside = spark.read.parquet(folder("aside")).collect()
    assert sorted(r["order_id"] for r in aside) == ["17", "3", "3"]
    assert all("refused" in r["error"] for r in aside)


def test_without_a_quarantine_the_batch_fails(spark, batch, folder, monkeypatch):
    failing(monkeypatch, 3)
    with pytest.raises(Exception, match="refused"):
        UniqueSink(spark, folder("lake"), stream="s").write(batch(2, 3), 0)


def test_an_outage_of_the_lake_sets_nothing_aside(spark, batch, folder, tmp_path, monkeypatch):
    failing(monkeypatch, 2, 3)
    sink = UniqueSink(spark, folder("lake"), stream="s", quarantine=folder("aside"))
    sink._begin(0)
    (tmp_path / "lake").write_text("a file where the folder should be")
    with pytest.raises(Exception):
        sink.write(batch(2, 3), 0)
    assert names_in(spark, folder("aside")) == []


# --- files that vanish -------------------------------------------------------------------------


def test_vanished_files_are_passed_over_and_reported(spark, orders, folder, tmp_path):
    topic = DirectoryTopic(folder("topic"), {"maxFilesPerTrigger": "1"})
    for number in range(3):
        topic.publish(orders(order(number)).coalesce(1))
    stored = []

    def write(rows, batch_id):
        stored.extend(ids(decode(rows)))
        files = sorted((tmp_path / "topic").glob("*.txt"), key=lambda p: p.stat().st_mtime_ns)
        if batch_id == 0:
            files[2].unlink()
        if batch_id == 1:
            files[0].unlink()  # read already, so nothing is lost

    raw = topic.stream_with_files(spark).writeStream.option("checkpointLocation", folder("checkpoint"))
    raw.foreachBatch(noting_files(write, folder("checkpoint"))).trigger(availableNow=True).start().awaitTermination()
    assert sorted(stored) == [0, 1]
    (gap,) = lost_files(spark, topic, folder("checkpoint")).collect()
    assert gap["batch"] == 2 and not math.isnan(gap["batch"])
