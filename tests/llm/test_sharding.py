import hashlib

import pytest

from orderflow.llm import sharding
from tests.llm.conftest import ODD


def plain_table(names, size):
    """The turns written down directly: each shard's whole order of preference."""
    orders = []
    for name in names:
        digest = hashlib.md5(name.encode()).digest()
        offset, step = int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1
        orders.append(iter([(offset + j * step) % size for j in range(size)]))
    table = {}
    while len(table) < size:
        for shard, order in enumerate(orders):
            if len(table) < size:
                table[next(slot for slot in order if slot not in table)] = shard
    return [table[slot] for slot in range(size)]


def test_fill_takes_turns():
    names = [f"s{i}" for i in range(7)]
    for size in (7, 101, 1009):
        found = sharding.fill(names, size).tolist()
        assert found == plain_table(names, size)
        counts = [found.count(s) for s in range(7)]
        assert max(counts) - min(counts) <= 1


def test_few_keys_move_when_a_shard_leaves():
    names = [f"s{i}" for i in range(20)]
    before = [names[s] for s in sharding.fill(names)]
    after = [names[:-1][s] for s in sharding.fill(names[:-1])]
    moved = sum(a != b for a, b in zip(before, after) if a != "s19")
    assert moved < 0.05 * len(before)


def test_placement(table, folder):
    names = ["a", "b", "c"]
    slots = sharding.fill(names, 101).tolist()
    rows = sharding.place(table(*ODD).withColumnRenamed("n", "slot"), "doc_id", names, 101).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        key = "" if row["doc_id"] is None else str(row["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (row["slot"], row["shard"]) == (slot, names[slots[slot]])
    sharding.write(table(*ODD), "doc_id", names, folder("shards"))
    assert sharding.place(table(*ODD).limit(0), "doc_id", names, 101).collect() == []


def test_what_cannot_be_filled():
    for names, size in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.fill(names, size)


def test_odd_column_names(spark):
    names = ["a.b", "_key", "_name", "__slot", "__shard", "slot"]
    docs = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], ", ".join(f"`{n}` int" for n in names))
    placed = sharding.place(docs, "a.b", ["x", "y"])
    assert placed.columns == ["slot", "a.b", "_key", "_name", "__slot", "__shard", "shard"]
    assert tuple(placed.drop("slot", "shard").first()) == (1, 2, 3, 4, 5)
