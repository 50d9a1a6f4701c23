import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import components, jaccard
from tests.llm.conftest import ODD


def plain(rows, size, percent):
    """Sets, all pairs that share a shingle, and a union of what links."""
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    for a, b in {p for held in holders.values() for p in combinations(held, 2)}:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.fixture
def rows(chance):
    base = [" ".join(chance.choice("abcdefgh") for _ in range(chance.randint(1, 60))) for _ in range(50)]
    out = []
    for i in range(500):
        words = chance.choice(base).split()
        for _ in range(chance.choice([0, 0, 1, 1, 2, 3])):
            words[chance.randrange(len(words))] = chance.choice(["a", "B", "zz%d" % chance.randint(0, 5)])
        out.append((i, " ".join(words)))
    return out + [row for row in ODD if row[0] != 906]


@pytest.mark.parametrize("size, percent, limit, frequent", [(4, 85, None, 50), (4, 85, 24, 3), (5, 80, 0, 3), (4, 85, 9, 50)])
def test_components_are_those_of_all_pairs(table, rows, monkeypatch, size, percent, limit, frequent):
    """With any boundary between light and heavy sets, and with hardly any list frequent or most."""
    if limit is not None:
        monkeypatch.setattr(jaccard, "light_limit", lambda *_: limit)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    found = jaccard.join(table(*rows), size, percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == plain(rows, size, percent)


def test_one_of_each_group_stays(table, rows):
    docs = table(*rows)
    kept = jaccard.one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns
    firsts = {d for d, _, c in plain(rows, 5, 80) if d is None or d == c}
    assert {r["doc_id"] for r in kept.collect()} == firsts


def test_without_rows_and_without_links(table):
    assert jaccard.join(table(*ODD).limit(0), 4, 85).collect() == []
    assert {r["component_id"] for r in jaccard.join(table((1, "a b"), (2, "c d")), 4, 85).collect()} == {1, 2}


def test_bounds_hold_for_all_small_sizes():
    for percent in (80, 85):
        for n in range(1, 40):
            assert list(jaccard.partner_sizes(n, percent)) == [
                m for m in range(1, 80) if 100 * min(n, m) >= percent * max(n, m)
            ]
            for m in jaccard.partner_sizes(n, percent):
                o = jaccard.least_overlap(n, m, percent)
                assert 100 * o >= percent * (n + m - o) and 100 * (o - 1) < percent * (n + m - o + 1)
                # Of any two sets with that overlap, the heads meet.
                assert jaccard.prefix_size(n, percent) > n - o
    # Many light sets with short lists are scanned, long lists are not.
    assert jaccard.light_limit({12: 1000}, 0, 85) < 12 <= jaccard.light_limit({12: 1000}, 1e6, 85)


def test_components_of_random_graphs(spark, chance):
    for n in (1, 30, 60):
        edges = [(chance.randrange(50), chance.randrange(50)) for _ in range(n)] + [(60 + i, 61 + i) for i in range(20)]
        frame = spark.createDataFrame(edges, "a long, b long")
        near = defaultdict(set)
        for a, b in edges:
            near[a].add(b)
            near[b].add(a)

        def reached(start):
            met, todo = {start}, [start]
            while todo:
                fresh = near[todo.pop()] - met
                met |= fresh
                todo += fresh
            return min(met)

        wanted = {x: reached(x) for x in near if near[x] - {x}}
        assert {r["id"]: r["component"] for r in components.components(frame).collect()} == wanted


def test_links_are_named_as_the_spanning_ones(spark, table):
    """Five texts that all link: the links tried connect them and need not be all ten."""
    docs = [(i, " ".join("w%d" % k for k in range(60)) + " end%d" % i) for i in range(5)]
    joined = jaccard.join(table(*docs), size=4, percent=85)
    assert joined.columns == ["doc_id", "n_shingles", "n_spanning_links", "component_id"]
    rows = joined.collect()
    assert {r["component_id"] for r in rows} == {0}
    assert all(1 <= r["n_spanning_links"] <= 4 for r in rows)


def test_sets_that_clash_part_under_another_salt_or_are_told(spark, table, monkeypatch):
    one, other = (np.array(s, np.uint64) for s in ([1, 4, 9], [2, 3, 9]))
    assert all(jaccard.set_hash(one, salt) != jaccard.set_hash(other, salt) for salt in range(jaccard.SALTS))
    sets = jaccard._sets
    docs = table((1, "a b c d e f"), (2, "g h i j k l"))
    monkeypatch.setattr(jaccard, "_sets", lambda *rest: sets(*rest).withColumn("v", F.lit(1).cast("long")))
    with pytest.raises(RuntimeError, match="equal hashes"):
        jaccard.join(docs, size=4, percent=85)


def test_only_copies_of_an_id_go(table):
    text = "one two three four five six seven eight"
    docs = table((1, text), (2, text), (2, "other words that stand alone in here"), (3, "z"), (2, text), (None, text))
    kept = jaccard.one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"][:5]) for r in kept.collect()), key=repr)
    assert found == [(1, "one t"), (2, "other"), (3, "z"), (None, "one t")]


def test_a_text_and_many_edited_copies(table, chance):
    """Copies that are linked with the text but hardly with each other, and some with neither."""
    words = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(1, 90):
        copy = list(words)
        for place in chance.sample(range(120), 2 if i % 3 else 9):
            copy[place] = f"x{i}_{place}"
        rows.append((i, " ".join(copy)))
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(table(*rows), 4, 85).collect())
    assert found == sorted((d, n, c) for d, n, c in plain(rows, 4, 85))
    assert sum(c == 0 for _, _, c in found) > 50 and sum(d == c for d, _, c in found) > 20


def test_copies_are_listed_once(table, monkeypatch):
    """However many copies a text has, its class is in each list once."""
    counts, saved = {}, jaccard.saved

    def noting(rows, name):
        out = saved(rows, name)
        counts.setdefault(name, out.count())
        return out

    monkeypatch.setattr(jaccard, "saved", noting)
    text = " ".join(f"w{i}" for i in range(40))
    listed = []
    for copies in (1, 30):
        counts.clear()
        joined = jaccard.join(table(*[(i, text) for i in range(copies)], (100, text + "x")), size=4, percent=85)
        assert {r["component_id"] for r in joined.collect()} == {0}
        listed.append(counts["lists"])
    assert listed[0] == listed[1] > 0


def test_pairs_of_a_group_of_copies_grow_with_its_size(table, monkeypatch):
    """Copies of a text with two edits each of thirty: they link by a common edit, but hardly with one
    of them. What is left to try across components is less than a pair for each."""
    tried, linked = [], jaccard._linked

    def noting(texts, pairs, *rest):
        tried.append(pairs.count())
        return linked(texts, pairs, *rest)

    monkeypatch.setattr(jaccard, "_linked", noting)
    rows = []
    for edits in combinations(range(30), 2):
        copy = [f"w{i}" for i in range(100)]
        for edit in edits:
            copy[5 * edit % 100] = f"x{edit}"
        rows.append((len(rows), " ".join(copy)))
    found = jaccard.join(table(*rows), 4, 85).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(plain(rows, 4, 85))
    across = tried[1]
    assert across < len(rows) and sum(tried) < 20 * len(rows), tried


@pytest.mark.parametrize("most", [1 << 20, 1000])
def test_shingles_of_heads_are_counted_packed(table, rows, monkeypatch, most):
    """As one by one, but a row for many: a row for each filled an executor's heap."""
    monkeypatch.setattr(jaccard, "MOST_TOPS", most)
    made, saved = [], jaccard.map_batches

    def noting(frame, function, schema):
        out = saved(frame, function, schema)
        made.append((schema, out))
        return out

    monkeypatch.setattr(jaccard, "map_batches", noting)
    texts = jaccard.texts_of(table(*rows)).withColumn("k", F.xxhash64("doc_id", "text")).coalesce(2)
    every = jaccard.Bitmap(np.full(1, -1, np.int64).view(np.uint64), 6)
    heads = jaccard._heads(texts, 4, 85, every, jaccard.Bitmap.none(), wide=3)
    sets = [s for _, _, w in jaccard.word_blocks(texts.toArrow()["text"].combine_chunks(), lower=True) for s in jaccard.text_sets(w, 4)]
    tops = np.concatenate([jaccard._head(s, 85, jaccard.Bitmap.none(), 3) for s in sets]) >> np.uint64(32)
    top, count = np.unique(tops.astype(np.uint32), return_counts=True)
    wanted = dict(zip(top[count > 1].view(np.int32).tolist(), count[count > 1].tolist()))
    assert {r["top"]: r["count"] for r in heads.collect()} == wanted
    assert heads.count() == len(wanted)
    schema, packed = made[0]
    assert "tops binary" in schema and packed.selectExpr("sum(length(tops))").first()[0] <= 4 * len(tops)
    assert packed.groupBy("part").count().count() <= jaccard.LEAST_PARTS
