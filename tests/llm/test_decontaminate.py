import re

import corpus_pipeline
from orderflow.llm import decontaminate, queries
from tests.llm.conftest import ODD


def distance(one, other):
    row = list(range(len(other) + 1))
    for i, x in enumerate(one, 1):
        fresh = [i]
        for j, y in enumerate(other, 1):
            fresh.append(min(row[j] + 1, fresh[-1] + 1, row[j - 1] + (x != y)))
        row = fresh
    return row[-1]


def words(text):
    return re.findall("[a-z0-9\u0080-￿]+", text.lower())


def test_edit_distance(chance):
    for _ in range(500):
        a, b = ([chance.choice("abc") for _ in range(chance.randint(0, 9))] for _ in "ab")
        assert decontaminate.edit_distance(a, b) == distance(a, b)


def test_recall_against_all_windows_and_items(spark, table, chance):
    vocabulary = ["w%d" % chance.randint(0, 400) for _ in range(500)] + ["the", "of"] * 40
    items = [(i, " ".join(chance.choice(vocabulary) for _ in range(chance.randint(5, 45)))) for i in range(25)]
    docs = []
    for number in range(160):
        leak = words(items[chance.randrange(25)][1])
        for _ in range(chance.randint(0, len(leak) // 4)):
            at = chance.randrange(len(leak))
            leak[at : at + chance.randint(0, 1)] = chance.choice(([], ["new"], ["new", "er"]))
            leak = leak or ["new"]
        around = [[chance.choice(vocabulary) for _ in range(chance.randint(0, 60))] for _ in "ab"]
        docs.append((number, ", ".join(around[0] + leak).upper() + "\n" + " ".join(around[1])))
    wanted = {}
    for doc_id, text in docs:
        mine = words(text)
        for item_id, item in items:
            item = words(item)
            best = min(
                (decontaminate.edit_distance(item, mine[s : s + len(item)]) for s in range(len(mine) - len(item) + 1)), default=99
            )
            if len(item) >= decontaminate.LEAST_WORDS and best <= len(item) * 20 // 100:
                wanted[doc_id, item_id] = best
    held = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.find(table(*docs), held).collect()}
    assert set(found) <= set(wanted)
    assert len(wanted) > 60 and len(found) >= 0.97 * len(wanted)
    assert all(found[pair] >= wanted[pair] for pair in found)
    exact = {pair for pair, d in wanted.items() if d == 0}
    assert exact <= set(found)
    clean = decontaminate.clean(table(*docs), held)
    assert clean.columns == table(*docs).columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in found}


def test_windows_may_hang_over_the_ends_of_a_text(spark, table, chance):
    """Whole texts shorter than an item, and items cut at the beginning or end of a text, against
    unrestricted edit distance."""
    items = [(i, " ".join("w%d" % chance.randint(0, 60) for _ in range(chance.randint(8, 40)))) for i in range(30)]
    docs, planted = [], {}
    for number in range(300):
        item_id, item = items[number % 30]
        leak = item.split()
        edits = chance.randint(1, len(leak) * 20 // 100)
        if number % 3:
            leak = leak[edits:] if number % 3 == 1 else leak[:-edits]
            around = ["x%d" % i for i in range(chance.randint(1, 30))]
            text = leak + around if number % 3 == 1 else around + leak
        else:
            for _ in range(edits):
                del leak[chance.randrange(len(leak))]
            text = leak
        planted[number, item_id] = distance(item.split(), leak)
        docs.append((number, " ".join(text)))
    held = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(table(*docs), held).collect()
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in rows}
    assert set(found) >= set(planted)
    assert all(found[pair] <= planted[pair] for pair in planted)
    texts, wanted = dict(docs), dict(items)
    for r in rows:
        mine = texts[r["doc_id"]].split()[r["start"] : r["start"] + r["n_words"]]
        assert r["distance"] == distance(wanted[r["item_id"]].split(), mine)
    assert decontaminate.clean(table(*docs), held).count() == 0


def test_short_items_and_scripts_without_spaces(spark, tmp_path):
    """Through the query and the stage: short items as they are, long ones of one script cut."""
    items = [
        (1, "Who wrote it?"), (2, "Yes"), (3, "日本の首都はどこですか東京です"), (4, "เมืองหลวงของไทยคืออะไร"),
        (5, "首都?"), (6, "who  WROTE it"), (7, None), (8, "?!"),
    ]
    docs = [
        (1, "So who wrote it then"), (2, "who really wrote it"), (3, "who wrote"), (4, "it who wrote"),
        (5, "yesterday"), (6, "oh, YES"), (7, "答えは日本の首都はどこですか東だ。"), (8, "xเมืองหลวงของไทยคือไร"),
        (9, "首 都"), (10, "首の都"), (11, None), (12, "𠀀首都𠀀"), (13, "who wrote it? who wrote it?"),
    ]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = {tuple(r) for r in queries.op3_decontamination(spark, str(tmp_path)).collect()}
    short = {(1, 1, 1, 3, 0), (1, 6, 1, 3, 0), (13, 1, 0, 3, 0), (13, 6, 0, 3, 0), (6, 2, 1, 1, 0)}
    short |= {(9, 5, 0, 2, 0), (12, 5, 1, 2, 0), (7, 5, 6, 2, 0)}
    assert {f for f in found if f[1] in (1, 2, 5, 6)} == short
    assert {f[:2] for f in found} - {f[:2] for f in short} == {(7, 3), (8, 4)}
    stage = corpus_pipeline.decontaminated(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r["doc_id"] for r in stage.collect()} == {2, 3, 4, 5, 10, 11}


def test_odd_rows(spark, table):
    items = spark.createDataFrame([(1, None), (2, "word " * 12), (2, "word " * 12), (None, "too short")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.find(table(*ODD), items).collect()}
    assert found == {(906, 2, 0)}
    assert decontaminate.clean(table(*ODD), items).count() == len(ODD) - 1
    assert decontaminate.find(table(*ODD), items.limit(0)).collect() == []
    assert decontaminate.clean(table(*ODD).limit(0), items).collect() == []
