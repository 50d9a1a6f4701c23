import math
import re
import tracemalloc
from collections import Counter
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa

from orderflow.llm import quality
from orderflow.llm.common import map_batches
from orderflow.llm.queries import op10_quality
from orderflow.llm.words import word_blocks
from tests.llm.conftest import ODD


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op10_quality(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert all(crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_odd_rows_and_labels(spark, table):
    docs = table(*ODD, *[(i, "good fine words " * 9 if i % 2 else "### bad!! " * 9) for i in range(60)])
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(None, 1), (1, None), (904, 7), (5000, 1), (3, 1), (3, 0), (3, 1)],
        "doc_id long, quality int",
    )
    model = quality.train(docs, labels, "quality")
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in found.values())
    assert min(found[i] for i in range(1, 60, 2)) > 0.5 > max(found[i] for i in range(0, 60, 2))
    assert found[901] == found[902] == found[903] and found[904] == found[905]
    kept = quality.keep(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["score"] >= 0.5 for r in quality.score(docs, model).collect())
    again = quality.train(docs, labels, "quality")
    assert (again.weights == model.weights).all()
    none = quality.train(docs, labels.limit(0), "quality")
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).collect() == []


def test_one_row_for_each_labelled_id_reaches_the_driver(spark, monkeypatch):
    docs = spark.range(2000).selectExpr("7 AS doc_id", "concat('text number ', id) AS text")
    docs = docs.union(spark.createDataFrame([(8, "another text")], "doc_id int, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "descend", lambda rows: seen.append([label for _, label in rows]))
    for most in (1, 2, 3):
        quality.train(docs, labels, "quality", max_train=most)
    # 9, of no document, has its place among the smallest MD5s.
    assert [len(rows) for rows in seen] == [sum(i in (7, 8) for i in sorted((7, 8, 9), key=md5)[:n]) for n in (1, 2, 3)]
    quality.train(docs, labels, "quality", max_packed=1)
    assert seen[-1] == []


def md5(number):
    import hashlib

    return hashlib.md5(str(number).encode()).hexdigest()


def words_of(*texts):
    ((_, _, words),) = word_blocks(pa.array(texts))
    return words


def plain_features(text):
    """What a text's features are made of, without their hashes."""
    words = text.encode().split()
    found = Counter(words) + Counter(zip(words, words[1:]))
    padded = bytes(b if b not in b" \t\n\v\f\r" else 32 for b in text.encode())
    for size in quality.CHAR_SIZES:
        grams = (padded[s : s + size] for s in range(len(padded) - size + 1))
        found += Counter((size, g) for g in grams if b" " not in g[1:-1])
    return found


def test_features_and_scores_are_those_of_each_text(chance):
    texts = ["one two  one\ttwo", "", " x ", "été a\nbc d", "".join(chance.choice("ab c") for _ in range(300))]
    words = words_of(*texts)
    block = [Counter() for _ in texts]
    for buckets, text in quality.features(words):
        for b, t in zip(buckets.tolist(), text.tolist()):
            block[t][b] += 1
    for text, found in zip(texts, block):
        alone = Counter(b for buckets, _ in quality.features(words_of(text)) for b in buckets.tolist())
        assert alone == found
        # Buckets may clash, so they are compared by their counts alone.
        wanted = plain_features(text)
        assert sum(found.values()) == sum(wanted.values())
        assert 0 <= len(wanted) - len(found) <= 3
    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(0, 3, quality.BUCKETS).astype(np.float32), 0.25)
    for found, score in zip(block, model.scores(words)):
        n = sum(found.values())
        odds = sum(float(model.weights[b]) * c for b, c in found.items()) / max(1, n) + model.bias
        assert math.isclose(score, 1 / (1 + math.exp(-odds)), rel_tol=1e-5)


def test_a_step_goes_down_the_gradient(chance):
    """Against differences of the loss, for the layer, the bias and the vectors."""
    rng = np.random.default_rng(2)
    buckets, counts = np.array([3, 9, 40]), np.array([1, 2, 5])

    def loss(learner, label):
        odds = (counts / counts.sum()) @ learner.vectors[buckets] @ learner.layer + learner.bias
        return np.log(np.exp(odds).sum()) - odds[label]

    for label in (0, 1):
        learner = quality.Learner.begin(0.3, np.random.default_rng(5))
        learner.bias = learner.bias + rng.normal(0, 1, 2)
        before = [x.copy() for x in (learner.vectors, learner.layer, learner.bias)]
        slopes = []
        for part, at, gain in (("vectors", (9, 1), quality.VECTOR_GAIN), ("layer", (4, 1), 1), ("bias", (0,), 0.1)):
            values, tiny = getattr(learner, part), 1e-6
            values[at] += tiny
            up = loss(learner, label)
            values[at] -= 2 * tiny
            slopes.append((part, at, gain, (up - loss(learner, label)) / (2 * tiny)))
            values[at] += tiny
        learner.step(buckets, counts, label, 0.01)
        for (part, at, gain, slope), old in zip(slopes, before):
            assert math.isclose(old[at] - getattr(learner, part)[at], 0.01 * gain * slope, rel_tol=1e-4, abs_tol=1e-9)
        untouched = np.setdiff1d(np.arange(quality.BUCKETS), buckets)
        assert (learner.vectors[untouched] == before[0][untouched]).all()


def test_packed_features_are_the_same_again(chance):
    for n in (0, 1, 4000):
        buckets = np.array(sorted(chance.sample(range(quality.BUCKETS), n)), np.int32)
        counts = np.array([chance.choice([1, 300, 10**6]) for _ in range(n)], np.int64)
        again = quality.unpacked(quality.packed(buckets, counts))
        assert again[0].tolist() == buckets.tolist() and again[1].tolist() == counts.tolist()


class InThisProcess:
    """A frame whose mapInArrow gives the function that a worker would run."""

    def __init__(self, spark):
        self.sparkSession = spark

    def mapInArrow(self, function, schema):
        return function


def test_features_of_a_large_batch_take_little_memory(spark, chance):
    words = ["".join(chance.choices("abcdefgh", k=5)) for _ in range(5000)]
    texts = [" ".join(chance.choices(words, k=300)) for _ in range(2000)]
    n = len(texts)
    batch = pa.record_batch({"place": pa.array(range(n), pa.int32()), "label": pa.array([1] * n, pa.int32()), "text": texts})
    model = quality.Model(np.random.default_rng(3).normal(0, 1, quality.BUCKETS).astype(np.float32), 0.1)
    whole = np.concatenate([model.scores(part) for _, _, part in word_blocks(batch["text"])])
    functions = (
        quality.counted(InThisProcess(spark)),
        quality.keep(type("Texts", (InThisProcess,), {"schema": None})(spark), model, float(np.median(whole))),
    )
    found = []
    for function in functions:
        tracemalloc.start()
        found.append(pa.Table.from_batches(function(iter([batch]))))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60 << 20
    assert found[0]["place"].to_pylist() == list(range(n))
    assert found[1]["place"].to_pylist() == np.flatnonzero(whole >= np.median(whole)).tolist()


def test_a_worker_gives_memory_back_after_a_task(spark):
    held = []

    def untidy(batches):
        pieces = [np.ones(12_500) for _ in range(6000)]
        held.extend(pieces[::100])
        del pieces
        yield {"x": [1]}

    def taken():
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    run = map_batches(InThisProcess(spark), untidy, "x long")
    before = taken()
    assert len(list(run(iter([])))) == 1
    assert taken() - before < 100
