"""Collocations against plain counting of every phrase."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from orderflow.llm import collocations
from orderflow.llm.common import Bitmap
from tests.llm.conftest import ODD


def plain(rows, order, least, top, percent):
    counts, totals = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, order + 1):
                for s in range(len(words) - k + 1):
                    counts[lang, tuple(words[s : s + k])] += 1
    many = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    most = Counter()
    for (lang, p), f in many.items():
        for part in {p[s : s + k] for k in range(2, len(p)) for s in range(len(p) - k + 1)}:
            most[lang, part] = max(most[lang, part], f)
    out = {}
    for (lang, p), a in many.items():
        if 100 * most[lang, p] >= percent * a and most[lang, p]:
            continue
        n, cuts = totals[lang], []
        for c in range(1, len(p)):
            left, rest = counts[lang, p[:c]], counts[lang, p[c:]]
            cuts.append((1000 * a * n // (left * rest), c, left, rest))
        score, _, left, rest = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, rest, n))
    found = []
    for lang, phrases in out.items():
        for rank, (score, a, p, left, rest, n) in enumerate(sorted(phrases)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, rest, n, -score))
    return sorted(found)


def mined(spark, rows, *how):
    frame = spark.createDataFrame(rows, "lang string, text string")
    frame = frame.selectExpr("*", "1 AS n", "2 AS w1", "3 AS share", "'x' AS phrase", "4 AS rank")
    found = collocations.mine(frame, *how).drop("size")
    return sorted(tuple(r) for r in found.collect())


def test_every_phrase_and_score(spark, chance):
    words = ["a", "B", "b", "cé", "dd", "e-e", "É", " ", "f\x00"]
    ends = [" ", " ", " ", "\t ", " . ", ", ", "!", "\n", ";x:", "? "]
    rows = []
    for i in range(300):
        text = "".join(chance.choice(words) + chance.choice(ends) for _ in range(chance.randint(0, 40)))
        rows.append((chance.choice(["de", "fr", None, "und", ""]), text + chance.choice(["", " in the End of it"])))
    rows += [("de", text) for _, text in ODD] + [(None, None)]
    for how in ((5, 4, 2000, 100), (5, 2, 10, 80), (2, 3, 7, 100), (4, 10**9, 9, 100), (3, 1, 50, 50)):
        wanted = plain(rows, *how)
        assert mined(spark, rows, *how) == wanted
        assert bool(wanted) == (how[1] < 10**9)
    assert mined(spark, [], 5, 1, 10, 100) == []
    assert mined(spark, [("de", " .,\n"), (None, "")], 5, 1, 10, 100) == []


def test_scores_beyond_64_bits(spark):
    columns = "lang string, phrase string, size int, a long, l long, r long, n long, cut int"
    a, n = 9 * 10**17 + 7, 9 * 10**18 + 1
    (row,) = collocations._scored(spark.createDataFrame([("x", "p q", 2, a, a + 1, a + 3, n, 1)], columns)).collect()
    assert row["score"] == 1000 * a * n // ((a + 1) * (a + 3))


def test_what_the_bitmap_lets_pass_changes_nothing(spark, monkeypatch, chance):
    """Bitmaps that say yes to everything leave whole windows, and the same phrases."""
    rows = [("x", " ".join(chance.choice("abcdef") for _ in range(60))) for _ in range(40)]
    wanted = mined(spark, rows, 5, 6, 100, 100)
    full = Bitmap(np.full(1, 2**64 - 1, np.uint64), 6)
    monkeypatch.setattr(collocations, "_filter", lambda *a: collocations.Filter(full, full))
    assert mined(spark, rows, 5, 6, 100, 100) == wanted == plain(rows, 5, 6, 100, 100)


def test_windows_end_with_their_piece():
    batch = pa.RecordBatch.from_pydict({"lang": ["x", "y"], "text": ["one two, three\tfour", "five"]})
    (block,) = collocations.blocks_of(batch)
    assert block.linked.tolist() == [True, False, True, False, False]
    full = Bitmap(np.full(1, 2**64 - 1, np.uint64), 6)
    one, length, counts = collocations.distinct_windows(block, 3, collocations.Filter(full))
    assert sorted(zip(one.tolist(), length.tolist())) == [(0, 2), (1, 1), (2, 2), (3, 1), (4, 1)]
    assert counts.tolist() == [1] * 5


def test_counted_hashes(spark, chance, monkeypatch):
    """Small pieces, many of them: exactly the hashes that are frequent by their upper 32 bits."""
    monkeypatch.setattr(collocations, "HELD", 50)
    rows = [("x", " ".join(str(chance.randint(0, 300)) for _ in range(40))) for _ in range(200)]
    texts = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    hashes = Counter()
    for block in collocations.blocks_of(pa.RecordBatch.from_pydict({"lang": ["x"] * 200, "text": [t for _, t in rows]})):
        hashes.update(collocations._short_hashes(block).tolist())
    for least in (1, 3, 25, 400):
        bitmap = collocations.frequent(texts, least, collocations._short_hashes)
        keys = np.array(list(hashes), np.uint64)
        wanted = {h >> 38 for h, n in hashes.items() if n >= least}
        assert {h >> 38 for h in keys[bitmap.has(keys)].tolist()} == wanted


def test_packed_hashes_are_the_same_again(chance):
    for n in (1, 5, 3000):
        tops = np.array(sorted(chance.sample(range(1 << 22), n)), np.uint32)
        counts = np.array([chance.choice([1, 2, 255, 256, 2**32 - 1]) for _ in range(n)])
        places, again = collocations.unpacked(collocations.packed(tops + np.uint32(5 << 22), counts))
        assert places.tolist() == tops.tolist() and again.tolist() == counts.tolist()
