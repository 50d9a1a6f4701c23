"""Vector codes against plain k-means in Python's integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from orderflow.llm import codes


def plain(rows, parts, entries, rounds):
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(Fraction(x) * 4096) for x in v] for _, v in kept]
    firsts = {}
    for (i, v), w in zip(kept, whole):
        if i is not None:
            firsts[i] = min(firsts.get(i, (v, w)), (v, w))
    starts = [firsts[i][1] for i in sorted(firsts)[:entries]]
    if not starts:
        return [], []
    m = len(starts[0]) // parts
    cut = lambda w, p: w[p * m : (p + 1) * m]
    books = [[cut(w, p) for w in starts] for p in range(parts)]
    gap = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))

    def assigned():
        return [[min((gap(cut(w, p), e), j) for j, e in enumerate(books[p])) for p in range(parts)] for w in whole]

    for _ in range(rounds):
        best = assigned()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [cut(w, p) for w, b in zip(whole, best) if b[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for (i, _), b in zip(kept, assigned()):
        error = sum(d for d, _ in b)
        out.append((i, bytes(j for _, j in b), error if error < 1 << 63 else None))
    return out, books


def found(spark, rows, kind="double", **shape):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    frame = frame.selectExpr("*", "1 AS id", "'x' AS state", "2 AS sums", "'c' AS carried", "3 AS code")
    coded = codes.compress(frame, **shape)
    return [(r["id"], bytes(r["code"]), r["error"]) for r in coded.rows.collect()], coded.codebooks.tolist()


def same(spark, rows, kind="double", **shape):
    got, books = found(spark, rows, kind, **shape)
    wanted, plain_books = plain(rows, shape["parts"], shape["entries"], shape["rounds"])
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert books == plain_books or not wanted
    return got


def test_codes_are_those_of_plain_rounds(spark, chance):
    centres = [[chance.gauss(0, 1) for _ in range(12)] for _ in range(9)]
    rows = []
    for i in range(600):
        near = chance.choice(centres)
        rows.append((i, [float(np.float32(x + chance.gauss(0, 0.2))) for x in near]))
    for parts, entries, rounds, groups in ((3, 16, 6, 4), (4, 5, 3, 1), (1, 16, 9, 16), (12, 2, 2, 4), (2, 1, 2, 3)):
        same(spark, rows, "float", parts=parts, entries=entries, rounds=rounds, groups=groups)


def test_odd_rows_and_ties(spark, chance):
    rows = [(i, [float(chance.randint(-1, 1)) / 4096 for _ in range(4)]) for i in range(200)]
    rows += [(None, [0.5, -0.5, 0.25, 0.0])] * 3 + [(7, [1.0, 2.0, 3.0, 4.0])] * 2 + [(300, None)]
    rows += [(-1, [None, 1.0, 1.0, 1.0]), (-2, [math.nan, 0.0, 0.0, 0.0]), (-3, [math.inf, 0.0, 0.0, 0.0])]
    got = same(spark, rows, parts=2, entries=16, rounds=4)
    assert len(got) == 205
    # More entries than ids, and one vector only.
    same(spark, rows[:5] + rows[200:], parts=2, entries=16, rounds=3)
    same(spark, [(5, [0.1, 0.2])], parts=2, entries=16, rounds=2)


def test_numbers_beyond_64_bits(spark, chance):
    rows = [(i, [chance.gauss(0, 1) * 10.0 ** chance.randint(-3, 30) for _ in range(4)]) for i in range(60)]
    got = same(spark, rows, parts=2, entries=6, rounds=3)
    assert any(e is None for _, _, e in got)
    rows = [(i, [chance.gauss(0, 1) * 1e5 for _ in range(4)]) for i in range(60)]
    same(spark, rows, parts=2, entries=6, rounds=3)


def test_nothing_to_code(spark):
    for rows in ([], [(1, None)], [(None, [1.0, 2.0])]):
        assert found(spark, rows, parts=2, entries=4, rounds=2)[0] == []
    assert found(spark, [(1, []), (2, [])], parts=2, entries=4, rounds=2)[0] == [(1, b"\0\0", 0), (2, b"\0\0", 0)]
    with pytest.raises(ValueError, match="from 1 to 2"):
        found(spark, [(1, [1.0]), (2, [1.0, 2.0])], parts=1, entries=4, rounds=2)
    with pytest.raises(ValueError, match="do not divide"):
        found(spark, [(1, [1.0, 2.0, 3.0])], parts=2, entries=4, rounds=2)


def test_bounds_spare_scans(spark, chance, monkeypatch):
    """Well separated vectors are scanned in the first rounds and left alone in the last."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-5000, 5000, (4, 6))
    data = centres[rng.integers(0, 4, 800)][:, None, :] + rng.integers(-20, 20, (800, 1, 6))
    shape = codes.Shape(1, 6, 2, 5100)
    history, state, scanned = [data[:4].transpose(1, 0, 2)], None, []
    history[0] = centres[None] + 7
    plain_distances = codes.distances
    monkeypatch.setattr(codes, "distances", lambda r, e: scanned.append(len(r)) or plain_distances(r, e))
    for _ in range(4):
        now = codes.Round(shape, history)
        state = now.first(len(data)) if state is None else state
        before = sum(scanned)
        now.assign(data, state)
        wanted = plain_distances(data[:, 0], history[-1][0]).argmin(axis=1)
        assert state["a"][:, 0].tolist() == wanted.tolist()
        fresh = history[-1].copy()
        for j in range(4):
            fresh[0, j] = data[wanted == j, 0].sum(axis=0) // (wanted == j).sum()
        history.append(fresh)
        last = sum(scanned) - before
    assert scanned[0] == 800 and last == 0


def test_a_code_stands_for_its_entries(spark):
    rows = [(i, [i / 8, -i / 4, 0.5, 1.0]) for i in range(4)]
    coded = codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), parts=2, entries=4, rounds=1)
    near = codes.approximate(coded.rows, coded.codebooks)
    assert {r["id"]: list(r["vector"]) for r in near.collect()} == dict(rows)
