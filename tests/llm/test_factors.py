"""Longest previous factors, and what is removed by them, against plain versions."""

import numpy as np

from orderflow.llm import factors
from tests.llm.conftest import ODD


def plain(rows, length):
    """Rows of one doc_id must have equal texts here, so that their order is fixed."""
    texts = sorted(((-(2**63) if i is None else i, n, i, (t or "").encode()) for n, (i, t) in enumerate(rows)))
    seen, out = set(), []
    for _, _, doc_id, data in texts:
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone])) == 1))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(data), int(gone.sum()), runs, kept))
    return sorted(out, key=repr)


def removed(table, rows, length):
    found = factors.remove(table(*rows), length).collect()
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found), key=repr)


def corpus(chance):
    pool = ["".join(chance.choice("ab cé") for _ in range(chance.randint(3, 60))) for _ in range(25)]

    def text():
        fresh = ["".join(chance.choice("xyz ") for _ in range(9)) for _ in range(6)]
        return "".join(chance.choice(pool if chance.random() < 0.6 else fresh) for _ in range(chance.randint(0, 14)))

    rows = [(i, text()) for i in range(200)]
    rows += [(300 + i, rows[chance.randint(0, 9)][1]) for i in range(30)]
    rows += [(-5, "late in the file, early in the order " * 3), (400, "late in the file, early in the order " * 4)]
    rows += [(401, "ab" * 300), (402, "a" * 257), (403, "\x00" * 90 + "q"), (404, "\x00" * 95)]
    # One row for each id of ODD, or equal ones: see plain().
    return rows + [r for r in ODD if r[0] not in (906, 907)] + [(906, "word " * 400), (907, "x" * 700)]


def test_later_copies_go_and_the_first_stays(table, chance):
    rows = corpus(chance)
    for length in (1, 7, 20, 100):
        assert removed(table, rows, length) == plain(rows, length)
    assert removed(table, [], 7) == []
    assert removed(table, [(1, None), (None, ""), (2, "short")], 7) == plain([(1, None), (None, ""), (2, "short")], 7)


def test_crowded_anchors_and_small_pieces(table, chance, monkeypatch):
    """Every anchor crowded, and every text cut into stretches: the same result."""
    rows = corpus(chance)
    wanted = plain(rows, 20)
    monkeypatch.setattr(factors, "MOST_CLASSES", 1)
    assert removed(table, rows, 20) == wanted
    batch = table(*rows).limit(0)
    assert factors.remove(batch, 20).collect() == []


def test_stretches_of_a_long_text_have_its_anchors(chance, monkeypatch):
    import pyarrow as pa

    texts = ["".join(chance.choice("abc") for _ in range(n)) for n in (5000, 3, 40, 0, 1700, 39, 900)]

    def strings(length):
        out = {}
        for piece in factors.pieces(pa.array(texts), length):
            found = factors.Anchors(piece, length)
            kept = np.arange(len(found.place))
            around = found.surroundings(kept)
            rows = piece.rows[found.text]
            for i in range(len(kept)):
                for s in range(found.first[i], found.last[i] + 1):
                    key = (int(rows[i]), int(found.inner(np.array([s]), kept[i : i + 1])[0]))
                    assert key not in out
                    out[key] = (int(found.hash[i]), int(around[i]), int(found.inner(found.place[i : i + 1], kept[i : i + 1])[0]))
        return out

    wanted = strings(40)
    assert set(wanted) == {(i, s) for i, t in enumerate(texts) for s in range(len(t) - 39)}
    monkeypatch.setattr(factors, "PIECE", 256)
    assert strings(40) == wanted
    for (i, s), (_, _, place) in wanted.items():
        assert s <= place <= s + 40 - factors.anchor_bytes(40)


def test_previous_factors(chance):
    for n, length in ((1, 3), (60, 4), (200, 6), (120, 1)):
        suffixes = np.array([[chance.randint(0, 2) for _ in range(length)] for _ in range(n)], np.uint8)
        positions = np.array(chance.sample(range(n), n))
        if n > 60:
            positions[5] = positions[9]
            suffixes[5] = suffixes[9]

        def common(a, b):
            return next((k for k in range(length) if a[k] != b[k]), length)

        wanted = [
            max((common(suffixes[i], suffixes[j]) for j in range(n) if positions[j] < positions[i]), default=0)
            for i in range(n)
        ]
        assert factors.previous_factors(suffixes, positions).tolist() == wanted


def test_sliding_least_and_its_places(chance):
    for width in range(1, 20):
        values = np.array([chance.randint(1, 6) for _ in range(70)], np.uint64)
        runs = [values[s : s + width] for s in range(70 - width + 1)]
        assert factors.sliding_least(values, width).tolist() == [min(r) for r in runs]
        assert factors.sliding_least(values, width, most=True).tolist() == [max(r) for r in runs]
        starts = np.array(sorted(chance.sample(range(len(runs)), len(runs) // 2)))
        wanted = [s + int(np.argmin(runs[s])) for s in starts]
        assert factors.least_places(values, width, starts).tolist() == wanted


def test_smaller_before(chance):
    for _ in range(30):
        x = [chance.randint(0, 9) for _ in range(40)]
        wanted = [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(40)]
        assert factors.smaller_before(np.array(x)).tolist() == wanted


def test_hashes_of_a_piece_fit_a_cache_and_rows_of_pieces_go_on_together():
    """A text is never cut into so many stretches that what surrounds them is most of the work."""
    import pyarrow as pa

    texts = pa.array(["x" * 3000] * 300 + ["y" * 2_000_000])
    for length in (100, 40_000):
        found = list(factors.pieces(texts, length))
        assert sum(p.hi - p.lo for p in found) == 2_900_000
        assert sum(len(p.data) for p in found) < 1.3 * 2_900_000
        assert length > 100 or max(8 * len(p.data) for p in found) <= 1 << 20
    parts = [{"a": np.arange(n), "b": [b"x"] * n} for n in (2, 0, 3)]
    joined = factors._joined(parts)
    assert joined["a"].tolist() == [0, 1, 0, 1, 2] and joined["b"] == [b"x"] * 5
