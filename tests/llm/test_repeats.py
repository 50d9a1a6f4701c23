from collections import Counter

from orderflow.llm import repeats
from tests.llm.conftest import ODD


def plain(rows, size):
    texts = [(doc_id, (text or "").encode().split()) for doc_id, text in rows]
    seen = Counter(tuple(w[s : s + size]) for _, w in texts for s in range(len(w) - size + 1))
    out = []
    for doc_id, w in texts:
        gone = set()
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s : s + size])] > 1:
                gone.update(range(s, s + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((doc_id, len(w), len(gone), kept))
    return sorted(out, key=repr)


def test_exactly_the_repeated_windows_go(table, chance):
    pool = [" ".join(chance.choice("abcdef") for _ in range(chance.randint(5, 40))) for _ in range(30)]

    def text():
        fresh = ["".join(chance.choice("xyz") for _ in range(4)) for _ in range(12)]
        return " ".join(chance.choice(pool if chance.random() < 0.6 else fresh) for _ in range(chance.randint(0, 12)))

    rows = [(i, text()) for i in range(250)] + ODD
    rows += [(950, "q " * 100), (951, "a b c d e f g " * 20), (952, "n o p q r s t u v w x y z")]
    for size in (1, 7, 12, 70):
        found = sorted((tuple(r) for r in repeats.remove(table(*rows), size).collect()), key=repr)
        assert found == plain(rows, size)
    assert repeats.remove(table(*rows).limit(0), 7).collect() == []


def test_leftmost_least(chance):
    import numpy as np

    for width in range(1, 30):
        values = np.array([chance.randint(0, 5) for _ in range(80)], np.uint64)
        wanted = [s + int(np.argmin(values[s : s + width])) for s in range(len(values) - width + 1)]
        assert repeats._leftmost_least(values, width).tolist() == wanted
