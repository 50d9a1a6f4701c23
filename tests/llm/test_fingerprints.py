import hashlib

from orderflow.llm import fingerprints
from tests.llm.conftest import ODD


def plain_phrases(text):
    met, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in met:
            met.add(text[start:end])
            start = end
    return met


def test_phrases_are_those_of_a_plain_parse(chance):
    for _ in range(200):
        text = "".join(chance.choice("abé") for _ in range(chance.randint(0, 80)))
        ends = fingerprints.phrase_ends(text)
        assert {text[a:b] for a, b in zip([0, *ends], ends)} == plain_phrases(text)
        kept = chance.randint(0, len(text))
        edited = text[:kept] + "ba" * 10
        assert fingerprints.edited_phrase_ends(text, ends, edited, kept) == fingerprints.phrase_ends(edited)


def test_likeness_follows_the_overlap_of_phrase_sets(chance):
    gaps = []
    for _ in range(60):
        one = "".join(chance.choice("abcdefgh ") for _ in range(4000))
        other = one[: chance.randint(0, 4000)] + "".join(chance.choice("abcdefgh ") for _ in range(2000))
        a, b = plain_phrases(one), plain_phrases(other)
        found = fingerprints.likeness(
            *(fingerprints.signature(t, fingerprints.phrase_ends(t)) for t in (one, other))
        )
        gaps.append(abs(found - len(a & b) / len(a | b)))
    assert sum(gaps) / len(gaps) < 0.05 and max(gaps) < 0.2


def test_against_the_edited_and_the_next_text(table, chance):
    rows = [(i * 3, "".join(chance.choice("ab c") for _ in range(chance.randint(0, 300)))) for i in range(150)]
    found = {r["doc_id"]: r for r in fingerprints.edited_with_next(table(*rows)).collect()}
    texts = dict(rows)
    order = sorted(texts, reverse=True)
    for doc_id, following in zip(order, order[1:] + order[:1]):
        text, n = texts[doc_id], len(texts[doc_id])
        edited = text[: n - n // 3] + texts[following][: n // 3]
        row = found[doc_id]
        assert row["n_chars"] == n
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == fingerprints.signature(text, fingerprints.phrase_ends(text)).tobytes().hex()
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
    assert sum(r["near_edited"] > r["near_next"] for r in found.values()) > 100


def test_odd_rows(table):
    found = fingerprints.edited_with_next(table(*ODD)).collect()
    assert len(found) == len(ODD)
    prints = {r["doc_id"]: r["fingerprint"] for r in found}
    assert prints[901] == prints[902] == "" and prints[904] == prints[905]
    alone = fingerprints.edited_with_next(table((5, "alone"))).first()
    assert alone["near_next"] == 1.0
    assert fingerprints.edited_with_next(table(*ODD).limit(0)).collect() == []
    plain = {(r["doc_id"], r["fingerprint"]) for r in fingerprints.fingerprint(table(*ODD)).collect()}
    assert plain == {(r["doc_id"], r["fingerprint"]) for r in found}
