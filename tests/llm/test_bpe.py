import base64

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from orderflow.llm import bpe
from orderflow.llm.queries import BYTE_BPE
from tests.llm.conftest import ODD

TEXTS = [
    "a", " a", "\na", "\n a", "a  b", "a\n b", " ", "  ", "hello world's  \n\n x\t y  z",
    "aaaaaaaa" * 20, "\x1c \x85 a'll b'S", "日本語 テキスト ١٢٣ ²", "a \x1c b", "​ ﻿ x", "a" * 9000,
    "😀😀 é", "ab" * 3000 + " cd", "　x y",
]


@pytest.fixture(scope="module")
def vocabulary():
    with open(BYTE_BPE, "rb") as file:
        return bpe.Vocabulary(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=vocabulary.ranks,
        special_tokens={},
    )


def test_ids_are_those_of_the_public_library(vocabulary, reference, chance):
    texts = TEXTS + [
        "".join(chance.choice(["a", "the", " ", "  ", "\n", "'s", "é", "1", "#", "\t", "ing"]) for _ in range(80))
        for _ in range(300)
    ]
    for text, ids in zip(texts, vocabulary.encode_group(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)


def test_one_queue_for_many_gives_what_one_queue_each_gives(vocabulary, chance):
    pieces = [bytes(chance.choice(b"abcdeth ing") for _ in range(chance.randint(1, 30))) for _ in range(2000)]
    many = vocabulary.merge_many(pieces)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in many] == [vocabulary.merge(p) for p in pieces]


def test_a_merge_of_lower_rank_goes_first():
    """Ranks in which merging makes a pair that is due before others of its bucket."""
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {b"ab": 300, b"abab": 299, b"ba": 301, b"aba": 256}
    lines = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    own = bpe.Vocabulary(lines, r"\w+")
    other = tiktoken.Encoding("x", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    for piece in ("ab" * n + tail for n in range(1, 8) for tail in ("", "a", "b")):
        wanted = other.encode_ordinary(piece)
        assert own.merge(piece.encode()) == wanted
        assert np.frombuffer(own.merge_many([piece.encode()])[0], "<u4").tolist() == wanted


def test_queue_finds_the_lowest_rank(chance):
    queue, held = bpe.RankQueue(50_000), set()
    for _ in range(3000):
        if held and chance.random() < 0.5:
            assert queue.lowest() == min(held)
            queue.take(min(held))
            held.discard(min(held))
        else:
            rank = chance.randrange(50_000)
            queue.bucket(rank).append(0)
            held.add(rank)
    assert queue.lowest() == min(held, default=-1)


def test_classes_of_the_pattern_agree(reference):
    """Every character: the splitting library and the public encoder see the same pieces."""
    find = regex.compile(public_tokenizers.PATTERN).findall
    for start in range(0, 0x30000, 997):
        text = "".join(chr(c) for c in range(start, start + 997) if not 0xD800 <= c < 0xE000)
        cut = [reference.encode_ordinary(piece) for piece in find(text)]
        assert sum(cut, []) == reference.encode_ordinary(text)


def test_round_trip_of_odd_rows(table):
    docs = table(*ODD)
    both = bpe.decode(
        bpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN), BYTE_BPE, public_tokenizers.PATTERN
    )
    found = sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in both.collect())
    assert found == sorted((str(i), t or "") for i, t in ODD)
    assert bpe.encode(docs.limit(0), BYTE_BPE, public_tokenizers.PATTERN).collect() == []
