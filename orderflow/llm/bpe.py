"""Byte-level BPE encoding and decoding (operator 1).

A pre-token is merged with a queue of merge ranks: each rank has a bucket of positions in a
linked list of tokens, and a bitmap of three levels of 64-bit words shows which buckets hold
any. Find-first-set on the three levels gives the lowest rank in constant time, so the work
follows the number of merges however long a pre-token is. An entry whose pair was merged away
meanwhile is stale and skipped. The pre-tokens of a batch that were not met before share one
queue, so that a bucket is merged with a few array operations.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderflow.llm.common import map_batches, texts_of
from orderflow.llm.words import blocks, column_bytes, slices

# Distinct chunks a worker keeps between groups of texts; pre-token bytes merged at a time; a
# longer pre-token gets a queue of its own.
CACHED = 200_000
MERGED_BYTES = 2 << 20
LONG_PIECE = 1 << 12
# White space other than the space and the line break.
_RARE_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class RankQueue:
    """Buckets of positions by merge rank, with the lowest rank that has any."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, for something to be put in."""
        found = self.buckets.get(rank)
        if found is None:
            found = self.buckets[rank] = []
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)
        return found

    def lowest(self) -> int:
        """Find-first-set on each level; -1 when nothing is left."""
        if not self.top:
            return -1
        high = (self.top & -self.top).bit_length() - 1
        word = self.mid[high]
        middle = high << 6 | ((word & -word).bit_length() - 1)
        word = self.low[middle]
        return middle << 6 | ((word & -word).bit_length() - 1)

    def take(self, rank: int) -> list:
        """Removes a bucket."""
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.mid[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.mid[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))
        return self.buckets.pop(rank)


class Vocabulary:
    """Byte strings and their ranks, as a rank file lists them: base64 of the bytes, rank.

    chunks keeps what was encoded before, across the batches of a worker.
    """

    def __init__(self, rank_file: bytes, pattern: str):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.size = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_sizes = np.array([len(token) for token in tokens], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.find = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)])
        self.pair_keys, self.pair_ranks = self._pairs()
        self.chunks: dict[str, bytes] = {}

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every two tokens that together are a token, sorted by their key."""
        ranks, width = self.ranks, self.size + 1
        found = {
            left * width + right: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None
            and (right := ranks.get(token[cut:])) is not None
        }
        keys = np.array(sorted(found), np.int64)
        return keys, np.array([found[key] for key in keys.tolist()], np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: the queue holds its positions one by one, and each bucket
        is a heap, since of equal ranks the leftmost goes first."""
        ranks, n = self.ranks, len(piece)
        queue = RankQueue(self.size)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_at = [-1] * n

        def enter(at: int, end: int) -> None:
            rank = ranks.get(piece[at:end], -1)
            rank_at[at] = rank
            if rank >= 0:
                heappush(queue.bucket(rank), at)

        for at in range(n - 1):
            enter(at, at + 2)
        while (rank := queue.lowest()) >= 0:
            bucket = queue.buckets[rank]
            at = heappop(bucket)
            if not bucket:
                queue.take(rank)
            if rank_at[at] != rank:
                continue
            gone = after[at]
            end = after[at] = after[gone]
            rank_at[gone] = rank_at[at] = -1
            if end < n:
                before[end] = at
                enter(at, after[end])
            if before[at] >= 0:
                enter(before[at], end)
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : after[at]]])
            at = after[at]
        return ids

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many pre-tokens as bytes, with one queue for all of them: a bucket holds
        arrays of positions in any of the pre-tokens and is merged as a whole.

        Within a pre-token that is the order of merge() unless a merge makes a pair of lower
        rank than its own; such pre-tokens, and very long ones, go through merge().
        """
        size = np.array([len(piece) for piece in pieces], np.int64)
        ends = np.cumsum(size)
        n = int(ends[-1]) if len(pieces) else 0
        # Position n stands for "none"; no pair has its id.
        token = np.append(self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)], self.size)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends[size > 0] - 1] = n
        before[(ends - size)[size > 0]] = n
        after[n] = before[n] = n
        alive = np.ones(n + 1, bool)
        rank_at = self._pair_rank(token, token[after])
        odd = np.zeros(len(pieces), bool)
        queue = RankQueue(self.size)

        def enter(at: np.ndarray, rank: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            firsts = [0, *cuts.tolist()]
            for first, end in zip(firsts, [*firsts[1:], len(at)]):
                queue.bucket(int(rank[first])).append(at[first:end])

        some = np.flatnonzero(rank_at >= 0)
        if len(some):
            enter(some, rank_at[some])
        while (rank := queue.lowest()) >= 0:
            parts = queue.take(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank_at[at] == rank]
            if not len(at):
                continue
            if len(at) > 1 and (after[at[:-1]] == at[1:]).any():
                at = _apart(at, after)
            gone = after[at]
            end = after[gone]
            token[at], after[at], before[end] = rank, end, at
            rank_at[gone] = -1
            alive[gone] = False
            left = before[at]
            places = np.concatenate([at, left])
            ranks = self._pair_rank(token[places], np.concatenate([token[end], token[at]]))
            rank_at[places] = ranks
            rank_at[n] = -1
            good = ranks >= 0
            if good.any():
                places, ranks = places[good], ranks[good]
                if (early := ranks < rank).any():
                    odd[np.searchsorted(ends, places[early], "right")] = True
                enter(places, ranks)
        alive[n] = False
        kept = np.flatnonzero(alive)
        ids = token[kept].astype("<u4")
        cuts = np.searchsorted(kept, np.append(0, ends))
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        out = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        for k in np.flatnonzero(odd).tolist():
            out[k] = np.array(self.merge(pieces[k]), "<u4").tobytes()
        return out

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pre-tokens."""
        whole = {piece: self.ranks.get(piece.encode(), -1) for piece in pieces}
        known = {p: rank.to_bytes(4, "little") for p, rank in whole.items() if rank >= 0}
        rest, queued, total = [], [], 0
        for piece in (piece for piece, rank in whole.items() if rank < 0):
            data = piece.encode()
            if len(data) > LONG_PIECE:
                known[piece] = np.array(self.merge(data), "<u4").tobytes()
                continue
            rest.append(piece)
            queued.append(data)
            total += len(data)
            if total >= MERGED_BYTES:
                known.update(zip(rest, self.merge_many(queued)))
                rest, queued, total = [], [], 0
        known.update(zip(rest, self.merge_many(queued)))
        return known

    def _parts(self, text: str) -> list[str]:
        """Chunks that can be encoded apart: the pattern never matches across a lone space but
        from it on, so a text without other white space beside its spaces is cut there. A first
        chunk that is not cut off so begins with the text's first character."""
        if not text:
            return []
        if (
            "  " in text
            or " \n" in text
            or "\n " in text
            or text[0] == " "
            or text[-1] == " "
            or _RARE_SPACE.search(text)
        ):
            return ["\n" + text]
        return ("\n" + text).split(" ")

    def encode_group(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        group = [self._parts(text) for text in texts]
        chunks, find = self.chunks, self.find
        fresh = set().union(*group).difference(chunks)
        # A chunk stands for itself behind the space it was cut at, or, marked by a line break,
        # for the beginning of a text.
        cut = [find(c[1:]) if c[:1] == "\n" else find(" " + c) for c in fresh]
        ids = self._learn(set().union(*cut)).__getitem__
        chunks.update(zip(fresh, [b"".join(map(ids, pieces)) for pieces in cut]))
        look = chunks.__getitem__
        out = [b"".join(map(look, parts)) for parts in group]
        if len(chunks) > CACHED:
            chunks.clear()
        return out

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of texts whose ids lie one after another, counts[k] for text k."""
        size = self.token_sizes[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ids) else 0
        source = np.repeat(self.token_starts[ids] - (ends - size), size) + np.arange(total)
        data = self.token_bytes[source].tobytes()
        cuts = np.append(0, ends)[np.append(0, np.cumsum(counts))].tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions whose pairs overlap, the leftmost first."""
    kept, blocked = [], -1
    for place, following in zip(at.tolist(), after[at].tolist()):
        if place != blocked:
            kept.append(place)
            blocked = following
    return np.array(kept, np.int64)


_loaded: dict[tuple[str, str], Vocabulary] = {}


def _vocabulary(rank_file: bytes, pattern: str) -> Vocabulary:
    """One per worker process."""
    key = (hashlib.sha256(rank_file).hexdigest(), pattern)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(rank_file, pattern)
    return _loaded[key]


def encode(
    docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit). One row per row of docs.

    A null or empty text has no ids. Repeated rows are encoded alike, a null doc_id stays null,
    an empty table gives an empty one, other columns are left out. The rank file is read by the
    driver and broadcast: its size is the vocabulary's, not the data's.
    """
    with open(rank_path, "rb") as file:
        rank_file = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        vocabulary = _vocabulary(rank_file.value, pattern)
        for batch in batches:
            for part in slices(batch):
                ids = vocabulary.encode_group(part["text"].to_pylist())
                yield {"doc_id": part["doc_id"], "ids": ids}

    return map_batches(texts_of(docs, id_col, text_col), run, "doc_id long, ids binary")


def decode(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids, decoded (binary): the bytes the ids stand for. Null ids count as none."""
    with open(rank_path, "rb") as file:
        rank_file = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        vocabulary = _vocabulary(rank_file.value, pattern)
        for batch in batches:
            data, offsets = column_bytes(batch["ids"].fill_null(b""))
            for at, upto in blocks(offsets):
                part = batch.slice(at, upto - at)
                ids = np.frombuffer(data[offsets[at] : offsets[upto]].tobytes(), "<u4")
                decoded = vocabulary.decode_all(ids, np.diff(offsets[at : upto + 1]) // 4)
                yield {"doc_id": part["doc_id"], "ids": part["ids"], "decoded": decoded}

    return map_batches(
        encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, decoded binary"
    )
