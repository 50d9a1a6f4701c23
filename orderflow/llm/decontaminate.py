"""Benchmark decontamination (operator 3).

A window as long as a benchmark item matches it when at most one word in five must be inserted,
deleted or replaced to turn one into the other. A CGK random walk copies a word sequence and
repeats words as it goes, by bits drawn from step and word, so sequences that differ by few
edits fall into step again: edit distance becomes Hamming distance. Sampled places of the walk
are the bands of a locality-sensitive hash, repeated with fresh walks until a pair within the
distance is met with the wanted recall; what meets is verified by its exact edit distance.

Windows that cannot match are not walked: an edit changes RUN runs of RUN words at most, so a
window in which fewer runs than that leaves occur in any item is out. That is exact.

A window may hang over either end of its text by as many words as may be edited, and counts by
the words it has. Such windows are few, so they are not walked: they are compared with every item
that shares so many runs with them. That is exact, too.

Items of fewer than LEAST_WORDS words are left out, or with short searched for as they are, every
word equal. A character of a script written without spaces counts as a word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import filter_rows, map_batches, mixed, texts_of
from orderflow.llm.words import gram_hashes, word_blocks

# Everything in ASCII but letters and digits separates words; letters are lower-cased.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
EDITS_PERCENT = 20
# An item of fewer words is no evidence if edited: common phrases would match it.
LEAST_WORDS = 8
# Places sampled for a band, bands of a walk, and the share of places in which the walks of a
# pair within the distance differ, at the shift that aligns them best.
PLACES = 2
BANDS = 2
DIFFERING = 0.6
RECALL = 0.99
# Items searched at once: what is broadcast is bounded, more items take more passes.
ITEMS_PER_PASS = 20_000
# Words of a run, and runs counted together when texts without a match are left out.
RUN = 3
GROUP = 13
# Bits of a run's hash looked up before the run itself.
HINT_BITS = 22
# Walks stretch a sequence to about twice its length; places up to this many times it are sampled.
STRETCH = 1.7


def walks_needed(recall: float = RECALL) -> int:
    """So many walks that a pair meets in one band at least, with the wanted probability."""
    return math.ceil(math.log(1 - recall) / (BANDS * math.log(1 - (1 - DIFFERING) ** PLACES)))


def walk(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """The symbols that the walk of each window passes: a row a step, 0 beyond the end."""
    steps = math.ceil(STRETCH * int(sizes.max()))
    odd = mixed(np.arange(1, steps + 1, dtype=np.uint64) + np.uint64(seed << 32))
    out = np.zeros((steps, len(starts)), np.uint64)
    at = np.zeros(len(starts), np.int64)
    for step in range(steps):
        inside = at < sizes
        symbol = np.where(inside, hashes[starts + np.minimum(at, sizes - 1)], np.uint64(0))
        out[step] = symbol
        at += inside & (mixed(symbol ^ odd[step]) >> np.uint64(63) == 1)
    return out


def bands(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The band hashes of the windows, walk by walk and band by band. The same shares of the
    walk are sampled for all windows, and windows of different sizes never meet."""
    for seed in range(walks_needed()):
        symbols = walk(hashes, starts, sizes, seed)
        draw = np.random.default_rng(seed)
        for band in range(BANDS):
            key = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band)
            for share in np.sort(draw.random(PLACES)).tolist():
                step = (share * STRETCH * sizes).astype(np.int64)
                key = mixed(key * np.uint64(3) + symbols[step, np.arange(len(starts))])
            yield key


def edit_distance(one: list, other: list) -> int:
    """Insertions, deletions and replacements."""
    return edit_distances(one, other)[-1]


def edit_distances(one: list, other: list) -> list[int]:
    """Those from one to other[:k] for each k, a whole column of the table at a time in the bits
    of integers."""
    n = len(one)
    if not n:
        return list(range(len(other) + 1))
    full, top = (1 << n) - 1, 1 << (n - 1)
    where: dict = {}
    for place, symbol in enumerate(one):
        where[symbol] = where.get(symbol, 0) | 1 << place
    plus, minus, scores = full, 0, [n]
    for symbol in other:
        equal = where.get(symbol, 0)
        across = (((equal & plus) + plus) ^ plus) | equal | minus
        up = minus | ~(across | plus) & full
        down = plus & across
        scores.append(scores[-1] + (up & top != 0) - (down & top != 0))
        up = (up << 1 | 1) & full
        down = down << 1 & full
        fresh = equal | minus
        plus = down | ~(fresh | up) & full
        minus = up & fresh
    return scores


@dataclass
class Items:
    """The items of a pass, ready to be searched for. Run r is in the items
    holders[held[r]:held[r + 1]]; brief has the sorted hashes of items under LEAST_WORDS and
    which they are, by size. All else is of the longer ones, which come first."""

    ids: list
    words: list[np.ndarray]
    runs: np.ndarray
    owner: np.ndarray
    held: np.ndarray
    holders: np.ndarray
    sizes: list[int]
    tables: list[tuple[np.ndarray, np.ndarray]]
    brief: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, ids: list, texts: list[str], short: bool = False) -> Items:
        column = pc.utf8_lower(pa.array(texts, pa.string()))
        words = []
        for _, _, block in word_blocks(column, separators=SEPARATORS, unspaced=True):
            hashes = block.hashes()
            words += [hashes[a:b] for a, b in zip(block.first, block.first[1:])]
        kept = [k for k, w in enumerate(words) if len(w) >= LEAST_WORDS]
        few = [k for k, w in enumerate(words) if 0 < len(w) < LEAST_WORDS and short]
        brief = {}
        for size in {len(words[k]) for k in few}:
            which = np.array([n for n, k in enumerate(few, len(kept)) if len(words[k]) == size])
            keys = np.concatenate([gram_hashes(words[few[n - len(kept)]], size) for n in which])
            brief[size] = keys[np.argsort(keys)], which[np.argsort(keys)]
        ids, words, few = [ids[k] for k in kept + few], [words[k] for k in kept], [words[k] for k in few]
        sizes = np.array([len(w) for w in words], np.int64)
        runs, owner, tables = np.zeros(0, np.uint64), np.zeros(0, int), []
        held, holders = np.zeros(1, int), np.zeros(0, int)
        if words:
            found = [gram_hashes(w, RUN) for w in words]
            owned = np.repeat(sizes, [len(f) for f in found])
            runs, which = np.unique(np.concatenate(found), return_inverse=True)
            owner = np.full(len(runs), -1)
            owner[which] = owned
            # A run of items of several sizes counts for every size.
            owner[which[owner[which] != owned]] = -1
            mine = np.repeat(np.arange(len(words)), [len(f) for f in found])
            whose, holders = np.divmod(np.unique(which * len(words) + mine), len(words))
            held = np.searchsorted(whose, np.arange(len(runs) + 1))
            for keys in bands(np.concatenate(words), np.cumsum(sizes) - sizes, sizes):
                order = np.argsort(keys)
                tables.append((keys[order], order))
        return cls(
            ids, words + few, runs, owner, held, holders, sorted(set(sizes.tolist())), tables, brief
        )

    def needed(self, size: int) -> int:
        """Runs of some item that a matching window of this size has at least."""
        return size - RUN + 1 - RUN * (size * EDITS_PERCENT // 100)

    def candidates(self, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> set:
        """(window, item) that meet in a band."""
        met = set()
        for at in range(0, len(starts), 1 << 13):
            part = slice(at, at + (1 << 13))
            for keys, (held, items) in zip(bands(hashes, starts[part], sizes[part]), self.tables):
                first, end = np.searchsorted(held, keys), np.searchsorted(held, keys, "right")
                for window in np.flatnonzero(end > first).tolist():
                    met.update((at + window, item) for item in items[first[window] : end[window]].tolist())
        return met

    def _sharing(self, window: np.ndarray, size: int) -> list[int]:
        """The items of this size that share so many runs with the window as a match does."""
        runs = gram_hashes(window, RUN)
        near = np.minimum(np.searchsorted(self.runs, runs), len(self.runs) - 1)
        near = near[self.runs[near] == runs]
        items = [self.holders[a:b] for a, b in zip(self.held[near], self.held[near + 1])]
        shared, n = np.unique(np.concatenate(items), return_counts=True)
        return [item for item in shared[n >= self.needed(size)].tolist() if len(self.words[item]) == size]

    def _overhanging(
        self, hashes: np.ndarray, text: np.ndarray, total: np.ndarray, size: int
    ) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, start, size) of the best window over the beginning and over the
        end of each text; total counts the runs of items of this size."""
        edits = size * EDITS_PERCENT // 100
        first = np.flatnonzero(np.diff(text, prepend=-1))
        end = np.append(first[1:], len(text))[: len(first)]
        length = np.minimum(end - first, size - 1)
        long_enough = length >= size - edits
        first, end, length = first[long_enough], end[long_enough], length[long_enough]
        for start, step in ((first, 1), (end - length, -1)):
            enough = total[start + length - RUN + 1] - total[start] >= self.needed(size)
            for a, n in zip(start[enough].tolist(), length[enough].tolist()):
                for item in self._sharing(hashes[a : a + n], size):
                    wanted, mine = self.words[item].tolist(), hashes[a : a + n].tolist()
                    scores = edit_distances(wanted[::step], mine[::step])
                    ends = [(scores[m], a if step > 0 else a + n - m, m) for m in range(size - edits, n + 1)]
                    if min(ends)[0] <= edits:
                        yield int(text[a]), item, *min(ends)

    def _dense(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, the size of the items with the run that starts there (0: none, -1: several), and
        text, of the texts that have
        GROUP runs in a row of which so many are in some item as a group of any match has."""
        least = min(-(-self.needed(s) // -(-(s - RUN + 1) // GROUP)) for s in self.sizes)
        hint = np.zeros(1 << HINT_BITS, bool)
        hint[(self.runs >> np.uint64(64 - HINT_BITS)).astype(np.int64)] = True
        kept = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at, _, words in word_blocks(pc.utf8_lower(column), separators=SEPARATORS, unspaced=True):
            hashes, text = words.hashes(), words.text_of()
            if len(hashes) < RUN:
                continue
            runs = gram_hashes(hashes, RUN)
            seen = np.zeros(len(hashes), np.int64)
            maybe = np.flatnonzero(hint[(runs >> np.uint64(64 - HINT_BITS)).astype(np.int64)])
            near = np.minimum(np.searchsorted(self.runs, runs[maybe]), len(self.runs) - 1)
            seen[maybe] = np.where(self.runs[near] == runs[maybe], self.owner[near], 0)
            total = np.append(0, np.cumsum(seen != 0))
            ends = np.minimum(np.arange(len(seen)) + GROUP, len(seen))
            chosen = np.zeros(len(words.first) - 1, bool)
            chosen[text[total[ends] - total[:-1] >= least]] = True
            mine = chosen[text]
            kept.append((hashes[mine], seen[mine], text[mine] + at))
        return tuple(np.concatenate(parts) for parts in zip(*kept))

    def _as_they_are(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, start, size, 0) of the first place of each item under LEAST_WORDS."""
        for at, _, words in word_blocks(pc.utf8_lower(column), separators=SEPARATORS, unspaced=True):
            hashes, text = words.hashes(), words.text_of()
            for size, (keys, items) in self.brief.items():
                grams = gram_hashes(hashes, size)
                first, end = np.searchsorted(keys, grams), np.searchsorted(keys, grams, "right")
                places = np.flatnonzero(end > first)
                places = places[text[places] == text[places + size - 1]]
                _, one = np.unique(text[places] * len(keys) + first[places], return_index=True)
                for place in places[one].tolist():
                    start = place - int(words.first[text[place]])
                    for item in items[first[place] : end[place]].tolist():
                        if (hashes[place : place + size] == self.words[item]).all():
                            yield at + int(text[place]), item, start, size, 0

    def matches(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, size, distance) of the best window for each text and item."""
        return sorted([*self._alike(column), *(self._as_they_are(column) if self.brief else ())])

    def _alike(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """matches of the items of LEAST_WORDS or more."""
        if not self.sizes:
            return []
        hashes, seen, text = self._dense(column)
        starts, sizes = [], []
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for size in self.sizes:
            total = np.append(0, np.cumsum((seen == size) | (seen == -1)))
            for at, item, *found in self._overhanging(hashes, text, total, size):
                best[at, item] = min(tuple(found), best.get((at, item), tuple(found)))
            at = np.arange(max(0, len(hashes) - size + 1))
            at = at[total[at + size - RUN + 1] - total[at] >= self.needed(size)]
            at = at[text[at] == text[at + size - 1]]
            starts.append(at)
            sizes.append(np.full(len(at), size))
        starts, sizes = np.concatenate(starts), np.concatenate(sizes)
        for window, item in self.candidates(hashes, starts, sizes):
            start, size = int(starts[window]), int(sizes[window])
            mine, wanted = hashes[start : start + size], self.words[item]
            same = len(wanted) == size and (wanted == mine).all()
            distance = 0 if same else edit_distance(wanted.tolist(), mine.tolist())
            if distance <= len(wanted) * EDITS_PERCENT // 100:
                key, found = (int(text[start]), item), (distance, start, size)
                best[key] = min(found, best.get(key, found))
        first = np.searchsorted(text, np.arange(len(column)))
        return [
            (at, item, start - int(first[at]), size, distance)
            for (at, item), (distance, start, size) in sorted(best.items())
        ]


def _passes(items: DataFrame, id_col: str, text_col: str, short: bool) -> Iterator[Items]:
    """The items in blocks that the driver and each task hold at once; null texts are empty."""
    rows = items.select(
        items[id_col].cast("long").alias("item_id"),
        F.coalesce(items[text_col].cast("string"), F.lit("")).alias("text"),
    ).dropDuplicates()
    block: list = []
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        block.append(row)
        if len(block) == ITEMS_PER_PASS:
            yield Items.of([r["item_id"] for r in block], [r["text"] for r in block], short)
            block = []
    if block:
        yield Items.of([r["item_id"] for r in block], [r["text"] for r in block], short)


def find(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", short: bool = False,
) -> DataFrame:
    """doc_id, item_id, start, n_words, distance: for each row of docs and item that occurs in
    it, the window with the smallest distance, the first of equal ones; start and n_words count
    words of the text, so n_words is less than the item's where the window hangs over an end.

    A null or empty text holds nothing; repeated rows are reported each; an item without
    LEAST_WORDS words matches nothing, or with short its very words; empty tables give an empty result; other columns are left
    out.
    """
    texts = texts_of(docs, id_col, text_col)
    schema = "doc_id long, item_id long, start int, n_words int, distance int"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _passes(items, item_id_col, item_text_col, short):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[dict]:
            names = ("item_id", "start", "n_words", "distance")
            for batch in batches:
                found = held.value.matches(batch["text"])
                rows = [(held.value.ids[item], *rest) for _, item, *rest in found]
                columns = zip(*rows) if rows else [[]] * 4
                doc_ids = batch["doc_id"].take(pa.array([f[0] for f in found], pa.int64()))
                yield {"doc_id": doc_ids, **dict(zip(names, columns))}

        out = out.unionByName(map_batches(texts, run, schema))
    return out


def clean(
    docs: DataFrame, items: DataFrame, text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", short: bool = False,
) -> DataFrame:
    """The rows of docs, with all their columns, in which no item occurs, as find tells. Nothing is
    shuffled."""
    for block in _passes(items, item_id_col, item_text_col, short):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batch: pa.RecordBatch, held=held) -> np.ndarray:
            column = batch[text_col].cast(pa.string()).fill_null("")
            kept = np.ones(len(column), bool)
            kept[[found[0] for found in held.value.matches(column)]] = False
            return kept

        docs = filter_rows(docs, keep)
    return docs
