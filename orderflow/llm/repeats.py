"""Substring dedup by seed and extend (operator 9).

A window is min_words words of one text. Each window has an anchor: of the runs of a few words
in it, the one with the smallest hash, the leftmost of equal ones. Equal windows have equal
anchors at the same place, so texts that share a window meet where their anchors are joined.

An anchor's matches are extended both ways over all words that a window around it can cover.
Occurrences whose whole surroundings are equal form a class, and all its windows are repeated.
Where an anchor has several classes, one occurrence of each is compared with the others window
by window, which finds how far to the left and right the repeat goes. So thousands of copies
are one class, and work grows with the ends of repeats, not with pairs of occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import Bitmap, map_batches, mixed, saved, texts_of
from orderflow.llm.words import Words, gram_hashes, slices, span_hashes, word_blocks

_NO_ID = -(2**63)


def anchor_words(min_words: int) -> int:
    """Words of an anchor; the places it can have in a window fit the bits of a long."""
    return max(1, min_words // 3, min_words - 60)


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the least of the next width values is."""
    at = np.arange(len(values))
    have = 1
    while 2 * have <= width:
        left, right = at[:-have], at[have:]
        at = np.where(values[left] <= values[right], left, right)
        have *= 2
    if have < width:
        left, right = at[: len(at) - (width - have)], at[width - have :]
        at = np.where(values[left] <= values[right], left, right)
    return at


class Anchors:
    """The anchors of the texts of a block: place (a word), text, and the first and last of the
    windows that have it."""

    def __init__(self, words: Words, min_words: int):
        size = anchor_words(min_words)
        self.hashes, text = words.hashes(), words.text_of()
        self.words, self.min_words = words, min_words
        self.width = min_words - size + 1
        grams = gram_hashes(self.hashes, size)
        least = _leftmost_least(grams, self.width) if len(grams) >= self.width else np.zeros(0, int)
        starts = np.arange(len(least))
        kept = starts + min_words <= words.first[text[: len(least)] + 1]
        starts, least = starts[kept], least[kept]
        fresh = np.flatnonzero(np.diff(least, prepend=-1) != 0)
        self.place = least[fresh]
        self.first = starts[fresh]
        self.last = starts[np.append(fresh[1:], len(starts))[: len(fresh)] - 1]
        self.text = text[self.place]
        self.hash = grams[self.place]

    def surroundings(self) -> np.ndarray:
        """A hash of all words that windows with the anchor can cover, and its place in them."""
        first, end = self.words.first[self.text], self.words.first[self.text + 1]
        left = np.maximum(self.place - self.width + 1, first)
        right = np.minimum(self.place + self.min_words, end)
        return mixed(span_hashes(self.hashes, left, right) + (self.place - left).astype(np.uint64))

    def marks(self, k: np.ndarray) -> np.ndarray:
        """A hash that tells the occurrence from others; k has one for each text."""
        inner = (self.place - self.words.first[self.text]).astype(np.uint64)
        return mixed(k.astype(np.uint64)[self.text] + inner * np.uint64(0x9E3779B97F4A7C15))


def _seeds(texts: DataFrame, min_words: int) -> Bitmap:
    """Anchors that occur more than once, judged by half of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for _, _, words in word_blocks(batch["text"]):
                tops = Anchors(words, min_words).hash >> np.uint64(32)
                yield {"top": tops.astype(np.uint32).view(np.int32)}

    tops = map_batches(texts, run, "top int").groupBy("top").count().where("count > 1")
    return Bitmap.of(tops, F.shiftleft(F.col("top").cast("long"), 32))


def _occurrences(texts: DataFrame, min_words: int, seeds: Bitmap) -> DataFrame:
    """anchor, around, d, k, mark, place, lo, hi: the occurrences of anchors that are repeated,
    with the range of the anchor's place in its windows."""
    bitmap = texts.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids, keys = batch["d"].to_numpy(), batch["k"].to_numpy()
            for at, upto, words in word_blocks(batch["text"]):
                found = Anchors(words, min_words)
                kept = bitmap.value.has(found.hash)
                k = keys[at:upto]
                text = found.text[kept]
                yield {
                    "anchor": found.hash[kept].view(np.int64),
                    "around": found.surroundings()[kept].view(np.int64),
                    "d": ids[at:upto][text],
                    "k": k[text],
                    "mark": found.marks(k)[kept].view(np.int64),
                    "place": (found.place - words.first[found.text])[kept],
                    "lo": (found.place - found.last)[kept],
                    "hi": (found.place - found.first)[kept],
                }

    schema = "anchor long, around long, d long, k long, mark long, place int, lo int, hi int"
    return map_batches(texts, run, schema)


def _windows(texts: DataFrame, min_words: int, marks: Bitmap) -> DataFrame:
    """anchor, around, j, w: the windows of the marked occurrences; j is the anchor's place in
    the window, w the window's hash."""
    bitmap = texts.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keys = batch["k"].to_numpy()
            for at, upto, words in word_blocks(batch["text"]):
                found = Anchors(words, min_words)
                kept = np.flatnonzero(bitmap.value.has(found.marks(keys[at:upto])))
                if not len(kept):
                    continue
                around = found.surroundings()[kept]
                n = found.last[kept] - found.first[kept] + 1
                nth = np.repeat(np.arange(len(kept)), n)
                inner = np.arange(len(nth)) - np.repeat(np.cumsum(n) - n, n)
                start = found.first[kept][nth] + inner
                yield {
                    "anchor": found.hash[kept][nth].view(np.int64),
                    "around": around[nth].view(np.int64),
                    "j": found.place[kept][nth] - start,
                    "w": span_hashes(found.hashes, start, start + min_words).view(np.int64),
                }

    return map_batches(texts, run, "anchor long, around long, j int, w long")


def repeated_spans(docs: DataFrame, min_words: int) -> DataFrame:
    """d, k, spans: for each text with repeated windows, their starts as (place, lo, hi, mask):
    the windows place - j for the j from lo to hi whose bit is set in mask.

    docs has d, k and text; rows of equal d and k have equal text.
    """
    seeds = _seeds(docs, min_words)
    met = saved(_occurrences(docs, min_words, seeds), "occurrences")
    one = F.min(F.struct("mark")).alias("one")
    classes = saved(
        met.groupBy("anchor", "around").agg(F.count(F.lit(1)).alias("n"), one), "classes"
    )
    several = classes.groupBy("anchor").count().where("count > 1").select("anchor")
    open_classes = classes.join(several, "anchor")
    marks = Bitmap.of(open_classes.select("one.mark"), "mark")
    windows = saved(_windows(docs, min_words, marks), "windows")
    # The bitmap also lets occurrences of classes pass that have no rival; they meet nobody.
    shared = (
        windows.groupBy("anchor", "j", "w")
        .agg(F.min("around").alias("a0"), F.max("around").alias("a1"))
        .where("a0 <> a1")
        .select("anchor", "j", "w")
    )
    partly = (
        windows.join(shared, ["anchor", "j", "w"])
        .groupBy("anchor", "around")
        .agg(F.bit_or(F.expr("shiftleft(1L, j)")).alias("mask"))
    )
    whole = classes.where("n > 1").select("anchor", "around", F.lit(-1).cast("long").alias("mask"))
    verdict = whole.union(partly).groupBy("anchor", "around").agg(F.bit_or("mask").alias("mask"))
    found = met.join(verdict, ["anchor", "around"])
    return found.groupBy("d", "k").agg(
        F.collect_set(F.struct("place", "lo", "hi", "mask")).alias("spans")
    )


def covered(n: int, spans: list, min_words: int) -> np.ndarray:
    """Which of n words are in a window that one of the spans names."""
    change = np.zeros(n + 1, np.int64)
    for span in spans:
        lo, hi, place = span["lo"], span["hi"], span["place"]
        j = np.arange(lo, hi + 1)
        start = place - j[(span["mask"] >> j) & 1 == 1]
        np.add.at(change, start, 1)
        np.add.at(change, np.minimum(start + min_words, n), -1)
    return np.cumsum(change[:-1]) > 0


def remove(
    docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the text without each word covered by a window of
    min_words words that also starts anywhere else, joined by single spaces.

    One row per row of docs. Words are what stands between space and the control characters from
    tab to carriage return, unchanged; windows are judged on the input. A null or empty text has
    no words; a repeated row repeats all its windows; a text of fewer words keeps all; an empty
    table gives an empty one; other columns are left out.
    """
    texts = texts_of(docs, id_col, text_col)
    d = F.coalesce("doc_id", F.lit(_NO_ID))
    texts = texts.select("doc_id", "text", d.alias("d"), F.xxhash64("doc_id", "text").alias("k"))
    spans = saved(repeated_spans(texts.select("d", "k", "text"), min_words), "spans")
    touched = texts.sparkSession.sparkContext.broadcast(Bitmap.of(spans, "k"))
    schema = "doc_id long, n_words long, n_removed long, kept string"

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            batch = batch.filter(pa.array(~touched.value.has(batch["k"].to_numpy())))
            for part in slices(batch):
                texts = [text.encode().split() for text in part["text"].to_pylist()]
                yield {
                    "doc_id": part["doc_id"],
                    "n_words": [len(words) for words in texts],
                    "n_removed": [0] * len(texts),
                    "kept": [b" ".join(words).decode() for words in texts],
                }

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            batch = batch.filter(pa.array(touched.value.has(batch["k"].to_numpy())))
            yield {name: batch[name] for name in ("doc_id", "text", "d", "k")}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in (part for batch in batches for part in slices(batch)):
            counts, removed, kept = [], [], []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                words = text.encode().split()
                gone = covered(len(words), spans or [], min_words)
                counts.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode())
            yield {"doc_id": batch["doc_id"], "n_words": counts, "n_removed": removed, "kept": kept}

    plain = map_batches(texts.select("doc_id", "text", "k"), untouched, schema)
    rest = map_batches(texts, candidates, "doc_id long, text string, d long, k long")
    rest = rest.join(spans, ["d", "k"], "left").select("doc_id", "text", "spans")
    return plain.unionByName(map_batches(rest, cut, schema))
