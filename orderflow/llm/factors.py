"""Substring dedup by longest previous factors (operator 11): of equal runs of bytes the first stays.

In suffix order, the suffixes most like one suffix stand next to it. Of those that start earlier
in the corpus, the nearest before and after it (the previous and the next smaller position) have
the longest common prefixes, and the longer one is the longest previous factor. A string of
length bytes is a later copy where that factor is length or more.

One suffix array of the corpus would have to pass through one task, so suffixes that cannot share
so many bytes are kept apart. Each string has an anchor: of the short runs of bytes in it the one
with the smallest hash, the leftmost of equal ones. Equal strings have equal anchors at equal
places. Occurrences of an anchor whose whole surroundings are equal form a class: all but the
first are later copies altogether. The firsts of an anchor's classes meet in one bucket, and a
task builds the arrays of its buckets from their bytes. An anchor with more classes than a bucket
should hold has its strings dealt one by one instead: in a run of equal suffixes all but the
first have a previous smaller position.

Texts that are equal as a whole are told apart before all this, so that thousands of copies are
counted and not searched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import Bitmap, map_batches, mixed, saved, texts_of
from orderflow.llm.words import byte_values, blocks, column_bytes, power_pair, span_hashes

_NO_ID = -(2**63)
# Bytes whose 64-bit hashes, and what is made of them step by step, stay in a core's cache.
PIECE = 1 << 16
# Pieces whose rows are handed on together.
TOGETHER = 32
# Classes of an anchor that meet in one bucket.
MOST_CLASSES = 1000
# Copies of a row written by one step.
COPIES = 1_000_000


def anchor_bytes(length: int) -> int:
    return max(1, 2 * length // 5)


def sliding_least(values: np.ndarray, width: int, most: bool = False) -> np.ndarray:
    """The least (or most) of each run of width values, from runs twice as wide each time."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pick = np.maximum if most else np.minimum
    out, span = values, 1
    while 2 * span <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    return pick(out[:n], out[width - span : width - span + n])


def least_places(values: np.ndarray, width: int, starts: np.ndarray) -> np.ndarray:
    """For each start, where the least of the next width values is, the leftmost of equal ones."""
    if not len(starts):
        return starts
    least = sliding_least(values, width)
    # A value is the least of some run if it is the most that a run holding it has as least.
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    chosen = sliding_least(around, width, most=True) == values
    before = np.cumsum(chosen) - chosen
    places = np.flatnonzero(chosen)
    at, wanted = before[starts], least[starts]
    left = np.flatnonzero(values[places[at]] != wanted)
    while len(left):
        at[left] += 1
        left = left[values[places[at[left]]] != wanted[left]]
    return places[at]


@dataclass
class Piece:
    """Part of a batch: bytes of whole texts, or a stretch of one long text. Text i of the piece is
    row rows[i], at data[first[i]:end[i]]; its byte first[i] is byte shift of the text; strings
    starting from lo up to before hi belong to the piece."""

    data: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    end: np.ndarray
    shift: int
    lo: int
    hi: int


def pieces(column: pa.Array, length: int) -> Iterator[Piece]:
    data, offsets = column_bytes(column)
    # What comes along with a stretch is a small part of it.
    size = max(PIECE, 16 * length)
    for at, upto in blocks(offsets, size):
        start, end = int(offsets[at]), int(offsets[upto])
        if end - start <= 2 * size or upto - at > 1:
            edges = offsets[at : upto + 1] - start
            yield Piece(data[start:end], np.arange(at, upto), edges[:-1], edges[1:], 0, 0, end - start)
            continue
        # What surrounds the strings of a stretch comes along on both sides.
        for lo in range(start, end, size):
            hi = min(end, lo + size)
            left, right = max(start, lo - length), min(end, hi + 2 * length)
            whole = np.array([right - left])
            yield Piece(data[left:right], np.array([at]), whole * 0, whole, left - start, lo - left, hi - left)


class Anchors:
    """The anchors of a piece: place, hash, row of the batch, and the first and last of the strings
    that have it (all places in the piece)."""

    def __init__(self, piece: Piece, length: int):
        size = anchor_bytes(length)
        self.piece, self.length, self.width = piece, length, length - size + 1
        self.values = byte_values(piece.data)
        n = max(0, len(piece.data) - size + 1)
        up, down = power_pair(len(piece.data) + 1)
        sums = np.zeros(len(piece.data) + 1, np.uint64)
        np.cumsum(self.values * up[:-1], out=sums[1:])
        grams = mixed((sums[size:] - sums[: len(sums) - size]) * down[:n]) if n else sums[:0]
        room = np.zeros(len(piece.data) + 1, np.int32)
        long = piece.end - piece.first >= length
        np.add.at(room, np.maximum(piece.first, piece.lo)[long], 1)
        np.add.at(room, np.maximum(np.maximum(piece.first, piece.lo), np.minimum(piece.end - length + 1, piece.hi))[long], -1)
        starts = np.flatnonzero(np.cumsum(room[:-1]) > 0)
        place = least_places(grams, self.width, starts)
        fresh = np.flatnonzero(np.diff(place, prepend=-1) != 0)
        self.place = place[fresh]
        self.first = starts[fresh]
        self.last = starts[np.append(fresh[1:], len(starts))[: len(fresh)] - 1]
        # The least of many hashes are small numbers; hashed again, they fill a bitmap evenly.
        self.hash = mixed(grams[self.place] ^ np.uint64(0xA0761D6478BD642F))
        self.text = np.searchsorted(piece.first, self.place, "right") - 1
        self.left = np.maximum(self.place - self.width + 1, piece.first[self.text])
        self.right = np.minimum(self.place + length, piece.end[self.text])

    def surroundings(self, kept: np.ndarray) -> np.ndarray:
        """A hash of all bytes that strings with the anchor can cover, and its place in them."""
        left = self.left[kept]
        inner = (self.place[kept] - left).astype(np.uint64)
        return mixed(span_hashes(self.values, left, self.right[kept]) + inner)

    def marks(self, keys: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """A hash that tells the occurrence from others; keys has one for each row of the batch."""
        key = keys[self.piece.rows[self.text[kept]]].astype(np.uint64)
        return mixed(key + self.inner(self.place[kept], kept).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def inner(self, places: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """Places in the piece as places in the text."""
        return places - self.piece.first[self.text[kept]] + self.piece.shift


@dataclass(frozen=True)
class Heads:
    """Which rows stand for all rows of an equal text, by the hash in column mark. Rows that are
    repeated as a whole pass once a task."""

    firsts: Bitmap
    many: Bitmap

    def of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            marks = batch["mark"].to_numpy()
            good = self.firsts.has(marks)
            for i in np.flatnonzero(good & self.many.has(marks)):
                key = tuple(batch[name][i].as_py() for name in ("d", "t", "u"))
                good[i] = key not in seen
                seen.add(key)
            yield batch.filter(pa.array(good))


def _anchored(
    texts: DataFrame, heads: Heads, length: int, schema: str, rows: Callable, *bitmaps: Bitmap
) -> DataFrame:
    """What rows(batch, anchors, *bitmaps) makes of each piece of the texts that stand for others."""
    held = texts.sparkSession.sparkContext.broadcast((heads, bitmaps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        heads, bitmaps = held.value
        found: list[dict] = []
        for batch in heads.of(batches):
            for piece in pieces(batch["text"], length):
                made = rows(batch, Anchors(piece, length), *bitmaps)
                found += [] if made is None else [made]
                if len(found) == TOGETHER:
                    yield _joined(found)
                    found = []
        if found:
            yield _joined(found)

    return map_batches(texts.select("d", "t", "u", "mark", "text"), run, schema)


def _joined(parts: list[dict]) -> dict:
    """The columns of all parts, one after another."""
    together = {name: [part[name] for part in parts] for name in parts[0]}
    return {
        name: np.concatenate(columns) if isinstance(columns[0], np.ndarray) else list(chain(*columns))
        for name, columns in together.items()
    }


def _tops(batch: pa.RecordBatch, found: Anchors) -> dict:
    tops, counts = np.unique((found.hash >> np.uint64(32)).astype(np.uint32), return_counts=True)
    return {"top": tops.view(np.int32), "n": counts}


def _named(batch: pa.RecordBatch, found: Anchors, kept: np.ndarray) -> dict:
    row = found.piece.rows[found.text[kept]]
    return {name: batch[name].to_numpy()[row] for name in ("d", "t")}


def _occurrences(batch: pa.RecordBatch, found: Anchors, seeds: Bitmap) -> dict:
    kept = np.flatnonzero(seeds.has(found.hash))
    return _named(batch, found, kept) | {
        "anchor": found.hash[kept].view(np.int64),
        "around": found.surroundings(kept).view(np.int64),
        "mark": found.marks(batch["mark"].to_numpy(), kept).view(np.int64),
        "at": found.inner(found.place[kept], kept),
        "first": found.inner(found.first[kept], kept),
        "last": found.inner(found.last[kept], kept),
    }


def _contexts(batch: pa.RecordBatch, found: Anchors, several: Bitmap, ones: Bitmap, hot: Bitmap) -> dict | None:
    """The surroundings themselves, of the firsts of classes that meet others."""
    kept = np.flatnonzero(several.has(found.hash) & ~hot.has(found.hash))
    kept = kept[ones.has(found.marks(batch["mark"].to_numpy(), kept))]
    if not len(kept):
        return None
    data = found.piece.data.tobytes()
    return _named(batch, found, kept) | {
        "anchor": found.hash[kept].view(np.int64),
        "around": found.surroundings(kept).view(np.int64),
        "base": found.inner(found.left[kept], kept),
        "first": found.inner(found.first[kept], kept),
        "last": found.inner(found.last[kept], kept),
        "context": [data[a:b] for a, b in zip(found.left[kept].tolist(), found.right[kept].tolist())],
    }


def _strings(batch: pa.RecordBatch, found: Anchors, ones: Bitmap, hot: Bitmap) -> dict | None:
    """Each string of crowded anchors, by its hash."""
    kept = np.flatnonzero(hot.has(found.hash))
    kept = kept[ones.has(found.marks(batch["mark"].to_numpy(), kept))]
    if not len(kept):
        return None
    n = found.last[kept] - found.first[kept] + 1
    nth = np.repeat(np.arange(len(kept)), n)
    start = found.first[kept][nth] + np.arange(len(nth)) - np.repeat(np.cumsum(n) - n, n)
    return {name: column[nth] for name, column in _named(batch, found, kept).items()} | {
        "anchor": found.hash[kept][nth].view(np.int64),
        "string": span_hashes(found.values, start, start + found.length).view(np.int64),
        "start": found.inner(start, kept[nth]),
    }


def smaller_before(positions: np.ndarray) -> np.ndarray:
    """For each place, the last place before it with a smaller position, or -1."""
    at = np.arange(-1, len(positions) - 1)
    left = np.flatnonzero((at >= 0) & (positions[at] >= positions))
    while len(left):
        at[left] = at[at[left]]
        left = left[(at[left] >= 0) & (positions[at[left]] >= positions[left])]
    return at


def previous_factors(suffixes: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The longest previous factor of each suffix (a row of bytes, all of one length): the longest
    prefix it has in common with one of a smaller position. Equal positions are one suffix."""
    n, length = suffixes.shape
    order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{length}").ravel(), kind="stable")
    ranked = positions[order]
    before = smaller_before(ranked)
    after = n - 1 - smaller_before(ranked[::-1])[::-1]
    factors = np.zeros(n, np.int64)
    for near in (before, after):
        some = np.flatnonzero((near >= 0) & (near < n))
        unlike = suffixes[order[some]] != suffixes[order[near[some]]]
        common = np.where(unlike.any(axis=1), unlike.argmax(axis=1), length)
        factors[order[some]] = np.maximum(factors[order[some]], common)
    return factors


def _late_in(rows: pa.Table, length: int) -> dict:
    """d, t, first, last: runs of strings that start earlier as well, of whole buckets."""
    anchor, around = (rows[name].to_numpy() for name in ("anchor", "around"))
    # Sorted, so the first of each class is its first occurrence.
    new = np.flatnonzero((np.diff(anchor, prepend=~anchor[:1]) != 0) | (np.diff(around, prepend=~around[:1]) != 0))
    rows = rows.take(new)
    d, t, base, first, last = (rows[name].to_numpy() for name in ("d", "t", "base", "first", "last"))
    data, offsets = column_bytes(rows["context"].combine_chunks())
    n = (last - first + 1).astype(np.int64)
    nth = np.repeat(np.arange(len(new)), n)
    start = first[nth] + np.arange(len(nth)) - np.repeat(np.cumsum(n) - n, n)
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    suffixes = windows[offsets[nth] + start - base[nth]]
    order = np.lexsort((start, t[nth], d[nth]))
    steps = np.zeros(len(nth), bool)
    for key in (start, t[nth], d[nth]):
        steps[1:] |= np.diff(key[order]) != 0
    positions = np.zeros(len(nth), np.int64)
    positions[order] = np.cumsum(steps)
    late = np.flatnonzero(previous_factors(suffixes, positions) >= length)
    cut = np.flatnonzero((np.diff(nth[late], prepend=-1) != 0) | (np.diff(start[late], prepend=-2) != 1))
    ends = np.append(cut[1:], len(late))[: len(cut)] - 1
    row = nth[late[cut]]
    return {"d": d[row], "t": t[row], "first": start[late[cut]], "last": start[late[ends]]}


def _late_in_buckets(contexts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            anchors = batch["anchor"].to_numpy()
            # The last bucket may go on in the next batch.
            cut = int(np.flatnonzero(anchors == anchors[-1])[0])
            if cut == 0 and held and held[-1]["anchor"][len(held[-1]) - 1].as_py() == anchors[0]:
                held.append(batch)
                continue
            held.append(batch.slice(0, cut))
            if sum(map(len, held)):
                yield _late_in(pa.Table.from_batches(held), length)
            held = [batch.slice(cut)]
        if held:
            yield _late_in(pa.Table.from_batches(held), length)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor", "around", "d", "t", "base")
    return map_batches(dealt, run, "d long, t long, first int, last int")


def later_strings(texts: DataFrame, heads: Heads, length: int) -> DataFrame:
    """d, t, first, last: runs of places in a text where strings of length bytes begin that also
    begin earlier, by (d, t, place)."""
    tops = _anchored(texts, heads, length, "top int, n long", _tops)
    tops = tops.groupBy("top").agg(F.sum("n").alias("n")).where("n > 1")
    seeds = Bitmap.of(tops, F.shiftleft(F.col("top").cast("long"), 32))
    met = "d long, t long, anchor long, around long, mark long, at int, first int, last int"
    met = saved(_anchored(texts, heads, length, met, _occurrences, seeds), "occurrences")
    one = F.min(F.struct("d", "t", "at", "mark")).alias("one")
    classes = saved(met.groupBy("anchor", "around").agg(one), "classes")
    anchors = saved(classes.groupBy("anchor").count().where("count > 1"), "anchors")
    several = Bitmap.of(anchors, "anchor")
    hot = Bitmap.of(anchors.where(F.col("count") > MOST_CLASSES), "anchor")
    ones = Bitmap.of(classes.select("one.mark"), "mark")

    columns = "d long, t long, anchor long, around long, base int, first int, last int, context binary"
    contexts = _anchored(texts, heads, length, columns, _contexts, several, ones, hot)
    columns = "d long, t long, anchor long, string long, start int"
    strings = saved(_anchored(texts, heads, length, columns, _strings, ones, hot), "strings")
    place = F.struct("d", "t", "start")
    earliest = saved(strings.groupBy("anchor", "string").agg(F.min(place).alias("one")), "earliest")
    crowded = strings.join(earliest, ["anchor", "string"]).where(place != F.col("one"))
    again = met.join(classes.select("anchor", "around", "one"), ["anchor", "around"])
    again = again.where(F.struct("d", "t", "at") != F.struct("one.d", "one.t", "one.at"))
    return (
        again.select("d", "t", "first", "last")
        .union(_late_in_buckets(contexts, length))
        .union(crowded.select("d", "t", F.col("start").alias("first"), F.col("start").alias("last")))
    )


def cut_out(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """What is left without the strings that begin in the runs; bytes removed, and their runs."""
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, last.astype(np.int64) + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
    return data[~gone].tobytes(), int(np.count_nonzero(gone)), runs


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _copies(groups: DataFrame) -> DataFrame:
    """All rows of groups but the first of each text, as rows that keep nothing."""
    n = F.col("copies") - F.col("is_first").cast("long")
    steps = groups.withColumn("left", n).where("left > 0")
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(left - 1) div {COPIES}"))))
    one = F.explode(F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("left") - F.col("step") * COPIES).cast("int")))
    rows = steps.select("doc_id", "n_bytes", one)
    return rows.select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(b"").alias("kept"),
    )


def remove(docs: DataFrame, length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: the UTF-8 bytes of a text without each byte
    covered by a string of length bytes that also starts earlier, in a row of a smaller doc_id or
    before in the same one; n_spans counts the runs of bytes removed.

    One row per row of docs. Strings are judged on the input and never cross rows. A null doc_id
    is the smallest; rows of equal doc_id are ordered by a hash of their texts, and of rows equal
    in both, one comes first. A null or empty text has no bytes; a text shorter than length stays;
    an empty table gives an empty one; other columns are left out. kept may end within a character.
    """
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col).select(
        "doc_id",
        F.col("text").cast("binary").alias("text"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("d"),
        F.xxhash64("text").alias("t"),
        F.xxhash64(F.lit(length), "text").alias("u"),
    )
    texts = texts.withColumn("mark", F.xxhash64("d", "t", "u"))
    short, long = texts.where(F.col("n_bytes") < length), texts.where(F.col("n_bytes") >= length)

    keys = ["doc_id", "n_bytes", "d", "t", "u", "mark"]
    counted = saved(long.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")), "counted")
    least = saved(counted.groupBy("t", "u").agg(F.min("d").alias("least")), "least")
    groups = saved(counted.join(least, ["t", "u"]).withColumn("is_first", F.expr("d = least")), "groups")
    firsts = groups.where("is_first")
    heads = Heads(Bitmap.of(firsts, "mark"), Bitmap.of(firsts.where("copies > 1"), "mark"))
    later = Bitmap.of(groups.where("NOT is_first"), "mark")

    spans = later_strings(long, heads, length).groupBy("d", "t")
    spans = saved(spans.agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans")
    verdict = saved(firsts.select("d", "t", "u", "mark").join(spans, ["d", "t"], "left"), "verdict")
    touched = Bitmap.of(verdict.where("spans IS NOT NULL"), "mark")
    held = spark.sparkContext.broadcast((heads, later, touched))

    def unclear(batch: pa.RecordBatch) -> np.ndarray:
        heads, later, touched = held.value
        marks = batch["mark"].to_numpy()
        return later.has(marks) | heads.many.has(marks) | touched.has(marks)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            batch = batch.filter(pa.array(~unclear(batch)))
            nothing = np.zeros(len(batch), np.int64)
            yield {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "kept": batch["text"]} | {
                "n_removed": nothing, "n_spans": nothing
            }

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in held.value[0].of(batches):
            batch = batch.filter(pa.array(unclear(batch)))
            packed = [pack(text) for text in batch["text"].to_pylist()]
            yield {name: batch[name] for name in ("doc_id", "d", "t", "u")} | {"packed": packed}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in (part for batch in batches for part in _parts(batch, 200)):
            edges, values = batch["spans"].fill_null([]).offsets.to_numpy(), batch["spans"].fill_null([]).values
            first, last = (values.field(name).to_numpy() for name in ("first", "last"))
            sizes, kept = [], []
            for i, packed in enumerate(batch["packed"].to_pylist()):
                data = np.frombuffer(unpack(packed), np.uint8)
                sizes.append(len(data))
                kept.append(cut_out(data, first[edges[i] : edges[i + 1]], last[edges[i] : edges[i + 1]], length))
            rest, removed, runs = zip(*kept)
            yield {"doc_id": batch["doc_id"], "n_bytes": sizes, "n_removed": removed, "n_spans": runs, "kept": rest}

    plain = map_batches(long.select("doc_id", "n_bytes", "text", "mark"), whole, SCHEMA)
    rest = map_batches(
        long.select("doc_id", "d", "t", "u", "mark", "text"), candidates, "doc_id long, d long, t long, u long, packed binary"
    )
    rest = rest.groupBy("doc_id", "d", "t", "u").agg(F.first("packed").alias("packed"))
    rest = rest.join(verdict.select("d", "t", "u", "spans"), ["d", "t", "u"]).select("doc_id", "packed", "spans")
    nothing = F.lit(0).cast("long")
    short = short.select("doc_id", "n_bytes", nothing, nothing, "text")
    return plain.union(short).union(map_batches(rest, cut, SCHEMA)).union(_copies(groups))


def _parts(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)
