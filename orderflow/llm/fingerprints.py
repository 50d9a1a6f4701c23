"""Lempel-Ziv phrase fingerprints (operator 2).

A text is parsed from left to right: each phrase is the shortest run of characters that is not
a phrase yet. Texts that compress well together share phrases, so the likeness of two phrase
sets, estimated from minimum-hash signatures, follows compression distance without compressing
pairs. The signature has one minimum for each of BINS ranges of the hash; a range without a
phrase borrows another range's minimum, in an order that is the same for all texts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import map_batches, ranges, texts_of
from orderflow.llm.words import slices, span_hashes

BINS = 128
_BIN_BITS = 7
# The order in which empty bins look for one that is not.
_PROBES = np.random.default_rng(7).permuted(np.tile(np.arange(BINS), (BINS, 1)), axis=1)


def phrase_ends(
    text: str, done: list[int] | None = None, phrases: set[str] | None = None
) -> list[int]:
    """Where the phrases end. What is left at the end, a phrase met before, is no phrase.

    done and phrases continue a parse of a common prefix."""
    ends = [] if done is None else done
    met = set() if phrases is None else phrases
    add, start, n = met.add, ends[-1] if ends else 0, len(text)
    for end in range(start + 1, n + 1):
        phrase = text[start:end]
        if phrase not in met:
            add(phrase)
            ends.append(end)
            start = end
    return ends


def edited_phrase_ends(text: str, ends: list[int], edited: str, shared: int) -> list[int]:
    """phrase_ends of a text that begins with the same shared characters as another one, whose
    phrase ends are known."""
    kept = ends[: bisect_right(ends, shared)]
    met = {text[start:end] for start, end in zip([0, *kept], kept)}
    return phrase_ends(edited, kept, met)


def signature(text: str, ends: list[int]) -> np.ndarray:
    """BINS bytes; a text without phrases has none."""
    if not ends:
        return np.zeros(0, np.uint8)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    ends = np.array(ends)
    hashes = np.sort(span_hashes(points[: ends[-1]], np.append(0, ends[:-1]), ends))
    bins = (hashes >> np.uint64(64 - _BIN_BITS)).astype(np.int64)
    first = np.searchsorted(bins, np.arange(BINS))
    held = np.minimum(first, len(bins) - 1)
    full = bins[held] == np.arange(BINS)
    # Of each bin's minimum, eight bits below those that all small hashes share.
    values = (hashes[held] >> np.uint64(24)).astype(np.uint8)
    if not full.all():
        empty = np.flatnonzero(~full)
        donors = _PROBES[empty]
        values[empty] = values[donors[np.arange(len(empty)), full[donors].argmax(axis=1)]]
    return values


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of equal minima, less what eight bits make equal by chance; from 0 to 1.
    Two texts without phrases are alike, one with and one without are not."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    equal = float((one == other).mean())
    return max(0.0, (equal - 1 / 256) / (1 - 1 / 256))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex). One row per row of docs; a null or empty text has the empty
    fingerprint, equal texts have equal ones, other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch):
                texts = part["text"].to_pylist()
                prints = [signature(text, phrase_ends(text)).tobytes().hex() for text in texts]
                yield {"doc_id": part["doc_id"], "fingerprint": prints}

    return map_batches(texts_of(docs, id_col, text_col), run, "doc_id long, fingerprint string")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, packed: texts compressed, as they are about to be shuffled whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch):
                packed = [pack(text.encode()) for text in part["text"].to_pylist()]
                yield {"doc_id": part["doc_id"], "packed": packed}

    return map_batches(docs, run, "doc_id long, packed binary")


def _in_descending_ranges(docs: DataFrame) -> DataFrame:
    """range (int), later, doc_id, packed, in partitions that hold whole ranges of doc_id, each
    sorted by range and descending doc_id. Each range ends with a copy, marked later, of the row
    that the next range begins with, and the last one with a copy of the first row of all.

    The bounds are quantiles of doc_id and the driver sees two numbers a range.
    """
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    below = ranges(docs, key)
    at = lambda k: below.width - 1 - below.of(k)  # noqa: E731  range 0 has the largest ids
    ids = docs.select(key.alias("k"))
    tops = dict(ids.groupBy(at(F.col("k")).alias("r")).agg(F.max("k")).collect())
    held = sorted(tops)
    keys = F.array(*[F.lit(tops[r]) for r in held]).cast("array<long>")
    before = F.array(*[F.lit(held[i - 1]) for i in range(len(held))]).cast("array<int>")
    place = F.array_position(keys, F.col("k")).cast("int")
    rows = _packed(docs).withColumn("k", key).select(
        "doc_id",
        "packed",
        "k",
        F.inline(
            F.filter(
                F.array(
                    F.struct(at(F.col("k")).alias("range"), F.lit(False).alias("later")),
                    F.struct(F.try_element_at(before, F.nullif(place, F.lit(0))).alias("range"), F.lit(True).alias("later")),
                ),
                lambda copy: copy.range.isNotNull(),
            )
        ),
    )
    dealt = rows.repartitionById(len(held) or 1, F.pmod(F.col("range"), F.lit(max(1, len(held)))))
    ordered = dealt.sortWithinPartitions("range", "later", F.desc("k"), "packed")
    return ordered.select("range", "later", "doc_id", "packed")


def edited_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document by descending doc_id
    (after the last comes the first): doc_id, n_chars, edited_text_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many,
    or all, of the next document. Rows of equal doc_id are ordered by their compressed texts; a null doc_id is
    the smallest; a document that is alone is its own next.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = None
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                out = []
                rows = zip(*(part[name].to_pylist() for name in ("range", "later", "doc_id", "packed")))
                for number, later, doc_id, packed in rows:
                    text = unpack(packed).decode()
                    follows = held is not None and held[0] == number
                    if follows or not later:
                        ends = phrase_ends(text)
                        after = signature(text, ends)
                    if follows:
                        out.append(compared(*held[1:], text, after))
                    # Of several rows of the next range's first doc_id, the first counts.
                    held = None if later else (number, doc_id, text, ends, after)
                yield dict(zip(NAMES, zip(*out))) if out else {name: [] for name in NAMES}

    def compared(doc_id, text: str, ends: list, one: np.ndarray, following: str, after) -> tuple:
        n = len(text)
        kept = n - n // 3
        edited = text[:kept] + following[: n // 3]
        changed = signature(edited, edited_phrase_ends(text, ends, edited, kept))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        prints = one.tobytes().hex(), changed.tobytes().hex()
        return (doc_id, n, sha, *prints, likeness(one, changed), likeness(one, after))

    rows = _in_descending_ranges(texts_of(docs, id_col, text_col))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_batches(rows, run, schema)


NAMES = (
    "doc_id",
    "n_chars",
    "edited_sha256",
    "fingerprint",
    "edited_fingerprint",
    "near_edited",
    "near_next",
)
