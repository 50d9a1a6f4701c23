"""Phrase collocation mining by top-order marginalisation (operator 12).

Each word leads one window: itself and the next words of its piece of text, up to the longest
phrase, padded beyond the piece. Only these longest windows are counted. A phrase occurs once for
each window it begins, so ROLLUP over the window's columns, which sums successively shorter
prefixes, gives the counts of the phrases of every length; a prefix that ends in padding is none.

Windows are cut where a word, a pair or a triple is too rare to be in a candidate, which bitmaps
of fixed size tell; whatever passes them wrongly is counted and left out exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import Bitmap, map_batches, mixed, saved
from orderflow.llm.words import byte_span_hashes, column_bytes, word_blocks

# Full stop, comma, semicolon, colon, exclamation and question mark, and the line breaks.
PIECE_ENDS = b".,;:!?\n\v\f\r"
GAPS = b" \t"
NO_LANG = "und"


@dataclass
class Block:
    """The words of some texts: each one's number in the vocabulary, its language's number, and
    whether the next word follows in the same piece."""

    vocabulary: pa.Array
    languages: pa.Array
    word: np.ndarray
    lang: np.ndarray
    linked: np.ndarray

    @cached_property
    def _keys(self) -> tuple[np.ndarray, np.ndarray]:
        of_word, of_lang = (
            byte_span_hashes(data, offsets[:-1], offsets[1:])
            for data, offsets in (column_bytes(self.vocabulary), column_bytes(self.languages))
        )
        words, own = of_word[self.word], of_lang[self.lang]
        pairs = mixed(words * np.uint64(0x9E3779B97F4A7C15) + np.append(words[1:], words[:1]))
        return mixed(words ^ mixed(own)), mixed(pairs + own)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each word, and of each word and the next one, in its language."""
        return self._keys


def blocks_of(batch: pa.RecordBatch) -> Iterator[Block]:
    """The words of a batch with lang and text, about 2 MB of text at a time."""
    ends = np.zeros(256, bool)
    ends[list(PIECE_ENDS)] = True
    for at, upto, words in word_blocks(batch["text"], lower=True, separators=PIECE_ENDS + GAPS):
        n = len(words.starts)
        offsets = np.zeros(n + 1, np.int32)
        np.cumsum(words.ends - words.starts, out=offsets[1:])
        inside = np.zeros(len(words.data) + 1, np.int8)
        inside[words.starts] += 1
        np.subtract.at(inside, words.ends, 1)
        letters = words.data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
        column = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters)))
        coded = column.dictionary_encode()
        langs = batch["lang"][at:upto].dictionary_encode()
        breaks = np.concatenate([[0], np.cumsum(ends[words.data])])
        text = words.text_of()
        linked = np.zeros(n, bool)
        linked[:-1] = (breaks[words.ends[:-1]] == breaks[words.starts[1:]]) & (text[:-1] == text[1:])
        lang = langs.indices.to_numpy(zero_copy_only=False)[text]
        yield Block(coded.dictionary, langs.dictionary, coded.indices.to_numpy(zero_copy_only=False), lang, linked)


# Hashes are counted by their upper 32 bits, in ranges of the upper 10.
PART_BITS = 10
WIDTH_BITS = 32 - PART_BITS
# So many different hashes of a task are put together before they are written.
HELD = 1 << 21


def packed(tops: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted different hashes of a range and their counts, a few bytes each: gaps between neighbours
    by planes of their bytes, compressed."""
    gaps = np.diff(tops & np.uint32((1 << WIDTH_BITS) - 1), prepend=np.uint32(0)).astype("<u4")
    planes = np.concatenate([gaps.view(np.uint8).reshape(-1, 4).T[:3].ravel(), counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places in the range, and counts."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(7, -1)
    gaps = sum(planes[i].astype(np.uint32) << np.uint32(8 * i) for i in range(3))
    counts = sum(planes[3 + i].astype(np.int64) << 8 * i for i in range(4))
    return np.cumsum(gaps, dtype=np.uint32), counts


def _summed(keys: list[np.ndarray], counts: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and their counts up to most: more need not be known."""
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)
    return found, np.minimum(total, most)


def frequent(texts: DataFrame, min_count: int, hashes: Callable[[Block], np.ndarray]) -> Bitmap:
    """The hashes that blocks have min_count times or more in all, and few others.

    What a task has counted is shuffled in sorted ranges of hashes, packed to a few bytes a hash;
    a range of the hash has a fixed number of places, so the task that sums it is bounded too.
    """
    most = min(min_count, (1 << 32) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        keys, counts = [], []

        def written() -> dict:
            tops, n = _summed(keys, counts, most)
            parts = np.arange(1 << PART_BITS, dtype=np.uint64) << np.uint64(WIDTH_BITS)
            cuts = np.append(np.searchsorted(tops, parts.astype(np.uint32)), len(tops))
            some = np.flatnonzero(np.diff(cuts))
            return {"part": some, "packed": [packed(tops[cuts[p] : cuts[p + 1]], n[cuts[p] : cuts[p + 1]]) for p in some]}

        for batch in batches:
            for block in blocks_of(batch):
                tops = (hashes(block) >> np.uint64(32)).astype(np.uint32)
                found, n = np.unique(tops, return_counts=True)
                keys.append(found)
                counts.append(n)
                if sum(map(len, keys)) > 2 * HELD:
                    found, n = _summed(keys, counts, most)
                    keys[:], counts[:] = [found], [n]
                    if len(found) > HELD:
                        yield written()
                        keys.clear()
                        counts.clear()
        if keys:
            yield written()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, keys, counts = None, [], []

        def bits() -> dict:
            places, n = _summed(keys, counts, most)
            tops = places[n >= min_count].astype(np.int64) + (held << WIDTH_BITS)
            # The words of a bitmap of 2**26 bits.
            words, bit = tops >> 12, np.uint64(1) << ((tops >> 6) & 63).astype(np.uint64)
            first = np.flatnonzero(np.diff(words, prepend=-1))
            values = np.bitwise_or.reduceat(bit, first) if len(first) else bit
            return {"w": words[first], "v": values.view(np.int64)}

        for batch in batches:
            for part, blob in zip(batch["part"].to_pylist(), batch["packed"].to_pylist()):
                if part != held and keys:
                    yield bits()
                    keys, counts = [], []
                held = part
                places, n = unpacked(blob)
                keys.append(places)
                counts.append(n)
                if sum(map(len, keys)) > 2 * HELD:
                    places, n = _summed(keys, counts, most)
                    keys, counts = [places], [n]
        if keys:
            yield bits()

    counted = map_batches(texts, count, "part int, packed binary")
    found = map_batches(counted.repartition("part").sortWithinPartitions("part"), total, "w int, v long").toArrow()
    table = np.zeros(1 << 20, np.int64)
    table[found["w"].to_numpy()] = found["v"].to_numpy()
    return Bitmap(table.view(np.uint64), 26)


def _short_hashes(block: Block) -> np.ndarray:
    words, pairs = block.keys()
    return np.concatenate([words, pairs[block.linked]])


@dataclass(frozen=True)
class Filter:
    """Which words, pairs and triples of words may be in a candidate."""

    short: Bitmap
    triples: Bitmap | None = None

    def words(self, block: Block) -> np.ndarray:
        return self.short.has(block.keys()[0])

    def pairs(self, block: Block) -> np.ndarray:
        """Of each word, whether it and the next one may go together."""
        return block.linked & self.short.has(block.keys()[1])

    def triple_hashes(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Words that begin a triple of such pairs, and the triples' hashes."""
        follows = self.pairs(block)
        at = np.flatnonzero(follows[:-1] & follows[1:])
        pairs = block.keys()[1]
        return at, mixed(pairs[at] * np.uint64(0x9E3779B97F4A7C15) + pairs[at + 1])

    def triple(self, block: Block) -> np.ndarray:
        """Of each word, whether it and the next two may go together."""
        out = np.zeros(len(block.word), bool)
        at, hashes = self.triple_hashes(block)
        out[at] = True if self.triples is None else self.triples.has(hashes)
        return out


def _filter(texts: DataFrame, min_count: int) -> Filter:
    """What is too rare to be in a candidate, or in one of three words or more."""
    held = texts.sparkSession.sparkContext.broadcast(Filter(frequent(texts, min_count, _short_hashes)))
    triples = frequent(texts, min_count, lambda block: held.value.triple_hashes(block)[1])
    return Filter(held.value.short, triples)


def distinct_windows(block: Block, order: int, known: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each different window of a block one word it begins at, its length, and its count."""
    n = len(block.word)
    goes, pairs, triples = known.words(block), known.pairs(block), known.triple(block)
    length = goes.astype(np.int64)
    which, codes = np.unique(
        block.lang * np.int64(len(block.vocabulary) + 1) + np.where(goes, block.word + 1, 0), return_inverse=True
    )
    seen = len(which)
    at = np.flatnonzero(goes)
    for more in range(1, order):
        at = at[pairs[at]] if more == 1 else at[triples[at + more - 2]]
        longer = codes[at] * np.int64(len(block.vocabulary)) + block.word[at + more]
        which, place = np.unique(longer, return_inverse=True)
        codes[at] = seen + place
        length[at] = more + 1
        seen += len(which)
    counts = np.bincount(codes, minlength=seen)
    one = np.zeros(seen, np.int64)
    one[codes] = np.arange(n)
    used = np.flatnonzero(counts)
    return one[used], length[one[used]], counts[used]


def _columns(order: int) -> list[str]:
    return [f"w{k}" for k in range(1, order + 1)]


def windows(texts: DataFrame, order: int, known: Filter) -> DataFrame:
    """lang, w1 to w{order}, n: the longest windows and how often each occurs; null is padding."""
    held = texts.sparkSession.sparkContext.broadcast(known)
    names = _columns(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for block in blocks_of(batch):
                one, length, counts = distinct_windows(block, order, held.value)
                out = {"lang": block.languages.take(pa.array(block.lang[one])), "n": counts}
                for k, name in enumerate(names):
                    place = np.minimum(one + k, max(0, len(block.word) - 1))
                    out[name] = block.vocabulary.take(pa.array(block.word[place], mask=length <= k))
                yield out

    schema = ", ".join(["lang string", *[f"{name} string" for name in names], "n long"])
    return map_batches(texts, run, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def phrase_counts(texts: DataFrame, order: int, min_count: int) -> DataFrame:
    """lang, size, phrase, f: phrases of up to order words that occur min_count times or more, and
    for size 0 the number of words of the language."""
    names = _columns(order)
    longest = saved(windows(texts, order, _filter(texts, min_count)), "windows")
    rolled = longest.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    size = F.lit(order) - F.log2(F.col("rolled") + 1).cast("int")
    last = F.coalesce(*[F.when(F.col("size") == k, F.col(name)) for k, name in enumerate(names, 1)])
    counted = rolled.where(F.col("rolled") < 1 << order).withColumn("size", size)
    counted = counted.where((F.col("size") == 0) | (last.isNotNull() & (F.col("f") >= min_count)))
    return counted.select("lang", "size", F.concat_ws(" ", *names).alias("phrase"), "f")


def _part(phrase: str, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, size), " ")


def _scored(cuts: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, cut, score, with integers of any size in between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            numbers = zip(*(batch[name].to_pylist() for name in ("a", "n", "l", "r")))
            out = {name: batch[name] for name in batch.schema.names}
            yield out | {"score": [1000 * a * n // (l * r) for a, n, l, r in numbers]}  # noqa: E741

    cuts = cuts.select("lang", "phrase", "size", "a", "l", "r", "n", "cut")
    return map_batches(
        cuts, run, "lang string, phrase string, size int, a long, l long, r long, n long, cut int, score long"
    )


def mine(
    docs: DataFrame,
    order: int = 5,
    min_count: int = 100,
    top: int = 2000,
    percent: int = 100,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, size, a, l, r, n, score: the top phrases of each language.

    Texts are cut at PIECE_ENDS into pieces and those at spaces and tabs into words, A-Z
    lower-cased. Phrases of 2 to order words that occur min_count times or more are candidates. a
    is a candidate's count, l and r are those of its first words and of the rest at the cut that
    scores lowest (of equal ones the first), n is the language's number of words, score is
    floor(1000 * a * n / (l * r)). A candidate goes if a longer one with at least percent
    hundredths of its count holds its words in a row. Rank is by falling score, falling a and the
    phrase's bytes. A null language is "und"; null, empty and blank texts have no words; repeated
    rows count again; an empty table has no phrases; other columns are left out.
    """
    texts = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    counts = saved(phrase_counts(texts, order, min_count), "counts")
    phrases = counts.where("size > 1").withColumnRenamed("f", "a")

    longer = phrases.where("size > 2").withColumn("part", F.explode(F.expr("sequence(2, size - 1)")))
    longer = longer.withColumn("start", F.explode(F.expr("sequence(1, size - part + 1)")))
    inner = longer.select("lang", _part("phrase", F.col("start"), F.col("part")).alias("phrase"), "a")
    around = saved(inner.groupBy("lang", "phrase").agg(F.max("a").alias("most")), "around")
    alone = phrases.join(around, ["lang", "phrase"], "left").where(
        "most IS NULL OR 100 * most < {} * a".format(int(percent))
    )

    cuts = alone.withColumn("cut", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.select(
        "*",
        _part("phrase", F.lit(1), F.col("cut")).alias("first"),
        _part("phrase", F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        known = counts.where("size > 0").select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        cuts = cuts.join(known, ["lang", part])
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    scored = _scored(cuts.join(total, "lang"))
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("lowest")
    best = saved(scored.groupBy("lang", "phrase", "size", "a", "n").agg(lowest), "best")
    best = best.select("lang", "phrase", "size", "a", "lowest.l", "lowest.r", "n", "lowest.score")

    # The top of each share of a language first, so that no task sorts all its phrases.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = best.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    by_score = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for keys in (["lang", "share"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by_score))
        best = best.withColumn("rank", place).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long"), "phrase", "size", "a", "l", "r", "n", "score")
