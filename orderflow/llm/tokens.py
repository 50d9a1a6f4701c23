"""Token ids in compressed files (operator 7).

Documents are encoded in ascending doc_id order and cut into shards of about SHARD_IDS ids, each
compressed with a grammar of its own: frequent pairs of ids are replaced by new symbols, again
and again, the most frequent first. A shard is one row of a Parquet file and holds the rules, how
many ids each symbol stands for, the remaining symbols, and the doc_ids with their numbers of
ids. With the lengths, a span of ids is found and expanded without expanding what is before it.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderflow.llm.common import map_batches, ranges, texts_of
from orderflow.llm.words import blocks, column_bytes, slices

SHARD_IDS = 1 << 20
# Rules of a shard; a pair rarer than this is not worth one.
MAX_RULES = 16_000
LEAST_COUNT = 6
# Rules that stand for so many ids at most are expanded by one look at a table.
SHORT_RULE = 64
# Bytes of texts whose pieces are looked up together.
GROUP_BYTES = 8 << 20
# Distinct pieces that a worker keeps from one group of texts to the next.
CACHED = 600_000
LONG_WORD = 200

# Kinds of bytes. What stands together in a word and is of one kind, or a digit, is a piece; an odd
# byte makes the whole word one piece.
_LETTER, _DIGIT, _SIGN, _SPACE, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT
_KIND[list(b" \n")] = _SPACE
_KIND[ord("'")] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# As tables of bytes.translate.
_KIND, _LOWER = _KIND.tobytes(), _LOWER.tobytes()
# U+00C0 to U+00FF are letters but for two; they are 0xC3 and a byte from 0x80 on.
_WIDE, _TIMES, _DIVIDED = 0xC3, 0x97, 0xB7
_LOWER_WIDE = np.arange(256, dtype=np.uint8)
_LOWER_WIDE[0x80:0x9F] += 32
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
# The characters by which byte-level vocabularies write bytes.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)}.difference(_PLAIN)))}


# Pairs are counted in so many buckets, and what is no pair in one more.
_NO_PAIR = 1 << 20


def _bucket(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bucket of each pair, by a hash."""
    key = left.astype(np.uint64) << np.uint64(32)
    key |= right
    key *= np.uint64(0x9E3779B97F4A7C15)
    key >>= np.uint64(44)
    return key.astype(np.int64)


@dataclass
class Grammar:
    """Symbol base + r stands for the two symbols of rules[r]; smaller ones are ids."""

    base: int
    rules: np.ndarray
    symbols: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, base: int) -> Grammar:
        """Re-Pair in rounds: each replaces the pairs that are at least half as frequent as the
        most frequent one, so no pair waits behind one less than half as frequent.

        held counts the pairs by bucket and follows what is replaced; the last symbol begins no
        pair and is in the bucket of none."""
        symbols, rules = ids.astype(np.uint32), []
        bucket = np.append(_bucket(symbols[:-1], symbols[1:]), _NO_PAIR)[: len(symbols)]
        held = np.bincount(bucket, minlength=_NO_PAIR + 1).astype(np.int32)
        most = None
        while len(symbols) > 1 and len(rules) < MAX_RULES:
            top = int(held[:_NO_PAIR].max())
            least = max(LEAST_COUNT, (top if most is None else min(top, most)) // 2)
            if top < LEAST_COUNT:
                break
            many = held >= least
            many[_NO_PAIR] = False
            places = np.flatnonzero(many.take(bucket, mode="clip"))
            key = symbols[places].astype(np.uint64) << np.uint64(32) | symbols[places + 1]
            pairs, which, counts = np.unique(key, return_inverse=True, return_counts=True)
            wanted = counts >= least
            most = least
            if wanted.any():
                order = np.argsort(-counts[wanted], kind="stable")[: MAX_RULES - len(rules)]
                chosen = np.flatnonzero(wanted)[order]
                number = np.full(len(pairs), -1)
                number[chosen] = np.arange(len(chosen))
                places, which = places[number[which] >= 0], number[which][number[which] >= 0]
                # Of pairs that overlap in a row, every second one from the left is replaced.
                fresh = np.append(True, np.diff(places) > 1)
                run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
                kept = (np.arange(len(places)) - run) % 2 == 0
                places, which = places[kept], which[kept]
                # The pairs that touch a replaced one: itself, the next, and the one before unless
                # it is the next of another.
                before = (places > 0) & (np.diff(places, prepend=-3) > 2)
                gone = np.concatenate([places, places + 1, places[before] - 1])
                np.subtract.at(held, bucket[gone], np.int32(1))
                symbols[places] = (base + len(rules) + which).astype(np.uint32)
                stay = np.ones(len(symbols), bool)
                stay[places + 1] = False
                symbols, bucket = symbols[stay], bucket[stay]
                places -= np.arange(len(places))
                made = np.concatenate([places, places[before] - 1])
                made = made[made < len(symbols) - 1]
                bucket[made] = _bucket(symbols[made], symbols[made + 1])
                bucket[-1] = _NO_PAIR
                np.add.at(held, bucket[made], np.int32(1))
                rules += pairs[chosen].tolist()
            elif least == LEAST_COUNT:
                break
        rules = np.array(rules, np.uint64)
        halves = np.stack([rules >> np.uint64(32), rules & np.uint64(0xFFFFFFFF)], axis=1)
        return cls(base, halves.astype(np.uint32), symbols.astype(np.uint32))

    def lengths(self) -> np.ndarray:
        """How many ids each rule stands for."""
        sizes = np.ones(self.base + len(self.rules), np.int64)
        for number, (left, right) in enumerate(self.rules.tolist()):
            sizes[self.base + number] = sizes[left] + sizes[right]
        return sizes[self.base :]

    def _opened(self, out: np.ndarray, deep: np.ndarray) -> np.ndarray:
        """The symbols with each of the deep ones replaced by its two."""
        ends = np.cumsum(1 + deep)
        grown = np.empty(int(ends[-1]), np.int64)
        grown[ends - 1] = out
        rule = self.rules[out[deep] - self.base]
        grown[ends[deep] - 2], grown[ends[deep] - 1] = rule[:, 0], rule[:, 1]
        return grown

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, and for each symbol where its ids begin among them and how many they are; a rule of
        more than SHORT_RULE ids has none there."""
        sizes = np.ones(self.base + len(self.rules), np.int64)
        sizes[self.base :] = self.lengths()
        out = self.base + np.flatnonzero(sizes[self.base :] <= SHORT_RULE)
        starts = np.arange(len(sizes))
        starts[out] = self.base + np.cumsum(sizes[out]) - sizes[out]
        while len(out) and (deep := out >= self.base).any():
            out = self._opened(out, deep)
        return np.concatenate([np.arange(self.base), out]).astype(np.uint32), starts, sizes

    def expanded(self, symbols: np.ndarray) -> np.ndarray:
        """All levels of rules undone: long rules one array operation a level, the rest by table."""
        ids, starts, sizes = self._table
        out = symbols.astype(np.int64)
        while len(out) and (deep := sizes[out] > SHORT_RULE).any():
            out = self._opened(out, deep)
        return _gathered(ids, starts[out], sizes[out])

    def span(self, lengths: np.ndarray, start: int, n: int) -> np.ndarray:
        """ids start to start + n; only the symbols that touch them are expanded."""
        deep = self.symbols >= self.base
        sizes = np.ones(len(self.symbols), np.int64)
        sizes[deep] = lengths[self.symbols[deep].astype(np.int64) - self.base]
        ends = np.cumsum(sizes)
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(ends, start + n, "left")) + 1
        before = int(ends[first - 1]) if first else 0
        return self.expanded(self.symbols[first:last])[start - before : start - before + n]


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[0] : starts[0] + sizes[0]], then the next, and so on."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]


class _Encoder:
    """The tokenizer with its earlier results by piece. Words are cut at spaces and line breaks:
    no token reaches across either.

    A word of printable ASCII without apostrophes and of letters up to U+00FF is lower-cased and cut
    on into what the tokenizer's pattern cuts it into; a run of its letters, which normalization
    leaves alone then, goes to the library's model. Any other word goes to the library whole.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        # The strings of special tokens are ordinary text in a document.
        self.tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        """known: the number of each piece; its ids are the next so many as sizes says."""
        self.known: dict[bytes, int] = {}
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        tokenize, fresh, sizes = self.tokenizer.model.tokenize, [], []
        # No piece has a line break.
        texts = b"\n".join(pieces).decode().split("\n") if pieces else []
        for piece, text in zip(pieces, texts):
            if piece.isalpha() and len(piece) <= LONG_WORD:
                ids = [token.id for token in tokenize(text)]
            elif len(text) <= LONG_WORD and _LETTERS(text):
                ids = [token.id for token in tokenize(piece.decode("latin-1").translate(_BYTE_CHARS))]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            fresh += ids
            sizes.append(len(ids))
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.ids = np.append(self.ids, np.array(fresh, np.uint32))
        self.sizes = np.append(self.sizes, np.array(sizes, np.int64))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        data, offsets = column_bytes(column)
        # Pieces are cut block by block, and distinct ones looked up once for all blocks.
        parts = [
            _pieces(data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at])
            for at, upto in blocks(offsets)
        ]
        # Empty chunks may go.
        coded = pa.chunked_array([pieces for pieces, _ in parts], pa.binary()).dictionary_encode().chunks
        indices = np.concatenate([np.zeros(0, np.int32), *[chunk.indices.to_numpy() for chunk in coded]])
        joined, cuts = column_bytes(coded[-1].dictionary if coded else pa.array([], pa.binary()))
        joined, cuts = joined.tobytes(), cuts.tolist()
        distinct = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        self._learn([piece for piece in distinct if piece not in self.known])
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        starts = np.cumsum(self.sizes) - self.sizes
        found = []
        for pieces, first in parts:
            which, indices = number[indices[: len(pieces)]], indices[len(pieces) :]
            sizes = self.sizes[which]
            out = _gathered(self.ids, starts[which], sizes).tobytes()
            cuts = (4 * np.append(0, np.cumsum(sizes))[first]).tolist()
            found += [out[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(self.known) > CACHED:
            self._forget()
        return found


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The pieces of texts data[offsets[d]:offsets[d + 1]] as binary, and the number of each text's
    first."""
    raw = data.tobytes()
    kind = np.frombuffer(bytearray(raw.translate(_KIND)), np.uint8)
    inside = kind != _SPACE
    low = np.frombuffer(bytearray(raw.translate(_LOWER)), np.uint8)
    wide = np.flatnonzero(data == _WIDE)
    second = data[wide + 1]
    letters = (second != _TIMES) & (second != _DIVIDED)
    kind[wide], kind[wide[letters] + 1] = _LETTER, _LETTER
    low[wide[letters] + 1] = _LOWER_WIDE[second[letters]]
    begin = np.zeros(len(data) + 1, bool)
    begin[1:] = ~inside
    begin[offsets] = True
    # An odd byte's word, with the space after it.
    words = np.flatnonzero(begin)
    whole = np.unique(np.searchsorted(words, np.flatnonzero(kind == _ODD), "right"))
    odd = _gathered(np.arange(len(data)), words[whole - 1], words[whole] - words[whole - 1])
    odd = odd[inside[odd]]
    kind[odd], low[odd] = _ODD, data[odd]
    begin[1:-1] |= kind[1:] != kind[:-1]
    begin[:-1] |= kind == _DIGIT
    begin = begin[:-1] & inside
    starts = np.append(np.flatnonzero(begin[inside]), np.count_nonzero(inside)).astype(np.int32)
    first = np.searchsorted(np.flatnonzero(begin), offsets)
    buffers = [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(low[inside].tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers), first


@lru_cache(maxsize=1)
def _encoder(definition: str) -> _Encoder:
    """A worker's encoder, for one task after another: the library keeps memory for each tokenizer
    and each of its threads that it never gives back. Tasks fill the cores without its threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _Encoder(definition)


_SHARD = (
    "range int, number int, base int, size long, doc_ids binary, counts binary, rules binary, "
    "lengths binary, symbols binary"
)


def write(
    docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encodes every text, appends end_id and writes the shards below path.

    Ascending doc_id, a null one first; rows of equal doc_id by text. A null or empty text is
    end_id alone; an empty table gives a folder without shards. A document is never cut, so a
    very long one is a shard of its own. Other columns are left out.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = texts_of(docs, id_col, text_col)
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    cut = ranges(texts, key)
    rows = texts.withColumn("range", cut.of(key)).repartitionById(cut.width, "range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = _encoder(definition.value)
        end = end_id.to_bytes(4, "little")
        base = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        held: list[tuple[int, int | None, bytes]] = []
        size, numbers = 0, {}
        for batch in batches:
            for part in slices(batch, limit=GROUP_BYTES):
                ids = encoder.encode(part["text"])
                for number, doc_id, mine in zip(part["range"].to_pylist(), part["doc_id"].to_pylist(), ids):
                    if held and (size >= 4 * SHARD_IDS or held[0][0] != number):
                        yield shard(held, numbers, base)
                        held, size = [], 0
                    held.append((number, doc_id, mine + end))
                    size += len(mine) + 4
        if held:
            yield shard(held, numbers, base)

    def shard(held: list, numbers: dict, base: int) -> dict:
        at = held[0][0]
        numbers[at] = numbers.get(at, -1) + 1
        ids = np.frombuffer(b"".join(mine for _, _, mine in held), "<u4")
        grammar = Grammar.of(ids, base)
        wide = "<u2" if base + len(grammar.rules) <= 1 << 16 else "<u4"
        counts = np.array([len(mine) // 4 for _, _, mine in held], "<u4")
        doc_ids = np.array([-(2**63) if d is None else d for _, d, _ in held], "<i8")
        row = {
            "range": at,
            "number": numbers[at],
            "base": base,
            "size": len(ids),
            "doc_ids": doc_ids.tobytes(),
            "counts": counts.tobytes(),
            "rules": grammar.rules.astype(wide).tobytes(),
            "lengths": grammar.lengths().astype("<u4").tobytes(),
            "symbols": grammar.symbols.astype(wide).tobytes(),
        }
        return {name: [value] for name, value in row.items()}

    ordered = rows.sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "text")
    map_batches(ordered, run, _SHARD).write.parquet(path)


def _grammar(row: dict) -> Grammar:
    """The grammar of a shard row; its symbols are narrow if all fit in 16 bits."""
    lengths = np.frombuffer(row["lengths"], "<u4")
    wide = "<u2" if row["base"] + len(lengths) <= 1 << 16 else "<u4"
    rules = np.frombuffer(row["rules"], wide).astype(np.uint32).reshape(-1, 2)
    return Grammar(row["base"], rules, np.frombuffer(row["symbols"], wide).astype(np.uint32))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """range, number, size, start of each shard: start counts the ids of all shards before it.

    A shard's place is summed within its range; only the totals of the ranges, one row a
    range, meet in one task.
    """
    shards = spark.read.parquet(path).select("range", "number", "size")
    inner = Window.partitionBy("range").orderBy("number")
    placed = shards.withColumn("inner", F.sum("size").over(inner) - F.col("size"))
    totals = shards.groupBy("range").agg(F.sum("size").alias("total"))
    outer = totals.select(
        "range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("outer")
    )
    joined = placed.join(F.broadcast(outer), "range")
    return joined.select("range", "number", "size", (F.col("inner") + F.col("outer")).alias("start"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """range, number, doc_id, inner (ids of the shard before it), n_tokens, ids (binary,
    little-endian unsigned 32-bit) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            # A row is a shard, so a batch may be large already.
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                grammar = _grammar(row)
                data = grammar.expanded(grammar.symbols).astype("<u4").tobytes()
                counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                doc_ids = np.frombuffer(row["doc_ids"], "<i8")
                ends = np.cumsum(counts)
                cuts = (4 * np.append(0, ends)).tolist()
                n = len(counts)
                yield {
                    "range": np.full(n, row["range"], np.int32),
                    "number": np.full(n, row["number"], np.int32),
                    "doc_id": pa.array(doc_ids, mask=doc_ids == -(2**63)),
                    "inner": ends - counts,
                    "n_tokens": counts,
                    "ids": [data[a:b] for a, b in zip(cuts, cuts[1:])],
                }

    schema = "range int, number int, doc_id long, inner long, n_tokens long, ids binary"
    return map_batches(spark.read.parquet(path), run, schema)


def located(docs: DataFrame, path: str) -> DataFrame:
    """What read gives, without ids or with, and start: the ids of all documents before it."""
    shards = manifest(docs.sparkSession, path).select("range", "number", "start")
    joined = docs.join(shards, ["range", "number"])
    return joined.withColumn("start", F.col("start") + F.col("inner")).drop("range", "number", "inner")


def span(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """ids start to start + n of all documents in order, from the shards that hold them."""
    held = manifest(spark, path).where(
        (F.col("start") < start + n) & (F.col("start") + F.col("size") > start)
    )
    rows = spark.read.parquet(path).join(F.broadcast(held.drop("size")), ["range", "number"])
    parts = []
    for row in rows.orderBy("start").toLocalIterator():
        row = row.asDict()
        first = max(0, start - row["start"])
        last = min(row["size"], start + n - row["start"])
        lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
        parts.append(_grammar(row).span(lengths, first, last - first))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
