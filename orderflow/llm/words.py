"""Words of many texts at once, as hashes computed on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from orderflow.llm.common import mixed

# Space and the control characters from tab to carriage return separate words.
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
BLOCK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    """base**i modulo 2**64, doubled up."""
    out = np.ones(size, np.uint64)
    done, power = 1, base
    while done < size:
        step = min(done, size - done)
        out[done : done + step] = out[:step] * np.uint64(power)
        done += step
        power = power * power & _MASK
    return out


def power_pair(size: int) -> tuple[np.ndarray, np.ndarray]:
    rounded = 1 << max(16, (size - 1).bit_length())
    return _powers(_BASE, rounded)[:size], _powers(pow(_BASE, -1, 1 << 64), rounded)[:size]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each span, from one running sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = power_pair(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    out = (sums[ends] - sums[starts]) * down[starts]
    return mixed(out + (ends - starts).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for each byte."""
    return _BYTE_VALUES[data]


def byte_span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """span_hashes of bytes, in pieces that hold whole spans, so that memory stays bounded."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        at = starts[done]
        upto = max(done + 1, int(np.searchsorted(starts, at + (1 << 19))))
        piece = _BYTE_VALUES[data[at : ends[upto - 1]]]
        out[done:upto] = span_hashes(piece, starts[done:upto] - at, ends[done:upto] - at)
        done = upto
    return out


@lru_cache(maxsize=8)
def _lookup(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of the texts of a block: text d is data[offsets[d]:offsets[d + 1]], word i is
    data[starts[i]:ends[i]], and the words of text d are first[d] to first[d + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return byte_span_hashes(self.data, self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


# First and last code points of scripts written without spaces: Thai, Lao, Tibetan, Myanmar, Khmer,
# Tai, Kana and Han, their extensions and half-width forms.
UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF),
    (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x31BF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters of scripts without spaces begin and end."""
    at = np.flatnonzero(data >= 0xE0)
    wide = data[at] >= 0xF0
    b = [data[np.minimum(at + k, len(data) - 1)].astype(np.int64) & 0x3F for k in range(4)]
    three = (b[0] & 0xF) << 12 | b[1] << 6 | b[2]
    point = np.where(wide, (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3], three)
    bounds = np.array(UNSPACED).ravel() + np.tile([0, 1], len(UNSPACED))
    mine = np.searchsorted(bounds, point, "right") % 2 == 1
    return at[mine], (at + 3 + wide)[mine]


def split_words(
    data: np.ndarray,
    offsets: np.ndarray,
    lower: bool = False,
    separators: bytes = SPACES,
    unspaced: bool = False,
) -> Words:
    """The words of texts data[offsets[d]:offsets[d + 1]], as bytes.split() cuts them; with
    unspaced, a character of a script without spaces is a word."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    inside = np.concatenate([~_lookup(separators)[data], [False]])
    fresh = np.ones(len(data) + 1, bool)
    fresh[1:] = ~inside[:-1]
    fresh[offsets] = True
    if unspaced:
        for place in _unspaced(data):
            fresh[place] = True
    starts = np.flatnonzero(inside & fresh)
    last = np.concatenate([fresh[1:] | ~inside[1:], [False]])
    ends = np.flatnonzero(inside & last) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each value starts."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes; a longer text is a block of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        upto = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        upto = min(n, max(at + 1, upto))
        yield at, upto
        at = upto


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about limit bytes of a string or binary column at a time."""
    _, offsets = column_bytes(batch[column])
    for at, upto in blocks(offsets, limit):
        yield batch.slice(at, upto - at)


def word_blocks(
    column: pa.Array, lower: bool = False, separators: bytes = SPACES, unspaced: bool = False, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, Words]]:
    data, offsets = column_bytes(column)
    for at, upto in blocks(offsets, limit):
        yield at, upto, split_words(data, offsets[at : upto + 1], lower, separators, unspaced)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of size words, by its first word; runs over the end are left out."""
    n = max(0, len(words) - size + 1)
    at = np.arange(n)
    return span_hashes(words, at, at + size)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column: the first counts[0] values, then the next counts[1], and so on."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
