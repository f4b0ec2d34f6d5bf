"""Words and hashes of many texts at once, as arrays over one Arrow buffer.

The functions work on a chunk: the UTF-8 bytes of some whole texts laid end to
end, with the offset of each text. Nothing is done per word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 2 << 20

SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: For bytes.translate and for take: A-Z become a-z, all other bytes stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOWER_ARRAY = np.frombuffer(LOWER, np.uint8)

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1
U = np.uint64
# The constants of the public XXH64 hash: fixed values.
P1, P2, P3 = U(11400714785074694791), U(14029467366897019727), U(1609587929392839161)
P4, P5 = U(9650029242287828579), U(2870177450012600261)
#: A random 64-bit value for each byte.
BYTE_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


class Chunk(NamedTuple):
    """Whole texts: rows ``low`` to ``high`` of a batch, their bytes and offsets."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a column of texts into chunks of about ``most`` bytes; a longer text is one chunk."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    count = len(texts)
    if not count:
        return
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + count + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < count:
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(max(high, low + 1), count)
        start = offsets[low]
        yield Chunk(low, high, data[start : offsets[high]], offsets[low : high + 1] - start)
        low = high


class Words(NamedTuple):
    """Byte ranges of the words of a chunk; ``first[d]`` is the first word of text ``d``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def split(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = IS_SPACE) -> Words:
    """The maximal runs of bytes that are no separators; a word never crosses texts."""
    gap = separator[data]
    inside = ~gap
    before = np.ones(len(data) + 1, bool)
    before[1:] = gap
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins = before[:-1].copy()
    begins[edges] = True
    ends = np.ones(len(data), bool)
    if len(data):
        ends[:-1] = gap[1:]
        ends[edges - 1] = True
    start = np.flatnonzero(inside & begins)
    return Words(start, np.flatnonzero(inside & ends) + 1, np.searchsorted(start, offsets))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd ``base`` and of its inverse modulo 2**64, at least ``count``."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < count:
        size = max(1024, 1 << (count - 1).bit_length())
        known = tuple(
            np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
            for b in (base, pow(base, -1, 1 << 64))
        )
        _POWERS[base] = known
    return known


def prefixes(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of a polynomial hash over ``values``; the first is 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (one to one)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def sliding_hashes(prefix: np.ndarray, width: int, base: int) -> np.ndarray:
    """The hash of every range of ``width`` values."""
    count = len(prefix) - width
    if count <= 0:
        return np.zeros(0, np.uint64)
    return mix((prefix[width:] - prefix[:-width]) * powers(base, len(prefix) + 1)[1][:count])


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U(bits)) | (x >> U(64 - bits))


def _round(h: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(h + lane * P2, 31) * P1


def _xxh64_equal(lanes: np.ndarray, start: np.ndarray, length: int, seed: int) -> np.ndarray:
    """XXH64 of byte ranges of one length; ``lanes[i]`` is the 64-bit word at byte ``i``."""
    at, left = start, length
    if length >= 32:
        h = [np.full(len(start), (seed + int(c)) & MASK, U) for c in (int(P1) + int(P2), int(P2), 0, -int(P1))]
        while left >= 32:
            h = [_round(h[i], lanes[at + 8 * i]) for i in range(4)]
            at, left = at + 32, left - 32
        out = _turn(h[0], 1) + _turn(h[1], 7) + _turn(h[2], 12) + _turn(h[3], 18)
        for part in h:
            out = (out ^ _round(np.zeros_like(part), part)) * P1 + P4
    else:
        out = np.full(len(start), (seed + int(P5)) & MASK, U)
    out = out + U(length)
    while left >= 8:
        out = _turn(out ^ _round(np.zeros_like(out), lanes[at]), 27) * P1 + P4
        at, left = at + 8, left - 8
    if left >= 4:
        out = _turn(out ^ ((lanes[at] & U(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at, left = at + 4, left - 4
    while left:
        out = _turn(out ^ ((lanes[at] & U(255)) * P5), 11) * P1
        at, left = at + 1, left - 1
    out ^= out >> U(33)
    out *= P2
    out ^= out >> U(29)
    out *= P3
    return out ^ (out >> U(32))


def byte_lanes(data: bytes) -> np.ndarray:
    """The eight bytes from each place on as a number."""
    padded = np.frombuffer(data + bytes(8), np.uint8)
    return np.ascontiguousarray(np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,)))


#: The lowest bytes of a lane.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def same_bytes(a: bytes, at_a: np.ndarray, b: bytes, at_b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Are the ranges of ``size`` bytes equal? Up to 16 bytes are compared as two lanes, more in full."""
    lanes_a, lanes_b = byte_lanes(a), byte_lanes(b)
    low = LOW_BYTES[np.minimum(size, 8)]
    same = lanes_a[at_a] & low == lanes_b[at_b] & low
    back = np.maximum(size - 8, 0)
    same &= (lanes_a[at_a + back] ^ lanes_b[at_b + back]) & np.where(size > 8, LOW_BYTES[8], U(0)) == 0
    for i in np.flatnonzero(same & (size > 16)).tolist():
        same[i] = a[at_a[i] : at_a[i] + size[i]] == b[at_b[i] : at_b[i] + size[i]]
    return same


def xxh64(data: bytes, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of many byte ranges of ``data``: ranges of one length are hashed together."""
    out = np.zeros(len(start), U)
    if not len(start):
        return out
    lanes = byte_lanes(data)
    order = np.argsort(length, kind="stable")
    ordered = length[order]
    edges = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(order)]])
    for low, high in zip(edges[:-1], edges[1:]):
        group, size = order[low:high], int(ordered[low])
        if high - low < 32:
            for i in group:
                out[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + size], seed=seed)
        else:
            out[group] = _xxh64_equal(lanes, start[group], size, seed)
    return out


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """XXH64 of each word's bytes."""
    return xxh64(data.tobytes(), words.start, words.end - words.start)


def word_numbers(data: bytes, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, the same for equal words alone, and one word of each number."""
    start, size = words.start, words.end - words.start
    keys, open_ = xxh64(data, start, size), np.arange(len(start))
    out, examples, used = np.empty(len(start), np.int64), [np.zeros(0, np.int64)], 0
    while len(open_):
        _, first, which = np.unique(keys[open_], return_index=True, return_inverse=True)
        example = open_[first]
        same = size[open_] == size[example][which]
        held = np.flatnonzero(same)
        same[held] = same_bytes(data, start[open_[held]], data, start[example[which[held]]], size[open_[held]])
        out[open_[same]] = which[same] + used
        examples.append(example)
        used += len(example)
        open_ = open_[~same]
    return out, np.concatenate(examples)


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges as a column of texts."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    body = data[spread_ranges(start, size)]
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))])


class WordTable:
    """Some words with their row numbers, found by XXH64 and compared with themselves."""

    def __init__(self, words: list[bytes]) -> None:
        self.data = b"".join(words)
        size = np.array([len(word) for word in words], np.int64)
        start = np.cumsum(size) - size
        keys = xxh64(self.data, start, size)
        self.row = np.argsort(keys, kind="stable")
        self.keys, self.start, self.size = keys[self.row], start[self.row], size[self.row]

    def find(self, data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The row of each word, or -1. Of words of one hash only the first is ever found."""
        out = np.full(len(start), -1)
        if not len(self.keys) or not len(start):
            return out
        keys = xxh64(data, start, size)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = np.flatnonzero((self.keys[place] == keys) & (self.size[place] == size))
        place = place[held]
        same = same_bytes(data, start[held], self.data, self.start[place], size[held])
        out[held[same]] = self.row[place[same]]
        return out


def joined(data: np.ndarray, words: Words, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of each text with one space after each, and where words and texts begin.

    With ``keep``, a flag for each word, the other words are left out. The text
    ``d`` without its last space is ``out[texts[d] : texts[d + 1] - 1]``.
    """
    start, end, first = words
    if keep is not None:
        start, end = start[keep], end[keep]
        first = np.concatenate([[0], np.cumsum(keep)])[first]
    size = end - start + 1
    place = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(place[-1]) + np.repeat(start - place[:-1], size)
    out = data[np.minimum(source, len(data) - 1)] if len(data) else np.zeros(0, np.uint8)
    out[place[1:] - 1] = 32
    return out.tobytes(), place[:-1], place[first]


def spread_ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indices of the ranges that begin at ``start`` and have ``size`` members, in order."""
    place = np.cumsum(size)
    total = int(place[-1]) if len(place) else 0
    return np.arange(total) + np.repeat(start - (place - size), size)


def covered(start: np.ndarray, size: np.ndarray, total: int) -> np.ndarray:
    """A flag for each of ``total`` places: does any of the ranges cover it?"""
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, start, 1)
    np.subtract.at(steps, start + size, 1)
    return np.cumsum(steps[:-1]) > 0
