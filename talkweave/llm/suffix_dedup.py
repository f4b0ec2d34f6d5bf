"""Suffix-array dedup: repeated byte strings, found by a hash-compared suffix sort.

The suffixes of passages that share an anchor are sorted. Two suffixes are
compared by their longest common extension, which a binary search over prefix
polynomial hashes finds in logarithmic time; a bottom-up mergesort makes these
comparisons for all groups at once. It sorts the suffixes that begin at anchors;
those that begin further left are sorted from them, one byte at a time, as their
order is that of the byte in front and then of the suffix after it. Neighbours in
the order whose first ``WINDOW`` bytes agree are repeats. Agreement by hash is
verified on the bytes.

Windows of segments that are equal as a whole are repeats without a sort: equal
in 128 bits of BLAKE2b, or in 64 bits of it and in the hash of the anchor.

Defined cases: a missing text is empty; a text shorter than a window has no
repeats; strings are bytes of UTF-8, so what is kept may not be valid UTF-8 and is
returned as bytes; repeated rows repeat each other; no rows give no rows; further
columns are ignored; a very long text is read as one chunk, with some ten numbers
for each of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talkweave.llm import passages as P
from talkweave.llm import words as W
from talkweave.llm.rows import in_tasks, shown_id, whole_groups
from talkweave.llm.segments import Windows
from talkweave.session import stage

WINDOW = 200
GRAM = 48


class Suffixes:
    """Suffixes of many byte strings laid end to end, compared by hashes of their prefixes."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        self.prefix = W.prefixes(W.BYTE_VALUE[data], W.BYTE_BASE)
        self.inverse = W.powers(W.BYTE_BASE, len(data) + 1)[1]
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.lanes = np.ascontiguousarray(np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)))

    def hashes(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """The hash of ``size`` bytes from each start."""
        return (self.prefix[start + size] - self.prefix[start]) * self.inverse[start]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The longest common extension of the suffixes at ``a`` and ``b``, up to ``most`` bytes."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            same = self.hashes(a[open_], middle) == self.hashes(b[open_], middle)
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1

    def less(self, a: np.ndarray, end_a: np.ndarray, b: np.ndarray, end_b: np.ndarray) -> np.ndarray:
        """Does the suffix at ``a`` come before the one at ``b``? Each stops at its end."""
        most = np.minimum(end_a - a, end_b - b)
        shared = self.common(a, b, most)
        ended = shared == most
        last = len(self.data) - 1
        by_byte = self.data[np.minimum(a + shared, last)] < self.data[np.minimum(b + shared, last)]
        return np.where(ended, end_a - a < end_b - b, by_byte)

    def same_bytes(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Are the ``size`` bytes at ``a`` and ``b`` equal? Compared eight at a time."""
        same = np.ones(len(a), bool)
        for step in [*range(0, size - 7, 8), size - 8] if size >= 8 else ():
            same &= self.lanes[a + step] == self.lanes[b + step]
        for step in range(size if size < 8 else 0):
            same &= self.data[a + step] == self.data[b + step]
        return same


def merge_sort(suffixes: Suffixes, group: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The order of suffixes by group and then by their bytes; ``group`` is sorted.

    Runs of one, two, four and so on are merged: a suffix's new place is its place
    in its own run and the number of suffixes before it in the other run, found by
    binary search. All merges of a level are made together.
    """
    count = len(group)
    order = np.arange(count)
    first = np.flatnonzero(P.starts(group))
    size = np.diff(np.concatenate([first, [count]]))
    base, length = np.repeat(first, size), np.repeat(size, size)
    width = 1
    while True:
        # Only suffixes of groups larger than a run, in a run that has another to merge with.
        own = np.flatnonzero(length > width)
        if not len(own):
            return order
        run = (own - base[own]) // width
        other = base[own] + (run ^ 1) * width
        other_end = np.minimum(other + width, base[own] + length[own])
        partner = other < base[own] + length[own]
        own, run, other, other_end = own[partner], run[partner], other[partner], other_end[partner]
        low, high = other.copy(), other_end.copy()
        mine = order[own]
        right = (run & 1).astype(bool)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            theirs, us = order[middle], mine[open_]
            # Equal suffixes keep the order of their runs.
            before = np.where(
                right[open_],
                ~suffixes.less(start[us], end[us], start[theirs], end[theirs]),
                suffixes.less(start[theirs], end[theirs], start[us], end[us]),
            )
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]
        pair_start = base[own] + (run & ~1) * width
        own_start = base[own] + run * width
        new_order = order.copy()
        new_order[pair_start + (own - own_start) + (low - other)] = mine
        order = new_order
        width *= 2


def repeats(
    data: np.ndarray, offsets: np.ndarray, group: np.ndarray, at: np.ndarray, size: np.ndarray, width: int
) -> np.ndarray:
    """A flag for each window of the segments: does another segment of the group hold it?

    Segment ``r`` is ``data[offsets[r] : offsets[r + 1]]`` with ``size[r]`` windows, and its
    anchor is ``at[r]`` bytes from its start. Segments are sorted by ``group``.
    """
    suffixes = Suffixes(data)
    begin, end = offsets[:-1], offsets[1:]
    window = np.cumsum(size) - size
    flags = np.zeros(int(size.sum()), bool)
    order = merge_sort(suffixes, group, begin + at, end)
    verified = np.full(len(group), -1)
    for left in range(int(at.max(initial=-1)) + 1):
        if left:
            order = order[at[order] >= left]
            key = group[order] * 256 + data[begin[order] + at[order] - left]
            order = order[np.argsort(key, kind="stable")]
        # The windows that begin ``left`` bytes before their anchor, in order of their bytes.
        owner = order[at[order] - left < size[order]]
        place = begin[owner] + at[owner] - left
        hashes = suffixes.hashes(place, width)
        pair = np.flatnonzero((hashes[1:] == hashes[:-1]) & (group[owner[1:]] == group[owner[:-1]]))
        a, b = owner[pair], owner[pair + 1]
        # Neighbours verified one byte further right need only that byte.
        known = verified[a] == b
        same = data[place[pair]] == data[place[pair + 1]]
        fresh = np.flatnonzero(~known)
        same[fresh] = suffixes.same_bytes(place[pair[fresh]], place[pair[fresh] + 1], width)
        verified[:] = -1
        a, b = a[same], b[same]
        verified[a] = b
        flags[window[a] + at[a] - left] = True
        flags[window[b] + at[b] - left] = True
    return flags


def _bytes(width: int):
    """The bodies of segments: their bytes."""

    def take(chunk: W.Chunk, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = size - 1 + width
        offsets = np.concatenate([[0], np.cumsum(length)])
        return offsets, chunk.data[W.spread_ranges(chunk.offsets[text] + start, length)]

    return take


def _sort(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "anchor"):
            anchor, ids, key_hash, place, known = (
                table.column(c).to_numpy() for c in ("anchor", "key_id", "key_hash", "place", "other")
            )
            start, size, at = P.unpack(place)
            data = np.frombuffer(b"".join(body.as_py() for body in table.column("body")), np.uint8)
            offsets = np.concatenate([[0], np.cumsum(size - 1 + width)])
            flags = repeats(data, offsets, np.cumsum(P.starts(anchor)), at, size, width)
            flags &= np.repeat(known == 0, size)
            segment = np.repeat(np.arange(len(size)), size)
            edge = np.concatenate([[False], flags, [False]])
            cut = np.concatenate([[True], segment[1:] != segment[:-1]]) if len(segment) else segment.astype(bool)
            head = np.flatnonzero(flags & (~edge[:-2] | cut))
            tail = np.flatnonzero(flags & (~edge[2:] | np.concatenate([cut[1:], [True]])[: len(flags)]))
            owner = segment[head]
            first = start[owner] + head - (np.cumsum(size) - size)[owner]
            columns = [ids[owner], key_hash[owner], P.pack(first, tail - head + 1)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["key_id", "key_hash", "place"])

    return run


def spans(docs: DataFrame, width: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Runs of repeated windows: key and packed ``place``."""
    windows = Windows("bytes", width, min(gram, width))
    decided = P.decide(docs, windows, ordered=False)
    rows = P.contexts(docs, decided.filter("asked"), windows, _bytes(width))
    late = stage(in_tasks(rows, _sort(width), "key_id bigint, key_hash bigint, place bigint"))
    return decided.filter("NOT asked").select("key_id", "key_hash", "place").unionByName(late)


def _remove(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                offsets = chunk.offsets
                gone = P.covered_tokens(batch, chunk, offsets, width)
                total = np.concatenate([[0], np.cumsum(gone)])
                heads = gone.copy()
                heads[1:] &= ~gone[:-1]
                # A run that a text begins with is a run of its own.
                begins = offsets[:-1][np.diff(offsets) > 0]
                heads[begins] = gone[begins]
                runs = np.concatenate([[0], np.cumsum(heads)])
                kept = chunk.data[~gone].tobytes()
                edge = (offsets - total[offsets]).tolist()
                parts = [kept[a:b] for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key_id")[chunk.low : chunk.high],
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(total[offsets])),
                        pa.array(np.diff(runs[offsets])),
                        pa.array(parts, pa.binary()),
                        pa.array([hashlib.sha256(part).hexdigest() for part in parts]),
                    ],
                    ["key_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
                )

    return run


def remove_repeats(docs: DataFrame, width: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Each document without its repeated strings: ``doc_id``, counts, ``kept`` bytes and their SHA-256."""
    rows = P.with_places(docs, spans(docs, width, gram))
    schema = "key_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"
    out = in_tasks(rows, _remove(width), schema)
    return out.select(shown_id(), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")


def repeated_spans(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id``, first byte and bytes of runs of repeated windows; runs may overlap."""
    start, size = P.span_columns(width)
    return spans(docs, width).select(shown_id(), start.alias("first_byte"), size.alias("n_bytes"))
