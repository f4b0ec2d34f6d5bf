"""Substring dedup by relative Lempel-Ziv parsing.

Every document is factored against reference blocks made of the documents of
smaller ``doc_id``. A block holds the passages around one anchor, so a document only
meets blocks that can hold a factor of a window or more, and meets every such block.

A block's index is its suffixes in sorted order, by ranks that are doubled from
windows to longer runs. The nearest suffixes of smaller ``doc_id`` on both sides of a
place share the longest run of words with it: the longer one is the factor there. The
parse goes greedily from left to right: it takes the factor at the first place that
has one, goes on behind it, and at its boundary checks the windows that reach over
its end, which may lie in a factor of another reference. Factors of ``WINDOW`` words
or more are duplicate spans. A whole passage equal to an earlier one is one factor
and is not indexed again.

Defined cases: a missing or empty text, or one of fewer words than a window, has
no factors; a missing ``doc_id`` comes after all others; rows of equal ``doc_id``
are no references for each other; no rows give no rows; further columns are
ignored; a very long text is read as one chunk, with some ten numbers for each of
its words. Words are told apart by XXH64, whole passages by 128 bits of BLAKE2b.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm import passages as P
from talkweave.llm import words as W
from talkweave.llm.rows import in_tasks, shown_id, whole_groups
from talkweave.llm.segments import Windows
from talkweave.session import stage

WINDOW = 50
GRAM = 16


def _word_hashes(width: int):
    """The bodies of segments: the hashes of their words."""

    def take(chunk: W.Chunk, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = W.split(chunk.data, chunk.offsets)
        hashes = W.word_hashes(chunk.data, words)
        length = size + width - 1
        offsets = 8 * np.concatenate([[0], np.cumsum(length)])
        return offsets, hashes[W.spread_ranges(words.first[text] + start, length)].view(np.uint8)

    return take


def window_classes(anchor: np.ndarray, size: np.ndarray, words: np.ndarray, width: int) -> np.ndarray:
    """A number for each window of the segments, equal for equal windows of one anchor and for no others."""
    length = size + width - 1
    begin = W.spread_ranges(np.cumsum(length) - length, size)
    block = np.repeat(np.cumsum(P.starts(anchor)), size).astype(np.uint64)
    hashes = W.sliding_hashes(W.prefixes(words, W.WORD_BASE), width, W.WORD_BASE)[begin] if len(begin) else block
    keys = W.mix(hashes + block * np.uint64(0x9E3779B97F4A7C15))
    out, open_, used = np.empty(len(keys), np.int64), np.arange(len(keys)), 0
    while len(open_):
        # Members whose words differ from those of the first one are classed anew.
        _, first, which = np.unique(keys[open_], return_index=True, return_inverse=True)
        mine, other = begin[open_], begin[open_][first][which]
        same = block[open_] == block[open_][first][which]
        for step in range(width):
            same &= words[mine + step] == words[other + step]
        out[open_[same]] = which[same] + used
        used += len(first)
        open_ = open_[~same]
    return out


def _ranks(classes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of runs of 1, 2, 4 and so on windows, in one order; a run stops where its segment ends."""
    levels = [classes]
    at, step = np.arange(len(classes)), 1
    while step < int((ends - at).max(initial=0)):
        behind = at + step
        inside = behind < ends
        second = np.where(inside, levels[-1][np.minimum(behind, len(at) - 1)] + 1, 0)
        _, rank = np.unique(levels[-1] * (len(at) + 2) + second, return_inverse=True)
        levels.append(rank)
        step *= 2
    return levels


def _nearest_smaller(ids: np.ndarray, group: np.ndarray, back: bool) -> np.ndarray:
    """For each place the nearest one before (or behind) it of smaller id in its group, or -1.

    All that a place skips has no smaller id than the place it skipped from, so
    a place may always go on to where the place it looks at has got.
    """
    if not back:
        count = len(ids)
        mirrored = _nearest_smaller(ids[::-1], group[::-1], True)[::-1]
        return np.where(mirrored < 0, -1, count - 1 - mirrored)
    near = np.arange(len(ids)) - 1
    open_ = np.arange(len(ids))
    while True:
        at = near[open_]
        outside = (at < 0) | (group[np.maximum(at, 0)] != group[open_])
        near[open_[outside]] = -1
        open_, at = open_[~outside], at[~outside]
        skip = ids[at] >= ids[open_]
        open_, at = open_[skip], at[skip]
        if not len(open_):
            return near
        near[open_] = near[at]


def longest_factors(classes: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the most windows from it on that a smaller id holds in a row, and where it holds them.

    ``ids`` are the windows' documents, ``ends`` the ends of their segments. A
    window that no smaller id holds has 0.
    """
    levels = _ranks(classes, ends)
    order = np.argsort(levels[-1], kind="stable")
    length, source = np.zeros(len(classes), np.int64), np.full(len(classes), -1)
    for back in (True, False):
        near = _nearest_smaller(ids[order], classes[order], back)
        some = np.flatnonzero(near >= 0)
        mine, other = order[some], order[near[some]]
        a, b = mine.copy(), other.copy()
        for level in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((a < ends[mine]) & (b < ends[other]))
            # Runs that reach the end of a segment are compared by the shorter levels.
            whole = inside[np.minimum(ends[mine] - a, ends[other] - b)[inside] >= 1 << level]
            same = whole[levels[level][a[whole]] == levels[level][b[whole]]]
            a[same] += 1 << level
            b[same] += 1 << level
        shared = a - mine
        longer = shared > length[mine]
        length[mine[longer]], source[mine[longer]] = shared[longer], other[longer]
    return length, source


def parse(
    anchor: np.ndarray, ids: np.ndarray, size: np.ndarray, words: np.ndarray, width: int
) -> tuple[np.ndarray, ...]:
    """Parse segments, sorted by anchor and document, against the blocks of their anchors.

    ``words`` are the word hashes of all segments, ``size`` how many windows each
    has. Returns for each factor its segment, first window, number of windows,
    and document.
    """
    segment = np.repeat(np.arange(len(size)), size)
    offset = np.cumsum(size) - size
    ends = (offset + size)[segment]
    length, source = longest_factors(window_classes(anchor, size, words, width), ids[segment], ends)
    # The next place, from each one on, that has a factor.
    place = np.where(length > 0, np.arange(len(length)), len(length))
    following = np.append(np.minimum.accumulate(place[::-1])[::-1], len(length))
    at, found = following[offset], []
    within = offset + size
    while True:
        alive = at < within
        at, within = at[alive], within[alive]
        if not len(at):
            break
        found.append(at)
        at = following[at + length[at]]
    begin = np.sort(np.concatenate([np.zeros(0, np.int64), *found]))
    return segment[begin], begin - offset[segment[begin]], length[begin], ids[segment[source[begin]]]


def _parse(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "anchor", 1 << 15):
            anchor, ids, key_hash, place = (table.column(c).to_numpy() for c in ("anchor", "key_id", "key_hash", "place"))
            start, size, _ = P.unpack(place)
            words = np.frombuffer(b"".join(body.as_py() for body in table.column("body")), np.uint64)
            segment, first, length, source = parse(anchor, ids, size, words, width)
            columns = [ids[segment], key_hash[segment], P.pack(start[segment] + first, length), source]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["key_id", "key_hash", "place", "other"])

    return run


def spans(docs: DataFrame, width: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Factors of a window or more: key, packed ``place`` of its windows, and ``other``, the document referred to."""
    windows = Windows("words", width, min(gram, width))
    decided = P.decide(docs, windows, ordered=True)
    rows = P.contexts(docs, decided.filter("asked"), windows, _word_hashes(width))
    late = stage(in_tasks(rows, _parse(width), "key_id bigint, key_hash bigint, place bigint, other bigint"))
    return decided.filter("NOT asked").select("key_id", "key_hash", "place", "other").unionByName(late)


def factors(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """The duplicate spans of each document: ``doc_id``, first word, words, and the document they are copied from."""
    found = spans(docs, width)
    start, size = P.span_columns(width)
    return found.select(shown_id(), start.alias("first_word"), size.alias("n_words"), F.col("other").alias("copied_from"))


def _remove(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                words = W.split(chunk.data, chunk.offsets)
                gone = P.covered_tokens(batch, chunk, words.first, width)
                line, _, texts = W.joined(chunk.data, words, ~gone)
                kept = [line[a : b - 1] if b > a else b"" for a, b in zip(texts[:-1].tolist(), texts[1:].tolist())]
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[words.first[1:]] - total[words.first[:-1]]
                own = slice(chunk.low, chunk.high)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key_id")[own],
                        pa.array(np.diff(words.first)),
                        pa.array(removed),
                        pa.array([text.decode() for text in kept]),
                        pa.array([hashlib.sha256(text).hexdigest() for text in kept]),
                    ],
                    ["key_id", "n_words", "n_removed", "kept", "kept_sha256"],
                )

    return run


def remove_repeats(docs: DataFrame, width: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Each document without the words of its factors: ``doc_id``, counts, ``kept`` text and its SHA-256."""
    rows = P.with_places(docs, spans(docs, width, gram))
    schema = "key_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    return in_tasks(rows, _remove(width), schema).select(shown_id(), "n_words", "n_removed", "kept", "kept_sha256")
