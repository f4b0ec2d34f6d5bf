"""Cutting texts into segments that equal passages share, by anchors taken from the content.

A window is ``width`` consecutive tokens (words or bytes) of a text. Its anchor is
the run of ``gram`` tokens in it whose hash ranks lowest, so equal windows have
equal anchors at equal places. Neighbouring windows mostly share their anchor; a
segment is a maximal run of windows with one anchor, and its tokens are those of
all its windows. Hence two windows can be equal only if their segments have the
same anchor, and all windows of equal segments are equal.

Runs of tokens that are frequent in the corpus (``hot``) rank last, so windows
around a common line or passage take a rarer anchor. A window in which all of them
are frequent is a segment of its own, and its content stands for its anchor: many
different windows of a large group of near copies then never share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.rows import in_tasks, keyed
from talkweave.session import stage

#: An anchor is hot if it holds more than this share of all segments.
HOT_SHARE = 1e-4
LEAST_HOT = 64

#: The place of an anchor in its window is less than this.
WIDEST = 1 << 12

NONE = np.zeros(0, np.uint64)


@dataclass(frozen=True)
class Windows:
    """What a window is: ``width`` tokens, anchored by ``gram`` of them."""

    tokens: str
    width: int
    gram: int

    @property
    def base(self) -> int:
        """The base of the token hashes."""
        return W.WORD_BASE if self.tokens == "words" else W.BYTE_BASE

    def __post_init__(self) -> None:
        if not 0 <= self.gram <= self.width or self.width - self.gram >= WIDEST:
            raise ValueError(f"a window of {self.width} tokens needs an anchor of {self.width - WIDEST + 1} to {self.width}")

    def read(self, chunk: W.Chunk) -> Tokens:
        """The tokens of a chunk."""
        if self.tokens == "words":
            words = W.split(chunk.data, chunk.offsets)
            prefix = W.prefixes(W.word_hashes(chunk.data, words), self.base)
            line, place, _ = W.joined(chunk.data, words)
            return Tokens(prefix, words.first, line, place, place + words.end - words.start)
        place = np.arange(len(chunk.data) + 1)
        return Tokens(W.prefixes(W.BYTE_VALUE[chunk.data], self.base), chunk.offsets, chunk.data.tobytes(), place[:-1], place[1:])


class Tokens(NamedTuple):
    """Tokens of a chunk: prefix hashes, the first token of each text, and the bytes of each token."""

    prefix: np.ndarray
    first: np.ndarray
    line: bytes
    begin: np.ndarray
    end: np.ndarray


class Segments(NamedTuple):
    """Segments of a chunk: text, first token in it, windows, place of the anchor, and hashes.

    ``content`` and, where windows stand for themselves, ``anchor`` are parts of one
    128-bit digest of the segment's bytes.
    """

    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    at: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def _is_hot(grams: np.ndarray, hot: np.ndarray) -> np.ndarray:
    sieve = np.zeros(1 << 20, bool)
    sieve[hot & np.uint64((1 << 20) - 1)] = True
    flag = sieve[grams & np.uint64((1 << 20) - 1)]
    some = np.flatnonzero(flag)
    place = np.minimum(np.searchsorted(hot, grams[some]), len(hot) - 1)
    flag[some] = hot[place] == grams[some]
    return flag


def digests(line: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """BLAKE2b of byte ranges, as two numbers each."""
    ranges = zip(begin.tolist(), end.tolist())
    return np.frombuffer(b"".join([hashlib.blake2b(line[a:b], digest_size=16).digest() for a, b in ranges]), "<u8").reshape(-1, 2)


def cut(tokens: Tokens, windows: Windows, hot: np.ndarray, contents: bool = True) -> Segments:
    """The segments of the texts of a chunk, in order; without ``contents``, anchors only."""
    prefix, first = tokens.prefix, tokens.first
    width, gram = windows.width, windows.gram
    count = len(prefix) - width
    if count <= 0:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    grams = W.sliding_hashes(prefix, gram, windows.base)
    rank = grams >> np.uint64(33)
    if len(hot):
        rank |= _is_hot(grams, hot).astype(np.uint64) << np.uint64(31)
    least = (rank << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    span, size = width - gram + 1, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:count], least[span - size : span - size + count])
    at = least.astype(np.uint32)

    held = np.diff(first)
    long_enough = np.flatnonzero(held >= width)
    steps = np.zeros(count + 1, np.int8)
    steps[first[long_enough]] += 1
    steps[first[long_enough] + held[long_enough] - width + 1] -= 1
    whole = np.cumsum(steps[:-1], dtype=np.int8).astype(bool)
    edge = np.ones(count + 1, bool)
    edge[1:-1] = at[1:] != at[:-1]
    edge[1:-1] |= ~whole[1:] | ~whole[:-1]
    common = (least >> np.uint64(63)).astype(bool)
    edge[:-1] |= common
    edge[1:] |= common
    start = np.flatnonzero(edge[:-1] & whole)
    size = np.flatnonzero(edge[1:] & whole) + 1 - start
    place = at[start].astype(np.int64)
    text = np.searchsorted(first, start, "right") - 1
    if contents:
        digest = digests(tokens.line, tokens.begin[start], tokens.end[start + size + width - 2])
        anchor, content = np.where(common[start], digest[:, 1], grams[place]), digest[:, 0]
    else:
        anchor, content = grams[place], np.zeros(len(start), np.uint64)
    return Segments(text, start - first[text], size, place - start, anchor, content)


def of_batch(texts: pa.Array, windows: Windows, hot: np.ndarray) -> Segments:
    """The segments of all texts of a batch; ``text`` is the row."""
    parts = []
    for chunk in W.chunks(texts):
        part = cut(windows.read(chunk), windows, hot)
        parts.append(part._replace(text=part.text + chunk.low))
    if not parts:
        none = np.zeros(1, np.int64)
        return cut(Tokens(none.astype(np.uint64), none, b"", none[1:], none[1:]), windows, hot)
    return Segments(*(np.concatenate(column) for column in zip(*parts)))


def _near_hot(tokens: Tokens, windows: Windows, hot: np.ndarray) -> np.ndarray:
    """All runs of tokens in the windows of a chunk whose anchor is hot."""
    prefix, first = tokens.prefix, tokens.first
    part = cut(tokens, windows, NONE, contents=False)
    chosen = np.flatnonzero(_is_hot(part.anchor, hot))
    grams = W.sliding_hashes(prefix, windows.gram, windows.base)
    begin = first[part.text[chosen]] + part.start[chosen]
    return grams[W.covered(begin, part.size[chosen] + windows.width - windows.gram, len(grams))]


def _frequent(windows: Windows, hot: np.ndarray):
    """Frequent anchors of each batch, or with ``hot`` the frequent runs of tokens around hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = W.chunks(batch.column("text"))
            if len(hot):
                keys = [_near_hot(windows.read(chunk), windows, hot) for chunk in chunks]
            else:
                keys = [cut(windows.read(chunk), windows, NONE, contents=False).anchor for chunk in chunks]
            ordered = np.sort(np.concatenate([NONE, *keys]))
            edge = np.append(np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)]), len(ordered))
            count = np.diff(edge)
            often = np.flatnonzero(count > (1 if len(hot) else max(1, HOT_SHARE * len(ordered))))
            anchors = ordered[edge[:-1][often]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *anchors.tolist()], pa.int64()), pa.array([len(ordered), *count[often].tolist()], pa.int64())],
                ["anchor", "n"],
            )

    return run


def _counts(docs: DataFrame, windows: Windows, hot: np.ndarray) -> DataFrame:
    rows = in_tasks(keyed(docs), _frequent(windows, hot), "anchor bigint, n bigint")
    return stage(rows.groupBy("anchor").agg(F.sum("n").alias("n")))


def _above(counts: DataFrame, bound: float) -> np.ndarray:
    rows = counts.filter((F.col("n") > bound) & F.col("anchor").isNotNull()).select("anchor").collect()
    return np.sort(np.array([row["anchor"] for row in rows], np.int64).view(np.uint64))


def hot_anchors(docs: DataFrame, windows: Windows) -> np.ndarray:
    """The hashes of frequent runs of tokens, sorted.

    First come frequent anchors: one with more than ``HOT_SHARE`` of all segments has
    more than that share of some batch, so batches only report their own frequent
    ones. Then come the other frequent runs in the windows around these, which
    would be the next anchors. Each holds more than the bound, so there are at most
    ``1 / HOT_SHARE`` times the windows of a segment. The list steers the work and
    does not change what is found.
    """
    counts = _counts(docs, windows, NONE)
    total = counts.filter("anchor IS NULL").first()
    bound = max(LEAST_HOT, HOT_SHARE * (total["n"] if total else 0))
    hot = _above(counts, bound)
    return np.union1d(hot, _above(_counts(docs, windows, hot), bound)) if len(hot) else hot
