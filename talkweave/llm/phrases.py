"""Phrase collocations, from counts of the longest windows alone.

Each place of a piece of text starts one window of ``LONGEST`` words; behind the end
of the piece it is padded. Only these windows are counted, in columns ``w1`` to ``w4``.
A ROLLUP over the columns then sums them by successively shorter prefixes, which gives
the number of all words, words and phrases of every length at once: a phrase occurs
once for each window that it begins.

Windows are cut short where no candidate can go on, before they are counted. Pairs of
neighbouring words are counted by slots of a hash (``SLOTS``); then the runs of three and
four words of which all pairs lie in slots of ``LEAST`` or more. A window ends where the
run up to there, or a pair in it, has a slot of fewer, as the run itself then has fewer.
No phrase of ``LEAST`` or more is touched, and what counts is what ROLLUP sums. The slots
that reach ``LEAST`` go to the tasks as ``BITS`` bits, for any corpus; runs that share a
bit with one of these are counted for nothing, no more.

Candidates are the phrases of two to ``LONGEST`` words that occur ``LEAST`` times or more.
Their parts occur at least as often, so all that scores and comparisons with longer
candidates need is in the table of counts of ``LEAST`` or more.

Defined cases: a missing or empty text has no words; a missing ``lang`` counts as
``und``; repeated rows are counted each; ties in the ranks are ordered by phrase; no
rows give no rows; further columns are ignored; a very long text is read as one
chunk, with some ten numbers for each word. Words are compared with themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.rows import in_tasks
from talkweave.session import stage

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
TOP = 2000
#: A candidate is dropped if a longer one around it occurs at least this many times in a hundred.
INSIDE_PERCENT = 80
#: Slots in which pairs and longer runs of words are counted.
SLOTS = 1 << 40
#: Bits that tell the tasks which slots are full: 16 MB for pairs, 16 MB for longer runs.
BITS = 1 << 27

BREAK = np.zeros(256, bool)
BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
SPACE = np.zeros(256, bool)
SPACE[list(b" \t")] = True
NO_WORD = BREAK | SPACE

COLUMNS = [f"w{i + 1}" for i in range(LONGEST)]


class Full(NamedTuple):
    """Which slots hold enough, by one bit for all slots that are equal modulo the number of bits."""

    slots: int
    bits: np.ndarray

    def has(self, slot: np.ndarray) -> np.ndarray:
        at = slot & (64 * len(self.bits) - 1)
        return ((self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class Windows:
    """The windows of a chunk of texts: words by number, and how many follow in the same piece."""

    def __init__(self, chunk: W.Chunk, lang: np.ndarray) -> None:
        self.data = W.LOWER_ARRAY[chunk.data]
        self.words = W.split(self.data, chunk.offsets, NO_WORD)
        self.number, self.example = W.word_numbers(self.data.tobytes(), self.words)
        owner = np.repeat(np.arange(chunk.high - chunk.low), np.diff(self.words.first))
        self.lang = lang[chunk.low : chunk.high][owner]
        # A word begins a piece if a text begins or a break lies before it.
        breaks = np.concatenate([[0], np.cumsum(BREAK[self.data])])
        fresh = np.ones(len(owner) + 1, bool)
        fresh[1:-1] = (owner[1:] != owner[:-1]) | (breaks[self.words.start[1:]] > breaks[self.words.end[:-1]])
        self.follows = ~fresh[1:]

        spelt = W.xxh64(self.data.tobytes(), self.words.start[self.example], self._lengths(), 1)
        self.hashes = spelt[self.number]

    def _lengths(self) -> np.ndarray:
        return self.words.end[self.example] - self.words.start[self.example]

    def slots(self, salts: np.ndarray, size: int, count: int) -> np.ndarray:
        """The slot of the ``size`` words from each place on; ``salts`` are numbers of the languages."""
        mixed = self.hashes + salts[self.lang]
        for step in range(1, size):
            mixed = W.mix(mixed * np.uint64(0x9E3779B97F4A7C15) + ahead(self.hashes, step))
        return (mixed % np.uint64(count)).astype(np.int64)

    def frequent(self, salts: np.ndarray, pairs: Full) -> np.ndarray:
        """Does the next word follow in the same piece, and is the pair's slot full?"""
        return self.follows & pairs.has(self.slots(salts, 2, pairs.slots))


def ahead(values: np.ndarray, step: int) -> np.ndarray:
    """The values ``step`` places further on; zeros behind the end."""
    step = min(step, len(values))
    return np.append(values[step:], np.zeros(step, values.dtype))


def _languages(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The number of each row's language, the languages, and a hash of each."""
    coded = batch.column("lang").dictionary_encode()
    names = coded.dictionary
    salts = np.array([W.xxhash.xxh64_intdigest(name.encode()) for name in names.to_pylist()], np.uint64)
    return coded.indices.to_numpy(), names, salts


def _slot_counts(slots: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for found in slots:
        slot, n = np.unique(found, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n.astype(np.int32))], ["slot", "n"])


def _pairs(slots: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            lang, _, salts = _languages(batch)
            for chunk in W.chunks(batch.column("text")):
                windows = Windows(chunk, lang)
                yield windows.slots(salts, 2, slots)[windows.follows]

    return lambda batches: _slot_counts(found(batches))


def _longer(pairs: Full):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            lang, _, salts = _languages(batch)
            for chunk in W.chunks(batch.column("text")):
                windows = Windows(chunk, lang)
                goes_on = windows.frequent(salts, pairs)
                alive = goes_on
                for size in range(3, LONGEST + 1):
                    alive = alive & ahead(goes_on, size - 2)
                    yield windows.slots(salts, size, pairs.slots)[alive]

    return lambda batches: _slot_counts(found(batches))


def full_slots(counted: DataFrame, slots: int, bits: int, least: int) -> Full:
    """The slots whose ``n`` add up to ``least`` or more; ``bits`` is a power of two, 64 or more."""
    full = counted.groupBy("slot").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    bit = F.col("slot").bitwiseAND(F.lit(bits - 1)).cast("int")
    # At most bits / 64 rows of 64 bits, for any corpus.
    held = full.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at"))
    found = held.agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    if len(found):
        out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Full(slots, out)


def _windows(pairs: Full, longer: Full):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, names, salts = _languages(batch)
            for chunk in W.chunks(batch.column("text")):
                windows = Windows(chunk, lang)
                total = len(windows.number)
                if not total:
                    continue
                goes_on = windows.frequent(salts, pairs)
                # Word numbers from 1; 0 is padding.
                column, alive = windows.number + 1, np.ones(total, bool)
                columns = [column]
                for step in range(1, LONGEST):
                    alive = alive & ahead(goes_on, step - 1)
                    if step > 1:
                        alive = alive & longer.has(windows.slots(salts, step + 1, longer.slots))
                    columns.append(np.where(alive, ahead(column, step), 0))
                key = windows.lang.astype(np.int64)
                for column in columns:
                    _, key = np.unique(key * (len(windows.example) + 1) + column, return_inverse=True)
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                at = windows.example
                spelt = W.strings(windows.data, windows.words.start[at], windows.words.end[at])
                spelt = pa.concat_arrays([pa.array([""]), spelt])
                out = [spelt.take(pa.array(column[first])) for column in columns]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(windows.lang[first])), *out, pa.array(n)], ["lang", *COLUMNS, "n"]
                )

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, slots: int = SLOTS, bits: int = BITS) -> DataFrame:
    """``lang``, ``size``, ``phrase`` and ``f`` of all phrases of ``least`` or more; size 0 counts all words of a language."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    pairs = full_slots(in_tasks(rows, _pairs(slots), "slot bigint, n int"), slots, bits, least)
    longer = full_slots(in_tasks(rows, _longer(pairs), "slot bigint, n int"), slots, bits, least)
    windows = in_tasks(rows, _windows(pairs, longer), f"lang string, {', '.join(f'{c} string' for c in COLUMNS)}, n bigint")
    # Each window is one row before its prefixes multiply it.
    counted = windows.groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # The bits of the level tell which columns are summed over; padding is no word.
    size = sum((F.when(F.col("level").bitwiseAND(F.lit(1 << i)) == 0, 1).otherwise(0) for i in range(LONGEST)), F.lit(0))
    whole = F.col("lang").isNotNull() & ((F.col("f") >= least) | (F.col("level") == (1 << LONGEST) - 1))
    unpadded = F.lit(True)
    for column in COLUMNS:
        unpadded = unpadded & (F.col(column).isNull() | (F.col(column) != ""))
    return stage(
        summed.filter(whole & unpadded).select("lang", size.alias("size"), F.concat_ws(" ", *COLUMNS).alias("phrase"), "f")
    )


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, slots: int = SLOTS, bits: int = BITS) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` how often its parts do at its
    weakest cut, and ``n`` the number of words of the language.
    """
    counts = phrase_counts(docs, least, slots, bits)
    frequent = counts.filter("size > 0")
    words = F.split("phrase", " ")
    candidates = counts.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ").alias("tail"),
    )
    part = frequent.select("lang", "phrase", "f")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    scale, a, both = _exact(F.lit(SCALE)), _exact(F.col("a")), _exact(F.col("l")) + _exact(F.col("r"))
    cuts = cuts.withColumn("score", F.call_function("div", (scale * a).cast("decimal(38,0)"), both.cast("decimal(38,0)")))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Every shorter candidate inside a longer one, with the most that any of these occurs.
    place = F.expr("sequence(0, size - 2)"), F.expr("sequence(2, size - 1)")
    inner = (
        candidates.filter("size > 2")
        .withColumn("from", F.explode(place[0]))
        .withColumn("long", F.explode(place[1]))
        .filter("from + long <= size")
        .select("lang", F.array_join(F.slice(words, F.col("from") + 1, F.col("long")), " ").alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    kept = weakest.join(inner, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * _exact(F.col("around")) < INSIDE_PERCENT * _exact(F.col("a")))
    )
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    best = first_of_each(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score")
    )


def first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each language with their rank; slices are cut first, so no language is ranked as a whole."""
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    best = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
    best = best.filter(F.col("rank") <= top).drop("rank", "slice")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
