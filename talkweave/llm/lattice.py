"""Language-model scores from a lattice of subwords.

A text is a row of words and an end. The pieces of an existing vocabulary that spell a
word, with ``MARK`` in front, form a lattice: every path through it is one segmentation,
and its probability is the product of its pieces' probabilities. The word's probability
is the sum over all paths, found by a forward recursion in log space. Characters that
no piece holds are spelt by byte pieces, so every text has a probability.

The vocabulary's own scores are ranks; read as Zipf weights they are the start. One
round or more of expectation maximisation over the training words then gives the
pieces' probabilities: the lattice's forward and backward sums weigh all segmentations,
and expected counts, in millionths, are added up over tasks.

A word's probability does not depend on its neighbours, so each distinct word of the
corpus is summed once. Words of more than a ``FREQUENT`` share of all (hence a
bounded list) are scored in the tasks that read the texts; the other words of each
document meet their scores by a join, in which no word is frequent.

Defined cases: a missing or empty text is the end alone; a missing ``doc_id`` belongs
to the training documents; repeated rows are counted and scored each; no rows give no
rows; further columns are ignored; a very long text is read as one chunk, with some
ten numbers for each word; a very long word is summed in steps, one for each of its
characters. Words are compared with themselves, not by hash alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.rows import in_tasks, row_id, shown_id
from talkweave.session import stage

MARK = "▁"
#: One in so many documents is held out.
HELD_OUT = 10
#: Words with more than this share of the training tokens are scored where they are read.
FREQUENT = 1e-6
EM_ROUNDS = 1
#: Added to the expected count of each piece.
SMOOTHING = 0.1
#: Expected counts are added in whole parts of one, so that sums do not hinge on order.
UNITS = 1_000_000
#: Added to the count of each word in the base score.
BASE_SMOOTHING = 0.1
CHUNK_BYTES = 8 << 20


def vocabulary(path: str) -> tuple[tuple[str, ...], np.ndarray]:
    """The pieces of a vocabulary, byte pieces last, and their Zipf weights as log-probabilities."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    # A mark inside a piece would join words.
    plain = [i for i in plain if MARK not in model.id_to_piece(i)[1:]]
    rank = np.array([-model.get_score(i) for i in plain] + [len(ids)] * 256, float)
    weight = 1 / (1 + np.maximum(rank, 0))
    return tuple(model.id_to_piece(i) for i in plain), np.log(weight / weight.sum())


class Lattice:
    """The lattices of words over a vocabulary with log-probabilities; the last 256 are those of bytes."""

    def __init__(self, pieces: tuple[str, ...], logs: np.ndarray) -> None:
        self.machine = _machine(pieces)
        self.sizes = [len(piece) for piece in pieces]
        self.logs = logs.tolist()
        self.first_byte = len(pieces)
        self.spelt: dict[str, float] = {}

    def _by_bytes(self, char: str) -> float:
        value = self.spelt.get(char)
        if value is None:
            value = sum(self.logs[self.first_byte + b] for b in char.encode())
            self.spelt[char] = value
        return value

    def forward(self, word: str) -> tuple[list[float], list[tuple[int, int, float]]]:
        """The log-probability of each prefix, and the edges (start, piece, log-probability) by their ends."""
        text = MARK + word
        sums, logs, sizes = [0.0], self.logs, self.sizes
        found = self.machine.iter(text)
        end, piece = next(found, (-1, 0))
        edges = []
        for i, char in enumerate(text):
            total = sums[i] + self._by_bytes(char)
            while end == i:
                start = i + 1 - sizes[piece]
                log = logs[piece]
                edges.append((start, piece, log))
                x = sums[start] + log
                if x > total:
                    total, x = x, total
                total += math.log1p(math.exp(x - total))
                end, piece = next(found, (-1, 0))
            sums.append(total)
        return sums, edges

    def log_probability(self, word: str) -> float:
        """The natural logarithm of the sum over all segmentations of a word."""
        return self.forward(word)[0][-1]

    def expect(self, word: str, times: int, counts: np.ndarray) -> None:
        """Add the expected counts of all pieces in ``times`` of the word to ``counts``."""
        sums, edges = self.forward(word)
        text, whole = MARK + word, sums[-1]
        behind = [-math.inf] * len(text) + [0.0]
        ends = len(edges)
        for i in range(len(text), 0, -1):
            after = behind[i]
            char = text[i - 1]
            steps = [(i - 1, -1, self._by_bytes(char))]
            while ends and edges[ends - 1][0] + self.sizes[edges[ends - 1][1]] == i:
                ends -= 1
                steps.append(edges[ends])
            for start, piece, log in steps:
                weight = times * math.exp(sums[start] + log + after - whole)
                if piece < 0:
                    for b in char.encode():
                        counts[self.first_byte + b] += weight
                else:
                    counts[piece] += weight
                x, y = after + log, behind[start]
                if x < y:
                    x, y = y, x
                behind[start] = x + math.log1p(math.exp(y - x)) if y > -math.inf else x


@lru_cache(maxsize=1)
def _machine(pieces: tuple[str, ...]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for number, piece in enumerate(pieces):
        machine.add_word(piece, number)
    machine.make_automaton()
    return machine


def _read(docs: DataFrame) -> DataFrame:
    """Key, text and ``held_out`` of documents."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0
    return docs.select(
        row_id().alias("key_id"),
        F.coalesce(number, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's words with their number in training documents; NULL stands for the end."""
    for batch in batches:
        training = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        for chunk in W.chunks(batch.column("text"), CHUNK_BYTES):
            data = W.LOWER_ARRAY[chunk.data]
            words = W.split(data, chunk.offsets)
            number, example = W.word_numbers(data.tobytes(), words)
            counted = np.repeat(training[chunk.low : chunk.high], np.diff(words.first))
            counts = np.bincount(number, weights=counted, minlength=len(example)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [W.strings(data, words.start[example], words.end[example]), pa.array(counts)], ["word", "n"]
            )
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([int(training.sum())])], ["word", "n"])


def _expect(pieces: tuple[str, ...], logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, logs)
        for batch in batches:
            counts = np.zeros(len(logs))
            for word, times in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                lattice.expect(word, times, counts)
            some = np.flatnonzero(counts)
            units = np.round(counts[some] * UNITS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(units)], ["piece", "units"])

    return run


def _marginals(pieces: tuple[str, ...], logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, logs)
        for batch in batches:
            sums = [lattice.log_probability(word) / math.log(10) for word in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(sums, pa.float64())], ["word", "n", "log10"])

    return run


def fit(words: DataFrame, ends: int, pieces: tuple[str, ...], logs: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float]:
    """Log-probabilities of the pieces and of the end, from the training words (``word``, ``n``)."""
    end = 0.0
    for _ in range(rounds):
        found = in_tasks(words, _expect(pieces, logs), "piece bigint, units bigint")
        # At most one row for each piece of the vocabulary.
        rows = found.groupBy("piece").agg(F.sum("units").alias("units")).collect()
        counts = np.full(len(logs) + 1, SMOOTHING)
        counts[-1] += ends
        for row in rows:
            counts[row["piece"]] += row["units"] / UNITS
        all_logs = np.log(counts / counts.sum())
        logs, end = all_logs[:-1], float(all_logs[-1])
    return logs, end


def _score(frequent: list[tuple[bytes, float, float, bool]], end: tuple[float, float, bool]):
    """Sums over the frequent words and the end of each document; its other words are listed with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(tuple(row[0] for row in frequent))
        base, score = (np.array([row[i] for row in frequent]) for i in (1, 2))
        known = np.array([row[3] for row in frequent], np.int64)
        part, rows = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), CHUNK_BYTES):
                data = W.LOWER_ARRAY[chunk.data]
                words = W.split(data, chunk.offsets)
                texts = chunk.high - chunk.low
                number, example = W.word_numbers(data.tobytes(), words)
                place = table.find(data.tobytes(), words.start[example], (words.end - words.start)[example])[number]
                owner = np.repeat(np.arange(texts), np.diff(words.first))
                held = place >= 0
                sums = [
                    np.bincount(owner[held], weights=values[place[held]], minlength=texts) if len(values) else np.zeros(texts)
                    for values in (base, score, known)
                ]
                # The other words of each document, once each.
                rest = owner[~held] * max(1, len(example)) + number[~held]
                rest, times = np.unique(rest, return_counts=True)
                whose, which = np.divmod(rest, max(1, len(example)))
                at = example[which]
                edge = np.searchsorted(whose, np.arange(texts + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays(
                    [W.strings(data, words.start[at], words.end[at]), pa.array(times.astype(np.int64))], ["word", "times"]
                )
                own = slice(chunk.low, chunk.high)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part + rows + np.arange(texts)),
                        batch.column("key_id")[own],
                        batch.column("held_out")[own],
                        pa.array(np.diff(words.first) + 1),
                        pa.array(sums[2].astype(np.int64) + end[2]),
                        pa.array(sums[0] + end[0]),
                        pa.array(sums[1] + end[1]),
                        pa.ListArray.from_arrays(pa.array(edge), pairs),
                    ],
                    ["row", "key_id", "held_out", "n_tokens", "n_known", "base", "score", "rest"],
                )
                rows += texts

    return run


@lru_cache(maxsize=1)
def _table(words: tuple[bytes, ...]) -> W.WordTable:
    return W.WordTable(list(words))


SCORED = (
    "row bigint, key_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double,"
    " rest array<struct<word:string,times:bigint>>"
)


def score(docs: DataFrame, vocabulary_path: str, rounds: int = EM_ROUNDS, frequent: float = FREQUENT) -> DataFrame:
    """Score every document by the model learnt from those that are not held out.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``,
    logarithms to the base of ten. The vocabulary's file is read on the driver.
    """
    rows = _read(docs)
    counts = stage(in_tasks(rows, _count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    words = counts.filter("word IS NOT NULL")
    total, distinct, ends = counts.agg(
        F.sum("n"), F.count_if(F.col("n") > 0), F.max(F.when(F.col("word").isNull(), F.col("n")))
    ).first()
    total, ends = total or 0, ends or 0
    pieces, logs = vocabulary(vocabulary_path)
    logs, end_log = fit(words.filter("n > 0"), ends, pieces, logs, rounds)
    below = math.log10(total + BASE_SMOOTHING * (distinct + 1))
    base = F.log10(F.col("n") + BASE_SMOOTHING) - below
    marginals = stage(
        in_tasks(words, _marginals(pieces, logs), "word string, n bigint, log10 double").select("word", "n", base.alias("base"), "log10")
    )
    # Each holds more than its share, so there are at most 1 / frequent of them.
    common = marginals.filter(F.col("n") > frequent * total)
    listed = [(row["word"].encode(), row["base"], row["log10"], row["n"] > 0) for row in common.collect()]
    listed.sort()
    end = (math.log10(ends + BASE_SMOOTHING) - below, end_log / math.log(10), ends > 0)
    scored = stage(in_tasks(rows, _score(listed, end), SCORED))
    others = scored.select("row", F.inline("rest")).join(marginals.hint("shuffle_hash"), "word")
    sums = others.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.col("base")).alias("more_base"),
        F.sum(F.col("times") * F.col("log10")).alias("more_score"),
    )

    def both(name: str, more: str, zero: int | float):
        return F.col(name) + F.coalesce(F.col(more), F.lit(zero))

    return scored.drop("rest").join(sums, "row", "left").select(
        shown_id(),
        "held_out",
        "n_tokens",
        both("n_known", "more_known", 0).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        both("base", "more_base", 0.0).alias("base_score"),
        both("score", "more_score", 0.0).alias("score"),
    )
