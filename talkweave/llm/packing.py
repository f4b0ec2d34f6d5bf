"""Best-fit packing of documents into sequences, by linear grouping.

Lengths are whole numbers up to the capacity, so a histogram of them, of at most
as many rows as the capacity, says all that a packing depends on, however many
documents there are. It is planned on the driver:

1. Lengths above a part of the capacity are sorted and cut into groups of equal
   cardinality, and rounded up to the largest of their group.
2. For these few sizes, the best mix of configurations (sets of sizes that fit) is
   found by column generation: a linear program whose new columns come from a
   knapsack over the program's prices.
3. Actual lengths are put in the places of the rounded ones.
4. What the program leaves over, and the small lengths, go into the gaps by best
   fit in decreasing length.

Which lengths count as large and how many groups there are decide how much room
the rounding wastes and how much best fit can fill. The plan is made for each pair
of ``SCHEMES``, from the histogram alone, and the one of fewest sequences is used.

The plan says, for a run of the documents of one length, which sequences and
offsets they get. Every document has a number among those of its length, from
counts by task, and looks itself up. Only longer documents are cut.

Defined cases: a missing or empty text is one piece with only the end id; texts
of equal content are pieces of their own; repeated rows are packed each; no rows
give no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.rows import in_tasks, keyed, shown_id
from talkweave.llm.tokens import word_tokens
from talkweave.session import stage

CAPACITY = 2048
END_ID = 0
#: The part of the capacity above which a length is large, and the number of groups.
SCHEMES = ((1 / 8, 24), (1 / 4, 48), (2 / 5, 48), (1 / 2, 48))

PIECE = "key_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        tokens = word_tokens(path)
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                ids, begin = tokens.of_chunk(chunk, END_ID)
                count = -(-np.diff(begin) // capacity)
                row = np.repeat(np.arange(len(count)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(np.diff(begin)[row] - start, capacity)
                data = ids.astype("<u4").tobytes()
                place = 4 * (begin[row] + start)
                sums = [zlib.crc32(data[a:b]) for a, b in zip(place.tolist(), (place + 4 * length).tolist())]
                # The number of each piece among those of its length in this task.
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                run_start = np.searchsorted(ordered, ordered)
                number = np.empty(len(row), np.int64)
                number[order] = np.arange(len(row)) - run_start + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                ids_of = batch.column("key_id")[chunk.low : chunk.high].to_numpy()[row]
                columns = [ids_of, piece.astype(np.int32), start, length, np.array(sums, np.int64), number]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(np.full(len(row), task, np.int64))],
                    ["key_id", "piece", "start", "length", "ids_crc32", "number", "task"],
                )

    return run


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable set of sizes, with repeats, that fits."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    ascending = np.argsort(sizes)
    small, worth = sizes[ascending], values[ascending]
    for room in range(int(small[0]), capacity + 1):
        fit = int(np.searchsorted(small, room, "right"))
        totals = best[room - small[:fit]] + worth[:fit]
        top = int(totals.argmax())
        best[room], choice[room] = best[room - 1], -1
        if totals[top] > best[room] + 1e-12:
            best[room], choice[room] = totals[top], ascending[top]
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations (how often each size) and how many sequences of each, by column generation.

    The program's fractions are rounded down, so no demand is exceeded.
    """
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(12 * len(sizes)):
        amounts = np.linalg.solve(basis, demand.astype(float))
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, column = knapsack(sizes, np.maximum(prices, 0), capacity)
        if value <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, column.astype(float))
        ratio = np.full(len(sizes), np.inf)
        np.divide(np.maximum(amounts, 0), change, out=ratio, where=change > 1e-9)
        leaving = int(ratio.argmin())
        if not np.isfinite(ratio[leaving]):
            break
        basis[:, leaving] = column
    amounts = np.floor(np.linalg.solve(basis, demand.astype(float)) + 1e-6).astype(np.int64)
    left = demand.astype(np.int64).copy()
    out = []
    for column, amount in zip(basis.T.astype(np.int64), amounts):
        used = column > 0
        amount = min(int(amount), int((left[used] // column[used]).min()))
        if amount > 0:
            left -= amount * column
            out.append((column, amount))
    return out


@dataclass
class Plan:
    """Runs of documents of one length and their places.

    Document ``first + j`` of a length is in sequence ``sequence + j // per``, at
    ``offset + (j % per) * length``.
    """

    capacity: int
    sequences: int = 0
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    #: Sequences with room: for each room, runs of sequences (first, count).
    rooms: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    open_rooms: list[int] = field(default_factory=list)

    def add_room(self, room: int, first: int, count: int) -> None:
        """Note sequences that have ``room`` left."""
        if count and room:
            if room not in self.rooms:
                self.rooms[room] = []
                insort(self.open_rooms, room)
            self.rooms[room].append((first, count))

    def new(self, contents: list[tuple[int, int]], count: int) -> None:
        """``count`` new sequences, each with one document of every (length, first number)."""
        offset = 0
        for length, first in contents:
            self.runs.append((length, first, self.sequences, 1, offset))
            offset += length
        self.add_room(self.capacity - offset, self.sequences, count)
        self.sequences += count

    def best_fit(self, length: int, first: int, count: int) -> None:
        """Put documents where the least room is left, or into new sequences."""
        while count:
            at = bisect_left(self.open_rooms, length)
            if at == len(self.open_rooms):
                needed = -(-count // (self.capacity // length))
                self.add_room(self.capacity, self.sequences, needed)
                self.sequences += needed
                continue
            room = self.open_rooms[at]
            sequence, free = self.rooms[room].pop()
            if not self.rooms[room]:
                del self.rooms[room]
                self.open_rooms.pop(at)
            # The tightest sequence stays the tightest until the length no longer fits.
            per = room // length
            full = min(free, count // per)
            if full:
                self.runs.append((length, first, sequence, per, self.capacity - room))
                self.add_room(room - per * length, sequence, full)
                first, count, sequence, free = first + full * per, count - full * per, sequence + full, free - full
            if free and 0 < count < per:
                self.runs.append((length, first, sequence, per, self.capacity - room))
                self.add_room(room - count * length, sequence, 1)
                sequence, free, count = sequence + 1, free - 1, 0
            self.add_room(room, sequence, free)


def _grouped(lengths: list[int], counts: dict[int, int], groups: int) -> list[list[tuple[int, int, int]]]:
    """Runs (length, first number, count) in groups of equal cardinality, longest first."""
    each = -(-sum(counts[n] for n in lengths) // groups)
    out: list[list[tuple[int, int, int]]] = [[]]
    room = each
    for length in lengths:
        first, left = 0, counts[length]
        while left:
            if not room:
                out.append([])
                room = each
            some = min(left, room)
            out[-1].append((length, first, some))
            first, left, room = first + some, left - some, room - some
    return out


def _substitute(plan: Plan, queues: list[list[tuple[int, int, int]]], column: np.ndarray, amount: int) -> None:
    """Fill ``amount`` sequences of a configuration with the next actual documents of its groups."""
    slots = []
    for group in np.flatnonzero(column):
        for _ in range(int(column[group])):
            slot, needed = [], amount
            while needed:
                length, first, count = queues[group].pop(0)
                some = min(count, needed)
                slot.append((length, first, some))
                if some < count:
                    queues[group].insert(0, (length, first + some, count - some))
                needed -= some
            slots.append(slot)
    done = 0
    while done < amount:
        step = min(slot[0][2] for slot in slots)
        plan.new([(slot[0][0], slot[0][1]) for slot in slots], step)
        for slot in slots:
            length, first, count = slot.pop(0)
            if count > step:
                slot.insert(0, (length, first + step, count - step))
        done += step


def make_plan(counts: dict[int, int], capacity: int, part: float, groups: int) -> Plan:
    """Pack a histogram of lengths (1 to ``capacity``) by one scheme."""
    plan = Plan(capacity)
    if counts.get(capacity):
        plan.new([(capacity, 0)], counts[capacity])
    descending = sorted((n for n in counts if n < capacity and counts[n]), reverse=True)
    large = [n for n in descending if n > part * capacity]
    rest: list[tuple[int, int, int]] = [(n, 0, counts[n]) for n in descending if n <= part * capacity]
    if large:
        queues: list[list[tuple[int, int, int]]] = []
        for group in _grouped(large, counts, groups):
            # Groups of the same rounded size are one size.
            if queues and queues[-1][0][0] == group[0][0]:
                queues[-1] += group
            else:
                queues.append(group)
        sizes = np.array([queue[0][0] for queue in queues])
        demand = np.array([sum(count for _, _, count in queue) for queue in queues])
        for column, amount in configurations(sizes, demand, capacity):
            _substitute(plan, queues, column, amount)
        rest = sorted((run for queue in queues for run in queue), reverse=True) + rest
    for length, first, count in rest:
        plan.best_fit(length, first, count)
    return plan


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan of fewest sequences among those of ``SCHEMES``."""
    return min((make_plan(counts, capacity, *scheme) for scheme in SCHEMES), key=lambda plan: plan.sequences)


def _assign(plan: Plan):
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    keys = (runs[:, 0] << 48) + runs[:, 1]
    runs = runs[:, 1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            first, sequence, per, offset = runs[np.searchsorted(keys, (length << 48) + number, "right") - 1].T
            step = number - first
            columns = [batch.column(c) for c in ("key_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(sequence + step // per), pa.array(offset + step % per * length)]
            yield pa.RecordBatch.from_arrays(
                columns, ["key_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            )

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place.

    Returns ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and
    ``offset``. The tokenizer's file is read on the executors.
    """
    schema = f"{PIECE}, number bigint, task bigint"
    pieces = stage(in_tasks(keyed(docs), _pieces(tokenizer_path, capacity), schema))
    by_task = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    counts = {row["length"]: row["n"] for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["length", "task"]).withColumn("number", F.col("number") + F.col("before"))
    placed = in_tasks(numbered.drop("before"), _assign(plan), f"{PIECE}, sequence_id bigint, offset bigint")
    return placed.select(shown_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
