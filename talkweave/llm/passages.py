"""Which segments of a corpus hold windows that also begin elsewhere.

Segments are compared by anchor and content. Most are decided at once: a segment
whose equal is elsewhere is a repeat as a whole, and one whose anchor is nowhere
else has no repeats. What is left are segments that share an anchor but not all
content, at the ends of repeated passages; one segment of each content is asked
for and compared in detail by the operator.

Copies met within one batch are decided there, so a batch sends at most one
segment of each content on, however many copies there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.rows import in_tasks, keyed, whole_groups
from talkweave.llm.segments import Windows, hot_anchors, of_batch
from talkweave.session import stage

FACTS = ["anchor", "content", "key_id", "key_hash", "other"]
SEGMENT = ", ".join(f"{name} bigint" for name in FACTS)


#: Neighbouring repeats are put together up to about so many windows.
LONGEST = 1 << 18


def pack(start: np.ndarray, size: np.ndarray, at: np.ndarray | int = 0) -> np.ndarray:
    """Start, number of windows (under 2**20) and place of the anchor (under ``WIDEST``) as one number."""
    return (start.astype(np.int64) << 32) | (size.astype(np.int64) << 12) | at


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverse of ``pack``."""
    return place >> 32, (place >> 12) & 0xFFFFF, place & 0xFFF


def span_columns(width: int) -> list[Column]:
    """``start`` and ``size`` of a packed place in tokens, as columns."""
    size = F.shiftright("place", 12).bitwiseAND(F.lit(0xFFFFF)) + (width - 1)
    return [F.shiftright("place", 32).alias("start"), size.alias("size")]


def starts(*columns: np.ndarray) -> np.ndarray:
    """Flags the first row of each run of equal values in the columns."""
    flag = np.zeros(len(columns[0]), bool)
    flag[:1] = True
    for column in columns:
        flag[1:] |= column[1:] != column[:-1]
    return flag


def joined_runs(text: np.ndarray, start: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put together neighbouring segments of a text with equal ``other``: the first of each run, and its size.

    Segments are in order of text and start.
    """
    fresh = starts(text, other, start // LONGEST)
    fresh[1:] |= start[1:] != start[:-1] + size[:-1]
    head = np.flatnonzero(fresh)
    return head, np.add.reduceat(size, head) if len(head) else size


def _numbers(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    column = table.column(name)
    return column.fill_null(0).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.fill_null(0).to_numpy()


def _offered(columns: list[np.ndarray], edge: np.ndarray, place: np.ndarray, done: bool) -> pa.RecordBatch:
    """Rows with ``places``: of row ``i``, ``place[edge[i] : edge[i + 1]]``."""
    lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(place))
    flags = np.full(len(lists), done)
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), lists, pa.array(flags)], [*FACTS, "places", "done"])


def _offer(windows: Windows, hot: np.ndarray, ordered: bool):
    """Segments of each batch, with copies within the batch decided (``done``).

    What is not decided goes on as one row for each content and document, with all
    its places, however often a document repeats itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = of_batch(batch.column("text"), windows, hot)
            ids, hashes = _numbers(batch, "key_id")[found.text], _numbers(batch, "key_hash")[found.text]
            order = np.lexsort((hashes, ids, found.content, found.anchor))
            anchor, content, ids, hashes = found.anchor[order], found.content[order], ids[order], hashes[order]
            fresh = starts(anchor, content)
            group = np.cumsum(fresh) - 1
            if ordered:
                other = ids[fresh][group]
                done = ids > other
            else:
                other = (np.bincount(group, minlength=1)[group] > 1).astype(np.int64)
                done = ~fresh
            left = [c[~done] for c in (anchor.view(np.int64), content.view(np.int64), ids, hashes, other)]
            row = starts(*left[:4])
            place = pack(found.start, found.size, found.at)[order[~done]]
            edge = np.append(np.flatnonzero(row), len(row))
            yield _offered([column[row] for column in left], edge, place, False)
            # Decided copies go on as runs, in order of text and start again.
            copies = np.sort(order[done])
            back = np.empty(len(order), np.int64)
            back[order] = other
            text, start = found.text[copies], found.start[copies]
            head, size = joined_runs(text, start, found.size[copies], back[copies])
            first = copies[head]
            owner = found.text[first]
            nothing = np.zeros(len(head), np.int64)
            runs = [nothing, nothing, _numbers(batch, "key_id")[owner], _numbers(batch, "key_hash")[owner], back[first]]
            yield _offered(runs, np.arange(len(head) + 1), pack(found.start[first], size), True)

    return run


def _decide(ordered: bool):
    """Whole anchors at a time: repeats (``asked`` is false), and segments to compare in detail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "anchor"):
            rows = {name: _numbers(table, name) for name in FACTS}
            lists = table.column("places").combine_chunks()
            owner_row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            place = lists.flatten().to_numpy()
            done = table.column("done").to_numpy()
            open_ = np.flatnonzero(~done)
            anchor, content, ids = (rows[name][open_] for name in ("anchor", "content", "key_id"))
            fresh = starts(anchor, content)
            new_anchor = starts(anchor)
            group, owner = np.cumsum(fresh) - 1, np.cumsum(new_anchor) - 1
            mixed = (np.bincount(owner, weights=fresh, minlength=1) > 1)[owner]
            if ordered:
                other = ids[fresh][group]
                again = ids > other
                wanted = mixed & ~again
            else:
                again = np.bincount(group, weights=1 + rows["other"][open_], minlength=1)[group] > 1
                other = again.astype(np.int64)
                wanted = mixed & fresh
            rows["other"] = rows["other"].copy()
            rows["other"][open_] = other
            repeat, asked = done.copy(), np.zeros(len(done), bool)
            repeat[open_], asked[open_] = again, wanted
            for flag, chosen in ((False, repeat), (True, asked)):
                some = chosen[owner_row]
                columns = [pa.array(rows[name][owner_row[some]]) for name in FACTS]
                if not flag:
                    columns[:2] = [pa.nulls(len(columns[0]), pa.int64())] * 2
                flags = pa.array(np.full(len(columns[0]), flag))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(place[some]), flags], [*FACTS, "place", "asked"])

    return run


def decide(docs: DataFrame, windows: Windows, ordered: bool) -> DataFrame:
    """The written table of repeats and of segments to compare.

    With ``ordered``, a segment is a repeat if a document of smaller ``key_id`` holds
    its equal, and ``other`` is that document; else if its equal is anywhere else.
    Of segments to compare, ``other`` is the document, or 1 for a known repeat.
    """
    hot = hot_anchors(docs, windows)
    offered = in_tasks(keyed(docs), _offer(windows, hot, ordered), f"{SEGMENT}, places array<bigint>, done boolean")
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = F.when(F.col("done"), F.xxhash64("key_id", "key_hash", "places")).otherwise(F.col("anchor"))
    placed = offered.repartition(count, target).sortWithinPartitions("done", "anchor", "content", "key_id")
    return stage(in_tasks(placed, _decide(ordered), f"{SEGMENT}, place bigint, asked boolean"))


def contexts(docs: DataFrame, asked: DataFrame, windows: Windows, take: Callable) -> DataFrame:
    """The segments asked for with their ``body``, sorted by anchor and ``key_id`` within partitions.

    ``take(chunk, text, start, size)`` makes the bodies, as offsets and bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("asked")
            edge = np.concatenate([[0], np.cumsum(wanted.value_lengths().to_numpy())])
            parts = wanted.flatten()
            fields = {name: parts.field(name).to_numpy() for name in ("anchor", "place", "other")}
            row = np.repeat(np.arange(len(batch)), np.diff(edge))
            for chunk in W.chunks(batch.column("text")):
                own = slice(edge[chunk.low], edge[chunk.high])
                start, size, _ = unpack(fields["place"][own])
                offsets, body = take(chunk, row[own] - chunk.low, start, size)
                body = pa.Array.from_buffers(
                    pa.binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))]
                )
                columns = [pa.array(fields[name][own]) for name in ("anchor", "place", "other")]
                columns += [pa.array(_numbers(batch, name)[row[own]]) for name in ("key_id", "key_hash")]
                yield pa.RecordBatch.from_arrays([*columns, body], ["anchor", "place", "other", "key_id", "key_hash", "body"])

    lists = asked.groupBy("key_id", "key_hash").agg(F.collect_list(F.struct("anchor", "place", "other")).alias("asked"))
    rows = in_tasks(
        keyed(docs).join(lists, ["key_id", "key_hash"]),
        run,
        "anchor bigint, place bigint, other bigint, key_id bigint, key_hash bigint, body binary",
    )
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(count, "anchor").sortWithinPartitions("anchor", "key_id", "key_hash", "place")


def with_places(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Keys and texts of documents with ``places``, the packed spans of each."""
    lists = spans.groupBy("key_id", "key_hash").agg(F.collect_list("place").alias("places"))
    return keyed(docs).join(lists, ["key_id", "key_hash"], "left")


def covered_tokens(batch: pa.RecordBatch, chunk: W.Chunk, first: np.ndarray, width: int) -> np.ndarray:
    """A flag for each token of a chunk that a span covers."""
    lists = batch.column("places").slice(chunk.low, chunk.high - chunk.low)
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    start, size, _ = unpack(lists.flatten().to_numpy())
    start = start + np.repeat(first[:-1], sizes)
    return W.covered(start, size + width - 1, int(first[-1]))
