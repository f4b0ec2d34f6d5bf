"""SimHash near-duplicates, compared bit-sliced.

A document's fingerprint has a bit for each of the 64 bits of its shingles' hashes:
the majority of them. Fingerprints within ``RADIUS`` differing bits are linked, and
groups are the connected components of the links.

Equal fingerprints are one from the start. To find the links between different
ones, the 64 bits are cut into blocks: two fingerprints that differ in at most
``RADIUS`` bits agree on all but ``RADIUS`` of the blocks, so they share a bucket for
some choice of the others. More distinct fingerprints get more blocks, so that
buckets stay small; a bucket that is large all the same is cut once more, in the
same way, by more blocks. This finds every link whatever the sizes.

Within buckets, fingerprints are stored as bit planes: a 64-bit word holds one bit
of 64 fingerprints. Carry-save adders over these words update 64 distances at a
time, and words in which all distances exceed the radius are abandoned early. A
bucket returns a spanning star for each group in it, never its pairs.

Defined cases: a missing or empty text has fingerprint zero, which links like any
other; a text of fewer words than a shingle is one shingle; a missing ``doc_id``
comes after all others; repeated rows are copies; no rows give no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.llm import words as W
from talkweave.llm.components import connected
from talkweave.llm.rows import in_tasks, keyed, whole_groups
from talkweave.session import stage

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Buckets should hold about so many fingerprints; larger ones are cut once more.
BUCKET = 2048
HOT_BUCKET = 4 * BUCKET
#: Words of 64 comparisons made at a time.
PAIR_WORDS = 1 << 17

U = np.uint64

#: For each byte, its bits as eight byte-wide counters.
BIT_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the bits set in over half of its hashes; ``first`` says where each text's begin."""
    count = np.diff(first)
    out = np.zeros(len(count), U)
    some = np.flatnonzero(count)
    if not len(some):
        return out
    # A byte-wide counter holds up to 255, so hashes are summed in blocks of that many.
    blocks = -(-count[some] // 255)
    begin = np.repeat(first[:-1][some], blocks)
    within = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    sums = [np.add.reduceat(BIT_LANES[octets[:, i]], begin + 255 * within).view(np.uint8).reshape(-1, 8) for i in range(8)]
    text = np.cumsum(blocks) - blocks
    totals = np.add.reduceat(np.concatenate(sums, axis=1).astype(np.int64), text, axis=0)
    bits = 2 * totals > count[some][:, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def shingle_hashes(chunk: W.Chunk, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each shingle of a chunk's texts, and where each text's begin."""
    data = W.LOWER_ARRAY[chunk.data]
    words = W.split(data, chunk.offsets)
    line, place, _ = W.joined(data, words)
    n_words = np.diff(words.first)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    head = W.spread_ranges(words.first[:-1], n_shingles)
    tail = head + np.repeat(np.minimum(n_words, shingle), n_shingles) - 1
    length = place[tail] + (words.end - words.start)[tail] - place[head] if len(head) else head
    hashes = W.xxh64(line, place[head] if len(head) else head, length, SEED)
    return hashes, np.concatenate([[0], np.cumsum(n_shingles)])


def fingerprints(chunk: W.Chunk, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text of a chunk."""
    return majority(*shingle_hashes(chunk, shingle))


def _fingerprint(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprints(chunk, shingle) for chunk in W.chunks(batch.column("text"))]
            if parts:
                prints = pa.array(np.concatenate(parts).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key_id"), batch.column("key_hash"), prints], ["key_id", "key_hash", "fingerprint"]
                )

    return run


def fingerprint_rows(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Each document's key and fingerprint, a 64-bit number."""
    return in_tasks(keyed(docs), _fingerprint(shingle), "key_id bigint, key_hash bigint, fingerprint bigint")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Fingerprints stored vertically: row ``k``, column ``b`` has bit ``b`` of the ``k``-th 64 of them."""
    blocks = -(-len(prints) // 64)
    padded = np.zeros(64 * blocks, U)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8), bitorder="little").reshape(blocks, 64, 64)
    vertical = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(vertical).view(np.uint64)[:, :, 0]


def _add(ones: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A carry-save adder: the sum bits and the carry bits of three words."""
    half = ones ^ x
    return half ^ y, (ones & x) | (half & y)


def within_radius(
    prints: np.ndarray, planes: np.ndarray, query: np.ndarray, block: np.ndarray, wanted: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Compare fingerprint ``query[i]`` with the 64 of ``block[i]``, where ``wanted[i]`` has a bit.

    Returns the queries and the others that are within ``radius`` (at most 7).
    Counters of one, two and four and an overflow hold each distance in its lane.
    """
    value = prints[query]
    ones, twos, fours, over = (np.zeros(len(query), U) for _ in range(4))
    for low in range(0, 64, 4):
        x = [planes[block, bit] ^ (U(0) - ((value >> U(bit)) & U(1))) for bit in range(low, low + 4)]
        ones, carry_a = _add(ones, x[0], x[1])
        ones, carry_b = _add(ones, x[2], x[3])
        twos, carry = _add(twos, carry_a, carry_b)
        over |= fours & carry
        fours ^= carry
        if low in (12, 20, 28, 60):
            near = wanted & ~over & ~_above(ones, twos, fours, radius)
            alive = np.flatnonzero(near)
            if low < 60 and len(alive) < len(near):
                query, block, wanted, value = query[alive], block[alive], wanted[alive], value[alive]
                ones, twos, fours, over = ones[alive], twos[alive], fours[alive], over[alive]
    lanes = np.unpackbits(near[alive].view(np.uint8), bitorder="little").reshape(-1, 64)
    pair, lane = np.nonzero(lanes)
    return query[alive][pair], 64 * block[alive][pair] + lane


def _above(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-bit counter is greater than ``radius``."""
    above, equal = np.zeros_like(ones), ~np.zeros_like(ones)
    for counter, bit in ((fours, 4), (twos, 2), (ones, 1)):
        if radius & bit:
            equal = equal & counter
        else:
            above = above | (equal & counter)
            equal = equal & ~counter
    return above


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Make the labels of linked places equal, each the least place of its group."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            next_label = label[label]
            if (next_label == label).all():
                break
            label = next_label
    return label


def bucket_groups(prints: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For fingerprints sorted by bucket, the place of the least member of each one's group.

    Groups are the components within buckets.
    """
    count = len(prints)
    label = np.arange(count)
    if count < 2:
        return label
    planes = bit_planes(prints)
    edge = np.flatnonzero(np.concatenate([bucket[1:] != bucket[:-1], [True]])) + 1
    end = np.repeat(edge, np.diff(np.concatenate([[0], edge])))
    first_block = (np.arange(count) + 1) // 64
    blocks = np.where(end - np.arange(count) > 1, (end - 1) // 64 - first_block + 1, 0)
    done = np.concatenate([[0], np.cumsum(blocks)])
    low = 0
    while low < count:
        high = max(low + 1, int(np.searchsorted(done, done[low] + PAIR_WORDS, "right")) - 1)
        query = np.repeat(np.arange(low, high), blocks[low:high])
        block = W.spread_ranges(first_block[low:high], blocks[low:high])
        # Only later members of the same bucket: each pair is met once.
        from_lane = np.maximum(query + 1 - 64 * block, 0).astype(U)
        to_lane = np.minimum(end[query] - 64 * block, 64).astype(U)
        wanted = (~U(0) << from_lane) & (~U(0) >> (U(64) - to_lane))
        label = _join(label, *within_radius(prints, planes, query, block, wanted, radius))
        low = high
    return label


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "bucket"):
            prints = table.column("fingerprint").to_numpy().view(np.uint64)
            label = bucket_groups(prints, table.column("bucket").to_numpy(), radius)
            linked = np.flatnonzero(label != np.arange(len(label)))
            a, b = prints[linked].view(np.int64), prints[label[linked]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _mask(width: int) -> int:
    return (1 << width) - 1


def _cuts(bits: int, blocks: int) -> list[tuple[int, int]]:
    """Lowest bit and width of ``blocks`` blocks that cut ``bits`` bits about equally."""
    edges = [bits * i // blocks for i in range(blocks + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def block_count(distinct: int, radius: int = RADIUS) -> int:
    """How many blocks keep the expected bucket of random fingerprints within ``BUCKET``."""
    blocks = radius + 1
    while blocks < 2 * radius and distinct >> (64 * (blocks - radius) // blocks) > BUCKET:
        blocks += 1
    return blocks


def _bits(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit(_mask(width)))


def _shared(value: Column, bits: int, blocks: int, radius: int, salt: Column) -> Column:
    """A bucket for each choice of all but ``radius`` blocks."""
    keys = []
    for number, chosen in enumerate(combinations(_cuts(bits, blocks), blocks - radius)):
        keys.append(F.xxhash64(salt, F.lit(number), *(_bits(value, low, width) for low, width in chosen)))
    return F.array(*keys)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a``, ``b`` that join all of the distinct ``fingerprint`` within ``radius``, directly or by others."""
    distinct = prints.count()
    blocks = block_count(distinct, radius)
    value = F.col("fingerprint")
    rows = stage(prints.select("fingerprint", F.explode(_shared(value, 64, blocks, radius, F.lit(0))).alias("bucket")))
    large = stage(rows.groupBy("bucket").count().filter(F.col("count") > HOT_BUCKET).select("bucket"))
    # A large bucket is cut by more blocks of all 64 bits; its members still meet only each other.
    finer = _shared(value, 64, blocks + 2, radius, F.col("bucket"))
    rows = (
        rows.join(large.select(F.col("bucket").alias("large")), F.col("bucket") == F.col("large"), "left")
        .withColumn("bucket", F.explode(F.when(F.col("large").isNull(), F.array("bucket")).otherwise(finer)))
        .select("bucket", "fingerprint")
    )
    count = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartition(count, "bucket").sortWithinPartitions("bucket", "fingerprint")
    return in_tasks(placed, _links(radius), "a bigint, b bigint")


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For rows (key_id, fingerprint): ``fingerprint``, its group, and the group's least ``key_id`` as ``component_id``.

    ``root``, the least fingerprint of a group, names it also where ids repeat.
    """
    nodes = stage(prints.groupBy("fingerprint").agg(F.min("key_id").alias("node")))
    roots = connected(links(nodes.select("fingerprint"), radius))
    placed = stage(
        nodes.join(roots.withColumnRenamed("a", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", "node", F.coalesce("b", "fingerprint").alias("root")
        )
    )
    least = placed.groupBy("root").agg(F.min("node").alias("component_id"))
    return placed.join(least, "root").select("fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Each document's ``key_id``, ``key_hash``, ``fingerprint``, and its group: ``root`` and ``component_id``."""
    prints = stage(fingerprint_rows(docs, shingle))
    groups = stage(components(prints, radius))
    return prints.join(groups, "fingerprint").select("key_id", "key_hash", "fingerprint", "root", "component_id")
