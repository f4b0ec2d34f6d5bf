"""A Merkle manifest of a dataset, by time-forward processing.

Documents are the leaves. Those of one source, in order of ``doc_id``, form a tree of
``FAN`` children a node; the roots of the sources form another one, whose root stands
for the dataset. Nodes are labelled by level and place, so a child comes before its
parent: every node, taken in order of labels from a priority queue, sends its digest
to its parent's label, and finds its own children's digests when its turn comes. The
reversed sweep takes labels in falling order and sends each node's proof suffix (the
siblings above it) to its children, until the leaves have whole proofs.

The queue is external: a tree is cut into blocks of ``FAN ** LEVELS`` leaves. Within a
block the queue is a heap of bounded size; between blocks, messages travel by Spark's
shuffle, sorted by label. A block hands one digest up and takes one suffix down, so a
source of any size needs a round for every ``LEVELS`` levels and never meets in one task.

Defined cases: a missing field is written as ``-``; a missing ``doc_id`` comes after all
others and is never tampered with; rows of equal ``doc_id`` are leaves of their own, in
order of digests; a missing source is a source of its own, the first; an empty table
has no leaves and no root; further columns are ignored; a very long text is only read
by Spark's own hash functions.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave.llm.rows import in_tasks, whole_groups
from talkweave.session import stage

FAN = 3
#: Levels of a block: 3 ** 8 = 6,561 leaves.
LEVELS = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

NODE = "named boolean, src string, idx bigint, n bigint"


def digest(parts: list[str]) -> str:
    """SHA-256 of digests laid end to end."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: dict[str, Column]) -> Column:
    """The digest of a row: its fields, each ``-`` or its length in bytes, a colon and the value."""
    parts = []
    for name in FIELDS:
        value = row[name].cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered(row: dict[str, Column]) -> dict[str, Column]:
    """The row with the line ends of its text deleted, where the CRC-32 of ``doc_id`` is even."""
    chosen = F.crc32(row["doc_id"].cast("string").cast("binary")) % 2 == 0
    return {**row, "text": F.when(chosen, F.replace(row["text"], F.lit("\n"), F.lit(""))).otherwise(row["text"])}


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``idx``, the place of a row among those of its tree from 0, and ``n``, their number.

    Rows are sorted over range partitions and counted by tree and partition, so a
    large tree is spread over many tasks.
    """
    order = ["named", "src", *order]
    placed = stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("number", F.monotonically_increasing_id())
    )
    counts = placed.groupBy("named", "src", "part").agg(F.count(F.lit(1)).alias("m"), F.min("number").alias("first"))
    tree = Window.partitionBy("named", "src")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(
        counts.select(
            "named", "src", "part", F.sum("m").over(tree).alias("n"),
            (F.coalesce(F.sum("m").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        )
    )
    joined = placed.join(counts, ["named", "src", "part"])
    return joined.withColumn("idx", F.col("number") + F.col("shift")).drop("part", "number", "shift")


def height(n: int) -> int:
    """How many levels a tree of ``n`` leaves has above them."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


class Block:
    """The nodes of a block: its leaves' digests, and ``levels`` levels above them."""

    def __init__(self, leaves: list[str], levels: int) -> None:
        self.sizes = [len(leaves)]
        for _ in range(levels):
            self.sizes.append(-(-self.sizes[-1] // FAN))
        self.base = [0]
        for size in self.sizes:
            self.base.append(self.base[-1] + size)
        self.digests = list(leaves) + [""] * (self.base[-1] - len(leaves))
        self._sweep_up()

    def _place(self, label: int) -> tuple[int, int]:
        level = 0
        while label >= self.base[level + 1]:
            level += 1
        return level, label - self.base[level]

    def _sweep_up(self) -> None:
        """Take nodes by rising label; each sends its digest to its parent."""
        queue = [(self.base[1] + i // FAN, i) for i in range(self.sizes[0])] if len(self.sizes) > 1 else []
        heapq.heapify(queue)
        level = 1
        while queue:
            label, children = queue[0][0], []
            while queue and queue[0][0] == label:
                children.append(self.digests[heapq.heappop(queue)[1]])
            self.digests[label] = digest(children)
            while label >= self.base[level + 1]:
                level += 1
            if level + 1 < len(self.sizes):
                heapq.heappush(queue, (self.base[level + 1] + (label - self.base[level]) // FAN, label))

    @property
    def root(self) -> str:
        """The digest of the top node."""
        return self.digests[-1]

    def run(self, label: int, level: int) -> tuple[list[str], int]:
        """A node's siblings from left to right, and how many are left of it."""
        place = label - self.base[level]
        first = place - place % FAN
        last = min(first + FAN, self.sizes[level])
        others = [self.digests[self.base[level] + i] for i in range(first, last) if i != place]
        return others, place - first

    def sweep_down(self, suffix: str, shape: str) -> Iterator[tuple[int, str, str]]:
        """Take nodes by falling label; each sends its suffix to its children. Yields leaves with their proofs.

        A proof is the siblings level by level; its shape has two digits for each
        level: how many siblings are on the left, and how many there are.
        """
        queue = [(-(self.base[-1] - 1), suffix, shape)]
        while queue:
            label, suffix, shape = heapq.heappop(queue)
            level, place = self._place(-label)
            if level == 0:
                yield place, suffix, shape
                continue
            low = self.base[level - 1] + place * FAN
            for child in range(low, min(low + FAN, self.base[level])):
                others, left = self.run(child, level - 1)
                heapq.heappush(queue, (-child, "".join(others) + suffix, f"{left}{len(others)}{shape}"))


def fold(own: str, proof: str, shape: str) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    for i in range(0, len(shape), 2):
        left, count = int(shape[i]), int(shape[i + 1])
        others = [proof[at + 64 * k : at + 64 * (k + 1)] for k in range(count)]
        own = digest([*others[:left], own, *others[left:]])
        at += 64 * count
    return own


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other."""
    for table in whole_groups(batches, "block_key", 1 << 12):
        held: list[dict] = []
        for row in table.to_pylist():
            if held and (held[-1]["named"], held[-1]["src"], held[-1]["block"]) != (row["named"], row["src"], row["block"]):
                yield held
                held = []
            held.append(row)
        yield held


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"boolean": pa.bool_(), "string": pa.string(), "bigint": pa.int64()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


UP = f"{NODE}, digest string"
DOWN = f"{NODE}, proof string, shape string"
LEAF = "named boolean, src string, doc_id bigint, leaf string, proof_sha256 string, folded_root string"


def _up(levels: int):
    """The digest of each block, as a node of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            first = rows[0]
            block = Block([row["digest"] for row in rows], min(levels, height(first["n"])))
            above = -(-first["n"] // FAN**levels)
            yield _batch([(first["named"], first["src"], first["block"], above, block.root)], UP)

    return run


def _proofs(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[list[tuple[dict, str, str]]]:
    """The nodes of each block with their proofs and shapes; the block's suffix comes before its nodes."""
    for head, *rows in _blocks(batches):
        block = Block([row["digest"] for row in rows], min(levels, height(rows[0]["n"])))
        yield [(rows[place], proof, shape) for place, proof, shape in block.sweep_down(head["proof"], head["shape"])]


def _down(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes in _proofs(batches, levels):
            yield _batch([(row["named"], row["src"], row["idx"], row["n"], proof, shape) for row, proof, shape in nodes], DOWN)

    return run


def _leaves(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes in _proofs(batches, levels):
            out = []
            for row, proof, shape in nodes:
                told = hashlib.sha256(proof.encode()).hexdigest()
                out.append((row["named"], row["src"], row["doc_id"], row["digest"], told, fold(row["bent"], proof, shape)))
            yield _batch(out, LEAF)

    return run


def _by_block(nodes: DataFrame) -> DataFrame:
    """Nodes with their block, whole blocks in one partition, sorted by label."""
    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.withColumn("block_key", F.xxhash64("named", "src", "block"))
    return placed.repartition(count, "block_key").sortWithinPartitions("block_key", "named", "src", "block", "idx")


def climb(nodes: DataFrame, largest: int, levels: int) -> list[DataFrame]:
    """Tables of nodes for each round, from the leaves (``idx``, ``n``, ``digest``) to the roots of their trees."""
    rounds = [nodes]
    while True:
        chosen = rounds[-1].select("named", "src", "idx", "n", "digest", F.expr(f"idx DIV {FAN**levels}").alias("block"))
        rounds.append(stage(in_tasks(_by_block(chosen), _up(levels), UP)))
        largest = -(-largest // FAN**levels)
        if largest <= 1:
            return rounds


def descend(rounds: list[DataFrame], suffixes: DataFrame, levels: int, function, schema: str) -> DataFrame:
    """Send the suffixes of the roots (``proof``, ``shape``) down to the nodes of the first round."""
    for number in range(len(rounds) - 2, -1, -1):
        nodes = rounds[number].withColumn("block", F.expr(f"idx DIV {FAN**levels}"))
        heads = suffixes.select(
            "named", "src", F.col("idx").alias("block"), F.lit(-1).cast("bigint").alias("idx"), "proof", "shape"
        )
        rows = _by_block(heads.unionByName(nodes, allowMissingColumns=True))
        if number:
            suffixes = stage(in_tasks(rows, _down(levels), DOWN))
        else:
            suffixes = in_tasks(rows, function(levels), schema)
    return suffixes


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Each document's leaf, its source's ``subroot``, the ``root``, the digest of its proof, and the check of it.

    ``folded_root`` is recomputed from the tampered leaf and the original siblings;
    the document is ``verified`` if that is the root.
    """
    spark = docs.sparkSession
    row = {name: F.col(name) for name in FIELDS}
    source = F.col("source").cast("string")
    leaves = stage(
        docs.select(
            source.isNotNull().alias("named"),
            F.coalesce(source, F.lit("")).alias("src"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            leaf(row).alias("digest"),
            leaf(tampered(row)).alias("bent"),
        )
    )
    # The last column parts rows that are equal in all others, in any order.
    order = [F.asc_nulls_last("doc_id"), F.col("digest"), F.monotonically_increasing_id()]
    nodes = stage(numbered(leaves, order))
    rounds = climb(nodes, nodes.agg(F.max("n")).first()[0] or 0, levels)
    subroots = rounds[-1].select("named", "src", F.col("digest").alias("subroot"))
    # The second tree: one leaf for each source.
    one = subroots.select(
        F.lit(True).alias("named"), F.lit("").alias("src"), F.col("named").alias("was"), F.col("src").alias("source"),
        F.col("subroot").alias("digest"),
    )
    tops = stage(numbered(one, [F.col("was"), F.col("source")]))
    above = climb(tops, tops.agg(F.max("n")).first()[0] or 0, levels)
    found = above[-1].first()
    root = found["digest"] if found else None
    start = above[-1].select("named", "src", "idx", "n", F.lit("").alias("proof"), F.lit("").alias("shape"))
    above[0] = tops.select("named", "src", "idx", "n", "digest")
    proofs = stage(descend(above, start, levels, _down, DOWN))
    heads = stage(
        tops.select("was", "source", "idx").join(proofs.select("idx", "proof", "shape"), "idx")
        .select(F.col("was").alias("named"), F.col("source").alias("src"), F.lit(0).cast("bigint").alias("idx"), "proof", "shape")
    )
    checked = descend(rounds, heads, levels, _leaves, LEAF)
    return (
        checked.join(subroots, ["named", "src"])
        .withColumn("root", F.lit(root))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    )
