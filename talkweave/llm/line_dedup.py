"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches, in order of ``doc_id``. The keys of a batch are reduced
to one row each and merge-joined with the runs of earlier batches: a key found
there has its first document, a key not found (the anti-join) goes into a new
run. Runs are tables bucketed and sorted by hash, so a batch meets them without
moving them. When a level holds ``FAN`` runs, they are merged into one run of the
next level, so there are few runs however many batches came.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys
of ``LEAST_POINTS`` or more that several documents hold lose their lines in all
but the document of smallest ``doc_id``. Keys are told apart by 96 bits of hash.

Defined cases: a missing or empty text is one empty line; a missing ``doc_id``
comes after all others; rows of equal ``doc_id`` count as one document; no rows
give no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.rows import keyed, shown_id, with_row
from talkweave.session import shared_folder, stage

LEAST_POINTS = 10
BATCHES = 4
FAN = 3

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENDS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(ENDS)), UPPER, UPPER.lower())


def line_hashes(docs: DataFrame) -> DataFrame:
    """One row for each line long enough: ``key_id``, ``key_hash``, ``line``, ``h1``, ``h2``."""
    return (
        keyed(docs)
        .select("key_id", "key_hash", F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
        .withColumn("key", line_key(F.col("content")))
        .filter(F.length("key") >= LEAST_POINTS)
        .select("key_id", "key_hash", "line", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))
    )


@dataclass
class Runs:
    """Sorted runs of (h1, h2, first document), by level."""

    spark: SparkSession
    levels: list[list[str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("path", shared_folder(self.spark)).saveAsTable(name)
        return name

    def add(self, rows: DataFrame) -> None:
        """Add a run, then merge the runs of each level that is full."""
        run, level = self._write(rows), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < FAN:
                return
            full, self.levels[level] = self.levels[level], []
            run = self._write(self._union(full))
            for name in full:
                self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def _union(self, names: list[str]) -> DataFrame:
        rows = self.spark.table(names[0])
        for name in names[1:]:
            rows = rows.unionByName(self.spark.table(name))
        return rows

    def first_documents(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``known``, the document that holds the key in any run."""
        known = []
        for number, name in enumerate(name for level in self.levels for name in level):
            run = self.spark.table(name).select("h1", "h2", F.col("first").alias(f"known_{number}"))
            keys = keys.join(run.hint("merge"), ["h1", "h2"], "left")
            known.append(f"known_{number}")
        found = F.coalesce(*(F.col(name) for name in known), F.lit(None).cast("bigint"))
        return keys.withColumn("known", found).drop(*known)

    def drop(self) -> None:
        """Remove the runs' tables from the catalog."""
        for name in (name for level in self.levels for name in level):
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def bounds(lines: DataFrame, batches: int) -> list[int]:
    """``doc_id`` limits that cut the lines into about equal batches in order of ``doc_id``.

    They decide how much is done at a time, not what is found.
    """
    if batches < 2:
        return []
    shares = [i / batches for i in range(1, batches)]
    return sorted({int(x) for x in lines.approxQuantile("key_id", shares, 0.01)})


def dropped_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The lines to drop: ``key_id``, ``key_hash``, ``line``."""
    spark = docs.sparkSession
    lines = stage(line_hashes(docs))
    limits = bounds(lines, batches)
    runs, repeats = Runs(spark), []
    edges = [None, *limits, None]
    for low, high in zip(edges, edges[1:]):
        batch = lines
        if low is not None:
            batch = batch.filter(F.col("key_id") >= low)
        if high is not None:
            batch = batch.filter(F.col("key_id") < high)
        keys = batch.groupBy("h1", "h2").agg(F.min("key_id").alias("least"), F.max("key_id").alias("most"))
        met = stage(runs.first_documents(keys))
        if high is not None:
            runs.add(met.filter("known IS NULL").select("h1", "h2", F.col("least").alias("first")))
        repeats.append(
            met.withColumn("first", F.coalesce("known", "least"))
            .filter("most > first")
            .select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first", F.lit(low).cast("bigint").alias("low"))
        )
    # A key may repeat in several batches, always with the same first document.
    found = repeats[0]
    for part in repeats[1:]:
        found = found.unionByName(part)
    # Written, so that the join below has two plain shuffles, of which Spark can split a common line's.
    found = stage(found.groupBy("r1", "r2").agg(F.min("first").alias("first")))
    doomed = lines.join(
        found, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & (F.col("key_id") > F.col("first"))
    )
    doomed = stage(doomed.select("key_id", "key_hash", "line"))
    runs.drop()
    return doomed


def _gone(docs: DataFrame, batches: int) -> DataFrame:
    """The numbers of the lines to drop, in order, for each document that has any."""
    return (
        dropped_lines(docs, batches)
        .groupBy("key_id", "key_hash")
        .agg(F.array_sort(F.collect_set("line")).alias("__gone"))
    )


def _with_kept(rows: DataFrame) -> DataFrame:
    """``__lines`` and ``__kept``: the lines of ``text``, and the text without those numbered in ``__gone``.

    The lines between the dropped ones are cut out as slices, each line touched once.
    """
    kept = F.expr(
        """if(__gone IS NULL, text, array_join(flatten(zip_with(
            concat(array(0), transform(__gone, x -> x + 1)), concat(__gone, array(size(__lines))),
            (low, high) -> slice(__lines, low + 1, high - low))), '\n'))"""
    )
    return rows.withColumn("__lines", F.split("text", "\n", -1)).withColumn("__kept", kept)


def drop_repeated_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Each document's ``doc_id``, ``n_lines`` before, ``n_dropped``, and the ``kept`` text."""
    rows = _with_kept(keyed(docs).join(_gone(docs, batches), ["key_id", "key_hash"], "left"))
    return rows.select(
        shown_id(),
        F.size("__lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.col("__kept").alias("kept"),
    )


def without_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the lines dropped from ``text``, and ``n_chars``, if there, its new length.

    All other columns, and the texts that lose nothing, stay as they are.
    """
    joined = with_row(docs).join(_gone(docs, batches), ["key_id", "key_hash"], "left")
    rows = _with_kept(joined.withColumn("text", F.coalesce(F.col("row.text"), F.lit(""))))
    new = {"text": F.col("__kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("__kept").cast(docs.schema["n_chars"].dataType)
    lost = F.col("__gone").isNotNull()
    old = {name: F.col("row").getField(name) for name in docs.columns}
    return rows.select(
        *(F.when(lost, new[name]).otherwise(old[name]).alias(name) if name in new else old[name].alias(name) for name in old)
    )
