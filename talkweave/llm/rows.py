"""Documents as the operators take them: a key for each row and its whole text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave.session import in_tasks

#: Stands in for a missing doc_id, so that such rows come after all others.
LAST_ID = (1 << 63) - 1


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int = 1 << 16) -> Iterator[pa.Table]:
    """Put batches sorted by ``key`` together so that no table ends within a group.

    A table has ``least`` rows or more, but for the last one; memory is bounded by
    that and by the largest group.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < least:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if len(changes):
            cut = int(changes[-1]) + 1
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            count -= cut
        least = max(least, 2 * count)
    if count:
        yield pa.Table.from_batches(held)


def row_id() -> Column:
    """``doc_id`` as a number, or the largest one where it is missing."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))


def text_hash() -> Column:
    """A hash of the text; rows that share ``doc_id`` and text are alike in every result."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """The columns ``key_id``, ``key_hash`` and ``text`` of documents, and no others.

    The first two name a row: ``doc_id`` alone may be missing or repeated. A
    missing text counts as empty.
    """
    return docs.select(
        row_id().alias("key_id"),
        text_hash().alias("key_hash"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def shown_id() -> Column:
    """``doc_id`` as it was given, from ``key_id``."""
    return F.nullif(F.col("key_id"), F.lit(LAST_ID)).alias("doc_id")


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``verdicts``, with all their columns unchanged.

    ``verdicts`` has ``key_id`` and ``key_hash``; a key in it may repeat.
    """
    keys = verdicts.select(F.col("key_id").alias("_key_id"), F.col("key_hash").alias("_key_hash"))
    return docs.join(keys, (row_id() == keys["_key_id"]) & (text_hash() == keys["_key_hash"]), "left_semi")


def with_row(docs: DataFrame) -> DataFrame:
    """``key_id``, ``key_hash``, and ``row`` with all columns of ``docs``, whatever their names."""
    return docs.select(row_id().alias("key_id"), text_hash().alias("key_hash"), F.struct("*").alias("row"))


def beside_rows(docs: DataFrame, function: Callable[[pa.Array], list[pa.Array]], columns: str) -> DataFrame:
    """``row``, all columns of ``docs``, and beside it the ``columns`` that ``function`` finds for a batch of texts.

    Rows stay in the tasks that read them, so what is found can filter them where they are.
    """
    rows = with_row(docs).withColumn("text", F.coalesce(F.col("row.text"), F.lit("")))
    schema = T.StructType([*rows.drop("text").schema.fields, *T.StructType.fromDDL(columns).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = function(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], schema.names)

    return in_tasks(rows, run, schema)


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of rows with equal ``doc_id`` and text, one."""
    return with_row(docs).dropDuplicates(["key_id", "key_hash"]).select("row.*")
