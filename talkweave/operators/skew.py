"""Joins whose cost does not hinge on one key or on a guess at a table's size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.session import stage

BROADCAST_BYTES = 32 << 20


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Do the values of a narrow table take at most ``most`` bytes? They are measured, as text."""
    sizes = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 8 for name in df.columns]
    total = df.agg(F.sum(sum(sizes[1:], sizes[0]))).first()[0]
    return (total or 0) <= most


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a narrow table for broadcast if its values take at most ``most`` bytes.

    The values are measured, as text. A larger table is left to the join that
    Spark picks by its own sizes.
    """
    return F.broadcast(df) if is_small(df, most) else df


def hot_keys(counts: DataFrame, key: str, count: str) -> DataFrame:
    """Keys with more rows than a shuffle partition holds on average, and their ``slices``.

    A key gets one slice for each partition that its rows would fill. There are
    fewer such keys than partitions, and fewer than twice as many slices, whatever
    the data; so the list and the copies it asks for stay small.
    """
    counts = stage(counts.select(key, count))
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(count)).first()[0] or 0
    mean = max(total / partitions, 1.0)
    return counts.filter(F.col(key).isNotNull() & (F.col(count) > mean)).select(
        F.col(key).alias("hot_key"), F.ceil(F.col(count) / mean).cast("int").alias("slices")
    )


def salted_join(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame, spread_by: str, how: str = "inner"
) -> DataFrame:
    """Inner or left join on ``key``, with the rows of hot left keys cut into slices.

    A hot key's left rows get one of its slices by a hash of ``spread_by``; its
    right rows are repeated once per slice. Left rows without a key, which match
    nothing, are spread over all partitions. ``hot`` is the list of ``hot_keys``,
    shorter than the number of partitions, so it is broadcast.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot)
    slices = F.when(F.col(key).isNull(), F.lit(partitions)).otherwise(F.coalesce("slices", F.lit(1)))
    left = left.join(hot, F.col(key) == F.col("hot_key"), "left").withColumn(
        "salt", F.pmod(F.xxhash64(spread_by), slices).cast("int")
    )
    right = right.join(hot, F.col(key) == F.col("hot_key"), "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))
    )
    return (
        left.drop("hot_key", "slices")
        .join(right.drop("hot_key", "slices"), [key, "salt"], how)
        .drop("salt")
    )
