"""Small column functions for labels, keys, flags and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_kind(link_id: Column) -> Column:
    """``t3_abc`` to ``abc``: drop the three-character type prefix."""
    return F.substring(link_id, 4, 2147483647)


def binarize(label: Column, positive: int) -> Column:
    """1 where the label equals ``positive``, else 0; NULL counts as 0."""
    return F.when(label == positive, 1).otherwise(0)


def threshold_flag(probability: Column, threshold: float) -> Column:
    """0 where the probability is at most the threshold, else 1."""
    return F.when(probability <= threshold, 0).otherwise(1)


def utc_day(epoch_seconds: Column) -> Column:
    """Epoch seconds to ``yyyy-MM-dd`` in the session time zone (pinned to UTC)."""
    return F.from_unixtime(epoch_seconds, "yyyy-MM-dd")


def parse_day(day: Column) -> Column:
    """``yyyy-MM-dd`` text to a date."""
    return F.to_date(day, "yyyy-MM-dd")


def hash_bucket(key: Column, buckets: int = 100, seed: str = "") -> Column:
    """A bucket in ``0 .. buckets-1`` that depends on the key and the seed alone.

    The bucket is the same for any file layout, partitioning or retried task.
    """
    digest = F.md5(F.concat(F.lit(seed), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def token_bucket(token: Column, buckets: Column) -> Column:
    """The index bucket a token belongs to."""
    return F.pmod(F.xxhash64(token), buckets).cast("int")
