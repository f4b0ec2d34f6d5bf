"""Projections, filters and joins that prepare comments for scoring."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.functions.columns import binarize, hash_bucket, strip_kind
from talkweave.operators.skew import broadcast_if_small, hot_keys, salted_join

POSITIVE, NEGATIVE = 1, -1


def prepare_comments(comments: DataFrame) -> DataFrame:
    """Choose and rename the comment columns; the link id loses its prefix."""
    return comments.select(
        "id",
        "body",
        "created_utc",
        F.col("author_flair_text").alias("state"),
        F.col("score").alias("com_score"),
        strip_kind(F.col("link_id")).alias("link_id"),
    )


def prepare_submissions(submissions: DataFrame) -> DataFrame:
    """Choose and rename the submission columns."""
    return submissions.select(F.col("id").alias("link_id"), "title", F.col("score").alias("sub_score"))


def drop_sarcasm(comments: DataFrame) -> DataFrame:
    """Drop comments that contain ``/s``, and those without a body."""
    return comments.filter(~F.col("body").contains("/s"))


def drop_quotes(comments: DataFrame) -> DataFrame:
    """Drop comments that start with an escaped quote mark, and those without a body."""
    return comments.filter(~F.col("body").startswith("&gt;"))


def filter_states(df: DataFrame, states: Iterable[str]) -> DataFrame:
    """Keep rows whose state is on the list, by exact match."""
    return df.filter(F.col("state").isin(list(states)))


def label_comments(comments: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels with the body of the comment each one is about.

    Labels are made by hand and few: they are measured and sent to the comments,
    whose bodies then stay where they are read.
    """
    return comments.select("id", "body").join(
        broadcast_if_small(labels.select("Input_id", "labeldem", "labelgop", "labeldjt")),
        F.col("id") == F.col("Input_id"),
    ).select("Input_id", "labeldem", "labelgop", "labeldjt", "body")


def attach_submission(
    comments: DataFrame, submissions: DataFrame, links: DataFrame | None = None
) -> DataFrame:
    """Join prepared comments to prepared submissions; comments without one go.

    One post may hold much of all comments, so busy posts are salted.
    They are counted on ``links``, by default the comments themselves. Where the
    comments are filtered by their body or carry scores, pass the plain table:
    its link ids are then read without the text.
    """
    links = comments if links is None else links
    per_post = links.groupBy("link_id").agg(F.count(F.lit(1)).alias("n"))
    keyed = comments.withColumn("spread", F.xxhash64("id", "created_utc"))
    return salted_join(
        keyed, submissions, "link_id", hot_keys(per_post, "link_id", "n"), "spread"
    ).drop("spread")


def add_labels(labeled: DataFrame) -> DataFrame:
    """Add the 0/1 labels of the positive and the negative classifier."""
    return labeled.withColumns(
        {
            "pos_label": binarize(F.col("labeldjt"), POSITIVE),
            "neg_label": binarize(F.col("labeldjt"), NEGATIVE),
        }
    )


def split_by_hash(
    df: DataFrame, key: str, percent: int = 50, seed: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Split rows in two by a hash of their key; the first part holds ``percent``.

    Other seeds give independent splits.
    """
    first = hash_bucket(F.col(key), 100, seed) < percent
    return df.filter(first), df.filter(~first)
