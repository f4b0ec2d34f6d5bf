"""Shares of positive and negative comments, and top-k lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.functions.columns import utc_day
from talkweave.functions.states import STATES
from talkweave.operators.prepare import filter_states
from talkweave.session import stage


def shares(scored: DataFrame, *keys: Column | str) -> DataFrame:
    """Share of positive and of negative flags per key.

    Each task adds up its own rows first, so a key that holds much of the data
    sends one row per task through the shuffle.
    """
    return scored.groupBy(*keys).agg(F.avg("pos_prob").alias("pos"), F.avg("neg_prob").alias("neg"))


def sentiment_by_post(scored: DataFrame) -> DataFrame:
    return shares(scored, "link_id", "title")


def sentiment_by_day(scored: DataFrame) -> DataFrame:
    return shares(scored, utc_day(F.col("created_utc")).alias("date"))


def sentiment_by_state(scored: DataFrame, states: Iterable[str] = STATES) -> DataFrame:
    return shares(filter_states(scored, states), "state")


def sentiment_by_comment_score(scored: DataFrame) -> DataFrame:
    return shares(scored, "com_score")


def sentiment_by_submission_score(scored: DataFrame) -> DataFrame:
    return shares(scored, "sub_score")


def top_posts(by_post: DataFrame, by: str, k: int = 10) -> DataFrame:
    """The ``k`` posts with the highest share; ties go to the lower link id."""
    return by_post.orderBy(F.desc(by), "link_id", "title").limit(k)


#: The rollups and the columns that each keeps; all others are summed over.
ROLLUP_KEYS = {
    "posts": ["link_id", "title"],
    "days": ["date"],
    "states": ["state"],
    "sub_score": ["sub_score"],
    "com_score": ["com_score"],
}


def all_shares(scored: DataFrame, states: Iterable[str] = STATES) -> dict[str, DataFrame]:
    """The shares of every rollup, from one reading of ``scored`` and one shuffle.

    The rollups are grouping sets of one aggregate, whose rows are written once; each
    result is the part of that table that its grouping id names.
    """
    columns = [column for keys in ROLLUP_KEYS.values() for column in keys]
    rows = scored.select(
        "link_id", "title", utc_day(F.col("created_utc")).alias("date"),
        F.when(F.col("state").isin(*states), F.col("state")).alias("state"),
        "sub_score", "com_score", "pos_prob", "neg_prob",
    )
    sets = [[F.col(column) for column in keys] for keys in ROLLUP_KEYS.values()]
    grouped = rows.groupingSets(sets, *columns).agg(
        F.avg("pos_prob").alias("pos"), F.avg("neg_prob").alias("neg"), F.grouping_id().alias("summed_over")
    )
    grouped = stage(grouped)
    results = {}
    for name, keys in ROLLUP_KEYS.items():
        # A bit for each column, the first one highest: set if the column is summed over.
        bits = sum(1 << place for place, column in enumerate(reversed(columns)) if column not in keys)
        results[name] = grouped.filter(F.col("summed_over") == bits).select(*keys, "pos", "neg")
    results["states"] = results["states"].filter("state IS NOT NULL")
    return results
