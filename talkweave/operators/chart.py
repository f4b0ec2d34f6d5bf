"""Tables behind the charts, derived from the rollups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.functions.columns import parse_day
from talkweave.functions.states import BAD_DAYS, UNCHARTED_REGIONS


def to_chart(rollup: DataFrame) -> DataFrame:
    """Rename rollup columns to the names the charts use."""
    return rollup.withColumnsRenamed(
        {
            "pos": "Positive",
            "neg": "Negative",
            "sub_score": "submission_score",
            "com_score": "comment_score",
        }
    )


def drop_dates(by_day: DataFrame, days: Iterable[str] = BAD_DAYS) -> DataFrame:
    """Drop the days known to be wrong; ``date`` is still text. A missing date stays."""
    return by_day.filter(F.col("date").isNull() | ~F.col("date").isin(list(days)))


def parse_dates(by_day: DataFrame) -> DataFrame:
    """Turn the text column ``date`` into a date."""
    return by_day.withColumn("date", parse_day(F.col("date")))


def exclude_regions(regions: DataFrame, names: Iterable[str] = UNCHARTED_REGIONS) -> DataFrame:
    """Drop the map regions that are not charted."""
    return regions.filter(~F.col("name").isin(list(names)))


def region_sentiment(regions: DataFrame, by_state: DataFrame) -> DataFrame:
    """Shares per map region; NULL where the rollup has no such state."""
    return regions.join(by_state, F.col("name") == F.col("state"), "left").drop("state")


def sentiment_difference(by_state: DataFrame) -> DataFrame:
    """Positive minus negative share, and its sign; a difference of 0 counts as 1."""
    return by_state.withColumn("difference", F.col("pos") - F.col("neg")).withColumn(
        "sign", F.when(F.col("difference") < 0, -1).when(F.col("difference") >= 0, 1)
    )


def chart_weight(differences: DataFrame, vmax: float = 100.0, vmin: float = 0.0) -> DataFrame:
    """Colour weights of the shares and of their difference, on a scale from ``vmin`` to ``vmax``."""
    span = vmax - vmin
    return differences.withColumns(
        {
            "pos_weight": 1 - F.sqrt((F.col("pos") - vmin) / span),
            "neg_weight": 1 - F.sqrt((F.col("neg") - vmin) / span),
            "difference_weight": 1 - (F.abs(F.col("difference")) - vmin) / span,
        }
    )
