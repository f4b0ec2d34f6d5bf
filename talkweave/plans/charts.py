"""The tables behind the charts, from the rollup files of the sentiment job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkweave.operators import chart
from talkweave.sources.tables import read_rollup


def chart_tables(spark: SparkSession, out: str, regions: DataFrame) -> dict[str, DataFrame]:
    """Shares over time, per map region (column ``name``) and per score."""
    shares = "pos double, neg double"
    by_day = read_rollup(spark, f"{out}/days.csv", f"date string, {shares}")
    by_state = read_rollup(spark, f"{out}/states.csv", f"state string, {shares}")
    by_submission_score = read_rollup(spark, f"{out}/sub_score.csv", f"sub_score int, {shares}")
    by_comment_score = read_rollup(spark, f"{out}/com_score.csv", f"com_score int, {shares}")
    mapped = chart.region_sentiment(chart.exclude_regions(regions), by_state)
    return {
        "time": chart.to_chart(chart.parse_dates(chart.drop_dates(by_day))),
        "map": chart.to_chart(chart.chart_weight(chart.sentiment_difference(mapped))),
        "submission_score": chart.to_chart(by_submission_score),
        "comment_score": chart.to_chart(by_comment_score),
    }
