"""The search job: build the index, answer a batch of queries, show a page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkweave.operators import search


def build_index(spark: SparkSession, documents: DataFrame, path: str, buckets: int = 1024) -> DataFrame:
    """Index documents ``(song_id, text)`` and store the index."""
    search.write_index(search.build_tfidf(documents), path, buckets)
    return search.read_index(spark, path)


def answer(
    spark: SparkSession, queries: DataFrame, index: str, song: DataFrame, artist: DataFrame, out: str,
    strict_duplicates: bool = True, escape_quotes: bool = False,
) -> DataFrame:
    """Answer a batch of queries from the stored index and store all results with their ranks."""
    stored = search.read_index(spark, index)
    results = search.search(queries, stored, song, artist, strict_duplicates, escape_quotes)
    search.materialize(results, out)
    return search.published(spark, out)
