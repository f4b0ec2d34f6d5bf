"""Views that shape the given tables into the inputs of the two jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.sources.tables import read_table, spread


def bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts as comment bodies: ``id``, ``body``."""
    documents = spread(read_table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    return documents.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("body"))


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """What comments have besides their body: time, author and score from events, and the post."""
    authors = (
        read_table(spark, folder, "customer")
        .join(read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", "n_name")
    )
    events = read_table(spark, folder, "events").join(authors, F.col("user_id") == F.col("c_custkey"), "left")
    documents = read_table(spark, folder, "documents").select("doc_id")
    return documents.join(events, F.col("doc_id") == F.col("event_id")).select(
        F.col("doc_id").cast("string").alias("id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_utc"),
        F.col("n_name").alias("author_flair_text"),
        F.floor("value").cast("int").alias("score"),
        F.concat(F.lit("t3_"), (F.col("doc_id") % 120).cast("string")).alias("link_id"),
    )


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as comments. What needs no body, or no more than a body, reads the two views above."""
    return bodies(spark, folder).join(facts(spark, folder), "id").select(
        "id", "body", "created_utc", "author_flair_text", "score", "link_id"
    )


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    """The first turn of every conversation as a submission, its text as the title."""
    return (
        read_table(spark, folder, "conversations")
        .filter("turn = 0")
        .select(
            F.col("conv_id").cast("string").alias("id"),
            F.col("text").alias("title"),
            F.length("text").cast("int").alias("score"),
        )
    )


def labeled(spark: SparkSession, folder: str) -> DataFrame:
    """Quality and toxicity marks as labels 1, 0 and -1."""
    return read_table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("Input_id"),
        F.col("toxic").alias("labeldem"),
        F.col("quality").alias("labelgop"),
        F.when(F.col("toxic") == 1, -1).when(F.col("quality") == 1, 1).otherwise(0).alias("labeldjt"),
    )


def songs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as songs, without their text."""
    return read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("song_id"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("song_name"),
        F.col("source").alias("artist_id"),
        F.concat(F.lit("/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")).alias("page_link"),
    )


def artists(spark: SparkSession, folder: str) -> DataFrame:
    """Sources as artists; ``src0`` is left out, so that its songs have none."""
    return (
        read_table(spark, folder, "documents")
        .filter("source <> 'src0'")
        .select(F.col("source").alias("artist_id"))
        .distinct()
        .withColumn("artist_name", F.upper("artist_id"))
    )


def lyrics(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts as lyrics, the input of the search index."""
    texts = read_table(spark, folder, "documents").select(F.col("doc_id").alias("song_id"), "text")
    return spread(texts, "song_id")
