"""A block-max index: the best results of a query without reading all rows of its tokens.

The rows of a token are ordered by falling score and cut into blocks, and the highest
score of each block is kept beside them. A search reads the first blocks of each token,
which give every query a threshold: the score that its last wanted result has at
least. A song with more tokens than one can only reach it if it has a large share of
it for some token, so blocks whose highest score is below that share are not read.
What is left are a few songs, whose whole scores come from a copy of the index that is
kept by song.

Results equal those of a search that reads everything, ties included.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.functions.columns import token_bucket
from talkweave.operators.search import PAGE_SIZE, SCORE_UNITS, attach_metadata, page, wanted_tokens
from talkweave.operators.skew import broadcast_if_small
from talkweave.session import stage

BLOCK_ROWS = 128
BUCKETS = 1024
#: Up to so many songs are named in the scan; for more, only their buckets are.
NAMED_SONGS = 1000
#: Up to so many buckets have a range of blocks of their own in the scan; more have one range together.
NAMED_BUCKETS = 100
#: Songs are hashed to so many places, which make the buckets of songs and the tasks that write them.
PLACES = 1 << 20


def _place(song: Column) -> Column:
    return F.pmod(F.xxhash64(song), F.lit(PLACES))


def _part(place: Column, count: int) -> Column:
    """One of ``count`` parts of the places, in their order."""
    return F.shiftright(place * count, PLACES.bit_length() - 1).cast("int")


def write_blocks(tfidf: DataFrame, path: str, block_rows: int = BLOCK_ROWS, buckets: int = BUCKETS) -> None:
    """Store the index three times: ``songs`` by song, ``postings`` by token and block, and ``blocks``.

    Scores are stored in whole units. The index is computed once, for the copy by song, which the
    other two are made from. The rows of all tokens lie in ranges of token and falling score, so a token
    found in much of all songs is ordered over many tasks. A block ends after ``block_rows`` rows of a range or
    with its token: its number rises as the token's scores fall, and a token's first block may be a short one.
    """
    spark = tfidf.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = F.round(F.col("score") * SCORE_UNITS).cast("bigint").alias("units")
    # Some slices of each folder's songs for each task, so that tasks get alike shares and write few folders.
    place, slices = _place(F.col("song_id")), buckets * -(-4 * tasks // buckets)
    rows = tfidf.select(_part(place, buckets).alias("song_part"), _part(place, slices).alias("slice"), "song_id", "token", units)
    # A song that the index holds twice for a token is one row, whose score is the sum: bounds are of songs, not of rows.
    merged = rows.repartition(tasks, "song_part", "slice").groupBy("song_part", "slice", "song_id", "token").agg(
        F.sum("units").alias("units"), F.count(F.lit(1)).alias("copies")
    )
    merged.drop("slice").sortWithinPartitions("song_part", "song_id").write.mode("overwrite").partitionBy("song_part").parquet(
        f"{path}/songs"
    )
    rows = spark.read.parquet(f"{path}/songs").select(
        token_bucket(F.col("token"), F.lit(buckets)).alias("bucket"), "token", "song_id", "units", "copies"
    )
    order = (F.col("bucket"), F.col("token"), F.desc("units"), F.col("song_id"))
    block = F.expr(f"monotonically_increasing_id() DIV {block_rows}")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "bucket", "token", block.alias("block"), "song_id", "units", "copies"
    ).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    order = ("bucket", "token", "block")
    blocks = spark.read.parquet(f"{path}/postings").groupBy(*order).agg(
        F.max("units").alias("top"), F.count(F.lit(1)).alias("n"), F.max("copies").alias("most_copies")
    )
    blocks.withColumn("buckets", F.lit(buckets)).repartitionByRange(*order).sortWithinPartitions(*order).write.mode(
        "overwrite"
    ).partitionBy("buckets", "bucket").parquet(f"{path}/blocks")


def _asked_blocks(spark: SparkSession, wanted: DataFrame, path: str) -> DataFrame:
    """The blocks of the tokens asked for, with their queries."""
    stored = spark.read.parquet(f"{path}/blocks")
    row = stored.select("buckets").first()
    count = row["buckets"] if row else 1
    wanted = wanted.withColumn("bucket", token_bucket(F.col("token"), F.lit(count)))
    asked = [row["bucket"] for row in wanted.select("bucket").distinct().collect()]
    part = stored.filter(F.col("bucket").isin(asked)).drop("buckets")
    return stage(part.join(broadcast_if_small(wanted), ["bucket", "token"]))


def _read(spark: SparkSession, blocks: DataFrame, path: str) -> DataFrame:
    """The rows of some blocks, read from the folders and row groups that hold them."""
    asked = blocks.groupBy("bucket").agg(F.min("block").alias("low"), F.max("block").alias("high")).collect()
    first, last = blocks.agg(F.min("token"), F.max("token")).first()
    wanted = F.col("bucket").isin([row["bucket"] for row in asked]) & F.col("token").between(F.lit(first), F.lit(last))
    if 0 < len(asked) <= NAMED_BUCKETS:
        ranges = [(F.col("bucket") == row["bucket"]) & F.col("block").between(row["low"], row["high"]) for row in asked]
        wanted = wanted & reduce(Column.__or__, ranges)
    rows = spark.read.parquet(f"{path}/postings").filter(wanted)
    return rows.join(broadcast_if_small(blocks.drop("top", "n", "most_copies")), ["bucket", "token", "block"])


def _thresholds(spark: SparkSession, blocks: DataFrame, path: str, size: int) -> DataFrame:
    """Per query the score that its result number ``size`` has at least, from the rows of some ``blocks`` alone.

    A query for all tokens only counts songs that have them all there. Where too
    few are found, the threshold is 0.
    """
    sums = (
        _read(spark, blocks, path)
        .groupBy("query_id", "song_id", "any_token", "n_tokens")
        .agg(F.sum("units").alias("units"), F.sum("copies").alias("matched"))
        .filter(F.col("any_token") | (F.col("matched") == F.col("n_tokens")))
    )
    best = page(sums.select("query_id", "song_id", F.col("units").alias("score")), 1, size)
    return best.filter(F.col("rank") == size).select("query_id", F.col("score").alias("threshold"))


def _openings(blocks: DataFrame, size: int) -> DataFrame:
    """Per query and token the last of its first blocks, which have ``size`` rows or more if the token has so many.

    Only a token's first block, and the one that ends with a range, are short; so three are looked at.
    """
    in_order = Window.partitionBy("query_id", "token").orderBy("block")
    before = F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = blocks.withColumn("place", F.row_number().over(in_order)).filter("place <= 3")
    return first.withColumn("before", before).filter(F.col("before") < size).groupBy("query_id", "token").agg(F.max("block").alias("opening"))


def needed_blocks(spark: SparkSession, wanted: DataFrame, path: str, size: int = PAGE_SIZE) -> DataFrame:
    """The blocks of the tokens asked for, with ``needed``: can a song of the first ``size`` be found in it alone?

    The first blocks of a token, which give the thresholds, are marked as ``opens``.
    A song with any of ``m`` tokens needs an ``m``-th of the threshold from one of them.
    A song with all of them is in the token of fewest rows, with what the highest
    scores of the others leave of the threshold; where the index holds songs twice for a token, their rows may
    number a query's tokens without that one, and all blocks are needed.
    """
    blocks = _asked_blocks(spark, wanted, path)
    totals = blocks.groupBy("query_id", "token").agg(
        F.max("top").alias("highest"), F.sum("n").alias("rows"), F.max("most_copies").alias("most_copies")
    )
    tokens = stage(totals.join(_openings(blocks, size), ["query_id", "token"]))
    openings = broadcast_if_small(tokens.select("query_id", "token", "opening"))
    first = blocks.join(openings, ["query_id", "token"]).filter(F.col("block") <= F.col("opening")).drop("opening")
    per_query = tokens.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("highest").alias("all_highest"),
        (F.max("most_copies") > 1).alias("twice"),
        F.min(F.struct("rows", "token"))["token"].alias("driver"),
    )
    bounds = stage(per_query.join(_thresholds(spark, stage(first), path, size), "query_id", "left").fillna(0, ["threshold"]))
    joined = blocks.join(broadcast_if_small(bounds), "query_id").join(
        broadcast_if_small(tokens.select("query_id", "token", "highest", "opening")), ["query_id", "token"]
    )
    any_token = F.col("top") * F.col("m") >= F.col("threshold")
    all_tokens = F.col("twice") | (F.col("token") == F.col("driver")) & (
        F.col("top") + F.col("all_highest") - F.col("highest") >= F.col("threshold")
    )
    needed = F.when(F.col("any_token"), any_token).otherwise(all_tokens)
    return joined.withColumns({"needed": needed, "opens": F.col("block") <= F.col("opening")}).select(
        "query_id", "bucket", "token", "block", "any_token", "n_tokens", "n", "threshold", "needed", "opens"
    )


def rows_read(blocks: DataFrame) -> DataFrame:
    """Per query how many index rows its tokens have, and how many of them are in blocks that are read."""
    return blocks.groupBy("query_id").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("needed") | F.col("opens"), F.col("n")).otherwise(0)).alias("n_read")
    )


def best_songs(
    spark: SparkSession, queries: DataFrame, path: str, size: int = PAGE_SIZE, strict_duplicates: bool = True,
    escape_quotes: bool = False,
) -> DataFrame:
    """The first ``size`` results of each query: ``query_id``, ``song_id``, ``score``, ``rank``."""
    wanted = stage(wanted_tokens(queries, strict_duplicates, escape_quotes))
    blocks = stage(needed_blocks(spark, wanted, path, size))
    candidates = stage(_read(spark, blocks.filter("needed").drop("n", "threshold", "needed", "opens"), path).select("query_id", "song_id").distinct())
    stored = spark.read.parquet(f"{path}/songs")
    songs = candidates.select("song_id").distinct()
    buckets = int(spark.read.parquet(f"{path}/blocks").select(F.coalesce(F.max("buckets"), F.lit(1))).first()[0])
    asked = [row["b"] for row in songs.select(_part(_place(F.col("song_id")), buckets).alias("b")).distinct().collect()]
    stored = stored.filter(F.col("song_part").isin(asked)).drop("song_part")
    named = [row["song_id"] for row in songs.limit(NAMED_SONGS + 1).collect()]
    if len(named) <= NAMED_SONGS:
        stored = stored.filter(F.col("song_id").isin(named))
    # Few of a song's tokens are asked for; the others are left out before its queries are looked up.
    found = stored.join(broadcast_if_small(wanted.select("query_id", "token", "any_token", "n_tokens")), "token").join(
        broadcast_if_small(candidates), ["query_id", "song_id"]
    )
    whole = (
        found.groupBy("query_id", "song_id", "any_token", "n_tokens")
        .agg((F.sum("units") / SCORE_UNITS).alias("score"), F.sum("copies").alias("matched"))
        .filter(F.col("any_token") | (F.col("matched") == F.col("n_tokens")))
    )
    return page(whole.select("query_id", "song_id", "score"), 1, size)


def search_first_page(
    spark: SparkSession, queries: DataFrame, path: str, song: DataFrame, artist: DataFrame, **options: bool
) -> DataFrame:
    """The first page of every query with its songs and artists, from the stored blocks."""
    rows = stage(best_songs(spark, queries, path, **options))
    shown = song.join(broadcast_if_small(rows.select("song_id").distinct()), "song_id", "left_semi")
    return attach_metadata(rows, shown, artist).select(
        "query_id", "rank", "song_name", "artist_name", "page_link", "song_id", "score"
    )
