"""Ranked OR and AND keyword search over a token index, for batches of queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.functions.columns import token_bucket
from talkweave.functions.text import term_counts, unigrams
from talkweave.operators.skew import broadcast_if_small, hot_keys, salted_join
from talkweave.session import stage
from talkweave.sources.tables import exists

PAGE_SIZE = 20

# Pages up to this one are ranked from the best rows of slices; deeper ones are found by counting.
NEAR_PAGES = 5
# A range of results is cut into so many parts, until it has at most so many rows.
PARTS = 256
WITHIN = 1000
# Index rows are looked at for repeats in parts of about so many.
COUNTED = 250_000

# Scores are added as whole multiples of 1 / SCORE_UNITS. Such sums do not
# depend on the order of the rows, so equal scores stay equal and a page holds
# the same rows on every run.
SCORE_UNITS = 1_000_000_000


def tokenize(query: Column, escape_quotes: bool = False) -> Column:
    """Array of query tokens, in their own case and with repeats.

    Tokens are parted by spaces and line ends (not tabs) and lose the ASCII
    punctuation at both ends; tokens of nothing else are dropped.
    """
    found = F.filter(
        F.transform(
            F.split(query, "[ \n\r]+"),
            lambda token: F.regexp_replace(token, r"^\p{Punct}+|\p{Punct}+\z", ""),
        ),
        lambda token: token != "",
    )
    if not escape_quotes:
        return found
    return F.transform(found, lambda token: F.replace(token, F.lit("'"), F.lit("''")))


def query_tokens(queries: DataFrame, escape_quotes: bool = False) -> DataFrame:
    """One row per query token: ``(query_id, pos, token)``, positions from 0."""
    return queries.select(
        "query_id", F.posexplode(tokenize(F.col("query"), escape_quotes)).alias("pos", "token")
    )


def build_tfidf(
    documents: DataFrame, key: str = "song_id", text: str = "text", tokens: DataFrame | None = None
) -> DataFrame:
    """The index ``(key, token, score)`` with score ``tf * ln(N / df)``.

    Words are counted inside each document, and the counts are written once: they
    give both the term and the document frequencies, so every text is read and
    cleaned a single time. The two then meet by token; tokens found in much of all
    documents are salted. A table of distinct ``tokens`` limits the index to them,
    before anything is written.
    """
    total = documents.select(F.count(F.lit(1))).scalar()
    frequencies = documents.select(key, F.inline(term_counts(unigrams(F.col(text)))))
    if tokens is not None:
        frequencies = frequencies.join(broadcast_if_small(tokens), "token", "left_semi")
    frequencies = stage(frequencies)
    counts = stage(frequencies.groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    # Every token has a count; as a left join, only the counts can be broadcast.
    hot = hot_keys(counts, "token", "df")
    joined = salted_join(frequencies, counts, "token", hot, key, "left")
    return joined.select(key, "token", (F.col("tf") * F.log(total / F.col("df"))).alias("score"))


def write_index(tfidf: DataFrame, path: str, buckets: int = 1024) -> None:
    """Store the index in folders by token bucket, so a search reads few of them.

    Rows are cut into ranges of token and song: a token found in much of all
    songs is written by many tasks, and every file holds a narrow token range.
    """
    order = ("bucket", "token", "song_id")
    bucketed = tfidf.withColumn("bucket", token_bucket(F.col("token"), F.lit(buckets)))
    bucketed.withColumn("buckets", F.lit(buckets)).repartitionByRange(*order).sortWithinPartitions(
        *order
    ).write.mode("overwrite").partitionBy("buckets", "bucket").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The stored index, with its bucket columns, which ``match_tokens`` uses."""
    return spark.read.parquet(path)


def wanted_tokens(queries: DataFrame, strict_duplicates: bool = True, escape_quotes: bool = False) -> DataFrame:
    """One row per distinct token of a query, with its type as ``any_token`` and its number of tokens."""
    return queries.select(
        "query_id",
        (F.lower("query_type") == "or").alias("any_token"),
        tokenize(F.col("query"), escape_quotes).alias("tokens"),
    ).select(
        "query_id",
        "any_token",
        F.size(F.col("tokens") if strict_duplicates else F.array_distinct("tokens")).alias("n_tokens"),
        F.explode(F.array_distinct("tokens")).alias("token"),
    )


def match_tokens(
    queries: DataFrame, tfidf: DataFrame, strict_duplicates: bool = True, escape_quotes: bool = False
) -> DataFrame:
    """Index rows that hold a token of a query; a repeated token matches once.

    Adds the query's type as ``any_token`` and its number of tokens. The tokens
    are measured before they are broadcast; a larger batch is joined by token,
    where adaptive execution splits the partitions of frequent tokens. Of a stored
    index, only the folders of the tokens' buckets are read, and in their files,
    which are sorted, only the row groups from the first to the last token.
    """
    return _rows_of(wanted_tokens(queries, strict_duplicates, escape_quotes), tfidf)


def _rows_of(wanted: DataFrame, tfidf: DataFrame) -> DataFrame:
    """Index rows joined to ``wanted`` by token; of a stored index, the folders and row groups that can hold them."""
    if "bucket" not in tfidf.columns:
        return tfidf.join(broadcast_if_small(wanted), "token")
    # The number of buckets is fixed in the index, so the list of them is bounded.
    row = tfidf.select("buckets").first()
    buckets = F.lit(row["buckets"] if row else 1)
    wanted = wanted.withColumn("bucket", token_bucket(F.col("token"), buckets))
    first, last = wanted.agg(F.min("token"), F.max("token")).first()
    asked = [row["bucket"] for row in wanted.select("bucket").distinct().collect()]
    part = tfidf.filter(F.col("bucket").isin(asked) & F.col("token").between(F.lit(first), F.lit(last)))
    return part.join(broadcast_if_small(wanted), ["bucket", "token"]).drop("bucket", "buckets")


def _candidates(asked: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs ``(asked, song_id)`` that hold every result of queries for all tokens.

    A song with all tokens of a query is among those of its rarest token. Songs
    that the index holds twice for a token may number a query's tokens without
    that one; all their queries are kept.
    """
    tokens = asked.select("asked", F.explode("tokens").alias("token"))
    sizes = stage(held.groupBy("token").agg(F.count(F.lit(1)).alias("songs")))
    rarest = F.min(F.struct(F.coalesce("songs", F.lit(0)).alias("songs"), "token"))["token"]
    drivers = stage(tokens.join(broadcast_if_small(sizes), "token", "left").groupBy("asked").agg(rarest.alias("token")))
    found = held.select("token", "song_id").join(broadcast_if_small(drivers), "token").select("asked", "song_id").distinct()
    # As many parts as the rows ask for: none counts more than a fixed number of keys at a time.
    parts = sizes.agg(F.sum("songs")).first()[0] or 0
    counts = held.select("song_id", "token").repartition(parts // COUNTED + 1, "song_id", "token").groupBy("song_id", "token")
    twice = stage(counts.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("song_id").alias("again")).distinct())
    if twice.isEmpty():
        return stage(found)
    others = held.join(twice, F.col("song_id").eqNullSafe(F.col("again")), "left_semi")
    return stage(found.unionByName(others.join(broadcast_if_small(tokens), "token").select("asked", "song_id")).distinct())


def rank_songs(
    queries: DataFrame, tfidf: DataFrame, strict_duplicates: bool = True, escape_quotes: bool = False
) -> DataFrame:
    """Score all matches: ``(query_id, song_id, score)``.

    A query of type ``or`` keeps songs with any of its tokens; any other type
    keeps songs whose matching index rows number exactly its tokens. A repeated
    token scores once but counts twice, so with ``strict_duplicates`` an AND
    query that repeats a token finds nothing.

    The index rows of all queries' tokens are read and written once, whatever the
    number of queries that share a token. Songs for all tokens are looked for among
    those of the rarest one, so a query's common words meet few songs.
    """
    key = ("query_id", "any_token", "n_tokens")
    wanted = wanted_tokens(queries, strict_duplicates, escape_quotes)
    asked = stage(
        wanted.groupBy(*key).agg(F.collect_list("token").alias("tokens")).withColumn("asked", F.monotonically_increasing_id())
    )
    units = F.round(F.col("score") * SCORE_UNITS).cast("bigint")
    rows = _rows_of(asked.select(F.explode("tokens").alias("token")).distinct(), tfidf)
    held = stage(rows.select("song_id", "token", units.alias("units")))
    # Where a query comes twice, its rows may number its tokens without holding all of them.
    plain = (F.size("tokens") <= F.col("n_tokens")) & (F.size("tokens") == F.size(F.array_distinct("tokens")))
    narrow = ~F.coalesce("any_token", F.lit(False)) & plain
    tokens = asked.select("asked", *key, F.explode("tokens").alias("token"), narrow.alias("narrow"))
    wide = held.join(broadcast_if_small(tokens.filter("NOT narrow")), "token")
    pairs = _candidates(asked.filter(narrow), held).join(broadcast_if_small(tokens.filter("narrow")), "asked")
    pairs = pairs.withColumnsRenamed({"song_id": "song", "token": "word"})
    near = held.join(
        broadcast_if_small(pairs), F.col("song").eqNullSafe(F.col("song_id")) & (F.col("word") == F.col("token"))
    )
    columns = ("asked", *key, "song_id", "units")
    return (
        wide.select(*columns)
        .unionByName(near.select(*columns))
        .groupBy(*key, "song_id")
        .agg((F.sum("units") / SCORE_UNITS).alias("score"), F.count(F.lit(1)).alias("matched"))
        .filter(F.col("any_token") | (F.col("matched") == F.col("n_tokens")))
        .select("query_id", "song_id", "score")
    )


def attach_metadata(ranked: DataFrame, song: DataFrame, artist: DataFrame) -> DataFrame:
    """Add song and artist columns; a song without them keeps NULLs.

    Artists meet the song table, one row per song, not the results. Artists of
    very many songs are salted, and songs without an artist are spread.
    """
    songs = song.select("song_id", "song_name", "artist_id", "page_link")
    per_artist = songs.groupBy("artist_id").agg(F.count(F.lit(1)).alias("n"))
    named = salted_join(
        songs, artist.select("artist_id", "artist_name"), "artist_id", hot_keys(per_artist, "artist_id", "n"),
        "song_id", "left",
    )
    return ranked.join(named.drop("artist_id"), "song_id", "left")


def search(
    queries: DataFrame,
    tfidf: DataFrame,
    song: DataFrame,
    artist: DataFrame,
    strict_duplicates: bool = True,
    escape_quotes: bool = False,
) -> DataFrame:
    """All results of a batch of queries, each by its own type."""
    ranked = rank_songs(queries, tfidf, strict_duplicates, escape_quotes)
    return attach_metadata(ranked, song, artist).select(
        "query_id", "song_name", "artist_name", "page_link", "song_id", "score"
    )


def search_or(
    queries: DataFrame,
    tfidf: DataFrame,
    song: DataFrame,
    artist: DataFrame,
    escape_quotes: bool = False,
) -> DataFrame:
    """Songs with at least one token of the query."""
    asked = queries.withColumn("query_type", F.lit("or"))
    return search(asked, tfidf, song, artist, escape_quotes=escape_quotes)


def search_and(
    queries: DataFrame,
    tfidf: DataFrame,
    song: DataFrame,
    artist: DataFrame,
    strict_duplicates: bool = True,
    escape_quotes: bool = False,
) -> DataFrame:
    """Songs with every token of the query."""
    asked = queries.withColumn("query_type", F.lit("and"))
    return search(asked, tfidf, song, artist, strict_duplicates, escape_quotes)


def page(results: DataFrame, n: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``n`` of every query, by falling score, then song id; adds ``rank``.

    Page 0 is page 1. A query may match much of the index, so for the pages up to
    ``NEAR_PAGES`` its results are first cut into slices by song; each slice keeps
    its best rows up to the end of the page, and the rows left over are ranked.
    Deeper pages are found by ``deep_page``.
    """
    if n > NEAR_PAGES:
        return deep_page(results, n, size)
    first, last = (max(n, 1) - 1) * size, max(n, 1) * size
    slices = int(results.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = (F.desc("score"), F.col("song_id"))
    in_slice = Window.partitionBy("query_id", "slice").orderBy(*order)
    in_query = Window.partitionBy("query_id").orderBy(*order)
    best = (
        results.withColumn("slice", F.pmod(F.xxhash64("song_id"), F.lit(slices)))
        .withColumn("rank", F.row_number().over(in_slice))
        .filter(F.col("rank") <= last)
    )
    return (
        best.withColumn("rank", F.row_number().over(in_query))
        .filter((F.col("rank") > first) & (F.col("rank") <= last))
        .drop("slice")
    )


def _narrow(rows: DataFrame, ranges: DataFrame, by: str, falling: bool, first: int, last: int) -> DataFrame:
    """Cut ranges of ``by`` into ``PARTS`` parts and keep those that hold ranks ``first + 1`` to ``last``.

    A range has its bounds ``low_BY`` and ``high_BY``, the rows ``inside`` it and how many
    rank ``above`` it. All its rows are counted; none are collected or ordered.
    """
    keys = [name for name in ranges.columns if name not in (f"low_{by}", f"high_{by}", "inside", "above")]
    held = rows.join(broadcast_if_small(ranges), "query_id").filter(
        F.col("units").between(F.col("low_units"), F.col("high_units"))
        & F.col("song_id").between(F.col("low_song_id"), F.col("high_song_id"))
    )
    # As decimals, which hold the product of a bound and the number of parts.
    low, high, value = (F.col(name).cast("decimal(20,0)") for name in (f"low_{by}", f"high_{by}", by))
    width = (high - low + 1).cast("decimal(21,0)")
    part = F.floor((value - low) * PARTS / width).cast("bigint")
    parts = held.withColumn("part", part).groupBy(*keys, "above", "part").agg(
        F.count(F.lit(1)).alias("inside"), F.min(by).alias(f"low_{by}"), F.max(by).alias(f"high_{by}")
    )
    order = F.desc("part") if falling else F.col("part")
    before = Window.partitionBy(*keys, "above").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    over = F.col("above") + F.coalesce(F.sum("inside").over(before), F.lit(0))
    kept = parts.withColumn("above", over).drop("part")
    return kept.filter((F.col("above") < last) & (F.col("above") + F.col("inside") > first))


def deep_page(results: DataFrame, n: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``n`` of every query, found by counting: no query's results are ordered as a whole.

    The scores of each query are cut into ranges, whose rows are counted, and only
    the ranges that hold the page are cut again, until none has more than ``WITHIN``
    rows; ranges of one score are cut by song id. Only those rows are ranked.
    """
    first, last = (max(n, 1) - 1) * size, max(n, 1) * size
    rows = stage(results.withColumn("units", F.round(F.col("score") * SCORE_UNITS).cast("bigint")))
    ranges = rows.groupBy("query_id").agg(
        F.min("units").alias("low_units"), F.max("units").alias("high_units"),
        F.min("song_id").alias("low_song_id"), F.max("song_id").alias("high_song_id"),
        F.count(F.lit(1)).alias("inside"), F.lit(0).cast("bigint").alias("above"),
    ).filter(F.col("inside") > first)
    ranges = stage(ranges)
    for by, falling in (("units", True), ("song_id", False)):
        while True:
            wide = (F.col("inside") > WITHIN) & (F.col(f"low_{by}") < F.col(f"high_{by}"))
            if ranges.filter(wide).isEmpty():
                break
            done = ranges.filter(~wide)
            ranges = stage(done.unionByName(_narrow(rows, ranges.filter(wide), by, falling, first, last)))
    held = rows.join(broadcast_if_small(ranges.drop("inside")), "query_id").filter(
        F.col("units").between(F.col("low_units"), F.col("high_units"))
        & F.col("song_id").between(F.col("low_song_id"), F.col("high_song_id"))
    )
    within = Window.partitionBy("query_id", "above").orderBy(F.desc("units"), "song_id")
    ranked = held.withColumn("rank", (F.row_number().over(within) + F.col("above")).cast("int"))
    return ranked.filter((F.col("rank") > first) & (F.col("rank") <= last)).select(*results.columns, "rank")


def search_page(
    queries: DataFrame,
    tfidf: DataFrame,
    song: DataFrame,
    artist: DataFrame,
    n: int = 1,
    strict_duplicates: bool = True,
    escape_quotes: bool = False,
) -> DataFrame:
    """One page of results; only its rows are joined to songs and artists.

    A page holds at most ``PAGE_SIZE`` rows per query. It is written first, so its
    song ids have a known size when they pick their few rows from the song table.
    """
    rows = stage(page(rank_songs(queries, tfidf, strict_duplicates, escape_quotes), n))
    shown = song.join(broadcast_if_small(rows.select("song_id").distinct()), "song_id", "left_semi")
    return attach_metadata(rows, shown, artist).select(
        "query_id", "rank", "song_name", "artist_name", "page_link", "song_id", "score"
    )


def turn_page(n: Column, direction: Column) -> Column:
    """The page to show: one back, one on, or the first for a new search."""
    wanted = F.when(direction == "previous", n - 1).when(direction == "next", n + 1).otherwise(1)
    return F.greatest(wanted, F.lit(1))


def result_count(results: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """Number of results per query; with ``queries``, also those without any."""
    counts = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_row"))
    if queries is None:
        return counts
    return queries.select("query_id").join(counts, "query_id", "left").fillna(0, ["n_row"])


def page_info(counts: DataFrame, n: int, size: int = PAGE_SIZE) -> DataFrame:
    """Number of pages, and whether page ``n`` has one before and after it."""
    number = max(n, 1)
    return counts.select(
        "query_id",
        "n_row",
        F.lit(number).alias("n_page"),
        F.ceil(F.col("n_row") / size).alias("pages"),
        F.lit(number > 1).alias("has_previous"),
        (F.lit(number) < F.col("n_row") / size).alias("has_next"),
    )


def with_url(results: DataFrame, base: str) -> DataFrame:
    """Add the full address of each result."""
    return results.withColumn("url", F.concat(F.lit(base), F.col("page_link")))


def add_ranks(results: DataFrame) -> DataFrame:
    """Add ``rank`` within each query, by falling score, then song id, for results of any size.

    Rows are put into ranges by query and rank and numbered in their range; the
    number of a query's rows in earlier ranges comes from counts, one for each query
    and range. No query's results meet in one task.
    """
    order = (F.col("query_id"), F.desc("score"), F.col("song_id"))
    numbered = stage(
        results.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("number", F.monotonically_increasing_id())
    )
    counts = numbered.groupBy("query_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first"))
    earlier = Window.partitionBy("query_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "query_id", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("offset")
    )
    ranked = numbered.join(offsets, ["query_id", "part"])
    return ranked.withColumn("rank", F.col("number") + F.col("offset")).drop("part", "number", "offset")


def materialize(results: DataFrame, path: str) -> int:
    """Publish the results of a batch with their ranks, so that pages need no new search.

    A new version is written beside the earlier ones and then named in the list of
    versions, by a file that appears at once and whole: readers have the old version
    or the new one, never parts of one. Files are ranges of query and rank: a page
    reads the row groups that hold it. Returns the number of the version.
    """
    spark = results.sparkSession
    version = (_version(spark, path) or 0) + 1
    name = f"{version}-{uuid.uuid4().hex}"
    ranked = add_ranks(results)
    ranked.repartitionByRange("query_id", "rank").sortWithinPartitions("query_id", "rank").write.parquet(f"{path}/{name}")
    spark.createDataFrame([(version, name)], VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


VERSIONS = "version bigint, name string"


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(VERSIONS).parquet(f"{path}/versions") if exists(spark, f"{path}/versions") else None


def _version(spark: SparkSession, path: str) -> int | None:
    listed = _versions(spark, path)
    return None if listed is None else listed.agg(F.max("version")).first()[0]


def published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The stored results: those of the newest published version, or of a given one."""
    listed = _versions(spark, path)
    chosen = listed if version is None else listed.filter(F.col("version") == version)
    name = chosen.agg(F.max_by("name", F.struct("version", "name"))).first()[0]
    return spark.read.parquet(f"{path}/{name}")


def stored_pages(spark: SparkSession, path: str, n: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``n`` of every query from the stored results; page 0 is page 1."""
    last = max(n, 1) * size
    return published(spark, path).filter((F.col("rank") > last - size) & (F.col("rank") <= last))


def stored_page(spark: SparkSession, path: str, query_id: int, n: int) -> DataFrame:
    """Page ``n`` of one query from the stored results."""
    return stored_pages(spark, path, n).filter(F.col("query_id") == query_id)
