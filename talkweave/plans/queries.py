"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.functions import text as tx
from talkweave.functions.columns import strip_kind, threshold_flag, utc_day
from talkweave.functions.states import STATES, UNCHARTED_REGIONS
from talkweave.operators import blockmax, chart, features, model, prepare, rollup, search
from talkweave.plans import planted
from talkweave.session import shared_folder, stage
from talkweave.sources import tables, views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its own name."""
    QUERIES[function.__name__] = function
    return function


# --- inputs -------------------------------------------------------------------


def _planted(spark: SparkSession, rows: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {rows}")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.read_table(spark, folder, "documents").select("doc_id", "text")
    extra = _planted(spark, planted.TEXTS).select(F.col("doc_id").cast("bigint"), "text")
    return tables.spread(documents, "doc_id").unionByName(extra)


def _all_comments(spark: SparkSession, folder: str) -> DataFrame:
    extra = _planted(spark, planted.COMMENTS).withColumn("created_utc", F.col("created_utc").cast("bigint"))
    return views.comments(spark, folder).unionByName(extra)


def _all_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Comments as id and body alone: texts stay where they are read."""
    return views.bodies(spark, folder).unionByName(_planted(spark, planted.COMMENTS).select("id", "body"))


def _all_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Comments without their body."""
    extra = _planted(spark, planted.COMMENTS).drop("body")
    return views.facts(spark, folder).unionByName(extra.withColumn("created_utc", F.col("created_utc").cast("bigint")))


def _prepared_facts(spark: SparkSession, folder: str) -> DataFrame:
    whole = _all_facts(spark, folder).withColumn("body", F.lit(None).cast("string"))
    return prepare.prepare_comments(whole).drop("body")


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies of the corpus without sarcasm and quotes, planted ones included."""
    return prepare.drop_quotes(prepare.drop_sarcasm(_all_bodies(spark, folder)))


def _submissions(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.prepare_submissions(views.submissions(spark, folder))


def _labeled(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled comments with their labels and n-grams."""
    labeled = prepare.label_comments(views.bodies(spark, folder), views.labeled(spark, folder))
    return features.add_ngrams(prepare.add_labels(labeled))


def _index(spark: SparkSession, folder: str) -> DataFrame:
    """The index over all documents."""
    return search.build_tfidf(views.lyrics(spark, folder))


def _searched(spark: SparkSession, folder: str) -> tuple[DataFrame, ...]:
    return (
        _planted(spark, planted.QUERIES),
        _index(spark, folder),
        views.songs(spark, folder),
        views.artists(spark, folder),
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of doubles to six places, the same on any engine."""
    return df.withColumns({name: F.round(name, 6) for name in names})


#: So many labelled comments for each part that their terms are counted in.
LABELS_A_PART = 4000


def _log_odds(part: str, whole: str) -> Column:
    return F.log((F.col(part) + 1) / (F.col(whole) - F.col(part) + 1))


def _weights(spark: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    """Term weights, with the comments that hold the term (``n``), and intercepts, counted from the labelled comments.

    A stand-in for trained coefficients that SQL can compute as well: how far
    the odds of a label among comments with a term lie from the odds overall.
    """
    labeled = _labeled(spark, folder).select("n_gram", "pos_label", "neg_label")
    label_sums = [F.sum(f"{kind}_label").alias(f"n_{kind}") for kind in ("pos", "neg")]
    overall = prepare.add_labels(
        prepare.label_comments(views.bodies(spark, folder), views.labeled(spark, folder))
    ).agg(F.count(F.lit(1)).alias("n"), *label_sums)
    prior = {kind: overall.select(_log_odds(f"n_{kind}", "n")).scalar() for kind in ("pos", "neg")}
    # Tasks that read texts count terms by stretches of rows. Most terms are rare, so adding these counts
    # up before the shuffle would hold nearly all of them; after it, a part does those of about LABELS_A_PART comments.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(partitions, views.labeled(spark, folder).count() // LABELS_A_PART)
    counted = (
        features.counted_terms(labeled, "pos_label", "neg_label")
        .drop("total")
        .repartition(parts, "term")
        .groupBy("term")
        .agg(F.sum("df").alias("n"), *label_sums)
        .filter("n >= 10")
    )
    odds = [(0.05 * (_log_odds(f"n_{kind}", "n") - prior[kind])).alias(kind) for kind in ("pos", "neg")]
    return stage(counted.select("term", "n", *odds)), prior


def _chances(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of kept comments with the chances ``pos`` and ``neg`` of the stand-in weights."""
    weights, prior = _weights(spark, folder)
    return features.score_linear(features.add_ngrams(_kept(spark, folder)), ["id"], weights, prior, "n")


def _flags(spark: SparkSession, folder: str) -> DataFrame:
    return _chances(spark, folder).withColumns(
        {f"{kind}_prob": threshold_flag(F.col(kind), limit) for kind, limit in model.THRESHOLDS.items()}
    ).drop("pos", "neg")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    facts = _prepared_facts(spark, folder)
    scored = facts.join(_flags(spark, folder), "id")
    return prepare.attach_submission(scored, _submissions(spark, folder), facts)


def _by_state(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.sentiment_by_state(_scored(spark, folder), STATES + planted.TEST_STATES)


def _regions(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_table(spark, folder, "nation").select(F.col("n_name").alias("name"))


# --- sources, projections, filters --------------------------------------------


@query
def s3_read_table(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table written to a folder of tables and read from it by name."""
    path = shared_folder(spark)
    df.write.parquet(f"{path}/{name}.parquet")
    return tables.read_table(spark, path, name)


@query
def s9_read_songs(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(spark, views.songs(spark, folder), "song")


@query
def s9_read_artists(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(spark, views.artists(spark, folder), "artist")


@query
def s9_read_index(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_stored(spark, _index(spark, folder), "tfidf"), "score")


@query
def s1_read_json(spark: SparkSession, folder: str) -> DataFrame:
    """Comments written as compressed JSON lines and read back."""
    path = shared_folder(spark)
    _all_comments(spark, folder).write.option("compression", "bzip2").json(path)
    return tables.read_json(spark, path, tables.COMMENTS)


def _with_bad_lines(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    path = shared_folder(spark)
    comments = _all_comments(spark, folder)
    lines = comments.select(F.to_json(F.struct("*")).alias("line"))
    lines.unionByName(_planted(spark, planted.BAD_LINES)).write.option("compression", "bzip2").text(path)
    return tables.read_json_checked(spark, path, tables.COMMENTS)


@query
def s1_read_json_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Comments read from files that hold unreadable lines too, which make no rows."""
    return _with_bad_lines(spark, folder)[0]


@query
def s1_unreadable_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The unreadable lines, whole, and how many rows the files have besides."""
    good, bad = _with_bad_lines(spark, folder)
    return bad.groupBy("line").agg(F.count(F.lit(1)).alias("n_lines")).withColumn("n_rows", F.lit(good.count()).cast("bigint"))


def _label_file(spark: SparkSession, folder: str) -> str:
    path = shared_folder(spark)
    labels = views.labeled(spark, folder).unionByName(_planted(spark, planted.LABELS))
    labels.write.csv(path, header=True)
    return path


@query
def s2_read_labels_csv(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_labels_csv(spark, _label_file(spark, folder))


@query
def s4_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Submissions from the staged copy, which the second call finds and the first has made."""
    raw, staged = shared_folder(spark), shared_folder(spark)
    views.facts(spark, folder).write.json(f"{raw}/comments")
    views.submissions(spark, folder).write.json(f"{raw}/submissions")
    files = (f"{raw}/submissions", f"{raw}/comments", _label_file(spark, folder), staged)
    tables.ingest_comments(spark, *files)
    return tables.ingest_comments(spark, *files)["submissions"]


@query
def s5_s10_csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Titles, planted ones included, with a share, written as CSV and read back."""
    titles = _submissions(spark, folder).select("link_id", "title").unionByName(_planted(spark, planted.TITLES))
    path = shared_folder(spark)
    tables.write_csv(titles.withColumn("pos", F.length("title") / 7), path)
    return tables.read_rollup(spark, path, "link_id string, title string, pos double")


@query
def s8_sanitize_file(spark: SparkSession, folder: str) -> DataFrame:
    """All documents and planted texts as JSON lines, cleaned."""
    path = shared_folder(spark)
    _texts(spark, folder).select(F.col("text").alias("body")).write.option("ignoreNullFields", False).json(path)
    return tables.sanitize_file(spark, path)


@query
def p1_prepare_comments(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.prepare_comments(_all_comments(spark, folder))


@query
def p1_prepare_submissions(spark: SparkSession, folder: str) -> DataFrame:
    return _submissions(spark, folder)


@query
def p3_drop_sarcasm(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.drop_sarcasm(_all_bodies(spark, folder))


@query
def p4_drop_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.drop_quotes(_all_bodies(spark, folder))


@query
def p5_filter_states(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared_facts(spark, folder)
    return prepare.filter_states(prepared, STATES + planted.TEST_STATES).select("id", "state")


@query
def p6_match_tokens(spark: SparkSession, folder: str) -> DataFrame:
    asked, index, _, _ = _searched(spark, folder)
    matched = search.match_tokens(asked, index)
    return _rounded(matched.select("query_id", "song_id", "token", "score"), "score")


@query
def p7_drop_dates(spark: SparkSession, folder: str) -> DataFrame:
    days = _all_facts(spark, folder).select(utc_day(F.col("created_utc")).alias("date")).distinct()
    return chart.drop_dates(days)


@query
def p8_exclude_regions(spark: SparkSession, folder: str) -> DataFrame:
    return chart.exclude_regions(_regions(spark, folder), UNCHARTED_REGIONS + planted.TEST_UNCHARTED)


@query
def p9_strip_kind(spark: SparkSession, folder: str) -> DataFrame:
    return _all_facts(spark, folder).select("id", strip_kind(F.col("link_id")).alias("link_id"))


@query
def p10_with_url(spark: SparkSession, folder: str) -> DataFrame:
    return search.with_url(views.songs(spark, folder).select("song_id", "page_link"), "http://songs.example")


@query
def p12_to_chart(spark: SparkSession, folder: str) -> DataFrame:
    return chart.to_chart(rollup.sentiment_by_submission_score(_scored(spark, folder)))


# --- joins and aggregates -----------------------------------------------------


@query
def j1_label_comments(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.label_comments(views.bodies(spark, folder), views.labeled(spark, folder))


@query
def j2_attach_submission(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared_facts(spark, folder)
    return prepare.attach_submission(prepared, _submissions(spark, folder))


@query
def j3_attach_metadata(spark: SparkSession, folder: str) -> DataFrame:
    asked, index, song, artist = _searched(spark, folder)
    return search.attach_metadata(search.rank_songs(asked, index), song, artist).drop("score")


@query
def j4_songs_with_all_tokens(spark: SparkSession, folder: str) -> DataFrame:
    asked, index, _, _ = _searched(spark, folder)
    return search.rank_songs(asked.filter("lower(query_type) <> 'or'"), index).select("query_id", "song_id")


@query
def j5_region_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return chart.region_sentiment(_regions(spark, folder), _by_state(spark, folder))


@query
def a1_sentiment_by_post(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.sentiment_by_post(_scored(spark, folder))


@query
def a2_sentiment_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.sentiment_by_day(_scored(spark, folder))


@query
def a3_sentiment_by_state(spark: SparkSession, folder: str) -> DataFrame:
    return _by_state(spark, folder)


@query
def a4_sentiment_by_comment_score(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.sentiment_by_comment_score(_scored(spark, folder))


@query
def a5_sentiment_by_submission_score(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.sentiment_by_submission_score(_scored(spark, folder))


@query
def a5_all_rollups_at_once(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all rollups, from one reading of the scored comments."""
    shares = rollup.all_shares(_scored(spark, folder), STATES + planted.TEST_STATES)
    parts = []
    for name, keys in rollup.ROLLUP_KEYS.items():
        key = F.coalesce(F.col(keys[0]).cast("string"), F.lit("-"))
        title = F.col("title") if name == "posts" else F.lit(None).cast("string")
        parts.append(shares[name].select(F.lit(name).alias("rollup"), key.alias("key"), title.alias("title"), "pos", "neg"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def a6_sum_scores(spark: SparkSession, folder: str) -> DataFrame:
    asked, index, _, _ = _searched(spark, folder)
    return _rounded(search.rank_songs(asked.filter("lower(query_type) = 'or'"), index), "score")


@query
def a7_sum_scores_of_full_matches(spark: SparkSession, folder: str) -> DataFrame:
    asked, index, _, _ = _searched(spark, folder)
    return _rounded(search.rank_songs(asked.filter("lower(query_type) <> 'or'"), index), "score")


@query
def a8_result_count(spark: SparkSession, folder: str) -> DataFrame:
    asked, index, _, _ = _searched(spark, folder)
    return search.result_count(search.rank_songs(asked, index), asked)


@query
def a9_sentiment_difference(spark: SparkSession, folder: str) -> DataFrame:
    return chart.sentiment_difference(_by_state(spark, folder))


@query
def a10_chart_weight(spark: SparkSession, folder: str) -> DataFrame:
    weighted = chart.chart_weight(chart.sentiment_difference(_by_state(spark, folder)))
    return _rounded(
        weighted.select("state", "pos_weight", "neg_weight", "difference_weight"),
        "pos_weight", "neg_weight", "difference_weight",
    )


# --- top lists, pages, search -------------------------------------------------


@query
def t1_top_positive_posts(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.top_posts(rollup.sentiment_by_post(_scored(spark, folder)), "pos")


@query
def t2_top_negative_posts(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.top_posts(rollup.sentiment_by_post(_scored(spark, folder)), "neg")


@query
def t3_first_page(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(search.search_page(*_searched(spark, folder)), "score")


@query
def t3_first_page_from_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The first page from the whole index stored in blocks, of which only those that can hold it are read."""
    path = shared_folder(spark)
    blockmax.write_blocks(_index(spark, folder), path, 32, 64)
    asked = _planted(spark, planted.QUERIES)
    songs, artists = views.songs(spark, folder), views.artists(spark, folder)
    return _rounded(blockmax.search_first_page(spark, asked, path, songs, artists), "score")


@query
def t4_tenth_page(spark: SparkSession, folder: str) -> DataFrame:
    """A deep page, found by counting."""
    asked, index, _, _ = _searched(spark, folder)
    return _rounded(search.page(search.rank_songs(asked, index), 10), "score")


@query
def t4_third_page(spark: SparkSession, folder: str) -> DataFrame:
    asked, index, _, _ = _searched(spark, folder)
    return _rounded(search.page(search.rank_songs(asked, index), 3), "score")


def _materialized(spark: SparkSession, folder: str) -> str:
    asked, index, _, _ = _searched(spark, folder)
    path = shared_folder(spark)
    search.materialize(search.rank_songs(asked, index), path)
    return path


@query
def t4_stored_third_page(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(search.stored_pages(spark, _materialized(spark, folder), 3), "score")


@query
def q4_stored_results(spark: SparkSession, folder: str) -> DataFrame:
    """All results of all queries with their ranks, from the stored table."""
    return _rounded(search.published(spark, _materialized(spark, folder)), "score")


@query
def t6_turn_page(spark: SparkSession, folder: str) -> DataFrame:
    """The page after a button, for the turns of all conversations as requests."""
    button = F.when(F.col("role") == "user", "next").when(F.col("role") == "assistant", "previous")
    turns = tables.read_table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", search.turn_page(F.col("turn"), button).alias("n_page"))


@query
def t5_page_info(spark: SparkSession, folder: str) -> DataFrame:
    return search.page_info(a8_result_count(spark, folder), 3)


@query
def q1_search_or(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(search.search_or(*_searched(spark, folder)), "score")


@query
def q2_search_and(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(search.search_and(*_searched(spark, folder)), "score")


@query
def q2_search_and_ignoring_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(search.search_and(*_searched(spark, folder), strict_duplicates=False), "score")


@query
def q3_search(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(search.search(*_searched(spark, folder)), "score")


@query
def q3_search_stored_index(spark: SparkSession, folder: str) -> DataFrame:
    """The same search over the whole index, stored in folders and read back."""
    path = shared_folder(spark)
    search.write_index(_index(spark, folder), path, 64)
    asked = _planted(spark, planted.QUERIES)
    songs, artists = views.songs(spark, folder), views.artists(spark, folder)
    return _rounded(search.search(asked, search.read_index(spark, path), songs, artists), "score")


@query
def q3_search_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents hold every word of a benchmark item."""
    asked = tables.read_table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.lower("text").alias("query"), F.lit("and").alias("query_type")
    )
    return _rounded(search.rank_songs(asked, _index(spark, folder), strict_duplicates=False), "score")


# --- text and dates -----------------------------------------------------------


def _text_query(name: str, function: Callable, joined: bool = False) -> None:
    """Register a text function over all documents and the planted texts."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = function(F.col("text"))
        return _texts(spark, folder).select(
            "doc_id", (F.array_join(result, " ") if joined else result).alias("result")
        )

    run.__name__ = name
    query(run)


_text_query("x1_normalize", tx.normalize)
_text_query("x3_strip_urls", tx.strip_urls)
_text_query("x4_collapse_spaces", tx.collapse_spaces)
_text_query("x5_isolate_punct", tx.isolate_punct)
_text_query("x6_tokens", tx.tokens, joined=True)
_text_query("x7_parsed_text", tx.parsed_text)
_text_query("x8_unigrams", tx.unigrams, joined=True)
_text_query("x9_bigrams", tx.bigrams, joined=True)
_text_query("x9_trigrams", tx.trigrams, joined=True)
_text_query("x10_ngrams", tx.ngrams, joined=True)


@query
def x11_query_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of the planted queries and of every document's text as a query."""
    asked = _planted(spark, planted.QUERIES).select(F.col("query_id").cast("bigint"), "query")
    documents = _texts(spark, folder).select((F.col("doc_id") + 1000).alias("query_id"), F.col("text").alias("query"))
    return search.query_tokens(asked.unionByName(documents))


@query
def x12_build_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_index(spark, folder), "score")


@query
def d1_utc_day(spark: SparkSession, folder: str) -> DataFrame:
    return _all_facts(spark, folder).select("id", utc_day(F.col("created_utc")).alias("date"))


@query
def d2_parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    parsed = chart.parse_dates(d1_utc_day(spark, folder))
    return parsed.select("id", F.date_diff("date", F.lit("1970-01-01").cast("date")).alias("epoch_day"))


# --- features and models ------------------------------------------------------


@query
def m1_fit_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """A vocabulary of fewer terms than there are, as it is stored."""
    return _stored_vocabulary(spark, features.fit_vocabulary(_labeled(spark, folder), vocab_size=300))


def _stored_vocabulary(spark: SparkSession, fitted: CountVectorizerModel) -> DataFrame:
    path = shared_folder(spark)
    features.save_vocabulary(fitted, path)
    return features.vocabulary_rows(spark, path).select("term")


@query
def s6_stored_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_vocabulary(spark, features.fit_vocabulary(_labeled(spark, folder)))


@query
def m1_vocabulary_table(spark: SparkSession, folder: str) -> DataFrame:
    return features.vocabulary_table(features.add_ngrams(views.bodies(spark, folder)))


@query
def m2_vectorize(spark: SparkSession, folder: str) -> DataFrame:
    """Number of vocabulary terms per comment, from the feature vectors."""
    fitted = features.fit_vocabulary(_labeled(spark, folder))
    vectors = features.vectorize(fitted, features.add_ngrams(_all_bodies(spark, folder)))
    return vectors.select(
        "id", F.size(F.unwrap_udt("features")["indices"]).cast("bigint").alias("n_terms")
    )


@query
def m2_feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = stage(features.vocabulary_table(_labeled(spark, folder)))
    return features.feature_rows(features.add_ngrams(_all_bodies(spark, folder)), vocabulary, often="df")


@query
def m3_add_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The 0/1 labels of both classifiers (M3, M4)."""
    labels = views.labeled(spark, folder).unionByName(_planted(spark, planted.LABELS))
    return prepare.add_labels(labels).select("Input_id", "pos_label", "neg_label")


@query
def m5_split_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    """Both halves of both splits, by the part each comment falls in."""
    parts = []
    for seed in ("pos", "neg"):
        halves = prepare.split_by_hash(views.labeled(spark, folder).select("Input_id"), "Input_id", 50, seed)
        parts += [
            half.select("Input_id", F.lit(seed).alias("kind"), F.lit(name).alias("part"))
            for half, name in zip(halves, ("train", "test"))
        ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def m10_threshold_flag(spark: SparkSession, folder: str) -> DataFrame:
    chances = _chances(spark, folder)
    both = chances.select("id", F.col("pos").alias("chance")).unionByName(_planted(spark, planted.CHANCES))
    return both.select(
        "id",
        threshold_flag(F.col("chance"), model.THRESHOLDS["pos"]).alias("pos_prob"),
        threshold_flag(F.col("chance"), model.THRESHOLDS["neg"]).alias("neg_prob"),
    )


@query
def m11_score_linear(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_chances(spark, folder).select("id", "pos", "neg"), "pos", "neg")


def _featured(spark: SparkSession, folder: str) -> tuple:
    """The fitted vocabulary and the labelled comments as feature vectors, which every fit reads as they are written."""
    labeled = stage(_labeled(spark, folder).select("Input_id", "n_gram", "pos_label", "neg_label"))
    vocabulary = features.fit_vocabulary(labeled)
    return vocabulary, stage(features.vectorize(vocabulary, labeled).drop("n_gram"))


def _loss(fitted: LogisticRegressionModel, train: DataFrame, kind: str) -> Column:
    chance = vector_to_array(F.col(f"{kind}_probability"))[1]
    return -F.avg(F.log(F.when(F.col(f"{kind}_label") == 1, chance).otherwise(1 - chance)))


#: By the steps of a fit, the part of the gradient at no weights that may be left; the classifiers take ten.
GRADIENT_LEFT = {10: 0.1, 100: 1e-4}


def _near_best(train: DataFrame, kind: str) -> bool:
    """Has the gradient of the regularised loss fallen as far as it should?"""
    squares = [F.sum(F.col(c) * F.col(c)) for c in ("gradient", "at_zero")]
    for steps, left in GRADIENT_LEFT.items():
        fitted = model.logistic_regression(kind).setRegParam(1.0).setMaxIter(steps).fit(train)
        if model.gradient(fitted, train, kind, 1.0).agg(squares[0] / squares[1]).first()[0] >= left * left:
            return False
    return True


@query
def m6_fit_logistic_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and positives that each classifier is fitted on, whether it does better than no weights, and is near the best."""
    _, labeled = _featured(spark, folder)
    parts = []
    for kind in model.THRESHOLDS:
        train, _ = prepare.split_by_hash(labeled, "Input_id", 50, kind)
        train = stage(train)
        fitted = model.logistic_regression(kind).setRegParam(1.0).fit(train)
        parts.append(
            fitted.transform(train).agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.sum(f"{kind}_label").alias("n_positive"),
                (_loss(fitted, train, kind) < F.log(F.lit(2.0))).alias("fits"),
                F.lit(_near_best(train, kind)).alias("near_best"),
            ).select(F.lit(kind).alias("kind"), "n_rows", "n_positive", "fits", "near_best")
        )
    return parts[0].unionByName(parts[1])


Trained = tuple[CountVectorizerModel, dict[str, CrossValidatorModel], dict[str, tuple[DataFrame, DataFrame]]]


def _trained(spark: SparkSession, folder: str) -> Trained:
    """The vocabulary, both classifiers, and for each the half it was fitted on and the other."""
    vocabulary, labeled = _featured(spark, folder)
    halves = {kind: prepare.split_by_hash(labeled, "Input_id", 50, kind) for kind in model.THRESHOLDS}
    fitted = model.fit_classifiers({kind: half[0] for kind, half in halves.items()}, "Input_id")
    return vocabulary, fitted, halves


@query
def m7_cross_validate(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of each fold of each classifier, and whether its mean area is that of five fits of their own."""
    _, fitted, halves = _trained(spark, folder)
    parts = []
    for kind, (train, _) in halves.items():
        areas = model.fold_areas(train, kind, "Input_id")
        agrees = abs(fitted[kind].avgMetrics[0] - sum(areas) / len(areas)) < 1e-9
        sizes = model.add_fold(train, kind, "Input_id").groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(sizes.select(F.lit(kind).alias("kind"), "fold", "n_rows", F.lit(agrees).alias("agrees")))
    return parts[0].unionByName(parts[1])


def _vectors(spark: SparkSession, folder: str, vocabulary: CountVectorizerModel) -> DataFrame:
    """All kept comments as feature vectors."""
    return features.vectorize(vocabulary, features.add_ngrams(_kept(spark, folder))).select("id", "features")


def _applied(
    spark: SparkSession, folder: str, vocabulary: CountVectorizerModel, fitted: dict[str, CrossValidatorModel]
) -> DataFrame:
    """All kept comments, scored by both classifiers."""
    return model.score(_vectors(spark, folder, vocabulary), fitted["pos"], fitted["neg"])


@query
def m8_prediction_equals_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Per comment: the models' own thresholds give the flags taken from the chances."""
    vocabulary, fitted, _ = _trained(spark, folder)
    return _applied(spark, folder, vocabulary, fitted).select(
        "id",
        (F.col("pos_predict") == F.col("pos_prob")).alias("pos_agrees"),
        (F.col("neg_predict") == F.col("neg_prob")).alias("neg_agrees"),
    )


@query
def m9_score(spark: SparkSession, folder: str) -> DataFrame:
    """Per comment: both chances are those of the stored weights of the terms it holds."""
    vocabulary, fitted, _ = _trained(spark, folder)
    path = shared_folder(spark)
    features.save_vocabulary(vocabulary, f"{path}/vocabulary")
    weights, start = features.vocabulary_rows(spark, f"{path}/vocabulary"), {}
    for kind, best in fitted.items():
        model.save_classifier(best, f"{path}/{kind}")
        stored = model.weight_rows(spark, f"{path}/{kind}").withColumnRenamed("weight", kind)
        start[kind] = stored.filter("position = -1").first()[kind]
        weights = weights.join(stored, "position", "left").fillna(0.0, [kind])
    linear = features.score_linear(
        features.add_ngrams(_kept(spark, folder)), ["id"], stage(weights.drop("position")), start
    )
    scored = _applied(spark, folder, vocabulary, fitted)
    chances = {f"{kind}_chance": vector_to_array(F.col(f"{kind}_probability"))[1] for kind in fitted}
    return linear.join(scored.withColumns(chances).select("id", *chances), "id").select(
        "id", *(F.coalesce(F.abs(F.col(k) - F.col(f"{k}_chance")) < 1e-9, F.lit(False)).alias(f"{k}_agrees") for k in fitted)
    )


@query
def s7_stored_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Per comment: classifiers read from storage flag what the fitted ones flag."""
    vocabulary, fitted, _ = _trained(spark, folder)
    path = shared_folder(spark)
    for kind, best in fitted.items():
        model.save_classifier(best, f"{path}/{kind}")
    loaded = {kind: model.load_classifier(f"{path}/{kind}") for kind in fitted}
    # Cleaning the texts costs far more than scoring them: their vectors are made once, for both.
    corpus = stage(_vectors(spark, folder, vocabulary))
    ours = model.score(corpus, fitted["pos"], fitted["neg"]).select("id", "pos_prob", "neg_prob")
    theirs = model.score(corpus, loaded["pos"], loaded["neg"]).select(
        "id", F.col("pos_prob").alias("pos_loaded"), F.col("neg_prob").alias("neg_loaded")
    )
    return ours.join(theirs, "id").select(
        "id",
        (F.col("pos_prob") == F.col("pos_loaded")).alias("pos_agrees"),
        (F.col("neg_prob") == F.col("neg_loaded")).alias("neg_agrees"),
    )


@query
def m12_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the area under the ROC curve, on the unseen half, is that of the chances' ranks."""
    _, fitted, halves = _trained(spark, folder)
    parts = []
    for kind, best in fitted.items():
        area = model.evaluate(best, halves[kind][1], kind)
        by_ranks = model.area_by_ranks(best.transform(halves[kind][1]), kind)
        agrees = F.coalesce(F.abs(F.col("area") - F.lit(area)) < 1e-9, F.lit(False))
        parts.append(by_ranks.select(F.lit(kind).alias("kind"), agrees.alias("agrees")))
    return parts[0].unionByName(parts[1])
