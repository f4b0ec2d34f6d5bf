from __future__ import annotations

from pyspark.sql import functions as F

from talkweave.functions.columns import parse_day, strip_kind, threshold_flag, utc_day
from talkweave.functions.states import STATES
from talkweave.operators import chart, prepare, rollup, skew


def test_state_list():
    assert len(STATES) == len(set(STATES)) == 51


def test_filters(spark):
    bodies = ["nice /s", "see /story", None, "&gt; quoted", " &gt; not first", "plain"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {r["body"] for r in prepare.drop_sarcasm(df).collect()} == {"&gt; quoted", " &gt; not first", "plain"}
    assert None not in {r["body"] for r in prepare.drop_quotes(df).collect()}
    assert prepare.drop_quotes(df).count() == 4
    states = spark.createDataFrame([("Texas",), ("texas",), (None,)], "state string")
    assert [r["state"] for r in prepare.filter_states(states, STATES).collect()] == ["Texas"]


def test_columns(spark):
    df = spark.createDataFrame(
        [("t3_abc", 0.2, 1514764799, "2017-12-31"), (None, 0.2000001, 0, "1970-01-01")],
        "link_id string, p double, seconds bigint, day string",
    )
    rows = df.select(
        strip_kind(F.col("link_id")).alias("k"),
        threshold_flag(F.col("p"), 0.2).alias("f"),
        (utc_day(F.col("seconds")) == F.col("day")).alias("same"),
        parse_day(F.col("day")).cast("string").alias("d"),
    ).collect()
    assert [tuple(r) for r in rows] == [("abc", 0, True, "2017-12-31"), (None, 1, True, "1970-01-01")]


def test_labels(spark):
    df = spark.createDataFrame([(1,), (0,), (-1,), (2,), (None,)], "labeldjt int")
    rows = prepare.add_labels(df).select("pos_label", "neg_label").collect()
    assert [tuple(r) for r in rows] == [(1, 0), (0, 0), (0, 1), (0, 0), (0, 0)]


def test_split(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    first, second = prepare.split_by_hash(df, "id", 50, "pos")
    other, _ = prepare.split_by_hash(df, "id", 50, "neg")
    assert first.count() + second.count() == 2000
    assert first.intersect(second).count() == 0
    assert 900 < first.count() < 1100
    assert 400 < first.intersect(other).count() < 600
    again, _ = prepare.split_by_hash(df.repartition(7), "id", 50, "pos")
    assert again.exceptAll(first).count() == 0


def _comments(spark, n: int):
    """Comments, two thirds of them on one post, some on none."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.col("id").alias("created_utc"),
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 30 == 29, None)
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("link_id"),
    )


def test_salted_join_equals_plain_join(spark):
    comments = _comments(spark, 3000)
    posts = spark.createDataFrame(
        [("hot", "hot post", 1)] + [(f"p{i}", f"post {i}", i) for i in range(40)],
        "link_id string, title string, sub_score int",
    )
    plain = comments.join(posts, "link_id").select(*sorted(comments.columns), "title")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    counts = comments.groupBy("link_id").count()
    try:
        for partitions in (1, 8, 60, 500):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            hot = skew.hot_keys(counts, "link_id", "count")
            # No more hot keys than partitions, and few copies, whatever the mean.
            assert hot.count() <= partitions and (hot.agg(F.sum("slices")).first()[0] or 0) <= 2 * partitions
            salted = prepare.attach_submission(comments, posts).select(*sorted(comments.columns), "title")
            assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
            left = skew.salted_join(comments, posts, "link_id", hot, "id", "left")
            assert left.count() == 3000 and left.filter("title IS NULL").count() == 3000 - plain.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_broadcast_is_measured_in_bytes(spark):
    from pyspark.sql import functions as F

    long = spark.createDataFrame([("x" * 5000,), (None,)], "t string")
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "Hint broadcast" in plan(skew.broadcast_if_small(long, 6000))
    assert "Hint broadcast" not in plan(skew.broadcast_if_small(long, 5000))
    assert "Hint broadcast" in plan(skew.broadcast_if_small(long.filter(F.lit(False)), 10))


def test_hot_rows_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        comments = _comments(spark, 3000)
        posts = spark.createDataFrame([("hot", "t", 1)], "link_id string, title string, sub_score int")
        joined = prepare.attach_submission(comments, posts)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2000 and max(sizes) < 1200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rollups(spark):
    rows = [("a", "A", 1514764799, "Texas", None, 5, 1, 0), ("a", "A", 1514764800, "texas", 3, 5, 0, 0),
            ("b", "B", 1514764800, "Texas", None, 6, 1, 1)]
    scored = spark.createDataFrame(
        rows,
        "link_id string, title string, created_utc bigint, state string, com_score int, sub_score int,"
        " pos_prob int, neg_prob int",
    )
    found = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert found(rollup.sentiment_by_post(scored)) == [("a", "A", 0.5, 0.0), ("b", "B", 1.0, 1.0)]
    assert found(rollup.sentiment_by_day(scored)) == [("2017-12-31", 1.0, 0.0), ("2018-01-01", 0.5, 0.5)]
    assert found(rollup.sentiment_by_state(scored)) == [("Texas", 1.0, 0.5)]
    assert found(rollup.sentiment_by_comment_score(scored)) == [(3, 0.0, 0.0), (None, 1.0, 0.5)]
    assert found(rollup.sentiment_by_submission_score(scored)) == [(5, 0.5, 0.0), (6, 1.0, 1.0)]


def test_top_posts_break_ties_by_link(spark):
    rows = [(f"p{i:02}", "t", 0.5, 0.5) for i in range(12)] + [("z", "t", 0.6, 0.1)]
    by_post = spark.createDataFrame(rows, "link_id string, title string, pos double, neg double").repartition(4)
    assert [r["link_id"] for r in rollup.top_posts(by_post, "pos").collect()] == ["z"] + [f"p{i:02}" for i in range(9)]
    assert [r["link_id"] for r in rollup.top_posts(by_post, "neg").collect()] == [f"p{i:02}" for i in range(10)]


def test_charts(spark):
    by_state = spark.createDataFrame(
        [("Texas", 0.64, 0.36), ("Ohio", 0.25, 0.5), ("Utah", 0.5, 0.5)], "state string, pos double, neg double"
    )
    regions = spark.createDataFrame([("Texas",), ("Puerto Rico",), ("",), ("Guam",), ("Ohio",), ("Utah",)], "name string")
    mapped = chart.region_sentiment(chart.exclude_regions(regions), by_state)
    rows = {r["name"]: r for r in chart.chart_weight(chart.sentiment_difference(mapped), 1.0).collect()}
    assert set(rows) == {"Texas", "Guam", "Ohio", "Utah"}
    assert rows["Guam"]["pos"] is None and rows["Guam"]["sign"] is None
    assert (rows["Texas"]["sign"], rows["Ohio"]["sign"], rows["Utah"]["sign"]) == (1, -1, 1)
    assert abs(rows["Texas"]["pos_weight"] - 0.2) < 1e-12
    assert abs(rows["Ohio"]["difference_weight"] - 0.75) < 1e-12
    days = spark.createDataFrame([("2018-12-31", 1.0, 0.0), ("2018-01-02", 0.5, 0.1)], "date string, pos double, neg double")
    table = chart.to_chart(chart.parse_dates(chart.drop_dates(days)))
    assert table.columns == ["date", "Positive", "Negative"]
    assert [str(r["date"]) for r in table.collect()] == ["2018-01-02"]
