"""The sentiment job and the charts, from raw files to tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from talkweave.plans import charts, planted, sentiment
from talkweave.sources import views
from talkweave.sources.tables import read_rollup

FOLDER = "/root/testdata/sf0.01"


def test_sentiment_job(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    comments = views.comments(spark, FOLDER)
    extra = spark.sql(f"SELECT * FROM {planted.COMMENTS}").withColumn("created_utc", F.col("created_utc").cast("bigint"))
    comments = comments.unionByName(extra)
    comments.write.option("compression", "bzip2").json(f"{raw}/comments")
    views.submissions(spark, FOLDER).write.option("compression", "bzip2").json(f"{raw}/submissions")
    views.labeled(spark, FOLDER).coalesce(1).write.csv(f"{raw}/labels", header=True)

    areas = sentiment.run(
        spark, f"{raw}/submissions", f"{raw}/comments", f"{raw}/labels", out, planted.TEST_STATES + ("Texas",)
    )
    assert set(areas) == {"pos", "neg"} and all(0 <= area <= 1 for area in areas.values())

    scored = spark.read.parquet(f"{out}/scored.parquet")
    posts = views.submissions(spark, FOLDER).select(F.concat(F.lit("t3_"), "id").alias("link_id"))
    kept = comments.filter("NOT contains(body, '/s') AND NOT startswith(body, '&gt;')").join(posts, "link_id")
    assert scored.count() == kept.count() > 800
    assert {"title", "sub_score", "pos_prob", "neg_predict", "pos_rawPredict"} <= set(scored.columns)
    assert scored.filter("pos_prob <> pos_predict OR neg_prob <> neg_predict").count() == 0

    for name in ("top_pos_posts", "top_neg_posts", "days", "states", "sub_score", "com_score"):
        assert len(list(Path(out, f"{name}.csv").glob("part-*"))) == 1
    top = read_rollup(spark, f"{out}/top_pos_posts.csv", "link_id string, title string, pos double, neg double")
    assert top.count() == 10 and top.join(posts, F.concat(F.lit("t3_"), top.link_id) == posts.link_id).count() == 10
    assert top.filter("title LIKE '%\n%'").count() > 0

    regions = spark.read.parquet(f"{FOLDER}/nation.parquet").select(F.col("n_name").alias("name"))
    tables = charts.chart_tables(spark, out, regions)
    assert tables["time"].columns == ["date", "Positive", "Negative"]
    assert tables["map"].count() == 25
    assert tables["map"].filter("Positive IS NOT NULL").count() == 10
    assert tables["submission_score"].columns == ["submission_score", "Positive", "Negative"]
    assert tables["comment_score"].filter("Positive < 0 OR Positive > 1").count() == 0
