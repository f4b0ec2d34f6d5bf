"""What the plans of the text queries move between tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from compare import TESTDATA
from talkweave.operators import features, model, rollup

FOLDER = str(TESTDATA / "sf0.001")
TEXT_QUERIES = [
    "a1_sentiment_by_post", "a2_sentiment_by_day", "a3_sentiment_by_state", "a4_sentiment_by_comment_score",
    "a5_sentiment_by_submission_score", "m1_vocabulary_table", "m2_feature_rows", "m11_score_linear",
    "p3_drop_sarcasm", "p4_drop_quotes", "j1_label_comments", "x10_ngrams",
]


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", TEXT_QUERIES)
def test_no_exchange_carries_texts(spark, no_broadcast, name, capsys):
    queries()[name](spark, FOLDER).explain("formatted")
    plan = capsys.readouterr().out
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert all(not re.search(r"\b(?:text|body|n_gram|parsed_text)#", columns) for columns in moved)


def test_feature_rows_send_no_row_for_each_term(spark, no_broadcast, capsys):
    """Where Spark by itself broadcasts nothing, the terms of comments still meet the vocabulary where they are read."""
    queries()["m2_feature_rows"](spark, FOLDER).explain("formatted")
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", capsys.readouterr().out)
    assert not [columns for columns in moved if re.search(r"\bid#", columns)]


def test_all_rollups_read_the_scored_table_once(spark, tmp_path, monkeypatch):
    """One scan for six results, which equal those of the single rollups."""
    path = str(tmp_path / "scored")
    rows = spark.range(500).select(
        (F.col("id") % 7).cast("string").alias("link_id"), F.concat(F.lit("t"), F.col("id") % 7).alias("title"),
        (F.col("id") * 40_000).alias("created_utc"), F.element_at(F.array(F.lit("Texas"), F.lit("Nowhere"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("state"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).cast("int").alias("com_score"), (F.col("id") % 4).cast("int").alias("sub_score"),
        (F.col("id") % 2).cast("int").alias("pos_prob"), (F.col("id") % 3 % 2).cast("int").alias("neg_prob"),
    )
    rows.write.parquet(path)
    scored = spark.read.parquet(path)
    planned = []
    monkeypatch.setattr(rollup, "stage", lambda df: (planned.append(df._jdf.queryExecution().executedPlan().toString()), df)[1])
    shares = rollup.all_shares(scored)
    assert len(planned) == 1 and planned[0].count("FileScan") == 1 and planned[0].count("Exchange hashpartitioning") == 1
    single = {
        "posts": rollup.sentiment_by_post(scored), "days": rollup.sentiment_by_day(scored), "states": rollup.sentiment_by_state(scored),
        "sub_score": rollup.sentiment_by_submission_score(scored), "com_score": rollup.sentiment_by_comment_score(scored),
    }
    for name, want in single.items():
        assert sorted(map(repr, shares[name].collect())) == sorted(map(repr, want.collect()))


def test_area_by_ranks_orders_no_whole_table(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([-x, x]), float(i % 3 == 0)) for i, x in enumerate([0.1 * (k % 17) for k in range(200)])]
    scored = spark.createDataFrame(rows, ["pos_rawPredict", "pos_label"])
    want = model.area_under_roc("pos").evaluate(scored)
    for count in (1, 5):
        areas = model.area_by_ranks(scored.repartition(count), "pos")
        assert abs(areas.first()["area"] - want) < 1e-9
    plan = areas._jdf.queryExecution().executedPlan().toString()
    # Only the row for each partition is ordered as a whole.
    assert plan.count("chance") and "Window [sum(n" in plan


def test_stored_classifiers_score_vectors_made_once(spark, monkeypatch):
    """Both pairs of classifiers read the same written vectors; no text is cleaned for the comparison itself."""
    vectorized = []
    whole = features.vectorize
    monkeypatch.setattr(features, "vectorize", lambda fitted, df: (vectorized.append(df.columns), whole(fitted, df))[1])
    agrees = queries()["s7_stored_classifier"](spark, FOLDER)
    # Once for the labelled comments, once for all.
    assert len(vectorized) == 2
    assert "regexp_extract_all" not in agrees._jdf.queryExecution().optimizedPlan().toString()
