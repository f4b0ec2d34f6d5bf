"""Models on labels planted as 'the document holds a term'."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from talkweave.operators import features, model, prepare

TERM = "le"


@pytest.fixture(scope="module")
def trained(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 400")
    texts = features.add_ngrams(documents.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("body")))
    texts = texts.withColumn("labeldjt", F.when(F.array_contains("n_gram", TERM), 1).otherwise(-1))
    labeled = prepare.add_labels(texts).persist()
    vocabulary = features.fit_vocabulary(labeled)
    vectors = features.vectorize(vocabulary, labeled).persist()
    fitted, halves = {}, {}
    for kind in model.THRESHOLDS:
        halves[kind] = prepare.split_by_hash(vectors, "id", 50, kind)
        fitted[kind] = model.fit_classifier(halves[kind][0], kind, "id", folds=2)
    yield labeled, vocabulary, vectors, fitted, halves
    vectors.unpersist()
    labeled.unpersist()


def test_vocabulary_equals_table(trained):
    labeled, vocabulary, *_ = trained
    table = {r["term"] for r in features.vocabulary_table(labeled).collect()}
    assert set(vocabulary.vocabulary) == table


def test_models_learn_the_term(trained):
    *_, fitted, halves = trained
    for kind in model.THRESHOLDS:
        assert model.evaluate(fitted[kind], halves[kind][1], kind) > 0.8


def test_flag_equals_prediction(trained):
    _, _, vectors, fitted, _ = trained
    scored = model.score(vectors, fitted["pos"], fitted["neg"])
    assert scored.filter("pos_prob <> pos_predict OR neg_prob <> neg_predict").count() == 0
    assert scored.count() == 400


def test_saved_models_predict_the_same(trained, tmp_path):
    labeled, vocabulary, vectors, fitted, _ = trained
    model.save_classifier(fitted["pos"], str(tmp_path / "pos.model"))
    model.save_classifier(fitted["pos"], str(tmp_path / "pos.model"))
    features.save_vocabulary(vocabulary, str(tmp_path / "v.model"))
    features.save_vocabulary(vocabulary, str(tmp_path / "v.model"))
    again = model.load_classifier(str(tmp_path / "pos.model"))
    loaded = features.load_vocabulary(str(tmp_path / "v.model"))
    chances = lambda m, df: {r["id"]: r["pos_probability"] for r in m.transform(df).collect()}
    assert chances(fitted["pos"], vectors) == chances(again, features.vectorize(loaded, labeled))


def test_linear_score_equals_model(spark, trained):
    """The relational score with the trained weights gives the model's chances."""
    labeled, vocabulary, vectors, fitted, _ = trained
    rows, start = {}, {}
    for kind in model.THRESHOLDS:
        best = fitted[kind].bestModel
        rows[kind] = [float(w) for w in best.coefficients.toArray()]
        start[kind] = float(best.intercept)
    weights = spark.createDataFrame(
        list(zip(vocabulary.vocabulary, rows["pos"], rows["neg"])), "term string, pos double, neg double"
    )
    linear = features.score_linear(labeled, ["id"], weights, start)
    scored = model.score(vectors, fitted["pos"], fitted["neg"]).select(
        "id", *[vector_to_array(f"{k}_probability")[1].alias(f"{k}_chance") for k in model.THRESHOLDS]
    )
    joined = linear.join(scored, "id")
    assert joined.count() == 400
    assert joined.filter("abs(pos - pos_chance) > 1e-9 OR abs(neg - neg_chance) > 1e-9").count() == 0


def test_row_without_terms_gets_the_intercept(spark):
    df = features.add_ngrams(spark.createDataFrame([("1", ""), ("2", "x y")], "id string, body string"))
    weights = spark.createDataFrame([("x", 2.0)], "term string, w double")
    rows = {r["id"]: r["w"] for r in features.score_linear(df, ["id"], weights, {"w": 0.0}).collect()}
    assert rows["1"] == 0.5 and abs(rows["2"] - 0.8807970779778823) < 1e-12


def test_feature_rows(spark):
    df = features.add_ngrams(
        spark.createDataFrame([("1", "a b a"), ("2", "b c"), ("3", "")], "id string, body string")
    )
    vocabulary = features.vocabulary_table(df, min_df=2)
    assert sorted(map(tuple, vocabulary.collect())) == [("b", 2)]
    assert sorted(map(tuple, features.feature_rows(df, vocabulary).collect())) == [("1", "b"), ("2", "b")]


def test_vocabulary_is_counted_before_the_shuffle_by_stretches(spark, monkeypatch):
    """A task adds nothing up but the terms of a stretch; the counts are those of the rows that hold a term."""
    rows = [(" ".join(f"w{(i * k) % 23}" for k in range(i % 12)),) for i in range(200)] + [(None,), ("w1 w1",)]
    df = features.add_ngrams(spark.createDataFrame(rows, "body string").coalesce(1))
    plain = features.term_rows(df).groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter("df >= 7")
    for most in (1, 60, 1 << 22):
        monkeypatch.setattr(features, "COUNTED", most)
        table = features.vocabulary_table(df, min_df=7)
        assert table.dtypes == plain.dtypes
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, plain.collect()))
    plan = features.vocabulary_table(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "Aggregate" not in plan[plan.index("Exchange") :]


def test_feature_rows_of_any_vocabulary(spark, monkeypatch):
    """A large vocabulary gives the rows that a small one gives, repeated and missing keys, rows and terms included."""
    rows = [(i % 50, " ".join(f"w{(i * k) % 97}" for k in range(1, i % 12 + 1))) for i in range(300)] + [(7, None), (None, "w1 w2")]
    df = features.add_ngrams(spark.createDataFrame(rows, "number bigint, body string").repartition(3)).unionByName(
        spark.createDataFrame([(9, "", None), (9, "", ["w3", None, "w3"])], "number bigint, body string, n_gram array<string>")
    )
    found = {r.term: r.df for r in features.vocabulary_table(df, 1).collect()}
    vocabulary = [(f"w{i}", found.get(f"w{i}", 0)) for i in range(80)] + [("w7", 1), (None, 900), ("w2_w3", None), ("w1_w2", 1)]
    vocabulary = spark.createDataFrame(vocabulary, "term string, df bigint").persist()
    plain = features.term_rows(df, "number").join(vocabulary.select("term"), "term", "left_semi").select("number", "term")
    want, dtypes = sorted(map(str, plain.collect())), plain.dtypes
    keep, sent = features.stage, {}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert sorted(map(str, features.feature_rows(df, vocabulary, "number").collect())) == want
        monkeypatch.setattr(features, "is_small", lambda table: False)
        for most, held_bytes, often in ((1, 40 * 8, "df"), (20, 40 * 8, "df"), (1 << 21, 40 * 8, "df"), (20, 0, "df"), (20, 1 << 20, "df"), (20, 1 << 20, None)):
            monkeypatch.setattr(features, "COUNTED", most)
            monkeypatch.setattr(features, "HELD_BYTES", held_bytes)
            moved = []
            monkeypatch.setattr(features, "stage", lambda table: (moved.append(keep(table)), moved[-1])[1])
            large = features.feature_rows(df, vocabulary, "number", often)
            assert sorted(map(str, large.collect())) == want and large.dtypes == dtypes
            pairs = moved[-1].filter("NOT known").join(vocabulary, "term", "left_semi").selectExpr("sum(size(held))").first()[0] or 0
            sent[most, held_bytes, often] = pairs
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        vocabulary.unpersist()
    # What is held is not sent: nothing, part, or all of it.
    assert sent[20, 1 << 20, "df"] == 0 < sent[20, 40 * 8, "df"] < sent[20, 0, "df"] == sent[20, 1 << 20, None] == len(want)


def test_vocabulary_over_the_limit_equals_the_estimator(spark):
    texts = [(f"w{i % 7} " * (i % 4 + 1) + "x, " * i + "y",) for i in range(30)]
    df = features.add_ngrams(spark.createDataFrame(texts, "body string")).persist()
    for size in (1, 2, 9):
        fitted = CountVectorizer(inputCol="n_gram", outputCol="f", minDF=2.0, binary=True, vocabSize=size).fit(df)
        ours = features.fit_vocabulary(df, min_df=2, vocab_size=size).vocabulary
        assert len(ours) == size
        totals = df.select(F.explode("n_gram").alias("term")).groupBy("term").count()
        total = {r["term"]: r["count"] for r in totals.collect()}
        assert sorted(total[t] for t in ours) == sorted(total[t] for t in fitted.vocabulary)


def test_most_frequent_by_count_then_digest(spark):
    import hashlib

    rows = [(f"t{i}", 5 if i % 3 else i % 40 + 1) for i in range(900)]
    counts = spark.createDataFrame(rows, "term string, total bigint").persist()
    order = sorted(rows, key=lambda r: (-r[1], int(hashlib.md5(r[0].encode()).hexdigest()[:15], 16), r[0]))
    for most in (1, 30, 200, 899, 900, 5000):
        found = {r.term for r in features.most_frequent(counts, "total", "term", most).collect()}
        assert found == {term for term, _ in order[:most]}
    counts.unpersist()


def test_equal_keys_stay_apart(spark):
    df = features.add_ngrams(spark.createDataFrame([("1", "x"), ("1", "x x"), ("1", "")], "id string, body string"))
    weights = spark.createDataFrame([("x", 2.0)], "term string, w double")
    rows = [round(r["w"], 6) for r in features.score_linear(df, ["id"], weights, {"w": 0.0}).collect()]
    assert sorted(rows) == [0.5, 0.880797, 0.880797]


def test_folds_do_not_depend_on_layout(trained):
    *_, halves = trained
    one = model.fit_classifier(halves["pos"][0].repartition(1), "pos", "id", folds=3)
    many = model.fit_classifier(halves["pos"][0].repartition(7, "features"), "pos", "id", folds=3)
    assert one.avgMetrics == pytest.approx(many.avgMetrics, abs=1e-9)


def test_both_classifiers_at_once(trained):
    *_, fitted, halves = trained
    both = model.fit_classifiers({kind: half[0] for kind, half in halves.items()}, "id", folds=2)
    for kind in model.THRESHOLDS:
        assert both[kind].bestModel.coefficients == fitted[kind].bestModel.coefficients


def test_weights_too_large_to_broadcast(spark, monkeypatch):
    """Large weights give the same chances; a term goes once to its weights with all rows that hold it."""
    rows = [(str(i % 50), " ".join(f"w{(i * k) % 97}" for k in range(1, i % 12 + 1))) for i in range(300)] + [("x", None)]
    df = features.add_ngrams(spark.createDataFrame(rows, "id string, body string").repartition(3))
    weights = [(f"w{i}", 0.01 * i, -0.02 * i) for i in range(80)] + [("w1_w2", 0.5, 0.25)]
    weights = spark.createDataFrame(weights, "term string, pos double, neg double").persist()
    start = {"pos": -0.5, "neg": 0.1}
    small = features.score_linear(df, ["id"], weights, start)
    for gathered in (1, 1 << 21):
        monkeypatch.setattr(features, "GATHERED", gathered)
        monkeypatch.setattr(features, "is_small", lambda table: False)
        moved = []
        keep = features.stage
        monkeypatch.setattr(features, "stage", lambda table: (moved.append(keep(table)), moved[-1])[1])
        large = features.score_linear(df, ["id"], weights, start)
        monkeypatch.setattr(features, "stage", keep)
        plain = lambda table: sorted((r["id"], round(r["pos"], 9), round(r["neg"], 9)) for r in table.collect())
        assert plain(large) == plain(small) and large.count() == 301
        sent = moved[0].filter("term IS NOT NULL")
    # Three tasks: at most one row for each of them and term, besides the few that the filter lets pass.
    assert sent.join(weights, "term").count() <= 3 * 81 < sent.selectExpr("sum(size(held))").first()[0]
    weights.unpersist()


def test_frequent_terms_of_large_weights_stay_in_their_tasks(spark, monkeypatch):
    """Of weights too large to broadcast, only the terms found seldom are sent; the chances are the same."""
    rows = [(str(i % 50), " ".join(f"w{(i * k) % 97}" for k in range(1, i % 12 + 1))) for i in range(300)] + [("x", None), (None, "w1 w2")]
    df = features.add_ngrams(spark.createDataFrame(rows, "id string, body string").repartition(3))
    found = {r.term: r.df for r in features.term_totals(df).collect()}
    weights = [(f"w{i}", found.get(f"w{i}", 0), 0.01 * i, -0.02 * i) for i in range(80)] + [("w1_w2", 1, 0.5, 0.25)]
    # Twice the same term, a term that is missing, a weight that is missing.
    weights += [("w7", 1, 0.125, 0.5), (None, 900, 5.0, 5.0), ("w2_w3", None, None, 1.0)]
    weights = spark.createDataFrame(weights, "term string, n bigint, pos double, neg double").persist()
    start = {"pos": -0.5, "neg": 0.1}
    plain = lambda table: sorted((str(r["id"]), round(r["pos"], 9), round(r["neg"], 9)) for r in table.collect())
    small = plain(features.score_linear(df, ["id"], weights, start))
    monkeypatch.setattr(features, "is_small", lambda table: False)
    keep = features.stage
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for gathered, held_bytes in ((1, 40 * 24), (20, 40 * 24), (1 << 21, 40 * 24), (20, 0), (20, 1 << 20)):
            monkeypatch.setattr(features, "GATHERED", gathered)
            monkeypatch.setattr(features, "HELD_BYTES", held_bytes)
            moved = []
            monkeypatch.setattr(features, "stage", lambda table: (moved.append(keep(table)), moved[-1])[1])
            large = features.score_linear(df, ["id"], weights, start, "n")
            assert plain(large) == small and len(small) == 302
            sent = {r.term for r in moved[-1].filter("term IS NOT NULL").join(weights, "term").collect()}
            if held_bytes == 40 * 24:
                # Terms are held from the most frequent down, so none that is sent is found more often than one that is held.
                have = {r.term for r in weights.collect() if found.get(r.term)} - sent
                assert 20 <= len(have) <= 40 and sent and min(found[t] for t in have) > max(found[t] for t in sent)
            else:
                assert bool(sent) == (held_bytes == 0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        weights.unpersist()


def test_terms_are_counted_by_stretches_of_rows(spark, monkeypatch):
    """One row for a term of a stretch, whatever the rows of it that hold the term; sums as by rows of terms."""
    rows = [(" ".join(f"w{(i * k) % 23}" for k in range(i % 12)), i % 5 - 1) for i in range(200)] + [(None, 3), ("w1 w1", None)]
    df = features.add_ngrams(spark.createDataFrame(rows, "body string, mark int").coalesce(1)).unionByName(
        spark.createDataFrame([(None, 7, None)], "body string, mark int, n_gram array<string>")
    )
    terms = df.select(F.explode("n_gram").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    once = df.select("mark", F.explode(F.array_distinct("n_gram")).alias("term")).groupBy("term")
    plain = {tuple(r) for r in once.agg(F.count(F.lit(1)), F.coalesce(F.sum("mark"), F.lit(0))).join(terms, "term").collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for most, most_bytes in ((1, 1 << 28), (60, 1 << 28), (1 << 22, 1), (1 << 22, 1 << 28)):
            monkeypatch.setattr(features, "COUNTED", most)
            monkeypatch.setattr(features, "COUNTED_BYTES", most_bytes)
            counted = features.counted_terms(df, "mark")
            sums = counted.groupBy("term").agg(F.sum("df"), F.sum("mark"), F.sum("total"))
            assert {tuple(r) for r in sums.collect()} == plain
            totals = {tuple(r) for r in features.term_totals(df).collect()}
            assert totals == {(term, df, total) for term, df, _, total in plain}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert counted.count() == len(plain) > 100
