"""The sentiment job: from raw comments to scored tables and rollup files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from talkweave.functions.states import STATES
from talkweave.operators import features, model, prepare, rollup
from talkweave.sources import tables

SCORED_COLUMNS = [
    "id", "link_id", "created_utc", "state", "com_score",
    "pos_rawPredict", "pos_predict", "pos_prob", "neg_rawPredict", "neg_predict", "neg_prob",
]


def train(spark: SparkSession, comments: DataFrame, labels: DataFrame, out: str) -> dict[str, float]:
    """Fit and store the vocabulary and both classifiers.

    The labelled comments are cleaned once and written; every fold reads them
    from there. Returns the area under the ROC curve on the unseen halves.
    """
    labeled = prepare.add_labels(prepare.label_comments(comments, labels))
    features.add_ngrams(labeled).write.mode("overwrite").parquet(f"{out}/labeled.parquet")
    labeled = spark.read.parquet(f"{out}/labeled.parquet")
    vocabulary = features.fit_vocabulary(labeled)
    features.save_vocabulary(vocabulary, f"{out}/vocabulary.model")
    labeled = features.vectorize(vocabulary, labeled)
    halves = {kind: prepare.split_by_hash(labeled, "Input_id", 50, kind) for kind in model.THRESHOLDS}
    fitted = model.fit_classifiers({kind: seen for kind, (seen, _) in halves.items()}, "Input_id")
    for kind, best in fitted.items():
        model.save_classifier(best, f"{out}/{kind}.model")
    return {kind: model.evaluate(best, halves[kind][1], kind) for kind, best in fitted.items()}


def score_corpus(spark: SparkSession, comments: DataFrame, submissions: DataFrame, out: str) -> DataFrame:
    """Score every kept comment with the stored models and write the table once.

    Cleaning and scoring happen in the tasks that read the comments, before the
    join, so texts are never shuffled; only keys and scores meet the posts.
    """
    vocabulary = features.load_vocabulary(f"{out}/vocabulary.model")
    fitted = [model.load_classifier(f"{out}/{kind}.model") for kind in model.THRESHOLDS]
    prepared = prepare.prepare_comments(comments)
    kept = prepare.drop_quotes(prepare.drop_sarcasm(prepared))
    vectors = features.vectorize(vocabulary, features.add_ngrams(kept))
    scored = model.score(vectors, *fitted).select(*SCORED_COLUMNS)
    joined = prepare.attach_submission(scored, prepare.prepare_submissions(submissions), prepared)
    joined.write.mode("overwrite").parquet(f"{out}/scored.parquet")
    return spark.read.parquet(f"{out}/scored.parquet")


ROLLUPS = ("top_pos_posts", "top_neg_posts", "days", "states", "sub_score", "com_score")


def write_rollups(scored: DataFrame, out: str, states: Iterable[str] = STATES) -> None:
    """Write all shares and top lists as CSV, from one reading of ``scored``; fails where a file is there already."""
    shares = rollup.all_shares(scored, states)
    results = (
        rollup.top_posts(shares["posts"], "pos"),
        rollup.top_posts(shares["posts"], "neg"),
        shares["days"],
        shares["states"],
        shares["sub_score"],
        shares["com_score"],
    )
    for name, result in zip(ROLLUPS, results):
        tables.write_csv(result, f"{out}/{name}.csv")


def run(
    spark: SparkSession, submissions: str, comments: str, labels: str, out: str,
    states: Iterable[str] = STATES,
) -> dict[str, float]:
    """The whole job, from the raw files to the CSV files in ``out``.

    Fails before any work if one of these files is there already.
    """
    there = [name for name in ROLLUPS if tables.exists(spark, f"{out}/{name}.csv")]
    if there:
        raise FileExistsError(f"{out} has {', '.join(there)} already")
    raw = tables.ingest_comments(spark, submissions, comments, labels, f"{out}/staged")
    areas = train(spark, raw["comments"], raw["labeled_data"], out)
    write_rollups(score_corpus(spark, raw["comments"], raw["submissions"], out), out, states)
    return areas
