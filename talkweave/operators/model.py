"""Training, storing, evaluating and applying the two classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.functions.columns import hash_bucket, threshold_flag
from talkweave.session import stage

# A comment counts as positive or negative above these chances.
THRESHOLDS = {"pos": 0.2, "neg": 0.25}


def logistic_regression(kind: str) -> LogisticRegression:
    """The classifier for ``pos`` or ``neg``, with column names of its own.

    With distinct names the second model reads the output of the first.
    """
    return LogisticRegression(
        featuresCol="features",
        labelCol=f"{kind}_label",
        rawPredictionCol=f"{kind}_rawPredict",
        probabilityCol=f"{kind}_probability",
        predictionCol=f"{kind}_predict",
        maxIter=10,
        threshold=THRESHOLDS[kind],
    )


def area_under_roc(kind: str) -> BinaryClassificationEvaluator:
    """The area under the whole ROC curve: its points are not thinned out into bins."""
    return BinaryClassificationEvaluator(
        rawPredictionCol=f"{kind}_rawPredict", labelCol=f"{kind}_label", metricName="areaUnderROC", numBins=0
    )


def add_fold(train: DataFrame, kind: str, key: str, folds: int = 5) -> DataFrame:
    """Add ``fold``, from a hash of the key; it does not depend on order or layout."""
    return train.withColumn("fold", hash_bucket(F.col(key), folds, f"fold {kind}").cast("int"))


def fit_classifier(
    train: DataFrame,
    kind: str,
    key: str,
    reg_params: Sequence[float] = (1.0,),
    folds: int = 5,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validate over ``reg_params`` and refit the best on all of ``train``.

    The labelled rows are written once for the many passes over them, in one
    order: the sums of a fit then come out alike whatever the layout of the input.
    """
    estimator = logistic_regression(kind)
    grid = ParamGridBuilder().addGrid(estimator.regParam, list(reg_params)).build()
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=area_under_roc(kind),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    rows = add_fold(train, kind, key, folds).select(key, "fold", "features", f"{kind}_label")
    return validator.fit(stage(rows.repartitionByRange(key).sortWithinPartitions(key)))


def fit_classifiers(trains: dict[str, DataFrame], key: str, **settings) -> dict[str, CrossValidatorModel]:
    """Fit the classifiers of all kinds at the same time.

    Training is many short jobs over a small table; one classifier's jobs leave
    most cores idle.
    """

    def fit(kind: str) -> CrossValidatorModel:
        return fit_classifier(trains[kind], kind, key, **settings)

    session = next(iter(trains.values())).sparkSession
    with ThreadPool(len(trains)) as pool:
        return dict(zip(trains, pool.map(inheritable_thread_target(session)(fit), trains)))


def save_classifier(model: CrossValidatorModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_classifier(path: str) -> CrossValidatorModel:
    return CrossValidatorModel.load(path)


def weight_rows(spark: SparkSession, path: str) -> DataFrame:
    """The weights of a stored classifier as rows ``(position, weight)``; the intercept is at -1."""
    data = spark.read.parquet(f"{path}/bestModel/data")
    weights = data.select(F.posexplode(F.unwrap_udt("coefficientMatrix")["values"]).alias("position", "weight"))
    intercept = F.unwrap_udt("interceptVector")["values"][0]
    return weights.unionByName(data.select(F.lit(-1).alias("position"), intercept.alias("weight")))


def area_by_ranks(scored: DataFrame, kind: str) -> DataFrame:
    """The area under the ROC curve as one row, from the ranks of the chances, ties by halves.

    Chances are added up per value and put into ranges. Running sums are made in
    each range, and start from the sums of the ranges below it, so no task
    orders more than its range.
    """
    chance = vector_to_array(F.col(f"{kind}_rawPredict"))[1]
    values = scored.groupBy(chance.alias("chance")).agg(
        F.sum(f"{kind}_label").alias("p"), F.sum(1 - F.col(f"{kind}_label")).alias("n")
    )
    ranges = stage(values.repartitionByRange("chance").withColumn("part", F.spark_partition_id()))
    sums = ranges.groupBy("part").agg(F.sum("n").alias("n"))
    # One row for each partition.
    ordered = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(sums.select("part", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("start")))
    below = Window.partitionBy("part").orderBy("chance").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranges.join(starts, "part").withColumn("lower", F.col("start") + F.coalesce(F.sum("n").over(below), F.lit(0)))
    area = F.sum(F.col("p") * (F.col("lower") + F.col("n") / 2)) / (F.sum("p") * F.sum("n"))
    return counted.agg(area.alias("area"))


def fold_areas(train: DataFrame, kind: str, key: str, reg_param: float = 1.0, folds: int = 5) -> list[float]:
    """The area on each fold of a classifier fitted on the other folds, from the ranks of its chances.

    It repeats by other means what ``fit_classifier`` does for one value of the
    regularisation: the mean of these areas is its mean metric.
    """
    rows = stage(add_fold(train, kind, key, folds).select(key, "fold", "features", f"{kind}_label"))

    def area(fold: int) -> float:
        others = rows.filter(F.col("fold") != fold).repartitionByRange(key).sortWithinPartitions(key)
        fitted = logistic_regression(kind).setRegParam(reg_param).fit(others)
        return area_by_ranks(fitted.transform(rows.filter(F.col("fold") == fold)), kind).first()["area"]

    with ThreadPool(folds) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(area), range(folds))


def gradient(fitted: LogisticRegressionModel, train: DataFrame, kind: str, reg_param: float) -> DataFrame:
    """The gradient of the regularised loss, by term: ``position``, ``gradient`` at the weights, ``at_zero`` at none.

    Terms are on the scale of their standard deviations, on which the weights are
    regularised; the intercept, at -1, is not. One aggregate over the feature
    rows: no term's rows meet but as sums.
    """
    chance, label = vector_to_array(F.col(f"{kind}_probability"))[1], F.col(f"{kind}_label")
    errors = fitted.transform(train).select("features", (chance - label).alias("e"), (F.lit(0.5) - label).alias("z"))
    vector = F.unwrap_udt("features")
    pairs = F.arrays_zip(vector["indices"].alias("position"), vector["values"].alias("x"))
    # A sparse vector has indices; a dense one has a value at each place.
    dense = F.arrays_zip(F.sequence(F.lit(0), F.size(vector["values"]) - 1).alias("position"), vector["values"].alias("x"))
    rows = errors.select("e", "z", F.inline(F.when(vector["indices"].isNull(), dense).otherwise(pairs)))
    count = errors.count()
    sums = rows.groupBy("position").agg(
        F.sum(F.col("e") * F.col("x")).alias("e"), F.sum(F.col("z") * F.col("x")).alias("z"),
        F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("s2"),
    )
    deviation = F.sqrt(F.greatest((F.col("s2") - F.col("s") * F.col("s") / count) / (count - 1), F.lit(0.0)))
    spark = train.sparkSession
    weights = spark.createDataFrame(list(enumerate(fitted.coefficients.toArray().tolist())), "position int, weight double")
    terms = sums.withColumn("deviation", deviation).filter("deviation > 0").join(weights, "position").select(
        "position",
        (F.col("e") / count / F.col("deviation") + reg_param * F.col("weight") * F.col("deviation")).alias("gradient"),
        (F.col("z") / count / F.col("deviation")).alias("at_zero"),
    )
    intercept = errors.agg(F.lit(-1).alias("position"), F.avg("e").alias("gradient"), F.avg("z").alias("at_zero"))
    return terms.unionByName(intercept)


def evaluate(model: CrossValidatorModel, test: DataFrame, kind: str) -> float:
    """Area under the ROC curve on rows the model has not seen."""
    return area_under_roc(kind).evaluate(model.transform(test))


def score(df: DataFrame, pos_model: CrossValidatorModel, neg_model: CrossValidatorModel) -> DataFrame:
    """Apply both models to ``features``, inside each task.

    ``pos_prob`` and ``neg_prob`` hold the 0/1 flag of the threshold, not the
    chance itself.
    """
    both = neg_model.transform(pos_model.transform(df))
    flags = {
        f"{kind}_prob": threshold_flag(vector_to_array(F.col(f"{kind}_probability"))[1], limit)
        for kind, limit in THRESHOLDS.items()
    }
    return both.withColumns(flags)
