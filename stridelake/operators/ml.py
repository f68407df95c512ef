"""Fraud model on Spark ML: training set, training, batch scoring, run report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, FEATURES, PREDICTION_SUBJECT, Thresholds
from stridelake.functions import columns as X


def label_fraud(gold: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return gold.withColumn("label", X.flag(X.is_fraud(F.col("anomaly_score"), t)))


def label_distribution(gold: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return label_fraud(gold, t).groupBy("label").agg(F.count(F.lit(1)).alias("row_count"))


def features(gold: DataFrame) -> DataFrame:
    """The model's inputs, missing ones as 0."""
    return gold.fillna(0, subset=list(FEATURES))


def training_set(gold: DataFrame, train_fraction: float = 0.8, seed: int = 42, t: Thresholds = DEFAULTS) -> DataFrame:
    """Label first, then features, then the side of the split.

    The split hashes (user, date): the same rows train in every run, without a shuffle. Note that
    the label is a function of ``total_steps``, so any score on the test side says little.
    """
    date = X.date_label(F.col("year"), F.col("month"), F.col("day"))
    side = F.when(X.in_train_split(train_fraction, seed, F.col("user_id"), date), "train").otherwise("test")
    return features(label_fraud(gold, t)).select(
        "label", *FEATURES, "user_id", date.alias("date"), side.alias("split")
    )


def train(data: DataFrame, t: Thresholds = DEFAULTS, seed: int = 42) -> PipelineModel:
    """Boosted trees on the train side; positives weigh more."""
    rows = data.filter("split = 'train'").withColumn("weight", F.when(F.col("label") == 1, t.positive_weight).otherwise(1.0))
    boosted = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=t.boosting_rounds,
        maxDepth=t.tree_depth, stepSize=t.learning_rate, seed=seed,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), boosted]).fit(rows)


def auc(model: PipelineModel, data: DataFrame) -> float:
    """Area under ROC on the test side."""
    scored = model.transform(data.filter("split = 'test'"))
    return BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC").evaluate(scored)


def score(model: PipelineModel, gold: DataFrame) -> DataFrame:
    """Every gold row with its fraud probability and class."""
    scored = model.transform(features(gold))
    probability = vector_to_array("probability")[1]
    return predictions(scored.withColumn("raw_prediction", probability))


def predictions(scored: DataFrame, levels: bool = False, exact: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Prediction rows as stored: who, when, the inputs shown to readers, the class of the two-class model.

    With ``levels`` also the level of a four-level model's code. A missing prediction is stored as -1 and UNKNOWN.
    """
    raw = F.col("raw_prediction")
    level = [X.decode_prediction(raw, exact).alias("predicted_activity")] if levels else []
    return scored.select(
        F.col("user_id").cast("string").alias("user_id"),
        X.date_label(F.col("year"), F.col("month"), F.col("day")).alias("date"),
        "total_steps",
        "total_calories",
        X.decode_fraud(raw).alias("predicted_class"),
        *level,
        F.coalesce(raw.cast("double"), F.lit(-1.0)).alias("raw_prediction"),
        "anomaly_score",
        *carry,
    )


def prediction_report(rows: DataFrame, by: str = "predicted_class", t: Thresholds = DEFAULTS) -> DataFrame:
    """Rows and suspicious rows per predicted value, with a TOTAL line, in one aggregate."""
    return (
        rows.rollup(by)
        .agg(
            F.grouping(by).alias("_total"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(X.is_fraud(F.col("anomaly_score"), t)).alias("fraud_rows"),
        )
        .select(F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col(by)).alias(by), "row_count", "fraud_rows")
    )


def prediction_note(report: DataFrame, run_date: Column, by: str = "predicted_class") -> DataFrame:
    """Subject and body of the run report, from the few lines of ``prediction_report``."""
    total = F.col(by) == "TOTAL"
    line = F.when(~total, F.concat(F.lit("  "), by, F.lit(": "), F.col("row_count").cast("string")))
    summary = report.agg(
        F.max(F.when(total, F.col("row_count"))).alias("n"),
        F.max(F.when(total, F.col("fraud_rows"))).alias("fraud"),
        F.sort_array(F.collect_list(line)).alias("lines"),
    )
    body = F.concat(
        F.lit("Daily ML Prediction Report:\nDate: "), F.date_format(run_date, "yyyy-MM-dd"),
        F.lit("\n\nTotal users predicted: "), F.col("n").cast("string"),
        F.lit("\n\nActivity Summary:\n"), F.concat_ws("\n", "lines"),
        F.lit("\n\nFraud detected: "), F.col("fraud").cast("string"), F.lit(" users"),
    )
    return summary.select(F.lit(PREDICTION_SUBJECT).alias("subject"), body.alias("body"))
