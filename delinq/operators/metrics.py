"""Classification metrics and model selection as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delinq.functions.numeric import exact_avg, np_round
from delinq.operators.ranking import cumulative_counts


def _score_table(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: positives and negatives, and both counts at higher scores.

    Counting runs over the negated score, so ``*_below`` there is "above" here; both metrics
    then need no total beforehand.
    """
    rows = scored.select((-F.col(score).cast("double")).alias("down"), F.col(label).alias("label")).dropna()
    counts = {"pos": F.count_if(F.col("label") == 1), "neg": F.count_if(F.col("label") == 0)}
    table = cumulative_counts(rows, "down", counts)
    return table.withColumnsRenamed({"pos_below": "pos_above", "neg_below": "neg_above"})


def _auc() -> Column:
    """Share of pairs in the right order, ties one half; NULL when one class is absent."""
    c = F.col
    wide = lambda x: x.cast("decimal(19,0)")  # products of row counts outgrow 64 bits
    twice = F.sum(wide(c("neg")) * wide(c("pos_above") * 2 + c("pos")))
    pairs = wide(F.sum("pos")) * wide(F.sum("neg"))
    return F.try_divide(twice.cast("double"), pairs.cast("double") * 2)


def _average_precision() -> Column:
    """Sum of recall steps times the precision at each distinct threshold; NULL without positives."""
    c = F.col
    hits = c("pos_above") + c("pos")
    reached = hits + c("neg_above") + c("neg")
    return F.try_divide(F.sum(c("pos") * F.try_divide(hits, reached)), F.sum("pos"))


def roc_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    return _score_table(scored, score, label).agg(_auc().alias("roc_auc"))


def average_precision(scored: DataFrame, score: str, label: str) -> DataFrame:
    return _score_table(scored, score, label).agg(_average_precision().alias("average_precision"))


def ranking_metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """AUC and average precision from one score table."""
    return _score_table(scored, score, label).agg(
        _auc().alias("test_auc"), _average_precision().alias("test_avg_precision")
    )


def class_metrics(scored: DataFrame, prediction: str, label: str) -> DataFrame:
    """Precision, recall and F1 of class 1 and accuracy; 0 where a ratio is undefined."""
    called, true = F.col(prediction) == 1, F.col(label) == 1
    counts = scored.agg(
        F.count_if(called & true).alias("tp"),
        F.count_if(called & ~true).alias("fp"),
        F.count_if(~called & true).alias("fn"),
        F.count_if(~called & ~true).alias("tn"),
    )
    c = F.col
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        div(c("tp"), c("tp") + c("fp")).alias("test_precision"),
        div(c("tp"), c("tp") + c("fn")).alias("test_recall"),
        div(c("tp") * 2, c("tp") * 2 + c("fp") + c("fn")).alias("test_f1"),
        div(c("tp") + c("tn"), c("tp") + c("fp") + c("fn") + c("tn")).alias("test_accuracy"),
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models by F1, a perfect accuracy costs 10 %; equal scores keep the training order.

    ``metrics`` has columns model, position, test_f1, test_accuracy. Models without a positive
    score cannot win and are left out, so the result may be empty.
    """
    f1 = F.col("test_f1")
    adjusted = F.when(F.col("test_accuracy") >= 1.0, f1 * 0.9).otherwise(f1)
    return (
        metrics.withColumn("adjusted_score", adjusted)
        .filter(F.col("adjusted_score") > 0)
        .orderBy(F.desc("adjusted_score"), "position")
    )


def select_best(metrics: DataFrame) -> DataFrame:
    return rank_models(metrics).limit(1)


def prediction_stats(predictions: DataFrame) -> DataFrame:
    """Per risk category: predictions, mean score, mean latency if it was recorded."""
    aggs = [
        F.count(F.lit(1)).alias("predictions"),
        np_round(exact_avg(F.col("risk_score")), 4).alias("mean_risk_score"),
    ]
    if "response_time_ms" in predictions.columns:
        aggs.append(F.avg("response_time_ms").alias("mean_response_time_ms"))
    return predictions.groupBy("risk_category").agg(*aggs)
