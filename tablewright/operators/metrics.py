"""Evaluation tables of a binary classifier, positive class 1."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.columns import q
from tablewright.operators.ordered import running_totals

METRICS = ("accuracy", "precision", "recall", "f1_score")


def _ratio(a: Column, b: Column) -> Column:
    """a / b as double, 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def metric_columns(label: str = "label", prediction: str = "prediction") -> list[Column]:
    y, p = q(label), q(prediction)
    tp = F.count_if((y == 1) & (p == 1))
    predicted, actual = F.count_if(p == 1), F.count_if(y == 1)
    return [_ratio(F.count_if(y == p), F.count(F.lit(1))).alias("accuracy"),
            _ratio(tp, predicted).alias("precision"),
            _ratio(tp, actual).alias("recall"),
            _ratio(2 * tp, predicted + actual).alias("f1_score")]


def binary_metrics(scored: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """One row of accuracy, precision, recall and F1."""
    return scored.agg(*metric_columns(label, prediction))


def fold_metrics(scored: DataFrame, fold="fold", label="label", prediction="prediction") -> DataFrame:
    return scored.groupBy(fold).agg(*metric_columns(label, prediction))


def mean_metrics(scored: DataFrame, fold="fold", label="label", prediction="prediction") -> DataFrame:
    """One row: the mean of the metrics of the folds (0 without folds) and the number of folds."""
    per_fold = fold_metrics(scored, fold, label, prediction)
    means = [F.coalesce(F.avg(m), F.lit(0.0)).alias(f"mean_{m}") for m in METRICS]
    return per_fold.agg(*means, F.count(F.lit(1)).alias("n_folds"))


def confusion_matrix(scored: DataFrame, label="label", prediction="prediction", classes: Sequence[int] = (0, 1)) -> DataFrame:
    """(label, prediction, n) for every pair of classes, zero counts included; folds are pooled."""
    cells = [(a, b) for a in classes for b in classes]
    one = scored.agg(*[F.count_if((q(label) == a) & (q(prediction) == b)).alias(f"n_{a}_{b}") for a, b in cells])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"n_{a}_{b}").alias("n"))
        for a, b in cells])))


def score_column(scored: DataFrame) -> Column:
    """Probability of class 1, else the decision value, else the prediction."""
    if "probability" in scored.columns:
        return vector_to_array("probability")[1]
    if "rawPrediction" in scored.columns:
        return vector_to_array("rawPrediction")[1]
    return F.col("prediction").cast("double")


def _score_totals(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg, tp, fp): one row per distinct score with running totals from the top.

    Copies of a score are combined before any shuffle, and the totals run over range partitions, so
    neither many rows nor many distinct scores meet in one task.
    """
    counts = scored.groupBy(q(score).cast("double").alias("score")).agg(
        F.count_if(q(label) == 1).alias("pos"), F.count_if(q(label) != 1).alias("neg"))
    totals = running_totals(counts, "score", ["pos", "neg"], descending=True)
    return totals.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})


def roc_points(scored: DataFrame, label="label", score="score") -> DataFrame:
    """(threshold, fpr, tpr), pooled over folds; the start (0, 0) has an infinite threshold."""
    totals = _score_totals(scored, label, score)
    whole = totals.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    p, n = whole["p"] or 0, whole["n"] or 0
    nothing = F.lit(None).cast("double")
    points = totals.select(F.col("score").alias("threshold"),
                           (F.col("fp") / n if n else nothing).alias("fpr"),
                           (F.col("tp") / p if p else nothing).alias("tpr"))
    start = scored.sparkSession.createDataFrame(
        [(float("inf"), 0.0 if n else None, 0.0 if p else None)], points.schema)
    return points.unionByName(start)


def auc(scored: DataFrame, label="label", score="score") -> DataFrame:
    """One row (auc): the area under the ROC curve by the trapezoid rule; NULL if a class is absent."""
    totals = _score_totals(scored, label, score)
    # The trapezoid of one score: neg wide, between the true positives before and after it.
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return totals.agg(F.when(pairs > 0, area / pairs).alias("auc"))


def leaderboard(tables: Mapping[str, DataFrame], sort_by: str = "mean_f1_score") -> DataFrame:
    """Model x metrics, best first. Sorts by the first metric if ``sort_by`` is absent."""
    if not tables:
        raise ValueError("no results to rank")
    named = [t.select(F.lit(name).alias("model"), "*") for name, t in tables.items()]
    board = named[0]
    for t in named[1:]:
        board = board.unionByName(t)
    key = sort_by if sort_by in board.columns else board.columns[1]
    return board.orderBy(F.col(key).desc(), "model")


def champion(board: DataFrame, sort_by: str = "mean_f1_score") -> DataFrame:
    """One row (model, score): the top of the leaderboard."""
    key = sort_by if sort_by in board.columns else board.columns[1]
    return board.select("model", F.col(key).alias("score")).orderBy(F.col("score").desc(), "model").limit(1)
