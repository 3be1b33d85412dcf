"""Model scores from one aggregation pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.operators.order import prefix_sum


def _div0(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, MSE, RMSE and R2; R2 is NaN for a constant truth."""
    error = F.col(actual).cast("double") - F.col(predicted)
    spread = F.var_pop(F.when(F.col(predicted).isNotNull(), F.col(actual).cast("double")))
    s = df.agg(F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"), spread.alias("v"))
    return s.select("mae", "mse", F.sqrt("mse").alias("rmse"),
                    F.coalesce(1 - F.try_divide("mse", "v"), F.lit(float("nan"))).alias("r2"))


def _confusion(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    return df.agg(
        F.count_if((actual == 0) & (predicted == 0)).alias("tn"), F.count_if((actual == 0) & (predicted == 1)).alias("fp"),
        F.count_if((actual == 1) & (predicted == 0)).alias("fn"), F.count_if((actual == 1) & (predicted == 1)).alias("tp"))


def _rates() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": _div0(tp + tn, tp + tn + fp + fn), "precision": _div0(tp, tp + fp),
        "recall": _div0(tp, tp + fn), "f1": _div0(2 * tp, 2 * tp + fp + fn),
    }


def _score_counts(df: DataFrame, actual: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg"))


def roc_auc(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Area under the ROC curve by the rank-sum rule; ties count one half."""
    placed = prefix_sum(_score_counts(df, actual, score), ["score"], {"neg_below": "neg"})
    wins = F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)
    s = placed.agg(F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return s.select(F.try_divide("wins", F.col("p").cast("double") * F.col("n")).alias("roc_auc"))


def roc_data(df: DataFrame, actual: str, score: str) -> DataFrame:
    """(fpr, tpr) at every distinct score, from the highest down, starting at (0, 0)."""
    counts = _score_counts(df, actual, score)
    placed = prefix_sum(counts, [F.desc("score")], {"pos_above": "pos", "neg_above": "neg"})
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).first()["t"]
    p, n = float(totals["p"] or 0), float(totals["n"] or 0)
    points = placed.select(
        "score", F.try_divide(F.col("neg_above") + F.col("neg"), F.lit(n)).alias("fpr"),
        F.try_divide(F.col("pos_above") + F.col("pos"), F.lit(p)).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "score double, fpr double, tpr double")
    return start.unionByName(points)


def classification_metrics(df: DataFrame, actual: str, predicted: str, score: str | None = None) -> DataFrame:
    """Confusion cells, accuracy, precision, recall and F1 (0 when undefined), and ROC-AUC for a score."""
    cells = _confusion(df, F.col(actual), F.col(predicted))
    out = cells.select("tn", "fp", "fn", "tp", *[c.alias(n) for n, c in _rates().items()])
    if score is None:
        return out
    return out.withColumn("roc_auc", roc_auc(df, actual, score).scalar())


def threshold_table(df: DataFrame, actual: str, score: str, thresholds) -> DataFrame:
    """Precision, recall and F1 when predicting 1 at ``score >= threshold``.

    All thresholds are counted in the same pass as conditional counts.
    """
    thresholds = [float(t) for t in thresholds]
    y, s = F.col(actual), F.col(score)
    counts = []
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(t)
        counts += [F.count_if(hit & (y == 1)).alias(f"tp{i}"), F.count_if(hit & (y == 0)).alias(f"fp{i}"),
                   F.count_if(~hit & (y == 1)).alias(f"fn{i}")]
    rows = F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn"))
        for i, t in enumerate(thresholds)
    ])
    rates = {n: c for n, c in _rates().items() if n != "accuracy"}
    return df.agg(*counts).select(F.inline(rows)).select("threshold", *[c.alias(n) for n, c in rates.items()])


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.avg((F.col(a) == F.col(b)).cast("int")).alias("agreement"))
