"""Feature-blind baselines and the scaler-leakage check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.semantics import TASKS, require_choice
from tablework.ml.knn import knn_predict
from tablework.ml.metrics import classification_metrics, regression_metrics
from tablework.ml.split import infer_task, train_test_split
from tablework.operators.clean import most_frequent


def baseline_regression(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """Always predict the train mean; train and test scores in one row."""
    mean = train.agg(F.avg(target)).first()[0]
    score = lambda d: regression_metrics(d.withColumn("_p", F.lit(mean)), target, "_p")
    on_train = score(train).select("r2").scalar()
    return score(test).select(
        F.lit(mean).alias("baseline_prediction"), F.col("mae").alias("test_mae"), F.col("rmse").alias("test_rmse"),
        F.col("r2").alias("test_r2")).withColumn("train_r2", on_train)


def baseline_classification(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """Always predict the most frequent train class (the smallest one among equals)."""
    major = most_frequent(train, target)
    right = lambda d: d.agg(F.avg((F.col(target) == F.lit(major)).cast("int"))).scalar()
    scored = test.withColumn("_p", F.lit(major))
    return classification_metrics(scored, target, "_p").select(
        F.lit(major).alias("majority_class"), F.col("f1").alias("test_f1")
    ).withColumns({"train_accuracy": right(train), "test_accuracy": right(test)})


def baseline(train: DataFrame, test: DataFrame, target: str, task: str) -> DataFrame:
    require_choice("task", task, TASKS)
    if task == "regression":
        return baseline_regression(train, test, target)
    return baseline_classification(train, test, target)


def _moments(df: DataFrame, features) -> dict:
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in features]).first()
    return {c: (row[c]["m"], row[c]["s"] or 1.0) for c in features}


def _scaled(df: DataFrame, features, moments, id_col: str, target: str) -> DataFrame:
    vector = F.array(*[(F.col(c).cast("double") - F.lit(moments[c][0])) / F.lit(moments[c][1]) for c in features])
    return df.select(id_col, target, vector.alias("_vec"))


def scaler_mean_gap(df: DataFrame, train: DataFrame, features) -> float:
    """Largest gap between the means of all rows and of train rows, in train std units."""
    whole, part = _moments(df, features), _moments(train, features)
    return max(abs(whole[c][0] - part[c][0]) / part[c][1] for c in features)


def leakage_check(df: DataFrame, id_col: str, target: str, features, test_size: float = 0.2, seed: int = 42, k: int = 5) -> DataFrame:
    """Nearest-neighbour scores with scaling learned on all rows (leaky) and on train rows (clean)."""
    task = infer_task(df, target)
    train, test = train_test_split(df, id_col, test_size, seed, target if task == "classification" else None)
    scores = {}
    for name, source in (("leaky", df), ("clean", train)):
        m = _moments(source, features)
        a, b = (_scaled(d, features, m, id_col, target) for d in (train, test))
        predicted = knn_predict(a, b, id_col, "_vec", target, k, task)
        joined = b.select(id_col, target).join(predicted, id_col)
        if task == "classification":
            scores[name] = joined.agg(F.avg((F.col(target) == F.col("prediction")).cast("int"))).first()[0]
        else:
            scores[name] = regression_metrics(joined, target, "prediction").first()["r2"]
    row = (task, "accuracy" if task == "classification" else "r2", scores["leaky"], scores["clean"],
           scores["leaky"] - scores["clean"], scaler_mean_gap(df, train, features))
    return df.sparkSession.createDataFrame(
        [row], "task string, metric string, leaky_score double, clean_score double, score_difference double, scaler_mean_gap double")
