"""Trees, forests, model comparison and saved bundles."""

from __future__ import annotations

import json
import time

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablework.functions.semantics import TASKS, require_choice
from tablework.ml import linear
from tablework.ml.baseline import baseline
from tablework.ml.metrics import classification_metrics, regression_metrics
from tablework.ml.split import train_test_split
from tablework.ml.tree import GrownTree, grow
from tablework.operators.clean import most_frequent
from tablework.operators.order import materialize

SEED = 42
MAX_DEPTH = 30
CLASSIFIERS = ("dummy", "logistic_regression", "logistic_regression_balanced", "decision_tree", "random_forest")
REGRESSORS = ("dummy", "linear_regression", "decision_tree", "random_forest")


class FittedModel:
    """A scoring function over a feature table plus, for tree models, the library model."""

    def __init__(self, name: str, task: str, features, score, library=None):
        self.name, self.task, self.features = name, task, list(features)
        self._score, self.library = score, library

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and, for classifiers, ``probability`` of class 1."""
        return self._score(df)

    def metrics(self, df: DataFrame, target: str) -> DataFrame:
        scored = self.predict(df)
        if self.task == "classification":
            return classification_metrics(scored, target, "prediction", "probability")
        return regression_metrics(scored, target, "prediction")


def _forest(task: str, depth: int | None, trees: int):
    depth = MAX_DEPTH if depth is None else depth
    common = dict(featuresCol="_features", maxDepth=depth, maxBins=256, seed=SEED, maxMemoryInMB=512)
    if task == "classification":
        return RandomForestClassifier(numTrees=trees, featureSubsetStrategy="sqrt", **common)
    return RandomForestRegressor(numTrees=trees, featureSubsetStrategy="all", **common)


def fit_model(df: DataFrame, features, target: str, task: str, name: str, depth: int | None = -1, trees: int = 200) -> FittedModel:
    """Fit one of the named models. ``depth`` -1 is the usual depth (tree 6, forest 10), None unlimited."""
    names = CLASSIFIERS if task == "classification" else REGRESSORS
    require_choice("task", task, TASKS)
    if name not in names:
        raise ValueError(f"unknown model {name!r} for {task}; choose one of {names}")
    features = list(features)
    if name == "dummy":
        if task == "classification":
            major = most_frequent(df, target)
            share = F.lit(1.0 if major == 1 else 0.0)
            return FittedModel(name, task, features, lambda d: d.withColumns({"prediction": F.lit(major), "probability": share}))
        mean = df.agg(F.avg(target)).first()[0]
        return FittedModel(name, task, features, lambda d: d.withColumn("prediction", F.lit(mean)))
    if name == "linear_regression":
        m = linear.fit_linear(df, features, target)
        return FittedModel(name, task, features, m.predict, m)
    if name.startswith("logistic"):
        fitted = linear.fit_logistic(df, features, target, balanced=name.endswith("balanced"))
        return FittedModel(name, task, features, lambda d: linear.score_classifier(fitted, d, features), fitted)
    if depth == -1:
        depth = 6 if name == "decision_tree" else 10
    linear.require_complete(df, [*features, target])
    if name == "decision_tree":
        grown = grow(df, features, target, task, depth)
        return FittedModel(name, task, features, lambda d: linear.only_complete(grown.predict(d), features), grown)
    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    fitted = _forest(task, depth, trees).setLabelCol(target).fit(assembler.transform(df))
    return FittedModel(name, task, features, lambda d: linear.only_complete(_tree_score(fitted, assembler.transform(d), task), features), fitted)


def _tree_score(fitted, rows: DataFrame, task: str) -> DataFrame:
    scored = fitted.transform(rows)
    if task == "classification":
        scored = scored.withColumns({"probability": vector_to_array("probability")[1], "prediction": F.col("prediction").cast("int")})
    return scored.drop("_features", "rawPrediction")


def fit_with_preprocessing(train: DataFrame, preprocessor, target: str, task: str, name: str, **options) -> FittedModel:
    """Learn the preprocessing and the model together; predictions take raw rows."""
    preprocessor.fit(train)
    # dots in level names would read as struct access in the assembler
    names = {n: f"f{i}" for i, n in enumerate(preprocessor.feature_names())}
    prepare = lambda d, keep: preprocessor.transform(d, keep).withColumnsRenamed(names)
    inner = fit_model(prepare(train, [target]), list(names.values()), target, task, name, **options)

    def score(df: DataFrame) -> DataFrame:
        keep = [c for c in df.columns if c not in names]
        return inner.predict(prepare(df, keep))

    return FittedModel(name, task, list(names), score, inner.library)


def feature_importance(model: FittedModel, spark: SparkSession, top: int | None = None) -> DataFrame:
    """Importances that sum to 1, largest first; an error for models without them."""
    if isinstance(model.library, GrownTree):
        values = model.library.importances()
    elif hasattr(model.library, "featureImportances"):
        values = model.library.featureImportances.toArray()
    else:
        raise ValueError(f"{model.name} has no feature importances")
    rows = [(c, float(v)) for c, v in zip(model.features, values)]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out


def tree_nodes(model: FittedModel, spark: SparkSession, path: str | None = None) -> DataFrame:
    """Nodes of a fitted tree: number, prediction, rows, impurity, gain, children, feature and threshold; written to ``path`` if given."""
    nodes = model.library.table(spark)
    if path is None:
        return nodes
    nodes.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def compare_depths(train: DataFrame, test: DataFrame, features, target: str, task: str, depths) -> DataFrame:
    """One row per tree depth (None: unlimited): score (accuracy or R2) on either part, and what is lost from train to test.

    One tree is grown to the largest depth; the scores at all depths are read off it in one pass over each part.
    """
    require_choice("task", task, TASKS)
    depths = list(depths)
    if not depths:
        raise ValueError("at least one depth is needed")
    linear.require_complete(train, [*features, target])
    grown = grow(train, features, target, task, None if None in depths else max(depths))
    sides = [grown.scores(part, target, depths) for part in (train, test)]
    rows = [(str(d), a, b, a - b) for d, a, b in zip(depths, *sides)]
    return train.sparkSession.createDataFrame(rows, "max_depth string, train_score double, test_score double, gap double")


def compare_models(train: DataFrame, test: DataFrame, features, target: str, task: str, names=None, **options) -> DataFrame:
    """One row of rounded test metrics per model, all on the same split."""
    keep = ["accuracy", "precision", "recall", "f1", "roc_auc"] if task == "classification" else ["mae", "rmse", "r2"]
    digits = {"mae": 3, "rmse": 3}
    rows, spark = [], train.sparkSession
    train, test = train.persist(), test.persist()
    try:
        for name in names or (CLASSIFIERS if task == "classification" else REGRESSORS):
            got = fit_model(train, features, target, task, name, **options).metrics(test, target).first()
            rows.append((name, *[round(float(got[c]), digits.get(c, 4)) for c in keep]))
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "model string, " + ", ".join(f"{c} double" for c in keep))


def model_table(scored: dict[str, DataFrame], target: str, task: str) -> DataFrame:
    """Comparison rows of already scored tables (``prediction``, and ``probability`` for classes)."""
    out = None
    for name, d in scored.items():
        got = (classification_metrics(d, target, "prediction", "probability") if task == "classification"
               else regression_metrics(d, target, "prediction"))
        row = got.withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def experiment_data(df: DataFrame, id_col: str, target: str, task: str, preprocessor, engineer=None, test_size=0.2) -> dict:
    """Split, engineer, and preprocess with parameters learned on the train part only."""
    require_choice("task", task, TASKS)
    train, test = train_test_split(df, id_col, test_size, SEED, target if task == "classification" else None)
    if engineer:
        train, test = engineer(train), engineer(test)
    preprocessor.fit(train)
    names = {n: f"f{i}" for i, n in enumerate(preprocessor.feature_names())}
    parts = [preprocessor.transform(d, [id_col, target]).withColumnsRenamed(names) for d in (train, test)]
    return {"task": task, "train": parts[0], "test": parts[1], "features": list(names.values()),
            "feature_names": list(names), "preprocessor": preprocessor}


def compare_with_baseline(dataset: str, df: DataFrame, id_col: str, target: str, task: str, candidates: dict, test_size: float = 0.2) -> DataFrame:
    """Test scores of candidate models ({model name: features}) on one split, each beside the score without features."""
    by_class = task == "classification"
    train, test = train_test_split(df, id_col, test_size, SEED, target if by_class else None)
    train, test = materialize(train, "train"), materialize(test, "test")
    plain = baseline(train, test, target, task)
    metric, of_model = ("test_accuracy", "accuracy") if by_class else ("test_r2", "r2")
    scores = plain.select(F.lit(0).alias("_nth"), F.lit("baseline").alias("model"), F.col(metric).cast("double").alias("score"))
    for nth, (name, features) in enumerate(candidates.items(), 1):
        got = fit_model(train, features, target, task, name).metrics(test, target)
        scores = scores.unionByName(got.select(F.lit(nth).alias("_nth"), F.lit(name).alias("model"), F.col(of_model).cast("double").alias("score")))
    parts = train.agg(F.count("*").alias("n_train")).crossJoin(test.agg(F.count("*").alias("n_test")))
    base = F.max(F.when(F.col("_nth") == 0, F.col("score"))).over(Window.partitionBy())  # a row per candidate
    facts = {"dataset": F.lit(dataset), "task": F.lit(task), "metric": F.lit(metric), "n_features": F.lit(len(df.columns) - 2).cast("long")}
    return scores.crossJoin(parts).withColumns(facts).withColumn("over_baseline", F.col("score") - base).orderBy("_nth").select(
        "dataset", "task", "n_features", "n_train", "n_test", "metric", "model", "score", "over_baseline")


def score_lines(runs: DataFrame) -> DataFrame:
    """A sentence per row of ``compare_with_baseline``, ready for ``write_report``."""
    return runs.select(F.format_string(
        "%s, %s on %d of %d rows: %s reaches %.4f, %+.4f against no features", "dataset", "metric", "n_test",
        F.col("n_train") + F.col("n_test"), "model", "score", "over_baseline").alias("line"))


def save_bundle(spark: SparkSession, model: FittedModel, metrics: dict, path: str) -> tuple[str, str]:
    """Write the model and ``metrics`` below one folder; returns both paths."""
    model_path, metrics_path = f"{path}/model", f"{path}/metrics"
    if isinstance(model.library, GrownTree):
        model.library.table(spark).coalesce(1).write.mode("overwrite").parquet(model_path)
    elif hasattr(model.library, "write"):
        model.library.write().overwrite().save(model_path)
    elif isinstance(model.library, linear.LinearModel):
        model.library.table(spark).coalesce(1).write.mode("overwrite").parquet(model_path)
    else:
        spark.createDataFrame([(model.name, model.task)], "model string, task string").coalesce(1).write.mode("overwrite").parquet(model_path)
    spark.createDataFrame([(json.dumps(metrics),)], "value string").coalesce(1).write.mode("overwrite").text(metrics_path)
    return model_path, metrics_path


def train_and_save(data: dict, target: str, name: str, path: str, **options) -> dict:
    """Fit on the train part, score the test part, save the bundle; returns the metrics."""
    spark = data["train"].sparkSession
    start = time.time()
    model = fit_model(data["train"], data["features"], target, data["task"], name, **options)
    seconds = time.time() - start
    metrics = model.metrics(data["test"], target).first().asDict()
    metrics |= {"task": data["task"], "model": name, "n_train": data["train"].count(), "n_test": data["test"].count(),
                "n_features": len(data["features"]), "train_seconds": round(seconds, 4)}
    save_bundle(spark, model, metrics, path)
    return metrics
