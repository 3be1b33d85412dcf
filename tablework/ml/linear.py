"""Linear and logistic models.

Least squares, gradient descent, ridge and lasso all start from the centred second moments
of the features and the target: a (d+1) x (d+1) summary of the whole table. Only that summary
reaches the driver, where d-sized systems are solved.
"""

from __future__ import annotations

from functools import reduce

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.semantics import require_number

_EXPRESSION_WIDTH = 12


@dataclass
class Moments:
    """n, means, and mean centred products of (features, target)."""

    features: list[str]
    n: int
    mean: np.ndarray
    cov: np.ndarray

    @property
    def xx(self):
        return self.cov[:-1, :-1]

    @property
    def xy(self):
        return self.cov[:-1, -1]


def _gaps(names) -> Column:
    """Number of rows that lack a value."""
    return F.count_if(reduce(lambda a, b: a | b, [F.col(c).cast("double").isNull() | F.isnan(F.col(c).cast("double")) for c in names]))


def _refuse(count: int, names) -> None:
    if count:
        raise ValueError(f"{count} row(s) lack a value in one of {list(names)}; fill or remove them before fitting")


def require_complete(df: DataFrame, names) -> None:
    """Models are not fitted on a part of the rows: missing values are the caller's to fill.

    A scan of its own; fits that begin with an aggregation count the gaps there.
    """
    _refuse(df.agg(_gaps(names)).first()[0], names)


def only_complete(scored: DataFrame, features) -> DataFrame:
    """Every row stays; one that lacks a feature has no prediction."""
    whole = reduce(lambda a, b: a & b, [F.col(c).cast("double").isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])
    return scored.withColumns({c: F.when(whole, F.col(c)) for c in ("prediction", "probability") if c in scored.columns})


def moments(df: DataFrame, features, target: str) -> Moments:
    """Second moments in one pass of built-in aggregates, or, for many columns, in two passes
    with one dense block per task."""
    names = [*features, target]
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)])
    d = len(names)
    means = [_gaps(rows.columns).alias("gaps"), *[F.avg(f"_{i}").alias(f"m{i}") for i in range(d)]]
    if d <= _EXPRESSION_WIDTH:
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        row = rows.agg(F.count("*").alias("n"), *means, *[F.covar_pop(f"_{i}", f"_{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
        _refuse(row["gaps"], names)
        cov = np.zeros((d, d))
        for i, j in pairs if row["n"] else ():
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    else:
        row = rows.agg(F.count("*").alias("n"), *means).first()
        _refuse(row["gaps"], names)
        center = np.array([row[f"m{i}"] or 0.0 for i in range(d)])
        i, j = np.indices((d, d))

        def fold(batches):
            total = np.zeros((d, d))
            for pdf in batches:
                x = pdf.to_numpy() - center
                total += x.T @ x
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

        sums = rows.mapInPandas(fold, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        cov = np.zeros((d, d))
        for r in sums:
            cov[r["i"], r["j"]] = r["v"] / row["n"]
    if not row["n"]:
        raise ValueError("a model needs at least one complete row")
    return Moments(list(features), row["n"], np.array([row[f"m{i}"] for i in range(d)]), cov)


@dataclass
class LinearModel:
    features: list[str]
    intercept: float
    weights: list[float]
    losses: list[float] = field(default_factory=list)

    def expression(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.weights):
            out = out + F.col(c).cast("double") * F.lit(float(w))
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.expression())

    def table(self, spark) -> DataFrame:
        rows = [("intercept", float(self.intercept)), *[(c, float(w)) for c, w in zip(self.features, self.weights)]]
        return spark.createDataFrame(rows, "feature string, weight double")

    def loss_table(self, spark) -> DataFrame:
        return spark.createDataFrame([(i, float(v)) for i, v in enumerate(self.losses)], "epoch long, loss double")


def _model(m: Moments, w: np.ndarray) -> LinearModel:
    return LinearModel(m.features, float(m.mean[-1] - w @ m.mean[:-1]), [float(v) for v in w])


def ols_normal_equation(df: DataFrame, features, target: str) -> LinearModel:
    """Least squares from the moments; dependent features share their weight (minimum norm)."""
    m = moments(df, features, target)
    scale = np.sqrt(np.where(np.diag(m.xx) > 0, np.diag(m.xx), 1.0))
    unit = m.xx / np.outer(scale, scale)
    if np.linalg.matrix_rank(unit, tol=1e-10) < len(unit):
        return _model(m, np.linalg.pinv(m.xx, rcond=1e-10, hermitian=True) @ m.xy)
    return _model(m, np.linalg.solve(unit, m.xy / scale) / scale)


def _check_descent(lr, epochs) -> None:
    require_number("learning rate", lr)
    require_number("epochs", epochs, whole=True)


def gd_linear(df: DataFrame, features, target: str, lr: float = 0.01, epochs: int = 1000) -> LinearModel:
    """Full-batch descent on the squared error, started at zero.

    Loss and gradient depend on the data only through the moments, so the whole descent costs
    one pass over the table.
    """
    _check_descent(lr, epochs)
    m = moments(df, features, target)
    center = np.r_[1.0, m.mean[:-1]]
    second = np.outer(center, center)
    second[1:, 1:] += m.xx
    cross = center * m.mean[-1]
    cross[1:] += m.xy
    square = m.cov[-1, -1] + m.mean[-1] ** 2
    loss = lambda w: float(w @ second @ w - 2 * w @ cross + square)
    w = np.zeros(len(center))
    losses = [loss(w)]
    for _ in range(epochs):
        w = w - lr * 2 * (second @ w - cross)
        losses.append(loss(w))
    return LinearModel(m.features, float(w[0]), [float(v) for v in w[1:]], losses)


def fit_ridge(df: DataFrame, features, target: str, alpha: float = 1.0) -> LinearModel:
    """Squared error plus ``alpha`` times squared weights; the intercept is free."""
    m = moments(df, features, target)
    return _model(m, np.linalg.solve(m.xx * m.n + alpha * np.eye(len(m.features)), m.xy * m.n))


def fit_lasso(df: DataFrame, features, target: str, alpha: float = 0.5, tol: float = 1e-10, rounds: int = 10_000) -> LinearModel:
    """Half mean squared error plus ``alpha`` times absolute weights, by coordinate descent on the moments."""
    m = moments(df, features, target)
    w = np.zeros(len(m.features))
    for _ in range(rounds):
        change = 0.0
        for j in range(len(w)):
            if m.xx[j, j] <= 0:
                continue
            pull = m.xy[j] - m.xx[j] @ w + m.xx[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / m.xx[j, j]
            change = max(change, abs(new - w[j]) * np.sqrt(m.xx[j, j]))
            w[j] = new
        if change < tol:
            break
    return _model(m, w)


def _assembled(df: DataFrame, features) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep").transform(df)


def fit_linear(df: DataFrame, features, target: str) -> LinearModel:
    """Ordinary least squares by the library solver."""
    require_complete(df, [*features, target])
    fitted = LinearRegression(featuresCol="_features", labelCol=target, regParam=0.0).fit(_assembled(df, features))
    return LinearModel(list(features), fitted.intercept, list(fitted.coefficients))


def coef_table(spark, models: dict[str, LinearModel]) -> DataFrame:
    """One row per feature and model, with the number of zero weights of that model."""
    rows = []
    for name, m in models.items():
        zero = sum(1 for w in m.weights if w == 0)
        rows += [(name, c, round(float(w), 3), zero) for c, w in zip(m.features, m.weights)]
    return spark.createDataFrame(rows, "model string, feature string, weight double, zeroed long")


def sigmoid(z: Column) -> Column:
    """Logistic function that never overflows: it only takes exp of non-positive numbers."""
    e = F.exp(-F.abs(z))
    return F.when(z >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def predict_logistic(df: DataFrame, model: LinearModel, threshold: float = 0.5) -> DataFrame:
    """Add ``probability`` and ``prediction`` (1 from the threshold on)."""
    scored = df.withColumn("probability", sigmoid(model.expression()))
    return scored.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))


def gd_logistic(df: DataFrame, features, target: str, lr: float = 0.1, epochs: int = 100) -> LinearModel:
    """Full-batch descent on the log-loss, started at zero.

    Each epoch is one pass over the cached feature rows; a task sends back one row with its
    loss and gradient. For long trainings ``fit_logistic`` needs far fewer passes.
    """
    _check_descent(lr, epochs)
    features = list(features)
    rows = df.select(*[F.col(c).cast("double") for c in features], F.col(target).cast("double").alias("_y"))
    rows = rows.persist()
    try:
        seen = rows.agg(F.count("*").alias("n"), F.count_if(~F.col("_y").isin(0.0, 1.0)).alias("bad"), _gaps(rows.columns).alias("gaps")).first()
        _refuse(seen["gaps"], [*features, target])
        if not seen["n"]:
            raise ValueError("a model needs at least one complete row")
        if seen["bad"]:
            raise ValueError("the target must hold only 0 and 1")
        n, d = seen["n"], len(features) + 1
        names = [f"g{i}" for i in range(d)]
        schema = "loss double, " + ", ".join(f"{g} double" for g in names)

        def look(w: np.ndarray) -> tuple[float, np.ndarray]:
            def part(batches):
                total = np.zeros(d + 1)
                for pdf in batches:
                    values = pdf.to_numpy()
                    x, y = np.c_[np.ones(len(values)), values[:, :-1]], values[:, -1]
                    z = x @ w
                    e = np.exp(-np.abs(z))
                    p = np.where(z >= 0, 1 / (1 + e), e / (1 + e))
                    safe = np.clip(p, 1e-12, 1 - 1e-12)
                    total[0] -= (y * np.log(safe) + (1 - y) * np.log(1 - safe)).sum()
                    total[1:] += x.T @ (p - y)
                yield pd.DataFrame([total], columns=["loss", *names])

            got = rows.mapInPandas(part, schema).agg(*[F.sum(c).alias(c) for c in ("loss", *names)]).first()
            return got["loss"] / n, np.array([got[g] for g in names]) / n

        w, losses = np.zeros(d), []
        for _ in range(epochs):
            loss, gradient = look(w)
            losses.append(loss)
            w = w - lr * gradient
        losses.append(look(w)[0])
    finally:
        rows.unpersist()
    return LinearModel(features, float(w[0]), [float(v) for v in w[1:]], losses)


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """n / (k * n_c) per class."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return counts.select(target, (total["n"] / (total["k"] * F.col("n"))).alias("class_weight"))


def fit_logistic(df: DataFrame, features, target: str, c: float = 1.0, balanced: bool = False, max_iter: int = 1000):
    """Logistic regression with an L2 penalty of strength 1/c, by the library solver.

    Returns the fitted library model; its input is the assembled column ``_features``.
    """
    seen = df.agg(F.count("*").alias("n"), _gaps([*features, target]).alias("gaps")).first()
    _refuse(seen["gaps"], [*features, target])
    rows, n = _assembled(df, features), seen["n"]
    est = LogisticRegression(featuresCol="_features", labelCol=target, regParam=1.0 / (c * n), elasticNetParam=0.0,
                             standardization=False, maxIter=max_iter, tol=1e-9)
    if balanced:
        weights = {r[target]: r["class_weight"] for r in class_weights(df, target).collect()}
        weight = F.lit(None).cast("double")
        for label, w in weights.items():
            weight = F.when(F.col(target) == F.lit(label), F.lit(w)).otherwise(weight)
        rows = rows.withColumn("_weight", weight)
        # weights sum to n, so the penalty keeps its strength
        est = est.setWeightCol("_weight")
    return est.fit(rows)


def as_linear_model(fitted, features) -> LinearModel:
    """Intercept and weights of a fitted library model as plain numbers."""
    return LinearModel(list(features), float(fitted.intercept), [float(v) for v in fitted.coefficients])


def score_classifier(fitted, df: DataFrame, features) -> DataFrame:
    """Add ``probability`` of class 1 and ``prediction`` of a fitted library classifier."""
    scored = fitted.transform(_assembled(df, features))
    return only_complete(scored.withColumns({
        "probability": vector_to_array("probability")[1], "prediction": F.col("prediction").cast("int"),
    }).drop("_features", "rawPrediction"), features)
