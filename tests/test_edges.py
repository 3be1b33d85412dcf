"""Values and layouts that the given tables never hold."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.ml import models
from tablework.operators import clean, matrix, quantiles, stats
from tablework.sources import readers, writers


def test_json_lines_and_arrays_keep_every_row(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    path = str(tmp_path / "lines.json")
    writers.write_json(rows, path)
    assert sorted(map(tuple, readers.load_table(spark, path, "id LONG, v LONG").collect())) == [(i, 2 * i) for i in range(1000)]
    for name, indent in (("flat.json", None), ("wide.json", 1)):
        (tmp_path / name).write_text(json.dumps([{"id": i, "v": 2 * i} for i in range(50)], indent=indent))
        assert readers.load_table(spark, str(tmp_path / name), "id LONG, v LONG").count() == 50


def test_models_refuse_gaps_and_score_every_row(spark):
    rows = spark.range(60).select("id", F.col("id").cast("double").alias("x"), (F.col("id") >= 30).cast("int").alias("y"))
    gaps = rows.withColumn("x", F.when(F.col("id") % 3 != 0, F.col("x")))
    for name in ("decision_tree", "logistic_regression"):
        fitted = models.fit_model(rows, ["x"], "y", "classification", name)
        got = {r["id"]: r["prediction"] for r in fitted.predict(gaps).collect()}
        assert len(got) == 60 and all((got[i] is None) == (i % 3 == 0) for i in got)
        with pytest.raises(ValueError, match="20 row"):
            models.fit_model(gaps, ["x"], "y", "classification", name)


@pytest.mark.parametrize("n", [3, 100, 300])
def test_inverse_of_large_matrices(spark, n):
    m = np.random.default_rng(n).normal(size=(n, n))
    cells = spark.createDataFrame([(1, i, j, float(m[i, j])) for i in range(n) for j in range(n)], "matrix_id long, i long, j long, v double")
    got = np.zeros((n, n))
    for r in matrix.det_inverse(cells).collect():
        got[r["i"], r["j"]] = r["v"]
    assert np.abs(got @ m - np.eye(n)).max() < 1e-8


def test_singular_matrix(spark):
    cells = spark.createDataFrame([(1, 0, 0, 1.0), (1, 0, 1, 2.0), (1, 1, 0, 2.0), (1, 1, 1, 4.0)], "matrix_id long, i long, j long, v double")
    assert [r["error"] for r in matrix.det_inverse(cells).collect()] == ["not invertible"]


def test_quantile_search_ends_on_infinities(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_FINISH_ROWS", 10)
    rows = spark.range(1000).select(F.when(F.col("id") == 999, float("inf")).when(F.col("id") == 0, float("-inf")).otherwise(F.col("id").cast("double")).alias("v"))
    assert quantiles.column_quantiles(rows, ["v"], [0.5, 0.25])["v"] == [499.5, 249.75]


def test_nan_is_missing_in_fills_and_profiles(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (2, float("nan"), float("nan")), (3, 3.0, None), (4, None, 9.0)], "id long, x double, y double")
    got = lambda d, c="x": [r[c] for r in d.orderBy("id").collect()]
    assert got(clean.fill_mean(df, "x")) == got(clean.fill_median(df, "x")) == [1, 2, 3, 2]
    assert got(clean.fill_mode(df, "x")) == [1, 1, 3, 1] and got(clean.fill_constant(df, "x", 5.0)) == [1, 5, 3, 5]
    assert got(clean.ffill(df, "x", ["id"])) == [1, 1, 3, 3] and got(clean.bfill(df, "x", ["id"])) == [1, 3, 3, None]
    both = clean.handle_missing(df, {"x": "mode", "y": "mode"})
    assert got(both) == [1, 1, 3, 1] and got(both, "y") == [7, 7, 7, 9]
    for row in (clean.describe(df, ["x"]).first(), stats.numeric_profile(df, ["x"]).first()):
        assert (row["mean"], row["max"]) == (2.0, 3.0)
    assert stats.central_tendency(df, ["x"]).first()["mean"] == 2.0
    assert stats.spread(df, ["x"]).first()["stddev_samp"] == pytest.approx(2 ** 0.5)


def test_entry_without_the_training_data_folders(tmp_path):
    """Only the pipeline's file is left of them: the entry module must still list the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "tests", "__pycache__", "*.json"))
    code = "import __spark_entry__ as e; names = set(e.queries()); assert len(names) > 200 and set(e.oracle_sql()) <= names; print(any(n.startswith('op1') for n in names))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0 and done.stdout.strip() == "False", done.stderr
