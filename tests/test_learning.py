import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.functions.semantics import hash_normal, hash_uniform
from tablework.ml import baseline, knn, linear, metrics, models, preprocess, split
from tests.conftest import rows


@pytest.fixture(scope="module")
def imbalanced(spark):
    return spark.range(1000).select("id", (F.col("id") < 100).cast("int").alias("y"), F.col("id").cast("double").alias("x"))


@pytest.fixture(scope="module")
def noisy_line(spark):
    return spark.range(300).select("id", (hash_uniform("id", 1) * 10).alias("x"), hash_normal("id", 2).alias("e")).select(
        "id", "x", (F.col("x") * 3 + 2 + F.col("e") * 0.1).alias("y"))


@pytest.fixture(scope="module")
def two_class(spark):
    base = spark.range(400).select("id", hash_normal("id", 3).alias("a"), hash_normal("id", 4).alias("b"), hash_uniform("id", 5).alias("u"))
    return base.select("id", "a", "b", (F.col("u") < 1 / (1 + F.exp(-(2 * F.col("a") - F.col("b"))))).cast("int").alias("y")).cache()


@pytest.mark.parametrize("size", [0, 1, -0.1, 1.5, "0.2", None, True])
def test_bad_test_sizes(imbalanced, size):
    with pytest.raises(ValueError):
        split.mark_test(imbalanced, "id", size)


def test_split_sizes_and_shares(imbalanced):
    train, test = split.train_test_split(imbalanced, "id", 0.2, stratify="y")
    assert (train.count(), test.count()) == (800, 200)
    assert test.agg(F.avg("y")).first()[0] == pytest.approx(0.1, abs=0.005)
    plain = split.mark_test(imbalanced.limit(7), "id", 0.2)
    assert plain.filter("is_test").count() == math.ceil(7 * 0.2)
    again = {r["id"] for r in split.train_test_split(imbalanced.repartition(9), "id", 0.2, stratify="y")[1].collect()}
    assert again == {r["id"] for r in test.collect()}
    with pytest.raises(ValueError):
        split.mark_test(imbalanced.limit(0), "id")


def test_class_quotas():
    assert split.class_quotas({"a": 5, "b": 5, "c": 5}, 0.3) == {"a": 2, "b": 2, "c": 1}


def test_infer_task(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("few"), "id", F.col("id").cast("double").alias("real"), F.col("id").cast("string").alias("text"))
    assert [split.infer_task(df, c) for c in ("few", "id", "real", "text")] == ["classification", "regression", "regression", "classification"]


def test_baselines(imbalanced, noisy_line):
    train, test = split.train_test_split(imbalanced, "id", 0.2, stratify="y")
    got = baseline.baseline(train, test, "y", "classification").first()
    assert (got["majority_class"], got["test_accuracy"], got["test_f1"]) == (0, 0.9, 0.0)
    got = baseline.baseline(*split.train_test_split(noisy_line, "id"), "y", "regression").first()
    assert got["train_r2"] == pytest.approx(0, abs=1e-9) and got["test_r2"] <= 1e-6
    with pytest.raises(ValueError):
        baseline.baseline(train, test, "y", "ranking")


def test_normal_equation(noisy_line):
    m = linear.ols_normal_equation(noisy_line, ["x"], "y")
    assert m.intercept == pytest.approx(2, abs=0.1) and m.weights[0] == pytest.approx(3, abs=0.1)
    frame = noisy_line.toPandas()
    want = np.linalg.lstsq(np.c_[np.ones(len(frame)), frame["x"]], frame["y"], rcond=None)[0]
    np.testing.assert_allclose([m.intercept, *m.weights], want, atol=1e-8)
    lib = linear.fit_linear(noisy_line, ["x"], "y")
    np.testing.assert_allclose([lib.intercept, *lib.weights], want, atol=1e-4)
    with pytest.raises(ValueError):
        linear.ols_normal_equation(noisy_line.limit(0), ["x"], "y")


def test_wide_moments_equal_narrow(spark):
    cols = [f"c{i}" for i in range(14)]
    df = spark.range(200).select(*[(hash_normal("id", i) * (i + 1) + 1000).alias(c) for i, c in enumerate(cols)]).repartition(6)
    m = linear.moments(df, cols[:-1], cols[-1])
    x = df.toPandas().to_numpy()
    np.testing.assert_allclose(m.cov, np.cov(x, rowvar=False, ddof=0), rtol=1e-8, atol=1e-8)


def test_collinear_columns_share_weight(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("b"), (F.col("id") * 2.0 + 1).alias("y"))
    m = linear.ols_normal_equation(df, ["a", "b"], "y")
    assert np.isfinite(m.weights).all() and sum(m.weights) == pytest.approx(2, abs=1e-6)


def test_gradient_descent(noisy_line):
    scaled = noisy_line.withColumn("x", F.col("x") / 10)
    m = linear.gd_linear(scaled, ["x"], "y", lr=0.3, epochs=2000)
    want = linear.ols_normal_equation(scaled, ["x"], "y")
    assert m.weights[0] == pytest.approx(want.weights[0], abs=0.05) and m.intercept == pytest.approx(want.intercept, abs=0.05)
    assert len(m.losses) == 2001 and m.losses[-1] < m.losses[0]
    for lr, epochs in ((0, 5), (-1, 5), (True, 5), (0.1, 0), (0.1, 2.5)):
        with pytest.raises(ValueError):
            linear.gd_linear(noisy_line, ["x"], "y", lr, epochs)


def test_ridge_and_lasso(spark):
    df = spark.range(120).select(*[hash_normal("id", i).alias(f"x{i}") for i in range(3)]).withColumn(
        "y", 4 * F.col("x0") - 0.5 * F.col("x1") + F.lit(7.0))
    names = ["x0", "x1", "x2"]
    x, y = df.select(names).toPandas().to_numpy(), df.toPandas()["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = linear.fit_ridge(df, names, "y", 1.0)
    np.testing.assert_allclose(ridge.weights, np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc), rtol=1e-8)
    lasso = linear.fit_lasso(df, names, "y", 0.5)
    assert lasso.weights[2] == 0 and abs(lasso.weights[0]) < 4
    residual = xc.T @ (yc - xc @ np.array(lasso.weights)) / len(y)
    for w, g in zip(lasso.weights, residual):
        assert abs(g) <= 0.5 + 1e-8 and (w == 0 or g == pytest.approx(0.5 * np.sign(w)))


def test_linear_prediction(spark):
    df = spark.createDataFrame([(1, 1), (2, 0)], "a long, b long")
    m = linear.LinearModel(["a", "b"], 1.0, [2.0, -1.0])
    assert sorted(r["prediction"] for r in m.predict(df).collect()) == [2.0, 5.0]


def test_sigmoid_is_stable(spark):
    df = spark.createDataFrame([(0.0,), (1000.0,), (-1000.0,)], "z double")
    assert [r[0] for r in df.select(linear.sigmoid(F.col("z"))).collect()] == [0.5, 1.0, 0.0]


def test_logistic(two_class):
    gd = linear.gd_logistic(two_class, ["a", "b"], "y", lr=0.5, epochs=25)
    assert gd.losses[0] == pytest.approx(math.log(2)) and all(a >= b for a, b in zip(gd.losses, gd.losses[1:]))
    fitted = linear.fit_logistic(two_class, ["a", "b"], "y")
    plain = linear.as_linear_model(fitted, ["a", "b"])
    mine = linear.predict_logistic(two_class, gd).select("id", F.col("prediction").alias("p"))
    theirs = linear.score_classifier(fitted, two_class, ["a", "b"]).select("id", F.col("prediction").alias("q"))
    assert metrics.agreement(mine.join(theirs, "id"), "p", "q").first()[0] >= 0.9
    # at the optimum the penalised gradient is zero
    scored = linear.predict_logistic(two_class, plain)
    g = scored.agg(*[F.sum((F.col("y") - F.col("probability")) * F.col(c)) for c in ("a", "b")]).first()
    np.testing.assert_allclose(g, plain.weights, atol=1e-3)
    with pytest.raises(ValueError):
        linear.gd_logistic(two_class.withColumn("y", F.col("y") + 1), ["a"], "y", epochs=1)


def test_classification_metrics(spark):
    df = spark.range(24).select((F.col("id") % 3 == 0).cast("int").alias("y"), ((F.col("id") * 7 % 24 + 4 * (F.col("id") % 3 == 0).cast("int")) / 32).alias("p"))
    recalls = [r["recall"] for r in metrics.threshold_table(df, "y", "p", [0.3, 0.5, 0.7]).orderBy("threshold").collect()]
    assert recalls == sorted(recalls, reverse=True)
    points = df.collect()
    pairs = [(a["p"] > b["p"]) + (a["p"] == b["p"]) / 2 for a in points for b in points if a["y"] > b["y"]]
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(sum(pairs) / len(pairs))
    roc = metrics.roc_data(df, "y", "p").orderBy("fpr", "tpr").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"], roc[-1]["fpr"], roc[-1]["tpr"]) == (0, 0, 1, 1)
    perfect = df.withColumns({"q": F.col("y"), "s": F.col("y").cast("double")})
    got = metrics.classification_metrics(perfect, "y", "q", "s").first()
    assert all(got[c] == 1 for c in ("accuracy", "precision", "recall", "f1", "roc_auc"))
    none = metrics.classification_metrics(df.withColumn("q", F.lit(0)), "y", "q").first()
    assert (none["precision"], none["recall"], none["f1"]) == (0, 0, 0)


def test_regression_metrics_of_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p").first()
    assert got["mae"] == 1 and got["rmse"] == 1 and math.isnan(got["r2"])


@pytest.fixture(scope="module")
def raw_churn(spark):
    return spark.createDataFrame(
        [(n, months, 20.5 + 11 * n, (20.5 + 11 * n) * months if months else None, contract, payment, n % 2)
         for n, (months, contract, payment) in enumerate([
             (3, "Month-to-month", "Check"), (30, "One year", "Mail"), (0, "Two year", None), (41, "One year", "Bank"),
             (66, "Two year", "Check"), (11, "Month-to-month", "Check")], 1)],
        "id long, tenure long, monthly double, total double, contract string, payment string, churn int")


def test_preprocessing(spark, raw_churn, tmp_path):
    engineered = preprocess.engineer_features(raw_churn, "tenure", "monthly", "total")
    assert [r["tenure_bucket"] for r in engineered.orderBy("id").collect()] == ["0-1yr", "2-4yr", "0-1yr", "2-4yr", "5yr+", "0-1yr"]
    prep = preprocess.Preprocessor(["tenure", "monthly", "total", "avg_monthly_spend"], ["payment"],
                                   {"contract": preprocess.CONTRACT_ORDER, "tenure_bucket": preprocess.TENURE_BUCKETS}).fit(engineered)
    out = prep.transform(engineered, ["id"])
    frame = out.toPandas()
    assert not frame.isna().any().any()
    np.testing.assert_allclose(frame[["tenure", "monthly", "total"]].mean(), 0, atol=1e-9)
    np.testing.assert_allclose(frame[["tenure", "monthly", "total"]].std(ddof=0), 1, atol=1e-9)
    assert set(prep.feature_names()) == set(out.columns) - {"id"}
    codes = frame.set_index("id")["contract"]
    assert codes[5] > codes[1]
    unseen = engineered.withColumns({"payment": F.lit("Crypto"), "contract": F.lit("Ten years")})
    row = prep.transform(unseen).first()
    assert row["contract"] == -1 and sum(row[c] for c in row.asDict() if c.startswith("payment_")) == 0
    prep.save(spark, str(tmp_path / "prep"))
    assert rows(preprocess.Preprocessor.load(spark, str(tmp_path / "prep")).transform(engineered, ["id"])) == rows(out)
    with pytest.raises(ValueError):
        preprocess.Preprocessor(["tenure"], scaler="robust")
    with pytest.raises(ValueError):
        preprocess.Preprocessor(["tenure"]).transform(raw_churn)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    for scaler in ("standard", "minmax"):
        assert [r["v"] for r in preprocess.scale_columns(df, df, ["v"], scaler).collect()] == [0, 0]


def test_fitted_preprocessing_runs_on_a_stream(spark, raw_churn, tmp_path):
    prep = preprocess.Preprocessor(["tenure", "monthly"], ["payment"]).fit(raw_churn)
    raw_churn.write.parquet(str(tmp_path / "in"))
    stream = prep.transform(spark.readStream.schema(raw_churn.schema).parquet(str(tmp_path / "in")), ["id"])
    run = stream.writeStream.format("memory").queryName("prepared").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    run.awaitTermination(60)
    assert rows(spark.table("prepared")) == rows(prep.transform(raw_churn, ["id"]))


def test_feature_scores(two_class):
    scores = {r["feature"]: r["score"] for r in preprocess.anova_f(two_class, ["a", "b"], "y").collect()}
    frame = two_class.toPandas()
    for c, got in scores.items():
        groups = [g[c].to_numpy() for _, g in frame.groupby("y")]
        between = sum(len(g) * (g.mean() - frame[c].mean()) ** 2 for g in groups)
        within = sum(((g - g.mean()) ** 2).sum() for g in groups)
        assert got == pytest.approx(between / (within / (len(frame) - 2)))
    assert preprocess.select_top_features(two_class, ["a", "b"], "y", 1, "classification").first()["feature"] == "a"
    for k in (0, -1, True, 1.5):
        with pytest.raises(ValueError):
            preprocess.select_top_features(two_class, ["a"], "y", k, "classification")


@pytest.mark.parametrize("block", [5_000, 7])
def test_knn_against_brute_force(spark, monkeypatch, block):
    """A dense cell (a third of the points within a hair of each other), copies included."""
    monkeypatch.setattr(knn, "_BLOCK", block)
    near = lambda seed: F.when(F.col("id") % 3 == 0, hash_normal("id", seed) * 1e-3).otherwise(hash_normal("id", seed) * 5)
    points = spark.range(330).select("id", F.array(near(1), near(2), near(3)).alias("v"), (F.col("id") % 4).alias("label"))
    points = points.unionByName(points.filter("id < 20").withColumn("id", F.col("id") + 1000)).cache()
    train, test = points.filter("id % 10 <> 3"), points.filter("id % 10 = 3")
    got = {}
    for r in knn.knn_join(train, test, "id", "v", 5).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"]))
    base = sorted((r["id"], np.array(r["v"])) for r in train.select("id", "v").collect())
    for r in test.collect():
        d = sorted((float(np.sqrt(((x - np.array(r["v"])) ** 2).sum())), i) for i, x in base)
        assert [n for _, n in sorted(got[r["id"]])] == [i for _, i in d[:5]]
    votes = knn.knn_predict(train, test, "id", "v", "label", 3)
    assert votes.count() == test.count()
    with pytest.raises(ValueError):
        knn.knn_join(train.limit(2), test, "id", "v", 5)


def test_leakage_check(two_class):
    got = baseline.leakage_check(two_class, "id", "y", ["a", "b"]).first()
    assert got["task"] == "classification" and 0.5 < got["clean_score"] <= 1 and got["scaler_mean_gap"] > 0
    assert got["score_difference"] == pytest.approx(got["leaky_score"] - got["clean_score"])


def test_trees(spark, two_class, tmp_path):
    tree = models.fit_model(two_class, ["a", "b"], "y", "classification", "decision_tree", depth=3)
    importance = models.feature_importance(tree, spark)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert models.feature_importance(tree, spark, top=1).first()["feature"] == "a"
    nodes = models.tree_nodes(tree, spark, str(tmp_path / "tree"))
    inner = nodes.filter("feature IS NOT NULL")
    assert nodes.count() == 2 * inner.count() + 1 and inner.filter("threshold IS NULL").count() == 0
    with pytest.raises(ValueError):
        models.feature_importance(models.fit_model(two_class, ["a"], "y", "classification", "dummy"), spark)
    with pytest.raises(ValueError):
        models.fit_model(two_class, ["a"], "y", "classification", "linear_regression")
    train, test = split.train_test_split(two_class, "id", stratify="y")
    table = models.compare_depths(train, test, ["a", "b"], "y", "classification", [1, 4, None]).collect()
    scores = [r["train_score"] for r in table]
    assert [r["max_depth"] for r in table] == ["1", "4", "None"] and scores == sorted(scores)
    for bad in (([], "classification"), ([1], "ranking")):
        with pytest.raises(ValueError):
            models.compare_depths(train, test, ["a"], "y", bad[1], bad[0])


def test_comparison_and_bundle(spark, two_class, tmp_path):
    train, test = split.train_test_split(two_class, "id", stratify="y")
    table = models.compare_models(train, test, ["a", "b"], "y", "classification", trees=5)
    got = {r["model"]: r for r in table.collect()}
    assert set(got) == set(models.CLASSIFIERS) and got["dummy"]["roc_auc"] == 0.5
    assert got["logistic_regression"]["roc_auc"] > 0.7
    lines = models.compare_models(train, test, ["a"], "b", "regression", ["dummy", "linear_regression", "random_forest"], trees=5)
    assert lines.columns == ["model", "mae", "rmse", "r2"] and lines.count() == 3
    data = models.experiment_data(two_class, "id", "y", "classification", preprocess.Preprocessor(["a", "b"]))
    out = models.train_and_save(data, "y", "decision_tree", str(tmp_path / "bundle"))
    stored = json.loads(spark.read.text(str(tmp_path / "bundle/metrics")).first()[0])
    assert stored == out and stored["n_train"] == 320 and 0 <= stored["f1"] <= 1


def test_scores_beside_the_baseline(spark, two_class):
    runs = models.compare_with_baseline("demo", two_class, "id", "y", "classification", {"logistic_regression": ["a", "b"]})
    plain, fitted = runs.collect()
    assert (plain["model"], plain["over_baseline"], plain["n_train"], plain["n_test"]) == ("baseline", 0.0, 320, 80)
    assert fitted["over_baseline"] == pytest.approx(fitted["score"] - plain["score"]) and fitted["score"] > plain["score"]
    lines = [r["line"] for r in models.score_lines(runs).collect()]
    assert len(lines) == 2 and "80 of 400 rows" in lines[1] and "logistic_regression" in lines[1]
    with pytest.raises(ValueError):
        models.compare_with_baseline("demo", two_class, "id", "y", "ranking", {})


def test_train_command(spark, two_class, tmp_path):
    from jobs import train

    source = str(tmp_path / "in.parquet")
    two_class.write.parquet(source)
    args = ["--task", "classification", "--input", source, "--output-dir", str(tmp_path / "out"), "--id", "id", "--target", "y", "--numeric", "a,b"]
    assert train.main([*args, "--model", "no_such_model"]) == 2
    assert train.main([*args, "--model", "random_forest", "--trees", "3"]) == 0
    assert json.loads(spark.read.text(str(tmp_path / "out/metrics")).first()[0])["model"] == "random_forest"


def test_train_command_features_and_targets(spark, two_class, tmp_path):
    from jobs import train

    source = str(tmp_path / "in.parquet")
    two_class.withColumns({
        "answer": F.when(F.col("y") == 1, " Yes").otherwise("no"), "word": F.when(F.col("y") == 1, "true").otherwise("false"),
        "months": F.col("id") % 70, "paid": (F.col("id") % 70) * 20.0, "size": F.when(F.col("a") > 0, "big").otherwise("small"),
    }).write.parquet(source)
    args = ["--task", "classification", "--model", "decision_tree", "--input", source, "--output-dir", str(tmp_path / "out"), "--id", "id", "--numeric", "a,b"]
    stay = ["--tenure", "months", "--monthly", "b"]
    assert train.main([*args, "--target", "answer", *stay]) == 2
    assert train.main([*args, "--target", "answer", *stay, "--total", "paid", "--ordinal", "size=small,big"]) == 0
    assert json.loads(spark.read.text(str(tmp_path / "out/metrics")).first()[0])["n_features"] == 2 + 3 + 2
    with pytest.raises(ValueError, match="yes and no"):
        train.main([*args, "--target", "word"])
