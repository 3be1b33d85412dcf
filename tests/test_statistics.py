import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.operators import charts, stats
from tablework.plans import reports
from tests.conftest import rows


@pytest.fixture(scope="module")
def ten(spark):
    return spark.createDataFrame([(float(v),) for v in (4, 9, 4, 31, 16, 27, 4, 50, 13, 83)], "v double")


def test_descriptive(ten):
    v = np.array([r["v"] for r in ten.collect()])
    got = stats.central_tendency(ten, ["v"]).first()
    assert (got["mode"], got["median"]) == (4.0, np.median(v)) and got["mean"] == pytest.approx(v.mean())
    s = stats.spread(ten, ["v"]).first()
    assert s["var_pop"] == pytest.approx(v.var()) and s["stddev_samp"] == pytest.approx(v.std(ddof=1))
    assert s["value_range"] == 79 and s["iqr"] == pytest.approx(np.subtract(*np.percentile(v, [75, 25])))
    got = dict(rows(stats.percentile_linear(ten, "v", [10, 37.5])))
    assert got == pytest.approx({10.0: np.percentile(v, 10), 37.5: np.percentile(v, 37.5)})


def test_descriptive_errors(ten):
    with pytest.raises(ValueError):
        stats.central_tendency(ten.limit(0), ["v"])
    with pytest.raises(ValueError):
        stats.spread(ten.limit(1), ["v"])
    with pytest.raises(ValueError):
        stats.percentile_linear(ten, "v", [101])
    with pytest.raises(ValueError):
        stats.percentile_linear(ten.limit(0), "v", [50])


def test_probability(spark):
    df = spark.createDataFrame(
        [(True, True), (True, True), (False, True), (True, False), (True, False), (False, False), (False, False), (None, False)],
        "high boolean, electronics boolean")
    assert stats.simple_probability(df, F.col("high")).first()[0] == 0.5
    assert stats.conditional_probability(df, F.col("high"), F.col("electronics")).first()[0] == pytest.approx(2 / 3)
    with pytest.raises(Exception, match="never holds"):
        stats.conditional_probability(df, F.col("high"), F.lit(False)).collect()


def test_bayes():
    assert stats.bayes_two_class(0.01, 0.99, 0.05) == pytest.approx(0.1666667, abs=1e-6)
    assert stats.bayes(0.2, 0.8, 0.2) == pytest.approx(0.8)
    for bad in ((1.2, 0.5, 0.5), (0.5, -0.1, 0.5), (0.5, 0.5, 0.0)):
        with pytest.raises(ValueError):
            stats.bayes(*bad)


def test_pearson(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, -float(i), 5.0) for i in range(1, 6)], "x double, up double, down double, flat double")
    assert stats.pearson(df, "x", "up").first()[0] == pytest.approx(1)
    assert stats.pearson(df, "x", "down").first()[0] == pytest.approx(-1)
    for frame, y in ((df, "flat"), (df.limit(1), "up")):
        with pytest.raises(Exception, match="constant|fewer"):
            stats.pearson(frame, "x", y).collect()


def test_correlation_matrix(spark):
    df = spark.createDataFrame([(i, float(i), 3.0 * i + 7, -2.0 * i + 1) for i in range(1, 6)], "row_id long, a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): round(r["r"], 9) for r in stats.corr_matrix(df).collect()}
    assert got == {(x, y): (-1.0 if (x == "c") != (y == "c") else 1.0) for x in "abc" for y in "abc"}


def test_spearman_with_gaps_and_ties(spark):
    x = [1.0, 2.0, 2.0, 4.0, None, 6.0, 7.0, 2.0]
    y = [3.0, 1.0, 4.0, 4.0, 9.0, None, 8.0, 0.0]
    z = [1.0, 1.0, 2.0, 3.0, 5.0, 8.0, 13.0, 2.0]
    w = [9.0, 7.0, 7.0, 6.0, 5.0, 2.0, 1.0, 7.0]
    df = spark.createDataFrame(list(zip(x, y, z, w)), "x double, y double, z double, w double")
    frame = df.toPandas()
    got = stats.rank_correlations(df, ["x", "y", "z", "w"])
    for (a, b), (rho, n) in got.items():
        pair = frame[[a, b]].dropna().rank()
        assert rho == pytest.approx(pair[a].corr(pair[b])) and n == len(pair)


@pytest.mark.parametrize("r,n,p", [(0.5, 12, 0.0978), (-0.8, 10, 0.00545), (0.0, 9, 1.0), (1.0, 8, 0.0)])
def test_correlation_pvalue(r, n, p):
    assert stats.correlation_pvalue(r, n) == pytest.approx(p, abs=2e-4)


def test_corr_report_and_extremes(spark):
    df = spark.range(60).select(
        F.col("id").alias("a_id"), F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") * 17 % 23).cast("double").alias("c"))
    report = stats.corr_report(df)
    got = [(r["column_a"], r["column_b"]) for r in report.collect()]
    assert got[0] == ("a", "b") and len(got) == 3
    ends = stats.corr_extremes(report, "pearson", 1)
    assert {r["kind"]: r["column_a"] + r["column_b"] for r in ends.collect()}["strongest"] == "ab"


def test_outliers(spark):
    values = [200 + i % 7 for i in range(30)] + [900.0]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    flagged = stats.zscore_outliers(df, "v")
    assert sorted((r["threshold"], r["v"]) for r in flagged.collect()) == [(2.0, 900.0), (3.0, 900.0)]
    assert stats.zscore_counts(df, ["v"], 2.0).first()["n_outliers"] == 1
    with pytest.raises(ValueError):
        stats.zscores(df.limit(0).union(spark.createDataFrame([(1.0,), (1.0,)], "v double")), "v")
    iqr = spark.createDataFrame([(v,) for v in (21, 24, 22, 26, 24, 23, 21, 25, 140, -75)], "v long")
    assert sorted(r["v"] for r in stats.iqr_outliers(iqr, "v").collect()) == [-75, 140]
    with pytest.raises(ValueError):
        stats.iqr_outliers(iqr, "absent")


def test_zscore_normalize(spark):
    df = spark.createDataFrame([(3.0, 41.0, 9.0), (5.0, 44.0, 1.0), (8.0, 40.0, 4.0), (6.0, 52.0, 2.0)], "a double, b double, c double")
    out = stats.zscore_normalize(df, ["a", "b", "c"]).toPandas()
    np.testing.assert_allclose(out.mean(), 0, atol=1e-8)
    np.testing.assert_allclose(out.std(ddof=0), 1, atol=1e-8)
    with pytest.raises(ValueError):
        stats.zscore_normalize(spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "a double, b double"), ["a"])


def test_shapiro_known_sample(spark):
    """Weights of eleven men, the textbook example of the test: W 0.79, p 0.0067."""
    df = spark.createDataFrame([(float(v),) for v in (148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236)], "v double").repartition(4)
    got = stats.normality_test(df, "v").first()
    assert got["statistic"] == pytest.approx(0.78881, abs=2e-4) and got["p_value"] == pytest.approx(0.0067, abs=2e-4)
    assert got["method"] == "shapiro-wilk" and not got["is_normal"]


def test_normality_of_generated_columns(spark):
    from tablework.functions.semantics import hash_normal, hash_uniform

    df = spark.range(6000).select("id", hash_normal("id", 1).alias("normal"), hash_uniform("id", 1).alias("flat"))
    for frame in (df.filter("id < 800"), df):
        assert stats.normality_test(frame, "normal").first()["is_normal"]
        assert not stats.normality_test(frame, "flat").first()["is_normal"]
    for few in (df.limit(2), df.select(F.lit(1.0).alias("normal"))):
        with pytest.raises(ValueError):
            stats.normality_test(few, "normal")


def test_normality_method_does_not_follow_the_row_count(spark):
    """W against a direct evaluation, with ties that span several runs of ranks; the same test at any size."""
    from statistics import NormalDist

    for n, copies in ((5, 1), (9, 1), (4_990, 1), (36_000, 12_000)):
        v = np.sort(np.array([(i // copies) ** 1.5 for i in range(n)]))
        m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
        last, second, divisor = stats._shapiro_ends(n, float(m @ m))
        a = m / divisor
        a[0], a[-1] = -last, last
        if second:
            a[1], a[-2] = -second, second
        got = stats.normality_test(spark.createDataFrame([(float(x),) for x in v], "v double"), "v").first()
        assert got["method"] == "shapiro-wilk"
        assert got["statistic"] == pytest.approx((a @ v) ** 2 / ((v - v.mean()) ** 2).sum(), rel=1e-9)
    small = spark.range(50).select(F.sqrt("id").alias("v"))
    assert stats.normality_test(small, "v", method="jarque-bera").first()["method"] == "jarque-bera"
    with pytest.raises(ValueError):
        stats.normality_test(small, "v", method="other")


def test_correlation_pvalue_of_many_rows():
    """Both routes agree where they meet, and the tail stays right far beyond."""
    def tail(t):
        return math.erfc(t / math.sqrt(2))

    for t in (0.5, 1.3, 4.0):
        below, above = (stats.correlation_pvalue(t / math.sqrt(n - 2 + t * t), n) for n in (1_000_002, 1_000_003))
        assert below == pytest.approx(above, rel=1e-6)
        assert stats.correlation_pvalue(t / math.sqrt(1e12 - 2 + t * t), 10**12) == pytest.approx(tail(t), rel=1e-4)


def test_cross_check(spark):
    a = spark.createDataFrame([("m", 1.0), ("s", 2.0)], "metric string, value double")
    b = spark.createDataFrame([("m", 1.0000001), ("s", 2.5)], "metric string, value double")
    assert dict(rows(stats.cross_check(a, b, ["metric"], "value").select("metric", "status"))) == {"m": "OK", "s": "MISMATCH"}


@pytest.fixture(scope="module")
def shop(spark):
    return spark.createDataFrame(
        [(i, q, p, c, f"2024-{1 + i // 5:02d}-{1 + (i * 7) % 28:02d}") for i, (q, p, c) in enumerate(
            [(1, 10.0, "A"), (2, 25.5, "B"), (3, 30.0, "A"), (4, 12.0, "C"), (5, 99.0, "B"), (1, 45.0, "A"),
             (2, 60.0, "C"), (3, 75.0, "A"), (4, 20.0, "B"), (5, 15.0, "C"), (6, 80.0, "A"), (7, 55.0, "B")])],
        "order_id long, quantity long, unit_price double, category string, day string")


def test_histogram_against_numpy(shop):
    got = charts.hist_data(shop, "unit_price").orderBy("bin").collect()
    counts, edges = np.histogram([r["unit_price"] for r in shop.collect()], bins=charts.histogram_bins(12))
    assert [r["n"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["bin_start"] for r in got], edges[:-1])


def test_charts_take_empty_and_constant_input(spark, shop):
    none = shop.limit(0)
    assert charts.hist_data(none, "unit_price").count() == 0
    assert charts.box_data(none, "unit_price", "category").count() == 0
    assert charts.scatter_data(none, "quantity", "unit_price", "order_id").count() == 0
    assert charts.bar_data(none, "category").count() == 0
    assert charts.line_data(none, "day", "unit_price").count() == 0
    assert charts.violin_data(none, "unit_price", "category").count() == 0
    assert charts.regression_line_data(none, "quantity", "unit_price").count() == 0
    assert charts.pairplot_hist(none, ["quantity", "unit_price"], "category").count() == 0
    flat = spark.createDataFrame([(1, 5.0, 5.0)] * 3, "id long, x double, y double")
    assert charts.hist_data(flat, "x").agg(F.sum("n")).first()[0] == 3
    assert charts.regression_line_data(flat, "x", "y").count() == 0
    assert charts.scatter_data(flat, "x", "y", "id").first()["r"] is None


def test_violin_against_direct_density(shop):
    got = charts.violin_data(shop, "unit_price", "category", points=20).toPandas()
    frame = shop.toPandas()
    for name, part in got.groupby("category"):
        v = frame.loc[frame["category"] == name, "unit_price"].to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        want = [np.exp(-0.5 * ((x - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi)) for x in part["x"]]
        np.testing.assert_allclose(part["density"], want)
        assert part["x"].min() == pytest.approx(v.min() - 2 * h)


def test_box_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (7, 9, 8, 10, 9, 8, 7, 9, 61)], "c string, v double")
    row = charts.box_data(df, "v", "c").first()
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (7.0, 10.0, 1)
    assert [r["v"] for r in charts.box_outliers(df, "v", "c").collect()] == [61.0]


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "y int, p int")
    assert rows(charts.confusion_data(df, "y", "p")) == [(0, 0, 0), (0, 1, 1), (1, 0, 0), (1, 1, 2)]


def test_eda_report_on_narrow_tables(spark):
    df = spark.createDataFrame(
        [("tea", "east", 5.0, "open"), ("tea", "east", 9.0, "open"), ("soap", "west", 6.0, "shut"), ("soap", "west", 8.0, "open"),
         ("tea", "west", 7.0, "open"), ("soap", "east", 150.0, "shut")], "kind string, side string, amount double, state string")
    report = reports.eda_report(df)
    pivot = report["pivot_kind_by_side_mean_amount"]
    assert {r["kind"]: r["east"] for r in pivot.collect()}["tea"] == 7.0
    assert report["outliers"].first()["n_outliers"] == 1
    counts = {(r["column_name"], r["value"]): r["n"] for r in report["value_counts"].collect()}
    assert counts[("state", "open")] == 4
    assert "pivot" not in "".join(reports.eda_report(df.select("amount")))
    assert set(reports.eda_report(df.select("kind"))) == {"shape", "value_counts"}
    lines = [r["line"] for r in reports.eda_insights(df, "amount", "kind", "state", "open", "shut").collect()]
    assert "right-skewed" in lines[0] and "66.7% of rows" in lines[3]


def test_findings_follow_the_numbers(shop):
    s = reports.stats_summary(shop, ["quantity", "unit_price"], "unit_price", "quantity", "category")
    findings, advice = reports.business_insights(s, "unit_price", "quantity", "category")
    assert len(findings) == 7 and len(advice) == 3
    assert s.busiest == ("A", 5) and f"{s.central['unit_price']['mean']:.2f}" in findings[0]
    assert "At least one pair" in findings[2]
    assert "No pair" in reports.business_insights(s, "unit_price", "quantity", "category", weak=0.5)[0][2]


def test_student_report(spark):
    df = spark.createDataFrame([(0, 90.0, 80.0, 70.0), (1, 60.0, 50.0, 40.0), (2, 100.0, 100.0, 100.0), (3, 30.0, 20.0, 10.0)],
                               "id long, a double, b double, c double")
    rep = reports.student_report(df, "id", ["a", "b", "c"], 55.0, 2)
    assert [r["id"] for r in rep["top"].collect()] == [2, 0]
    lines = [r["line"] for r in reports.student_lines(rep, "id").orderBy("line_no").collect()]
    assert lines[0].startswith("a: mean 70.00") and lines[-1] == "at risk: 2"
