"""Mechanisms that keep plans small on large tables, against brute force: scans, pruning, bounds, blocks."""

import collections
import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.ml import knn, preprocess, split
from tablework.operators import aggregate, charts, clean, matrix, order, quantiles, stats
from tablework.plans import reports


def counted(spark, df):
    """The same rows, and a counter of how many of them were read."""
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(read, df.schema), seen


@pytest.fixture(scope="module")
def skewed(spark):
    draw = np.random.default_rng(5)
    v = np.r_[draw.lognormal(3, 2, 12_000), np.full(9_000, 7.25), draw.normal(0, 1e-9, 3_000)]
    rows = [(i, float(x), "abc"[i % 7 % 3], float(i % 11) if i % 5 else None) for i, x in enumerate(v.tolist())]
    return v, spark.createDataFrame(rows, "id long, v double, g string, w double").repartition(6)


def test_quantiles_and_moments_take_two_scans(spark, skewed):
    v, df = skewed
    df, seen = counted(spark, df.select("v", "w"))
    info, also = quantiles.profile(df, ["v", "w"], [0.01, 0.25, 0.5, 0.9, 1.0], each={"mean": F.avg}, also={"n": F.count("*")})
    assert seen.value == 2 * len(v) and also["n"] == len(v)
    assert np.allclose(info[((), "v")]["q"], np.quantile(v, [0.01, 0.25, 0.5, 0.9, 1.0]), rtol=1e-12)
    assert info[((), "w")]["n"] == len(v) - math.ceil(len(v) / 5) and math.isclose(info[((), "v")]["mean"], v.mean())
    before = seen.value
    got = {r["column_name"]: r for r in clean.describe(df).collect()}
    assert seen.value - before == 2 * len(v) and math.isclose(got["v"]["q50"], np.median(v))


@pytest.mark.parametrize("by,half,few,finish", [((), 0.0, 50, 50_000), ((), 0.003, 50, 10), (("g",), 0.0, 50, 10), (("g",), 0.02, 50, 50_000)])
def test_brackets_that_miss_are_repeated(skewed, monkeypatch, by, half, few, finish):
    v, df = skewed
    monkeypatch.setattr(quantiles, "_GROUPED" if by else "_WHOLE", (64, half, few))
    monkeypatch.setattr(quantiles, "_FINISH_ROWS", finish)
    got = quantiles.exact_quantiles(df, ["v"], [0.1, 0.37, 0.5, 0.75], by)
    label = np.array(["abc"[i % 7 % 3] for i in range(len(v))])
    for (key, _), summary in got.items():
        own = v[label == key[0]] if by else v
        assert summary["n"] == len(own) and np.allclose(summary["q"], np.quantile(own, [0.1, 0.37, 0.5, 0.75]), rtol=1e-12)
    assert len(got) == (3 if by else 1)


def test_eda_report_shares_its_scans(spark, skewed):
    df = order.materialize(skewed[1], "skewed")  # as a table is read: without a shuffle of its own
    spark.sparkContext.setJobGroup("eda", "eda")
    report = reports.eda_report(df.select("v", "w", "g", F.concat("g", F.lit("2")).alias("k")), pivots=[("g", "k", "v", "mean")], tier_column="v")
    rows = {name: part.collect() for name, part in report.items()}
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("eda")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) < 10, jobs
    want = {r["column_name"]: r["n_outliers"] for r in stats.outlier_counts(df, ["v", "w"]).collect()}
    assert {r["column_name"]: r["n_outliers"] for r in rows["outliers"]} == want
    assert {tuple(r) for r in rows["tiers"]} == {tuple(r) for r in aggregate.bin_terciles(df, "v").collect()}
    cross = {r["g"]: r for r in rows["pivot_g_by_k_mean_v"]}
    for r in aggregate.pivot_summary(df.withColumn("k", F.concat("g", F.lit("2"))), "g", "k", "v", "mean").collect():
        assert all(cross[r["g"]][c] == r[c] or math.isclose(cross[r["g"]][c], r[c]) for c in ("a2", "b2", "c2")) and len(cross) == 3
    assert [tuple(r) for r in rows["value_counts"]] == [tuple(r) for r in aggregate.value_counts(df.withColumn("k", F.concat("g", F.lit("2"))), ["g", "k"]).collect()]
    pairs = {(r["column_a"], r["column_b"]): r["r"] for r in rows["correlation"]}
    for r in stats.corr_matrix(df, ["v", "w"]).collect():
        assert math.isclose(pairs[(r["column_a"], r["column_b"])], r["r"])


def test_knn_is_exact_and_compares_a_smaller_share_of_a_larger_table(spark, monkeypatch):
    monkeypatch.setattr(knn, "_CELL_ROWS", 60)
    draw = np.random.default_rng(3)
    centres, shares = draw.normal(0, 40, (30, 5)), []
    for n in (600, 4800):
        x = np.round(centres[draw.integers(0, 30, n)] + draw.normal(0, 1, (n, 5)), 2)
        y = np.round(centres[draw.integers(0, 30, 60)] + draw.normal(0, 1, (60, 5)), 2)
        train = spark.createDataFrame([(i, r.tolist(), i % 3) for i, r in enumerate(x)], "id long, x array<double>, c long")
        test = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(y)], "id long, x array<double>")
        found, share = knn.knn_search(train, test, "id", "x", 4, ["c"])
        got = collections.defaultdict(list)
        for r in found.collect():
            got[r["id"]].append((r["rank"], r["neighbour"], r["c"]))
        for q in range(60):
            d = np.sqrt(((x - y[q]) ** 2).sum(axis=1))
            best = np.lexsort((np.arange(n), d))[:4]
            assert sorted(got[q]) == [(k, b, b % 3) for k, b in enumerate(best, 1)]
        shares.append(share)
    assert shares[1] < shares[0] < 1 and shares[1] < 0.1, shares


def test_ranks_of_ties_over_many_partitions(spark):
    draw = np.random.default_rng(8)
    rows = [(i, float(draw.integers(0, 3)), None if i % 4 == 0 else float(draw.normal()), float("nan") if i % 9 == 0 else 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(5)
    got = order.with_average_ranks(df, ["a", "b", "c"], ["ra", "rb", "rc"]).toPandas().sort_values("id")
    import pandas as pd
    frame = pd.DataFrame(rows, columns=["id", "a", "b", "c"])
    assert np.array_equal(got["ra"], frame["a"].rank()) and np.allclose(got["rb"], frame["b"].rank(), equal_nan=True)
    nans = frame["c"].isna().sum()
    assert np.allclose(got["rc"], np.where(frame["c"].isna(), len(rows) - nans + (nans + 1) / 2, (len(rows) - nans + 1) / 2))
    want = frame[["a", "b"]].dropna().corr("spearman").iloc[0, 1]
    assert math.isclose(stats.rank_correlations(df, ["a", "b"])[("a", "b")][0], want, rel_tol=1e-9)


def test_stratified_split_of_twenty_thousand_classes(spark):
    rows = spark.range(70_000).select("id", F.when(F.col("id") < 9_000, 0).otherwise(F.col("id") % 20_000).alias("c"))
    got = split.mark_test(rows, "id", 0.3, stratify="c").groupBy("c").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    counts = {r["c"]: r["n"] for r in got}
    assert len(counts) > 19_000 and {r["c"]: r["t"] for r in got} == split.class_quotas(counts, 0.3)
    few = rows.filter("c < 40")
    a = {r["id"] for r in split.mark_test(few, "id", stratify="c").filter("is_test").collect()}
    limit = split._CLASS_LIMIT
    try:
        split._CLASS_LIMIT = 5
        assert {r["id"] for r in split.mark_test(few, "id", stratify="c").filter("is_test").collect()} == a
    finally:
        split._CLASS_LIMIT = limit


def test_sparse_cross_table_and_levels(spark):
    rows = [(i % 3, f"l{i % 20_000:05d}", float(i)) for i in range(24_000)] + [(1, None, 1.0), (None, "l00000", 2.0), (2, "unvalued", None)]
    df = spark.createDataFrame(rows, "k long, l string, v double")
    wide, levels = aggregate.pivot_sparse(df, "k", "l", "v", "sum")
    names = {r["level_no"]: r["level"] for r in levels.collect()}
    assert names == dict(enumerate(f"l{i:05d}" for i in range(20_000)))
    want = collections.Counter()
    for k, l, v in rows[:24_000]:
        want[(k, l)] += v
    assert {(r["k"], names[c["level_no"]]): c["value"] for r in wide.collect() for c in r["cells"]} == dict(want)
    coded, codes = preprocess.encode_sparse(df, df.withColumn("k", F.col("k").cast("string")), ["k", "l"])
    code = {(r["column_name"], r["level"]): r["feature_no"] for r in codes.collect()}
    assert len(code) == 3 + 20_001 and code[("k", "0")] == 0 and code[("l", "unvalued")] == len(code) - 1
    seen = coded.filter("v = 23999.0").first()
    assert seen["features"] == sorted([code[("k", str(23_999 % 3))], code[("l", "l03999")]]) and coded.columns == ["v", "features"]


def test_positions_open_only_their_files(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 5000).alias("v")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be one
    try:
        placed = order.StoredOrder(df, ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [r["id"] for r in df.orderBy("v").collect()]
    assert placed.n == 5000 and len(placed.starts) > 2
    part = placed.between(120, 130)
    assert [r["id"] for r in part.orderBy("v").collect()] == want[120:130]
    assert "PartitionFilters: [isnotnull(_range" in part._jdf.queryExecution().toString()
    assert part.select("v").agg(F.count("*")).first()[0] == 10
    assert {r["_idx"]: r["id"] for r in placed.at([4999, 0, 0, 2500]).collect()} == {0: want[0], 2500: want[2500], 4999: want[4999]}
    assert placed.between(6000, 7000).count() == 0 and placed.at([]).count() == 0


def test_block_product(spark):
    draw = np.random.default_rng(1)
    a = np.where(draw.random((23, 17)) < 0.3, draw.integers(-5, 6, (23, 17)), 0)
    b = np.where(draw.random((17, 19)) < 0.3, draw.integers(-5, 6, (17, 19)), 0)
    cells = lambda m, di, dj: spark.createDataFrame([(int(i) + di, int(j) + dj, float(m[i, j])) for i, j in zip(*np.nonzero(m))], "i long, j long, v double")
    got = {(r["i"], r["j"]): r["v"] for r in matrix.mat_multiply(cells(a, -11, -4), cells(b, -4, 2), size=4, depth=2).collect()}
    there = (a != 0).astype(int) @ (b != 0).astype(int)
    want = a @ b
    assert got == {(i - 11, j + 2): float(want[i, j]) for i, j in zip(*np.nonzero(there))}
    twice = cells(a, 0, 0).union(cells(a, 0, 0))
    assert {(r["i"], r["j"]): r["v"] for r in matrix.mat_multiply(twice, cells(b, 0, 0), size=8).collect()} == {
        (i, j): 2.0 * want[i, j] for i, j in zip(*np.nonzero(there))}


def test_violin_moves_arrays_only(spark):
    draw = np.random.default_rng(2)
    rows = [("xy"[i % 2], float(round(v, 1))) for i, v in enumerate(draw.normal(5, 2, 3000))] + [("one", 1.0), (None, 2.0)]
    out = charts.violin_data(spark.createDataFrame(rows, "g string, v double"), "v", "g", 20)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[-1]
    for g in "xy":
        v = np.array([x for k, x in rows if k == g])
        h = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min() - 2 * h, v.max() + 2 * h, 20)
        want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * math.sqrt(2 * math.pi))
        got = out.filter(F.col("g") == g).orderBy("point").collect()
        assert np.allclose([r["density"] for r in got], want) and np.allclose([r["x"] for r in got], x)


def test_modes_keep_every_digit(spark):
    big = 2**60
    rows = [(big + 1, Decimal("0.10"), "b", 2.5, True), (big + 1, Decimal("0.2"), "a", 2.5, None), (big, Decimal("10"), "a", 1.0, False), (big, Decimal("9"), "b", None, False),
            (None, None, None, None, True)]
    df = spark.createDataFrame(rows, "l long, d decimal(20,2), s string, f double, b boolean")
    df, seen = counted(spark, df)
    assert clean.modes(df, df.columns) == {"l": big, "d": Decimal("0.10"), "s": "a", "f": 2.5, "b": False}
    assert seen.value == 5 and clean.modes(df.limit(0), ["l"]) == {"l": None}
    assert clean.handle_missing(df, {"l": "mode", "d": "mode", "s": "mode"}).filter("l IS NULL OR d IS NULL OR s IS NULL").count() == 0


def test_packed_side_of_pairwise_distance(spark, monkeypatch):
    a = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(7)], "a long, x array<double>")
    b = spark.createDataFrame([(f"k{i}", [0.0, float(i)]) for i in range(5)], "b string, y array<double>").repartition(3)
    want = {(i, f"k{j}", math.hypot(i, j)) for i in range(7) for j in range(5)}
    for limit in (matrix._BROADCAST_VALUES, 0):
        monkeypatch.setattr(matrix, "_BROADCAST_VALUES", limit)
        assert {tuple(r) for r in matrix.pairwise_distance(a, "a", "x", b, "b", "y").collect()} == want
    assert matrix.pairwise_distance(a, "a", "x", b.limit(0), "b", "y").count() == 0
