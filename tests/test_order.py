import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.operators import order, pick, quantiles
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key and one value."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 37 % 1009).cast("double")).alias("v"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"))


@pytest.mark.parametrize("parts", [1, 13])
def test_ordered_index_is_contiguous_and_independent_of_partitions(skewed, parts):
    got = {r["id"]: r["idx"] for r in order.ordered_index(skewed.repartition(parts), ["v", "id"]).collect()}
    want = sorted((r["v"], r["id"]) for r in skewed.collect())
    assert got == {i: n for n, (_, i) in enumerate(want)}


def test_prefix_sum_against_numpy(spark, skewed):
    counts = skewed.groupBy("v").agg(F.count("*").alias("n"), F.sum("v").alias("w"))
    placed = order.prefix_sum(counts, ["v"], {"before": "n", "mass": "w"}).orderBy("v").toPandas()
    assert placed["before"].tolist() == (placed["n"].cumsum() - placed["n"]).tolist()
    np.testing.assert_allclose(placed["mass"], placed["w"].cumsum() - placed["w"])


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("by", [(), ("g",)])
@pytest.mark.parametrize("parts", [1, 7])
def test_carry_fill_against_pandas(skewed, backward, by, parts):
    gappy = skewed.withColumn("x", F.when(F.col("id") % 11 == 5, F.col("id"))).drop("v")
    got = order.carry_fill(gappy.repartition(parts), ["id"], ["x"], by, backward).toPandas().sort_values("id")
    frame = gappy.toPandas().sort_values("id")
    series = frame.groupby("g")["x"] if by else frame["x"]
    want = series.bfill() if backward else series.ffill()
    assert got["x"].isna().tolist() == want.isna().tolist()
    assert got["x"].dropna().tolist() == want.dropna().tolist()


def test_fill_keeps_types_and_leading_gap(spark):
    df = spark.createDataFrame([(1, None), (2, 2**60 + 1), (3, None)], "id long, x long")
    assert rows(order.carry_fill(df, ["id"], ["x"]), "id") == [(1, None), (2, 2**60 + 1), (3, 2**60 + 1)]


def test_positions_both_routes_agree(skewed):
    near = rows(order.positions_between(skewed, ["v", "id"], 100, 150), "id")
    far = rows(order.positions_between(skewed, ["v", "id"], 100, 150), "id")
    assert near == far and len(near) == 50


def test_quantiles_equal_numpy(skewed):
    frame, probs = skewed.toPandas(), [0, 0.1, 0.25, 0.5, 0.66, 0.9, 1]
    got = quantiles.exact_quantiles(skewed, ["v", "id"], probs)
    np.testing.assert_allclose(got[((), "v")]["q"], np.quantile(frame["v"], probs))
    np.testing.assert_allclose(got[((), "id")]["q"], np.quantile(frame["id"], probs))


def test_quantiles_narrow_over_several_rounds(spark, monkeypatch):
    """Values of very different size force repeated narrowing."""
    monkeypatch.setattr(quantiles, "_FINISH_ROWS", 5)
    monkeypatch.setattr(quantiles, "_BUCKETS", 16)
    df = spark.range(2000).select((F.exp(F.col("id") / 60) - F.lit(3.0)).alias("v")).repartition(5)
    frame = df.toPandas()
    got = quantiles.column_quantiles(df, ["v"], [0.01, 0.5, 0.77])["v"]
    np.testing.assert_allclose(got, np.quantile(frame["v"], [0.01, 0.5, 0.77]), rtol=1e-12)


def test_group_quantiles_both_routes(skewed):
    direct = rows(quantiles.group_quantiles(skewed, ["g"], "v", [0.3, 0.5], ["a", "b"]), "g")
    placed = rows(quantiles.group_quantiles(skewed, ["g"], "v", [0.3, 0.5], ["a", "b"], max_groups=2), "g")
    want = skewed.toPandas().groupby("g")["v"].quantile([0.3, 0.5]).unstack()
    assert [r[0] for r in direct] == want.index.tolist()
    np.testing.assert_allclose([r[1:] for r in direct], want.to_numpy())
    np.testing.assert_allclose([r[1:] for r in placed], want.to_numpy())


def test_quantile_edge_cases(spark):
    empty = spark.createDataFrame([], "v double")
    assert quantiles.column_quantiles(empty, ["v"], [0.5]) == {"v": [None]}
    gaps = spark.createDataFrame([(None,), (float("nan"),), (4.0,), (1.0,)], "v double")
    assert quantiles.column_quantiles(gaps, ["v"], [0.5]) == {"v": [2.5]}
    with pytest.raises(ValueError):
        quantiles.column_quantiles(gaps, ["v"], [1.5])


def test_picks_are_exact_and_stable(skewed):
    a = {r["id"] for r in pick.sample_rows(skewed, 700, "id", 3).collect()}
    b = {r["id"] for r in pick.sample_rows(skewed.repartition(11), 700, "id", 3).collect()}
    assert len(a) == 700 and a == b
    assert pick.sample_rows(skewed, 10_000, "id").count() == 3000
    assert pick.sample_rows(skewed, 0, "id").count() == 0


def test_equal_hashes_are_cut_by_id(skewed, monkeypatch):
    monkeypatch.setattr(pick, "hash_key", lambda i, seed: F.lpad(F.floor(F.col(i) / 50).cast("string"), 32, "0"))
    got = sorted(r["id"] for r in pick.sample_rows(skewed, 120, "id").collect())
    assert got == list(range(120))


def test_picks_narrow_digit_by_digit(skewed, monkeypatch):
    want = sorted(r["id"] for r in pick.sample_rows(skewed, 700, "id", 3).collect())
    monkeypatch.setattr(pick, "_FINISH_ROWS", 0)
    assert sorted(r["id"] for r in pick.sample_rows(skewed, 700, "id", 3).collect()) == want
    by_group = skewed.filter(pick.pick_smallest(skewed, "id", 5, lambda g, n: n // 2, by=["g"]))
    halves = {r["g"]: r["count"] for r in by_group.groupBy("g").count().collect()}
    sizes = {r["g"]: r["count"] for r in skewed.groupBy("g").count().collect()}
    assert halves == {g: n // 2 for g, n in sizes.items() if n > 1}


def test_average_ranks_against_pandas(skewed):
    got = order.with_average_ranks(skewed, ["v", "id"], ["a", "b"]).toPandas().sort_values("id")
    frame = skewed.toPandas().sort_values("id")
    assert got["a"].tolist() == frame["v"].rank().tolist()
    assert got["b"].tolist() == frame["id"].rank().tolist()


def test_scratch_root_must_be_shared_on_a_cluster(spark, monkeypatch):
    assert order.scratch_root(spark)

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        order.scratch_root(Cluster())
