import pytest
from pyspark.sql import functions as F

from tablework.operators import aggregate as agg
from tablework.operators import joins, select
from tests.conftest import rows


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [(1, "Dora", "tool", "east", 40), (2, "Emil", "toy", "west", 125), (3, "Finn", "toy", "east", 90), (4, "Dora", "toy", "west", 310),
         (5, "Dora", "tool", "west", 75), (6, "Emil", "tool", "east", 220), (7, "Finn", "tool", "east", 15)],
        "id long, customer string, category string, region string, amount long")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("tool", "hardware"), ("toy", "games"), ("book", "print")], "category string, dept string")


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame([tuple(range(4 * r, 4 * r + 4)) for r in range(5)], "a long, b long, c long, d long")


def test_group_sums_and_filters(orders):
    assert rows(agg.group_agg(orders, "category", total=("amount", "sum"))) == [("tool", 350), ("toy", 525)]
    between = select.filter_records(orders, {"amount": {"between": (90, 220)}})
    assert sorted(r["amount"] for r in between.collect()) == [90, 125, 220]
    both = select.filter_records(orders, {"category": ["tool"], "region": "east", "customer": "Dora"})
    assert both.count() == 1
    assert select.filter_records(orders, {}).count() == 7


def test_filter_records_pushes_one_predicate(spark, tmp_path, orders):
    orders.write.parquet(str(tmp_path / "o"))
    plan = select.filter_records(spark.read.parquet(str(tmp_path / "o")), {"amount": {"between": (100, 200)}, "region": "east"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Filter (") == 1 and "region" in text.split("PushedFilters:")[1] and "amount" in text.split("PushedFilters:")[1]


@pytest.mark.parametrize("spec", [{"absent": 1}, {"amount": {"above": 3}}])
def test_filter_records_rejects_bad_conditions(orders, spec):
    with pytest.raises((KeyError, ValueError)):
        select.filter_records(orders, spec)


@pytest.mark.parametrize("n", [2, 5000])
def test_top_two_per_customer(orders, n):
    top = agg.top_n_per_group(orders, "customer", "amount", n, "id")
    dora = sorted((r["amount"] for r in top.collect() if r["customer"] == "Dora"), reverse=True)
    assert dora == ([310, 75] if n == 2 else [310, 75, 40])


def test_top_n_is_cut_before_the_shuffle(orders):
    plan = agg.top_n_per_group(orders, "customer", "amount", 2, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_null_groups_and_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 5.0), ("b", 1.0)], "k string, v double")
    assert rows(agg.group_agg(df, "k", s=("v", "sum"), n=("v", "count"))) == [("a", 0.0, 0), ("b", 1.0, 1)]


def test_group_aggregate_names_and_errors(orders):
    out = agg.group_aggregate(orders, "category", {"amount": ["sum", "median", "first", "last", "nunique"]}, order_by="id")
    assert out.columns == ["category", "amount_sum", "amount_median", "amount_first", "amount_last", "amount_nunique"]
    assert rows(out) == [("tool", 350, 57.5, 40, 15, 4), ("toy", 525, 125.0, 125, 310, 3)]
    with pytest.raises(ValueError):
        agg.group_aggregate(orders, "category", {"amount": "product"})
    with pytest.raises(KeyError):
        agg.group_aggregate(orders, "absent", {"amount": "sum"})


def test_transform_keeps_all_rows(orders):
    out = agg.group_transform(orders, "category", "amount", "m", "d")
    assert out.count() == 7
    assert {r["id"]: r["d"] for r in out.collect()}[2] == -50.0


@pytest.mark.parametrize("how,n", [("inner", 7), ("left", 7), ("right", 8), ("outer", 8)])
def test_join_counts(orders, lookup, how, n):
    joined = joins.merge(orders, lookup, "category", how)
    assert joined.count() == n
    if how in ("right", "outer"):
        assert [r["customer"] for r in joined.filter("category = 'book'").collect()] == [None]
    assert dict(rows(joins.join_counts(orders, lookup, "category")))[how] == n


def test_join_matches_missing_keys_and_renames(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v long")
    b = spark.createDataFrame([(None, 3)], "k string, v long")
    assert rows(joins.merge(a, b, "k")) == [(None, 1, 3)]
    assert joins.merge(a, b, "k").columns == ["k", "v_x", "v_y"]
    assert joins.merge(a, b, "k", "outer").count() == 2
    with pytest.raises(ValueError):
        joins.merge(a, b, "k", "cross")


def test_unmatched(orders, lookup):
    assert rows(joins.unmatched(lookup, orders, "category")) == [("book", "print")]


def test_concat(spark, orders, lookup):
    assert joins.concat_rows(orders, orders).count() == 14
    with pytest.raises(ValueError):
        joins.concat_rows(orders, lookup)
    a = spark.createDataFrame([(2, "b"), (1, "a")], "i long, x string")
    b = spark.createDataFrame([(10, "p"), (20, "q")], "j long, y string")
    assert rows(joins.concat_cols(a, ["i"], b, ["j"]), "i") == [(1, "a", 10, "p"), (2, "b", 20, "q")]
    with pytest.raises(ValueError):
        joins.concat_cols(a, ["i"], b.limit(1), ["j"])


def test_sub_matrix_and_row_picks(grid):
    assert rows(select.slice_rows_cols(grid, ["a"], (1, 3), (0, 2))) == [(4, 5), (8, 9)]
    picked = select.select_rows_by_index(grid, ["a"], [3, 0]).orderBy("ord")
    assert [r["a"] for r in picked.collect()] == [12, 0]
    assert [r["a"] for r in select.select_rows_by_index(grid, ["a"], [1, 1, 0, -1]).orderBy("ord").collect()] == [4, 4, 0, 16]
    with pytest.raises(IndexError):
        select.select_rows_by_index(grid, ["a"], [99])
    with pytest.raises(IndexError):
        select.slice_rows_cols(grid, ["a"], (10, 12))
    assert sorted(r["a"] for r in select.slice_step(grid, ["a"], 2).collect()) == [0, 8, 16]


def test_mean_deviation(spark):
    df = spark.createDataFrame([(float(v),) for v in (10, 11, 9, 10, 100, 12, -80, 11)], "v double")
    assert sorted(r["v"] for r in select.filter_mean_deviation(df, "v", 15).collect()) == [9, 10, 10, 11, 11, 12]


def test_scores_and_ranks(spark):
    df = spark.createDataFrame([(0, 90, 80, 70), (1, 60, 50, 40), (2, 100, 100, 100), (3, 30, 20, 10)], "id long, a long, b long, c long")
    means = agg.row_mean(df, ["a", "b", "c"], "m")
    assert [r["m"] for r in means.orderBy("id").collect()] == [80, 50, 100, 20]
    ranks = agg.rank_rows(means.select("id", "m"), "m", "id")
    assert [r["rank"] for r in ranks.orderBy("id").collect()] == [1, 2, 0, 3]
    assert [r["id"] for r in agg.at_risk(df, ["a", "b", "c"], 55.0, "id").collect()] == [1, 3]


def test_map_tier_cast(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), (None, None)], "k string, t string")
    assert [r["m"] for r in select.map_values(df, "k", {"a": 1}, "m").collect()] == [1, None, None]
    many = {f"k{i}": f"v{i}" for i in range(600)} | {"a": "found"}
    assert rows(select.map_values(df, "k", many, "m"), "k") == [(None, None, None), ("a", "1", "found"), ("b", "x", None)]
    for n in (1, 500, 501):  # the same type and values on both sides of the join
        whole = {f"k{i}": i for i in range(n - 1)} | {"a": 7}
        assert [f.dataType.simpleString() for f in select.map_values(df, "k", whole, "m").schema if f.name == "m"] == ["bigint"]
        assert rows(select.map_values(df, "k", whole, "m"), "k") == [(None, None, None), ("a", "1", 7), ("b", "x", None)]
        mixed = whole | {"b": 0.5, "gone": None}
        assert rows(select.map_values(df, "k", mixed, "m").select("m"), "m") == [(None,), (0.5,), (7.0,)]
    with pytest.raises(TypeError):
        select.map_values(df, "k", {"a": 1, "b": "x"}, "m")
    assert [r["t"] for r in select.cast_columns(df, {"t": "int"}).collect()] == [1, None, None]


def test_medians_of_several_columns_at_once(spark):
    df = spark.createDataFrame([("p", 1, 4.0), ("p", 3, None), ("q", 5, None), ("q", 8, None), (None, 9, 9.0)], "g string, a long, b double")
    got = agg.group_aggregate(df, "g", {"a": ["median", "sum"], "b": "median"})
    assert got.columns == ["g", "a_median", "a_sum", "b_median"]
    assert rows(got, "g") == [("p", 2.0, 4, 4.0), ("q", 6.5, 13, None)]
    from tablework.operators.quantiles import group_medians

    assert rows(group_medians(df, ["g"], ["a", "b"], max_groups=1), "g") == [("p", 2.0, 4.0), ("q", 6.5, None)]
    assert group_medians(df.limit(0), ["g"], ["a"]).count() == 0


def test_terciles_without_values(spark):
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert agg.bin_terciles(empty, "v").schema.names == ["tier", "n"] and agg.bin_terciles(empty, "v").count() == 0


def test_bins(spark):
    df = spark.createDataFrame([(10.0,), (13.0,), (200.0,), (12.0,), (0.0,), (301.0,)], "v double")
    out = {r["v"]: r["c"] for r in agg.bin_cut(df, "v", [0, 12, 20, 300], ["Low", "Medium", "High"], "c").collect()}
    assert out == {10.0: "Low", 13.0: "Medium", 200.0: "High", 12.0: "Low", 0.0: None, 301.0: None}
    with pytest.raises(ValueError):
        agg.bin_cut(df, "v", [0, 1], ["a", "b"])
    constant = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert agg.bin_terciles(constant, "v").agg(F.sum("n")).first()[0] == 2


def test_resample_empty_periods(spark):
    df = spark.createDataFrame([("2024-01-31", 1.0), ("2024-04-01", 2.0), (None, 3.0), ("2024-04-02", None)], "d string, v double")
    got = [(str(a), b) for a, b in rows(agg.resample_sum(df, "d", "v"))]
    assert got == [("2024-01-31", 1.0), ("2024-02-29", 0.0), ("2024-03-31", 0.0), ("2024-04-30", 2.0)]
    weeks = agg.resample_sum(spark.createDataFrame([("2024-01-07", 1.0), ("2024-01-08", 2.0)], "d string, v double"), "d", "v", "week")
    assert [(str(a), b) for a, b in rows(weeks)] == [("2024-01-07", 1.0), ("2024-01-14", 2.0)]
    assert agg.resample_sum(df.limit(0), "d", "v").count() == 0
    with pytest.raises(ValueError):
        agg.resample_sum(df, "d", "v", "hour")


def test_value_counts_and_pivot(spark):
    df = spark.createDataFrame([("x", "p", 1.0), ("x", "q", None), ("y", "p", 3.0), (None, "p", 9.0)], "i string, c string, v double")
    assert rows(agg.value_counts(df, ["i"])) == [("i", "x", 2), ("i", "y", 1)]
    assert rows(agg.pivot_summary(df, "i", "c", "v", "mean")) == [("x", 1.0), ("y", 3.0)]
    assert agg.scalar_metrics(df.limit(0), "v").first().asDict() == {"total": 0.0, "mean": 0.0}
    ends = agg.group_extremes(df, "i", "v").first()
    assert (ends["best_group"], ends["worst_group"], ends["pct_gap"]) == ("y", "x", 200.0)
