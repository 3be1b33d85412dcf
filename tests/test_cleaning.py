import datetime

import pytest
from pyspark.sql import functions as F

from tablework.operators import clean
from tests.conftest import rows


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(
        [(1, "Alice", 85.0, "2024-01-01"), (2, "Bob", None, "2024-01-02"), (3, None, 70.0, None),
         (4, "Dave", 90.0, "2024-01-04"), (5, "Alice", 85.0, "2024-01-05")],
        "id long, name string, score double, date_str string")


def test_missing_report(dirty):
    got = {r["column_name"]: (r["null_count"], r["null_share"], len(r["bar"])) for r in clean.missing_report(dirty).collect()}
    assert got == {"id": (0, 0.0, 0), "name": (1, 0.2, 8), "score": (1, 0.2, 8), "date_str": (1, 0.2, 8)}
    assert clean.missing_report(dirty.limit(0)).count() == 4
    assert clean.table_summary(dirty).first()["total_nulls"] == 3


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert clean.missing_report(df).first()["null_count"] == 1


def test_fills(dirty):
    assert clean.fill_mean(dirty, "score").filter("id = 2").first()["score"] == 82.5
    assert clean.fill_median(dirty, "score").filter("id = 2").first()["score"] == 85.0
    assert clean.fill_mode(dirty, "name").filter("id = 3").first()["name"] == "Alice"
    for fill in (clean.fill_mean, clean.fill_median):
        with pytest.raises(TypeError):
            fill(dirty, "name")


def test_fill_of_empty_column_leaves_gaps(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    for fill in (clean.fill_mean, clean.fill_median, clean.fill_mode):
        assert [r["v"] for r in fill(df, "v").collect()] == [None, None]


def test_fractional_median_widens_whole_numbers(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v long")
    assert sorted(r["v"] for r in clean.fill_median(df, "v").collect()) == [1.0, 1.5, 2.0]


def test_handle_missing(dirty):
    out = clean.handle_missing(dirty, {"score": "mean", "name": "drop", "absent": "mode", "date_str": "ffill"}, ["id"])
    assert out.count() == 4
    assert out.filter("score IS NULL OR name IS NULL OR date_str IS NULL").count() == 0
    with pytest.raises(ValueError):
        clean.handle_missing(dirty, {"score": "guess"})
    with pytest.raises(ValueError):
        clean.handle_missing(dirty, {"score": "bfill"})
    with pytest.raises(TypeError):
        clean.handle_missing(dirty, {"name": "mean"})
    back = clean.handle_missing(dirty, {"date_str": "bfill"}, ["id"])
    assert back.filter("id = 3").first()["date_str"] == "2024-01-04"


def test_subset_duplicates_keep_first(spark):
    df = spark.createDataFrame([(0, 1, 100), (1, 1, 999), (2, 2, 200)], "row long, id long, value long")
    assert rows(clean.remove_duplicates(df, "row", ["id"])) == [(0, 1, 100), (2, 2, 200)]
    assert clean.duplicate_report(df, "row", ["id"]).first().asDict() == {"total_rows": 3, "duplicate_rows": 1}
    assert rows(clean.duplicate_rows(df, "row", ["id"])) == [(1, 0)]
    with pytest.raises(ValueError):
        clean.remove_duplicates(df, subset=["id"])
    with pytest.raises(KeyError):
        clean.remove_duplicates(df, "row", ["absent"])


def test_full_duplicates_treat_gaps_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y long")
    assert clean.remove_duplicates(df).count() == 2
    assert dict(rows(clean.quality_report(df)))["duplicate_rows"] == 1


def test_hot_duplicate_value(spark):
    """A third of the rows hold the same long text."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.repeat(F.lit("x"), 500)).otherwise(F.col("id").cast("string")).alias("t"))
    assert clean.duplicate_report(df, "id", ["t"]).first()["duplicate_rows"] == 999
    kept = clean.remove_duplicates(df, "id", ["t"])
    assert kept.count() == 2001 and kept.filter("t LIKE 'x%'").first()["id"] == 0


def test_fix_types(spark):
    df = spark.createDataFrame([("9,041", "2024-05-01", "1.5"), ("62,500", "never", "2"), ("77", None, " 3 "), ("bad", "2024-01-02", "x")], "n string, d string, f string")
    out = clean.fix_types(df, {"n": "int", "d": "datetime", "f": "float"}).collect()
    assert [r["n"] for r in out] == [9041, 62500, 77, None]
    assert [r["f"] for r in out] == [1.5, 2.0, 3.0, None]
    assert out[0]["d"] == datetime.datetime(2024, 5, 1) and out[1]["d"] is None
    assert {r["n"]: r["f"] for r in clean.fix_types(df, {"f": "int"}).collect()} == {"9,041": None, "62,500": 2, "77": 3, "bad": None}
    with pytest.raises(KeyError):
        clean.fix_types(df, {"absent": "int"})


def test_clean_table(dirty):
    out = clean.clean_table(dirty.unionByName(dirty.limit(1)), {"score": "float"}, {"score": "median", "name": "mode"}, ["id"])
    assert out.count() == 5
    compared = {r["metric"]: (r["before"], r["after"]) for r in clean.quality_compare(dirty, out).collect()}
    assert compared["missing_cells"] == (3, 1)


def test_churn_cleaning(spark):
    df = spark.createDataFrame(
        [("k1", 7, "61.20", "no", "u"), ("k2", 19, "  ", "No ", "v"), ("k3", 2, "5.5", " YES ", "v"), ("k4", 60, "2400", "never", "u"), ("k5", 11, None, None, "v")],
        "client string, months long, billed string, gone string, plan string")
    out = clean.clean_churn(df, "client", "billed", "gone")
    got = out.orderBy("months").collect()
    assert out.columns == ["months", "billed", "target", "plan_v"]
    assert [r["billed"] for r in got] == [5.5, 61.2, 0.0, 0.0, 2400.0]
    assert [r["target"] for r in got] == [1, 0, 0, 0, 0]
    assert [r["plan_v"] for r in got] == [1, 0, 1, 1, 0]


def test_row_local_cleaning_runs_on_a_stream(spark, tmp_path, dirty):
    dirty.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(dirty.schema).parquet(str(tmp_path / "in"))
    out = clean.fill_constant(clean.drop_nulls(clean.fix_types(stream, {"date_str": "datetime"}), "name"), "score", 0.0)
    run = out.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    run.awaitTermination(60)
    assert spark.table("cleaned").count() == 4
