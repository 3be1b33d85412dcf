import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.catalog.sources import workbook
from tablework.operators import matrix
from tablework.sources import generate, readers, writers
from tests.conftest import rows

SCHEMA = "order_id BIGINT, name STRING, price DOUBLE, day STRING"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([(1, "Ann", 1.5, "2024-01-31"), (2, None, None, "soon"), (3, "Bob, Jr", 2.25, "2024-02-01")], SCHEMA)


def test_csv_and_json_round_trip(spark, orders, tmp_path):
    want = [(1, "Ann", 1.5, datetime.date(2024, 1, 31)), (2, None, None, None), (3, "Bob, Jr", 2.25, datetime.date(2024, 2, 1))]
    writers.write_csv(orders, str(tmp_path / "o.csv"))
    writers.write_json(orders, str(tmp_path / "o.json"))
    assert rows(readers.load_table(spark, str(tmp_path / "o.csv"), SCHEMA, ["day"]), "order_id") == want
    inferred = readers.load_table(spark, str(tmp_path / "o.csv"), date_columns=["day"])
    assert rows(inferred.select("order_id", "name", "price", "day"), "order_id")[0][3] == want[0][3]
    assert rows(readers.read_json(spark, str(tmp_path / "o.json"), SCHEMA, ["day"], lines=True), "order_id") == want
    (tmp_path / "array.json").write_text('[{"order_id": 1, "price": 2.5}, {"order_id": 2}]')
    assert rows(readers.load_table(spark, str(tmp_path / "array.json"), "order_id BIGINT, price DOUBLE"), "order_id") == [(1, 2.5), (2, None)]


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.load_table(spark, str(tmp_path / "absent.csv"))
    (tmp_path / "x.txt").write_text("a")
    with pytest.raises(ValueError):
        readers.load_table(spark, str(tmp_path / "x.txt"))
    with pytest.raises(ValueError):
        readers.read_excel(spark, "old.xls", SCHEMA)
    with pytest.raises(ValueError):
        readers.read_many(spark, [])


def test_excel_file(spark, tmp_path):
    content = workbook(["order_id", "day", "name", "price"], [[1, 45322, "Ann & Co", 1.5], [2, "2024-02-01", None, "x"], [3, None, "Bob", 2]])
    (tmp_path / "book.xlsx").write_bytes(content)
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "a.xlsx").write_bytes(content)
    (tmp_path / "more" / "b.xlsx").write_bytes(content)
    schema = "order_id BIGINT, name STRING, price DOUBLE, day DATE, extra STRING"
    got = rows(readers.load_table(spark, str(tmp_path / "book.xlsx"), schema, ["day"]), "order_id")
    assert got == [(1, "Ann & Co", 1.5, datetime.date(2024, 1, 31), None), (2, None, None, datetime.date(2024, 2, 1), None), (3, "Bob", 2.0, None, None)]
    assert readers.read_excel(spark, str(tmp_path / "more"), schema, ["day"]).count() == 6


def test_two_decimals_and_report(spark, orders, tmp_path):
    writers.write_csv(orders.select("order_id", "price"), str(tmp_path / "m.csv"), fixed_decimals=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "m.csv")).filter("order_id = 1").first()["price"] == "1.50"
    lines = spark.range(500).select(F.col("id").alias("line_no"), F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    writers.write_report(lines.repartition(7), str(tmp_path / "report"))
    parts = sorted(p for p in (tmp_path / "report").iterdir() if p.name.startswith("part"))
    text = "".join(p.read_text() for p in parts).splitlines()
    assert text == [f"line {i}" for i in range(500)]


def test_materialize_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert readers.materialize_once(spark, str(tmp_path / "once"), build).count() == 5
    assert len(calls) == 1


def test_inline_table(spark):
    assert rows(readers.inline_table(spark, {"a": [1, 2], "b": ["x", "y"]})) == [(1, "x"), (2, "y")]
    assert rows(readers.inline_table(spark, {"x": 1, "y": 2})) == [("x", 1), ("y", 2)]
    assert rows(readers.inline_table(spark, [{"a": 1}, {"a": 2, "b": 3}], "a long, b long")) == [(1, None), (2, 3)]
    assert rows(readers.inline_table(spark, [(1, 2.0)], "a long, b double")) == [(1, 2.0)]
    with pytest.raises(ValueError):
        readers.inline_table(spark, {"a": [1], "b": [1, 2]})


def test_dataset_catalog(spark):
    cat = readers.DatasetCatalog()
    cat.register("demo", lambda: spark.createDataFrame([(1, 2.0)], "x long, y double"), "y", "regression")
    x, y = cat.load_xy("DEMO")
    assert x.columns == ["x"] and y.columns == ["target"] and cat.task("demo") == "regression"
    for name in ("absent", None):
        with pytest.raises(ValueError):
            cat.load(name)
    with pytest.raises(ValueError):
        cat.register("bad", lambda: None, "y", "ranking")


def test_generators(spark):
    assert [r["value"] for r in generate.gen_range(spark, 0, 10, 3).orderBy("value").collect()] == [0, 3, 6, 9]
    np.testing.assert_allclose([r["value"] for r in generate.gen_linspace(spark, 0, 1, 5).orderBy("idx").collect()], np.linspace(0, 1, 5))
    assert generate.gen_constant(spark.range(2), "id", 3, 1).agg(F.sum("v"), F.count("*")).first()[:] == (6.0, 6)
    u = generate.gen_uniform(spark.range(100), "id", 50).agg(F.min("v"), F.max("v"), F.avg("v")).first()
    assert 0 <= u[0] and u[1] < 1 and u[2] == pytest.approx(0.5, abs=0.02)
    s = generate.gen_scores(spark.range(2000), "id", ["a", "b"]).agg(F.avg("a"), F.stddev("a"), F.min("b"), F.max("b")).first()
    assert s[0] == pytest.approx(70, abs=1.5) and s[1] == pytest.approx(15, abs=1.5) and s[2] >= 0 and s[3] <= 100
    o = generate.gen_orders(spark.range(150), "id", {"kind": {"x": 3, "y": 1}}, "2001-03-01", 30, 40)
    kinds = {r["kind"]: r["count"] for r in o.groupBy("kind").count().collect()}
    assert sum(kinds.values()) == 150 and kinds["x"] > 2 * kinds["y"] > 0
    assert o.filter("customer_name IS NULL").count() == 5
    for r in generate.compare_moments(generate.gen_distributions(spark.range(4000), "id")).collect():
        assert r["mean_sample"] == pytest.approx(r["mean_theory"], rel=0.03) and r["var_sample"] == pytest.approx(r["var_theory"], rel=0.1)


def test_inject_dirty(spark):
    df = spark.range(200).select("id", F.col("id").cast("string").alias("a"), F.col("id").cast("double").alias("b"))
    out = generate.inject_dirty(df, "id", 0.07, 9)
    assert out.count() == 209
    first = out.dropDuplicates(["id"])
    assert [first.filter(F.col(c).isNull()).count() for c in ("a", "b")] == [14, 14]
    assert df.filter("a IS NULL").count() == 0


def test_matrices(spark):
    cells = lambda m: spark.createDataFrame([(i, j, float(v)) for i, r in enumerate(m) for j, v in enumerate(r)], "i long, j long, v double")
    a, b = [[1, 2], [3, 4]], [[5, 6], [7, 8]]
    assert rows(matrix.mat_multiply(cells(a), cells(b)), "i", "j") == [(0, 0, 19.0), (0, 1, 22.0), (1, 0, 43.0), (1, 1, 50.0)]
    many = cells(a).withColumn("matrix_id", F.lit("a")).unionByName(cells([[1, 2], [2, 4]]).withColumn("matrix_id", F.lit("s"))).unionByName(
        cells([[1, 2, 3], [4, 5, 6]]).withColumn("matrix_id", F.lit("r")))
    out = matrix.det_inverse(many).collect()
    assert {r["matrix_id"]: r["error"] for r in out} == {"a": None, "s": "not invertible", "r": "not square"}
    inverse = {(r["i"], r["j"]): r["v"] for r in out if r["matrix_id"] == "a"}
    np.testing.assert_allclose([inverse[k] for k in sorted(inverse)], np.linalg.inv(a).ravel())


def test_sequences(spark):
    seq = spark.createDataFrame([(i, i + 1) for i in range(7)], "k long, v long").repartition(3)
    assert rows(matrix.chunk_rows(seq, ["k"], "v", 3)) == [(0, [1, 2, 3]), (1, [4, 5, 6]), (2, [7])]
    six = seq.filter("k < 6")
    assert rows(matrix.reshape_rows(six, ["k"], "v", 3), "i", "j")[-1] == (1, 2, 6)
    for call in (lambda: matrix.reshape_rows(seq, ["k"], "v", 3), lambda: matrix.chunk_rows(seq, ["k"], "v", 0)):
        with pytest.raises(ValueError):
            call()
    nested = spark.sql("SELECT array(array(1, 2), array(), array(3)) AS x, array(array(array(4)), array(array())) AS y")
    assert matrix.flatten_array(matrix.flatten_array(nested, "x", "x"), "y", "y").first()[:] == ([1, 2, 3], [4])


def test_words(spark):
    df = spark.createDataFrame([("Hello world! HELLO python, world.",), ("   ",), (None,), ("Élan élan x_1",)], "t string")
    assert dict(rows(matrix.word_frequency(df, "t"))) == {"hello": 2, "world": 2, "python": 1, "élan": 2, "x_1": 1}


def test_distances(spark, monkeypatch):
    a = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], "a long, x array<double>")
    b = spark.createDataFrame([(7, [0.0, 0.0]), (8, [3.0, 4.0])], "b long, y array<double>")
    want = [(1, 7, 0.0), (1, 8, 5.0), (2, 7, 2**0.5), (2, 8, 13**0.5)]
    assert rows(matrix.pairwise_distance(a, "a", "x", b, "b", "y")) == want
    monkeypatch.setattr(matrix, "_BROADCAST_VALUES", 2)
    monkeypatch.setattr(matrix, "_BLOCK_ROWS", 1)
    assert rows(matrix.pairwise_distance(a, "a", "x", b, "b", "y")) == want
    with pytest.raises(ValueError):
        matrix.pairwise_distance(a, "a", "x", b.withColumn("y", F.array(F.lit(1.0))), "b", "y")
