from pyspark.sql import functions as F

from tablework.catalog.registry import query, rounded, table
from tablework.operators import matrix

_CELLS = """(SELECT vec_id AS i, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings)"""


def _cells(spark, sf):
    return matrix.to_cells(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("sum_of_squares", "SELECT round(sum(l_quantity * l_quantity), 2) AS sum_of_squares FROM lineitem")
def _(spark, sf):
    return rounded(matrix.sum_of_squares(table(spark, sf, "lineitem"), "l_quantity"), 2)


@query("dot_product", "SELECT round(sum(l_quantity * l_discount), 2) AS dot_product FROM lineitem")
def _(spark, sf):
    return rounded(matrix.dot_product(table(spark, sf, "lineitem"), "l_quantity", "l_discount"), 2)


@query("abs_distance", "SELECT l_orderkey, l_linenumber, round(abs(l_discount - l_tax), 6) AS distance FROM lineitem")
def _(spark, sf):
    out = matrix.abs_distance(table(spark, sf, "lineitem"), "l_discount", "l_tax")
    return rounded(out.select("l_orderkey", "l_linenumber", "distance"))


_AXES = ("l_quantity", "l_discount", "l_tax")
_AXIS_SQL = """SELECT '{name}' AS axis, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(var_pop(v), 6) AS var,
  min(v) AS min, max(v) AS max, round(quantile_cont(v, 0.25), 6) AS p25, round(median(v), 6) AS median,
  round(quantile_cont(v, 0.75), 6) AS p75 FROM {source}"""


@query("axis_stats", "\nUNION ALL ".join(
    [_AXIS_SQL.format(name=c, source=f"(SELECT {c} AS v FROM lineitem)") for c in _AXES]
    + [_AXIS_SQL.format(name="*", source="(" + " UNION ALL ".join(f"SELECT {c} AS v FROM lineitem" for c in _AXES) + ")")]))
def _(spark, sf):
    return rounded(matrix.axis_stats(table(spark, sf, "lineitem"), _AXES))


@query("mat_multiply", f"""
SELECT a.i, b.j, round(sum(a.v * b.v), 6) AS v FROM {_CELLS} a
JOIN (SELECT j AS i, label::BIGINT AS j, avg(v) AS v FROM {_CELLS} c JOIN embeddings e ON c.i = e.vec_id GROUP BY ALL) b ON a.j = b.i
GROUP BY ALL""")
def _(spark, sf):
    """Every vector times the matrix of label means (64 x labels)."""
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("i"), F.col("label").cast("bigint").alias("label"))
    cells = _cells(spark, sf)
    means = cells.join(labels, "i").groupBy(F.col("j").alias("i"), F.col("label").alias("j")).agg(F.avg("v").alias("v"))
    return rounded(matrix.mat_multiply(cells, means))


@query("mat_transpose", f"SELECT j AS i, i AS j, v FROM {_CELLS}")
def _(spark, sf):
    return matrix.mat_transpose(_cells(spark, sf))


# One 2 x 2 matrix per customer, from whole-number parts of the account; some are singular.
_SMALL_SQL = """(SELECT c_custkey AS id, c_nationkey::DOUBLE AS a, (c_custkey % 7)::DOUBLE AS b,
  (c_custkey % 5)::DOUBLE AS c, (c_custkey % 11)::DOUBLE AS d FROM customer)"""


def _small(spark, sf):
    key = F.col("c_custkey")
    cell = lambda i, j, v: F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j"), v.cast("double").alias("v"))
    cells = F.array(cell(0, 0, F.col("c_nationkey")), cell(0, 1, key % 7), cell(1, 0, key % 5), cell(1, 1, key % 11))
    return table(spark, sf, "customer").select(key.alias("matrix_id"), F.inline(cells))


@query("mat_det_inverse", f"""
SELECT id AS matrix_id, round(CASE WHEN a * d - b * c = 0 THEN 0 ELSE a * d - b * c END, 6) AS det,
  CASE WHEN a * d - b * c <> 0 THEN k.i END AS i, CASE WHEN a * d - b * c <> 0 THEN k.j END AS j,
  CASE WHEN a * d - b * c <> 0 THEN round(CASE k.i * 2 + k.j WHEN 0 THEN d WHEN 1 THEN -b WHEN 2 THEN -c ELSE a END / (a * d - b * c), 6) + 0.0 END AS v,
  CASE WHEN a * d - b * c = 0 THEN 'not invertible' END AS error
FROM {_SMALL_SQL}, (VALUES (0::BIGINT, 0::BIGINT), (0, 1), (1, 0), (1, 1)) AS k(i, j)
WHERE a * d - b * c <> 0 OR (k.i = 0 AND k.j = 0)""")
def _(spark, sf):
    out = rounded(matrix.det_inverse(_small(spark, sf)))
    return out.withColumn("v", F.col("v") + F.lit(0.0))


@query("gram_matrix", "\nUNION ALL ".join(
    f"SELECT {i}::BIGINT AS i, {j}::BIGINT AS j, round(sum({a} * {b}), 2) AS v FROM lineitem"
    for i, a in enumerate(_AXES) for j, b in enumerate(_AXES)))
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.array(*[F.col(c) for c in _AXES]).alias("x"))
    return rounded(matrix.gram_cells(rows, "x", 3), 2)


@query("reshape_rows", """
SELECT idx // 4 AS i, idx % 4 AS j, value AS v FROM (SELECT value, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events)""")
def _(spark, sf):
    return matrix.reshape_rows(table(spark, sf, "events").select("event_id", "value"), ["event_id"], "value", 4)


@query("flatten_cells", "SELECT row_number() OVER (ORDER BY event_id) - 1 AS idx, value AS v FROM events")
def _(spark, sf):
    cells = matrix.reshape_rows(table(spark, sf, "events").select("event_id", "value"), ["event_id"], "value", 4)
    return matrix.flatten_cells(cells, 4)


@query("chunk_rows", """
SELECT idx // 300 AS chunk, list(value ORDER BY idx) AS items
FROM (SELECT value, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events) GROUP BY 1""")
def _(spark, sf):
    return matrix.chunk_rows(table(spark, sf, "events"), ["event_id"], "value", 300)


@query("flatten_array", """
SELECT o_orderkey, [o_orderkey, o_custkey, o_orderkey + o_custkey, o_orderkey % 7] AS items FROM orders""")
def _(spark, sf):
    a, b = F.col("o_orderkey"), F.col("o_custkey")
    nested = F.array(F.array(F.array(a, b), F.array().cast("array<bigint>")), F.array(F.array(a + b), F.array(a % 7)))
    return matrix.flatten_array(table(spark, sf, "orders").select("o_orderkey", nested.alias("nested")), "nested", "items").drop("nested")


@query("word_frequency", r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents) GROUP BY 1""")
def _(spark, sf):
    return matrix.word_frequency(table(spark, sf, "documents"), "text")



@query("pairwise_distance", """
WITH c AS (SELECT label, list(m ORDER BY j) AS centre FROM (
  SELECT label, j, avg(v) AS m FROM (SELECT label, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY ALL) GROUP BY 1)
SELECT e.vec_id, c.label, round(list_distance(e.embedding::DOUBLE[], c.centre::DOUBLE[]), 6) AS distance FROM embeddings e, c""")
def _(spark, sf):
    """Distance of every vector to the mean vector of every label."""
    e = table(spark, sf, "embeddings")
    means = e.select("label", F.posexplode("embedding").alias("j", "v")).groupBy("label", "j").agg(F.avg(F.col("v").cast("double")).alias("m"))
    centres = means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "m"))), lambda s: s["m"]).alias("centre"))
    return rounded(matrix.pairwise_distance(e, "vec_id", "embedding", centres, "label", "centre"))
