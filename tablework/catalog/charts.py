from pyspark.sql import functions as F

from tablework.catalog.registry import GAPPY_ORDERS_SQL, SCORED_DOCS_SQL, gappy_orders, query, rounded, scored_docs, table
from tablework.ml import metrics
from tablework.operators import charts


@query("hist_data", f"""
WITH s AS (SELECT least(20, greatest(5, count(o_totalprice) // 3)) AS bins, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
  avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM {GAPPY_ORDERS_SQL}),
c AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / bins)), bins - 1) AS BIGINT) AS bin, count(*) AS n
  FROM {GAPPY_ORDERS_SQL}, s WHERE o_totalprice IS NOT NULL GROUP BY 1),
g AS (SELECT unnest(range((SELECT bins FROM s))) AS bin)
SELECT g.bin, round(lo + g.bin * (hi - lo) / bins, 4) AS bin_start, round(lo + (g.bin + 1) * (hi - lo) / bins, 4) AS bin_end,
  round(m, 4) AS mean, round(m - sd, 4) AS mark_low, round(m + sd, 4) AS mark_high, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.bin = c.bin, s""")
def _(spark, sf):
    return rounded(charts.hist_data(gappy_orders(spark, sf), "o_totalprice"), 4)


_BOX = """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS md, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY 1)"""


@query("box_data", _BOX + """
SELECT v.event_type, round(any_value(q1), 4) AS q1, round(any_value(md), 4) AS median, round(any_value(q3), 4) AS q3,
  round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
  round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
  count(*) FILTER (value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM events v JOIN q ON v.event_type = q.event_type GROUP BY 1""")
def _(spark, sf):
    return rounded(charts.box_data(table(spark, sf, "events"), "value", "event_type"), 4)


@query("box_outliers", _BOX + """
SELECT event_id, v.event_type, value FROM events v JOIN q ON v.event_type = q.event_type
WHERE value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def _(spark, sf):
    return charts.box_outliers(table(spark, sf, "events").select("event_id", "event_type", "value"), "value", "event_type")


@query("scatter_data", """
SELECT p_partkey, p_size, p_retailprice, round((SELECT corr(p_size, p_retailprice) FROM part), 6) AS r FROM part""")
def _(spark, sf):
    return rounded(charts.scatter_data(table(spark, sf, "part"), "p_size", "p_retailprice", "p_partkey"))


@query("bar_data", f"""
SELECT o_orderpriority, coalesce(round(sum(o_totalprice), 2), 0) AS height FROM {GAPPY_ORDERS_SQL}
WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return rounded(charts.bar_data(gappy_orders(spark, sf), "o_orderpriority", "o_totalprice"), 2)


@query("count_data", f"SELECT o_orderstatus, count(*) AS height FROM {GAPPY_ORDERS_SQL} WHERE o_orderstatus IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return charts.count_data(gappy_orders(spark, sf), "o_orderstatus")


@query("line_data", """
SELECT last_day(CAST(o_orderdate AS DATE)) AS period, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def _(spark, sf):
    return rounded(charts.line_data(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"), 2)


@query("dashboard_data", """
WITH s AS (SELECT min(p_retailprice) AS lo, (max(p_retailprice) - min(p_retailprice)) / 15 AS w FROM part)
SELECT 'histogram' AS panel, CAST(CAST(least(floor((p_retailprice - lo) / w), 14) AS BIGINT) AS VARCHAR) AS item, count(*)::DOUBLE AS value
FROM part, s GROUP BY 2
UNION ALL SELECT 'box', p_type, round(median(p_retailprice), 4) FROM part GROUP BY 2
UNION ALL SELECT 'scatter', 'points', count(*)::DOUBLE FROM part
UNION ALL SELECT 'bar', p_type, count(*)::DOUBLE FROM part GROUP BY 2""")
def _(spark, sf):
    panels = charts.dashboard_data(table(spark, sf, "part"), "p_size", "p_retailprice", "p_type", "p_partkey")
    row = lambda d, panel, item, value: d.select(
        F.lit(panel).alias("panel"), item.cast("string").alias("item"), value.cast("double").alias("value"))
    points = panels["scatter"].agg(F.count("*").alias("n"))
    out = row(panels["histogram"], "histogram", F.col("bin"), F.col("n")).unionByName(
        row(panels["box"], "box", F.col("p_type"), F.col("median"))).unionByName(
        row(points, "scatter", F.lit("points"), F.col("n"))).unionByName(
        row(panels["bar"], "bar", F.col("p_type"), F.col("height")))
    return rounded(out, 4)


_HEAT = ("l_quantity", "l_extendedprice", "l_discount")


@query("heatmap_data", "\nUNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, " + ("1.0::DOUBLE AS r" if a == b else f"round(corr({a}, {b}), 2) AS r FROM lineitem")
    for a in _HEAT for b in _HEAT))
def _(spark, sf):
    return charts.heatmap_data(table(spark, sf, "lineitem"), _HEAT)


@query("pairplot_data", """
SELECT p_partkey, p_type, 'p_size' AS x_name, 'p_retailprice' AS y_name, p_size::DOUBLE AS x, p_retailprice AS y FROM part""")
def _(spark, sf):
    return charts.pairplot_points(table(spark, sf, "part"), ["p_size", "p_retailprice"], "p_type", "p_partkey")


@query("pairplot_hist", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, p_type, CAST(least(floor(({c} - lo) / ((hi - lo) / 10)), 9) AS BIGINT) AS bin, count(*) AS n
FROM part, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM part) GROUP BY ALL""" for c in ("p_size", "p_retailprice")))
def _(spark, sf):
    return charts.pairplot_hist(table(spark, sf, "part"), ["p_size", "p_retailprice"], "p_type")


@query("violin_data", """
WITH s AS (SELECT l_returnflag, count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi, stddev_samp(l_quantity) * count(*) ** -0.2 AS h
  FROM lineitem GROUP BY 1),
c AS (SELECT l_returnflag, l_quantity AS m, count(*) AS c FROM lineitem GROUP BY ALL),
g AS (SELECT *, unnest(range(100)) AS point FROM s),
x AS (SELECT *, (lo - 2 * h) + point * ((hi - lo + 4 * h) / 99) AS x FROM g)
SELECT x.l_returnflag, point::INTEGER AS point, round(x.x, 6) AS x, round(sum(c * exp(-0.5 * ((x.x - m) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM x JOIN c ON x.l_returnflag = c.l_returnflag GROUP BY ALL""")
def _(spark, sf):
    return rounded(charts.violin_data(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag"))


@query("regression_line_data", """
WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
  corr(l_quantity, l_extendedprice) AS r, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT k AS point, round(lo + (hi - lo) * k / 99, 6) AS x, round(a + b * (lo + (hi - lo) * k / 99), 4) AS fit,
  round(b, 4) AS slope, round(a, 4) AS intercept, round(r, 6) AS r FROM s, (SELECT unnest(range(100)) AS k)""")
def _(spark, sf):
    out = charts.regression_line_data(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(out.drop("band_low", "band_high"), 4, x=6, r=6)


@query("regression_band", """
WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS mx, var_pop(l_quantity) AS vx, var_pop(l_extendedprice) AS vy, covar_pop(l_quantity, l_extendedprice) AS c,
  regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
p AS (SELECT k, lo + (hi - lo) * k / 99 AS x, a, b, mx, vx, n, sqrt((vy - b * c) * n / (n - 2)) AS e FROM s, (SELECT unnest(range(100)) AS k))
SELECT k AS point, round(x, 6) AS x, round(a + b * x - 1.959963984540054 * e * sqrt(1 / n + (x - mx) ** 2 / (n * vx)), 4) AS band_low,
  round(a + b * x + 1.959963984540054 * e * sqrt(1 / n + (x - mx) ** 2 / (n * vx)), 4) AS band_high FROM p""")
def _(spark, sf):
    out = charts.regression_line_data(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(out.select("point", "x", "band_low", "band_high"), 4, x=6)


@query("residual_data", """
SELECT l_extendedprice AS actual, round(l_quantity * 2100, 2) AS predicted, round(l_extendedprice - l_quantity * 2100, 2) AS residual FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 2100)
    return rounded(charts.residual_data(li, "l_extendedprice", "guess"), 2)


@query("roc_data", f"""
WITH s AS (SELECT score, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS n FROM {SCORED_DOCS_SQL} GROUP BY 1)
SELECT round(score, 9) AS score, round(sum(n) OVER w / (SELECT sum(n) FROM s), 9) AS fpr, round(sum(p) OVER w / (SELECT sum(p) FROM s), 9) AS tpr
FROM s WINDOW w AS (ORDER BY score DESC)
UNION ALL SELECT 'infinity'::DOUBLE, 0, 0""")
def _(spark, sf):
    return rounded(metrics.roc_data(scored_docs(spark, sf), "quality", "score"), 9)


@query("confusion_data", f"""
SELECT a AS actual, p AS predicted, count(*) FILTER (quality = a AND (score >= 0.5)::INTEGER = p) AS n
FROM {SCORED_DOCS_SQL}, (VALUES (0), (1)) AS x(a), (VALUES (0), (1)) AS y(p) GROUP BY ALL""")
def _(spark, sf):
    docs = scored_docs(spark, sf).withColumn("guess", (F.col("score") >= 0.5).cast("int"))
    return charts.confusion_data(docs, "quality", "guess")
