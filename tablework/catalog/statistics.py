from pyspark.sql import functions as F

from tablework.catalog.registry import GAPPY_ORDERS_SQL, gappy_orders, query, rounded, table
from tablework.functions.semantics import words
from tablework.operators import stats
from tablework.plans import reports

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("percentile_linear", "\nUNION ALL ".join(
    f"SELECT {p}.0::DOUBLE AS pct, round(quantile_cont(l_extendedprice, {p / 100}), 4) AS value FROM lineitem" for p in (0, 10, 25, 50, 90, 100)))
def _(spark, sf):
    return rounded(stats.percentile_linear(table(spark, sf, "lineitem"), "l_extendedprice", [0, 10, 25, 50, 90, 100]), 4)


@query("central_tendency", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, round(median({c}), 4) AS median,
  (SELECT {c} FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM lineitem""" for c in _NUMBERS))
def _(spark, sf):
    return rounded(stats.central_tendency(table(spark, sf, "lineitem"), _NUMBERS), 4, mode=6)


@query("spread", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, round(var_pop({c}), {d}) AS var_pop, round(var_samp({c}), {d}) AS var_samp,
  round(stddev_pop({c}), {d}) AS stddev_pop, round(stddev_samp({c}), {d}) AS stddev_samp,
  round(max({c}) - min({c}), {d}) AS value_range, round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), {d}) AS iqr
FROM lineitem""" for c, d in (("l_quantity", 4), ("l_discount", 4))))
def _(spark, sf):
    return rounded(stats.spread(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"]), 4)


@query("numeric_profile", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, round(stddev_samp({c}), 4) AS std,
  round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS q25,
  round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem""" for c in _NUMBERS))
def _(spark, sf):
    return rounded(stats.numeric_profile(table(spark, sf, "lineitem"), _NUMBERS), 4)


@query("simple_probability", "SELECT round(avg(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END), 9) AS probability FROM events")
def _(spark, sf):
    return rounded(stats.simple_probability(table(spark, sf, "events"), F.col("event_type") == "purchase"), 9)


@query("conditional_probability", """
SELECT round(count(*) FILTER (value > 50 AND event_type = 'click') / count(*) FILTER (event_type = 'click'), 9) AS probability FROM events""")
def _(spark, sf):
    return rounded(stats.conditional_probability(table(spark, sf, "events"), F.col("value") > 50, F.col("event_type") == "click"), 9)


@query("bayes_posterior", r"""
WITH d AS (SELECT d.doc_id, l.toxic, list_distinct(regexp_extract_all(lower(d.text), '[\p{L}\p{N}_]+')) AS ws
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
t AS (SELECT count(*) AS n, count(*) FILTER (toxic = 1) AS pos FROM d),
w AS (SELECT word, count(*) AS docs, count(*) FILTER (toxic = 1) AS hits FROM (SELECT toxic, unnest(ws) AS word FROM d) GROUP BY 1)
SELECT word, docs, round(pos / n, 9) AS prior, round(hits / pos, 9) AS likelihood, round(docs / n, 9) AS evidence,
  round((hits / pos) * (pos / n) / (docs / n), 9) AS posterior FROM w, t""")
def _(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "toxic", words("text").alias("ws"))
    return rounded(stats.bayes_posterior(docs, "doc_id", "ws", "toxic"), 9)


@query("high_value_given_category", """
WITH m AS (SELECT median(o_totalprice) AS v FROM orders), n AS (SELECT count(*) AS n FROM orders)
SELECT o_orderpriority, round(avg(CASE WHEN o_totalprice > v THEN 1 ELSE 0 END), 9) AS p_high_given_category,
  round(count(*) / any_value(n), 9) AS p_category,
  round((SELECT avg(CASE WHEN o_totalprice > v THEN 1 ELSE 0 END) FROM orders, m), 9) AS p_high
FROM orders, m, n GROUP BY 1""")
def _(spark, sf):
    return rounded(stats.high_value_given_category(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority"), 9)


@query("zscore_normalize", """
SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 6) AS p_size,
  round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS p_retailprice FROM part""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(stats.zscore_normalize(part, ["p_size", "p_retailprice"]))


@query("zscores", "SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS z FROM events")
def _(spark, sf):
    return rounded(stats.zscores(table(spark, sf, "events"), "value").select("event_id", "z"))


@query("zscore_outliers", """
WITH z AS (SELECT event_id, value, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS z FROM events)
SELECT event_id, value, round(z, 6) AS z, t AS threshold FROM z, (VALUES (2.0::DOUBLE), (3.0::DOUBLE)) AS v(t) WHERE abs(z) > t""")
def _(spark, sf):
    return rounded(stats.zscore_outliers(table(spark, sf, "events").select("event_id", "value"), "value"))


@query("iqr_outliers", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
SELECT event_id, value FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""")
def _(spark, sf):
    return stats.iqr_outliers(table(spark, sf, "events").select("event_id", "value"), "value")


@query("outlier_counts", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS n_outliers
FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM lineitem)""" for c in _NUMBERS))
def _(spark, sf):
    return stats.outlier_counts(table(spark, sf, "lineitem"), _NUMBERS)


@query("pearson", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem")
def _(spark, sf):
    return rounded(stats.pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1:]]


@query("pair_correlations", "\nUNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in _PAIRS))
def _(spark, sf):
    return rounded(stats.pair_correlations(table(spark, sf, "lineitem"), _NUMBERS))


@query("corr_matrix", "\nUNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
    + ("1.0::DOUBLE AS r" if a == b else f"round(corr({a}, {b}), 6) AS r FROM lineitem") for a in _NUMBERS for b in _NUMBERS))
def _(spark, sf):
    return rounded(stats.corr_matrix(table(spark, sf, "lineitem"), _NUMBERS))


def _rank(c: str) -> str:
    return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)::DOUBLE"


def _two_sided(rho: str, n: str) -> str:
    """p-value of a rank correlation: one less twice the integral of Student's density, by Simpson's rule on 4,000 steps."""
    nu, t = f"({n} - 2)", f"least(40.0, abs({rho}) * sqrt(({n} - 2) / greatest(1 - {rho} * {rho}, 1e-300)))"
    weight = "CASE WHEN k IN (0, 4000) THEN 1.0 WHEN k % 2 = 1 THEN 4.0 ELSE 2.0 END"
    density = f"exp(lgamma(({nu} + 1) / 2) - lgamma({nu} / 2)) / sqrt({nu} * pi())"
    tail = f"(1 + (k * ({t}) / 4000) ** 2 / {nu}) ** (-({nu} + 1) / 2)"
    return f"1 - 2 * {density} * ({t}) / 12000 * list_sum(list_transform(range(0, 4001), lambda k: {weight} * {tail}))"


@query("corr_report", "\nUNION ALL ".join(f"""
SELECT '{a}' AS column_a, '{b}' AS column_b, (SELECT round(corr({a}, {b}), 6) FROM lineitem) AS pearson,
  round(rho, 6) AS spearman, greatest(0.0, round({_two_sided('rho', 'n')}, 6)) AS p_value
FROM (SELECT corr(x, y) AS rho, count(*)::DOUBLE AS n FROM (SELECT {_rank(a)} AS x, {_rank(b)} AS y FROM lineitem))""" for a, b in _PAIRS))
def _(spark, sf):
    return rounded(stats.corr_report(table(spark, sf, "lineitem"), _NUMBERS))


@query("corr_extremes", f"""
WITH p AS ({' UNION ALL '.join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS r FROM lineitem" for a, b in _PAIRS)})
SELECT column_a, column_b, round(r, 6) AS r, 'strongest' AS kind FROM (SELECT * FROM p ORDER BY abs(r) DESC LIMIT 2)
UNION ALL SELECT column_a, column_b, round(r, 6), 'weakest' FROM (SELECT * FROM p ORDER BY abs(r) LIMIT 2)""")
def _(spark, sf):
    pairs = stats.pair_correlations(table(spark, sf, "lineitem"), _NUMBERS)
    return rounded(stats.corr_extremes(pairs, "r", 2))


@query("spearman", f"""
SELECT round(corr(x, y), 6) AS rho, count(*) AS n
FROM (SELECT {_rank('o_totalprice')} AS x, {_rank('o_custkey')} AS y FROM {GAPPY_ORDERS_SQL} WHERE o_totalprice IS NOT NULL)""")
def _(spark, sf):
    return rounded(stats.spearman(gappy_orders(spark, sf), "o_totalprice", "o_custkey"))


@query("spearman_pvalue", f"""
SELECT round(rho, 6) AS rho, n, round({_two_sided('rho', 'n')}, 6) AS p_value
FROM (SELECT corr(x, y) AS rho, count(*) AS n FROM (SELECT {_rank('l_discount')} AS x, {_rank('l_tax')} AS y FROM lineitem))""")
def _(spark, sf):
    return rounded(stats.spearman_pvalue(table(spark, sf, "lineitem"), "l_discount", "l_tax"))


@query("normal_fit", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std FROM lineitem" for c in _NUMBERS))
def _(spark, sf):
    return rounded(stats.normal_fit(table(spark, sf, "lineitem"), _NUMBERS), 4)


@query("normality_test")
def _(spark, sf):
    return stats.normality_test(table(spark, sf, "customer"), "c_acctbal")


@query("normality_large", """
WITH m AS (SELECT avg(l_extendedprice) AS a FROM lineitem),
c AS (SELECT count(*) AS n, avg((l_extendedprice - a) ** 2) AS m2, avg((l_extendedprice - a) ** 3) AS m3, avg((l_extendedprice - a) ** 4) AS m4
  FROM lineitem, m)
SELECT 'l_extendedprice' AS column_name, 'jarque-bera' AS method, n,
  round(n / 6 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4), 4) AS statistic, false AS is_normal FROM c""")
def _(spark, sf):
    out = stats.normality_test(table(spark, sf, "lineitem"), "l_extendedprice", method="jarque-bera")
    return rounded(out.select("column_name", "method", "n", "statistic", "is_normal"), 4)


@query("cross_check", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 4) AS value_a, round(avg({c}), 4) AS value_b, 'OK' AS status FROM lineitem" for c in _NUMBERS))
def _(spark, sf):
    """Column means against means rebuilt from per-flag sums and counts."""
    li = table(spark, sf, "lineitem")
    ours = stats.normal_fit(li, _NUMBERS).select("column_name", F.col("mean").alias("value"))
    parts = li.groupBy("l_returnflag").agg(*[F.sum(c).alias(c) for c in _NUMBERS], F.count("*").alias("n"))
    wide = parts.agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in _NUMBERS])
    return rounded(stats.cross_check(ours, wide.unpivot([], list(_NUMBERS), "column_name", "value"), ["column_name"], "value"), 4)


_LINES = ("l_quantity", "l_extendedprice", "l_discount")


@query("eda_report", "\nUNION ALL ".join([
    "SELECT 'shape' AS section, 'table' AS item, 'n_rows' AS metric, count(*)::DOUBLE AS value FROM lineitem",
    *[f"SELECT 'value_counts', '{c}', {c}, count(*)::DOUBLE FROM lineitem GROUP BY ALL" for c in ("l_returnflag", "l_linestatus")],
    *[f"SELECT 'numeric_profile', '{c}', 'median', round(median({c}), 4) FROM lineitem" for c in _LINES],
    *[f"SELECT 'numeric_profile', '{c}', 'std', round(stddev_samp({c}), 4) FROM lineitem" for c in _LINES],
    *[f"SELECT 'outliers', '{c}', 'n', (count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)))::DOUBLE "
      f"FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM lineitem)" for c in _LINES],
    *[f"SELECT 'correlation', '{a}', '{b}', round(corr({a}, {b}), 4) FROM lineitem" for a in _LINES for b in _LINES if a != b],
    "SELECT 'pivot', l_returnflag, l_linestatus, round(avg(l_quantity), 4) FROM lineitem GROUP BY ALL",
    """SELECT 'tiers', 'l_quantity', CASE WHEN l_quantity <= a THEN 'Low' WHEN l_quantity <= b THEN 'Medium' ELSE 'High' END, count(*)::DOUBLE
FROM lineitem, (SELECT quantile_cont(l_quantity, 0.33) AS a, quantile_cont(l_quantity, 0.66) AS b FROM lineitem) GROUP BY ALL"""]))
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*_LINES, "l_returnflag", "l_linestatus")
    rep = reports.eda_report(li, pivots=[("l_returnflag", "l_linestatus", "l_quantity", "mean")], tier_column="l_quantity")
    row = lambda d, section, item, metric, value: d.select(
        F.lit(section).alias("section"), item.alias("item"), metric.alias("metric"), value.cast("double").alias("value"))
    profile = rep["numeric_profile"]
    pivot = rep["pivot_l_returnflag_by_l_linestatus_mean_l_quantity"]
    pivot = pivot.unpivot(["l_returnflag"], [c for c in pivot.columns if c != "l_returnflag"], "metric", "value").filter("value IS NOT NULL")
    parts = [
        row(rep["shape"], "shape", F.lit("table"), F.lit("n_rows"), F.col("n_rows")),
        row(rep["value_counts"], "value_counts", F.col("column_name"), F.col("value"), F.col("n")),
        row(profile, "numeric_profile", F.col("column_name"), F.lit("median"), F.col("median")),
        row(profile, "numeric_profile", F.col("column_name"), F.lit("std"), F.col("std")),
        row(rep["outliers"], "outliers", F.col("column_name"), F.lit("n"), F.col("n_outliers")),
        row(rep["correlation"].filter("column_a <> column_b"), "correlation", F.col("column_a"), F.col("column_b"), F.col("r")),
        row(pivot, "pivot", F.col("l_returnflag"), F.col("metric"), F.col("value")),
        row(rep["tiers"], "tiers", F.lit("l_quantity"), F.col("tier"), F.col("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out, 4)


@query("eda_insights", """
WITH s AS (SELECT avg(o_totalprice) AS m, median(o_totalprice) AS md, count(*) AS n FROM orders),
p AS (SELECT o_orderpriority AS k, avg(o_totalprice) AS v FROM orders GROUP BY 1),
b AS (SELECT * FROM p ORDER BY v DESC, k LIMIT 1), w AS (SELECT * FROM p ORDER BY v, k LIMIT 1),
q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders),
o AS (SELECT count(*) AS c FROM orders, q WHERE o_totalprice < a - 1.5 * (b - a) OR o_totalprice > b + 1.5 * (b - a)),
st AS (SELECT avg(CASE WHEN o_orderstatus = 'F' THEN 100 ELSE 0 END) AS f, avg(CASE WHEN o_orderstatus = 'P' THEN 100 ELSE 0 END) AS p FROM orders),
e AS (SELECT quantile_cont(o_totalprice, 0.33) AS x, quantile_cont(o_totalprice, 0.66) AS y FROM orders),
t AS (SELECT CASE WHEN o_totalprice <= x THEN 'Low' WHEN o_totalprice <= y THEN 'Medium' ELSE 'High' END AS tier, count(*) AS c
  FROM orders, e GROUP BY 1 ORDER BY c DESC, tier LIMIT 1)
SELECT 1::BIGINT AS line_no, printf('Mean o_totalprice %.2f lies %s the median %.2f: %s-skewed.', m,
  CASE WHEN m > md THEN 'above' ELSE 'not above' END, md, CASE WHEN m > md THEN 'right' ELSE 'left' END) AS line FROM s
UNION ALL SELECT 2, printf('o_orderpriority %s has the highest mean o_totalprice (%.2f), %.2f%% above %s (%.2f).', b.k, b.v, (b.v / w.v - 1) * 100, w.k, w.v) FROM b, w
UNION ALL SELECT 3, CASE WHEN c = 0 THEN 'No numeric column has values outside the IQR fences.'
  ELSE printf('%d values in 1 columns (o_totalprice) lie outside the IQR fences.', c) END FROM o
UNION ALL SELECT 4, printf('%.1f%% of rows have o_orderstatus F and %.1f%% have P.', f, p) FROM st
UNION ALL SELECT 5, printf('The %s tier of o_totalprice is the largest: %d of %d rows (%.1f%%).', tier, c, n, 100.0 * c / n) FROM t, s""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_totalprice", "o_orderpriority", "o_orderstatus")
    return reports.eda_insights(orders, "o_totalprice", "o_orderpriority", "o_orderstatus", "F", "P")


def _outlier_sql(c: str) -> str:
    return f"(SELECT count(*) FROM lineitem, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM lineitem) WHERE abs(({c} - m) / s) > 2)"


def _bera_sql(c: str) -> str:
    """Whether the Jarque-Bera test, which the table is large enough for, rejects normality."""
    return f"""(SELECT exp(-(n / 6 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4)) / 2) <= 0.05
  FROM (SELECT count(*) AS n, avg(({c} - a) ** 2) AS m2, avg(({c} - a) ** 3) AS m3, avg(({c} - a) ** 4) AS m4
    FROM lineitem, (SELECT avg({c}) AS a FROM lineitem)))"""


_FINDING_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount")]


@query("business_insights", f"""
WITH v AS (SELECT avg(l_extendedprice) AS m, median(l_extendedprice) AS md, stddev_samp(l_extendedprice) AS s, max(l_extendedprice) - min(l_extendedprice) AS r,
  avg(l_quantity) AS qm, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS qi FROM lineitem),
qmode AS (SELECT l_quantity AS x FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
p AS ({' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for a, b in _FINDING_PAIRS)}),
hi AS (SELECT * FROM p ORDER BY abs(r) DESC LIMIT 1), lo AS (SELECT * FROM p ORDER BY abs(r) LIMIT 1),
rej AS (SELECT string_agg(c, ' and ' ORDER BY c) AS names FROM (SELECT 'l_quantity' AS c, {_bera_sql('l_quantity')} AS x
  UNION ALL SELECT 'l_extendedprice', {_bera_sql('l_extendedprice')}) WHERE x),
o AS (SELECT {' + '.join(_outlier_sql(c) for c in ('l_quantity', 'l_extendedprice', 'l_discount'))} AS n),
g AS (SELECT l_returnflag AS k, count(*) AS n, median(l_extendedprice) AS m FROM lineitem GROUP BY 1),
g1 AS (SELECT * FROM g ORDER BY n DESC, k LIMIT 1), g2 AS (SELECT * FROM g ORDER BY n, k DESC LIMIT 1),
d1 AS (SELECT * FROM g ORDER BY m DESC, k LIMIT 1), d2 AS (SELECT * FROM g ORDER BY m, k DESC LIMIT 1)
SELECT 1::BIGINT AS line_no, printf('Finding 1: l_extendedprice averages %.2f (median %.2f, sample std %.2f, range %.2f).', m, md, s, r) AS line FROM v
UNION ALL SELECT 2, printf('Finding 2: l_quantity averages %.1f (mode %.0f, interquartile range %.2f).', qm, x, qi) FROM v, qmode
UNION ALL SELECT 3, printf('Finding 3: Strongest pair: %s and %s (r %+.3f); weakest: %s and %s (r %+.3f). %s', hi.a, hi.b, hi.r, lo.a, lo.b, lo.r,
  CASE WHEN abs(hi.r) >= 0.3 THEN 'At least one pair is clearly related.' ELSE 'No pair is clearly related.' END) FROM hi, lo
UNION ALL SELECT 4, coalesce('Finding 4: Normality is rejected for ' || names || '.', 'Finding 4: Normality is not rejected for any tested column.') FROM rej
UNION ALL SELECT 5, printf('Finding 5: %d values lie more than 2 standard deviations from their mean%s', n, CASE WHEN n > 0 THEN ', worth a review.' ELSE '.' END) FROM o
UNION ALL SELECT 6, printf('Finding 6: l_returnflag %s has the most rows (%d), %s the fewest (%d), a factor of %.1f.', g1.k, g1.n, g2.k, g2.n, g1.n / g2.n) FROM g1, g2
UNION ALL SELECT 7, printf('Finding 7: l_returnflag %s has the highest median l_extendedprice (%.2f), %s the lowest (%.2f), %.2f apart.', d1.k, d1.m, d2.k, d2.m, d1.m - d2.m) FROM d1, d2
UNION ALL SELECT 8, CASE WHEN abs(r) >= 0.3 THEN printf('Recommendation 1: Use %s and %s together in a model.', a, b)
  ELSE 'Recommendation 1: Collect further features before modelling: the numeric columns hardly explain one another.' END FROM hi
UNION ALL SELECT 9, coalesce('Recommendation 2: Use rank-based tests for ' || names || ', or transform them first.',
  'Recommendation 2: Tests that assume a normal distribution are acceptable here.') FROM rej
UNION ALL SELECT 10, printf('Recommendation 3: Find out why %s has %d rows against %d of %s.', g2.k, g2.n, g1.n, g1.k) FROM g1, g2""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    summary = reports.stats_summary(li, ["l_quantity", "l_extendedprice", "l_discount"], "l_extendedprice", "l_quantity", "l_returnflag")
    found, advice = reports.business_insights(summary, "l_extendedprice", "l_quantity", "l_returnflag")
    return reports.lines_table(spark, reports.insights_lines(found, advice))


@query("business_numbers", """
WITH c AS (SELECT l_returnflag AS k, count(*) AS n, median(l_extendedprice) AS m FROM lineitem GROUP BY 1),
s AS (SELECT avg(l_extendedprice) AS a, stddev_pop(l_extendedprice) AS d, avg(l_quantity) AS qa, stddev_pop(l_quantity) AS qd FROM lineitem)
SELECT (SELECT k FROM c ORDER BY n DESC, k LIMIT 1) AS busiest, (SELECT max(n) FROM c) AS busiest_rows,
  (SELECT k FROM c ORDER BY m DESC, k LIMIT 1) AS dearest, round((SELECT max(m) FROM c), 4) AS dearest_median,
  round((SELECT avg(l_extendedprice) FROM lineitem), 4) AS mean, round((SELECT median(l_extendedprice) FROM lineitem), 4) AS median,
  (SELECT count(*) FROM lineitem, s WHERE abs((l_extendedprice - a) / d) > 2) + (SELECT count(*) FROM lineitem, s WHERE abs((l_quantity - qa) / qd) > 2) AS outliers""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_returnflag")
    s = reports.stats_summary(li, ["l_quantity", "l_extendedprice"], "l_extendedprice", "l_quantity", "l_returnflag")
    v = s.central["l_extendedprice"]
    row = (*s.busiest, *s.dearest, v["mean"], v["median"], s.outliers)
    out = spark.createDataFrame([row], "busiest string, busiest_rows long, dearest string, dearest_median double, mean double, median double, outliers long")
    return rounded(out, 4)


@query("student_report", """
WITH s AS (SELECT p_partkey, p_size, p_retailprice, (p_size + p_retailprice) / 2 AS average FROM part)
SELECT 2::BIGINT AS line_no, printf('p_size: mean %.2f, median %.2f, std %.2f, min %.2f, max %.2f', avg(p_size), median(p_size),
  stddev_pop(p_size), min(p_size)::DOUBLE, max(p_size)::DOUBLE) AS line FROM s
UNION ALL SELECT 1, printf('p_retailprice: mean %.2f, median %.2f, std %.2f, min %.2f, max %.2f', avg(p_retailprice), median(p_retailprice),
  stddev_pop(p_retailprice), min(p_retailprice), max(p_retailprice)) FROM s
UNION ALL SELECT 2 + k, printf('top %d: %d with %.2f', k, p_partkey, average)
  FROM (SELECT *, row_number() OVER (ORDER BY average DESC, p_partkey) AS k FROM s) WHERE k <= 5
UNION ALL SELECT 8, printf('at risk: %d', count(*)) FROM s WHERE average < 500""")
def _(spark, sf):
    report = reports.student_report(table(spark, sf, "part"), "p_partkey", ["p_size", "p_retailprice"], 500.0)
    return reports.student_lines(report, "p_partkey")


@query("student_ranks", """
SELECT p_partkey, round((p_size + p_retailprice) / 2, 6) AS average,
  row_number() OVER (ORDER BY (p_size + p_retailprice) / 2 DESC, p_partkey DESC) - 1 AS rank FROM part""")
def _(spark, sf):
    report = reports.student_report(table(spark, sf, "part"), "p_partkey", ["p_size", "p_retailprice"], 500.0)
    return rounded(report["ranks"])


_PARTS = ("dashboard_histogram", "dashboard_box", "dashboard_scatter", "dashboard_bar", "heatmap", "histogram", "boxplot", "violin", "scatter",
          "regression", "bar", "count", "line", "pairplot", "summary")


def _bins_sql(part: str, bins: int) -> str:
    width = f"((b - a) / {bins})"
    return f"""SELECT '{part}', k::VARCHAR, 'n', (SELECT count(*) FROM o WHERE least(floor((o_totalprice - a) / {width}), {bins - 1}) = k)::DOUBLE FROM e, range({bins}) AS r(k)"""


def _box_sql(part: str) -> str:
    return f"""SELECT '{part}', o_orderpriority, m, v FROM (SELECT o_orderpriority, unnest(['q1', 'median', 'q3', 'n_outliers']) AS m,
  unnest([any_value(q1), any_value(md), any_value(q3), count(*) FILTER (o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1))::DOUBLE]) AS v
  FROM o JOIN (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS md, quantile_cont(o_totalprice, 0.75) AS q3 FROM o GROUP BY 1)
    USING (o_orderpriority) GROUP BY 1)"""


@query("full_report", f"""
WITH o AS (SELECT *, datediff('day', CAST(o_orderdate AS DATE), DATE '2003-01-01')::DOUBLE AS age FROM orders),
e AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b, min(age) AS c, max(age) AS d FROM o),
f AS (SELECT regr_slope(age, o_totalprice) AS s, corr(age, o_totalprice) AS r FROM o),
h AS (SELECT 'o_totalprice' AS n, o_orderpriority AS p, least(floor((o_totalprice - a) / ((b - a) / 10)), 9) AS bin FROM o, e
  UNION ALL SELECT 'age', o_orderpriority, least(floor((age - c) / ((d - c) / 10)), 9) FROM o, e),
v AS (SELECT 1 AS x),
parts AS (
{_bins_sql('dashboard_histogram', 15)}
UNION ALL {_bins_sql('histogram', 20)}
UNION ALL {_box_sql('dashboard_box')}
UNION ALL {_box_sql('boxplot')}
UNION ALL SELECT unnest(['dashboard_bar', 'bar', 'count']), o_orderpriority, 'height', count(*)::DOUBLE FROM o GROUP BY o_orderpriority
UNION ALL SELECT unnest(['dashboard_scatter', 'scatter']), 'all', unnest(['points', 'points']), count(*)::DOUBLE FROM o
UNION ALL SELECT unnest(['dashboard_scatter', 'scatter']), 'all', unnest(['r', 'r']), any_value(r) FROM f
UNION ALL SELECT 'heatmap', x, y, round(CASE WHEN x = y THEN 1.0 ELSE r END, 2) FROM f, (VALUES ('o_totalprice'), ('age')) AS a(x), (VALUES ('o_totalprice'), ('age')) AS b(y)
UNION ALL SELECT 'line', CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR), 'total', sum(o_totalprice) FROM o GROUP BY 2
UNION ALL SELECT 'pairplot', n || ' ' || p, bin::BIGINT::VARCHAR, count(*)::DOUBLE FROM h GROUP BY n, p, bin
UNION ALL SELECT 'regression', 'all', unnest(['slope', 'r']), unnest([regr_slope(o_totalprice, age), corr(age, o_totalprice)]) FROM o
UNION ALL SELECT 'summary', n, m, x FROM (SELECT n, unnest(['count', 'mean', 'std', 'min', 'max', 'q25', 'q50', 'q75']) AS m,
  unnest([count(*)::DOUBLE, avg(w), stddev_samp(w), min(w), max(w), quantile_cont(w, 0.25), median(w), quantile_cont(w, 0.75)]) AS x
  FROM (SELECT 'o_totalprice' AS n, o_totalprice AS w FROM o UNION ALL SELECT 'age', age FROM o) GROUP BY n)
UNION ALL SELECT 'violin', o_orderpriority, 'points', 100.0 FROM o GROUP BY 2
UNION ALL SELECT 'insights', 'all', 'lines', 10.0)
SELECT part, item, metric, round(value, 4) AS value FROM parts AS p(part, item, metric, value)""")
def _(spark, sf):
    """What the report wrote, read back: every number of its tables, but of points and densities their number."""
    from tablework.operators.order import scratch_path

    orders = table(spark, sf, "orders").withColumn("age", F.datediff(F.lit("2003-01-01").cast("date"), F.to_date("o_orderdate")).cast("double"))
    path = scratch_path(spark, "full-report")
    reports.full_report(orders, path, "o_totalprice", "age", ["o_totalprice", "age"], "o_orderpriority", "o_orderdate", "o_orderkey")
    read = {p: spark.read.json(f"{path}/{p}") for p in _PARTS}
    long = lambda d, part, item, metric, value: d.select(
        F.lit(part).alias("part"), item.cast("string").alias("item"), metric.cast("string").alias("metric"), value.cast("double").alias("value"))
    tall = lambda part, item, columns: long(
        read[part].unpivot([item], list(columns), "metric", "value"), part, F.col(item), F.col("metric"), F.col("value"))
    out = [long(read[p], p, F.col("bin"), F.lit("n"), F.col("n")) for p in ("dashboard_histogram", "histogram")]
    boxes = {p: read[p].withColumns({c: F.col(c).cast("double") for c in ("q1", "median", "q3", "n_outliers")}) for p in ("dashboard_box", "boxplot")}
    out += [long(d.unpivot(["o_orderpriority"], ["q1", "median", "q3", "n_outliers"], "metric", "value"), p, F.col("o_orderpriority"), F.col("metric"), F.col("value"))
            for p, d in boxes.items()]
    out += [tall(p, "o_orderpriority", ["height"]) for p in ("dashboard_bar", "bar", "count")]
    for p in ("dashboard_scatter", "scatter"):
        out.append(long(read[p].agg(F.count("*").alias("v")), p, F.lit("all"), F.lit("points"), F.col("v")))
        out.append(long(read[p].agg(F.max("r").alias("v")), p, F.lit("all"), F.lit("r"), F.col("v")))
    out.append(long(read["heatmap"], "heatmap", F.col("column_a"), F.col("column_b"), F.col("r")))
    out.append(tall("line", "period", ["total"]))
    out.append(long(read["pairplot"], "pairplot", F.concat_ws(" ", "column_name", "o_orderpriority"), F.col("bin"), F.col("n")))
    out += [long(read["regression"].agg(F.max(c).alias("v")), "regression", F.lit("all"), F.lit(c), F.col("v")) for c in ("slope", "r")]
    numbers = ["count", "mean", "std", "min", "max", "q25", "q50", "q75"]
    out.append(long(read["summary"].withColumn("count", F.col("count").cast("double")).unpivot(["column_name"], numbers, "metric", "value"),
                    "summary", F.col("column_name"), F.col("metric"), F.col("value")))
    out.append(long(read["violin"].groupBy("o_orderpriority").count(), "violin", F.col("o_orderpriority"), F.lit("points"), F.col("count")))
    out.append(long(spark.read.text(f"{path}/insights").agg(F.count("*").alias("v")), "insights", F.lit("all"), F.lit("lines"), F.col("v")))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return rounded(whole, 4)
