from pyspark.sql import functions as F

from tablework.catalog.registry import GAPPY_ORDERS_SQL, gappy_orders, query, rounded, table
from tablework.operators import aggregate as agg
from tablework.operators import pick
from tablework.operators.joins import merge
from tablework.operators.select import filter_records


@query("group_mean", "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem GROUP BY ALL")
def _(spark, sf):
    return rounded(agg.group_agg(table(spark, sf, "lineitem"), "l_returnflag", mean_quantity=("l_quantity", "mean")))


@query("group_sum_multi", """
SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    return rounded(agg.group_agg(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], total=("l_extendedprice", "sum")), 2)


@query("group_named_agg", """
SELECT l_returnflag, round(sum(l_extendedprice), 2) AS revenue, round(avg(l_discount), 6) AS mean_discount, count(l_tax) AS n
FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    out = agg.group_agg(table(spark, sf, "lineitem"), "l_returnflag", revenue=("l_extendedprice", "sum"),
                        mean_discount=("l_discount", "mean"), n=("l_tax", "count"))
    return rounded(out, revenue=2)


@query("group_null_keys", f"""
SELECT o_orderstatus, coalesce(round(sum(o_totalprice), 2), 0) AS total, count(o_totalprice) AS n
FROM {GAPPY_ORDERS_SQL} WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""")
def _(spark, sf):
    out = agg.group_agg(gappy_orders(spark, sf), "o_orderstatus", total=("o_totalprice", "sum"), n=("o_totalprice", "count"))
    return rounded(out, 2)


@query("group_aggregate", """
SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS l_extendedprice_sum,
  round(avg(l_extendedprice), 4) AS l_extendedprice_mean, round(median(l_extendedprice), 4) AS l_extendedprice_median,
  min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, round(stddev_samp(l_quantity), 6) AS l_quantity_std,
  round(var_samp(l_quantity), 6) AS l_quantity_var, count(l_orderkey) AS l_orderkey_count,
  count(DISTINCT l_suppkey) AS l_suppkey_nunique, min(l_orderkey) AS l_orderkey_first, max(l_orderkey) AS l_orderkey_last
FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    out = agg.group_aggregate(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "l_extendedprice": ["sum", "mean", "median"], "l_quantity": ["min", "max", "std", "var"],
        "l_orderkey": ["count", "first", "last"], "l_suppkey": "nunique"}, order_by="l_orderkey")
    return rounded(out, l_extendedprice_sum=2, l_extendedprice_mean=4, l_extendedprice_median=4)


@query("group_median", "SELECT l_returnflag, round(median(l_extendedprice), 4) AS m FROM lineitem GROUP BY ALL")
def _(spark, sf):
    return rounded(agg.group_median(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", "m"), 4)


@query("group_median_many", "SELECT o_custkey, round(median(o_totalprice), 4) AS m FROM orders GROUP BY ALL")
def _(spark, sf):
    """More groups than the driver should know: the ordered route, whatever the table size."""
    from tablework.operators.quantiles import group_quantiles

    return rounded(group_quantiles(table(spark, sf, "orders"), ["o_custkey"], "o_totalprice", [0.5], ["m"], max_groups=50), 4)


@query("group_transform", """
SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey), 7) AS mean_price,
  round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_custkey), 7) AS deviation FROM orders""")
def _(spark, sf):
    # at seven digits a mean of two-decimal prices ends in an exact half only in groups of 64 rows and more
    out = agg.group_transform(table(spark, sf, "orders"), "o_custkey", "o_totalprice", "mean_price", "deviation")
    return rounded(out.select("o_orderkey", "mean_price", "deviation"), 7)


@query("top_n_per_group", f"""
SELECT o_custkey, o_orderkey, o_totalprice FROM {GAPPY_ORDERS_SQL}
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) <= 2""")
def _(spark, sf):
    out = agg.top_n_per_group(gappy_orders(spark, sf), "o_custkey", "o_totalprice", 2, "o_orderkey")
    return out.select("o_custkey", "o_orderkey", "o_totalprice")


@query("top_k", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5")
def _(spark, sf):
    return agg.top_k(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 5, "c_custkey")


@query("sort_rows", f"SELECT o_orderkey, o_totalprice FROM {GAPPY_ORDERS_SQL}")
def _(spark, sf):
    return agg.sort_rows(gappy_orders(spark, sf).select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 250")
def _(spark, sf):
    return pick.sample_rows(table(spark, sf, "orders"), 250, "o_orderkey", 42).select("o_orderkey", "o_totalprice")


@query("rank_rows", "SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey DESC) - 1 AS rank FROM customer")
def _(spark, sf):
    return agg.rank_rows(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey").select("c_custkey", "rank")


_MARKS = ["p_size", "p_retailprice"]


@query("row_mean", "SELECT p_partkey, round((p_size + p_retailprice) / 2, 6) AS row_mean FROM part")
def _(spark, sf):
    return rounded(agg.row_mean(table(spark, sf, "part"), _MARKS, "row_mean").select("p_partkey", "row_mean"))


@query("at_risk", "SELECT p_partkey, round((p_size + p_retailprice) / 2, 6) AS row_mean FROM part WHERE (p_size + p_retailprice) / 2 < 500")
def _(spark, sf):
    return rounded(agg.at_risk(table(spark, sf, "part"), _MARKS, 500.0, "p_partkey"))


@query("group_extremes", """
WITH m AS (SELECT p_brand, avg(p_retailprice) AS v FROM part GROUP BY ALL)
SELECT b.p_brand AS best_group, round(b.v, 6) AS best_mean, w.p_brand AS worst_group, round(w.v, 6) AS worst_mean,
  round((b.v / w.v - 1) * 100, 6) AS pct_gap
FROM (SELECT * FROM m ORDER BY v DESC, p_brand LIMIT 1) b, (SELECT * FROM m ORDER BY v, p_brand LIMIT 1) w""")
def _(spark, sf):
    return rounded(agg.group_extremes(table(spark, sf, "part"), "p_brand", "p_retailprice"))


@query("value_counts", f"""
SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM {GAPPY_ORDERS_SQL}
WHERE o_orderstatus IS NOT NULL GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM {GAPPY_ORDERS_SQL}
WHERE o_orderpriority IS NOT NULL GROUP BY 2""")
def _(spark, sf):
    return agg.value_counts(gappy_orders(spark, sf), ["o_orderstatus", "o_orderpriority"])


@query("value_share", f"""
SELECT o_orderstatus, round(count(*) / (SELECT count(o_orderstatus) FROM {GAPPY_ORDERS_SQL}), 9) AS share
FROM {GAPPY_ORDERS_SQL} WHERE o_orderstatus IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return rounded(agg.value_share(gappy_orders(spark, sf), "o_orderstatus"), 9)


@query("category_pct", f"""
SELECT v AS value, round(avg(CASE WHEN o_orderstatus = v THEN 1 ELSE 0 END) * 100, 6) AS pct
FROM {GAPPY_ORDERS_SQL}, (VALUES ('F'), ('O')) AS t(v) GROUP BY v""")
def _(spark, sf):
    return rounded(agg.category_pct(gappy_orders(spark, sf), "o_orderstatus", ["F", "O"]))


@query("pivot_summary", f"""
SELECT o_orderstatus, round(avg(o_totalprice) FILTER (o_orderpriority = '1-URGENT'), 4) AS "1-URGENT",
  round(avg(o_totalprice) FILTER (o_orderpriority = '2-HIGH'), 4) AS "2-HIGH",
  round(avg(o_totalprice) FILTER (o_orderpriority = '3-MEDIUM'), 4) AS "3-MEDIUM",
  round(avg(o_totalprice) FILTER (o_orderpriority = '4-NOT SPECIFIED'), 4) AS "4-NOT SPECIFIED",
  round(avg(o_totalprice) FILTER (o_orderpriority = '5-LOW'), 4) AS "5-LOW"
FROM {GAPPY_ORDERS_SQL} WHERE o_orderstatus IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return rounded(agg.pivot_summary(gappy_orders(spark, sf), "o_orderstatus", "o_orderpriority", "o_totalprice", "mean"), 4)


@query("bin_cut", """
SELECT o_orderkey, CASE WHEN o_totalprice > 0 AND o_totalprice <= 100000 THEN 'low'
  WHEN o_totalprice > 100000 AND o_totalprice <= 300000 THEN 'mid' WHEN o_totalprice > 300000 AND o_totalprice <= 400000 THEN 'high' END AS band
FROM orders""")
def _(spark, sf):
    return agg.bin_cut(table(spark, sf, "orders"), "o_totalprice", [0, 100000, 300000, 400000], ["low", "mid", "high"], "band").select(
        "o_orderkey", "band")


@query("bin_terciles", f"""
WITH q AS (SELECT quantile_cont(o_totalprice, 0.33) AS a, quantile_cont(o_totalprice, 0.66) AS b FROM {GAPPY_ORDERS_SQL})
SELECT CASE WHEN o_totalprice <= a THEN 'Low' WHEN o_totalprice <= b THEN 'Medium' ELSE 'High' END AS tier, count(*) AS n
FROM {GAPPY_ORDERS_SQL}, q WHERE o_totalprice IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return agg.bin_terciles(gappy_orders(spark, sf), "o_totalprice")


# Orders of May count a month later, so that periods without a row occur.
_SPARSE = """(SELECT CAST(CASE WHEN month(o_orderdate) = 5 THEN o_orderdate + INTERVAL 1 MONTH ELSE o_orderdate END AS DATE) AS d, o_totalprice
  FROM orders WHERE o_totalprice IS NOT NULL)"""


def _resample_sql(label: str, first: str, step: str) -> str:
    return f"""
WITH s AS (SELECT {label} AS period, sum(o_totalprice) AS t FROM {_SPARSE} GROUP BY 1),
spine AS (SELECT CAST({first} AS DATE) AS period FROM (SELECT unnest(generate_series((SELECT min(period) FROM s), (SELECT max(period) FROM s), INTERVAL {step})) AS p))
SELECT spine.period, round(coalesce(s.t, 0), 2) AS total FROM spine LEFT JOIN s ON spine.period = s.period"""


def _sparse(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").withColumn("o_orderdate", F.when(F.month(day) == 5, day + F.expr("INTERVAL 1 MONTH")).otherwise(day))


@query("resample_sum", f"""
WITH s AS (SELECT date_trunc('month', d) AS m, sum(o_totalprice) AS t FROM {_SPARSE} GROUP BY 1),
spine AS (SELECT unnest(generate_series((SELECT min(m) FROM s), (SELECT max(m) FROM s), INTERVAL 1 MONTH)) AS m)
SELECT last_day(spine.m) AS period, round(coalesce(s.t, 0), 2) AS total FROM spine LEFT JOIN s ON spine.m = s.m""")
def _(spark, sf):
    return rounded(agg.resample_sum(_sparse(spark, sf), "o_orderdate", "o_totalprice", "month"), 2)


@query("resample_week", _resample_sql("CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE)", "p", "7 DAY"))
def _(spark, sf):
    return rounded(agg.resample_sum(_sparse(spark, sf), "o_orderdate", "o_totalprice", "week"), 2)


@query("resample_day", _resample_sql("d", "p", "1 DAY"))
def _(spark, sf):
    return rounded(agg.resample_sum(_sparse(spark, sf), "o_orderdate", "o_totalprice", "day"), 2)


@query("distinct_count", """
SELECT 'l_suppkey' AS column_name, count(DISTINCT l_suppkey) AS n_distinct FROM lineitem
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem
UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity) FROM lineitem""")
def _(spark, sf):
    return agg.distinct_count(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag", "l_quantity"])


@query("scalar_metrics", "SELECT round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS mean FROM lineitem")
def _(spark, sf):
    return rounded(agg.scalar_metrics(table(spark, sf, "lineitem"), "l_extendedprice"), 4, total=2)




@query("order_revenue", """
SELECT o.o_orderpriority, l.l_returnflag, round(sum(l.l_extendedprice), 2) AS l_extendedprice_sum,
  round(avg(l.l_discount), 6) AS l_discount_mean, count(l.l_orderkey) AS l_orderkey_count
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_quantity BETWEEN 10 AND 40 AND l.l_returnflag IN ('A', 'R') GROUP BY ALL""")
def _(spark, sf):
    lines = filter_records(table(spark, sf, "lineitem"), {"l_quantity": {"between": (10, 40)}, "l_returnflag": ["A", "R"]})
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    out = agg.group_aggregate(merge(lines, orders, "l_orderkey"), ["o_orderpriority", "l_returnflag"], {
        "l_extendedprice": "sum", "l_discount": "mean", "l_orderkey": "count"})
    return rounded(out, l_extendedprice_sum=2)
