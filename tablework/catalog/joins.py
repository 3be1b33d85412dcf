from pyspark.sql import functions as F

from tablework.catalog.registry import query, table
from tablework.operators import joins
from tablework.sources.readers import load_merged

# Every ninth order and one customer have no key; every fourth customer and some more have a key that no order has.
_LEFT = "(SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 1 THEN NULL ELSE o_custkey END AS custkey, o_totalprice AS amount FROM orders)"
_RIGHT = """(SELECT CASE WHEN c_custkey = 7 THEN NULL WHEN c_custkey % 4 = 2 OR c_custkey % 50 = 7 THEN -c_custkey ELSE c_custkey END AS custkey,
  c_name, c_acctbal AS amount FROM customer)"""


def _sides(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    key = F.col("c_custkey")
    left = o.select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 1, F.col("o_custkey")).alias("custkey"),
                    F.col("o_totalprice").alias("amount"))
    moved = F.when(key == 7, F.lit(None)).when((key % 4 == 2) | (key % 50 == 7), -key).otherwise(key)
    return left, c.select(moved.alias("custkey"), "c_name", F.col("c_acctbal").alias("amount"))


def _sql(kind: str) -> str:
    key = {"RIGHT": "r.custkey", "FULL": "coalesce(l.custkey, r.custkey)"}.get(kind, "l.custkey")
    return f"""SELECT {key} AS custkey, l.o_orderkey, l.amount AS amount_x, r.c_name, r.amount AS amount_y
FROM {_LEFT} l {kind} JOIN {_RIGHT} r ON l.custkey IS NOT DISTINCT FROM r.custkey"""


@query("join_inner", _sql("INNER"))
def _(spark, sf):
    return joins.merge(*_sides(spark, sf), "custkey", "inner")


@query("join_left", _sql("LEFT"))
def _(spark, sf):
    return joins.merge(*_sides(spark, sf), "custkey", "left")


@query("join_right", _sql("RIGHT"))
def _(spark, sf):
    return joins.merge(*_sides(spark, sf), "custkey", "right")


@query("join_outer", _sql("FULL"))
def _(spark, sf):
    return joins.merge(*_sides(spark, sf), "custkey", "outer")


@query("join_counts", "\nUNION ALL ".join(
    f"SELECT '{name}' AS how, count(*) AS row_count FROM ({_sql(kind)})"
    for name, kind in (("inner", "INNER"), ("left", "LEFT"), ("right", "RIGHT"), ("outer", "FULL"))))
def _(spark, sf):
    return joins.join_counts(*_sides(spark, sf), "custkey")


@query("join_unmatched", f"""
SELECT custkey, c_name, amount FROM {_RIGHT} r
WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {_LEFT} WHERE amount > 400000) l WHERE l.custkey IS NOT DISTINCT FROM r.custkey)""")
def _(spark, sf):
    left, right = _sides(spark, sf)
    return joins.unmatched(right, left.filter("amount > 400000"), "custkey")


@query("load_merged", """
SELECT s.s_nationkey AS nationkey, s.s_suppkey, s.s_acctbal, n.n_name, n.n_regionkey
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = CASE WHEN n_nationkey % 5 = 0 THEN n_nationkey + 1000 ELSE n_nationkey END""")
def _(spark, sf):
    facts = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"), "s_suppkey", "s_acctbal")
    key = F.col("n_nationkey")
    lookup = table(spark, sf, "nation").withColumn("n_nationkey", F.when(key % 5 == 0, key + 1000).otherwise(key)).withColumnRenamed("n_nationkey", "nationkey")
    return load_merged(facts, lookup, "nationkey")


@query("concat_rows", """
SELECT o_orderkey AS orderkey, o_totalprice AS price FROM orders UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem""")
def _(spark, sf):
    whole = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"))
    parts = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_extendedprice").alias("price"))
    return joins.concat_rows(whole, parts)


@query("concat_cols", """
SELECT a.o_orderkey, a.o_totalprice, b.date_key, b.o_orderdate FROM
  (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS k FROM orders) a
JOIN (SELECT o_orderkey AS date_key, CAST(o_orderdate AS DATE) AS o_orderdate,
             row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS k FROM orders) b ON a.k = b.k""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    left = o.select("o_orderkey", "o_totalprice")
    right = o.select(F.col("o_orderkey").alias("date_key"), F.to_date("o_orderdate").alias("o_orderdate"))
    return joins.concat_cols(left, ["o_totalprice", "o_orderkey"], right, ["o_orderdate", "date_key"])
