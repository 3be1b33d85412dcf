from pyspark.sql import functions as F

from tablework.catalog.registry import query, rounded, table
from tablework.operators import order, select


@query("select_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    return select.select_columns(table(spark, sf, "orders"), "o_orderkey", "o_totalprice")


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    return select.drop_columns(table(spark, sf, "orders"), "o_orderstatus", "o_orderdate", "o_orderpriority", "absent")


@query("numeric_columns", "SELECT value FROM events")
def _(spark, sf):
    return select.numeric_columns(table(spark, sf, "events"))


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def _(spark, sf):
    return select.distinct_values(table(spark, sf, "orders"), "o_orderpriority")


@query("slice_rows_cols", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 90 OFFSET 30")
def _(spark, sf):
    return select.slice_rows_cols(table(spark, sf, "orders"), ["o_totalprice", "o_orderkey"], (30, 120), (0, 3))


@query("slice_middle", """
SELECT o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx, count(*) OVER () AS n FROM orders)
WHERE idx >= n // 2 AND idx < n""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    n = orders.count()
    return order.positions_between(orders, ["o_totalprice", "o_orderkey"], n // 2, n)


@query("loc_rows", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 100 AND 900")
def _(spark, sf):
    return select.loc_rows(table(spark, sf, "orders"), "o_orderkey", 100, 900, ["o_orderkey", "o_totalprice"])


@query("slice_step", """
SELECT o_orderkey, o_totalprice FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey DESC) - 1 AS idx FROM orders)
WHERE idx % 3 = 0""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return select.slice_step(orders, ["o_totalprice", "o_orderkey"], -3)


@query("mask_greater", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def _(spark, sf):
    return select.mask_greater(table(spark, sf, "lineitem"), "l_quantity", 45).select("l_orderkey", "l_linenumber", "l_quantity")


_LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"]
_LINE_SQL = "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem WHERE "


@query("filter_and", _LINE_SQL + "l_quantity >= 30 AND l_returnflag = 'R'")
def _(spark, sf):
    return select.filter_all(table(spark, sf, "lineitem"), F.col("l_quantity") >= 30, F.col("l_returnflag") == "R").select(_LINE)


@query("filter_or", _LINE_SQL + "l_quantity >= 48 OR l_discount >= 0.1")
def _(spark, sf):
    return select.filter_any(table(spark, sf, "lineitem"), F.col("l_quantity") >= 48, F.col("l_discount") >= 0.1).select(_LINE)


@query("filter_isin", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def _(spark, sf):
    return select.filter_isin(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@query("filter_between", _LINE_SQL + "l_quantity BETWEEN 10 AND 20")
def _(spark, sf):
    return select.filter_between(table(spark, sf, "lineitem"), "l_quantity", 10, 20).select(_LINE)


@query("filter_expr", _LINE_SQL + "l_returnflag = 'A' AND l_quantity >= 25")
def _(spark, sf):
    return select.filter_expr(table(spark, sf, "lineitem"), "l_returnflag = 'A' AND l_quantity >= 25").select(_LINE)


@query("filter_records", _LINE_SQL + "l_returnflag IN ('A', 'N') AND l_quantity BETWEEN 5 AND 15 AND l_linestatus = 'F'")
def _(spark, sf):
    spec = {"l_returnflag": ["A", "N"], "l_quantity": {"between": (5, 15)}, "l_linestatus": "F"}
    return select.filter_records(table(spark, sf, "lineitem"), spec).select(_LINE)


@query("select_rows_by_index", """
SELECT w.ord, o.o_orderkey, o.o_totalprice
FROM (VALUES (0, 3), (1, 0), (2, 1), (3, 1), (4, -1)) AS w(ord, pos)
JOIN (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx, count(*) OVER () AS n
      FROM orders) AS o ON o.idx = CASE WHEN w.pos < 0 THEN w.pos + o.n ELSE w.pos END""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return select.select_rows_by_index(orders, ["o_totalprice", "o_orderkey"], [3, 0, 1, 1, -1]).withColumn("ord", F.col("ord").cast("int"))


@query("filter_mean_deviation", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE abs(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) <= 50000""")
def _(spark, sf):
    return select.filter_mean_deviation(table(spark, sf, "orders"), "o_totalprice", 50000.0).select("o_orderkey", "o_totalprice")


@query("column_arith", """
SELECT l_orderkey, l_linenumber, l_quantity + 10 + 100 AS l_quantity, round(l_discount + 10 + 0.5, 6) AS l_discount,
  round(l_tax + 10 - 0.25, 6) AS l_tax FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    shifted = select.add_scalar(li, ["l_quantity", "l_discount", "l_tax"], 10)
    return rounded(select.add_row_vector(shifted, {"l_quantity": 100, "l_discount": 0.5, "l_tax": -0.25}))


@query("row_expr", "SELECT l_orderkey, l_linenumber, round(l_quantity * l_extendedprice, 2) AS amount FROM lineitem")
def _(spark, sf):
    li = select.with_product(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "amount")
    return rounded(li.select("l_orderkey", "l_linenumber", "amount"), 2)


@query("map_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status_name FROM orders""")
def _(spark, sf):
    return select.map_values(table(spark, sf, "orders"), "o_orderstatus", {"F": "finished", "O": "open"}, "status_name").select(
        "o_orderkey", "status_name")


@query("apply_tier", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'premium' ELSE 'standard' END AS tier FROM orders")
def _(spark, sf):
    return select.apply_tier(table(spark, sf, "orders"), "o_totalprice", 200000, "premium", "standard", "tier").select("o_orderkey", "tier")


@query("cast_columns", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
  CAST(l_quantity AS FLOAT) AS l_quantity, TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag")
    return select.cast_columns(li, {"l_extendedprice": "int", "l_quantity": "float", "l_returnflag": "int"})


@query("byte_sizes", """
SELECT c.column_name, c.type_name, CAST(c.w AS BIGINT) AS item_bytes, n * c.w AS total_bytes
FROM (SELECT count(*) AS n FROM lineitem), (VALUES ('l_orderkey', 'bigint', 8), ('l_linenumber', 'int', 4),
  ('l_quantity', 'double', 8)) AS c(column_name, type_name, w)""")
def _(spark, sf):
    return select.byte_sizes(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))
