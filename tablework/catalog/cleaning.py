from pyspark.sql import functions as F

from tablework.catalog.registry import (
    QUERIES, SQL, GAPPY_EVENTS_SQL, GAPPY_ORDERS_SQL, gappy_events, gappy_orders, query, rounded, table,
)
from tablework.operators import clean


@query("profile_shape", """
SELECT count(*) AS n_rows, 6::BIGINT AS n_cols, 2::BIGINT AS ndim, count(*) * 6 AS n_cells, 32::BIGINT AS row_bytes,
  count(*) * 32 AS fixed_bytes FROM orders""")
def _(spark, sf):
    return clean.profile_shape(table(spark, sf, "orders"))


@query("head_tail", """
SELECT * FROM (SELECT o_orderkey, o_totalprice, 'head' AS part FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT o_orderkey, o_totalprice, 'tail' AS part FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def _(spark, sf):
    return clean.head_tail(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


_DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("describe", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS q25,
  round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem""" for c in _DESCRIBED))
def _(spark, sf):
    return rounded(clean.describe(table(spark, sf, "lineitem"), _DESCRIBED), 4)


_SUMMARY = (("o_orderkey", "bigint", "8 * count(*)"), ("o_custkey", "bigint", "8 * count(*)"),
            ("o_orderstatus", "string", "sum(strlen(o_orderstatus))"), ("o_totalprice", "double", "8 * count(*)"),
            ("o_orderdate", "date", "4 * count(*)"), ("o_orderpriority", "string", "sum(strlen(o_orderpriority))"))


@query("table_summary", "\nUNION ALL ".join(f"""
SELECT count(*) AS n_rows, 6::BIGINT AS n_cols, 6 * count(*) - ({' + '.join(f'count({x})' for x, _, _ in _SUMMARY)}) AS total_nulls,
  '{c}' AS column_name, '{t}' AS type_name, count(*) - count({c}) AS null_count, CAST({b} AS BIGINT) AS data_bytes
FROM {GAPPY_ORDERS_SQL}""" for c, t, b in _SUMMARY))
def _(spark, sf):
    return clean.table_summary(gappy_orders(spark, sf))


@query("missing_report", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, round((count(*) - count({c})) / count(*), 9) AS null_share,
  repeat('#', CAST(floor((count(*) - count({c})) / count(*) * 40) AS INTEGER)) AS bar FROM {GAPPY_ORDERS_SQL}""" for c, _, _ in _SUMMARY))
def _(spark, sf):
    return rounded(clean.missing_report(gappy_orders(spark, sf)), 9)


def _price(spark, sf):
    return gappy_orders(spark, sf).select("o_orderkey", "o_totalprice")


@query("fill_mean", f"""
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM {GAPPY_ORDERS_SQL})), 4) AS o_totalprice FROM {GAPPY_ORDERS_SQL}""")
def _(spark, sf):
    return rounded(clean.fill_mean(_price(spark, sf), "o_totalprice"), 4)


@query("fill_median", f"""
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT median(o_totalprice) FROM {GAPPY_ORDERS_SQL})), 4) AS o_totalprice FROM {GAPPY_ORDERS_SQL}""")
def _(spark, sf):
    return rounded(clean.fill_median(_price(spark, sf), "o_totalprice"), 4)


_MODE = "(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("fill_mode", f"""
SELECT o_orderkey, coalesce(o_orderpriority, {_MODE.format(c='o_orderpriority', t=GAPPY_ORDERS_SQL)}) AS o_orderpriority FROM {GAPPY_ORDERS_SQL}""")
def _(spark, sf):
    return clean.fill_mode(gappy_orders(spark, sf).select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query("fill_constant", f"SELECT o_orderkey, coalesce(o_totalprice, 0) AS o_totalprice FROM {GAPPY_ORDERS_SQL}")
def _(spark, sf):
    return clean.fill_constant(_price(spark, sf), "o_totalprice", 0.0)


@query("drop_nulls", f"SELECT o_orderkey, o_totalprice FROM {GAPPY_ORDERS_SQL} WHERE o_totalprice IS NOT NULL")
def _(spark, sf):
    return clean.drop_nulls(_price(spark, sf), "o_totalprice")


def _fill_sql(fn: str, frame: str, part: str = "") -> str:
    return f"""SELECT event_id, user_id, event_type, {fn}(value IGNORE NULLS) OVER ({part} ORDER BY event_id
  ROWS BETWEEN {frame}) AS value FROM {GAPPY_EVENTS_SQL}"""


@query("ffill", _fill_sql("last_value", "UNBOUNDED PRECEDING AND CURRENT ROW"))
def _(spark, sf):
    return clean.ffill(gappy_events(spark, sf), "value", ["event_id"])


@query("bfill", _fill_sql("first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING"))
def _(spark, sf):
    return clean.bfill(gappy_events(spark, sf), "value", ["event_id"])


@query("ffill_by_user", _fill_sql("last_value", "UNBOUNDED PRECEDING AND CURRENT ROW", "PARTITION BY user_id"))
def _(spark, sf):
    return clean.ffill(gappy_events(spark, sf), "value", ["event_id"], by=["user_id"])


@query("handle_missing", f"""
WITH a AS (SELECT * FROM {GAPPY_ORDERS_SQL} WHERE o_orderstatus IS NOT NULL)
SELECT o_orderkey, o_custkey, o_orderstatus, round(coalesce(o_totalprice, (SELECT median(o_totalprice) FROM a)), 4) AS o_totalprice,
  last_value(o_orderdate IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS o_orderdate,
  coalesce(o_orderpriority, {_MODE.format(c='o_orderpriority', t='a')}) AS o_orderpriority
FROM a""")
def _(spark, sf):
    plan = {"o_orderstatus": "drop", "o_totalprice": "median", "o_orderpriority": "mode", "absent": "mean", "o_orderdate": "ffill"}
    return rounded(clean.handle_missing(gappy_orders(spark, sf), plan, ["o_orderkey"]), 4)


@query("duplicate_report", """
SELECT count(*) AS total_rows, count(*) - count(DISTINCT text) AS duplicate_rows FROM documents""")
def _(spark, sf):
    return clean.duplicate_report(table(spark, sf, "documents"), "doc_id", ["text"])


@query("duplicate_rows", """
SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents) WHERE doc_id > first_id""")
def _(spark, sf):
    return clean.duplicate_rows(table(spark, sf, "documents"), "doc_id", ["text"])


@query("remove_duplicates", "SELECT doc_id, lang, source, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def _(spark, sf):
    kept = clean.remove_duplicates(table(spark, sf, "documents"), "doc_id", ["text"])
    return kept.select("doc_id", "lang", "source", "n_chars")


@query("remove_full_duplicates", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _(spark, sf):
    return clean.remove_duplicates(table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


# Line items as text: thousands separators, padding, and every 17th value unreadable.
_TEXT_SQL = """(SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 17 = 3 THEN 'n/a' ELSE ' ' || substr(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 1, 1) || ',' ||
    substr(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2) || ' ' END AS quantity,
  CASE WHEN l_orderkey % 17 = 4 THEN '' ELSE CAST(l_partkey AS VARCHAR) || '.5' END AS price,
  CASE WHEN l_orderkey % 17 = 5 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ship_date FROM lineitem)"""


def _as_text(spark, sf):
    li = table(spark, sf, "lineitem")
    digits = F.col("l_quantity").cast("int").cast("string")
    key = F.col("l_orderkey") % 17
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(key == 3, "n/a").otherwise(F.concat(F.lit(" "), F.substring(digits, 1, 1), F.lit(","), F.substring(digits, 2, 9), F.lit(" "))).alias("quantity"),
        F.when(key == 4, "").otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(".5"))).alias("price"),
        F.when(key == 5, "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ship_date"))


@query("fix_types", f"""
SELECT l_orderkey, l_linenumber, TRY_CAST(trim(replace(quantity, ',', '')) AS BIGINT) AS quantity,
  TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(ship_date AS TIMESTAMP) AS ship_date FROM {_TEXT_SQL}""")
def _(spark, sf):
    return clean.fix_types(_as_text(spark, sf), {"quantity": "int", "price": "float", "ship_date": "datetime"})


# Orders with gaps, and every order divisible by 40 a second time.
_DIRTY_SQL = f"(SELECT * FROM {GAPPY_ORDERS_SQL} UNION ALL SELECT * FROM {GAPPY_ORDERS_SQL} WHERE o_orderkey % 40 = 0)"


def _dirty(spark, sf):
    o = gappy_orders(spark, sf)
    return o.unionByName(o.filter("o_orderkey % 40 = 0"))


def _quality_sql(source: str) -> str:
    return f"""SELECT 'rows' AS metric, count(*) AS value FROM {source}
UNION ALL SELECT 'columns', 6
UNION ALL SELECT 'missing_cells', 6 * count(*) - ({' + '.join(f'count({x})' for x, _, _ in _SUMMARY)}) FROM {source}
UNION ALL SELECT 'duplicate_rows', (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))"""


_CLEANED_SQL = f"""(SELECT DISTINCT o_orderkey, o_custkey, coalesce(o_orderstatus, {_MODE.format(c='o_orderstatus', t=_DIRTY_SQL)}) AS o_orderstatus,
  coalesce(o_totalprice, (SELECT median(o_totalprice) FROM {_DIRTY_SQL})) AS o_totalprice, o_orderdate,
  coalesce(o_orderpriority, {_MODE.format(c='o_orderpriority', t=_DIRTY_SQL)}) AS o_orderpriority FROM {_DIRTY_SQL})"""


def _cleaned(spark, sf):
    plan = {"o_totalprice": "median", "o_orderstatus": "mode", "o_orderpriority": "mode"}
    return clean.clean_table(_dirty(spark, sf), {"o_totalprice": "float"}, plan, ["o_orderkey"])


@query("quality_report", _quality_sql(_DIRTY_SQL))
def _(spark, sf):
    return clean.quality_report(_dirty(spark, sf))


@query("quality_compare", f"""
SELECT a.metric, a.value AS before, b.value AS after FROM ({_quality_sql(_DIRTY_SQL)}) a
JOIN ({_quality_sql(_CLEANED_SQL)}) b ON a.metric = b.metric""")
def _(spark, sf):
    return clean.quality_compare(_dirty(spark, sf), _cleaned(spark, sf))


@query("clean_table", f"SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, o_orderdate, o_orderpriority FROM {_CLEANED_SQL}")
def _(spark, sf):
    return rounded(_cleaned(spark, sf), 4)


# The same sequence under the name of the survey.
QUERIES["clean_pipeline"], SQL["clean_pipeline"] = QUERIES["clean_table"], SQL["clean_table"]


_SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("clean_telco", f"""
SELECT CASE WHEN c_custkey % 12 = 5 THEN 0.0 ELSE c_acctbal END AS amount, c_nationkey AS nation,
  CASE WHEN c_custkey % 4 = 1 THEN 1 ELSE 0 END AS target,
  {', '.join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in _SEGMENTS)} FROM customer""")
def _(spark, sf):
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    raw = c.select(
        F.col("c_name").alias("customer"), F.when(key % 12 == 5, "  ").otherwise(F.col("c_acctbal").cast("string")).alias("amount"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
        F.when(key % 4 == 1, " YES").otherwise("No").alias("left_us"))
    return clean.clean_churn(raw, "customer", "amount", "left_us")


@query("cap_clip", "SELECT p_partkey, greatest(950.0::DOUBLE, least(1500.0::DOUBLE, p_retailprice)) AS p_retailprice FROM part")
def _(spark, sf):
    return clean.cap_clip(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 950.0, 1500.0)
