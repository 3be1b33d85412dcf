from pyspark.sql import functions as F

from tablework.catalog.registry import query, rounded, table
from tablework.operators.order import scratch_path
from tablework.sources import generate, readers, writers

_ORDER_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate STRING, o_orderpriority STRING"
_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate, o_orderpriority FROM orders"""


def _written_orders(spark, sf, fmt: str) -> str:
    """Orders as text files, with an unreadable date in every tenth row."""
    path = scratch_path(spark, f"orders-{fmt}") + f".{fmt}"
    bad = F.when(F.col("o_orderkey") % 10 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = table(spark, sf, "orders").withColumn("o_orderdate", bad)
    (writers.write_csv if fmt == "csv" else writers.write_json)(orders, path)
    return path


@query("read_csv", _ORDERS_SQL)
def _(spark, sf):
    return readers.read_csv(spark, _written_orders(spark, sf, "csv"), _ORDER_SCHEMA, ["o_orderdate"])


@query("read_json", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    path = scratch_path(spark, "events")
    writers.write_json(table(spark, sf, "events"), path)
    return readers.read_json(spark, path, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")


@query("load_table", _ORDERS_SQL)
def _(spark, sf):
    return readers.load_table(spark, _written_orders(spark, sf, "csv"), _ORDER_SCHEMA, ["o_orderdate"])


@query("read_many", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    paths = [scratch_path(spark, "slice"), scratch_path(spark, "slice")]
    orders.filter("o_totalprice < 200000").write.parquet(paths[0])
    orders.filter("o_totalprice >= 200000").write.parquet(paths[1])
    return readers.read_many(spark, paths, "parquet", "o_orderkey BIGINT, o_totalprice DOUBLE")


@query("read_typed", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def _(spark, sf):
    path = scratch_path(spark, "typed")
    li = table(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    writers.write_csv(li.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"), path)
    return readers.read_typed(spark, path, "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING, l_shipdate DATE")


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars")


def _catalog(spark, sf) -> readers.DatasetCatalog:
    out = readers.DatasetCatalog()
    out.register("quality", lambda: _documents(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"),
                 "quality", "classification")
    return out


@query("load_xy", "SELECT d.doc_id, d.lang, d.n_chars, l.quality AS target FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, sf):
    return _catalog(spark, sf).load("quality")


@query("load_xy_features", "SELECT d.doc_id, d.lang, d.n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, sf):
    return _catalog(spark, sf).load_xy("Quality")[0]


@query("write_csv", """
SELECT l_orderkey, l_linenumber, printf('%.2f', l_quantity) AS l_quantity, printf('%.2f', l_extendedprice) AS l_extendedprice FROM lineitem""")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    writers.write_csv(li, path, fixed_decimals=True)
    return spark.read.option("header", True).schema(
        "l_orderkey BIGINT, l_linenumber INT, l_quantity STRING, l_extendedprice STRING").csv(path)


@query("write_json", "SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1")
def _(spark, sf):
    path = scratch_path(spark, "json")
    summary = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean"))
    writers.write_json(rounded(summary, 4), path)
    return spark.read.schema(summary.schema).json(path)


@query("write_report", """
SELECT printf('order %d: %d lines, quantity %d', l_orderkey, count(*), CAST(sum(l_quantity) AS BIGINT)) AS value FROM lineitem GROUP BY l_orderkey""")
def _(spark, sf):
    """One line per order, written in order of the key."""
    path = scratch_path(spark, "report")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("q"))
    text = F.format_string("order %d: %d lines, quantity %d", "l_orderkey", "n", "q")
    writers.write_report(lines.select(F.col("l_orderkey").alias("line_no"), text.alias("line")), path)
    return spark.read.text(path)


@query("materialize_once", "SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(spark, sf):
    path = scratch_path(spark, "once")
    build = lambda: rounded(table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")), 2)

    def again():
        raise AssertionError("computed twice")

    readers.materialize_once(spark, path, build)
    return readers.materialize_once(spark, path, again)


@query("inline_table", """
SELECT o.o_orderkey, s.meaning FROM orders o JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS s(code, meaning)
  ON o.o_orderstatus = s.code""")
def _(spark, sf):
    names = readers.inline_table(spark, {"code": ["F", "O", "P"], "meaning": ["finished", "open", "partial"]})
    return table(spark, sf, "orders").join(names, F.col("o_orderstatus") == F.col("code")).select("o_orderkey", "meaning")


# The two grids take their size from a given table; the other generated tables are functions of its ids.
def _size(spark, sf, name: str) -> int:
    return table(spark, sf, name).count()


@query("gen_range", "SELECT unnest(range(5, 5 + 3 * (SELECT count(*) FROM orders), 3)) AS value")
def _(spark, sf):
    return generate.gen_range(spark, 5, 5 + 3 * _size(spark, sf, "orders"), 3)


@query("gen_linspace", """
SELECT k AS idx, round(-1 + 11.0 * k / ((SELECT count(*) FROM orders) - 1), 9) AS value FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS k)""")
def _(spark, sf):
    return rounded(generate.gen_linspace(spark, -1.0, 10.0, _size(spark, sf, "orders")), 9)


@query("gen_constant", "SELECT o_orderkey AS i, j, 1.0::DOUBLE AS v FROM orders, (SELECT unnest(range(3)) AS j)")
def _(spark, sf):
    return generate.gen_constant(table(spark, sf, "orders"), "o_orderkey", 3, 1.0)


@query("gen_identity", "SELECT p_partkey AS i, p_partkey AS j, 1.0::DOUBLE AS v FROM part")
def _(spark, sf):
    return generate.gen_identity(table(spark, sf, "part"), "p_partkey")


_UNIFORM = "(('0x' || substr(md5({id} || ':{seed}'), 1, 13))::BIGINT::DOUBLE / 4503599627370496)"


@query("gen_uniform", f"""
SELECT i, j, round({_UNIFORM.format(id='(i * 4 + j)', seed=42)}, 9) AS v FROM (SELECT p_partkey AS i, unnest(range(4)) AS j FROM part)""")
def _(spark, sf):
    return rounded(generate.gen_uniform(table(spark, sf, "part"), "p_partkey", 4), 9)


def _normal(key: str, seed: int) -> str:
    u1, u2 = _UNIFORM.format(id=key, seed=seed), _UNIFORM.format(id=key, seed=seed + 1_000_003)
    return f"sqrt(-2 * ln(1 - {u1})) * cos(6.283185307179586 * {u2})"


@query("gen_scores", "SELECT c_custkey, " + ", ".join(
    f"round(greatest(0, least(100, 70 + 15 * {_normal('c_custkey', 42 + k)})), 6) AS {s}" for k, s in enumerate(("math", "science", "english"))) + " FROM customer")
def _(spark, sf):
    return rounded(generate.gen_scores(table(spark, sf, "customer"), "c_custkey", ["math", "science", "english"]))


_ORDER_DOMAINS = {
    "status": {"O": 2, "F": 5, "P": 1},
    "priority": {"1-URGENT": 1, "2-HIGH": 1, "3-MEDIUM": 4, "4-NOT SPECIFIED": 1, "5-LOW": 1},
}


def _domain_sql(column: str, seed: int) -> str:
    weights, edge, cases = _ORDER_DOMAINS[column], 0, []
    for value, weight in weights.items():
        edge += weight
        cases.append(f"WHEN {_UNIFORM.format(id='k', seed=seed)} < {edge} / {sum(weights.values())} THEN '{value}'")
    return f"CASE {' '.join(cases)} END AS {column}"


@query("gen_orders", f"""
SELECT k AS order_id,
  CASE WHEN row_number() OVER (ORDER BY md5(k || ':49'), k) > 5
    THEN 'Customer ' || (CAST(floor({_UNIFORM.format(id='k', seed=43)} * 500) AS BIGINT) + 1) END AS customer_name,
  {_domain_sql("status", 52)}, {_domain_sql("priority", 53)}, CAST(floor({_UNIFORM.format(id='k', seed=45)} * 9) AS BIGINT) + 1 AS quantity,
  round(5 + {_UNIFORM.format(id='k', seed=47)} * 495, 2) AS unit_price,
  CAST(DATE '1995-01-01' + CAST(floor({_UNIFORM.format(id='k', seed=46)} * 2400) AS INTEGER) AS DATE) AS order_date
FROM (SELECT o_orderkey AS k FROM orders)""")
def _(spark, sf):
    return generate.gen_orders(table(spark, sf, "orders"), "o_orderkey", _ORDER_DOMAINS, "1995-01-01", 2400, 500)


_NORMAL_AND_BINOMIAL_SQL = f"""
WITH d AS (SELECT k, 50 + 10 * {_normal('k', 42)} AS x, {' + '.join(f"({_UNIFORM.format(id='k', seed=142 + i)} < 0.3)::INTEGER" for i in range(20))} AS b
  FROM (SELECT c_custkey AS k FROM customer))
SELECT 'normal' AS distribution, 50.0::DOUBLE AS mean_theory, round(avg(x), 6) AS mean_sample, 100.0::DOUBLE AS var_theory, round(var_pop(x), 6) AS var_sample FROM d
UNION ALL SELECT 'binomial', 6.0, round(avg(b), 6), 4.2, round(var_pop(b), 6) FROM d"""
_POISSON_SQL = f"""
WITH c AS (SELECT i, sum(exp(-4) * 4.0 ** i / gamma(i + 1)) OVER (ORDER BY i) AS p FROM (SELECT unnest(range(41)) AS i)),
d AS (SELECT u, (SELECT count(*) FROM c WHERE c.p <= u) AS v FROM (SELECT {_UNIFORM.format(id='c_custkey', seed=242)} AS u FROM customer))
SELECT 'poisson' AS distribution, 4.0::DOUBLE AS mean_theory, round(avg(v), 6) AS mean_sample, 4.0::DOUBLE AS var_theory, round(var_pop(v), 6) AS var_sample FROM d"""


def _moments(spark, sf):
    return rounded(generate.compare_moments(generate.gen_distributions(table(spark, sf, "customer"), "c_custkey")))


@query("gen_distributions", f"SELECT * FROM ({_NORMAL_AND_BINOMIAL_SQL}) UNION ALL SELECT * FROM ({_POISSON_SQL})")
def _(spark, sf):
    return _moments(spark, sf)


@query("gen_poisson", _POISSON_SQL)
def _(spark, sf):
    return _moments(spark, sf).filter("distribution = 'poisson'")


_DIRTY_COLUMNS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _pick_rank(seed: int) -> str:
    return f"row_number() OVER (ORDER BY md5(o_orderkey || ':{seed}'), o_orderkey)"


@query("inject_dirty", f"""
WITH d AS (SELECT o_orderkey, {', '.join(f"CASE WHEN {_pick_rank(42 + k)} > n // 20 THEN {c} END AS {c}" for k, c in enumerate(_DIRTY_COLUMNS))}
  FROM orders, (SELECT count(*) AS n FROM orders))
SELECT * FROM d UNION ALL SELECT * FROM (SELECT * FROM d ORDER BY md5(o_orderkey || ':46'), o_orderkey LIMIT 37)""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", *_DIRTY_COLUMNS)
    return generate.inject_dirty(orders, "o_orderkey", 0.05, 37)


# Namespaces of the Office Open XML workbook format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACK = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook(header, rows) -> bytes:
    """A minimal one-sheet .xlsx file, as input for the reader."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    def cell(at, v):
        if isinstance(v, str):
            return f'<c r="{at}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        return f'<c r="{at}"><v>{v!r}</v></c>'

    body = "".join(
        f'<row r="{i + 1}">' + "".join(cell(f"{chr(65 + j)}{i + 1}", v) for j, v in enumerate(row) if v is not None) + "</row>"
        for i, row in enumerate([header, *rows]))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACK}"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


@query("read_excel", "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def _(spark, sf):
    """All orders as workbooks of at most 500 rows, read back."""
    import pandas as pd

    names = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]

    def build(pdf):
        days = (pd.to_datetime(pdf["o_orderdate"]) - pd.Timestamp("1899-12-30")).dt.days
        rows = zip(pdf["o_orderkey"].tolist(), pdf["o_orderstatus"], pdf["o_totalprice"].tolist(), days.tolist())
        return pd.DataFrame({"content": [workbook(names, rows)]})

    orders = table(spark, sf, "orders").select(*names, F.floor(F.col("o_orderkey") / 500).alias("book"))
    files = orders.groupBy("book").applyInPandas(build, "content binary")
    return readers.parse_workbooks(files, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE", ["o_orderdate"])
