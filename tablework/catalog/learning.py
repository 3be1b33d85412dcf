import functools

from pyspark.sql import functions as F

from tablework.catalog.registry import QUERIES, SCORED_DOCS_SQL, query, rounded, scored_docs, table
from tablework.ml import baseline, knn, linear, metrics, models, preprocess, split
from tablework.operators import aggregate
from tablework.operators.order import scratch_path


def _hash(key: str, seed: int = 42) -> str:
    return f"md5({key} || ':{seed}')"


def _test_sql(source: str, key: str, share: str = "0.2", columns: str = "*") -> str:
    """Rows with the exact-size split marked by hash rank."""
    return f"""(SELECT {columns}, row_number() OVER (ORDER BY {_hash(key)}, {key}) <= ceil(count(*) OVER () * {share}) AS is_test FROM {source})"""


@query("train_test_split", f"SELECT o_orderkey, is_test FROM {_test_sql('orders', 'o_orderkey')}")
def _(spark, sf):
    return split.mark_test(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "is_test")


# Quotas of the stratified split: shares of the total quota by largest remainder, ties by class.
_STRATIFIED = f"""(WITH c AS (SELECT quality, count(*) AS n, ceil((SELECT count(*) FROM labels) * 0.2) AS q, (SELECT count(*) FROM labels) AS t FROM labels GROUP BY 1),
f AS (SELECT *, floor(q * n / t) AS base, q * n / t - floor(q * n / t) AS rest FROM c),
g AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, quality) <= q - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM f)
SELECT l.doc_id, l.quality, row_number() OVER (PARTITION BY l.quality ORDER BY {_hash('doc_id')}, doc_id) <= quota AS is_test
FROM labels l JOIN g ON l.quality = g.quality)"""


@query("stratified_split", f"SELECT doc_id, quality, is_test FROM {_STRATIFIED}")
def _(spark, sf):
    return split.mark_test(table(spark, sf, "labels"), "doc_id", stratify="quality").select("doc_id", "quality", "is_test")


@query("compare_shares", f"""
SELECT quality, round(f, 9) AS full, round(a, 9) AS train, round(b, 9) AS test, round(greatest(abs(a - f), abs(b - f)), 9) AS max_gap FROM (
  SELECT quality, count(*) / (SELECT count(*) FROM labels) AS f,
    count(*) FILTER (NOT is_test) / (SELECT count(*) FROM {_STRATIFIED} WHERE NOT is_test) AS a,
    count(*) FILTER (is_test) / (SELECT count(*) FROM {_STRATIFIED} WHERE is_test) AS b FROM {_STRATIFIED} GROUP BY 1)""")
def _(spark, sf):
    labels = table(spark, sf, "labels")
    train, test = split.train_test_split(labels, "doc_id", stratify="quality")
    return rounded(aggregate.compare_shares(labels, train, test, "quality"), 9)


@query("infer_task", """
SELECT 'o_orderstatus' AS target, 'classification' AS task UNION ALL SELECT 'o_totalprice', 'regression'
UNION ALL SELECT 'o_custkey', CASE WHEN count(DISTINCT o_custkey) <= 20 THEN 'classification' ELSE 'regression' END FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    rows = [(c, split.infer_task(orders, c)) for c in ("o_orderstatus", "o_totalprice", "o_custkey")]
    return spark.createDataFrame(rows, "target string, task string")


# Line items per order, the regression table of this section.
_ORDER_X = """(SELECT o_orderkey, any_value(o_totalprice) AS price, count(*)::DOUBLE AS n_lines, sum(l_quantity) AS quantity,
  sum(l_extendedprice) AS amount, avg(l_discount) AS discount FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)"""


def _order_x(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("price"))
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").cast("double").alias("n_lines"), F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("amount"), F.avg("l_discount").alias("discount"))
    return orders.join(lines, "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")


@query("baseline_regression", f"""
WITH d AS {_test_sql('orders', 'o_orderkey')}, m AS (SELECT avg(o_totalprice) AS p FROM d WHERE NOT is_test),
t AS (SELECT avg(abs(o_totalprice - p)) AS mae, avg((o_totalprice - p) ** 2) AS mse, var_pop(o_totalprice) AS v FROM d, m WHERE is_test)
SELECT round(p, 4) AS baseline_prediction, (SELECT round(1 - avg((o_totalprice - p) ** 2) / var_pop(o_totalprice), 6) FROM d, m WHERE NOT is_test) AS train_r2,
  round(mae, 4) AS test_mae, round(sqrt(mse), 4) AS test_rmse, round(1 - mse / v, 6) AS test_r2 FROM t, m""")
def _(spark, sf):
    out = baseline.baseline_regression(*split.train_test_split(table(spark, sf, "orders"), "o_orderkey"), "o_totalprice")
    return rounded(out, 4, test_r2=6, train_r2=6)


@query("baseline_classification", f"""
WITH m AS (SELECT quality AS p FROM {_STRATIFIED} WHERE NOT is_test GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT any_value(p) AS majority_class, round(avg(CASE WHEN quality = p THEN 1 ELSE 0 END) FILTER (NOT is_test), 9) AS train_accuracy,
  round(avg(CASE WHEN quality = p THEN 1 ELSE 0 END) FILTER (is_test), 9) AS test_accuracy,
  round(coalesce(CASE WHEN any_value(p) = 1 THEN 2.0 * count(*) FILTER (is_test AND quality = 1) /
    (count(*) FILTER (is_test) + count(*) FILTER (is_test AND quality = 1)) END, 0), 9)::DOUBLE AS test_f1
FROM {_STRATIFIED}, m""")
def _(spark, sf):
    train, test = split.train_test_split(table(spark, sf, "labels"), "doc_id", stratify="quality")
    return rounded(baseline.baseline_classification(train, test, "quality"), 9)


@query("leakage_gap", f"""
WITH d AS {_test_sql(_ORDER_X, 'o_orderkey')}
SELECT round(greatest({', '.join(f"abs(avg({c}) - avg({c}) FILTER (NOT is_test)) / stddev_pop({c}) FILTER (NOT is_test)" for c in ('n_lines', 'quantity', 'amount', 'discount'))}), 6) AS scaler_mean_gap
FROM d""")
def _(spark, sf):
    data = _order_x(spark, sf)
    train, _ = split.train_test_split(data, "o_orderkey")
    gap = baseline.scaler_mean_gap(data, train, ["n_lines", "quantity", "amount", "discount"])
    return rounded(spark.createDataFrame([(gap,)], "scaler_mean_gap double"))


def _scaled_distance(of: str) -> str:
    """Euclidean distance of train row t and test row q, scaled by the moments m over the rows of kind ``of``."""
    gap = lambda c: f"((t.{c} - m.{c}_m) / m.{c}_s - (q.{c} - m.{c}_m) / m.{c}_s) ** 2"
    return f"sqrt({gap('n_chars')} + {gap('score')})"


def _neighbour_accuracy(of: str) -> str:
    moments = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in ("n_chars", "score"))
    return f"""(WITH m AS (SELECT {moments} FROM x WHERE {of}),
n AS (SELECT q.doc_id, q.quality, t.quality AS vote, row_number() OVER (PARTITION BY q.doc_id ORDER BY {_scaled_distance(of)}, t.doc_id) AS k
  FROM x q, x t, m WHERE q.is_test AND NOT t.is_test),
v AS (SELECT doc_id, any_value(quality) AS quality, vote, count(*) AS c FROM n WHERE k <= 5 GROUP BY doc_id, vote),
p AS (SELECT doc_id, any_value(quality) AS quality, arg_min(vote, (-c, vote)) AS vote FROM v GROUP BY doc_id)
SELECT avg(CASE WHEN quality = vote THEN 1.0 ELSE 0.0 END) FROM p)"""


@query("leakage_check", f"""
WITH x AS (SELECT s.doc_id, s.quality, s.is_test, d.n_chars::DOUBLE AS n_chars, d.score FROM {_STRATIFIED} s JOIN {SCORED_DOCS_SQL} d USING (doc_id)),
a AS (SELECT {_neighbour_accuracy('true')} AS leaky, {_neighbour_accuracy('NOT is_test')} AS clean,
  (SELECT greatest({', '.join(f"abs(avg({c}) - avg({c}) FILTER (NOT is_test)) / stddev_pop({c}) FILTER (NOT is_test)" for c in ('n_chars', 'score'))}) FROM x) AS gap)
SELECT 'classification' AS task, 'accuracy' AS metric, round(leaky, 9) AS leaky_score, round(clean, 9) AS clean_score,
  round(leaky - clean, 9) AS score_difference, round(gap, 9) AS scaler_mean_gap FROM a""")
def _(spark, sf):
    docs = scored_docs(spark, sf).select("doc_id", "quality", "n_chars", "score")
    return rounded(baseline.leakage_check(docs, "doc_id", "quality", ["n_chars", "score"]), 9)


def _embedding_split(spark, sf):
    return split.train_test_split(table(spark, sf, "embeddings"), "vec_id")


_NEAR = f"""(WITH d AS {_test_sql('embeddings', 'vec_id')}
SELECT q.vec_id, t.vec_id AS neighbour, t.label, list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[]) AS distance
FROM d q, d t WHERE q.is_test AND NOT t.is_test
QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[]), t.vec_id) <= 5)"""


@query("knn_join", f"SELECT vec_id, neighbour, round(distance, 6) AS distance FROM {_NEAR}")
def _(spark, sf):
    train, test = _embedding_split(spark, sf)
    return rounded(knn.knn_join(train, test, "vec_id", "embedding").drop("rank"))


@query("knn_predict", f"""
SELECT vec_id, label AS prediction FROM (SELECT vec_id, label, count(*) AS n FROM {_NEAR} GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1""")
def _(spark, sf):
    train, test = _embedding_split(spark, sf)
    return knn.knn_predict(train, test, "vec_id", "embedding", "label")


# A churn-like table: customers with tenure in months, monthly and total charges, contract and payment.
def _churn(spark, sf):
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    tenure = (key * 7 % 73).cast("bigint")
    monthly = F.abs("c_acctbal") / 100 + 20
    return c.select(
        key.alias("customer_id"), tenure.alias("tenure"), monthly.alias("monthly"),
        F.when(tenure == 0, " ").otherwise((monthly * tenure).cast("string")).alias("total"),
        F.element_at(F.array(*[F.lit(x) for x in preprocess.CONTRACT_ORDER]), (key % 3 + 1).cast("int")).alias("contract"),
        F.col("c_mktsegment").alias("segment"),
        F.when((key * 7 % 73 < 20) & (F.col("c_acctbal") > 3000), "Yes").otherwise("No").alias("churn"))


_CHURN_SQL = """(SELECT c_custkey AS customer_id, c_custkey * 7 % 73 AS tenure, abs(c_acctbal) / 100 + 20 AS monthly,
  CASE WHEN c_custkey * 7 % 73 = 0 THEN NULL ELSE (abs(c_acctbal) / 100 + 20) * (c_custkey * 7 % 73) END AS total,
  CASE c_custkey % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS contract, c_mktsegment AS segment,
  CASE WHEN c_custkey * 7 % 73 < 20 AND c_acctbal > 3000 THEN 1 ELSE 0 END AS churn FROM customer)"""


def _clean_churn(spark, sf):
    keyed = _churn(spark, sf).withColumn("id", F.col("customer_id"))
    return preprocess.load_raw_churn(keyed, "customer_id", "total", "churn").withColumnRenamed("id", "customer_id")


@query("load_raw_telco", f"""
SELECT id, tenure, round(monthly, 6) AS monthly, round(total, 6) AS total, contract, CASE WHEN k <= greatest(1, n // 50) THEN NULL ELSE segment END AS segment, churn
FROM (SELECT *, customer_id AS id, row_number() OVER (ORDER BY {_hash('customer_id')}, customer_id) AS k, count(*) OVER () AS n FROM {_CHURN_SQL})""")
def _(spark, sf):
    keyed = _churn(spark, sf).withColumn("id", F.col("customer_id"))
    return rounded(preprocess.load_raw_churn(keyed, "customer_id", "total", "churn", blank="segment"))


@query("engineer_features", f"""
SELECT customer_id, round(tenure / 12, 6) AS tenure_years, round(total / CASE WHEN tenure = 0 THEN 1 ELSE tenure END, 6) AS avg_monthly_spend,
  CASE WHEN tenure <= 12 THEN '0-1yr' WHEN tenure <= 24 THEN '1-2yr' WHEN tenure <= 48 THEN '2-4yr' WHEN tenure <= 60 THEN '4-5yr' ELSE '5yr+' END AS tenure_bucket,
  round(monthly * tenure, 5) AS monthly_charge_x_tenure FROM {_CHURN_SQL}""")
def _(spark, sf):
    out = preprocess.engineer_features(_clean_churn(spark, sf), "tenure", "monthly", "total")
    out = out.select("customer_id", "tenure_years", "avg_monthly_spend", "tenure_bucket", "monthly_charge_x_tenure")
    return rounded(out, 6, monthly_charge_x_tenure=5)


_TRAIN_ROWS = f"(SELECT * FROM {_test_sql(_CHURN_SQL, 'customer_id')} WHERE NOT is_test)"
_TEST_ROWS = f"(SELECT * FROM {_test_sql(_CHURN_SQL, 'customer_id')} WHERE is_test)"


def _churn_split(spark, sf):
    return split.train_test_split(_clean_churn(spark, sf), "customer_id")


@query("impute_median_mode", f"""
SELECT customer_id, round(coalesce(total, (SELECT median(total) FROM {_TRAIN_ROWS})), 4) AS total,
  coalesce(CASE WHEN customer_id % 5 <> 2 THEN segment END, (SELECT segment FROM {_TRAIN_ROWS} WHERE customer_id % 5 <> 2 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS segment
FROM {_TEST_ROWS}""")
def _(spark, sf):
    gap = lambda d: d.withColumn("segment", F.when(F.col("customer_id") % 5 != 2, F.col("segment"))).select("customer_id", "total", "segment")
    train, test = (gap(d) for d in _churn_split(spark, sf))
    return rounded(preprocess.impute_median_mode(train, test, ["total"], ["segment"]), 4)


@query("scale_standard", f"""
SELECT customer_id, round((tenure - (SELECT avg(tenure) FROM {_TRAIN_ROWS})) / (SELECT stddev_pop(tenure) FROM {_TRAIN_ROWS}), 6) AS tenure,
  round((monthly - (SELECT avg(monthly) FROM {_TRAIN_ROWS})) / (SELECT stddev_pop(monthly) FROM {_TRAIN_ROWS}), 6) AS monthly FROM {_TEST_ROWS}""")
def _(spark, sf):
    train, test = (d.select("customer_id", "tenure", "monthly") for d in _churn_split(spark, sf))
    return rounded(preprocess.scale_columns(train, test, ["tenure", "monthly"], "standard"))


@query("scale_minmax", f"""
SELECT customer_id, round((tenure - (SELECT min(tenure) FROM {_TRAIN_ROWS})) / (SELECT max(tenure) - min(tenure) FROM {_TRAIN_ROWS}), 6) AS tenure,
  round((monthly - (SELECT min(monthly) FROM {_TRAIN_ROWS})) / (SELECT max(monthly) - min(monthly) FROM {_TRAIN_ROWS}), 6) AS monthly FROM {_TEST_ROWS}""")
def _(spark, sf):
    train, test = (d.select("customer_id", "tenure", "monthly") for d in _churn_split(spark, sf))
    return rounded(preprocess.scale_columns(train, test, ["tenure", "monthly"], "minmax"))


_LEVELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("encode_onehot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS c_mktsegment_{v}" for v in _LEVELS if v != "FURNITURE") + " FROM customer")
def _(spark, sf):
    """Learned without one segment, which then gives all zeros."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return preprocess.encode_onehot(c.filter("c_mktsegment <> 'FURNITURE'"), c, ["c_mktsegment"])


@query("encode_ordinal", """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE -1 END AS code FROM orders""")
def _(spark, sf):
    out = preprocess.encode_ordinal(table(spark, sf, "orders"), "o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT"], "code")
    return out.select("o_orderkey", "code")


def _preprocessor():
    return preprocess.Preprocessor(["tenure", "monthly", "total"], ["segment"], {"contract": preprocess.CONTRACT_ORDER})


def _scaled_sql(c: str) -> str:
    filled = f"coalesce({c}, (SELECT median({c}) FROM {_TRAIN_ROWS}))"
    source = f"(SELECT {filled} AS v FROM {_TRAIN_ROWS})"
    return f"round(({filled} - (SELECT avg(v) FROM {source})) / (SELECT stddev_pop(v) FROM {source}), 6) AS {c}"


_PREPROCESSED = f"""SELECT customer_id, {_scaled_sql('tenure')}, {_scaled_sql('monthly')}, {_scaled_sql('total')},
  {', '.join(f"CASE WHEN segment = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS segment_{v}" for v in _LEVELS)},
  CASE contract WHEN 'Month-to-month' THEN 0.0 WHEN 'One year' THEN 1.0 ELSE 2.0 END::DOUBLE AS contract FROM {_TEST_ROWS}"""


@query("preprocess_fit_transform", _PREPROCESSED)
def _(spark, sf):
    train, test = _churn_split(spark, sf)
    return rounded(_preprocessor().fit(train).transform(test, ["customer_id"]))


_PARAMS = "\nUNION ALL ".join(f"""
SELECT '{c}' AS feature, round(median({c}), 9) AS median, round((SELECT avg(coalesce({c}, m)) FROM t, (SELECT median({c}) AS m FROM t)), 9) AS center,
  round((SELECT stddev_pop(coalesce({c}, m)) FROM t, (SELECT median({c}) AS m FROM t)), 9) AS scale FROM t""" for c in ("tenure", "monthly", "total"))


@query("save_transformer", f"WITH t AS {_TRAIN_ROWS}\n{_PARAMS}")
def _(spark, sf):
    """The numeric parameters of the saved transformer, read back."""
    path = scratch_path(spark, "transformer")
    _preprocessor().fit(_churn_split(spark, sf)[0]).save(spark, path)
    return rounded(preprocess.Preprocessor.load(spark, path).numeric_params(spark), 9)


@query("load_transformer", _PREPROCESSED)
def _(spark, sf):
    train, test = _churn_split(spark, sf)
    path = scratch_path(spark, "transformer")
    _preprocessor().fit(train).save(spark, path)
    return rounded(preprocess.Preprocessor.load(spark, path).transform(test, ["customer_id"]))


_X = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("anova_f", "\nUNION ALL ".join(f"""
SELECT '{c}' AS feature, round((sum(n * (m - g) ** 2) / (count(*) - 1)) / (sum(n * s) / (sum(n) - count(*))), 6) AS score
FROM (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS s FROM lineitem GROUP BY l_returnflag), (SELECT avg({c}) AS g FROM lineitem)""" for c in _X))
def _(spark, sf):
    return rounded(preprocess.anova_f(table(spark, sf, "lineitem"), _X, "l_returnflag"))


@query("f_regression", "\nUNION ALL ".join(f"""
SELECT '{c}' AS feature, round(corr({c}, l_extendedprice) ** 2 / (1 - corr({c}, l_extendedprice) ** 2) * (count(*) - 2), 4) AS score FROM lineitem"""
                                              for c in ("l_quantity", "l_discount", "l_tax")))
def _(spark, sf):
    return rounded(preprocess.f_regression(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"), 4)


@query("select_top_features", f"""
SELECT feature, round(score, 4) AS score FROM ({' UNION ALL '.join(
    f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) ** 2 / (1 - corr({c}, l_extendedprice) ** 2) * (count(*) - 2) AS score FROM lineitem"
    for c in ('l_quantity', 'l_discount', 'l_tax'))}) ORDER BY score DESC LIMIT 2""")
def _(spark, sf):
    out = preprocess.select_top_features(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", 2, "regression")
    return rounded(out, 4)


_FEATURES = ["n_lines", "quantity", "amount", "discount"]


@query("ols_normal_equation", """
SELECT 'intercept' AS feature, round(regr_intercept(l_extendedprice, l_quantity), 4) AS weight FROM lineitem
UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""")
def _(spark, sf):
    return rounded(linear.ols_normal_equation(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice").table(spark), 4)


@query("ols_many", f"""
WITH s AS (SELECT var_pop(quantity) AS v1, var_pop(discount) AS v2, covar_pop(quantity, discount) AS c, covar_pop(quantity, price) AS y1,
  covar_pop(discount, price) AS y2, avg(quantity) AS m1, avg(discount) AS m2, avg(price) AS my FROM {_ORDER_X}),
w AS (SELECT *, (y1 * v2 - y2 * c) / (v1 * v2 - c * c) AS a, (y2 * v1 - y1 * c) / (v1 * v2 - c * c) AS b FROM s)
SELECT 'intercept' AS feature, round(my - a * m1 - b * m2, 4) AS weight FROM w
UNION ALL SELECT 'quantity', round(a, 4) FROM w UNION ALL SELECT 'discount', round(b, 4) FROM w""")
def _(spark, sf):
    return rounded(linear.ols_normal_equation(_order_x(spark, sf), ["quantity", "discount"], "price").table(spark), 4)


@query("predict_linear", """
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 3) AS prediction FROM lineitem,
  (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    model = linear.ols_normal_equation(li, ["l_quantity"], "l_extendedprice")
    return rounded(model.predict(li).select("l_orderkey", "l_linenumber", "prediction"), 3)


_UNIT = "(SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem)"


def _unit(spark, sf):
    return table(spark, sf, "lineitem").select((F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 100000).alias("y"))


def _descent_sql(lr: float, epochs: int) -> str:
    return f"""
WITH RECURSIVE m AS (SELECT avg(x) AS x, avg(y) AS y, avg(x * x) AS xx, avg(x * y) AS xy, avg(y * y) AS yy FROM {_UNIT}),
g AS (SELECT 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b
  UNION ALL SELECT k + 1, a - {lr} * 2 * (a + b * x - y), b - {lr} * 2 * (a * x + b * xx - xy) FROM g, m WHERE k < {epochs})
SELECT k::BIGINT AS epoch, round(a * a + 2 * a * b * x + b * b * xx - 2 * a * y - 2 * b * xy + yy, 6) AS loss FROM g, m"""


@query("gd_linear", _descent_sql(0.1, 200))
def _(spark, sf):
    return rounded(linear.gd_linear(_unit(spark, sf), ["x"], "y", lr=0.1, epochs=200).loss_table(spark))


@query("fit_ridge", f"""
SELECT 'intercept' AS feature, round(avg(y) - covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 1) * avg(x), 6) AS weight FROM {_UNIT}
UNION ALL SELECT 'x', round(covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 1), 6) FROM {_UNIT}""")
def _(spark, sf):
    return rounded(linear.fit_ridge(_unit(spark, sf), ["x"], "y", 1.0).table(spark))


@query("fit_lasso", f"""
SELECT 'intercept' AS feature, round(avg(y) - greatest(covar_pop(x, y) - 0.01, 0) / var_pop(x) * avg(x), 6) AS weight FROM {_UNIT}
UNION ALL SELECT 'x', round(greatest(covar_pop(x, y) - 0.01, 0) / var_pop(x), 6) FROM {_UNIT}""")
def _(spark, sf):
    return rounded(linear.fit_lasso(_unit(spark, sf), ["x"], "y", 0.01).table(spark))


@query("fit_linear", f"""
SELECT 'intercept' AS feature, round(regr_intercept(y, x), 6) AS weight FROM {_UNIT}
UNION ALL SELECT 'x', round(regr_slope(y, x), 6) FROM {_UNIT}""")
def _(spark, sf):
    return rounded(linear.fit_linear(_unit(spark, sf), ["x"], "y").table(spark))


_SLOPES = {
    "ols": "covar_pop(x, y) / var_pop(x)", "ridge": "covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 1)",
    "lasso": "greatest(covar_pop(x, y) - 0.5, 0) / var_pop(x)", "library": "regr_slope(y, x)"}


def _linear_models(spark, sf):
    data = _unit(spark, sf)
    return data, {
        "ols": linear.ols_normal_equation(data, ["x"], "y"), "ridge": linear.fit_ridge(data, ["x"], "y", 1.0),
        "lasso": linear.fit_lasso(data, ["x"], "y", 0.5), "library": linear.fit_linear(data, ["x"], "y")}


@query("coef_table", "\nUNION ALL ".join(
    f"SELECT '{m}' AS model, 'x' AS feature, round({slope}, 3) AS weight, CASE WHEN {slope} = 0 THEN 1::BIGINT ELSE 0 END AS zeroed FROM {_UNIT}"
    for m, slope in _SLOPES.items()))
def _(spark, sf):
    return linear.coef_table(spark, _linear_models(spark, sf)[1])


@query("model_table", "\nUNION ALL ".join(f"""
SELECT '{m}' AS model, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - avg(e * e) / var_pop(y), 6) + 0.0 AS r2
FROM (SELECT y, y - (my + s * (x - mx)) AS e FROM {_UNIT}, (SELECT {slope} AS s, avg(x) AS mx, avg(y) AS my FROM {_UNIT}))""" for m, slope in _SLOPES.items()))
def _(spark, sf):
    data, fitted = _linear_models(spark, sf)
    out = rounded(models.model_table({n: m.predict(data) for n, m in fitted.items()}, "y", "regression"))
    return out.withColumn("r2", F.when(F.col("r2") == 0, 0.0).otherwise(F.col("r2")))


@query("regression_metrics", """
SELECT round(avg(abs(e)), 4) AS mae, round(avg(e * e), 2) AS mse, round(sqrt(avg(e * e)), 4) AS rmse,
  round(1 - avg(e * e) / var_pop(l_extendedprice), 6) AS r2 FROM (SELECT l_extendedprice, l_extendedprice - l_quantity * 2100 AS e FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 2100)
    return rounded(metrics.regression_metrics(li, "l_extendedprice", "guess"), 4, mse=2, r2=6)


@query("sigmoid", "SELECT event_id, round(CASE WHEN z >= 0 THEN 1 / (1 + exp(-z)) ELSE exp(z) / (1 + exp(z)) END, 9) AS p FROM (SELECT event_id, (value - 50) / 4 AS z FROM events)")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", ((F.col("value") - 50) / 4).alias("z"))
    return rounded(e.select("event_id", linear.sigmoid(F.col("z")).alias("p")), 9)


def _logistic_sql(lr: float, epochs: int) -> str:
    """The same descent, one common table expression per epoch."""
    p = "1 / (1 + exp(-(a + b * score)))"
    steps = ["w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for k in range(epochs):
        steps.append(f"w{k + 1} AS MATERIALIZED (SELECT any_value(a) - {lr} * avg({p} - quality) AS a, any_value(b) - {lr} * avg(({p} - quality) * score) AS b FROM d, w{k})")
    losses = [f"SELECT {k}::BIGINT AS epoch, round(-avg(quality * ln({p}) + (1 - quality) * ln(1 - {p})), 6) AS loss FROM d, w{k}" for k in range(epochs + 1)]
    return f"WITH d AS MATERIALIZED (SELECT score, quality FROM {SCORED_DOCS_SQL}),\n" + ",\n".join(steps) + "\n" + "\nUNION ALL ".join(losses)


@query("gd_logistic", _logistic_sql(0.3, 15))
def _(spark, sf):
    return rounded(linear.gd_logistic(scored_docs(spark, sf), ["score"], "quality", lr=0.3, epochs=15).loss_table(spark))


@query("loss_curve_data", _descent_sql(0.05, 500))
def _(spark, sf):
    return rounded(linear.gd_linear(_unit(spark, sf), ["x"], "y", lr=0.05, epochs=500).loss_table(spark))


@query("predict_logistic", f"""
SELECT doc_id, round(1 / (1 + exp(-(4 * score - 1.5))), 9) AS probability, CASE WHEN 1 / (1 + exp(-(4 * score - 1.5))) >= 0.5 THEN 1 ELSE 0 END AS prediction
FROM {SCORED_DOCS_SQL}""")
def _(spark, sf):
    model = linear.LinearModel(["score"], -1.5, [4.0])
    return rounded(linear.predict_logistic(scored_docs(spark, sf), model).select("doc_id", "probability", "prediction"), 9)


def _docs_x(spark, sf):
    docs = scored_docs(spark, sf)
    return docs.select("doc_id", "quality", "score", F.log1p(F.col("n_chars").cast("double")).alias("size"))


def _newton_steps(source: str, weight: str, rounds: int = 8) -> list[str]:
    """Newton steps on the penalised log-loss with one feature, one common table expression each; the last is ``n<rounds>``."""
    p = "(1 / (1 + exp(-(a + b * score))))"
    steps = [f"d AS MATERIALIZED (SELECT score, quality, {weight} AS w FROM {source})", "n0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for k in range(rounds):
        steps.append(f"""s{k} AS MATERIALIZED (SELECT any_value(a) AS a, any_value(b) AS b, sum(w * ({p} - quality)) AS g0,
  sum(w * ({p} - quality) * score) + any_value(b) AS g1, sum(w * {p} * (1 - {p})) AS h00, sum(w * {p} * (1 - {p}) * score) AS h01,
  sum(w * {p} * (1 - {p}) * score * score) + 1 AS h11 FROM d, n{k})""")
        steps.append(f"n{k + 1} AS (SELECT a - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS a, b - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b FROM s{k})")
    return steps


def _newton_sql(weight: str) -> str:
    steps = ",\n".join(_newton_steps(SCORED_DOCS_SQL, weight))
    return f"WITH {steps}\nSELECT 'intercept' AS feature, round(a, 3) AS weight FROM n8 UNION ALL SELECT 'score', round(b, 3) FROM n8"


@query("experiment_run", f"""
WITH x AS MATERIALIZED (SELECT s.doc_id, s.quality, s.is_test, d.score FROM {_STRATIFIED} s JOIN {SCORED_DOCS_SQL} d USING (doc_id)),
tr AS (SELECT * FROM x WHERE NOT is_test), te AS (SELECT * FROM x WHERE is_test),
{(","+chr(10)).join(_newton_steps("tr", "1.0"))},
major AS (SELECT quality AS m FROM tr GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
s AS (SELECT avg(CASE WHEN quality = m THEN 1.0 ELSE 0.0 END) AS base, avg(CASE WHEN quality = CASE WHEN 1 / (1 + exp(-(a + b * score))) > 0.5 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END) AS fitted
  FROM te, major, n8)
SELECT 'quality' AS dataset, 'classification' AS task, 2::BIGINT AS n_features, (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM te) AS n_test,
  'test_accuracy' AS metric, model, round(score, 9) AS score, round(score - base, 9) AS over_baseline
FROM (SELECT 'baseline' AS model, base AS score, base FROM s UNION ALL SELECT 'logistic_regression', fitted, base FROM s)""")
def _(spark, sf):
    labels = scored_docs(spark, sf).select("doc_id", "n_chars", "score", "quality")
    return rounded(models.compare_with_baseline("quality", labels, "doc_id", "quality", "classification", {"logistic_regression": ["score"]}), 9)


@query("fit_logistic", _newton_sql("1.0"))
def _(spark, sf):
    fitted = linear.fit_logistic(_docs_x(spark, sf), ["score"], "quality")
    return rounded(linear.as_linear_model(fitted, ["score"]).table(spark), 3)


@query("fit_logistic_balanced", _newton_sql("count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY quality))"))
def _(spark, sf):
    fitted = linear.fit_logistic(_docs_x(spark, sf), ["score"], "quality", balanced=True)
    return rounded(linear.as_linear_model(fitted, ["score"]).table(spark), 3)


@query("class_weights", "SELECT quality, round((SELECT count(*) FROM labels) / (2 * count(*)), 9) AS class_weight FROM labels GROUP BY 1")
def _(spark, sf):
    return rounded(linear.class_weights(table(spark, sf, "labels"), "quality"), 9)


@query("agreement", f"""
SELECT round(avg(CASE WHEN (score >= 0.5) = (n_chars >= 1500) THEN 1 ELSE 0 END), 9) AS agreement FROM {SCORED_DOCS_SQL}""")
def _(spark, sf):
    docs = scored_docs(spark, sf).withColumns({"a": F.col("score") >= 0.5, "b": F.col("n_chars") >= 1500})
    return rounded(metrics.agreement(docs, "a", "b"), 9)


_GUESS = f"(SELECT quality AS y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p, score FROM {SCORED_DOCS_SQL})"


@query("classification_metrics", f"""
WITH c AS (SELECT count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp FROM {_GUESS}),
a AS (SELECT (sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS auc
  FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM {_GUESS}))
SELECT tn, fp, fn, tp, round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1, round(auc::DOUBLE, 9) AS roc_auc FROM c, a""")
def _(spark, sf):
    docs = scored_docs(spark, sf).withColumn("p", (F.col("score") >= 0.5).cast("int"))
    return rounded(metrics.classification_metrics(docs, "quality", "p", "score"), 9)


@query("threshold_table", f"""
SELECT t AS threshold, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1
FROM (SELECT t, count(*) FILTER (score >= t AND y = 1) AS tp, count(*) FILTER (score >= t AND y = 0) AS fp, count(*) FILTER (score < t AND y = 1) AS fn
  FROM {_GUESS}, (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE)) AS v(t) GROUP BY 1)""")
def _(spark, sf):
    return rounded(metrics.threshold_table(scored_docs(spark, sf), "quality", "score", [0.3, 0.5, 0.7]), 9)


# Trees grow on features of few values, where every split is exact.
_TREE_X = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_SHORT_X = ["l_quantity", "l_linenumber"]
_LINES = "(SELECT *, l_orderkey * 10 + l_linenumber AS line_id FROM lineitem)"


def _lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn("line_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def _tree(spark, sf, depth: int):
    data = _lines(spark, sf).select(*_TREE_X, "l_extendedprice")
    return data, models.fit_model(data, _TREE_X, "l_extendedprice", "regression", "decision_tree", depth=depth)


def _grown_sql(source: str, features, levels: int) -> str:
    """Tables t0 ... of rows with their node after every level, and b0 ... of each level's splits, as the text after WITH."""
    parts = [f"t0 AS MATERIALIZED (SELECT [{', '.join(f'{c}::DOUBLE' for c in features)}] AS x, l_extendedprice AS y, is_train, 1::BIGINT AS node FROM {source})"]
    for k in range(levels):
        left = "sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt"
        parts.append(f"""c{k} AS (SELECT node, f, v, count(*)::DOUBLE AS n, sum(y) AS s, sum(y * y) AS q
  FROM (SELECT node, y, unnest(range(0, {len(features)})) AS f, unnest(x) AS v FROM t{k} WHERE is_train AND node >= {2 ** k}) GROUP BY ALL),
w{k} AS (SELECT node, f, v, sum(n) OVER a AS nl, sum(s) OVER a AS sl, sum(n) OVER b AS nt, sum(s) OVER b AS st, sum(q) OVER b AS qt, lead(v) OVER a AS after
  FROM c{k} WINDOW a AS (PARTITION BY node, f ORDER BY v), b AS (PARTITION BY node, f)),
b{k} AS MATERIALIZED (SELECT node, f, v + (after - v) / 2 AS cut, round(({left}) / (qt - st * st / nt), 9) AS share, (qt - st * st / nt) AS impurity
  FROM w{k} WHERE nl < nt AND qt - st * st / nt > 1e-9 * qt AND round(({left}) / (qt - st * st / nt), 9) > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY share DESC, f, v) = 1),
t{k + 1} AS MATERIALIZED (SELECT x, y, is_train, CASE WHEN b.node IS NULL THEN t.node WHEN x[f + 1] <= cut THEN 2 * t.node ELSE 2 * t.node + 1 END AS node
  FROM t{k} t LEFT JOIN b{k} b ON t.node = b.node)""")
    return ",\n".join(parts)


_ALL_LINES = f"(SELECT *, true AS is_train FROM {_LINES})"
_IMPORTANCES = f"""WITH {_grown_sql(_ALL_LINES, _TREE_X, 6)},
g AS (SELECT f, sum(share * impurity) AS gain FROM ({' UNION ALL '.join(f'SELECT * FROM b{k}' for k in range(6))}) GROUP BY 1),
n AS (SELECT unnest({_TREE_X}) AS feature, unnest(range(0, 4)) AS f)
SELECT feature, round(coalesce(gain, 0) / (SELECT sum(gain) FROM g), 6) AS importance FROM n LEFT JOIN g USING (f)"""


@query("fit_tree", f"""WITH {_grown_sql(_ALL_LINES, _TREE_X, 6)}, p AS (SELECT y, y - avg(y) OVER (PARTITION BY node) AS e FROM t6)
SELECT round(avg(abs(e)), 4) AS mae, round(avg(e * e), 2) AS mse, round(sqrt(avg(e * e)), 4) AS rmse, round(1 - avg(e * e) / var_pop(y), 6) AS r2 FROM p""")
def _(spark, sf):
    data, model = _tree(spark, sf, 6)
    return rounded(model.metrics(data, "l_extendedprice"), 4, mse=2, r2=6)


@query("fit_forest")
def _(spark, sf):
    docs = _docs_x(spark, sf)
    return models.fit_model(docs, ["score", "size"], "quality", "classification", "random_forest").metrics(docs, "quality")


@query("feature_importance", _IMPORTANCES)
def _(spark, sf):
    return rounded(models.feature_importance(_tree(spark, sf, 6)[1], spark))


@query("importance_data", f"SELECT * FROM ({_IMPORTANCES}) ORDER BY importance DESC, feature LIMIT 2")
def _(spark, sf):
    return rounded(models.feature_importance(_tree(spark, sf, 6)[1], spark, top=2))


@query("tree_data", f"""WITH {_grown_sql(_ALL_LINES, _TREE_X, 3)},
n AS ({' UNION '.join(f'SELECT node, avg(y) AS prediction, count(*) AS n, var_pop(y) AS impurity FROM t{k} GROUP BY node' for k in range(4))}),
u AS (SELECT node, any_value(prediction) AS prediction, any_value(n) AS n, any_value(impurity) AS impurity FROM n GROUP BY node),
b AS ({' UNION ALL '.join(f'SELECT * FROM b{k}' for k in range(3))})
SELECT u.node, round(prediction, 4) AS prediction, n, round(u.impurity, 1) AS impurity, round(share * u.impurity, 0) AS gain,
  CASE WHEN b.node IS NOT NULL THEN 2 * u.node END AS left_child, CASE WHEN b.node IS NOT NULL THEN 2 * u.node + 1 END AS right_child,
  ({_TREE_X})[f + 1] AS feature, cut AS threshold FROM u LEFT JOIN b ON u.node = b.node""")
def _(spark, sf):
    return rounded(models.tree_nodes(_tree(spark, sf, 3)[1], spark, scratch_path(spark, "tree")), 4, impurity=1, gain=0)


def _depth_score(k: int, part: str) -> str:
    return f"""(SELECT 1 - sum((y - m) ** 2) / sum((y - a) ** 2) FROM (SELECT t.y, m.m, avg(t.y) OVER () AS a
  FROM t{k} t JOIN (SELECT node, avg(y) AS m FROM t{k} WHERE is_train GROUP BY 1) m ON t.node = m.node WHERE {part}))"""


_DEPTHS = f"""WITH {_grown_sql(f"(SELECT *, NOT is_test AS is_train FROM {_test_sql(_LINES, 'line_id')})", _SHORT_X, 24)},
s AS ({' UNION ALL '.join(f"SELECT '{name}' AS max_depth, {_depth_score(k, 'is_train')} AS a, {_depth_score(k, 'NOT is_train')} AS b"
                          for name, k in (('1', 1), ('3', 3), ('5', 5), ('None', 24)))})"""


def _depths(spark, sf):
    train, test = split.train_test_split(_lines(spark, sf).select("line_id", *_SHORT_X, "l_extendedprice"), "line_id")
    return models.compare_depths(train, test, _SHORT_X, "l_extendedprice", "regression", [1, 3, 5, None])


@query("depth_analysis", _DEPTHS + "\nSELECT max_depth, round(a, 6) AS train_score, round(b, 6) AS test_score, round(a - b, 6) AS gap FROM s")
def _(spark, sf):
    return rounded(_depths(spark, sf))


@query("depth_curve_data", _DEPTHS + """
SELECT max_depth, 'train_score' AS part, round(a, 6) AS score FROM s UNION ALL SELECT max_depth, 'test_score', round(b, 6) FROM s""")
def _(spark, sf):
    return rounded(_depths(spark, sf).unpivot(["max_depth"], ["train_score", "test_score"], "part", "score"))


def _experiment(spark, sf):
    engineer = functools.partial(preprocess.engineer_features, tenure="tenure", monthly="monthly", total="total")
    prep = preprocess.Preprocessor(["tenure", "monthly", "total", "tenure_years", "avg_monthly_spend", "monthly_charge_x_tenure"], ["segment"],
                                   {"contract": preprocess.CONTRACT_ORDER, "tenure_bucket": preprocess.TENURE_BUCKETS})
    return models.experiment_data(_clean_churn(spark, sf), "customer_id", "churn", "classification", prep, engineer)


_EXPERIMENT_ROWS = """(SELECT *, CASE WHEN row_number() OVER (PARTITION BY churn ORDER BY {h}, customer_id) <= quota THEN 'test' ELSE 'train' END AS part
FROM (SELECT c.*, tenure / 12 AS tenure_years, total / greatest(tenure, 1) AS avg_monthly_spend, monthly * tenure AS monthly_charge_x_tenure FROM {c} c)
JOIN (WITH k AS (SELECT churn AS label, count(*) AS n, ceil(0.2 * any_value(t)) AS q, any_value(t) AS t FROM {c}, (SELECT count(*) AS t FROM {c}) GROUP BY 1)
  SELECT label, floor(q * n / t) + CASE WHEN row_number() OVER (ORDER BY q * n / t - floor(q * n / t) DESC, label) <= q - sum(floor(q * n / t)) OVER ()
    THEN 1 ELSE 0 END AS quota FROM k) ON churn = label)""".format(c=_CHURN_SQL, h=_hash("customer_id"))


def _experiment_feature(c: str, name: str) -> str:
    return f"""round((coalesce({c}, (SELECT median({c}) FROM tr)) - (SELECT avg(coalesce({c}, m)) FROM tr, (SELECT median({c}) AS m FROM tr)))
  / (SELECT stddev_pop(coalesce({c}, m)) FROM tr, (SELECT median({c}) AS m FROM tr)), 5) AS {name}"""


_ENGINEERED = ("tenure", "monthly", "total", "tenure_years", "avg_monthly_spend", "monthly_charge_x_tenure")


@query("experiment_data", f"""
WITH e AS MATERIALIZED (SELECT * FROM {_EXPERIMENT_ROWS}), tr AS (SELECT * FROM e WHERE part = 'train')
SELECT customer_id, churn, {', '.join(_experiment_feature(c, f'f{i}') for i, c in enumerate(_ENGINEERED))},
  {', '.join(f"CASE WHEN segment = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS f{6 + i}" for i, v in enumerate(_LEVELS))},
  CASE contract WHEN 'Month-to-month' THEN 0.0 WHEN 'One year' THEN 1.0 ELSE 2.0 END::DOUBLE AS f11,
  CASE WHEN tenure <= 12 THEN 0.0 WHEN tenure <= 24 THEN 1.0 WHEN tenure <= 48 THEN 2.0 WHEN tenure <= 60 THEN 3.0 ELSE 4.0 END::DOUBLE AS f12, part
FROM e""")
def _(spark, sf):
    data = _experiment(spark, sf)
    part = lambda d, n: d.withColumn("part", F.lit(n))
    return rounded(part(data["train"], "train").unionByName(part(data["test"], "test")), 5)


@query("model_compare")
def _(spark, sf):
    data = _experiment(spark, sf)
    return models.compare_models(data["train"], data["test"], data["features"], "churn", "classification")


@query("fit_preprocessed_model")
def _(spark, sf):
    train, test = split.train_test_split(_clean_churn(spark, sf), "customer_id", stratify="churn")
    fitted = models.fit_with_preprocessing(train, _preprocessor(), "churn", "classification", "logistic_regression")
    return fitted.metrics(test, "churn")


# The same under the name of the survey.
QUERIES["fit_pipeline"] = QUERIES["fit_preprocessed_model"]


@query("model_bundle")
def _(spark, sf):
    data, path = _experiment(spark, sf), scratch_path(spark, "bundle")
    models.train_and_save(data, "churn", "decision_tree", path)
    return spark.read.text(f"{path}/metrics")


@query("train_job")
def _(spark, sf):
    """The training command on the churn-like table, written as CSV first."""
    from jobs import train

    source, out = scratch_path(spark, "train-input"), scratch_path(spark, "train-output")
    _churn(spark, sf).write.option("header", True).csv(source)
    code = train.main(["--task", "classification", "--model", "logistic_regression", "--input", source, "--output-dir", out,
                       "--id", "customer_id", "--target", "churn", "--numeric", "tenure,monthly,total", "--nominal", "segment,contract"])
    return spark.read.text(f"{out}/metrics").withColumn("exit_code", F.lit(code))
