"""Query registry and the derived input tables that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(column, digits: int = 6):
    """Rounded column under its own name, to absorb summation order."""
    return F.round(F.col(column), digits).alias(column)


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every floating column; ``special`` gives other digits by column."""
    return df.select(*[
        F.round(F.col(f"`{n}`"), special.get(n, digits)).alias(n) if t in ("double", "float") else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


# The given tables hold no gaps, so gaps, bad text and unmatched keys are derived by fixed rules.
GAPPY_ORDERS_SQL = """(SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
  CASE WHEN o_orderkey % 13 = 4 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders)"""


def gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    gap = lambda c, m, k: F.when(F.col("o_orderkey") % m != k, F.col(c)).alias(c)
    return o.withColumn("o_orderdate", F.to_date("o_orderdate")).select(
        "o_orderkey", "o_custkey", gap("o_orderstatus", 10, 3), gap("o_totalprice", 7, 2),
        gap("o_orderdate", 11, 5), gap("o_orderpriority", 13, 4))


GAPPY_EVENTS_SQL = """(SELECT event_id, user_id, event_type,
  CASE WHEN event_id % 3 = 0 THEN value END AS value FROM events)"""


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))


SCORED_DOCS_SQL = """(SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic,
  CAST(d.n_chars AS DOUBLE) / (1000 + d.n_chars) AS score
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score from their length."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return d.join(labels, "doc_id").withColumn("score", F.col("n_chars").cast("double") / (F.lit(1000) + F.col("n_chars")))
