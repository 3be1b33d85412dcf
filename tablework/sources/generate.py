"""Generated tables: per-row expressions of the ids of a given table.

Random columns are functions of (id, seed), so the same call gives the same table
whatever the partitioning and however often a task is retried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.semantics import clip, hash_normal, hash_uniform
from tablework.operators.pick import pick_many, pick_smallest, sample_rows


def gen_range(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    return spark.range(start, stop, step).withColumnRenamed("id", "value")


def gen_linspace(spark: SparkSession, start: float, stop: float, num: int) -> DataFrame:
    """``num`` even points, both ends included."""
    if num < 1:
        raise ValueError("num must be positive")
    step = (stop - start) / (num - 1) if num > 1 else 0.0
    return spark.range(num).select(F.col("id").alias("idx"), (F.lit(float(start)) + F.col("id") * F.lit(step)).alias("value"))


def gen_constant(keys: DataFrame, id_col: str, cols: int, value: float) -> DataFrame:
    """Matrix cells that all hold one value, a matrix row for each id."""
    return _cells(keys, id_col, cols).withColumn("v", F.lit(float(value)))


def _cells(keys: DataFrame, id_col: str, cols: int) -> DataFrame:
    return keys.select(F.col(id_col).cast("long").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long"))).alias("j"))


def gen_identity(keys: DataFrame, id_col: str) -> DataFrame:
    """Identity matrix over the ids; cells that are 0 are left out."""
    key = F.col(id_col).cast("long")
    return keys.select(key.alias("i"), key.alias("j"), F.lit(1.0).alias("v"))


def gen_uniform(keys: DataFrame, id_col: str, cols: int, seed: int = 42) -> DataFrame:
    """Matrix cells uniform in [0, 1), a matrix row for each id."""
    return _cells(keys, id_col, cols).withColumn("v", hash_uniform(F.col("i") * cols + F.col("j"), seed))


def gen_scores(keys: DataFrame, id_col: str, subjects, seed: int = 42, mean: float = 70.0, std: float = 15.0) -> DataFrame:
    """A normal score in 0..100 per row and subject."""
    return keys.select(id_col, *[
        clip(F.lit(mean) + F.lit(std) * hash_normal(id_col, seed + k), 0.0, 100.0).alias(s) for k, s in enumerate(subjects)
    ])


def _weighted(weights: dict, u: Column) -> Column:
    """The value in whose share of [0, 1) ``u`` falls; shares go by weight, in the given order."""
    total, edge, out = sum(weights.values()), 0.0, F.when(F.lit(False), F.lit(None).cast("string"))
    for value, weight in weights.items():
        edge += weight / total
        out = out.when(u < F.lit(edge), F.lit(value))
    return out.otherwise(F.lit(list(weights)[-1]))  # the edges may end just below 1


def gen_orders(keys: DataFrame, id_col: str, domains: dict, first_day: str, days: int, names: int, null_names: int = 5, seed: int = 42) -> DataFrame:
    """An order per id: a customer out of ``names``, a value of each of ``domains`` ({column: {value: weight}}), a quantity,
    a price and a day; exactly ``null_names`` customers are missing."""
    u = lambda k: hash_uniform("order_id", seed + k)
    rows = keys.select(F.col(id_col).cast("long").alias("order_id")).select(
        "order_id", F.concat(F.lit("Customer "), (F.floor(u(1) * names) + 1).cast("string")).alias("customer_name"),
        *[_weighted(weights, u(10 + k)).alias(c) for k, (c, weights) in enumerate(domains.items())],
        (F.floor(u(3) * 9) + 1).alias("quantity"), F.round(F.lit(5.0) + u(5) * 495, 2).alias("unit_price"),
        F.date_add(F.lit(first_day).cast("date"), F.floor(u(4) * days).cast("int")).alias("order_date"))
    blank = pick_smallest(rows, "order_id", seed + 7, lambda _, total: min(null_names, total))
    return rows.withColumn("customer_name", F.when(~blank, F.col("customer_name")))


def gen_distributions(keys: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """Samples of Normal(50, 10), Binomial(20, 0.3) and Poisson(4), a draw of each for every id."""
    rows = keys.select(F.col(id_col).cast("long").alias("id")).withColumn("_u", hash_uniform("id", seed + 200))
    successes = F.aggregate(
        F.array(*[(hash_uniform("id", seed + 100 + k) < 0.3).cast("int") for k in range(20)]), F.lit(0), lambda a, x: a + x)
    # Poisson by its inverse distribution function: the number of counts whose cumulated probability u has passed
    cumulated, term = [], math.exp(-4)
    for k in range(41):
        cumulated.append((cumulated[-1] if cumulated else 0.0) + term)
        term *= 4 / (k + 1)
    passed = F.size(F.filter(F.array(*[F.lit(p) for p in cumulated]), lambda p: p <= F.col("_u")))
    return rows.select(
        "id", (F.lit(50.0) + 10.0 * hash_normal("id", seed)).alias("normal"),
        successes.cast("double").alias("binomial"), passed.cast("double").alias("poisson"))


def compare_moments(samples: DataFrame) -> DataFrame:
    """Theoretical against empirical mean and variance of the three distributions."""
    theory = {"normal": (50.0, 100.0), "binomial": (6.0, 4.2), "poisson": (4.0, 4.0)}
    wide = samples.agg(*[F.struct(F.avg(c).alias("m"), F.var_pop(c).alias("v")).alias(c) for c in theory])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("distribution"), F.lit(m).alias("mean_theory"), F.col(f"{c}.m").alias("mean_sample"),
                 F.lit(v).alias("var_theory"), F.col(f"{c}.v").alias("var_sample"))
        for c, (m, v) in theory.items()
    ])))


def inject_dirty(df: DataFrame, id_col: str, null_share: float, duplicates: int, seed: int = 42) -> DataFrame:
    """Blank exactly ``int(n * null_share)`` cells of every other column and append repeated rows."""
    others = [c for c in df.columns if c != id_col]
    share = lambda _, n: int(n * null_share)
    picks = pick_many(df, id_col, {c: (seed + k, share) for k, c in enumerate(others)})
    dirty = df.withColumns({c: F.when(~p, F.col(c)) for c, p in picks.items()})
    if not duplicates:
        return dirty
    return dirty.unionByName(sample_rows(dirty, duplicates, id_col, seed + len(others)))
