"""Equi-joins with missing keys matching missing keys, unions and positional pasting.

No join strategy is forced: lookups below ``spark.sql.autoBroadcastJoinThreshold`` are
broadcast by the optimiser from their known size, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.semantics import require_columns
from tablework.operators.order import ordered_index


def _same_keys(on, left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in on])


def merge(left: DataFrame, right: DataFrame, on, how: str = "inner", suffixes=("_x", "_y")) -> DataFrame:
    """Join on equal key columns; clashing other columns get suffixes, the keys appear once.

    An outer join is a left join plus the unmatched right rows: adaptive execution can split
    a hot key in both of these, but not in a full outer join.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unknown join type {how!r}")
    require_columns(left, on)
    require_columns(right, on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    left_rest = [c for c in left.columns if c not in on]
    right_rest = [c for c in right.columns if c not in on]
    kind = "left" if how == "outer" else how
    side = "r" if how == "right" else "l"
    joined = left.alias("l").join(right.alias("r"), _same_keys(on, "l", "r"), kind).select(
        *[F.col(f"{side}.{k}").alias(k) for k in on],
        *[F.col(f"l.{c}") for c in left_rest],
        *[F.col(f"r.{c}") for c in right_rest],
    )
    if how != "outer":
        return joined
    return joined.unionByName(unmatched(right, left, on), allowMissingColumns=True)


def unmatched(rows: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows whose key does not occur in ``other``; only distinct keys of it are moved."""
    on = [on] if isinstance(on, str) else list(on)
    keys = other.select(*on).distinct()
    return rows.alias("l").join(keys.alias("r"), _same_keys(on, "l", "r"), "left_anti")


def join_counts(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Row counts of the four join types, from per-key counts: nothing is joined row by row."""
    on = [on] if isinstance(on, str) else list(on)
    a = left.groupBy(*on).agg(F.count("*").alias("_a"))
    b = right.groupBy(*on).agg(F.count("*").alias("_b"))
    pairs = a.alias("l").join(b.alias("r"), _same_keys(on, "l", "r"), "full")
    x, y = F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    wide = pairs.agg(
        total(x * y).alias("inner"),
        total(x * F.greatest(y, F.lit(1))).alias("left"),
        total(F.greatest(x, F.lit(1)) * y).alias("right"),
        total(F.greatest(x, F.lit(1)) * F.greatest(y, F.lit(1))).alias("outer"),
    )
    return wide.unpivot([], ["inner", "left", "right", "outer"], "how", "row_count")


def concat_rows(*frames: DataFrame) -> DataFrame:
    """Stack tables with the same columns."""
    first = frames[0]
    for other in frames[1:]:
        if set(other.columns) != set(first.columns):
            raise ValueError(f"columns differ: {first.columns} and {other.columns}")
    return reduce(DataFrame.unionByName, frames)


def concat_cols(left: DataFrame, left_order, right: DataFrame, right_order) -> DataFrame:
    """Paste two tables side by side by position; both must have the same number of rows."""
    if left.count() != right.count():
        raise ValueError("tables have different numbers of rows")
    a = ordered_index(left, left_order, "_idx")
    b = ordered_index(right, right_order, "_idx")
    return a.join(b, "_idx").drop("_idx")
