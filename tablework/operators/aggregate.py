"""Grouping, ranking, sampling, pivoting, binning and resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.functions.semantics import all_not_null, col, cut, flag, require_columns, sum0
from tablework.operators.order import materialize, ordered_index
from tablework.operators.quantiles import column_quantiles, group_medians, group_quantiles

_PLANNED_LIMIT = 1000  # spark.sql.optimizer.windowGroupLimitThreshold
_SALTS = 256
TERCILES = [0.0, 0.33, 0.66, 1.0]
TIERS = ["Low", "Medium", "High"]

# Aggregates by name; first and last follow an explicit order, median is an exact quantile.
AGGREGATES = {
    "sum": sum0, "mean": F.avg, "count": F.count, "min": F.min, "max": F.max,
    "std": F.stddev_samp, "var": F.var_samp, "nunique": F.count_distinct,
}


def group_agg(df: DataFrame, by, **named) -> DataFrame:
    """Named aggregates per group: ``name=(column, function)``; missing keys form no group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.filter(all_not_null(by)).groupBy(*by).agg(
        *[AGGREGATES[fn](c).alias(name) for name, (c, fn) in named.items()]
    )


def group_aggregate(df: DataFrame, by, spec: dict, order_by: str | None = None) -> DataFrame:
    """``{column: function | [functions]}`` per group, as flat columns ``column_function``."""
    by = [by] if isinstance(by, str) else list(by)
    require_columns(df, [*by, *spec])
    rows = df.filter(all_not_null(by))
    exprs, medians, names = [], [], []
    for c, fns in spec.items():
        for fn in [fns] if isinstance(fns, str) else fns:
            names.append(f"{c}_{fn}")
            if fn == "median":
                medians.append(c)
            elif fn in ("first", "last"):
                if order_by is None:
                    raise ValueError("first and last need order_by")
                pick = F.min_by if fn == "first" else F.max_by
                exprs.append(pick(c, F.when(F.col(c).isNotNull(), F.col(order_by))).alias(names[-1]))
            elif fn in AGGREGATES:
                exprs.append(AGGREGATES[fn](c).alias(names[-1]))
            else:
                raise ValueError(f"unknown aggregate {fn!r}")
    out = rows.groupBy(*by).agg(*exprs) if exprs else rows.select(*by).distinct()
    if medians:  # one search for all of them
        out = out.join(group_medians(rows, by, medians), by, "left")
    return out.select(*by, *names)


def group_median(df: DataFrame, by, column: str, out: str) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return group_quantiles(df, by, column, [0.5], [out]).orderBy(F.desc(out), *by)


def group_transform(df: DataFrame, by: str, column: str, mean: str, deviation: str) -> DataFrame:
    """Group mean on every row and the deviation from it.

    The table of means is written first, so that its size is known when the join is planned:
    a small one is broadcast and no row moves; a large one is joined by key, where adaptive
    execution splits a hot group. A window would put each group into one task.
    """
    means = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(column).alias(mean))
    return df.join(materialize(means, "means"), by, "left").withColumn(deviation, F.col(column) - F.col(mean))


def top_n_per_group(df: DataFrame, by: str, sort: str, n: int, id_col: str) -> DataFrame:
    """The ``n`` largest rows per group; each task cuts its groups to ``n`` before the shuffle.

    The planner makes that cut only for small ``n``; for larger ones a salted round first
    spreads a hot group over tasks.
    """
    order = [F.desc_nulls_last(sort), F.col(id_col)]
    rows = df.filter(F.col(by).isNotNull())
    keep = lambda d, keys: d.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")
    if n > _PLANNED_LIMIT:
        rows = keep(rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(_SALTS))), [by, "_salt"]).drop("_salt")
    return keep(rows, [by])


def top_k(df: DataFrame, by: str, k: int, id_col: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), F.col(id_col)).limit(k)


def sort_rows(df: DataFrame, by: str, id_col: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), F.col(id_col))


def rank_rows(df: DataFrame, score: str, id_col: str, out: str = "rank") -> DataFrame:
    """0-based rank of every row, best score first; equal scores rank the larger id first."""
    return ordered_index(df, [F.desc_nulls_last(score), F.desc(id_col)], out)


def row_mean(df: DataFrame, columns, out: str) -> DataFrame:
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return df.withColumn(out, total / len(columns))


def at_risk(df: DataFrame, columns, threshold: float, id_col: str) -> DataFrame:
    """Ids of rows whose mean over ``columns`` is below the threshold, ascending."""
    scored = row_mean(df, columns, "row_mean")
    return scored.filter(F.col("row_mean") < threshold).select(id_col, "row_mean").orderBy(id_col)


def group_extremes(df: DataFrame, by: str, column: str) -> DataFrame:
    """Best and worst group by mean and the gap in percent; equal means go to the smaller key."""
    means = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(column).alias("m"))
    best = F.min(F.struct((-F.col("m")).alias("neg"), F.col(by).alias("k")))
    worst = F.min(F.struct(F.col("m").alias("m"), F.col(by).alias("k")))
    ends = means.filter(F.col("m").isNotNull()).agg(best.alias("b"), worst.alias("w"))
    return ends.select(
        F.col("b.k").alias("best_group"), (-F.col("b.neg")).alias("best_mean"),
        F.col("w.k").alias("worst_group"), F.col("w.m").alias("worst_mean"),
        ((F.try_divide(-F.col("b.neg"), F.col("w.m")) - 1) * 100).alias("pct_gap"),
    )


def value_counts(df: DataFrame, columns) -> DataFrame:
    """Frequency of every value of every listed column, in one pass; missing values are skipped."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return (
        df.select(F.inline(entries)).filter(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count("*").alias("n"))
        .orderBy("column_name", F.desc("n"), "value")
    )


def value_share(df: DataFrame, column: str, out: str = "share") -> DataFrame:
    """Share of every value among non-missing ones."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, (F.col("n") / total).alias(out))


def compare_shares(full: DataFrame, train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Class shares of the whole table and of its two parts, with the widest gap."""
    parts = [value_share(d, column, n) for d, n in ((full, "full"), (train, "train"), (test, "test"))]
    out = parts[0].join(parts[1], column, "full").join(parts[2], column, "full")
    gaps = [F.abs(F.col(p) - F.col("full")) for p in ("train", "test")]
    return out.withColumn("max_gap", F.greatest(*gaps))


def category_pct(df: DataFrame, column: str, values) -> DataFrame:
    """Percentage of rows that hold each listed value."""
    share = lambda v: F.avg(flag(F.col(column) == v).cast("int")) * 100
    return df.agg(*[share(v).alias(str(v)) for v in values]).unpivot([], [str(v) for v in values], "value", "pct")


def pivot_summary(df: DataFrame, index: str, columns: str, values: str, fn: str, levels=None) -> DataFrame:
    """Cross-table of an aggregate. Levels without any value disappear. Every level is a column, so the levels are
    known to the driver; ``pivot_sparse`` has no such need."""
    require_columns(df, [index, columns, values])
    rows = df.filter(F.col(index).isNotNull() & F.col(columns).isNotNull())
    if levels is None:
        found = rows.filter(F.col(values).isNotNull()).select(columns).distinct().orderBy(columns)
        levels = [r[0] for r in found.collect()]
    return rows.groupBy(index).pivot(columns, levels).agg(AGGREGATES[fn](values))


def pivot_sparse(df: DataFrame, index: str, columns: str, values: str, fn: str) -> tuple[DataFrame, DataFrame]:
    """Cross-table for any number of levels: ``(index, cells)`` with ``cells`` an array of (level number, value) in order
    of the number, and the dictionary ``(level_no, level)``, numbered in order of the levels."""
    require_columns(df, [index, columns, values])
    rows = df.filter(F.col(index).isNotNull() & F.col(columns).isNotNull() & F.col(values).isNotNull())
    cells = materialize(rows.groupBy(index, F.col(columns).alias("level")).agg(AGGREGATES[fn](values).alias("value")), "pivot-cells")
    levels = ordered_index(cells.select("level").distinct(), ["level"], "level_no")
    wide = cells.join(levels, "level").groupBy(index).agg(F.array_sort(F.collect_list(F.struct("level_no", "value"))).alias("cells"))
    return wide, levels.select("level_no", "level")


def bin_cut(df: DataFrame, column: str, edges, labels, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{column}_category", cut(column, edges, labels))


def edges_between(marks) -> list[float]:
    """Bin edges from minimum, .33 and .66 quantile and maximum: the extremes widened by 1, without repeats; none without values."""
    lo, q1, q2, hi = marks
    return [] if lo is None else sorted({lo - 1, q1, q2, hi + 1})


def bin_terciles(df: DataFrame, column: str) -> DataFrame:
    """How many rows fall into the Low, Medium and High third of a column; no rows for a column without values."""
    edges = edges_between(column_quantiles(df, [column], TERCILES)[column])
    if not edges:
        return df.sparkSession.createDataFrame([], "tier string, n long")
    binned = bin_cut(df, column, edges, TIERS[: len(edges) - 1], "tier")
    return binned.filter(F.col("tier").isNotNull()).groupBy("tier").agg(F.count("*").alias("n"))


def resample_sum(df: DataFrame, date: str, value: str, freq: str = "month") -> DataFrame:
    """Sum per period, labelled with the last day of the period; empty periods give 0."""
    day = F.to_date(F.col(date))
    # a week runs Monday to Sunday and is labelled with its Sunday
    label = {
        "month": F.last_day(day),
        "week": F.next_day(F.date_sub(day, 1), "SUN"),
        "day": day,
    }
    if freq not in label:
        raise ValueError(f"freq must be one of {sorted(label)}")
    rows = df.select(label[freq].alias("period"), F.col(value).alias("_v")).filter(all_not_null(["period", "_v"]))
    # one row per period, read twice below
    sums = materialize(rows.groupBy("period").agg(F.sum("_v").alias("total")), "periods")
    step = {"month": "interval 1 month", "week": "interval 7 days", "day": "interval 1 day"}[freq]
    spine = sums.agg(F.min("period").alias("a"), F.max("period").alias("b")).filter(F.col("a").isNotNull())
    first = F.trunc("a", "month") if freq == "month" else F.col("a")
    spine = spine.select(F.explode(F.sequence(first, F.col("b"), F.expr(step))).alias("period"))
    if freq == "month":
        spine = spine.select(F.last_day("period").alias("period"))
    return spine.join(sums, "period", "left").select("period", F.coalesce("total", F.lit(0.0)).alias("total"))


def distinct_count(df: DataFrame, columns, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns]).unpivot([], list(columns), "column_name", "n_distinct")


def scalar_metrics(df: DataFrame, column: str) -> DataFrame:
    """Total and mean (4 decimals) of a column; 0 for an empty one."""
    return df.agg(
        sum0(column).alias("total"),
        F.coalesce(F.round(F.avg(col(column)), 4), F.lit(0.0)).alias("mean"),
    )
