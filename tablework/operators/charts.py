"""The numbers behind charts: each function returns the rows a plot would draw."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.semantics import all_not_null, numeric_names, pearson_expr, sum0
from tablework.operators.aggregate import resample_sum
from tablework.operators.order import materialize
from tablework.operators.quantiles import group_quantiles
from tablework.operators.stats import corr_matrix

_KERNEL_ROWS = 4096
_FOLDED = 10_000  # categories a task holds at once


def histogram_bins(n: int) -> int:
    return min(20, max(5, n // 3))


def _bin_index(x: Column, low: Column, width: Column, bins: Column) -> Column:
    """Equal-width bin; the last one is closed, and a constant column falls into bin 0."""
    return F.least(F.coalesce(F.floor(F.try_divide(x - low, width)), F.lit(0)), bins - 1).cast("bigint")


def hist_data(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """Bin counts over [min, max] plus mean and one-std marks on every row; empty bins give 0."""
    x = F.col(column).cast("double")
    s = df.agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
               F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")).first()
    schema = "bin long, bin_start double, bin_end double, mean double, mark_low double, mark_high double"
    if not s["n"]:
        return df.sparkSession.createDataFrame([], schema + ", n long")
    bins = bins or histogram_bins(s["n"])
    lo, hi = (s["lo"], s["hi"]) if s["hi"] > s["lo"] else (s["lo"] - 0.5, s["hi"] + 0.5)
    width = (hi - lo) / bins
    frame = df.sparkSession.createDataFrame(
        [(b, lo + b * width, lo + (b + 1) * width, s["mean"], s["mean"] - s["std"], s["mean"] + s["std"]) for b in range(bins)], schema)
    index = _bin_index(x, F.lit(lo), F.lit(width), F.lit(bins))
    counts = df.filter(x.isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    return frame.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _box_fences(df: DataFrame, value: str, by: str) -> DataFrame:
    q = group_quantiles(df, [by], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"lo": F.col("q1") - 1.5 * iqr, "hi": F.col("q3") + 1.5 * iqr})


def box_data(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, whiskers (last values inside 1.5 IQR) and number of outliers per category."""
    rows = df.select(by, F.col(value).cast("double").alias("_v")).filter(all_not_null([by, "_v"]))
    joined = rows.join(_box_fences(df, value, by), by)
    inside = F.when(F.col("_v").between(F.col("lo"), F.col("hi")), F.col("_v"))
    return joined.groupBy(by).agg(
        F.any_value("q1").alias("q1"), F.any_value("median").alias("median"), F.any_value("q3").alias("q3"),
        F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"),
        (F.count("*") - F.count(inside)).alias("n_outliers"),
    )


def box_outliers(df: DataFrame, value: str, by: str) -> DataFrame:
    """The rows a box plot draws as single points."""
    fences = _box_fences(df, value, by).select(by, "lo", "hi")
    return df.join(fences, by).filter(~F.col(value).between(F.col("lo"), F.col("hi"))).select(*df.columns)


def scatter_data(df: DataFrame, x: str, y: str, id_col: str) -> DataFrame:
    """Complete (x, y) points with r on every row; empty with fewer than two points."""
    points = df.select(id_col, x, y).filter(all_not_null([x, y]))
    stats = points.agg(F.count("*").alias("n"), pearson_expr(x, y).alias("r")).first()
    if stats["n"] < 2:
        points = points.limit(0)
    return points.withColumn("r", F.lit(stats["r"]).cast("double"))


def bar_data(df: DataFrame, category: str, value: str | None = None) -> DataFrame:
    """Rows, or the sum of a value, per category, largest first."""
    height = F.count("*") if value is None else sum0(value)
    return (
        df.filter(F.col(category).isNotNull()).groupBy(category).agg(height.alias("height"))
        .orderBy(F.desc("height"), category)
    )


def count_data(df: DataFrame, category: str) -> DataFrame:
    return bar_data(df, category)


def line_data(df: DataFrame, date: str, value: str, freq: str = "month") -> DataFrame:
    return resample_sum(df, date, value, freq)


def dashboard_data(df: DataFrame, x: str, y: str, category: str, id_col: str) -> dict[str, DataFrame]:
    """The four dashboard panels; the histogram has 15 bins."""
    return {
        "histogram": hist_data(df, y, 15),
        "box": box_data(df, y, category),
        "scatter": scatter_data(df, x, y, id_col),
        "bar": bar_data(df, category),
    }


def heatmap_data(df: DataFrame, columns=None) -> DataFrame:
    return corr_matrix(df, columns).withColumn("r", F.round("r", 2))


def pairplot_points(df: DataFrame, columns, hue: str, id_col: str) -> DataFrame:
    """Points of every pair of columns (lower triangle), with their category."""
    columns = list(columns or numeric_names(df, skip_ids=True))
    rows = df.select(id_col, hue, *columns).filter(all_not_null([hue, *columns]))
    pairs = F.array(*[
        F.struct(F.lit(a).alias("x_name"), F.lit(b).alias("y_name"),
                 F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        for a, b in combinations(columns, 2)
    ])
    return rows.select(id_col, hue, F.inline(pairs))


def pairplot_hist(df: DataFrame, columns, hue: str, bins: int = 10) -> DataFrame:
    """Histogram of each column per category; one bin grid per column, from one extent pass."""
    columns = list(columns or numeric_names(df, skip_ids=True))
    rows = df.select(hue, *columns).filter(all_not_null([hue, *columns]))
    ext = rows.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns]).first()
    cells = []
    for c in columns:
        if ext[c]["lo"] is not None:
            width = (ext[c]["hi"] - ext[c]["lo"]) / bins
            index = _bin_index(F.col(c).cast("double"), F.lit(ext[c]["lo"]), F.lit(width), F.lit(bins))
            cells.append(F.struct(F.lit(c).alias("column_name"), index.alias("bin")))
    if not cells:
        return df.sparkSession.createDataFrame([], f"column_name string, {hue} string, bin long, n long")
    return rows.select(hue, F.inline(F.array(*cells))).groupBy("column_name", hue, "bin").agg(F.count("*").alias("n"))


def violin_data(df: DataFrame, value: str, by: str, points: int = 100) -> DataFrame:
    """Gaussian density per category on an even grid, two bandwidths past the data.

    The bandwidth is Scott's (sample std x n^-1/5). Every task folds its rows into one array of ``points`` kernel sums a category,
    and only these arrays move, so a hot category stays spread and neither values nor kernels are rows.
    """
    rows = df.select(by, F.col(value).cast("double").alias("v")).filter(all_not_null([by, "v"]))
    stats = materialize(rows.groupBy(by).agg(
        F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        (F.stddev_samp("v") * F.pow(F.count("*").cast("double"), F.lit(-0.2))).alias("h"),
    ), "violin").filter("h > 0")
    start, step = F.col("lo") - 2 * F.col("h"), (F.col("hi") - F.col("lo") + 4 * F.col("h")) / (points - 1)

    def fold(batches):
        sums: dict = {}

        def flushed():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(sums), kind), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], names=[by, "sums"])
            sums.clear()
            return out

        kind = None
        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            kind = batch.schema.field(0).type
            codes = keys.indices.to_numpy()
            v, lo, gap, h = (batch.column(i).to_numpy() for i in range(1, 5))
            for code, key in enumerate(keys.dictionary.to_pylist()):
                own = np.flatnonzero(codes == code)
                at = lo[own[0]] + np.arange(points) * gap[own[0]]
                total = sums.setdefault(key, np.zeros(points))
                distinct, times = np.unique(v[own], return_counts=True)
                for k in range(0, len(distinct), _KERNEL_ROWS):
                    z = (at[None, :] - distinct[k:k + _KERNEL_ROWS, None]) / h[own[0]]
                    total += times[k:k + _KERNEL_ROWS] @ np.exp(-0.5 * z * z)
            if len(sums) > _FOLDED:
                yield flushed()
        if sums:
            yield flushed()

    schema = T.StructType([T.StructField(by, df.schema[by].dataType), T.StructField("sums", T.ArrayType(T.DoubleType()))])
    shaped = rows.join(stats.select(by, start.alias("_lo"), step.alias("_step"), "h"), by).select(by, "v", "_lo", "_step", "h")
    parts = shaped.mapInArrow(fold, schema).select(by, F.posexplode("sums").alias("point", "part")).groupBy(by, "point").agg(F.sum("part").alias("part"))
    return parts.join(stats, by).select(
        by, "point", (start + F.col("point") * step).alias("x"), (F.col("part") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))


def regression_line_data(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Fitted line with a 95% band on an even grid, from one pass of moments.

    The band is the closed-form standard error of the mean response (normal quantile).
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    pairs = df.select(a.alias("x"), b.alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    s = pairs.agg(
        F.count("*").alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_pop("x").alias("vx"),
        F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("cxy"), F.min("x").alias("lo"), F.max("x").alias("hi"),
    ).first()
    schema = "point long, x double, fit double, band_low double, band_high double, slope double, intercept double, r double"
    if s["n"] < 2 or not s["vx"]:
        return df.sparkSession.createDataFrame([], schema)
    slope = s["cxy"] / s["vx"]
    intercept = s["my"] - slope * s["mx"]
    r = s["cxy"] / math.sqrt(s["vx"] * s["vy"]) if s["vy"] else None
    n = s["n"]
    error = math.sqrt(max(0.0, (s["vy"] - slope * s["cxy"]) * n / (n - 2))) if n > 2 else 0.0
    rows = []
    for k in range(points):
        at = s["lo"] + (s["hi"] - s["lo"]) * k / (points - 1)
        half = 1.959963984540054 * error * math.sqrt(1 / n + (at - s["mx"]) ** 2 / (n * s["vx"]))
        fit = intercept + slope * at
        rows.append((k, at, fit, fit - half, fit + half, slope, intercept, r))
    return df.sparkSession.createDataFrame(rows, schema)


def residual_data(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.select(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"),
                     (F.col(actual) - F.col(predicted)).alias("residual"))


def confusion_data(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """All four cells of the 2 x 2 table, from one conditional-count pass."""
    cells = [(t, p) for t in (0, 1) for p in (0, 1)]
    wide = df.agg(*[F.count_if((F.col(actual) == t) & (F.col(predicted) == p)).alias(f"c{t}{p}") for t, p in cells])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{t}{p}").alias("n")) for t, p in cells
    ])))
