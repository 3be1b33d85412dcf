"""Descriptive statistics, probability, correlation, outliers and normality."""

from __future__ import annotations

import math
from itertools import combinations
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.semantics import flag, nan_to_null, numeric_names, pearson_expr, require_choice
from tablework.operators.clean import numeric_modes
from tablework.operators.order import average_ranks, local_rows, local_table, prefix_sum
from tablework.operators.quantiles import column_quantiles, exact_quantiles, profile

_PAIR_BATCH = 300
_NORMAL_TAIL = 1_000_000
SPREADS = ("var_pop", "var_samp", "stddev_pop", "stddev_samp")
PROFILE_MOMENTS = {"mean": F.avg, "std": F.stddev_samp}


def require_rows(info: dict, column: str, least: int = 1) -> dict:
    got = info.get(((), column))
    if got is None or got["n"] < least:
        raise ValueError(f"{column} needs at least {least} value(s)")
    return got


def percentile_linear(df: DataFrame, column: str, percents) -> DataFrame:
    """Percentiles by linear interpolation on (n-1)q, as rows ``(pct, value)``."""
    percents = list(percents)
    if any(not 0 <= p <= 100 for p in percents):
        raise ValueError("percentiles lie between 0 and 100")
    got = require_rows(exact_quantiles(df, [column], [p / 100 for p in percents]), column)
    return df.sparkSession.createDataFrame([(float(p), v) for p, v in zip(percents, got["q"])], "pct double, value double")


def central_tendency(df: DataFrame, columns) -> DataFrame:
    """Mean, median and mode (smallest among equals) per column."""
    columns = list(columns)
    df = nan_to_null(df, columns)
    info, _ = profile(df, columns, [0.5], each={"mean": F.avg})
    found = {c: require_rows(info, c) for c in columns}
    modes = numeric_modes(df, columns)
    rows = [(c, got["q"][0], modes[c], float(got["mean"])) for c, got in found.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, median double, mode double, mean double")


def spread(df: DataFrame, columns) -> DataFrame:
    """Population and sample variance and std, range and interquartile range per column."""
    columns = list(columns)
    df = nan_to_null(df, columns)
    info, _ = profile(df, columns, [0.25, 0.75], each={p: getattr(F, p) for p in SPREADS})
    found = {c: require_rows(info, c, 2) for c in columns}
    rows = [(c, *[float(i[p]) for p in SPREADS], i["max"] - i["min"], i["q"][1] - i["q"][0]) for c, i in found.items()]
    return df.sparkSession.createDataFrame(
        rows, f"column_name string, {', '.join(f'{p} double' for p in SPREADS)}, value_range double, iqr double")


def numeric_profile(df: DataFrame, columns=None) -> DataFrame:
    """Mean, median, sample std, extremes and quartiles of every numeric column."""
    columns = list(columns or numeric_names(df))
    df = nan_to_null(df, columns)
    info, _ = profile(df, columns, [0.25, 0.5, 0.75], each=PROFILE_MOMENTS)
    return profile_rows(df.sparkSession, columns, info)


def profile_rows(spark, columns, info: dict) -> DataFrame:
    """``numeric_profile`` from what ``profile`` found with ``PROFILE_MOMENTS`` and the quartiles first among its probabilities."""
    rows = []
    for c in columns:
        i = info[((), c)]
        mean, std = (None if v is None else float(v) for v in (i["mean"], i["std"]))
        rows.append((c, mean, i["q"][1], std, i["min"], i["max"], i["q"][0], i["q"][2]))
    return local_table(
        spark, rows, "column_name string, mean double, median double, std double, min double, max double, q25 double, q75 double")


def simple_probability(df: DataFrame, event: Column, out: str = "probability") -> DataFrame:
    """Share of rows in which the event holds; a missing indicator counts as not."""
    return df.agg(F.avg(flag(event).cast("int")).alias(out))


def conditional_probability(df: DataFrame, event: Column, given: Column, out: str = "probability") -> DataFrame:
    """P(event | given); raises at run time when the condition never holds."""
    both = F.count_if(flag(event) & flag(given))
    base = F.count_if(flag(given))
    counted = df.agg(both.alias("a"), base.alias("b"))
    checked = F.when(F.col("b") == 0, F.raise_error(F.lit("the condition never holds")).cast("double"))
    return counted.select(checked.otherwise(F.try_divide("a", "b")).alias(out))


def bayes(prior: float, likelihood: float, evidence: float) -> float:
    """Posterior probability; every input must be a probability and the evidence positive."""
    for p in (prior, likelihood, evidence):
        if not 0 <= p <= 1:
            raise ValueError(f"{p} is not a probability")
    if evidence == 0:
        raise ValueError("the evidence has probability 0")
    return likelihood * prior / evidence


def bayes_two_class(prior: float, hit_rate: float, false_alarm: float) -> float:
    """Posterior of the class given a positive sign, by total probability over two classes."""
    return bayes(prior, hit_rate, hit_rate * prior + false_alarm * (1 - prior))


def bayes_posterior(df: DataFrame, doc_id: str, words_col: str, label: str, min_docs: int = 1) -> DataFrame:
    """P(label = 1 | word) for every word, from prior, likelihood and evidence.

    Counts are per (document, distinct word); the table of words is as large as the
    vocabulary and stays distributed.
    """
    totals = df.agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    n, pos = totals["n"], totals["pos"]
    if not n or not pos:
        raise ValueError("both the table and the class must have rows")
    seen = df.select(F.col(label), F.explode(F.array_distinct(words_col)).alias("word"))
    counts = seen.groupBy("word").agg(F.count("*").alias("docs"), F.count_if(F.col(label) == 1).alias("hits"))
    prior, likelihood = F.lit(pos / n), F.col("hits") / F.lit(pos)
    evidence = F.col("docs") / F.lit(n)
    return counts.filter(F.col("docs") >= min_docs).select(
        "word", "docs", prior.alias("prior"), likelihood.alias("likelihood"), evidence.alias("evidence"),
        F.try_divide(likelihood * prior, evidence).alias("posterior"))


def high_value_given_category(df: DataFrame, value: str, category: str) -> DataFrame:
    """P(value above the overall median), P(category) and P(high | category) per category."""
    median = column_quantiles(df, [value], [0.5])[value][0]
    high = flag(F.col(value) > F.lit(median)).cast("int")
    total = df.agg(F.count("*").alias("n"), F.avg(high).alias("p")).first()
    groups = df.filter(F.col(category).isNotNull()).groupBy(category).agg(
        F.avg(high).alias("p_high_given_category"), (F.count("*") / F.lit(total["n"])).alias("p_category"))
    return groups.withColumn("p_high", F.lit(total["p"]))


def zscore_normalize(df: DataFrame, columns) -> DataFrame:
    """(x - mean) / population std per column; a constant column raises."""
    columns = list(columns)
    stats = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    for c in columns:
        if not stats[c]["s"]:
            raise ValueError(f"{c} has no spread")
    return df.withColumns({c: (F.col(c) - F.lit(stats[c]["m"])) / F.lit(stats[c]["s"]) for c in columns})


def zscore_outliers(df: DataFrame, column: str, thresholds=(2.0, 3.0)) -> DataFrame:
    """Rows beyond each threshold of |z|, with z; one pass for the moments, one filtered scan."""
    levels = F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.abs(F.col("z")) > t)
    return zscores(df, column).filter(F.abs("z") > min(thresholds)).withColumn("threshold", F.explode(levels))


def zscores(df: DataFrame, column: str, out: str = "z") -> DataFrame:
    """z of every value, on population moments; a constant column raises."""
    stats = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s")).first()
    if not stats["s"]:
        raise ValueError(f"{column} has no spread")
    return df.withColumn(out, (F.col(column) - F.lit(stats["m"])) / F.lit(stats["s"]))


def zscore_counts(df: DataFrame, columns, threshold: float) -> DataFrame:
    """Values beyond ``threshold`` per column: one pass for the moments, one for the counts."""
    m = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    for c in columns:
        if not m[c]["s"]:
            raise ValueError(f"{c} has no spread")
    beyond = lambda c: F.abs((F.col(c) - F.lit(m[c]["m"])) / F.lit(m[c]["s"])) > threshold
    return df.agg(*[F.count_if(beyond(c)).alias(c) for c in columns]).unpivot([], list(columns), "column_name", "n_outliers")


def fences(quartiles, factor: float = 1.5) -> tuple:
    """Bounds ``factor`` interquartile ranges outside the first and third of (q25, q50, q75, ...); None without values."""
    q1, q3 = quartiles[0], quartiles[2]
    return (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))


def beyond(column: str, low, high) -> Column:
    """Number of rows below or above the bounds."""
    return F.count_if((F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)))


def iqr_bounds(df: DataFrame, columns, factor: float = 1.5) -> dict:
    return {c: fences((q1, None, q3), factor) for c, (q1, q3) in column_quantiles(df, columns, [0.25, 0.75]).items()}


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows outside the quartiles by more than 1.5 interquartile ranges."""
    if column not in numeric_names(df):
        raise ValueError(f"{column} is not a numeric column")
    low, high = iqr_bounds(df, [column])[column]
    return df.filter((F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)))


def outlier_counts(df: DataFrame, columns) -> DataFrame:
    """Number of rows outside the IQR fences per column: the two scans of the quartiles, one to count."""
    wide = df.agg(*[beyond(c, *bounds).alias(c) for c, bounds in iqr_bounds(df, columns).items()])
    return wide.unpivot([], list(columns), "column_name", "n_outliers")


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of two columns; fewer than two rows or a constant column raises."""
    r = pearson_expr(x, y)
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    stats = pairs.agg(F.count("*").alias("n"), r.alias("r"))
    problem = F.when(F.col("n") < 2, F.raise_error(F.lit("fewer than two rows")).cast("double")).when(
        F.col("r").isNull(), F.raise_error(F.lit("a column is constant")).cast("double"))
    return stats.select(problem.otherwise(F.col("r")).alias("r"))


def pair_correlations(df: DataFrame, columns) -> DataFrame:
    """Pearson r of every unordered pair; pairs of many columns are aggregated in batches."""
    pairs = list(combinations(columns, 2))
    out = None
    for start in range(0, len(pairs), _PAIR_BATCH):
        part = pairs[start:start + _PAIR_BATCH]
        wide = df.agg(*[pearson_expr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(part)])
        long = wide.select(F.inline(F.array(*[
            F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(part)
        ])))
        out = long if out is None else out.unionByName(long)
    return out


def corr_matrix(df: DataFrame, columns=None) -> DataFrame:
    """Square correlation matrix in long form, with 1 on the diagonal."""
    columns = list(columns or numeric_names(df, skip_ids=True))
    half = pair_correlations(df, columns)
    both = F.array(F.struct(F.col("column_a").alias("a"), F.col("column_b").alias("b")),
                   F.struct(F.col("column_b").alias("a"), F.col("column_a").alias("b")))
    mirrored = half.select(F.explode(both).alias("p"), "r").select(
        F.col("p.a").alias("column_a"), F.col("p.b").alias("column_b"), "r")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "column_a string, column_b string, r double")
    return mirrored.unionByName(diagonal)


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation of two numeric columns over complete rows, with mean ranks for ties."""
    complete = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_ranks(complete, {"rx": x, "ry": y})
    return ranked.agg(pearson_expr("rx", "ry").alias("rho"), F.count("*").alias("n"))


def rank_correlations(df: DataFrame, columns) -> dict[tuple[str, str], tuple]:
    """``{(a, b): (rho, n)}`` for every pair, all ranked in one global order.

    A column without gaps is ranked once; a pair with gaps adds two rankings over its own complete rows.
    """
    columns = list(columns)
    holes = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    values, sides = {}, {}
    for a, b in combinations(columns, 2):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        for own in (a, b):
            whole = not (holes[a] or holes[b])
            name = f"_r{columns.index(own)}" if whole else f"_r{columns.index(own)}_{columns.index(a)}_{columns.index(b)}"
            values[name] = F.col(own) if whole else F.when(both, F.col(own))
            sides.setdefault((a, b), []).append(name)
    out: dict = {}
    ranked, pairs = average_ranks(df, values) if values else None, list(sides.items())
    for start in range(0, len(pairs), _PAIR_BATCH):
        part = pairs[start:start + _PAIR_BATCH]
        row = ranked.agg(*[F.struct(pearson_expr(x, y).alias("r"), F.count(x).alias("n")).alias(f"p{i}") for i, (_, (x, y)) in enumerate(part)]).first()
        out.update({pair: (row[f"p{i}"]["r"], row[f"p{i}"]["n"]) for i, (pair, _) in enumerate(part)})
    return out


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def correlation_pvalue(r: float, n: int) -> float | None:
    """Two-sided p-value of a rank correlation by the t distribution with n-2 degrees of freedom."""
    if r is None or n < 3:
        return None
    if abs(r) >= 1:
        return 0.0
    df = n - 2
    t2 = r * r * df / (1 - r * r)
    if df > _NORMAL_TAIL:  # the beta function loses its digits there; the corrected normal tail is exact to 1e-11
        z = math.sqrt(t2) * (1 - 1 / (4 * df)) / math.sqrt(1 + t2 / (2 * df))
        return math.erfc(z / math.sqrt(2))
    return incomplete_beta(df / 2, 0.5, df / (df + t2))


def spearman_pvalue(df: DataFrame, x: str, y: str) -> DataFrame:
    row = spearman(df, x, y).first()
    return df.sparkSession.createDataFrame(
        [(row["rho"], row["n"], correlation_pvalue(row["rho"], row["n"]))], "rho double, n long, p_value double")


def corr_report(df: DataFrame, columns=None) -> DataFrame:
    """Pearson, Spearman and p-value of every pair of numeric columns, strongest first."""
    columns = list(columns or numeric_names(df, skip_ids=True))
    pearsons = {(r["column_a"], r["column_b"]): r["r"] for r in pair_correlations(df, columns).collect()}
    rows = [
        (a, b, pearsons[(a, b)], rho, correlation_pvalue(rho, n)) for (a, b), (rho, n) in rank_correlations(df, columns).items()
    ]
    out = df.sparkSession.createDataFrame(
        rows, "column_a string, column_b string, pearson double, spearman double, p_value double")
    return out.orderBy(F.desc(F.abs("pearson")), "column_a", "column_b")


def corr_extremes(pairs: DataFrame, r: str, n: int) -> DataFrame:
    """The ``n`` strongest and ``n`` weakest pairs by absolute correlation."""
    size = F.abs(F.col(r))
    top = pairs.orderBy(size.desc(), "column_a", "column_b").limit(n).withColumn("kind", F.lit("strongest"))
    low = pairs.orderBy(size.asc(), "column_a", "column_b").limit(n).withColumn("kind", F.lit("weakest"))
    return top.unionByName(low)


def normal_fit(df: DataFrame, columns) -> DataFrame:
    wide = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`.mean").alias("mean"), F.col(f"`{c}`.std").alias("std"))
        for c in columns
    ])))


# Royston (1995) polynomial coefficients, constant term first.
_W_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_W_SECOND = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_P_SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
_P_SMALL_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
_P_LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
_P_LARGE_SD = (-0.4803, -0.082676, 0.0030302)
NORMALITY_METHODS = ("shapiro-wilk", "jarque-bera")
_RANK_RUN = 10_000


def _poly(coefficients, x: float) -> float:
    return sum(c * x**k for k, c in enumerate(coefficients))


def _normal_score(i: int, n: int) -> float:
    return NormalDist().inv_cdf((i - 0.375) / (n + 0.25))


def _shapiro_ends(n: int, mm: float) -> tuple[float, float, float]:
    """Outer weights and the divisor of the inner ones (second weight 0 for n <= 5); ``mm`` sums the squared normal scores."""
    top, next_, u = _normal_score(n, n), _normal_score(n - 1, n), 1 / math.sqrt(n)
    if n == 3:
        return math.sqrt(0.5), 0.0, 1.0
    last = _poly(_W_LAST, u) + top / math.sqrt(mm)
    if n <= 5:
        return last, 0.0, math.sqrt((mm - 2 * top**2) / (1 - 2 * last**2))
    second = _poly(_W_SECOND, u) + next_ / math.sqrt(mm)
    return last, second, math.sqrt((mm - 2 * top**2 - 2 * next_**2) / (1 - 2 * last**2 - 2 * second**2))


def _shapiro_p(w: float, n: int) -> float:
    if w >= 1:
        return 1.0
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if n <= 11:
        z_of = -math.log(-2.273 + 0.459 * n - math.log1p(-w))
        mean, sd = _poly(_P_SMALL_MEAN, n), math.exp(_poly(_P_SMALL_SD, n))
    else:
        z_of = math.log1p(-w)
        mean, sd = _poly(_P_LARGE_MEAN, math.log(n)), math.exp(_poly(_P_LARGE_SD, math.log(n)))
    return 1 - NormalDist().cdf((z_of - mean) / sd)


def _shapiro_w(df: DataFrame, column: str, n: int) -> float:
    """W from the normal scores of each value's ranks, in runs of bounded length, so that a value of any
    frequency is spread over tasks."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("c"))
    placed = prefix_sum(counts, ["v"], {"before": "c"})
    runs = placed.select("v", (F.col("before") + F.col("c")).alias("stop"),
                         F.explode(F.sequence("before", F.col("before") + F.col("c") - 1, F.lit(_RANK_RUN))).alias("start"))
    runs = runs.select("v", "start", F.least("stop", F.col("start") + _RANK_RUN).alias("stop")).repartition("start")
    outer = 1 if n <= 5 else 2

    @F.pandas_udf("inner double, squares double")
    def scores(start: pd.Series, stop: pd.Series) -> pd.DataFrame:
        out = []
        for a, b in zip(start.tolist(), stop.tolist()):
            m = [_normal_score(i, n) for i in range(a + 1, b + 1)]
            out.append((sum(m[max(0, outer - a):max(0, n - outer - a)]), sum(x * x for x in m)))
        return pd.DataFrame(out, columns=["inner", "squares"])

    mean = df.agg(F.avg(column)).first()[0]
    v, ranks = F.col("v") - F.lit(mean), F.col("stop") - F.col("start")
    at = lambda rank: F.max(F.when((F.col("start") < rank) & (F.col("stop") >= rank), F.col("v")))
    got = runs.withColumn("s", scores("start", "stop")).agg(
        F.sum(F.col("s.inner") * v).alias("inner"), F.sum("s.squares").alias("mm"), F.sum(ranks * v * v).alias("ss"),
        *[at(r).alias(name) for name, r in (("first", 1), ("second", 2), ("before_last", n - 1), ("last", n))]).first()
    last, second, divisor = _shapiro_ends(n, got["mm"])
    inner = 0.0 if n == 3 else got["inner"] / divisor
    total = inner + last * (got["last"] - got["first"]) + second * (got["before_last"] - got["second"])
    return min(1.0, total**2 / got["ss"])


def normality_test(df: DataFrame, column: str, alpha: float = 0.05, method: str = "shapiro-wilk") -> DataFrame:
    """Shapiro-Wilk, or Jarque-Bera by name, at any number of rows.

    The p-value of Shapiro-Wilk is an approximation fitted up to 5,000 rows and carried on beyond;
    Jarque-Bera takes one pass over the moments.
    """
    require_choice("method", method, NORMALITY_METHODS)
    m = df.agg(F.count(column).alias("n"), F.stddev_pop(column).alias("s"), F.skewness(column).alias("skew"),
               F.kurtosis(column).alias("kurt")).first()
    n = m["n"]
    if n < 3:
        raise ValueError("a normality test needs at least three values")
    if not m["s"]:
        raise ValueError(f"{column} is constant")
    if method == "shapiro-wilk":
        statistic = _shapiro_w(df, column, n)
        p = _shapiro_p(statistic, n)
    else:
        statistic = n / 6 * (m["skew"] ** 2 + m["kurt"] ** 2 / 4)
        p = math.exp(-statistic / 2)
    normal = p > alpha
    verdict = "does not reject" if normal else "rejects"
    text = f"{method} {verdict} normality of {column} at alpha {alpha}"
    return df.sparkSession.createDataFrame(
        [(column, method, n, float(statistic), float(p), alpha, normal, text)],
        "column_name string, method string, n long, statistic double, p_value double, alpha double, is_normal boolean, verdict string")


def cross_check(ours: DataFrame, theirs: DataFrame, keys, value: str, tolerance: float = 1e-6) -> DataFrame:
    """Join two tables of metric rows and say OK or MISMATCH per metric."""
    a = ours.withColumnRenamed(value, "value_a")
    b = theirs.withColumnRenamed(value, "value_b")
    near = flag(F.abs(F.col("value_a") - F.col("value_b")) <= tolerance) | (F.col("value_a").isNull() & F.col("value_b").isNull())
    return a.join(b, keys, "full").withColumn("status", F.when(near, "OK").otherwise("MISMATCH"))
