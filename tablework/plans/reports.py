"""Composite reports: exploration, insight sentences, business findings, score sheets.

Every section is an aggregate of the whole table; only aggregates of bounded size (a row per
column, category or pair) are turned into sentences.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.semantics import cut, nan_to_null, numeric_names, pearson_expr
from tablework.operators import charts, stats
from tablework.operators.aggregate import (
    AGGREGATES, TERCILES, TIERS, at_risk, bin_terciles, category_pct, edges_between, group_extremes, pivot_summary, rank_rows, row_mean, top_k, value_counts,
)
from tablework.operators.clean import describe
from tablework.operators.matrix import axis_stats
from tablework.operators.order import local_table
from tablework.operators.quantiles import profile
from tablework.sources.writers import write_json, write_report

MOST_CATEGORIES = 100_000
MOST_CELLS = 100_000


def lines_table(spark: SparkSession, lines) -> DataFrame:
    return spark.createDataFrame([(i + 1, s) for i, s in enumerate(lines)], "line_no long, line string")


def text_columns(df: DataFrame) -> list[str]:
    """Columns that are neither numbers nor dates: the categorical ones, booleans included."""
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, *dates))]


def eda_report(df: DataFrame, pivots=None, tier_column: str | None = None) -> dict[str, DataFrame]:
    """Shape, numeric profile, value counts, correlation, outlier counts, cross-tables and tiers.

    ``pivots`` lists ``(index, columns, values, function)``; without it the first two
    categorical columns and the first numeric one are crossed, if they exist.

    The sections share their scans: row count, moments, sketches and all correlations come from one aggregation, exact quartiles
    and tier edges from one count of their brackets, outliers and tiers from one more, and value counts and cross-tables of
    text columns from one grouped count in long form. Sections that would have more than ``MOST_CELLS`` cells are grouped
    on their own, when they are read.
    """
    spark = df.sparkSession
    numbers, texts = numeric_names(df), text_columns(df)
    df = nan_to_null(df, numbers)
    tier = tier_column or (numbers[0] if numbers else None)
    probs = {c: [0.25, 0.5, 0.75, *(TERCILES if c == tier else ())] for c in dict.fromkeys([*numbers, *([tier] if tier else [])])}
    pairs = list(combinations(numbers, 2))
    also = {"n_rows": F.count("*"), **{pair: pearson_expr(*pair) for pair in pairs}}
    info, shared = profile(df, list(probs), probs, each=stats.PROFILE_MOMENTS, also=also)

    out = {"shape": local_table(spark, [(shared["n_rows"], len(df.columns))], "n_rows long, n_cols long")}
    fences = {c: stats.fences(info[((), c)]["q"]) for c in numbers}
    edges = edges_between(info[((), tier)]["q"][3:]) if tier else []
    counts = [stats.beyond(c, *fences[c]).alias(f"_o{i}") for i, c in enumerate(numbers)]
    labels = TIERS[: max(0, len(edges) - 1)]
    counts += [F.count_if(cut(F.col(tier), edges, labels) == t).alias(f"_t{i}") for i, t in enumerate(labels)]
    third = df.agg(*counts).first() if counts else None
    if numbers:
        out["numeric_profile"] = stats.profile_rows(spark, numbers, info)
        out["outliers"] = local_table(spark, [(c, third[f"_o{i}"]) for i, c in enumerate(numbers)], "column_name string, n_outliers long")
    if pairs:
        cells = [(a, b, shared[(a, b)]) for a, b in pairs]
        cells += [(b, a, r) for a, b, r in cells] + [(c, c, 1.0) for c in numbers]
        out["correlation"] = local_table(spark, cells, "column_a string, column_b string, r double")
    if pivots is None:
        pivots = []
        if len(texts) >= 2 and numbers:
            pivots = [(texts[0], texts[1], numbers[0], "mean"), (texts[1], texts[0], numbers[0], "count")]
    out |= _category_sections(df, texts, pivots)
    if tier:
        tiers = [(t, third[f"_t{i}"]) for i, t in enumerate(labels) if third[f"_t{i}"]]
        out["tiers"] = local_table(spark, tiers, "tier string, n long")
    return out


def _category_sections(df: DataFrame, texts, pivots) -> dict[str, DataFrame]:
    """Value counts of text columns and cross-tables between them, from one grouped count of tagged key pairs."""
    spark, strings = df.sparkSession, {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    fused = [p for p in pivots if {p[0], p[1]} <= strings and (p[2] in doubles or p[3] in ("mean", "count", "std", "var"))]
    name = lambda p: f"pivot_{p[0]}_by_{p[1]}_{p[3]}_{p[2]}"
    entry = lambda tag, a, b, v: F.struct(
        F.lit(tag).alias("tag"), F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"), F.col(v).cast("double").alias("v"))
    entries = [F.struct(F.lit(f"c{i}").alias("tag"), F.col(c).cast("string").alias("a"), F.lit("").alias("b"), F.lit(None).cast("double").alias("v"))
               for i, c in enumerate(texts)]
    entries += [entry(f"p{i}", *p[:3]) for i, p in enumerate(fused)]
    out = {}
    if entries:
        functions = list(dict.fromkeys(p[3] for p in fused))
        long = df.select(F.inline(F.array(*entries))).filter("a IS NOT NULL AND b IS NOT NULL").groupBy("tag", "a", "b").agg(
            F.count("*").alias("n"), F.count("v").alias("known"), *[AGGREGATES[fn]("v").alias(f"_{fn}") for fn in functions])
        got = long.coalesce(1).limit(MOST_CELLS + 1).collect()  # one task, which stops at the limit
        if len(got) > MOST_CELLS:
            fused, got = [], None
        if texts and got is None:
            out["value_counts"] = value_counts(df, texts)
        elif texts:
            counts = sorted(((r["tag"], -r["n"], r["a"]) for r in got if r["tag"][0] == "c"), key=lambda r: (texts[int(r[0][1:])], *r[1:]))
            out["value_counts"] = local_table(spark, [(texts[int(t[1:])], a, -n) for t, n, a in counts], "column_name string, value string, n long")
        for i, p in enumerate(fused):
            own = [r for r in got if r["tag"] == f"p{i}"]
            levels = sorted({r["b"] for r in own if r["known"]})
            cells: dict = {r["a"]: {} for r in own}
            for r in own:
                cells[r["a"]][r["b"]] = r[f"_{p[3]}"]
            kind = "long" if p[3] in ("count", "nunique") else "double"
            rows = [(a, *[row.get(b) for b in levels]) for a, row in sorted(cells.items())]
            schema = T.StructType([T.StructField(p[0], T.StringType())] + [T.StructField(b, T.LongType() if kind == "long" else T.DoubleType()) for b in levels])
            out[name(p)] = local_table(spark, rows, schema)
    for p in pivots:
        if name(p) not in out:
            out[name(p)] = pivot_summary(df, *p)
    return out


def eda_insights(df: DataFrame, value: str, category: str, status: str, done: str, cancelled: str) -> DataFrame:
    """Sentences about skew, best and worst category, outliers, status shares and the main tier."""
    spark, numbers = df.sparkSession, numeric_names(df)
    profile = stats.numeric_profile(df, [value]).first()
    above = profile["mean"] > profile["median"]
    lines = [
        f"Mean {value} {profile['mean']:.2f} lies {'above' if above else 'not above'} the median {profile['median']:.2f}: "
        f"{'right' if above else 'left'}-skewed."
    ]
    ends = group_extremes(df, category, value).first()
    if ends["best_group"] is not None:
        lines.append(f"{category} {ends['best_group']} has the highest mean {value} ({ends['best_mean']:.2f}), "
                     f"{ends['pct_gap']:.2f}% above {ends['worst_group']} ({ends['worst_mean']:.2f}).")
    found = {r["column_name"]: r["n_outliers"] for r in stats.outlier_counts(df, numbers).collect() if r["n_outliers"]}
    if found:
        lines.append(f"{sum(found.values())} values in {len(found)} columns ({', '.join(sorted(found))}) lie outside the IQR fences.")
    else:
        lines.append("No numeric column has values outside the IQR fences.")
    shares = {r["value"]: r["pct"] or 0.0 for r in category_pct(df, status, [done, cancelled]).collect()}
    lines.append(f"{shares[done]:.1f}% of rows have {status} {done} and {shares[cancelled]:.1f}% have {cancelled}.")
    tiers = {r["tier"]: r["n"] for r in bin_terciles(df, value).collect()}
    main = min(tiers, key=lambda t: (-tiers[t], t))
    total = df.count()
    lines.append(f"The {main} tier of {value} is the largest: {tiers[main]} of {total} rows ({100 * tiers[main] / total:.1f}%).")
    return lines_table(spark, lines)


@dataclass
class StatsSummary:
    """Bounded-size statistics of one table: a row per column or pair, and the extreme categories."""

    n_rows: int
    central: dict
    spread: dict
    pairs: list
    normality: dict
    outliers: int
    busiest: tuple
    quietest: tuple
    dearest: tuple
    cheapest: tuple


def stats_summary(df: DataFrame, columns, value: str, quantity: str, category: str) -> StatsSummary:
    """Everything the findings need: moments, correlations and sketches of one scan, their brackets in a second, outliers in a
    third, modes in a fourth, and two scans grouped by category. More than ``MOST_CATEGORIES`` categories raise."""
    columns = list(columns)
    rows = nan_to_null(df, columns)
    pairs = list(combinations(columns, 2))
    moments = {"mean": F.avg, **{p: getattr(F, p) for p in stats.SPREADS}}
    also = {"n_rows": F.count("*"), **{pair: pearson_expr(*pair) for pair in pairs}}
    info, shared = profile(rows, columns, [0.25, 0.5, 0.75], each=moments, also=also)
    found = {c: stats.require_rows(info, c, 2) for c in columns}
    for c, i in found.items():
        if not i["stddev_pop"]:
            raise ValueError(f"{c} has no spread")
    modes = stats.numeric_modes(rows, columns)
    far = rows.agg(*[F.count_if(F.abs(F.try_divide(F.col(c) - F.lit(i["mean"]), F.lit(i["stddev_pop"]))) > 2.0).alias(c) for c, i in found.items()]).first()
    groups, _ = profile(df, [value], [0.5], by=[category], each={"rows": lambda _: F.count("*")}, max_groups=MOST_CATEGORIES)
    sizes = sorted((-g["rows"], key[0][0]) for key, g in groups.items())
    medians = sorted((-g["q"][0], key[0][0]) for key, g in groups.items() if g["n"])
    ends = lambda ordered: [(k, -v) for v, k in (ordered[0], ordered[-1])]
    (busiest, quietest), (dearest, cheapest) = ends(sizes), ends(medians)
    return StatsSummary(
        n_rows=shared["n_rows"],
        central={c: {"mean": float(i["mean"]), "median": i["q"][1], "mode": modes[c]} for c, i in found.items()},
        spread={c: {**{p: i[p] for p in stats.SPREADS}, "value_range": i["max"] - i["min"], "iqr": i["q"][2] - i["q"][0]} for c, i in found.items()},
        pairs=sorted(({"column_a": a, "column_b": b, "r": shared[(a, b)]} for a, b in pairs),
                     key=lambda p: (p["r"] is None, -abs(p["r"] or 0), p["column_a"], p["column_b"])),
        normality={c: stats.normality_test(df, c).first().asDict() for c in (quantity, value)},
        outliers=sum(far), busiest=busiest, quietest=quietest, dearest=dearest, cheapest=cheapest,
    )


def business_insights(s: StatsSummary, value: str, quantity: str, category: str, weak: float = 0.3) -> tuple[list[str], list[str]]:
    """Seven findings and three recommendations; each statement depends on the numbers."""
    v, q = s.central[value], s.central[quantity]
    strong, faint = s.pairs[0], s.pairs[-1]
    rejected = sorted(c for c, t in s.normality.items() if not t["is_normal"])
    related = abs(strong["r"]) >= weak
    top, low, dear, cheap = s.busiest, s.quietest, s.dearest, s.cheapest
    findings = [
        f"{value} averages {v['mean']:.2f} (median {v['median']:.2f}, sample std {s.spread[value]['stddev_samp']:.2f}, "
        f"range {s.spread[value]['value_range']:.2f}).",
        f"{quantity} averages {q['mean']:.1f} (mode {q['mode']:.0f}, interquartile range {s.spread[quantity]['iqr']:.2f}).",
        f"Strongest pair: {strong['column_a']} and {strong['column_b']} (r {strong['r']:+.3f}); weakest: "
        f"{faint['column_a']} and {faint['column_b']} (r {faint['r']:+.3f}). "
        + ("At least one pair is clearly related." if related else "No pair is clearly related."),
        (f"Normality is rejected for {' and '.join(rejected)}." if rejected else "Normality is not rejected for any tested column."),
        f"{s.outliers} values lie more than 2 standard deviations from their mean" + (", worth a review." if s.outliers else "."),
        f"{category} {top[0]} has the most rows ({top[1]}), {low[0]} the fewest ({low[1]}), a factor of {top[1] / low[1]:.1f}.",
        f"{category} {dear[0]} has the highest median {value} ({dear[1]:.2f}), {cheap[0]} the lowest ({cheap[1]:.2f}), "
        f"{dear[1] - cheap[1]:.2f} apart.",
    ]
    advice = [
        (f"Use {strong['column_a']} and {strong['column_b']} together in a model." if related
         else "Collect further features before modelling: the numeric columns hardly explain one another."),
        (f"Use rank-based tests for {' and '.join(rejected)}, or transform them first." if rejected
         else "Tests that assume a normal distribution are acceptable here."),
        f"Find out why {low[0]} has {low[1]} rows against {top[1]} of {top[0]}.",
    ]
    return findings, advice


def insights_lines(findings, advice) -> list[str]:
    return [*(f"Finding {i + 1}: {t}" for i, t in enumerate(findings)), *(f"Recommendation {i + 1}: {t}" for i, t in enumerate(advice))]


def student_report(df: DataFrame, id_col: str, subjects, threshold: float = 60.0, top: int = 5) -> dict[str, DataFrame]:
    """Subject statistics, ranks, best rows, rows at risk, normalised scores and correlation."""
    subjects = list(subjects)
    scored = row_mean(df.select(id_col, *subjects), subjects, "average")
    return {
        "subjects": axis_stats(df, subjects).filter(F.col("axis") != "*"),
        "ranks": rank_rows(scored.select(id_col, "average"), "average", id_col),
        "top": top_k(scored.select(id_col, "average"), "average", top, id_col),
        "at_risk": at_risk(df, subjects, threshold, id_col),
        "normalized": stats.zscore_normalize(df.select(id_col, *subjects), subjects),
        "correlation": stats.corr_matrix(df, subjects),
    }


def student_lines(report: dict[str, DataFrame], id_col: str) -> DataFrame:
    """The printed form: a line per subject and per best row, and the number of rows at risk."""
    lines = [
        f"{r['axis']}: mean {r['mean']:.2f}, median {r['median']:.2f}, std {r['std']:.2f}, min {r['min']:.2f}, max {r['max']:.2f}"
        for r in report["subjects"].orderBy("axis").collect()
    ]
    lines += [f"top {i + 1}: {r[id_col]} with {r['average']:.2f}" for i, r in enumerate(report["top"].collect())]
    lines.append(f"at risk: {report['at_risk'].count()}")
    return lines_table(report["top"].sparkSession, lines)


def full_report(df: DataFrame, path: str, value: str, quantity: str, columns, category: str, date: str, id_col: str) -> DataFrame:
    """Compute the chart suite, statistics and findings, write all below ``path``, and list the parts."""
    spark, columns = df.sparkSession, list(columns)
    pair = (quantity, value)
    suite = {
        **{f"dashboard_{n}": d for n, d in charts.dashboard_data(df, *pair, category, id_col).items()},
        "heatmap": charts.heatmap_data(df, columns),
        "histogram": charts.hist_data(df, value),
        "boxplot": charts.box_data(df, value, category),
        "violin": charts.violin_data(df, value, category),
        "scatter": charts.scatter_data(df, *pair, id_col),
        "regression": charts.regression_line_data(df, *pair),
        "bar": charts.bar_data(df, category),
        "count": charts.count_data(df, category),
        "line": charts.line_data(df, date, value),
        "pairplot": charts.pairplot_hist(df, columns, category),
        "summary": describe(df, columns),
    }
    for name, part in suite.items():
        write_json(part, f"{path}/{name}", mode="overwrite")
    found, advice = business_insights(stats_summary(df, columns, value, quantity, category), value, quantity, category)
    write_report(lines_table(spark, insights_lines(found, advice)), f"{path}/insights", mode="overwrite")
    rows = [(n, spark.read.schema(suite[n].schema).json(f"{path}/{n}").count()) for n in suite]
    rows.append(("insights", spark.read.text(f"{path}/insights").count()))
    return spark.createDataFrame(rows, "part string, n_rows long")
