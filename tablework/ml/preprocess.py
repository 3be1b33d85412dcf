"""Feature engineering, imputation, scaling, encoding and feature scores.

Fitting learns a small table of parameters in a few aggregation passes; transforming is one
projection of built-in expressions, which also runs on a streaming DataFrame.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.semantics import cut, pearson_expr, require_choice, require_number
from tablework.operators.clean import is_yes
from tablework.operators.clean import modes as common_values
from tablework.operators.order import ordered_index
from tablework.operators.pick import pick_smallest
from tablework.operators.quantiles import column_quantiles

# Contract lengths and tenure stages in their natural order, with the stage edges in months.
CONTRACT_ORDER = ("Month-to-month", "One year", "Two year")
TENURE_BUCKETS = ("0-1yr", "1-2yr", "2-4yr", "4-5yr", "5yr+")
TENURE_EDGES = (-1.0, 12.0, 24.0, 48.0, 60.0, math.inf)


def load_raw_churn(df: DataFrame, id_col: str, amount: str, target: str, blank: str | None = None, share: float = 0.02) -> DataFrame:
    """Raw churn table: blank amounts become NULL, the target 0/1, and ``share`` of ``blank`` is emptied."""
    out = df.withColumn(amount, F.trim(F.col(amount).cast("string")).try_cast("double")).withColumn(target, is_yes(target))
    if blank is not None:
        gone = pick_smallest(df, id_col, 42, lambda _, n: max(1, int(share * n)))
        out = out.withColumn(blank, F.when(~gone, F.col(blank)))
    return out.drop(id_col)


def engineer_features(df: DataFrame, tenure: str, monthly: str, total: str) -> DataFrame:
    """Four row-local features: years, average monthly spend, life stage, charge x tenure."""
    t = F.col(tenure)
    return df.withColumns({
        "tenure_years": t / 12.0,
        "avg_monthly_spend": F.col(total) / F.when(t == 0, 1).otherwise(t),
        "tenure_bucket": cut(tenure, TENURE_EDGES, TENURE_BUCKETS),
        "monthly_charge_x_tenure": F.col(monthly) * t,
    })


def _modes_and_levels(df: DataFrame, columns) -> tuple[dict, dict]:
    """Most frequent value and sorted levels of text columns, from one grouped count. Each level becomes a feature column."""
    if not columns:
        return {}, {}
    entries = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    counts = df.select(F.inline(entries)).filter("v IS NOT NULL").groupBy("c", "v").agg(F.count("*").alias("n"))
    modes, levels = {c: None for c in columns}, {c: [] for c in columns}
    for r in sorted(counts.collect(), key=lambda r: (-r["n"], r["v"])):
        levels[r["c"]].append(r["v"])
        modes[r["c"]] = r["v"] if modes[r["c"]] is None else modes[r["c"]]
    return modes, {c: sorted(v) for c, v in levels.items()}


def impute_median_mode(train: DataFrame, df: DataFrame, numeric, text) -> DataFrame:
    """Fill numbers with train medians and text with the most frequent train value."""
    medians = {c: q[0] for c, q in column_quantiles(train, numeric, [0.5]).items()} if numeric else {}
    modes = common_values(train, list(text)) if text else {}
    return df.withColumns({
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()},
        **{c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items()},
    })


class Preprocessor:
    """Imputation, scaling and encoding learned from a train table."""

    def __init__(self, numeric, nominal=(), ordinal: dict | None = None, scaler: str = "standard"):
        require_choice("scaler", scaler, ("standard", "minmax"))
        self.numeric, self.nominal = list(numeric), list(nominal)
        self.ordinal = {c: list(v) for c, v in (ordinal or {}).items()}
        self.scaler = scaler
        self.params: dict | None = None

    def fit(self, train: DataFrame) -> "Preprocessor":
        medians = {c: q[0] for c, q in column_quantiles(train, self.numeric, [0.5]).items()} if self.numeric else {}
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in self.numeric}
        center, scale = {}, {}
        if self.numeric:
            lo, hi = (F.avg, F.stddev_pop) if self.scaler == "standard" else (F.min, F.max)
            row = train.agg(*[F.struct(lo(e).alias("a"), hi(e).alias("b")).alias(c) for c, e in filled.items()]).first()
            for c in self.numeric:
                center[c] = row[c]["a"]
                width = row[c]["b"] if self.scaler == "standard" else row[c]["b"] - row[c]["a"]
                # a constant column becomes 0
                scale[c] = width or 1.0
        modes, levels = _modes_and_levels(train, [*self.nominal, *self.ordinal])
        self.params = {"median": medians, "center": center, "scale": scale, "mode": modes,
                       "levels": {c: levels[c] for c in self.nominal}}
        return self

    def _fitted(self) -> dict:
        if self.params is None:
            raise ValueError("fit the preprocessor first")
        return self.params

    def _expressions(self) -> list[tuple[str, Column]]:
        p, out = self._fitted(), []
        for c in self.numeric:
            value = F.coalesce(F.col(c).cast("double"), F.lit(p["median"][c]))
            out.append((c, (value - F.lit(p["center"][c])) / F.lit(p["scale"][c])))
        for c in self.nominal:
            value = F.coalesce(F.col(c).cast("string"), F.lit(p["mode"][c]))
            out += [(f"{c}_{v}", (value == F.lit(v)).cast("double")) for v in p["levels"][c]]
        for c, order in self.ordinal.items():
            value = F.coalesce(F.col(c).cast("string"), F.lit(p["mode"][c]))
            code = F.lit(-1.0)
            for k, v in reversed(list(enumerate(order))):
                code = F.when(value == F.lit(v), F.lit(float(k))).otherwise(code)
            out.append((c, code))
        return out

    def feature_names(self) -> list[str]:
        return [n for n, _ in self._expressions()]

    def transform(self, df: DataFrame, keep=()) -> DataFrame:
        """``keep`` columns followed by the feature columns: one narrow projection."""
        return df.select(*keep, *[e.alias(n) for n, e in self._expressions()])

    def numeric_params(self, spark: SparkSession) -> DataFrame:
        """Median, centre and scale of every numeric feature."""
        p = self._fitted()
        rows = [(c, float(p["median"][c]), float(p["center"][c]), float(p["scale"][c])) for c in self.numeric]
        return spark.createDataFrame(rows, "feature string, median double, center double, scale double")

    def save(self, spark: SparkSession, path: str) -> None:
        state = json.dumps({"numeric": self.numeric, "nominal": self.nominal, "ordinal": self.ordinal,
                            "scaler": self.scaler, "params": self._fitted()})
        spark.createDataFrame([(state,)], "state string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Preprocessor":
        state = json.loads(spark.read.parquet(path).first()["state"])
        out = cls(state["numeric"], state["nominal"], state["ordinal"], state["scaler"])
        out.params = state["params"]
        return out


def scale_columns(train: DataFrame, df: DataFrame, columns, scaler: str) -> DataFrame:
    """Scale columns in place with train statistics."""
    fitted = Preprocessor(columns, scaler=scaler).fit(train)
    rest = [c for c in df.columns if c not in columns]
    return fitted.transform(df, rest)


def encode_onehot(train: DataFrame, df: DataFrame, columns) -> DataFrame:
    """0/1 column per train level; a value unseen in train gives all zeros."""
    _, levels = _modes_and_levels(train, list(columns))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, *[
        F.col(c).cast("string").eqNullSafe(F.lit(v)).cast("int").alias(f"{c}_{v}") for c in columns for v in levels[c]
    ])


def encode_ordinal(df: DataFrame, column: str, order, out: str) -> DataFrame:
    """Position in the given order, -1 for anything else."""
    code = F.lit(-1)
    for k, v in reversed(list(enumerate(order))):
        code = F.when(F.col(column) == F.lit(v), F.lit(k)).otherwise(code)
    return df.withColumn(out, code)


def anova_f(df: DataFrame, features, target: str) -> DataFrame:
    """One-way F score of each feature over the classes, from per-class moments."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in features])
    rows = df.select(F.col(target).alias("_t"), F.inline(entries)).filter("_t IS NOT NULL AND v IS NOT NULL")
    per = rows.groupBy("feature", "_t").agg(F.count("*").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    whole = per.groupBy("feature").agg(
        F.sum("n").alias("rows"), F.count("*").alias("k"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    return per.join(whole, "feature").groupBy("feature").agg(
        F.try_divide(
            F.sum(F.col("n") * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean"))) / (F.any_value("k") - 1),
            F.sum(F.col("n") * F.col("s")) / (F.any_value("rows") - F.any_value("k")),
        ).alias("score"))


def f_regression(df: DataFrame, features, target: str) -> DataFrame:
    """F score of the correlation of each feature with a numeric target."""
    wide = df.agg(*[
        F.struct(pearson_expr(c, target).alias("r"), F.count_if(F.col(c).isNotNull() & F.col(target).isNotNull()).alias("n")).alias(c)
        for c in features
    ])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`.r").alias("r"), F.col(f"`{c}`.n").alias("n")) for c in features
    ])))
    r2 = F.col("r") * F.col("r")
    return long.select("feature", F.try_divide(r2 * (F.col("n") - 2), 1 - r2).alias("score"))


def select_top_features(df: DataFrame, features, target: str, k: int, task: str) -> DataFrame:
    """The ``k`` features of highest F score, best first."""
    require_number("k", k, whole=True)
    scores = anova_f(df, features, target) if task == "classification" else f_regression(df, features, target)
    return scores.orderBy(F.desc_nulls_last("score"), "feature").limit(k)


def encode_sparse(train: DataFrame, df: DataFrame, columns, out: str = "features") -> tuple[DataFrame, DataFrame]:
    """One-hot for any number of levels: ``df`` without ``columns`` but with ``out``, the sorted numbers of its levels, and the
    dictionary ``(feature_no, column_name, level)`` of the train table, numbered by column, then level.

    The dictionary stays a table joined by level; a value unseen in train has no number.
    """
    columns = list(columns)
    entries = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("string").alias("level")) for i, c in enumerate(columns)])
    levels = ordered_index(train.select(F.inline(entries)).filter("level IS NOT NULL").distinct(), ["_c", "level"], "feature_no")
    rows = df
    for i, c in enumerate(columns):
        own = levels.filter(F.col("_c") == i).select(F.col("level").alias(f"_l{i}"), F.col("feature_no").alias(f"_f{i}"))
        rows = rows.join(own, F.col(c).cast("string") == F.col(f"_l{i}"), "left").drop(f"_l{i}")
    numbers = F.array_sort(F.array_compact(F.array(*[f"_f{i}" for i in range(len(columns))])))
    kept = [c for c in df.columns if c not in columns]
    names = F.element_at(F.array(*map(F.lit, columns)), F.col("_c") + 1)
    return rows.select(*kept, numbers.alias(out)), levels.select("feature_no", names.alias("column_name"), "level")
