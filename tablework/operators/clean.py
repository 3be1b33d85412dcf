"""Profiling, filling, de-duplicating and type repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.semantics import clip, is_numeric, nan_to_null, numeric_names, require_columns, text_bar
from tablework.operators.order import carry_fill, materialize
from tablework.operators.quantiles import column_quantiles, profile
from tablework.operators.select import TYPE_WIDTH


def profile_shape(df: DataFrame) -> DataFrame:
    """Rows, columns, cells, and bytes held by fixed-width columns: one count."""
    width = sum(TYPE_WIDTH.get(f.dataType.simpleString(), 0) for f in df.schema.fields)
    cols = len(df.columns)
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(cols).cast("bigint").alias("n_cols"), F.lit(2).cast("bigint").alias("ndim"),
        (F.col("n_rows") * cols).alias("n_cells"), F.lit(width).cast("bigint").alias("row_bytes"),
        (F.col("n_rows") * width).alias("fixed_bytes"),
    )


def head_tail(df: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    """First and last rows by key: two distributed top-k picks."""
    first = df.orderBy(order_by).limit(n).withColumn("part", F.lit("head"))
    last = df.orderBy(F.desc(order_by)).limit(n).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


def _cells(columns, build) -> Column:
    return F.inline(F.array(*[build(c) for c in columns]))


def describe(df: DataFrame, columns=None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max per numeric column: two scans."""
    columns = list(columns or numeric_names(df))
    df = nan_to_null(df, columns)
    info, _ = profile(df, columns, [0.25, 0.5, 0.75], each={"mean": F.avg, "std": F.stddev_samp})
    rows = [(c, i["n"], i["mean"], i["std"], i["min"], i["max"], *i["q"]) for c, i in ((c, info[((), c)]) for c in columns)]
    return df.sparkSession.createDataFrame(
        [tuple(float(v) if at > 1 and v is not None else v for at, v in enumerate(r)) for r in rows],
        "column_name string, count long, mean double, std double, min double, max double, q25 double, q50 double, q75 double")


def _null_counts(df: DataFrame) -> DataFrame:
    df = nan_to_null(df)
    return df.agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)],
        *[
            (F.sum(F.octet_length(f.name)) if isinstance(f.dataType, T.StringType) else
             F.count("*") * TYPE_WIDTH.get(f.dataType.simpleString(), 0)).alias(f"b_{i}")
            for i, f in enumerate(df.schema.fields)
        ],
    )


def table_summary(df: DataFrame) -> DataFrame:
    """Type, missing count and data bytes of every column, plus table totals, in one pass."""
    fields = list(enumerate(df.schema.fields))
    return _null_counts(df).select(
        F.col("_n").alias("n_rows"),
        F.lit(len(fields)).cast("bigint").alias("n_cols"),
        sum((F.col(f"n_{i}") for i, _ in fields), F.lit(0)).alias("total_nulls"),
        _cells(fields, lambda f: F.struct(
            F.lit(f[1].name).alias("column_name"), F.lit(f[1].dataType.simpleString()).alias("type_name"),
            F.col(f"n_{f[0]}").alias("null_count"), F.coalesce(f"b_{f[0]}", F.lit(0)).alias("data_bytes"),
        )),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count, share and a 40-character bar per column; an empty table gives shares of 0."""
    fields = list(enumerate(df.columns))
    rows = _null_counts(df).select("_n", _cells(fields, lambda f: F.struct(
        F.lit(f[1]).alias("column_name"), F.col(f"n_{f[0]}").alias("null_count"))))
    share = F.coalesce(F.try_divide(F.col("null_count"), F.col("_n")), F.lit(0.0))
    return rows.select("column_name", "null_count", share.alias("null_share"), text_bar(share).alias("bar"))


def modes(df: DataFrame, columns) -> dict:
    """Most frequent value of each column, the smallest one among equals, None without values: one count for all of them.

    The count is over a tagged union with a slot for each type, so that no value loses digits and ties are
    ordered as their type orders them.
    """
    columns = list(dict.fromkeys(columns))
    kinds = {c: df.schema[c].dataType for c in columns}
    slots = list(dict.fromkeys(k.simpleString() for k in kinds.values()))
    names = {k: f"v{i}" for i, k in enumerate(slots)}
    held = lambda c, k: F.col(c) if kinds[c].simpleString() == k else F.lit(None).cast(k)
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).isNotNull().alias("known"), *[held(c, k).alias(names[k]) for k in slots]) for i, c in enumerate(columns)])))
    values = list(names.values())
    counts = cells.filter("known").groupBy("c", *values).agg(F.count("*").alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), *values)).alias("b")).collect()
    found = {columns[r["c"]]: r["b"] for r in best}
    return {c: found[c][names[kinds[c].simpleString()]] if c in found else None for c in columns}


def most_frequent(df: DataFrame, column: str):
    """Most frequent value, the smallest one among equals; None without values."""
    return modes(df, [column])[column]


def numeric_modes(df: DataFrame, columns) -> dict:
    """Most frequent value of each numeric column, as doubles."""
    return {c: None if v is None else float(v) for c, v in modes(df, columns).items()}


def _fill(df: DataFrame, column: str, value) -> DataFrame:
    df = nan_to_null(df, [column])
    if value is None:
        return df
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType) and isinstance(value, float) and not value.is_integer():
        return df.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(value)))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value).cast(kind)))


def _require_numeric(df: DataFrame, column: str, how: str) -> None:
    if not is_numeric(df.schema[column].dataType):
        raise TypeError(f"{how} needs a numeric column, {column} is {df.schema[column].dataType.simpleString()}")


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    _require_numeric(df, column, "mean")
    return _fill(df, column, nan_to_null(df, [column]).agg(F.avg(column)).first()[0])


def fill_median(df: DataFrame, column: str) -> DataFrame:
    _require_numeric(df, column, "median")
    return _fill(df, column, column_quantiles(df, [column], [0.5])[column][0])


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    return _fill(df, column, most_frequent(nan_to_null(df, [column]), column))


def fill_constant(df: DataFrame, column: str, value) -> DataFrame:
    return nan_to_null(df, [column]).withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def ffill(df: DataFrame, column: str, order_by, by=()) -> DataFrame:
    return carry_fill(nan_to_null(df, [column]), order_by, [column], by)


def bfill(df: DataFrame, column: str, order_by, by=()) -> DataFrame:
    return carry_fill(nan_to_null(df, [column]), order_by, [column], by, backward=True)


_AGGREGATED = ("mean", "median", "mode")
STRATEGIES = (*_AGGREGATED, "drop", "ffill", "bfill")


def handle_missing(df: DataFrame, strategy: dict, order_by=None) -> DataFrame:
    """Apply ``{column: strategy}`` in order; columns that do not exist are skipped.

    Runs of aggregate strategies are learned together (one scan for means and the medians' brackets, one to count these, one for
    all modes); only a row drop in between forces a new look at the data.
    """
    plan = [(c, s) for c, s in strategy.items() if c in df.columns]
    for _, s in strategy.items():
        if s not in STRATEGIES:
            raise ValueError(f"unknown strategy {s!r}; choose one of {STRATEGIES}")
    for c, s in plan:
        if s in ("mean", "median"):
            _require_numeric(df, c, s)
    df = nan_to_null(df, [c for c, _ in plan])
    pending: list = []

    def settle(frame):
        medians = [c for c, s in pending if s == "median"]
        info, values = profile(frame, medians, [0.5], each={}, also={c: F.avg(c) for c, s in pending if s == "mean"})
        values |= {c: info[((), c)]["q"][0] if ((), c) in info else None for c in medians}
        common = [c for c, s in pending if s == "mode"]
        values.update(modes(frame, common) if common else {})
        for c, _ in pending:
            frame = _fill(frame, c, values[c])
        pending.clear()
        return frame

    for c, s in plan:
        if s in _AGGREGATED:
            pending.append((c, s))
            continue
        df = settle(df)
        if s == "drop":
            df = df.dropna(subset=[c])
        else:
            if order_by is None:
                raise ValueError(f"{s} needs order_by")
            df = carry_fill(df, order_by, [c], backward=s == "bfill")
    return settle(df)


def _row_key(df: DataFrame, subset) -> list[Column]:
    """Key columns for equality of rows; text is replaced by its SHA-256 so that long texts
    are neither shuffled nor compared. Missing values equal each other."""
    out = []
    for i, c in enumerate(subset):
        value = F.sha2(F.col(c), 256) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
        out.append(value.alias(f"_key{i}"))
    return out


def duplicate_rows(df: DataFrame, id_col: str, subset=None) -> DataFrame:
    """Ids of rows that repeat an earlier row (by id) on the subset, with the first id.

    Only digests and ids move; the per-key table is combined on the map side.
    """
    subset = list(subset or [c for c in df.columns if c != id_col])
    require_columns(df, subset)
    rows = df.select(F.col(id_col), *_row_key(df, subset))
    keys = rows.columns[1:]
    firsts = rows.groupBy(*keys).agg(F.min(id_col).alias("first_id"), F.count("*").alias("_n")).filter("_n > 1")
    same = None
    for k in keys:
        part = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        same = part if same is None else same & part
    # written first, so that a short list of repeated keys is broadcast by its known size
    pairs = rows.alias("l").join(materialize(firsts, "repeated").alias("r"), same)
    return pairs.filter(F.col(f"l.{id_col}") > F.col("first_id")).select(F.col(f"l.{id_col}"), "first_id")


def duplicate_report(df: DataFrame, id_col: str, subset=None) -> DataFrame:
    """Total rows and number of repeated rows, from per-key counts."""
    subset = list(subset or [c for c in df.columns if c != id_col])
    counts = df.select(*_row_key(df, subset)).groupBy(*[f"_key{i}" for i in range(len(subset))]).agg(F.count("*").alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def remove_duplicates(df: DataFrame, order_col: str | None = None, subset=None) -> DataFrame:
    """Keep the first row (by the unique ``order_col``) of every set of equal rows.

    Only digests and ids are compared; the rows themselves meet the list of repeated ids, which
    is broadcast when small, so that long rows usually do not move at all.
    """
    if subset is None:
        return df.dropDuplicates()
    if order_col is None:
        raise ValueError("a subset needs order_col to know which row is first")
    repeated = materialize(duplicate_rows(df, order_col, subset).select(order_col), "repeats")
    return df.join(repeated, order_col, "left_anti").select(*df.columns)


def fix_types(df: DataFrame, spec: dict) -> DataFrame:
    """``{column: int | float | datetime | other type}``; what does not parse becomes NULL."""
    require_columns(df, spec)
    changes = {}
    for c, kind in spec.items():
        cleaned = F.trim(F.replace(F.col(c).cast("string"), F.lit(","), F.lit("")))
        if kind == "int":
            number = cleaned.try_cast("double")
            # a fraction cannot become a whole number
            changes[c] = F.coalesce(cleaned.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))
        elif kind == "float":
            changes[c] = cleaned.try_cast("double")
        elif kind == "datetime":
            changes[c] = F.col(c).cast("string").try_cast("timestamp_ntz")
        else:
            changes[c] = F.col(c).try_cast(kind)
    return df.withColumns(changes)


def quality_report(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and repeated rows as (metric, value) rows."""
    nulls = _null_counts(df)
    n_cols = len(df.columns)
    first = nulls.select(
        F.col("_n").alias("rows"), F.lit(n_cols).cast("bigint").alias("columns"),
        sum((F.col(f"n_{i}") for i in range(n_cols)), F.lit(0)).alias("missing_cells"),
    ).unpivot([], ["rows", "columns", "missing_cells"], "metric", "value")
    counts = df.select(*_row_key(df, df.columns)).groupBy(*[f"_key{i}" for i in range(n_cols)]).agg(F.count("*").alias("_n"))
    repeated = counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("value"))
    return first.unionByName(repeated.select(F.lit("duplicate_rows").alias("metric"), "value"))


def quality_compare(before: DataFrame, after: DataFrame) -> DataFrame:
    a = quality_report(before).withColumnRenamed("value", "before")
    b = quality_report(after).withColumnRenamed("value", "after")
    return a.join(b, "metric")


def clean_table(df: DataFrame, types: dict, strategy: dict, order_by=None) -> DataFrame:
    """Repair types, then fill, then drop repeated rows."""
    fixed = fix_types(df, types)
    filled = handle_missing(fixed, strategy, order_by)
    return remove_duplicates(filled)


def category_levels(df: DataFrame, columns) -> dict[str, list]:
    """Sorted levels of each categorical column from one pass, for callers that make a column of each."""
    entries = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    out: dict = {c: [] for c in columns}
    for r in df.select(F.inline(entries)).filter("v IS NOT NULL").distinct().collect():
        out[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def one_hot(df: DataFrame, columns, drop_first: bool = False, levels: dict | None = None) -> DataFrame:
    """Replace text columns with 0/1 columns ``column_level``."""
    levels = levels or category_levels(df, columns)
    added = [
        (F.col(c).cast("string").eqNullSafe(F.lit(v))).cast("int").alias(f"{c}_{v}")
        for c in columns
        for v in (levels[c][1:] if drop_first else levels[c])
    ]
    return df.select(*[c for c in df.columns if c not in columns], *added)


def is_yes(column: str) -> Column:
    """1 for yes in any case and padding, else 0."""
    return F.coalesce((F.lower(F.trim(F.col(column).cast("string"))) == "yes").cast("int"), F.lit(0))


def clean_churn(df: DataFrame, id_col: str, amount: str, target: str) -> DataFrame:
    """All-numeric feature table with a 0/1 ``target``: the id goes, a blank amount becomes 0,
    text columns become 0/1 columns without their first level."""
    df = df.drop(id_col).withColumn(amount, F.coalesce(F.trim(F.col(amount).cast("string")).try_cast("double"), F.lit(0.0)))
    df = df.withColumn(target, is_yes(target)).withColumnRenamed(target, "target")
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return one_hot(df, text, drop_first=True) if text else df


def cap_clip(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.withColumn(column, clip(column, low, high))
