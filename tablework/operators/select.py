"""Projection, slicing, predicates and row expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.semantics import numeric_names, require_columns
from tablework.operators.order import StoredOrder, local_rows, ordered_index

# Bytes per value of the fixed-width types.
TYPE_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8, "date": 4,
              "timestamp": 8, "timestamp_ntz": 8}

_LITERAL_MAP_LIMIT = 500
_VALUE_TYPES = ((str, "string"), (bool, "boolean"), (int, "long"), ((int, float), "double"))


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    require_columns(df, names)
    return df.select(*names)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)


def numeric_columns(df: DataFrame, skip_ids: bool = True) -> DataFrame:
    """Only the numeric columns; decided from the schema, without a job."""
    return df.select(*numeric_names(df, skip_ids))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def slice_rows_cols(df: DataFrame, order_by, rows: tuple[int, int], columns: tuple[int, int] | None = None) -> DataFrame:
    """Half-open positional slice of rows and, optionally, of columns."""
    start, stop = rows
    names = df.columns
    if columns is not None:
        if columns[0] < 0 or columns[0] >= len(names):
            raise IndexError(f"column {columns[0]} is out of range")
        names = names[columns[0]:columns[1]]
    placed = StoredOrder(df, order_by)
    if start < 0 or start >= placed.n:
        raise IndexError(f"row {start} is out of range")
    return placed.between(start, stop).select(*names)


def loc_rows(df: DataFrame, label: str, first, last, columns) -> DataFrame:
    """Rows whose label lies between two labels, both included."""
    return df.filter(F.col(label).between(first, last)).select(*columns)


def slice_step(df: DataFrame, order_by, step: int) -> DataFrame:
    """Every ``step``-th row from position 0; a negative step walks backwards."""
    if step == 0:
        raise ValueError("step must not be 0")
    placed = ordered_index(df, order_by, "_idx")
    if step < 0:
        last = df.count() - 1
        placed = placed.withColumn("_idx", F.lit(last) - F.col("_idx"))
    return placed.filter(F.col("_idx") % abs(step) == 0).drop("_idx")


def mask_greater(df: DataFrame, column: str, threshold) -> DataFrame:
    return df.filter(F.col(column) > threshold)


def filter_all(df: DataFrame, *predicates: Column) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, predicates))


def filter_any(df: DataFrame, *predicates: Column) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, predicates))


def filter_isin(df: DataFrame, column: str, values) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def filter_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def filter_expr(df: DataFrame, expression: str) -> DataFrame:
    return df.filter(expression)


def filter_records(df: DataFrame, conditions: dict) -> DataFrame:
    """Conditions ``{column: scalar | list | {"between": (low, high)}}``, all of which must hold.

    They become one predicate, so the scan receives all of them.
    """
    require_columns(df, conditions)
    parts = []
    for name, want in conditions.items():
        if isinstance(want, dict):
            if set(want) != {"between"}:
                raise ValueError(f"unsupported condition for {name}: {want}")
            parts.append(F.col(name).between(*want["between"]))
        elif isinstance(want, (list, tuple, set)):
            parts.append(F.col(name).isin(list(want)))
        else:
            parts.append(F.col(name) == want)
    return filter_all(df, *parts) if parts else df


def select_rows_by_index(df: DataFrame, order_by, positions) -> DataFrame:
    """Rows at the given positions, in that order; duplicates and negative positions allowed.

    The result carries the request number as ``ord``.
    """
    placed = StoredOrder(df, order_by)
    n, rows = placed.n, []
    for number, p in enumerate(positions):
        if not -n <= p < n:
            raise IndexError(f"position {p} is out of range for {n} rows")
        rows.append((number, p % n))
    wanted = local_rows(df.sparkSession, rows, "ord long, _idx long")
    return placed.at([p for _, p in rows]).join(wanted, "_idx").drop("_idx").orderBy("ord")


def filter_mean_deviation(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Keep values at most ``threshold`` away from the mean (a scalar subquery)."""
    mean = df.agg(F.avg(column)).scalar()
    return df.filter(F.abs(F.col(column) - mean) <= threshold)


def add_scalar(df: DataFrame, columns, amount) -> DataFrame:
    return df.withColumns({c: F.col(c) + F.lit(amount) for c in columns})


def add_row_vector(df: DataFrame, amounts: dict) -> DataFrame:
    """Add one constant per column to every row."""
    return df.withColumns({c: F.col(c) + F.lit(v) for c, v in amounts.items()})


def with_product(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(a) * F.col(b))


def map_values(df: DataFrame, column: str, mapping: dict, out: str) -> DataFrame:
    """Substitute values; those without an entry become NULL. Long mappings are joined.

    The new column has the common type of all entries (text, long, double or boolean), however many there are.
    """
    values = [v for v in mapping.values() if v is not None]
    value_type = next((name for kinds, name in _VALUE_TYPES if all(isinstance(v, kinds) for v in values)), None)
    if value_type is None:
        raise TypeError("the values of a mapping need a common type")
    if len(mapping) <= _LITERAL_MAP_LIMIT:
        if not mapping:
            return df.withColumn(out, F.lit(None).cast(value_type))
        table = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v).cast(value_type))])
        return df.withColumn(out, F.try_element_at(table, F.col(column)))
    if value_type == "double":
        mapping = {k: None if v is None else float(v) for k, v in mapping.items()}
    schema = T.StructType([T.StructField("_key", df.schema[column].dataType)]).add(out, value_type)
    lookup = local_rows(df.sparkSession, list(mapping.items()), schema)
    return df.join(lookup, F.col(column) == F.col("_key"), "left").drop("_key")


def apply_tier(df: DataFrame, column: str, threshold, high: str, low: str, out: str) -> DataFrame:
    return df.withColumn(out, F.when(F.col(column) > threshold, high).otherwise(low))


def cast_columns(df: DataFrame, types: dict) -> DataFrame:
    """Casts by column; what cannot be converted becomes NULL."""
    require_columns(df, types)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def byte_sizes(df: DataFrame) -> DataFrame:
    """Rows, width and total bytes of every fixed-width column."""
    widths = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    widths = [(n, t, TYPE_WIDTH[t]) for n, t in widths if t in TYPE_WIDTH]
    cells = F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("type_name"), F.lit(w).cast("bigint").alias("item_bytes"))
        for n, t, w in widths
    ])
    return (
        df.agg(F.count("*").alias("n")).select("n", F.inline(cells))
        .select("column_name", "type_name", "item_bytes", (F.col("n") * F.col("item_bytes")).alias("total_bytes"))
    )


