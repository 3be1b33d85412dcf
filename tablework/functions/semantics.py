"""Column expressions that pin down missing-value, division and randomness rules.

Everything here stays inside JVM code generation; nothing triggers a job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters, digits and underscore of any script form a word.
WORD_PATTERN = r"([\p{L}\p{N}_]+)"

_HASH_BITS = 52


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def require_columns(df: DataFrame, names) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"unknown column(s) {missing}; available: {df.columns}")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_names(df: DataFrame, skip_ids: bool = False) -> list[str]:
    """Numeric columns by type; with ``skip_ids`` those named ``*_id`` are left out."""
    return [
        f.name
        for f in df.schema.fields
        if is_numeric(f.dataType) and not (skip_ids and f.name.endswith("_id"))
    ]


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """Missing floats (of ``columns``, by default of all) become NULL, so aggregates skip them."""
    floats = {
        f.name: F.when(F.isnan(f.name), None).otherwise(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (columns is None or f.name in columns)
    }
    return df.withColumns(floats) if floats else df


def all_not_null(columns) -> Column:
    return reduce(lambda a, b: a & b, [col(c).isNotNull() for c in columns], F.lit(True))


def sum0(c: str | Column) -> Column:
    """Sum in which an all-missing group gives 0."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def require_number(name: str, value, above: float = 0, below: float | None = None, whole: bool = False) -> None:
    """Refuse anything but a (whole) number between two open bounds."""
    kinds = int if whole else (int, float)
    fits = isinstance(value, kinds) and not isinstance(value, bool) and value > above and (below is None or value < below)
    if not fits:
        upper = "" if below is None else f" and below {below}"
        raise ValueError(f"{name}: {value!r} is no {'whole ' if whole else ''}number above {above}{upper}")


#: Kinds of prediction task.
TASKS = ("classification", "regression")


def require_choice(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name}: {value!r} is none of {', '.join(allowed)}")


def flag(predicate: Column) -> Column:
    """A predicate in which NULL counts as false."""
    return F.coalesce(predicate, F.lit(False))


def pearson_expr(x: str | Column, y: str | Column) -> Column:
    """Correlation over pair-complete rows; NULL when either side is constant."""
    x, y = col(x).cast("double"), col(y).cast("double")
    sx = F.stddev_pop(F.when(y.isNotNull(), x))
    sy = F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)


def words(text: str | Column) -> Column:
    """Array of lower-cased words."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(WORD_PATTERN), F.lit(1))


def hash_key(ids, seed: int) -> Column:
    """A 32-hex-digit key per row; a pure function of the ids and the seed.

    Being independent of partitioning and of task attempts, a pick made from it
    survives the loss of an executor unchanged.
    """
    ids = [ids] if isinstance(ids, (str, Column)) else list(ids)
    return F.md5(F.concat_ws(":", *[col(i).cast("string") for i in ids], F.lit(str(seed))))


def hash_uniform(ids, seed: int) -> Column:
    """Uniform number in [0, 1) with 52 random bits, from ``hash_key``."""
    bits = F.conv(F.substring(hash_key(ids, seed), 1, _HASH_BITS // 4), 16, 10)
    return bits.cast("double") / F.lit(float(1 << _HASH_BITS))


def hash_normal(ids, seed: int) -> Column:
    """Standard normal number from two hash uniforms (Box-Muller)."""
    u1 = F.lit(1.0) - hash_uniform(ids, seed)
    u2 = hash_uniform(ids, seed + 1_000_003)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def clip(x: str | Column, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; a missing value stays missing."""
    x = col(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def cut(x: str | Column, edges, labels) -> Column:
    """Right-closed bins ``(a, b]``; values outside every bin become NULL."""
    edges, labels = list(edges), list(labels)
    if len(labels) != len(edges) - 1:
        raise ValueError("there must be one label per bin")
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("bin edges must increase")
    x = col(x)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for a, b, label in zip(edges, edges[1:], labels):
        out = out.when((x > F.lit(a)) & (x <= F.lit(b)), F.lit(label))
    return out


def text_bar(share: Column, width: int = 40) -> Column:
    return F.repeat(F.lit("#"), (share * width).cast("int"))
