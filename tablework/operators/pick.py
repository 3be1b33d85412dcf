"""Exact-size random picks without a shuffle.

Every row carries a hash of its id. The k-th smallest hash is found digit by digit: counts per
leading hex digits, then counts inside the one prefix that holds the rank. After that the pick
is a plain filter, a narrow and recomputable projection of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.semantics import all_not_null, hash_key
from tablework.operators.order import local_rows, materialize

_MAX_GROUPS = 2000
_FINISH_ROWS = 20_000
_MAX_CELLS = 400_000
_HASH_DIGITS = 32
_FINISH_GROUP = 2_000


def pick_many(df: DataFrame, id_col: str, picks: dict, by=()) -> dict[str, Column]:
    """One predicate per entry of ``picks = {name: (seed, size_of)}``.

    A predicate is true for exactly ``size_of(group, n)`` rows of each group: those with the
    smallest (hash, id). ``id_col`` must be unique. Groups must be few (class labels), as each is a part of the predicate;
    ``mark_smallest`` has no such limit. All picks share the same passes.
    """
    by = list(by)
    hashes = {name: hash_key(id_col, seed) for name, (seed, _) in picks.items()}
    base = df.filter(all_not_null(by)) if by else df
    if by and base.select(*by).distinct().limit(_MAX_GROUPS + 1).count() > _MAX_GROUPS:
        raise ValueError(f"more than {_MAX_GROUPS} groups; mark_smallest takes any number")
    cells = base.select(id_col, *by, F.inline(F.array(*[
        F.struct(F.lit(name).alias("_name"), h.alias("_h")) for name, h in hashes.items()])))
    limits = _limits(cells, id_col, by, {name: size_of for name, (_, size_of) in picks.items()})
    out = {name: F.lit(False) for name in picks}
    for (g, name), (limit, last_id) in limits.items():
        h = hashes[name]
        inside = (h < F.lit(limit)) | ((h == F.lit(limit)) & (F.col(id_col) <= F.lit(last_id)))
        for column, value in zip(by, g):
            inside = inside & (F.col(column) == F.lit(value))
        out[name] = out[name] | inside
    return {name: F.coalesce(p, F.lit(False)) for name, p in out.items()}


def _limits(cells: DataFrame, id_col: str, by, sizes: dict) -> dict:
    """``{(group, name): (hash, id)}`` of the last picked row."""
    digits = 3 if len(sizes) == 1 and not by else 2
    first = cells.groupBy(*by, "_name", F.substring("_h", 1, digits).alias("_p")).agg(F.count("*").alias("n")).collect()
    counts: dict = {}
    for r in first:
        counts.setdefault((tuple(r[b] for b in by), r["_name"]), []).append((r["_p"], r["n"]))
    targets = {}
    for key, parts in counts.items():
        k = min(sizes[key[1]](key[0], sum(n for _, n in parts)), sum(n for _, n in parts))
        if k > 0:
            targets[key] = _descend(parts, k - 1)
    schema = T.StructType([cells.schema[b] for b in by] + [
        T.StructField("_name", T.StringType()), T.StructField("_k", T.IntegerType()), T.StructField("_prefix", T.StringType())])
    out = {}
    while targets:
        keys = list(targets)
        rows = [(*g, name, i, targets[(g, name)][0]) for i, (g, name) in enumerate(keys)]
        open_prefixes = local_rows(cells.sparkSession, rows, schema)
        inside = cells.join(open_prefixes, [*by, "_name"]).filter(F.startswith("_h", "_prefix"))
        seen = max(len(p) for p, _, _ in targets.values())
        if sum(n for _, _, n in targets.values()) <= _FINISH_ROWS or seen >= _HASH_DIGITS:
            found: dict = {}
            for r in inside.select("_k", "_h", id_col).collect():
                found.setdefault(r["_k"], []).append((r["_h"], r[id_col]))
            for i, key in enumerate(keys):
                out[key] = sorted(found[i])[targets[key][1]]
            return out
        step = 3 if len(targets) * 16**3 <= _MAX_CELLS else 1
        finer = inside.groupBy("_k", F.expr(f"substring(_h, 1, {seen + step})").alias("_p")).agg(F.count("*").alias("n")).collect()
        parts: dict = {}
        for r in finer:
            parts.setdefault(r["_k"], []).append((r["_p"], r["n"]))
        targets = {key: _descend(parts[i], targets[key][1]) for i, key in enumerate(keys)}
    return out


def _descend(parts, rank: int) -> tuple[str, int, int]:
    """(prefix that holds the rank, rank inside it, rows in it)."""
    for prefix, n in sorted(parts):
        if rank < n:
            return prefix, rank, n
        rank -= n
    raise AssertionError("rank beyond the rows")


def pick_smallest(df: DataFrame, id_col: str, seed: int, size_of, by=()) -> Column:
    """Predicate for exactly ``size_of(group, n)`` random rows of each group."""
    return pick_many(df, id_col, {"one": (seed, size_of)}, by)["one"]


def sample_rows(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows at random without replacement (all rows when there are fewer)."""
    return df.filter(pick_smallest(df, id_col, seed, lambda _, total: min(n, total)))


def mark_smallest(df: DataFrame, id_col: str, seed: int, sizes: DataFrame, by, out: str) -> DataFrame:
    """All rows with a boolean ``out``: true for the ``_size`` rows of smallest (hash, id) of each group.

    ``sizes`` has the group keys ``by`` and ``_size``; groups that it lacks and rows without a key get false. Any number
    of groups: the prefix that holds a group's last picked hash is kept in a table joined by group, and
    lengthened by two hex digits a round from counts, until few rows share it. ``id_col`` must be unique.
    """
    by = list(by)
    cells = df.filter(all_not_null(by)).select(*by, F.col(id_col).alias("_id"), hash_key(id_col, seed).alias("_h"))
    open_ = materialize(sizes.filter("_size > 0").select(*by, F.lit("").alias("_prefix"), F.col("_size").cast("long").alias("_rank")), "picks")
    along = Window.partitionBy(*by).orderBy("_p")
    seen, left = 0, None
    while left is None or (left > _FINISH_GROUP and seen < _HASH_DIGITS):
        inside = cells.join(open_, by).filter(F.startswith("_h", "_prefix"))
        counts = inside.groupBy(*by, "_rank", F.substring("_h", 1, seen + 2).alias("_p")).agg(F.count("*").alias("_n"))
        # at most 256 rows a group
        counts = counts.withColumn("_before", F.sum("_n").over(along) - F.col("_n"))
        counts = counts.withColumn("_total", F.sum("_n").over(Window.partitionBy(*by))).withColumn("_rank", F.least("_rank", "_total"))
        here = (F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_n"))
        open_ = materialize(counts.filter(here).select(*by, F.col("_p").alias("_prefix"), (F.col("_rank") - F.col("_before")).alias("_rank"), "_n"), "picks")
        left, seen = open_.agg(F.max("_n")).first()[0] or 0, seen + 2
        open_ = open_.drop("_n")
    last = Window.partitionBy(*by).orderBy("_h", "_id")
    rest = cells.join(open_, by).filter(F.startswith("_h", "_prefix")).withColumn("_k", F.row_number().over(last))
    limits = materialize(rest.filter("_k = _rank").select(*by, F.col("_h").alias("_limit"), F.col("_id").alias("_last")), "pick-limits")
    h = hash_key(id_col, seed)
    inside = (h < F.col("_limit")) | ((h == F.col("_limit")) & (F.col(id_col) <= F.col("_last")))
    return df.join(limits, by, "left").select(*df.columns, F.coalesce(inside, F.lit(False)).alias(out))
