"""Exact linear-interpolation quantiles in two scans of the source.

The first scan builds, in the same aggregation as counts, extremes and any moments the caller wants, a mergeable rank
sketch (KLL) of each column. It brackets every wanted rank between two values. The second scan counts exactly how many values lie
below each bracket and how often each value inside occurs, combined map-side; a bracket holds a few thousandths of the rows. Few
cells go to the driver, many are written once and narrowed there by histograms. A bracket that turns out not to hold its rank is
seen in the counts, and that rank is narrowed on the source itself. No rows are sorted, no task keeps a value map
beyond a bracket, so a group holding a third of the table costs the same as any other.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.semantics import all_not_null
from tablework.operators.order import local_rows, materialize, prefix_sum

_LARGEST = 1.7976931348623157e308
_BUCKETS = 1024
_MAX_COLLECTED = 200_000
_FINISH_ROWS = 50_000
#: Sketch size, half width of a bracket in ranks, and the count up to which the bracket is the whole range: for a table, and for each of many groups.
_WHOLE, _GROUPED = (4096, 0.003, 5_000), (512, 0.02, 500)


class TooManyGroups(ValueError):
    pass


def _long(df: DataFrame, columns, by) -> DataFrame:
    if len(columns) == 1:
        pairs = df.select(*by, F.lit(0).alias("_c"), F.col(columns[0]).cast("double").alias("_v"))
    else:
        entries = F.array(*[
            F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)
        ])
        pairs = df.select(*by, F.inline(entries))
    return pairs.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    at = (n - 1) * q
    lo = math.floor(at)
    return lo, min(math.ceil(at), n - 1), at - lo


def exact_quantiles(df: DataFrame, columns, probs, by=(), max_groups: int = 2000) -> dict:
    """``{(group tuple, column): {"n", "min", "max", "q": [..]}}`` for every group.

    Rows with a missing group key or value are ignored. Raises ``TooManyGroups`` beyond
    ``max_groups``; ``group_quantiles`` then takes the ordered route.
    """
    return profile(df, columns, probs, by, max_groups)[0]


def profile(df: DataFrame, columns, probs, by=(), max_groups: int = 2000, each=None, also=None) -> tuple[dict, dict]:
    """``exact_quantiles`` and, from its first scan, further aggregates.

    ``probs`` is one list or ``{column: list}``. ``each`` is ``{name: function of a column}``, found under that name beside
    ``n``; ``also`` is ``{name: aggregate}`` of the whole table (without ``by``), returned as the second value. A column
    without values has no entry but with ``each``, where its ``n`` is 0 and its quantiles are None.
    """
    by, columns, each, also = list(by), list(columns), dict(each or {}), dict(also or {})
    probs = {c: list(probs[c] if isinstance(probs, dict) else probs) for c in columns}
    if any(not 0 <= p <= 1 for own in probs.values() for p in own):
        raise ValueError("probabilities must lie in [0, 1]")
    if not columns and not also:
        return {}, {}
    if by and also:
        raise ValueError("aggregates of the whole table go without groups")
    base = df.filter(all_not_null(by)) if by else df
    size, half, few = _GROUPED if by else _WHOLE
    inner = {c: [p for p in dict.fromkeys(own) if 0 < p < 1] for c, own in probs.items()}

    aggregates = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        parts = [F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")]
        parts += [F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch")] if inner[c] else []
        aggregates.append(F.struct(*parts, *[f(c).alias(name) for name, f in each.items()]).alias(f"_s{i}"))
    rows = base.groupBy(*by).agg(*aggregates, *[a.alias(f"_a{i}") for i, a in enumerate(also.values())])
    read = []
    for i, c in enumerate(columns):
        own, points = F.col(f"_s{i}"), F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in inner[c] for d in (-half, half)])
        marks = F.when(own["n"] > few, F.kll_sketch_get_quantile_double(own["sketch"], points)) if inner[c] else F.lit(None)
        read.append(F.struct(own["n"].alias("n"), own["lo"].alias("lo"), own["hi"].alias("hi"), marks.alias("marks"), *[own[e].alias(e) for e in each]).alias(f"_s{i}"))
    rows = rows.select(*by, *read, *[f"_a{i}" for i in range(len(also))])
    got = (rows.limit(max_groups + 1) if by else rows).collect()
    if len(got) > max_groups:
        raise TooManyGroups(f"more than {max_groups} groups")

    out, brackets, found = {}, [], {}
    for row in got:
        for i, c in enumerate(columns):
            own, key = row[f"_s{i}"], (tuple(row[b] for b in by), c)
            if own["n"] or each:
                out[key] = {"n": own["n"], "min": own["lo"], "max": own["hi"], **{e: own[e] for e in each}}
            if not own["n"]:
                continue
            for p in dict.fromkeys(probs[c]):
                open_ = {r for r in _ranks(own["n"], p)[:2] if not _end_rank(found, key, own, r)}
                if open_ and own["marks"] is not None:
                    at = 2 * inner[c].index(p)
                    brackets.append((key, own["marks"][at], own["marks"][at + 1], open_))
                elif open_:
                    brackets.append((key, own["lo"], own["hi"], open_))
    _count_brackets(base, columns, by, _joined(brackets), out, found)
    for key, summary in out.items():
        own = probs[key[1]]
        summary["q"] = [None] * len(own)
        for at, p in enumerate(own if summary["n"] else ()):
            a, b, part = _ranks(summary["n"], p)
            va, vb = found[(key, a)], found[(key, b)]
            summary["q"][at] = va + (vb - va) * part
    return out, {name: got[0][f"_a{i}"] for i, name in enumerate(also)}


def _joined(brackets: list[tuple]) -> list[tuple]:
    """Brackets of one key that overlap become one."""
    out: list[tuple] = []
    for key, lo, hi, wanted in sorted(brackets, key=lambda b: (repr(b[0]), b[1], b[2])):
        if out and out[-1][0] == key and lo <= out[-1][2]:
            out[-1] = (key, out[-1][1], max(hi, out[-1][2]), out[-1][3] | wanted)
        else:
            out.append((key, lo, hi, set(wanted)))
    return out


def _bounds(df: DataFrame, columns, by, rows) -> DataFrame:
    """Intervals as a table: group keys, column number, interval number and both ends."""
    schema = T.StructType(
        [T.StructField(b, df.schema[b].dataType) for b in by]
        + [T.StructField("_c", T.IntegerType()), T.StructField("_k", T.IntegerType()),
           T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType())])
    return local_rows(df.sparkSession, [(*key[0], columns.index(key[1]), k, lo, hi) for k, (key, lo, hi) in enumerate(rows)], schema)


def _count_brackets(base: DataFrame, columns, by, brackets, info: dict, found: dict) -> None:
    """The second scan: values below each bracket and every value inside, counted."""
    if not brackets:
        return
    values = _long(base, columns, by)
    near = values.join(_bounds(base, columns, by, [b[:3] for b in brackets]), [*by, "_c"]).filter(F.col("_v") <= F.col("_hi"))
    cells = near.groupBy("_k", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v")).agg(F.count("*").alias("_n"))
    _, half, few = _GROUPED if by else _WHOLE
    likely = sum(min(info[key]["n"], max(few, info[key]["n"] * 3 * half)) for key, *_ in brackets)
    if likely <= _FINISH_ROWS:
        table, rows = None, cells.collect()
    else:
        table = materialize(cells, "cells")
        rows = table.groupBy("_k", F.col("_v").isNull().alias("_b")).agg(F.sum("_n").alias("_n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()
    below, inside = [0] * len(brackets), [[] for _ in brackets]
    for r in rows:
        if r["_v"] is None if table is None else r["_b"]:
            below[r["_k"]] = r["_n"]
        else:
            inside[r["_k"]].append((r["_v"], r["_v"], r["_n"]) if table is None else (r["lo"], r["hi"], r["_n"]))
    left, missed = [], []
    for k, (key, _, _, wanted) in enumerate(brackets):
        total = below[k] + sum(n for *_, n in inside[k])
        here = {r for r in wanted if below[k] <= r < total}
        left += _settled(found, key, below[k], inside[k], here, k)
        if wanted - here:
            missed.append((key, wanted - here))
    if left:
        _narrow(table.filter("_v IS NOT NULL").withColumnRenamed("_k", "_s"), ["_s"], left, found)
    if missed:  # a bracket without its rank: the whole range, on the source
        whole = [((*key[0], columns.index(key[1])), key, info[key]["min"], info[key]["max"], 0, info[key]["n"], ranks) for key, ranks in missed]
        _narrow(values.withColumn("_n", F.lit(1).cast("long")), [*by, "_c"], whole, found)


def _settled(found: dict, key, before: int, cells, wanted: set, k: int) -> list[tuple]:
    """Put ranks that a cell's ends decide into ``found``; return the cells that are still open."""
    left = []
    for lo, hi, n in sorted(cells):
        here = {r for r in wanted if before <= r < before + n}
        ends = {r: lo if lo == hi or r == before else hi for r in here if lo == hi or r in (before, before + n - 1)}
        found.update({(key, r): v for r, v in ends.items()})
        if here - set(ends):
            left.append(((k,), key, lo, hi, before, n, here - set(ends)))
        before += n
    return left


def _narrow(values: DataFrame, names, intervals, found: dict) -> None:
    """Histograms of ever smaller intervals, until every wanted rank is a value.

    ``values`` has the key columns ``names``, ``_v`` and its weight ``_n``; an interval is (key, label, low, high,
    number of smaller values, number of its values, wanted ranks).
    """
    spark = values.sparkSession
    schema = T.StructType([values.schema[n] for n in names] + [
        T.StructField("_k", T.IntegerType()), T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType())])
    while intervals:
        bounds = local_rows(spark, [(*iv[0], k, iv[2], iv[3]) for k, iv in enumerate(intervals)], schema)
        inside = values.join(bounds, names).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        buckets = max(16, min(_BUCKETS, _MAX_COLLECTED // len(intervals)))
        if sum(iv[5] for iv in intervals) <= _FINISH_ROWS:
            cells = inside.groupBy("_k", F.col("_v").alias("lo")).agg(F.sum("_n").alias("n"))
            cells = cells.withColumn("hi", F.col("lo"))
        else:
            # infinities count as the largest finite numbers, and halves come first, so that nothing overflows
            low, high, at = (F.greatest(F.least(F.col(c), F.lit(_LARGEST)), F.lit(-_LARGEST)) for c in ("_lo", "_hi", "_v"))
            share = F.when(high > low, (at * 0.5 - low * 0.5) / (high * 0.5 - low * 0.5)).otherwise((F.col("_v") == F.col("_hi")).cast("double"))
            bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1))
            cells = inside.groupBy("_k", bucket.alias("_b")).agg(
                F.sum("_n").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
            )
        by_interval: dict = {}
        for cell in cells.select("_k", "lo", "hi", "n").collect():
            by_interval.setdefault(cell["_k"], []).append((cell["lo"], cell["hi"], cell["n"]))
        narrowed = []
        for k, (at, key, _, _, before, _, wanted) in enumerate(intervals):
            narrowed += [(at, *iv[1:]) for iv in _settled(found, key, before, by_interval[k], wanted, 0)]
        intervals = narrowed


def _end_rank(found: dict, key, row, rank: int) -> bool:
    if row["lo"] == row["hi"] or rank == 0:
        found[(key, rank)] = row["lo"]
    elif rank == row["n"] - 1:
        found[(key, rank)] = row["hi"]
    return (key, rank) in found


def column_quantiles(df: DataFrame, columns, probs) -> dict[str, list]:
    """``{column: [quantile, ...]}``; a column without values gives NULLs."""
    got = exact_quantiles(df, columns, probs)
    return {c: got[((), c)]["q"] if ((), c) in got else [None] * len(probs) for c in columns}


def group_quantiles(df: DataFrame, by, column: str, probs, names, max_groups: int = 2000) -> DataFrame:
    """One row per group: keys plus one column per probability."""
    by, probs, names = list(by), list(probs), list(names)
    try:
        got = exact_quantiles(df, [column], probs, by, max_groups)
    except TooManyGroups:
        return _ordered_group_quantiles(df, by, column, probs, names)
    schema = T.StructType(
        [T.StructField(b, df.schema[b].dataType) for b in by] + [T.StructField(n, T.DoubleType()) for n in names]
    )
    return local_rows(df.sparkSession, [(*k[0], *v["q"]) for k, v in got.items()], schema)


def group_medians(df: DataFrame, by, columns, max_groups: int = 2000) -> DataFrame:
    """One row per group: keys plus ``column_median`` of each column, all found in the same passes."""
    by, columns = list(by), list(dict.fromkeys(columns))
    try:
        got = exact_quantiles(df, columns, [0.5], by, max_groups)
    except TooManyGroups:
        parts = [_ordered_group_quantiles(df, by, c, [0.5], [f"{c}_median"]) for c in columns]
        return reduce(lambda a, b: a.join(b, by, "full"), parts)
    schema = T.StructType([T.StructField(b, df.schema[b].dataType) for b in by] + [T.StructField(f"{c}_median", T.DoubleType()) for c in columns])
    groups = dict.fromkeys(key for key, _ in got)
    rows = [(*k, *[got[(k, c)]["q"][0] if (k, c) in got else None for c in columns]) for k in groups]
    return local_rows(df.sparkSession, rows, schema)


def _ordered_group_quantiles(df: DataFrame, by, column, probs, names) -> DataFrame:
    """Any number of groups: count distinct values per group, place them in one global order,
    and pick the rows that cover the wanted ranks."""
    value = F.col(column).cast("double")
    counts = (
        df.filter(all_not_null(by)).select(*by, value.alias("_v"))
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*by, "_v").agg(F.count("*").alias("_n"))
    )
    placed = prefix_sum(counts, [*by, "_v"], {"_before": "_n"})
    groups = placed.groupBy(*by).agg(F.min("_before").alias("_start"), F.sum("_n").alias("_total"))
    rows = placed.join(groups, by).withColumn("_from", F.col("_before") - F.col("_start"))
    picks = []
    for i, p in enumerate(probs):
        at = (F.col("_total") - 1) * F.lit(float(p))
        for side, rank in (("a", F.floor(at)), ("b", F.ceil(at))):
            covered = (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_n"))
            picks.append(F.max(F.when(covered, F.col("_v"))).alias(f"_{side}{i}"))
    wide = rows.groupBy(*by).agg(F.max("_total").alias("_total"), *picks)
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        at = (F.col("_total") - 1) * F.lit(float(p))
        out.append((F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (at - F.floor(at))).alias(name))
    return wide.select(*by, *out)
