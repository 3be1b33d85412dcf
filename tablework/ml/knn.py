"""Exact k-nearest-neighbour join by a tree of pivots and the triangle inequality.

The tree has two levels. Leaves are cells of about ``_CELL_ROWS`` train rows around sampled pivots, as many as the table
asks for up to ``_PIVOT_BYTES`` of pivots; roots are about the square root of their number. A row goes to its nearest root and
there to the nearest leaf, so placing costs two square roots of comparisons.

A query is first answered in its nearest leaf alone, which gives a true bound of its k-th distance. Then it
asks, root by root and leaf by leaf, only those whose pivot lies no further away than that bound plus the radius. Cells are cut
into blocks, and the visitors of a block into slices, of limited size, so one dense cell never becomes one task;
each block hands on at most k candidates per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.operators.order import local_rows, materialize
from tablework.operators.pick import sample_rows

_CELL_ROWS = 500
_PIVOT_BYTES = 64_000_000
_BLOCK = 5_000
_CHUNK = 128


def _to_pivots(pivots: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(pivots)))
    for at in range(0, len(x), _CHUNK):
        out[at:at + _CHUNK] = np.sqrt(((x[at:at + _CHUNK, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))
    return out


class PivotTree:
    """Roots, and the leaves of each root as a range of one array."""

    def __init__(self, sample: np.ndarray):
        self.roots = sample[:math.ceil(math.sqrt(len(sample)))]
        nearest = _to_pivots(self.roots, sample).argmin(axis=1)
        order = np.argsort(nearest, kind="stable")
        self.leaves = sample[order]
        self.starts = np.searchsorted(nearest[order], np.arange(len(self.roots) + 1))
        self.counts = np.zeros(len(sample), np.int64)
        self.radius = np.zeros(len(sample))
        self.root_radius = np.full(len(self.roots), -np.inf)

    def place(self, x: np.ndarray, full: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, distance to it, distance to its root) of every row; with ``full`` only leaves of that many rows, if any is near."""
        far = _to_pivots(self.roots, x)
        root = far.argmin(axis=1)
        leaf, d = np.empty(len(x), np.int64), np.empty(len(x))
        for r in np.unique(root):
            mine, own = np.flatnonzero(root == r), slice(self.starts[r], self.starts[r + 1])
            own_d = _to_pivots(self.leaves[own], x[mine])
            if full and (self.counts[own] >= full).any():
                own_d[:, self.counts[own] < full] = np.inf
            leaf[mine] = own_d.argmin(axis=1) + own.start
            d[mine] = own_d.min(axis=1)
        return leaf, d, far[np.arange(len(x)), root]

    def measure(self, rows) -> None:
        """Take in count and radii: rows of (leaf, n, radius, distance to the root)."""
        root_of = np.searchsorted(self.starts, np.arange(len(self.leaves)), side="right") - 1
        for leaf, n, radius, from_root in rows:
            self.counts[leaf], self.radius[leaf] = n, radius
            self.root_radius[root_of[leaf]] = max(self.root_radius[root_of[leaf]], from_root)

    def reached(self, x: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
        """Leaves with rows that may lie within ``bounds`` of each query."""
        out: list[list[int]] = [[] for _ in x]
        slack = bounds * (1 + 1e-9) + 1e-12
        open_ = _to_pivots(self.roots, x) - self.root_radius <= slack[:, None]
        for r in np.flatnonzero(open_.any(axis=0)):
            mine, own = np.flatnonzero(open_[:, r]), slice(self.starts[r], self.starts[r + 1])
            near = (_to_pivots(self.leaves[own], x[mine]) - self.radius[own] <= slack[mine, None]) & (self.counts[own] > 0)
            for q, leaf in zip(*np.nonzero(near)):
                out[mine[q]].append(int(leaf) + own.start)
        return out


def _best_in(k: int, extra):
    """Function for one block of a cell and its visitors: the k nearest of each visitor."""

    def search(_, qs, ts):
        if not len(qs) or not len(ts):
            return pd.DataFrame({"_q": [], "_n": [], "distance": [], **{c: [] for c in extra}})
        ts = ts.sort_values("_n", kind="stable")
        y, keep = np.stack(ts["_y"].to_numpy()), min(k, len(ts))
        picks, distances = [], []
        for x in qs["_x"]:
            diff = y - x
            d = np.sqrt((diff * diff).sum(axis=1))
            near_enough = np.flatnonzero(d <= np.partition(d, keep - 1)[keep - 1])
            best = near_enough[np.argsort(d[near_enough], kind="stable")[:keep]]
            picks.append(best)
            distances.append(d[best])
        at = np.concatenate(picks)
        return pd.DataFrame({
            "_q": np.repeat(qs["_q"].to_numpy(), keep), "_n": ts["_n"].to_numpy()[at], "distance": np.concatenate(distances),
            **{c: ts[c].to_numpy()[at] for c in extra},
        })

    return search


def _met(visits: DataFrame, placed: DataFrame, counts, k: int, extra, schema: str) -> tuple[DataFrame, int]:
    """Candidates of all (query, cell) visits, and the number of distances they take."""
    load = {r["_cell"]: r["n"] for r in visits.groupBy("_cell").agg(F.count("*").alias("n")).collect()}
    plan = local_rows(
        visits.sparkSession, [(int(c), max(1, math.ceil(int(counts[c]) / _BLOCK)), math.ceil(n / _BLOCK)) for c, n in load.items()],
        "_cell long, _blocks int, _slices int")
    spread = lambda column, count: F.pmod(F.xxhash64(column), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = visits.join(plan, "_cell").withColumn("_s", spread("_q", "_slices")).withColumn("_b", every("_blocks"))
    right = placed.join(plan, "_cell").withColumn("_b", spread("_n", "_blocks")).withColumn("_s", every("_slices"))
    keys = ["_cell", "_b", "_s"]
    found = left.drop("_blocks", "_slices").groupBy(*keys).cogroup(right.drop("_blocks", "_slices").groupBy(*keys)).applyInPandas(_best_in(k, extra), schema)
    return found, sum(int(counts[c]) * n for c, n in load.items())


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_q").orderBy("distance", "_n")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def knn_search(train: DataFrame, test: DataFrame, id_col: str, vector: str, k: int = 5, extra=()) -> tuple[DataFrame, float]:
    """``knn_join`` and the share of all pairs whose distance it computes."""
    if k < 1:
        raise ValueError("k must be positive")
    extra = list(extra)
    base = train.select(F.col(id_col).alias("_n"), F.col(vector).cast("array<double>").alias("_y"), *extra)
    queries = test.select(F.col(id_col).alias("_q"), F.col(vector).cast("array<double>").alias("_x"))
    spark = train.sparkSession
    size = base.agg(F.count("*").alias("n"), F.max(F.size("_y")).alias("dim")).first()
    n = size["n"]
    if n < k:
        raise ValueError(f"{k} neighbours need at least {k} train rows, got {n}")
    cells = max(1, min(n // max(_CELL_ROWS, 4 * k), _PIVOT_BYTES // (8 * max(1, size["dim"]))))
    tree = PivotTree(np.array([r["_y"] for r in sample_rows(base, cells, "_n", seed=7).collect()], dtype="float64"))
    shape = spark.sparkContext.broadcast(tree)

    def place(batches):
        for pdf in batches:
            part = pdf.copy()
            if len(part):
                part["_cell"], part["_d"], part["_r"] = shape.value.place(np.stack(part["_y"].to_numpy()))
            else:
                part["_cell"], part["_d"], part["_r"] = np.empty(0, np.int64), np.empty(0), np.empty(0)
            yield part

    fields = [T.StructField("_cell", T.LongType()), T.StructField("_d", T.DoubleType()), T.StructField("_r", T.DoubleType())]
    placed = materialize(base.mapInPandas(place, T.StructType([*base.schema.fields, *fields])), "cells")
    tree.measure([tuple(r) for r in placed.groupBy("_cell").agg(F.count("*"), F.max("_d"), F.max("_r")).collect()])
    placed = placed.drop("_d", "_r")
    known = spark.sparkContext.broadcast(tree)
    schema = f"_q {queries.schema['_q'].dataType.simpleString()}, _n {base.schema['_n'].dataType.simpleString()}, distance double"
    schema += "".join(f", `{c}` {train.schema[c].dataType.simpleString()}" for c in extra)

    def nearest(batches):
        for pdf in batches:
            part = pdf.copy()
            part["_cell"] = known.value.place(np.stack(part["_x"].to_numpy()), k)[0] if len(part) else np.empty(0, np.int64)
            yield part

    first_cell = T.StructType([*queries.schema.fields, fields[0]])
    first = materialize(queries.mapInPandas(nearest, first_cell), "first-cells")
    found, pairs = _met(first, placed, tree.counts, k, extra, schema)
    found = materialize(_ranked(found, k).drop("rank"), "first-candidates")
    bounds = found.groupBy("_q").agg(F.count("*").alias("_found"), F.max("distance").alias("_bound"))
    asked = first.join(bounds, "_q", "left").withColumn("_bound", F.when(F.col("_found") == k, F.col("_bound")).otherwise(F.lit(float("inf"))))

    def reach(batches):
        for pdf in batches:
            lists = known.value.reached(np.stack(pdf["_x"].to_numpy()), pdf["_bound"].to_numpy()) if len(pdf) else []
            yield pd.DataFrame({"_q": pdf["_q"], "_x": pdf["_x"], "_cells": [[c for c in own if c != had] for own, had in zip(lists, pdf["_cell"])]})

    visits = materialize(asked.select("_q", "_x", "_cell", "_bound").mapInPandas(
        reach, T.StructType([*queries.schema.fields, T.StructField("_cells", T.ArrayType(T.LongType()))])), "visits")
    more, further = _met(visits.select("_q", "_x", F.explode("_cells").alias("_cell")), placed, tree.counts, k, extra, schema)
    best = _ranked(found.unionByName(more), k)
    share = (pairs + further) / max(1, n * first.count())
    return best.select(F.col("_q").alias(id_col), F.col("_n").alias("neighbour"), "distance", "rank", *extra), share


def knn_join(train: DataFrame, test: DataFrame, id_col: str, vector: str, k: int = 5, extra=()) -> DataFrame:
    """The ``k`` nearest train rows of every test row: ``(id, neighbour, distance, rank, *extra)``.

    Equal distances go to the smaller train id. ``extra`` names train columns to carry along. Test ids must be unique.
    """
    return knn_search(train, test, id_col, vector, k, extra)[0]


def knn_predict(train: DataFrame, test: DataFrame, id_col: str, vector: str, target: str, k: int = 5,
                task: str = "classification") -> DataFrame:
    """Vote (smallest class among equals) or mean of the ``k`` nearest train targets."""
    near = knn_join(train, test, id_col, vector, k, [target])
    if task == "regression":
        return near.groupBy(id_col).agg(F.avg(target).alias("prediction"))
    votes = near.groupBy(id_col, target).agg(F.count("*").alias("v"))
    return votes.groupBy(id_col).agg(F.min(F.struct((-F.col("v")).alias("v"), F.col(target).alias("t"))).alias("b")).select(
        id_col, F.col("b.t").alias("prediction"))
