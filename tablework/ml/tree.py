"""Decision trees grown level by level from split statistics, to any depth.

Feature values become bin numbers once: a feature of at most ``MOST_BINS`` values gets every midpoint between neighbours as a
threshold, so its splits are exact; one of more values gets that many thresholds from a rank sketch. A level is one aggregation:
tasks add up row number, target sums and squares by (node, feature, bin), the sums meet by key, and a window over the few bins of
each node and feature gives the gain of every threshold. One row a node reaches the driver, which holds the tree.

A tree grown to some depth is, cut at any smaller depth, the tree of that depth, so one growth gives the scores at all depths. Gains are
compared as shares of the node's own impurity, to nine digits; ties go to the first feature, then to the smallest threshold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablework.operators.order import local_table, materialize

MOST_BINS = 256
DEEPEST = 60
_SKETCH = 4096
_BATCH = 100_000
_DIGITS = 9


def thresholds(df: DataFrame, features) -> list[np.ndarray]:
    """Split points of every feature: all midpoints of few values, sketch quantiles of many."""
    marks = F.array(*[F.lit(k / MOST_BINS) for k in range(1, MOST_BINS)])
    value = lambda c: F.col(c).cast("double")
    row = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(features)],
                 *[F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value(c), F.lit(_SKETCH)), marks).alias(f"q{i}") for i, c in enumerate(features)]).first()
    few = [c for i, c in enumerate(features) if row[f"n{i}"] <= 2 * MOST_BINS]
    seen: dict = {c: [] for c in few}
    if few:
        cells = F.array(*[F.struct(F.lit(c).alias("c"), value(c).alias("v")) for c in few])
        for r in df.select(F.inline(cells)).distinct().limit(4 * MOST_BINS * len(few)).collect():
            seen[r["c"]].append(r["v"])
    out = []
    for i, c in enumerate(features):
        if 0 < len(seen.get(c, ())) <= MOST_BINS:
            values = np.sort(np.array(seen[c]))
            out.append(values[:-1] + np.diff(values) / 2)
        else:
            out.append(np.unique(np.array(row[f"q{i}"])))
    return out


class GrownTree:
    """Nodes by number (root 1, children 2k and 2k + 1), each with its rows, its values and, if it is split, feature and threshold."""

    def __init__(self, features, task: str, classes):
        self.features, self.task, self.classes = list(features), task, list(classes)
        self.nodes: dict[int, dict] = {}

    def _paths(self, x: np.ndarray, depths) -> np.ndarray:
        """Node of every row (column by column of ``depths``) after that many splits at most."""
        numbers = np.array(sorted(k for k, v in self.nodes.items() if v["feature"] is not None), np.int64)
        feature = np.array([self.nodes[k]["feature"] for k in numbers.tolist()], np.int64)
        cut = np.array([self.nodes[k]["threshold"] for k in numbers.tolist()], np.float64)
        node, out = np.ones(len(x), np.int64), np.empty((len(x), len(depths)), np.int64)
        last = max(depths)
        for level in range(last + 1):
            for j, d in enumerate(depths):
                if d == level:
                    out[:, j] = node
            if level == last or not len(numbers):
                continue
            at = np.minimum(np.searchsorted(numbers, node), len(numbers) - 1)
            split = np.flatnonzero(numbers[at] == node)
            if not len(split):
                out[:, [d > level for d in depths]] = node[:, None]
                break
            right = x[split, feature[at[split]]] > cut[at[split]]
            node[split] = 2 * node[split] + right
        if not len(numbers):
            out[:] = 1
        return out

    @property
    def depth(self) -> int:
        return max(k.bit_length() for k in self.nodes) - 1

    def value(self, node: int) -> tuple[float, float]:
        """(prediction, probability of class 1) of a node; classes that tie go to the smaller one."""
        sums, n = self.nodes[node]["sums"], self.nodes[node]["n"]
        if self.task == "regression":
            return sums[0] / n, 0.0
        share = sums[self.classes.index(1)] / n if 1 in self.classes else 0.0
        return float(self.classes[int(np.argmax(sums))]), share

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and, for classes, ``probability`` of class 1; rows with a missing feature get neither."""
        known = {k: self.value(k) for k in self.nodes}
        features, deepest, paths = self.features, self.depth, self._paths

        @F.pandas_udf("prediction double, probability double")
        def score(x: pd.DataFrame) -> pd.DataFrame:
            values = x.to_numpy(dtype="float64")
            node = paths(np.nan_to_num(values), [deepest])[:, 0]
            got = np.array([known[k] for k in node.tolist()]).reshape(-1, 2)
            got[np.isnan(values).any(axis=1)] = np.nan
            return pd.DataFrame(got, columns=["prediction", "probability"])

        scored = df.withColumn("_score", score(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])))
        whole = F.when(~F.isnan("_score.prediction"), F.col("_score.prediction"))
        if self.task == "regression":
            return scored.withColumn("prediction", whole).drop("_score")
        share = F.when(~F.isnan("_score.probability"), F.col("_score.probability"))
        return scored.withColumns({"probability": share, "prediction": whole.cast("int")}).drop("_score")

    def scores(self, df: DataFrame, target: str, depths) -> list[float]:
        """Accuracy, or R2, of the tree cut at every depth (None: uncut), in one pass."""
        at = [self.depth if d is None else min(d, self.depth) for d in depths]
        known, paths = {k: self.value(k)[0] for k in self.nodes}, self._paths
        names = [f"s{i}" for i in range(len(at))]

        def add(batches):
            total = np.zeros(len(at) + 3)
            for pdf in batches:
                values = pdf.to_numpy(dtype="float64")
                for s in range(0, len(values), _BATCH):
                    x, y = values[s:s + _BATCH, :-1], values[s:s + _BATCH, -1]
                    nodes = paths(x, at)
                    own, back = np.unique(nodes, return_inverse=True)
                    p = np.array([known[k] for k in own.tolist()])[back.reshape(nodes.shape)]
                    total[:len(at)] += ((y[:, None] - p) ** 2).sum(axis=0) if self.task == "regression" else (y[:, None] == p).sum(axis=0)
                    total[len(at):] += len(y), y.sum(), (y * y).sum()
            yield pd.DataFrame([total], columns=[*names, "n", "sum", "squares"])

        narrow = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)], F.col(target).cast("double").alias("_y"))
        kind = ", ".join(f"{c} double" for c in [*names, "n", "sum", "squares"])
        row = narrow.mapInPandas(add, kind).agg(*[F.sum(c).alias(c) for c in [*names, "n", "sum", "squares"]]).first()
        spread = row["squares"] - row["sum"] ** 2 / row["n"]
        return [1 - row[c] / spread if self.task == "regression" else row[c] / row["n"] for c in names]

    def importances(self) -> list[float]:
        """Share of every feature in the impurity that all splits take away."""
        gains = np.zeros(len(self.features))
        for v in self.nodes.values():
            if v["feature"] is not None:
                gains[v["feature"]] += v["gain"]
        return (gains / gains.sum() if gains.sum() else gains).tolist()

    def table(self, spark: SparkSession) -> DataFrame:
        """(node, prediction, n, impurity, gain, left_child, right_child, feature, threshold), impurity and gain per row of the node."""
        rows = []
        for k, v in sorted(self.nodes.items()):
            split = v["feature"] is not None
            rows.append((k, self.value(k)[0], v["n"], v["impurity"] / v["n"], v["gain"] / v["n"] if split else None, 2 * k if split else None,
                         2 * k + 1 if split else None, self.features[v["feature"]] if split else None, v["threshold"]))
        return local_table(spark, rows, "node long, prediction double, n long, impurity double, gain double, left_child long, right_child long, "
                                        "feature string, threshold double")


def _impurity(n: float, sums: np.ndarray, squares: float, task: str) -> float:
    """Squared deviations from the mean, or Gini's impurity times the rows."""
    return max(0.0, squares - float(sums @ sums) / n) if task == "regression" else max(0.0, n - float(sums @ sums) / n)


def grow(df: DataFrame, features, target: str, task: str, max_depth: int | None = None) -> GrownTree:
    """A tree on complete rows; without ``max_depth`` until every leaf is pure or cannot be split."""
    features = list(features)
    known = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(target).cast("double").alias("_y"))
    names = [f"x{i}" for i in range(len(features))]
    cuts = thresholds(known, names)
    classes = [] if task == "regression" else sorted(int(r[0]) for r in known.select("_y").distinct().collect())
    bins = [f"b{i}" for i in range(len(features))]

    def code(batches):
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(cuts) + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(c, x, side="left").astype(np.int16)) for c, x in zip(cuts, columns)] + [batch.column(len(cuts))], names=[*bins, "y"])

    binned = materialize(known.mapInArrow(code, ", ".join(f"{b} short" for b in bins) + ", y double"), "binned")
    parts = [F.sum("y")] if task == "regression" else [F.count_if(F.col("y") == c).cast("double") for c in classes]
    root = binned.agg(F.count("*").alias("n"), F.sum(F.col("y") * F.col("y")).alias("q"), *[p.alias(f"c{j}") for j, p in enumerate(parts)]).first()
    tree = GrownTree(features, task, classes)
    width = len(parts)

    def add(k: int, n: int, sums: np.ndarray, squares: float) -> bool:
        impurity = _impurity(n, sums, squares, task)
        tree.nodes[k] = {"n": int(n), "sums": sums, "squares": squares, "impurity": impurity, "gain": 0.0, "feature": None, "bin": None, "threshold": None}
        return n > 1 and impurity > 1e-9 * (squares if task == "regression" else n)

    open_ = [1] if add(1, root["n"], np.array([root[f"c{j}"] for j in range(width)], float), float(root["q"])) else []
    for _ in range(DEEPEST if max_depth is None else max_depth):
        if not open_:
            break
        found = _best_splits(binned, tree, open_, len(features), width).collect()
        open_ = []
        for r in found:
            node, parent = tree.nodes[r["node"]], r["node"]
            left = np.array([r[f"l{j}"] for j in range(width)], float)
            node |= {"feature": r["f"], "bin": r["b"], "threshold": float(cuts[r["f"]][r["b"]]), "gain": r["share"] * node["impurity"]}
            for k, n, sums, squares in ((2 * parent, r["nl"], left, r["ql"]), (2 * parent + 1, node["n"] - r["nl"], node["sums"] - left, node["squares"] - r["ql"])):
                if add(k, n, sums, squares):
                    open_.append(k)
    return tree


def _best_splits(binned: DataFrame, tree: GrownTree, open_, n_features: int, width: int) -> DataFrame:
    """(node, f, b, share, nl, ql, l0, ...): the best split of every open node that has one."""
    splits = {k: (v["feature"], v["bin"]) for k, v in tree.nodes.items() if v["feature"] is not None}
    numbers = np.array(sorted(splits), np.int64)
    feature, cut = (np.array([splits[k][i] for k in numbers.tolist()], np.int64) for i in (0, 1))
    wanted = np.array(sorted(open_), np.int64)
    levels, classes, regression = int(wanted[0]).bit_length() - 1, np.array(tree.classes, float), tree.task == "regression"
    names = ["node", "f", "b", "n", "q", *[f"c{j}" for j in range(width)]]

    def count(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, _BATCH):
                part = batch.slice(s, _BATCH)
                columns = [part.column(i).to_numpy(zero_copy_only=False) for i in range(n_features + 1)]
                x, y = np.stack(columns[:-1], axis=1).astype(np.int64), columns[-1]
                node = np.ones(len(x), np.int64)
                for _ in range(levels if len(numbers) else 0):
                    at = np.minimum(np.searchsorted(numbers, node), len(numbers) - 1)
                    on = np.flatnonzero(numbers[at] == node)
                    node[on] = 2 * node[on] + (x[on, feature[at[on]]] > cut[at[on]])
                at = np.minimum(np.searchsorted(wanted, node), len(wanted) - 1)
                on = np.flatnonzero(wanted[at] == node)
                if not len(on):
                    continue
                weights = [y[on]] if regression else [(y[on] == c).astype(float) for c in classes]
                for f in range(n_features):
                    key, back = np.unique(at[on] * (MOST_BINS + 1) + x[on, f], return_inverse=True)
                    sums = [np.bincount(back, w, len(key)) for w in (np.ones(len(on)), y[on] ** 2, *weights)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(wanted[key // (MOST_BINS + 1)]), pa.array(np.full(len(key), f, np.int32)), pa.array((key % (MOST_BINS + 1)).astype(np.int32)),
                         *[pa.array(v) for v in sums]], names=names)

    kind = "node long, f int, b int, n double, q double, " + ", ".join(f"c{j} double" for j in range(width))
    cells = binned.mapInArrow(count, kind).groupBy("node", "f", "b").agg(*[F.sum(c).alias(c) for c in names[3:]])
    along, whole = Window.partitionBy("node", "f").orderBy("b"), Window.partitionBy("node", "f")
    for c, left in (("n", "nl"), ("q", "ql"), *[(f"c{j}", f"l{j}") for j in range(width)]):
        cells = cells.withColumns({left: F.sum(c).over(along), f"{left}_t": F.sum(c).over(whole)})
    square = lambda col: sum((col(j) * col(j) for j in range(1, width)), col(0) * col(0))
    left, total = square(lambda j: F.col(f"l{j}")), square(lambda j: F.col(f"l{j}_t"))
    right = square(lambda j: F.col(f"l{j}_t") - F.col(f"l{j}"))
    n, t = F.col("nl"), F.col("nl_t")
    size = F.col("ql_t") if regression else t
    rated = cells.filter(n < t).withColumn("share", F.round((left / n + right / (t - n) - total / t) / (size - total / t), _DIGITS)).filter("share > 0")
    best = F.min(F.struct((-F.col("share")).alias("s"), "f", "b", "nl", "ql", *[f"l{j}" for j in range(width)])).alias("x")
    got = rated.groupBy("node").agg(best)
    return got.select("node", (-F.col("x.s")).alias("share"), *[F.col(f"x.{c}").alias(c) for c in ("f", "b", "ql", *[f"l{j}" for j in range(width)])], F.col("x.nl").cast("long").alias("nl"))
