"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors (``SAMPLE`` rows, picked by a hash of the id) the driver builds the graph of
nearest neighbours, cuts it into equal parts by recursive spectral bisection with swaps, and fits a
softmax classifier to the parts that a vector's neighbours lie in. Every row of the table then goes to its most
probable partition; a query goes to its most probable partitions, and its candidates there are ranked by exact distance on the
original vectors. How many partitions that are is measured: part of the sample is held out of graph and classifier, its true
neighbours in the sample are found, and the fewest partitions count that hold ``TARGET`` of them. On vectors without
structure that may be nearly all.

A partition's rows are dealt to blocks of about ``BLOCK`` rows and its queries to groups of as many,
each counted before, so neither a hot partition nor a group of equal vectors is one task's work. A
block keeps the best ``k`` for a query, ties to the smaller id, and a last ranking joins the blocks.

Vectors that are null, of another length than most, zero, or hold a null, NaN or infinity take no part,
nor do null ids. A row that repeats an id is a candidate of its own, but never for a query of its id. With fewer
candidates than ``k`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablework.llm import common

SAMPLE = 4096
ROWS_PER_PART = 4096
FEWEST, MOST = 4, 256
TARGET = 0.92
HELD_OUT = 512
BLOCK = 4096
GRAPH_K = 10
_EPOCHS = 120
_FOUND = "query_id long, vec_id long, score double"


def neighbour_graph(x: np.ndarray, k: int = GRAPH_K) -> np.ndarray:
    """(n, k) numbers of each vector's nearest others, by blocks of rows."""
    n, k = len(x), min(k, len(x) - 1)
    out, norms = np.empty((n, k), np.int64), (x * x).sum(axis=1)
    for at in range(0, n, 512):
        d = norms[None, :] - 2 * (x[at:at + 512] @ x.T)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out[at:at + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def bisect(edges: np.ndarray, n: int, turns: int = 60, swaps: int = 4) -> np.ndarray:
    """Halves of equal size with few edges between them; ``edges`` is (m, 2) over 0..n-1."""
    a, b = edges.T
    degree = np.maximum(np.bincount(a, minlength=n) + np.bincount(b, minlength=n), 1).astype(float)
    scale = 1 / np.sqrt(degree)
    steady = np.sqrt(degree) / np.linalg.norm(np.sqrt(degree))
    v = np.random.default_rng(n).normal(size=n)
    spread = lambda z: np.bincount(a, z[b], n) + np.bincount(b, z[a], n)
    for _ in range(turns):
        v -= steady * (steady @ v)
        v = v + scale * spread(scale * v)
        v /= max(np.linalg.norm(v), 1e-300)
    side = np.zeros(n, bool)
    side[np.argsort(v * scale, kind="stable")[n // 2:]] = True
    for _ in range(swaps):
        own = np.where(side, 1.0, -1.0)
        gain = -own * spread(own)  # edges cut less edges kept
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        good = int((gain[left[:m]] + gain[right[:m]] > 0).sum()) // 2  # half of them: moving both ends of an edge gains nothing
        if not good:
            break
        side[left[:good]], side[right[:good]] = True, False
    return side


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of every node, ``parts`` a power of two."""
    n = len(graph)
    edges = np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], axis=1)
    part, count = np.zeros(n, np.int64), 1
    while count < parts:
        new = part * 2
        for p in range(count):
            nodes = np.flatnonzero(part == p)
            if len(nodes) < 2:
                continue
            number = np.full(n, -1)
            number[nodes] = np.arange(len(nodes))
            inside = number[edges]
            new[nodes] += bisect(inside[(inside >= 0).all(axis=1)], len(nodes))
        part, count = new, count * 2
    return part


class Router:
    """Softmax classifier from a vector to its partitions."""

    def __init__(self, mean: np.ndarray, scale: float, weights: np.ndarray, offsets: np.ndarray):
        self.mean, self.scale, self.weights, self.offsets = mean, scale, weights, offsets

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            z = np.clip(np.nan_to_num((x - self.mean) * self.scale), -1e6, 1e6) @ self.weights + self.offsets
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """All parts of every vector, the most probable first."""
        return np.argsort(-self.probabilities(x), axis=1, kind="stable")


def visits_for(router: Router, asked: np.ndarray, rows: np.ndarray, target: float, k: int = GRAPH_K) -> int:
    """Fewest partitions in which the ``asked`` vectors find ``target`` of their true neighbours among ``rows``."""
    parts = router.weights.shape[1]
    if not len(asked) or len(rows) <= k or parts < 2:
        return parts
    home, order = router.ranked(rows)[:, 0], router.ranked(asked)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    found = np.zeros(parts)
    for i, q in enumerate(asked):
        d = ((rows - q) ** 2).sum(axis=1)
        found += np.bincount(place[i, home[np.argpartition(d, k)[:k]]], minlength=parts)
    return int(np.searchsorted(np.cumsum(found) / found.sum(), target)) + 1


def fit_router(x: np.ndarray, parts: int, epochs: int = _EPOCHS) -> Router:
    """Partition the sample's neighbour graph and learn which partitions a vector's neighbours are in."""
    mean = x.mean(axis=0) if len(x) else 0.0
    wide = float(np.abs(x - mean).max()) if len(x) else 0.0
    spread = wide * float(np.sqrt((((x - mean) / wide) ** 2).mean())) if 0 < wide < np.inf else 0.0
    scale = 1 / spread if spread > 0 else 1.0
    d = x.shape[1]
    router = Router(mean, scale, np.zeros((d, parts)), np.zeros(parts))
    if parts < 2 or len(x) < 2 * parts:
        router.weights, router.offsets = np.zeros((d, 1)), np.zeros(1)
        return router
    graph = neighbour_graph((x - mean) * scale)
    part = balanced_parts(graph, parts)
    hot = np.eye(parts)
    wanted = (hot[part] + hot[part[graph]].sum(axis=1)) / (1 + graph.shape[1])
    z = (x - mean) * scale
    w, b, rate = router.weights, router.offsets, 0.05
    first, second = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, epochs + 1):
        router.weights, router.offsets = w, b
        pull = (router.probabilities(x) - wanted) / len(x)
        for i, g in enumerate((z.T @ pull + 1e-5 * w, pull.sum(axis=0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
        steps = [rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-12) for m, v in zip(first, second)]
        w, b = w - steps[0], b - steps[1]
    router.weights, router.offsets = w, b
    return router


def _valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    named = named.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    length = named.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return named.filter(F.size("v") == (length["d"] if length else 0))


def _matrix(array: pa.Array) -> np.ndarray:
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(array), -1) if len(array) else np.empty((0, 0))


def _routed(rows: DataFrame, router: Router, visits: int) -> DataFrame:
    """(id, part, v): every row in each of its ``visits`` most probable parts."""

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            part = router.ranked(_matrix(batch.column(1)))[:, :visits].ravel()
            at = np.repeat(np.arange(batch.num_rows), len(part) // batch.num_rows)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([taken.column(0), pa.array(part, pa.int32()), taken.column(1)], names=["id", "part", "v"])

    return rows.mapInArrow(route, "id long, part int, v array<double>")


def best_of(ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ``k`` nearest rows to ``q`` with another id, and their distances, ties to the smaller id."""
    with np.errstate(over="ignore", invalid="ignore"):
        rough = (x * x).sum(axis=1) - 2 * (x @ q) + q @ q
        unsure = ~np.isfinite(rough) & (ids != own)  # squares overflow: ranked by the difference alone
        rough[unsure | (ids == own)] = np.inf
        near = np.flatnonzero(ids != own)
        if np.isfinite(rough).sum() > k:
            limit = np.partition(rough, k - 1)[k - 1]
            near = np.flatnonzero(unsure | (rough <= limit + 1e-9 * (1.0 + abs(limit) + q @ q)))
        gap = x[near] - q
        exact = np.sqrt((gap ** 2).sum(axis=1))
        far = ~np.isfinite(exact)
        if far.any():  # squares overflow where distances do not
            most = np.abs(gap[far]).max(axis=1)
            exact[far] = most * np.sqrt(((gap[far] / most[:, None]) ** 2).sum(axis=1))
    order = np.lexsort((ids[near], exact))[:k]
    return near[order], exact[order]


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10, target: float = TARGET,
            sample: int = SAMPLE, rows_per_part: int = ROWS_PER_PART, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found; ``is_query`` is a condition on the id column."""
    rows = common.materialize(_valid(vectors, key, vector), "vectors")
    n = rows.count()
    share = min(1.0, sample / max(1, n))
    picked = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 24)) < share * (1 << 24)).orderBy(F.xxhash64("id"), "id").limit(2 * sample).collect()
    x = np.array(sorted(tuple(r["v"]) for r in picked), np.float64)
    x = np.unique(x, axis=0) if len(x) else np.zeros((0, 1))
    parts = 1 << max(int(np.log2(FEWEST)), min(int(np.log2(MOST)), round(np.log2(max(1, n / rows_per_part)))))
    held = np.zeros(len(x), bool)
    held[np.random.default_rng(len(x)).permutation(len(x))[:min(HELD_OUT, len(x) // 5)]] = True
    router = fit_router(x[~held], parts)
    visits = visits_for(router, x[held], x[~held], target)

    index = common.materialize(_routed(rows, router, 1), "index")
    asked = common.materialize(_routed(rows.filter(is_query(F.col("id"))), router, visits), "asked")
    sizes = index.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    groups = asked.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("groups"))
    sizes = F.broadcast(common.materialize(sizes.join(groups, "part"), "part-sizes"))  # one row for each of at most MOST parts
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    queries = asked.join(sizes, "part").select(
        "part", every("blocks").alias("block"), F.pmod(F.xxhash64("id"), F.col("groups")).cast("int").alias("grp"), F.lit(0).alias("kind"), "id", "v")
    candidates = index.join(sizes, "part").select(
        "part", F.pmod(F.xxhash64(F.lit(1), "id"), F.col("blocks")).cast("int").alias("block"), every("groups").alias("grp"), F.lit(1).alias("kind"), "id", "v")
    met = queries.union(candidates).repartition("part", "block", "grp").sortWithinPartitions("part", "block", "grp", "kind", "id")

    def rank(batches):
        at, ask_ids, asks, ids, held = None, [], [], [], []

        def close():
            if not asks or not held:
                return []
            own, data, out = np.concatenate(ids), np.concatenate(held), []
            for one, q in zip(np.concatenate(ask_ids), np.concatenate(asks)):
                which, score = best_of(own, data, one, q, k)
                out.append((np.full(len(which), one), own[which], score))
            return [pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([o[i] for o in out]), t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                names=["query_id", "vec_id", "score"])]

        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = np.r_[0, np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1, len(cells)]
            keys, data = batch.column(4).to_numpy(), _matrix(batch.column(5))
            for s, e in zip(cuts[:-1], cuts[1:]):
                cell = tuple(cells[s, :3])
                if cell != at:
                    yield from close()
                    at, ask_ids, asks, ids, held = cell, [], [], [], []
                (ask_ids if cells[s, 3] == 0 else ids).append(keys[s:e])
                (asks if cells[s, 3] == 0 else held).append(data[s:e])
        yield from close()

    near = met.mapInArrow(rank, _FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_learned_partitions(spark, sf_dir):
    """The 10 nearest found of every vector whose id is divisible by 100."""
    return nearest(common.table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)
