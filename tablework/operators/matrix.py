"""Vectors, sparse coordinate matrices, sequences and words.

A matrix is a table ``(i, j, v)``; a vector table has an array column.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.semantics import col, numeric_names, words
from tablework.operators.order import local_rows, materialize, ordered_index
from tablework.operators.quantiles import column_quantiles, exact_quantiles

_BROADCAST_VALUES = 1_000_000
_BLOCK_ROWS = 2_000
_INVERSE_LIMIT = 512
_BLOCK_SIDE = 256


def sum_of_squares(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column).cast("double")
    return df.agg(F.coalesce(F.sum(x * x), F.lit(0.0)).alias("sum_of_squares"))


def dot_product(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(F.col(a).cast("double") * F.col(b)), F.lit(0.0)).alias("dot_product"))


def abs_distance(df: DataFrame, a: str, b: str, out: str = "distance") -> DataFrame:
    return df.withColumn(out, F.abs(F.col(a) - F.col(b)))


def axis_stats(df: DataFrame, columns=None) -> DataFrame:
    """Mean, median, population std and variance per column and over all cells, quartiles too."""
    columns = list(columns or numeric_names(df))
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("v")) for c in columns
    ])))
    # one pass over the cells; the overall row comes from the same cells under a second label
    labelled = cells.select(F.explode(F.array(F.col("axis"), F.lit("*"))).alias("axis"), "v")
    stats = labelled.groupBy("axis").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.var_pop("v").alias("var"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    per = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    overall = exact_quantiles(cells, ["v"], [0.25, 0.5, 0.75]).get(((), "v"), {"q": [None] * 3})["q"]
    rows = [(c, *q) for c, q in per.items()] + [("*", *overall)]
    quartiles = local_rows(df.sparkSession, rows, "axis string, p25 double, median double, p75 double")
    return stats.join(quartiles, "axis")


def to_cells(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """Vector rows as matrix cells ``(i, j, v)``."""
    return df.select(F.col(row_id).alias("i"), F.posexplode(vector).alias("j", "v")).select(
        "i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v"))


def _blocks(cells: DataFrame, rows: str, columns: str, size: int) -> DataFrame:
    """Cells grouped into square blocks ``(rows, columns, octets)``: of each cell its place in the block and its value."""
    at = lambda c: F.floor(F.col(c) / F.lit(size)).cast("long")
    place = (F.pmod("i", F.lit(size)) * size + F.pmod("j", F.lit(size))).cast("int")
    known = cells.filter("i IS NOT NULL AND j IS NOT NULL AND v IS NOT NULL")
    parts = known.groupBy(at("i").alias(rows), at("j").alias(columns), place.alias("p")).agg(F.sum(F.col("v").cast("double")).alias("v"))
    return parts.groupBy(rows, columns).agg(F.collect_list(F.struct("p", "v")).alias("cells"))


def mat_multiply(a: DataFrame, b: DataFrame, size: int = _BLOCK_SIDE, depth: int = 8) -> DataFrame:
    """Product of two coordinate matrices ``(i, j, v)``, block by block; cells that repeat add up, as they do in a sum of products.

    The result is cut into a grid of ``size`` x ``size`` blocks. A block of ``a`` goes once to every block column where ``b`` has a block
    of the same inner index, one of ``b`` likewise, so what moves is blocks times the width of the grid, not one
    row per elementary product. A task multiplies ``depth`` inner blocks of one result block with dense arrays and hands on
    their sum; an occupancy product keeps cells without any product out of the result.
    """
    left = materialize(_blocks(a, "bi", "bk", size), "blocks-a")
    right = materialize(_blocks(b, "bk", "bj", size), "blocks-b")
    group = F.floor(F.col("bk") / F.lit(depth))
    own = lambda df, tag: df.select("bk", "cells", *[F.col(c).alias(f"{c}{tag}") for c in ("bi", "bj", "g")])
    wide = lambda df, other, key, tag: own(df.join(other.select("bk", key), "bk").withColumn("g", group), tag)
    kind = "bi long, bj long, p int, v double"

    def dense(cells):
        out, there = np.zeros(size * size), np.zeros(size * size)
        places = np.fromiter((c["p"] for c in cells), np.int64, len(cells))
        out[places] = np.fromiter((c["v"] for c in cells), np.float64, len(cells))
        there[places] = 1
        return out.reshape(size, size), there.reshape(size, size)

    def multiply(key, xs, ys):
        total, hits = np.zeros((size, size)), np.zeros((size, size))
        other = dict(zip(ys["bk"], ys["cells"]))
        for k, cells in zip(xs["bk"], xs["cells"]):
            if k in other:
                (x, xt), (y, yt) = dense(cells), dense(other[k])
                total += x @ y
                hits += xt @ yt
        p = np.flatnonzero(hits)
        return pd.DataFrame({"bi": key[0], "bj": key[1], "p": p.astype(np.int32), "v": total.ravel()[p]})

    keyed = lambda df, tag: df.groupBy(*[f"{c}{tag}" for c in ("bi", "bj", "g")])
    parts = keyed(wide(left, right, "bj", "_a"), "_a").cogroup(keyed(wide(right, left, "bi", "_b"), "_b")).applyInPandas(multiply, kind)
    summed = parts.groupBy("bi", "bj", "p").agg(F.sum("v").alias("v"))
    return summed.select((F.col("bi") * size + F.floor(F.col("p") / size)).alias("i"), (F.col("bj") * size + F.col("p") % size).alias("j"), "v")


def mat_transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def gram_cells(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """X'X of a vector column as cells: each task folds its rows into one dense block."""
    def fold(batches):
        total = np.zeros((dim, dim))
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy()).astype("float64")
                total += x.T @ x
        i, j = np.indices((dim, dim))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    parts = df.select(F.col(vector).alias("x")).mapInPandas(fold, "i long, j long, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def det_inverse(matrices: DataFrame, id_col: str = "matrix_id") -> DataFrame:
    """Determinant and inverse of many small matrices given as cells ``(id, i, j, v)``.

    One row per cell of the inverse. A matrix that is not square or not invertible gives one
    row with the reason in ``error``; one above 512 x 512 is refused that way too, before its
    cells are brought together.
    """
    kind = matrices.schema[id_col].dataType.simpleString()
    size = matrices.groupBy(id_col).agg(
        (F.max("i") + 1).alias("rows"), (F.max("j") + 1).alias("cols"), F.count("*").alias("cells"))
    bad = (
        F.when(F.col("rows") != F.col("cols"), "not square")
        .when(F.col("rows") > _INVERSE_LIMIT, "too large")
        .when(F.col("cells") > F.col("rows") * F.col("cols"), "repeated cells")
    )
    checked = size.withColumn("error", bad)
    good = matrices.join(checked.filter("error IS NULL").select(id_col, "rows"), id_col)
    # at most 512 x 512 cells per row, as checked above
    packed = good.groupBy(id_col).agg(
        F.first("rows").cast("int").alias("n"), F.collect_list("i").alias("i"), F.collect_list("j").alias("j"), F.collect_list("v").alias("v"))

    def solve(batches):
        for pdf in batches:
            out: dict = {c: [] for c in (id_col, "det", "i", "j", "v", "error")}

            def put(key, det, i, j, v, error):
                for c, x in zip(out, (key, det, i, j, v, error)):
                    out[c].append(x)

            for key, n, i, j, v in zip(pdf[id_col], pdf["n"], pdf["i"], pdf["j"], pdf["v"]):
                m = np.zeros((n, n))
                m[i, j] = v
                if not np.linalg.cond(m) < 1 / np.finfo(float).eps:
                    put(key, 0.0, None, None, None, "not invertible")
                    continue
                a, b = np.indices((n, n))
                columns = ([key] * n * n, [float(np.linalg.det(m))] * n * n, a.ravel().tolist(), b.ravel().tolist(),
                           np.linalg.inv(m).ravel().tolist(), [None] * n * n)
                for c, x in zip(out, columns):
                    out[c].extend(x)
            yield pd.DataFrame({c: pd.Series(x, dtype="Int64" if c in ("i", "j") else None) for c, x in out.items()})

    solved = packed.mapInPandas(solve, f"{id_col} {kind}, det double, i long, j long, v double, error string")
    refused = checked.filter("error IS NOT NULL").select(
        id_col, F.lit(None).cast("double").alias("det"), F.lit(None).cast("long").alias("i"),
        F.lit(None).cast("long").alias("j"), F.lit(None).cast("double").alias("v"), "error")
    return solved.unionByName(refused)


def reshape_rows(df: DataFrame, order_by, value: str, width: int) -> DataFrame:
    """Row-major regrouping of a sequence into cells of rows of ``width``."""
    if width <= 0 or df.count() % width:
        raise ValueError(f"the number of values is not a multiple of {width}")
    placed = ordered_index(df.select(*dict.fromkeys([*order_by, value])), order_by, "idx")
    return placed.select(
        F.floor(F.col("idx") / width).alias("i"), (F.col("idx") % width).alias("j"), F.col(value).alias("v"))


def flatten_cells(cells: DataFrame, width: int) -> DataFrame:
    """Cells back to a sequence ``(idx, v)``."""
    return cells.select((F.col("i") * width + F.col("j")).alias("idx"), "v")


def chunk_rows(df: DataFrame, order_by, value: str, size: int) -> DataFrame:
    """Consecutive batches of ``size`` values; only the last one may be shorter."""
    if size <= 0:
        raise ValueError("size must be positive")
    placed = ordered_index(df.select(*dict.fromkeys([*order_by, value])), order_by, "idx")
    item = F.struct("idx", F.col(value).alias("v"))
    chunks = placed.groupBy(F.floor(F.col("idx") / size).alias("chunk")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return chunks.select("chunk", F.transform("items", lambda x: x["v"]).alias("items"))


def flatten_array(df: DataFrame, column: str, out: str) -> DataFrame:
    """Flatten nested arrays to one level, to whatever depth the schema has."""
    from pyspark.sql.types import ArrayType

    kind, value = df.schema[column].dataType, col(column)
    while isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType):
        value, kind = F.flatten(value), kind.elementType
    return df.withColumn(out, value)


def word_frequency(df: DataFrame, text: str) -> DataFrame:
    """How often each lower-cased word occurs over all texts."""
    return df.select(F.explode(words(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _dimension(df: DataFrame, vector: str) -> int | None:
    sizes = df.agg(F.min(F.size(vector)).alias("a"), F.max(F.size(vector)).alias("b")).first()
    if sizes["a"] != sizes["b"]:
        raise ValueError(f"vectors in {vector} have different lengths")
    return sizes["a"]


def pairwise_distance(a: DataFrame, a_id: str, a_vec: str, b: DataFrame, b_id: str, b_vec: str) -> DataFrame:
    """Euclidean distance of every row of ``a`` to every row of ``b``.

    The result has one row per pair by definition. A ``b`` that is counted to hold at most a million numbers is packed into arrays on
    the executors and goes to the tasks as these (8 MB at most); a larger one is cut into blocks, and each block meets each
    slice of ``a`` in its own task.
    """
    da, db = _dimension(a, a_vec), _dimension(b, b_vec)
    if da is not None and db is not None and da != db:
        raise ValueError(f"dimensions differ: {da} and {db}")
    spark = a.sparkSession
    left = a.select(F.col(a_id).alias("_a"), F.col(a_vec).cast("array<double>").alias("_x"))
    right = b.select(F.col(b_id).alias("_b"), F.col(b_vec).cast("array<double>").alias("_y"))
    a_kind, b_kind = a.schema[a_id].dataType.simpleString(), b.schema[b_id].dataType.simpleString()
    schema = f"{a_id} {a_kind}, {b_id} {b_kind}, distance double"
    n_b = b.count()
    if n_b * (db or 1) <= _BROADCAST_VALUES:
        packed = spark.sparkContext.broadcast(_packed(right))

        def measure(batches):
            ids, ys = packed.value
            for pdf in batches:
                for start in range(0, len(pdf), _BLOCK_ROWS):
                    part = pdf.iloc[start:start + _BLOCK_ROWS]
                    if len(part) and len(ids):
                        yield _distances(part["_a"].to_numpy(), np.stack(part["_x"].to_numpy()), ids, ys, a_id, b_id)

        return left.mapInPandas(measure, schema)
    # a task holds one block of each side and their distances
    blocks, slices = -(-n_b // _BLOCK_ROWS), -(-a.count() // _BLOCK_ROWS)
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = left.withColumn("_s", block("_a", slices)).withColumn("_k", every(blocks))
    right = right.withColumn("_k", block("_b", blocks)).withColumn("_s", every(slices))

    def meet(key, xs, ys):
        if not len(xs) or not len(ys):
            return pd.DataFrame({a_id: [], b_id: [], "distance": []})
        return _distances(xs["_a"].to_numpy(), np.stack(xs["_x"].to_numpy()), ys["_b"].to_numpy(), np.stack(ys["_y"].to_numpy()), a_id, b_id)

    return left.groupBy("_s", "_k").cogroup(right.groupBy("_s", "_k")).applyInPandas(meet, schema)


def _packed(right: DataFrame) -> tuple[list, np.ndarray]:
    """Ids and vectors of a small table, packed by its tasks: the driver gets one array a task and builds no rows."""

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, pa.schema([batch.schema.field(0)])) as writer:
                    writer.write_batch(batch.select([0]))
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()]), pa.array([values.tobytes()])], names=["ids", "values"])

    ids, parts = [], []
    for row in right.mapInArrow(pack, "ids binary, values binary").collect():
        own = pa.ipc.open_stream(bytes(row["ids"])).read_all().column(0).to_pylist()
        ids += own
        parts.append(np.frombuffer(bytes(row["values"])).reshape(len(own), -1))
    return ids, np.concatenate(parts) if parts else np.empty((0, 0))


def _distances(a_ids, x, b_ids, y, a_id, b_id) -> pd.DataFrame:
    d = np.empty((len(x), len(y)))
    for k in range(len(y)):
        diff = x - y[k]
        d[:, k] = np.sqrt((diff * diff).sum(axis=1))
    return pd.DataFrame({
        a_id: np.repeat(np.asarray(a_ids), len(y)), b_id: np.tile(np.asarray(b_ids), len(x)), "distance": d.ravel(),
    })
