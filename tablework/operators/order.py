"""Global order without a one-task window.

Rows are range-partitioned on the order keys, sorted inside each partition and
written once to the shared scratch folder together with their position. Range
bounds are sampled, so the written table (not a recomputation) is what later
steps read: a lost executor cannot change a position. Only one row per
partition ever reaches the driver.
"""

from __future__ import annotations

import atexit
import bisect
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablework.functions.semantics import col

_BROADCAST_ROWS = 1_000_000
_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


_local_roots: list[str] = []


def _local_root() -> str:
    """One folder for this process, removed when it ends; only for local mode without a configured one."""
    if not _local_roots:
        _local_roots.append(tempfile.mkdtemp(prefix="tablework-"))
        atexit.register(shutil.rmtree, _local_roots[0], ignore_errors=True)
    return _local_roots[0]


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/tablework/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: a lineage cut that survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Rows held by the driver as a table of known size, built from arrays: reading it back takes no job."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if any(isinstance(f.dataType, (T.TimestampType, T.ArrayType, T.MapType, T.StructType)) for f in kind.fields):
        return spark.createDataFrame(rows, kind)
    arrow = to_arrow_schema(kind)
    columns = list(zip(*rows)) or [[]] * len(kind.fields)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), kind)


def local_rows(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Rows held by the driver as a table, marked for broadcast up to a million of them."""
    df = local_table(spark, rows, schema)
    return F.broadcast(df) if len(rows) <= _BROADCAST_ROWS else df


def _offsets(spark: SparkSession, totals: list[tuple], dtypes: list[str]) -> DataFrame:
    """Exclusive running totals per partition; ``totals`` has one row per partition."""
    rows, run = [], [0.0 if t == "double" else 0 for t in dtypes]
    for pid, *values in sorted(totals):
        rows.append((pid, *run))
        run = [r + v for r, v in zip(run, values)]
    schema = "_pid long" + "".join(f", _off{i} {t}" for i, t in enumerate(dtypes))
    return local_rows(spark, rows, schema)


def ordered_index(df: DataFrame, order_by, index_col: str = "idx") -> DataFrame:
    """Contiguous 0-based position of every row in the order of ``order_by``.

    ``order_by`` must end in a unique key so that the order is total.
    """
    order = [col(c) for c in order_by]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = materialize(placed, "ordered")
    pid = F.shiftright("_at", _POS_BITS)
    sizes = stored.groupBy(pid.alias("_pid")).count().collect()
    offsets = _offsets(df.sparkSession, [(r["_pid"], r["count"]) for r in sizes], ["long"])
    return (
        stored.withColumn("_pid", pid)
        .join(offsets, "_pid")
        .withColumn(index_col, F.col("_off0") + F.col("_at").bitwiseAND(F.lit(_POS_MASK)))
        .drop("_pid", "_at", "_off0")
    )


def prefix_sum(df: DataFrame, order_by, weights: dict[str, str]) -> DataFrame:
    """Exclusive running totals in global order: ``{output column: weight column}``.

    Weights must be of type bigint or double. Hot order keys are no problem as long as
    callers group equal keys first (one row per key), which every caller here does.
    """
    order = [col(c) for c in order_by]
    names, sources = list(weights), list(weights.values())
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds = ["double" if isinstance(types[s], T.DoubleType) else "long" for s in sources]
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id().cast("long"))
    )
    schema = T.StructType(ranged.schema.fields + [
        T.StructField(f"_run{i}", T.DoubleType() if k == "double" else T.LongType())
        for i, k in enumerate(kinds)
    ])

    def running(batches):
        carry = [0] * len(sources)
        for batch in batches:
            out = list(batch.columns)
            for i, s in enumerate(sources):
                kind = pa.float64() if kinds[i] == "double" else pa.int64()
                total = np.cumsum(pc.fill_null(batch.column(s), 0).cast(kind).to_numpy()) + carry[i]
                out.append(pa.array(total, kind))
                if len(total):
                    carry[i] = total[-1]
            yield pa.RecordBatch.from_arrays(out, names=list(batch.schema.names) + [f"_run{i}" for i in range(len(sources))])

    stored = materialize(ranged.mapInArrow(running, schema), "prefix")
    totals = stored.groupBy("_pid").agg(*[F.max(f"_run{i}") for i in range(len(sources))]).collect()
    offsets = _offsets(df.sparkSession, [tuple(r) for r in totals], kinds)
    out = stored.join(offsets, "_pid")
    out = out.withColumns({
        n: F.col(f"_off{i}") + F.col(f"_run{i}") - F.coalesce(F.col(s), F.lit(0))
        for i, (n, s) in enumerate(zip(names, sources))
    })
    return out.select(*df.columns, *names)


def carry_fill(df: DataFrame, order_by, columns, by=(), backward: bool = False) -> DataFrame:
    """Fill gaps with the previous (or next) valid value in global order, within ``by``.

    The fill runs inside each range partition; what a partition hands to the next one is a
    single row, so neither the whole table nor a hot group is ever one task's work.
    """
    by, columns = list(by), list(columns)
    spark = df.sparkSession
    keys = [col(c) for c in [*by, *order_by]]
    if backward:
        keys = [k.desc_nulls_last() for k in keys]
    group = F.to_json(F.struct(*by)) if by else F.lit("")
    ranged = (
        df.withColumn("_group", group)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )

    def fill(batches):
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            if last is not None:
                table = pa.concat_tables([last, table])
            table = table.combine_chunks()
            n = table.num_rows
            group_of = table.column("_group").to_numpy(zero_copy_only=False)
            at = np.arange(n)
            new_run = np.r_[True, group_of[1:] != group_of[:-1]]
            run_start = np.maximum.accumulate(np.where(new_run, at, 0))
            for name in columns:
                values = table.column(name).combine_chunks()
                valid = values.is_valid().to_numpy(zero_copy_only=False)
                seen = np.maximum.accumulate(np.where(valid, at, -1))
                take = pa.array(seen, mask=seen < run_start)
                table = table.set_column(table.schema.get_field_index(name), table.schema.field(name), values.take(take))
            skip = 0 if last is None else 1
            last = table.slice(n - 1, 1)
            yield from table.slice(skip).combine_chunks().to_batches()

    stored = materialize(ranged.mapInArrow(fill, ranged.schema), "fill")
    pid = F.shiftright("_at", _POS_BITS)
    ends = stored.groupBy(pid.alias("_pid")).agg(
        F.min_by("_group", "_at").alias("first"),
        F.max_by(F.struct("_group", *columns), "_at").alias("last"),
    ).collect()
    carried, held_group, held = [], None, [None] * len(columns)
    for row in sorted(ends, key=lambda r: r["_pid"]):
        incoming = held if row["first"] == held_group else [None] * len(columns)
        carried.append((row["_pid"], row["first"], *incoming))
        tail = [row["last"][c] for c in columns]
        if row["last"]["_group"] == row["first"]:
            tail = [t if t is not None else i for t, i in zip(tail, incoming)]
        held_group, held = row["last"]["_group"], tail
    schema = T.StructType(
        [T.StructField("_pid", T.LongType()), T.StructField("_first", T.StringType())]
        + [T.StructField(f"_in{i}", df.schema[c].dataType) for i, c in enumerate(columns)]
    )
    carry = local_rows(spark, carried, schema)
    out = stored.withColumn("_pid", pid).join(carry, "_pid")
    out = out.withColumns({
        c: F.coalesce(F.col(c), F.when(F.col("_group") == F.col("_first"), F.col(f"_in{i}")))
        for i, c in enumerate(columns)
    })
    return out.select(*df.columns)


class StoredOrder:
    """A table written once in global order, a folder for each range, with the number of rows before every range.

    A slice or a list of positions opens only the folders that hold it. The driver keeps two numbers a range.
    """

    def __init__(self, df: DataFrame, order_by):
        order = [col(c) for c in order_by]
        self.columns = df.columns
        ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
        placed = ranged.withColumns({"_at": F.monotonically_increasing_id(), "_range": F.spark_partition_id()})
        path = scratch_path(df.sparkSession, "stored-order")
        placed.write.partitionBy("_range").parquet(path)
        self.stored = df.sparkSession.read.schema(placed.schema).parquet(path)
        sizes = {r["_range"]: r["count"] for r in self.stored.groupBy("_range").count().collect()}
        self.starts, run = [], 0
        for pid in sorted(sizes):
            self.starts.append((pid, run, run + sizes[pid]))
            run += sizes[pid]
        self.n = run

    def _of(self, ranges) -> DataFrame:
        """Rows of the given ranges with ``_idx``, their position."""
        offset = F.element_at(F.create_map(*[F.lit(x) for pid, first, _ in ranges for x in (pid, first)]), F.col("_range")).cast("long")
        own = self.stored.filter(F.col("_range").isin([pid for pid, *_ in ranges]))
        return own.withColumn("_idx", offset + F.col("_at").bitwiseAND(F.lit(_POS_MASK)))

    def between(self, start: int, stop: int) -> DataFrame:
        """Rows at positions ``[start, stop)``."""
        ranges = [r for r in self.starts if r[1] < stop and r[2] > start]
        if not ranges:
            return self.stored.select(*self.columns).limit(0)
        return self._of(ranges).filter((F.col("_idx") >= start) & (F.col("_idx") < stop)).select(*self.columns)

    def at(self, positions) -> DataFrame:
        """Rows at the given positions, each once, with ``_idx``."""
        wanted = sorted(set(positions))
        ranges = [r for r in self.starts if bisect.bisect_left(wanted, r[1]) < bisect.bisect_left(wanted, r[2])]
        if not ranges:
            return self.stored.select(*self.columns, F.lit(0).cast("long").alias("_idx")).limit(0)
        rows = local_rows(self.stored.sparkSession, [(p,) for p in wanted], "_idx long")
        return self._of(ranges).join(rows, "_idx").select(*self.columns, "_idx")


def positions_between(df: DataFrame, order_by, start: int, stop: int) -> DataFrame:
    """Rows at positions ``[start, stop)`` of the global order; several slices of one table share a ``StoredOrder``."""
    return StoredOrder(df, order_by).between(start, stop)


def _rank_rows(batches):
    """Rows of one range in the order (_c, _v, _row): each with the place and size of its run of ties.

    Only the run that is open is held, as row numbers.
    """
    held, done, start, last_c, prior = [], 0, 0, None, 0

    def bits(values) -> np.ndarray:
        out = values + 0.0
        out[np.isnan(out)] = np.nan
        return out.view(np.int64)

    def emit(c, v, rows, ends):
        """Closed runs; ``ends`` says whether the column ends behind the last of them."""
        nonlocal done, start, last_c
        b = bits(v)
        first = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (b[1:] != b[:-1])])
        size = np.diff(np.r_[first, len(c)])
        own = c[first]
        opens = np.r_[own[0] != last_c, own[1:] != own[:-1]]
        closes = np.r_[opens[1:], ends]
        at = done + first
        begins = np.maximum.accumulate(np.where(opens, at, start))
        start, done, last_c = int(begins[-1]), done + len(c), int(own[-1])
        edge = opens.astype(np.int32) + 2 * closes.astype(np.int32)
        spread = lambda x: np.repeat(x, size)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(c), pa.array(spread(at - begins)), pa.array(spread(size)), pa.array(spread(edge)), pa.array(v, mask=spread(edge == 0))],
            names=["_row", "_c", "_first", "_n", "_edge", "_v"])

    def taken(upto=None):
        c, v, rows = (np.concatenate(x) for x in zip(*held))
        return (c, v, rows) if upto is None else (c[:upto], v[:upto], rows[:upto])

    for batch in batches:
        if not batch.num_rows:
            continue
        c, v, rows = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in range(3))
        b = bits(v)
        if held and c[0] == c[-1] == held[-1][0][-1] and b[0] == b[-1] == bits(held[-1][1][-1:])[0]:
            held.append((c, v, rows))
            continue
        held.append((c, v, rows))
        c, v, rows = taken()
        b = bits(v)
        cut = int(np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (b[1:] != b[:-1])])[-1])
        if cut:
            yield emit(c[:cut], v[:cut], rows[:cut], c[cut] != c[cut - 1])
        held = [(c[cut:], v[cut:], rows[cut:])]
    if held:
        yield emit(*taken(), True)


def _tie_starts(parts) -> list[tuple]:
    """Per (partition, column): rows of the column before it, and the global start and size of the ties at its ends.

    ``parts`` has (partition, column, rows, first value, its rows, last value, its rows); a run of equal values may cover many partitions.
    """
    out, offsets, runs = [], {}, {}
    parts = sorted(parts, key=lambda p: (p[1], p[0]))
    key = lambda c, v: (c, "nan" if v != v else v)
    for pid, c, n, fv, fn, lv, ln in parts:
        off = offsets.get(c, 0)
        for v, size, at in [(fv, fn, off)] + ([(lv, ln, off + n - ln)] if key(c, lv) != key(c, fv) else []):
            begin, total = runs.get(key(c, v), (at, 0))
            runs[key(c, v)] = (begin, total + size)
        offsets[c] = off + n
        out.append((pid, c, off, fv, lv))
    return [(pid, c, off, *runs[key(c, fv)], *runs[key(c, lv)]) for pid, c, off, fv, lv in out]


def average_ranks(df: DataFrame, values: dict, row: str | None = None) -> DataFrame:
    """One row per row of ``df``: for each ``{name: column}`` its average 1-based rank, missing where the value is, and ``_row``,
    the row's number, which may be given as a unique bigint column of a stored table.

    All columns go through one global order of (column, value, row), in which a row finds its rank in place: ties share their
    mean rank, ties over several partitions by counts handed on. One shuffle in, one back by row, whatever the number of
    columns. Rows without any value are left out.
    """
    names = list(values)
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    stored = df.select(number.alias("_row"), *[col(c).cast("double").alias(f"_{i}") for i, c in enumerate(values.values())])
    if row is None:
        stored = materialize(stored, "rank-values")
    entries = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(f"_{i}").alias("_v")) for i in range(len(names))])
    cells = stored.select("_row", F.inline(entries)).filter("_v IS NOT NULL").select("_c", "_v", "_row")
    ranged = cells.repartitionByRange("_c", "_v", "_row").sortWithinPartitions("_c", "_v", "_row")
    placed = ranged.mapInArrow(_rank_rows, "_row long, _c int, _first long, _n long, _edge int, _v double").withColumn("_pid", F.spark_partition_id())
    placed = materialize(placed, "rank-places")
    end = lambda bit, what: F.max(F.when(F.col("_edge").bitwiseAND(F.lit(bit)) > 0, F.col(what)))
    parts = placed.groupBy("_pid", "_c").agg(F.count("*"), end(1, "_v"), end(1, "_n"), end(2, "_v"), end(2, "_n")).collect()
    starts = local_rows(df.sparkSession, _tie_starts([tuple(r) for r in parts]),
                        "_pid int, _c int, _off long, _fs long, _ft long, _ls long, _lt long")
    rank = F.when(F.col("_edge").bitwiseAND(F.lit(1)) > 0, F.col("_fs") + (F.col("_ft") + 1) / 2).when(
        F.col("_edge") > 0, F.col("_ls") + (F.col("_lt") + 1) / 2).otherwise(F.col("_off") + F.col("_first") + (F.col("_n") + 1) / 2)
    ranks = placed.join(starts, ["_pid", "_c"]).select("_row", "_c", rank.alias("_rank"))
    return ranks.groupBy("_row").agg(*[F.max(F.when(F.col("_c") == i, F.col("_rank"))).alias(n) for i, n in enumerate(names)])


def with_average_ranks(df: DataFrame, columns, names) -> DataFrame:
    """Add the average rank of each column; a missing value has no rank."""
    held = materialize(df.withColumn("_key", F.monotonically_increasing_id()), "ranked-rows")
    ranks = average_ranks(held, dict(zip(names, columns)), "_key").withColumnRenamed("_row", "_key")
    return held.join(ranks, "_key", "left").drop("_key")
