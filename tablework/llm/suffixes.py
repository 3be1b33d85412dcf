"""Suffix-array dedup: every byte of a ``WINDOW``-byte string that starts at two places anywhere is removed.

Only the first ``WINDOW`` bytes of a suffix matter, and a suffix can only have a twin where its anchor has one: the
place of the smallest hash among the ``ANCHOR``-byte runs of these bytes (winnowing), which equal strings have at the same distance.
So neighbouring suffixes that share an anchor travel together, as a segment, and read their leading tokens from the anchor on.

1. One pass over the texts gives the segments (anchor hash, fingerprint of all bytes, place), some 150 suffixes a row.
   Anchors that occur once are dropped after a count.
2. A segment whose bytes occur twice as a whole is repeated in full; no suffix of it has to be sorted for that.
3. Of anchors with different segments, one copy of each segment is fetched with its bytes.
4. An anchor of more than ``BUCKET_ROWS`` segments is lengthened. Its segments are halved by the distance of the anchor: all suffixes
   near to it hold more bytes after it, all far ones more bytes before it, and these join the anchor. Equal strings have one
   distance and equal bytes, so they stay together. Halves equal as a whole are merged, halves alone with their anchor leave, and what
   is still over ``BUCKET_ROWS`` is halved again, until in the end the anchor is the whole string.
5. Splitters sampled by Spark deal the segments to ranges of (leading bytes at the anchor, anchor). A range is read in buckets of whole
   anchors, about ``BUCKET_ROWS`` segments each. Their suffixes are sorted by a multikey quicksort, one character
   after the other, only ties going on to the next: first anchor and distance, then blocks of bytes. Suffixes still tied after
   ``WINDOW`` bytes are repeated.
6. Covered bytes are cut out of the texts.

Places are kept per distinct text (128-bit fingerprint), as what is removed depends on the text alone. Bytes are compared
by 64-bit hashes, within one anchor. Lists that join back to the texts are broadcast below a counted size and joined by key above.

A null text has no bytes. Ids do not matter: rows that repeat an id or a whole row are further places, and null ids are like others.
A text below ``WINDOW`` bytes stays. An empty table gives no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm import common

WINDOW = 400
ANCHOR = 120
BUCKET_ROWS = 4_000
_DEPTH = 8
_CHUNK = 1 << 16
_PLACE_BITS = 18
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_LEAD = 16
_EMIT_ROWS = 20_000
_BROADCAST_BYTES = 32_000_000

_SEGMENT = "h long, s long, f1 long, f2 long, start long, n int, rel int"
_FETCHED = "lead binary, h long, s long, c long, f1 long, f2 long, start long, n int, rel int, octets binary"
_FETCHED_NAMES = [column.split()[0] for column in _FETCHED.split(", ")]
_FETCHED_KINDS = [pa.binary(), *[pa.int64()] * 6, pa.int32(), pa.int32(), pa.binary()]
_FOUND = "f1 long, f2 long, first long, last long"


class Rolling:
    """Hashes of byte runs from running totals: a polynomial modulo 2**64 over hashed bytes."""

    def __init__(self, size: int):
        self.size = size
        self.value = common.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(common._ODD))
        falling, rising = (np.full(size + 1, b, np.uint64) for b in (common._INVERSE, common._ODD))
        falling[0] = rising[0] = 1
        self.falling, self.rising = np.cumprod(falling), np.cumprod(rising)

    def totals(self, octets: np.ndarray) -> np.ndarray:
        out = np.zeros(len(octets) + 1, np.uint64)
        np.cumsum(self.value[octets] * self.falling[:len(octets)], out=out[1:])
        return out

    def runs(self, totals: np.ndarray, length: int) -> np.ndarray:
        """Hash of every run of ``length`` bytes."""
        return common.mix((totals[length:] - totals[:-length]) * self.rising[:len(totals) - length])

    def pieces(self, totals: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the bytes ``[first, stop)``, length included."""
        return common.mix((totals[stop] - totals[first]) * self.rising[first] + (stop - first).astype(np.uint64))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks both ways."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1:width - 1 + count])


def segments(raw: bytes, rolling: Rolling, window: int, anchor: int):
    """Yield (anchor hash, fingerprint, start, suffixes, distance of the anchor from the start) arrays of a text, a chunk at a time."""
    octets = np.frombuffer(raw, np.uint8)
    for at in range(0, len(octets) - window + 1, _CHUNK):
        part = octets[at:at + _CHUNK + window - 1]
        totals = rolling.totals(part)
        grams = rolling.runs(totals, anchor)
        least = sliding_least((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), window - anchor + 1)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        stop = np.r_[first[1:], len(least)]
        yield ((least[first] >> np.uint64(_PLACE_BITS)).view(np.int64), rolling.pieces(totals, first, stop + window - 1).view(np.int64),
               first + at, (stop - first).astype(np.int32), ((least[first] & _PLACE).astype(np.int64) - first).astype(np.int32))


def _segment_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def cut(batches):
        rolling = Rolling(_CHUNK + window)

        def flushed(held):
            columns = [np.concatenate(c) for c in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["f1", "f2", "h", "s", "start", "n", "rel"]).select(
                ["h", "s", "f1", "f2", "start", "n", "rel"])

        for batch in batches:
            held, size = [], 0
            for f1, f2, raw in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), common.raw_texts(batch.column(2))):
                for part in segments(raw, rolling, window, anchor):
                    rows = len(part[0])
                    held.append((np.full(rows, f1, np.int64), np.full(rows, f2, np.int64), *part))
                    size += rows
                    if size >= _EMIT_ROWS:
                        yield flushed(held)
                        held, size = [], 0
            if held:
                yield flushed(held)

    return docs.select("f1", "f2", "text").mapInArrow(common.lean(cut), _SEGMENT)


def _fetched(docs: DataFrame, wanted: DataFrame, window: int, anchor: int) -> DataFrame:
    """The wanted segments with their bytes, read from one document of each text."""
    lists = wanted.groupBy("f1", "f2").agg(F.collect_list(F.struct("h", "s", "c", "start", "n", "rel")).alias("wanted"))
    one = docs.groupBy("f1", "f2").agg(F.min("row").alias("row"))
    places = common.materialize(lists.join(one, ["f1", "f2"]), "wanted")
    lean = docs.select(F.col("f1").alias("_f1"), F.col("f2").alias("_f2"), F.col("row").alias("_row"), "text")
    same = (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")) & (F.col("row") == F.col("_row"))
    near = lean.join(_held(places, F.size("wanted") * 40), same).select("f1", "f2", "wanted", "text")
    lead = min(_LEAD, anchor)  # the same for all of an anchor

    def cut(batches):
        for batch in batches:
            rows = []
            for i, raw in enumerate(common.raw_texts(batch.column(3))):
                f1, f2 = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for w in batch.column(2)[i].as_py():
                    at = w["start"]
                    octets = raw[at:at + w["n"] + window - 1]
                    rows.append((octets[w["rel"]:w["rel"] + lead], w["h"], w["s"], w["c"], f1, f2, at, w["n"], w["rel"], octets))
                    if len(rows) >= _EMIT_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _FETCHED_KINDS)], names=_FETCHED_NAMES)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _FETCHED_KINDS)], names=_FETCHED_NAMES)

    return near.mapInArrow(common.lean(cut), _FETCHED)


def halves(octets: bytes, n: int, rel: int, low: int, high: int, window: int):
    """Yield (bytes shared by all, first suffix, number of suffixes, least, largest distance) of the suffixes of a segment that lie
    ``low`` to the middle before their anchor, and of those from there to ``high``."""
    middle = (low + high) // 2
    for least, most in ((low, middle), (middle + 1, high)):
        first, stop = max(0, rel - most), min(n, rel - least + 1)
        if first < stop:
            yield octets[rel - least:rel + window - most], first, stop - first, least, most


def _halved(rows: DataFrame, window: int) -> DataFrame:
    """Each segment as up to two, with longer anchors."""
    names, kinds = [*_FETCHED_NAMES, "low", "high"], [*_FETCHED_KINDS, pa.int32(), pa.int32()]

    def digest(octets, seed=0):
        return int.from_bytes(xxhash.xxh3_64_digest(octets, seed), "big", signed=True)

    def cut(batches):
        for batch in batches:
            out = []
            for lead, _, _, c, f1, f2, start, n, rel, octets, low, high in zip(*(column.to_pylist() for column in batch.columns)):
                for shared, first, count, least, most in halves(octets, n, rel, low, high, window):
                    own = octets[first:first + count + window - 1]
                    seed = least * (window + 1) + most
                    out.append((lead, digest(shared, seed), digest(own), c, f1, f2, start + first, count, rel - first, own, least, most))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.select(*names).mapInArrow(common.lean(cut), f"{_FETCHED}, low int, high int")


def _lengthened(fetched: DataFrame, hot: DataFrame, window: int, anchor: int) -> tuple[DataFrame, list[DataFrame]]:
    """Segments of anchors that have at most ``BUCKET_ROWS`` of them, and the byte ranges found on the way; ``hot`` has the other anchors."""
    calm, found = [], []
    rows = fetched.withColumn("low", F.lit(0)).withColumn("high", F.lit(window - anchor))
    while not hot.isEmpty():
        calm.append(rows.join(F.broadcast(hot), "h", "left_anti"))
        parts = common.settle(_halved(rows.join(F.broadcast(hot), "h", "left_semi"), window), "halves")
        rep = F.struct("f1", "f2", "start", "n", "rel", "lead", "octets", "low", "high")
        kinds = parts.groupBy("h", "s").agg(F.sum("c").alias("c"), F.count("*").alias("places"), F.min(rep).alias("rep"))
        kinds = common.settle(kinds.select("h", "s", "c", "places", "rep.*"), "half-kinds")
        found.append(_whole(parts.filter("c = 1").join(kinds.filter("places > 1").select("h", "s"), ["h", "s"]), window))  # others are known
        sizes = common.materialize(kinds.groupBy("h").agg(F.count("*").alias("size")).filter("size > 1"), "half-sizes")
        rows = kinds.join(_held(sizes.select("h"), F.lit(8)), "h", "left_semi")
        hot = sizes.filter(F.col("size") > BUCKET_ROWS).select("h")
    return functools.reduce(DataFrame.union, [part.select(*_FETCHED_NAMES) for part in [*calm, rows]]), found


def _whole(rows: DataFrame, window: int) -> DataFrame:
    """All bytes of segments as ranges."""
    return rows.select("f1", "f2", F.col("start").alias("first"), (F.col("start") + F.col("n") + (window - 1)).alias("last"))


def _held(df: DataFrame, octets) -> DataFrame:
    """Marked for broadcast if its rows are small, all together."""
    return F.broadcast(df) if (df.agg(F.sum(octets) + 32 * F.count("*")).first()[0] or 0) <= _BROADCAST_BYTES else df


def multikey_ties(labels: np.ndarray, character, depth: int) -> np.ndarray:
    """Indices whose label and first ``depth`` characters another index shares.

    All groups of ties are sorted by their next character at once; single ones drop out.
    ``character(indices, k)`` gives the k-th characters.
    """
    live = np.arange(len(labels))
    keys = common.mix(labels.astype(np.uint64))
    for k in range(-1, depth):
        if k >= 0:
            keys = common.mix(keys + character(live, k))
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        tied = ~(new & np.r_[new[1:], True])
        live, keys = live[order[tied]], ordered[tied]
        if not len(live):
            break
    return live


class Bucket:
    """Segments of one bucket and the suffixes that start in them."""

    def __init__(self, batch: pa.RecordBatch, window: int):
        self.window = window
        self.h, self.s, self.c, self.f1, self.f2, self.start = (batch.column(i).to_numpy() for i in range(1, 7))
        self.n = batch.column(7).to_numpy().astype(np.int64)
        rel = batch.column(8).to_numpy().astype(np.int64)
        octets = np.frombuffer(b"".join(batch.column(9).to_pylist()), np.uint8)
        offsets = np.r_[0, np.cumsum(self.n + window - 1)][:-1]
        self.row = np.repeat(np.arange(len(self.n)), self.n)
        self.step = np.arange(len(self.row)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        self.at = offsets[self.row] + self.step
        self.distance = rel[self.row] - self.step
        self.rolling = Rolling(len(octets))
        self.totals = self.rolling.totals(octets)

    def repeated(self) -> np.ndarray:
        """Suffixes (numbers, in order) with a twin in this bucket."""
        group = np.cumsum(np.r_[0, self.h[1:] != self.h[:-1]])
        size = -(-self.window // _DEPTH)
        blocks = self.rolling.runs(self.totals, size)
        last = self.window - size
        return np.sort(multikey_ties(group[self.row] * (self.window + 1) + self.distance,
                                     lambda live, k: blocks[self.at[live] + min(k * size, last)], _DEPTH))

    def covered(self) -> pa.RecordBatch:
        """Byte ranges that repeated suffixes cover, of segments that occur once."""
        found = self.repeated()
        found = found[self.c[self.row[found]] == 1]
        row, step = self.row[found], self.step[found]
        new = np.r_[True, (row[1:] != row[:-1]) | (step[1:] - step[:-1] > self.window)] if len(found) else np.empty(0, bool)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(found)][:len(first)] - 1
        of = row[first]
        places = (self.f1[of], self.f2[of], self.start[of] + step[first], self.start[of] + step[last] + self.window)
        return pa.RecordBatch.from_arrays([*map(pa.array, places)], names=["f1", "f2", "first", "last"])


def _buckets(batches):
    """The rows of a range in record batches of whole anchors, about ``BUCKET_ROWS`` each; every segment once."""

    def joined(held):
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    held, size, before = [], 0, (None, None)
    for batch in batches:
        h, s = (batch.column(i).to_numpy() for i in (1, 2))
        if not len(h):
            continue
        new = np.r_[(h[0], s[0]) != before, (h[1:] != h[:-1]) | (s[1:] != s[:-1])]
        begins = np.r_[h[0] != before[0], h[1:] != h[:-1]]
        before = h[-1], s[-1]
        at = 0
        for cut in [*np.flatnonzero(begins).tolist(), len(h)]:
            if cut > at:
                piece = batch.slice(at, cut - at).filter(pa.array(new[at:cut]))
                held.append(piece)
                size += piece.num_rows
                at = cut
            if size >= BUCKET_ROWS and cut < len(h):
                yield joined(held)
                held, size = [], 0
    if size:
        yield joined(held)


def repeated_runs(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(f1, f2, runs): the maximal removed byte ranges of each text; ``docs`` has f1, f2 (hashes of the text), row and text."""
    long = docs.filter(F.octet_length("text") >= window)
    every = common.materialize(_segment_rows(long, window, anchor), "segments")
    twice = every.groupBy("h").agg(F.count("*").alias("c"), F.min("s").alias("low"), F.max("s").alias("high")).filter("c > 1")
    twice = common.settle(twice.select("h", (F.col("low") < F.col("high")).alias("mixed")), "anchors")
    shared = common.settle(every.join(twice, "h"), "shared")
    kinds = common.settle(
        shared.groupBy("h", "s", "mixed").agg(F.count("*").alias("c"), F.min(F.struct("f1", "f2", "start", "n", "rel")).alias("rep")), "kinds")
    whole = _whole(shared.join(kinds.filter("c > 1").select("h", "s"), ["h", "s"]), window)

    mixed = kinds.filter("mixed").select("h", "s", "c", "rep.*")
    hot = mixed.groupBy("h").agg(F.count("*").alias("size")).filter(F.col("size") > BUCKET_ROWS).select("h")
    fetched = common.settle(_fetched(long, mixed, window, anchor), "fetched")
    rows, on_the_way = _lengthened(fetched, common.materialize(hot, "hot-anchors"), window, anchor)
    ranges = max(common.partitions(docs.sparkSession), -(-rows.count() // BUCKET_ROWS))
    ordered = rows.repartitionByRange(ranges, "lead", "h").sortWithinPartitions("lead", "h", "s")

    def sort(batches):
        for held in _buckets(batches):
            yield Bucket(held, window).covered()

    found = common.settle(ordered.mapInArrow(common.lean(sort), _FOUND), "found")
    every_run = functools.reduce(DataFrame.union, [whole, found, *on_the_way])
    lists = every_run.groupBy("f1", "f2").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def merge(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                merged = []
                for runs in part.column(2):
                    out = []
                    for r in sorted((r["first"], r["last"]) for r in runs.as_py()):
                        if out and r[0] <= out[-1][1]:
                            out[-1] = (out[-1][0], max(out[-1][1], r[1]))
                        else:
                            out.append(r)
                    merged.append([{"first": a, "last": b} for a, b in out])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(merged, kind)], names=["f1", "f2", "runs"])

    return common.settle(lists.mapInArrow(common.lean(merge), "f1 long, f2 long, runs array<struct<first:long,last:long>>"), "runs")


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): every row with the bytes that are left, as binary."""
    value = F.col(f"`{text}`")
    named = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(value).alias("f1"), F.xxhash64(F.lit(7), value).alias("f2"), value.alias("text"))
    runs = repeated_runs(named.withColumn("row", F.coalesce("id", F.lit(0).cast("long"))), window, anchor)
    runs = _held(runs, F.size("runs") * 16).select(F.col("f1").alias("_f1"), F.col("f2").alias("_f2"), "runs")
    rows = named.join(runs, (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")), "left").select("id", "text", "runs")

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [[], [], [], []]
                for raw, runs in zip(common.raw_texts(part.column(1)), part.column(2)):
                    raw, runs = raw or b"", runs.as_py() or []
                    left, to = [], 0
                    for r in runs:
                        left.append(raw[to:r["first"]])
                        to = r["last"]
                    left = b"".join([*left, raw[to:]])
                    for column, value in zip(out, (len(raw), len(raw) - len(left), len(runs), left)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(common.lean(cut), "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op12_repeated_bytes(spark, sf_dir):
    """One row per document: bytes, removed bytes and runs, and a digest of what is left."""
    left = remove_repeated_bytes(common.table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
