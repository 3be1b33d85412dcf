"""Substring dedup: suffix automata of reference shards, through which documents are streamed.

A window is ``WINDOW`` consecutive words. Its owner is the smallest id that has it; every other
document loses the words of its copy.

1. Anchors: of each window the smallest hash among its ``ANCHOR``-word runs (winnowing). Equal windows have
   equal anchors, so a window can repeat only where its anchor occurs in a second document.
   Exact copies leave first: all but the smallest id of equal texts lose every window, which needs no search.
2. Regions: the words around such anchors, as hashes, once per document. All later steps read them
   and not the texts.
3. References: windows that occur in two documents, at their owner, found by a minimum and a
   maximum per window hash, combined before the shuffle. Each repeated window is there once however
   many documents have it, so a passage in a third of all rows costs one reference.
4. Shards: references are dealt to shards of about ``SHARD_WORDS`` words. The tasks of a shard each build its suffix
   automaton, every state with the smallest owner of its occurrences, and stream their documents:
   the matching statistics give, at each word, the longest match ending there; where it reaches the
   threshold, the state of the last ``WINDOW`` words says whether a smaller document has them. A
   document goes only to the shards that hold one of its anchors, a shard's documents are dealt to
   tasks in runs of ``_RUN``.
5. Covered words are cut out of the texts.

Words are compared by 64-bit hashes. Lists that join back to the texts are broadcast below a counted
size and joined by key above it. Intermediate tables lie in the shared folder.

A null text has no words. A null id is larger than none and smaller than none: nothing is removed
there and it is no reference. Rows that repeat an id never count against each other. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm import common

WINDOW = 50
ANCHOR = 20
SHARD_WORDS = 40_000
_RUN = 256
_PIECE_WORDS = 4_000
_CHUNK = 1 << 16
_BROADCAST_BYTES = 32_000_000
_EMIT_ROWS = 50_000

_MET = ["shard", "run", "kind", "id", "f", "start", "words"]
_REGION = "id long, f long, start long, words binary"


def anchors(hashes: np.ndarray, window: int = WINDOW, run: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the winnowed runs of a text; none if it has no whole window."""
    if len(hashes) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams, width = common.gram_hashes(hashes, run), window - run + 1
    picked = []
    for at in range(0, len(grams) - width + 1, _CHUNK):
        part = np.lib.stride_tricks.sliding_window_view(grams[at:at + _CHUNK + width - 1], width)
        chosen = part.argmin(axis=1) + np.arange(at, at + len(part))
        picked.append(chosen[np.r_[True, chosen[1:] != chosen[:-1]]])
    places = np.unique(np.concatenate(picked))
    return places, grams[places]


def joined_runs(starts: np.ndarray, length: int, total: int) -> list[tuple[int, int]]:
    """Ranges covered by [start, start + length), cut at ``total``; ``starts`` is sorted."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.r_[True, np.diff(starts) > length])
    last = np.r_[new[1:] - 1, len(starts) - 1]
    return [(int(s), int(min(e + length, total))) for s, e in zip(starts[new], starts[last])]


class Automaton:
    """Suffix automaton of word sequences, every state with the smallest owner of its occurrences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]
        self.last, self.pieces = 0, 0

    def add(self, words: list[int], owner: int) -> None:
        for w in words:
            self._extend(w, owner)
        self.pieces += 1
        self._extend(-self.pieces, owner)  # occurs once, so no match runs over the end of a piece

    def _extend(self, w: int, owner: int) -> None:
        nexts, link, length = self.next, self.link, self.length
        new = len(length)
        length.append(length[self.last] + 1)
        link.append(0)
        nexts.append({})
        self.owner.append(owner)
        p = self.last
        while p != -1 and w not in nexts[p]:
            nexts[p][w] = new
            p = link[p]
        if p != -1:
            q = nexts[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                nexts.append(dict(nexts[q]))
                self.owner.append(self.owner[q])
                while p != -1 and nexts[p].get(w) == q:
                    nexts[p][w] = clone
                    p = link[p]
                link[q] = link[new] = clone
        self.last = new

    def close(self) -> None:
        """Hand owners up the suffix links, longest states first."""
        for v in np.argsort(-np.array(self.length), kind="stable")[:-1].tolist():
            up = self.link[v]
            if self.owner[up] is None or self.owner[v] < self.owner[up]:
                self.owner[up] = self.owner[v]

    def window_ends(self, words: list[int], window: int, below: int) -> list[int]:
        """Ends (inclusive) of the windows that an owner smaller than ``below`` has."""
        nexts, link, length, owner = self.next, self.link, self.length, self.owner
        state = matched = 0
        found = []
        for i, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                matched = length[state]
            to = nexts[state].get(w)
            if to is None:
                continue
            state = to
            matched += 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                if owner[state] < below:
                    found.append(i)
        return found


def _gathered(parts, names):
    """Record batches of about ``_EMIT_ROWS`` rows from tuples of equally long arrays."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= _EMIT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)
            held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)


def _anchor_rows(docs: DataFrame, window: int, run: int) -> DataFrame:
    def parts(batches):
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), common.raw_texts(batch.column(1))):
                p, h = anchors(common.hash_words(common.words_of(raw)), window, run)
                yield np.full(len(p), key, np.int64), p.astype(np.int64), h.view(np.int64)

    def find(batches):
        yield from _gathered(parts(batches), ["id", "place", "h"])

    return docs.select("id", "text").mapInArrow(common.lean(find), "id long, place long, h long")


def _small(df: DataFrame, items) -> DataFrame:
    """Marked for broadcast if all its rows are counted to be small: 8 bytes an item and 32 a row."""
    size = df.agg(F.sum(items) * 8 + F.count("*") * 32).first()[0] or 0
    return F.broadcast(df) if size <= _BROADCAST_BYTES else df


def _regions(docs: DataFrame, places: DataFrame, window: int, run: int) -> DataFrame:
    """Words around the given places, one row for each stretch."""
    per_doc = common.materialize(places.groupBy(F.col("id").alias("_id")).agg(F.collect_set("place").alias("places")), "places")
    near = docs.join(_small(per_doc, F.size("places")), F.col("id") == F.col("_id")).select("id", "f", "text", "places")

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, rows = batch.slice(at, 512), []
                for i, raw in enumerate(common.raw_texts(part.column(2))):
                    hashes = common.hash_words(common.words_of(raw))
                    whole = len(hashes) - window + 1
                    if whole <= 0:
                        continue
                    open_ = np.zeros(whole, bool)
                    for p in part.column(3)[i].as_py():  # windows that hold the run
                        open_[max(0, p + run - window):p + 1] = True
                    for s, e in joined_runs(np.flatnonzero(open_), window, len(hashes)):
                        rows.append((part.column(0)[i].as_py(), part.column(1)[i].as_py(), s, hashes[s:e].tobytes()))
                columns = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["id", "f", "start", "words"])

    return common.settle(near.mapInArrow(common.lean(cut), _REGION), "regions")


def _owned_windows(regions: DataFrame, window: int) -> DataFrame:
    """(id, places): the windows that a second document has, at their owner."""

    def parts(batches):
        for batch in batches:
            for key, start, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                h = common.gram_hashes(np.frombuffer(raw.as_buffer(), np.uint64), window)
                yield h.view(np.int64), np.full(len(h), key, np.int64), np.arange(start, start + len(h))

    def spread(batches):
        yield from _gathered(parts(batches), ["w", "id", "place"])

    rows = regions.mapInArrow(common.lean(spread), "w long, id long, place long")
    best = rows.groupBy("w").agg(F.min("id").alias("id"), F.max("id").alias("other"), F.min_by("place", "id").alias("place")).filter("id < other")
    return common.settle(best.groupBy("id").agg(F.collect_set("place").alias("places")), "owned")


def _references(regions: DataFrame, owned: DataFrame, window: int, run: int) -> DataFrame:
    """(id, words, hashes): stretches of owned windows in pieces of bounded length, with their anchors."""
    both = regions.join(_small(owned.withColumnRenamed("id", "_id"), F.size("places")), F.col("id") == F.col("_id")).select("id", "start", "words", "places")

    def cut(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                key, start = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                words = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                places = np.sort(np.array(batch.column(3)[i].as_py(), np.int64)) - start
                places = places[(places >= 0) & (places <= len(words) - window)]
                for s, e in joined_runs(places, window, len(words)):
                    for at in range(s, e - window + 1, _PIECE_WORDS):
                        piece = words[at:min(e, at + _PIECE_WORDS + window - 1)]
                        rows.append((key, piece.tobytes(), anchors(piece, window, run)[1].view(np.int64).tolist()))
            columns = list(zip(*rows)) or [[], [], []]
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "words", "hashes"])

    return common.materialize(both.mapInArrow(common.lean(cut), "id long, words binary, hashes array<long>"), "references")


def _sharded(references: DataFrame, least: DataFrame) -> DataFrame:
    """References with a shard. Pieces of one family (the first document that has their first anchor) share
    a shard as far as ``SHARD_WORDS`` goes, so that a document meets few shards; a larger family is split by piece,
    as one document can be all of it. Pieces overlap, so every window lies in one of them."""
    pieces = references.withColumn("piece", F.xxhash64("id", "words"))
    first = pieces.select("piece", F.explode("hashes").alias("h")).join(least.select("h", "least"), "h")
    family = first.groupBy("piece").agg(F.min("least").alias("family"))
    known = common.materialize(pieces.join(family, "piece"), "families")
    words = F.octet_length("words") / 8
    total = known.agg(F.sum(words)).first()[0] or 0
    split = known.groupBy("family").agg(F.ceil(F.sum(words) / SHARD_WORDS).alias("split"))
    part = F.xxhash64("family", F.pmod("piece", F.col("split")))
    return common.materialize(
        known.join(split, "family").withColumn("shard", F.pmod(part, F.lit(max(1, round(total / SHARD_WORDS)))).cast("int"))
        .select("id", "words", "hashes", "shard"), "shards")


def _near(met: DataFrame, window: int, run: int) -> DataFrame:
    """Of each region only the windows around the places that its shard knows."""

    def cut(batches):
        for batch in batches:
            rows = []
            shard, runs, ids, fs, starts = (batch.column(i).to_pylist() for i in range(5))
            for i, start in enumerate(starts):
                words = np.frombuffer(batch.column(5)[i].as_buffer(), np.uint64)
                open_ = np.zeros(len(words) - window + 1, bool)
                for p in batch.column(6)[i].as_py():
                    open_[max(0, p - start + run - window):max(0, p - start + 1)] = True
                rows += [(shard[i], runs[i], 1, ids[i], fs[i], start + s, words[s:e].tobytes())
                         for s, e in joined_runs(np.flatnonzero(open_), window, len(words))]
            columns = list(zip(*rows)) or [[]] * 7
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=_MET)

    return met.mapInArrow(common.lean(cut), "shard int, run int, kind int, id long, f long, start long, words binary")


def _stream(met: DataFrame, window: int) -> DataFrame:
    """(id, f, first, last): covered stretches of the documents of each (shard, run)."""

    def match(batches):
        at, automaton, closed = None, None, False
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for shard, run, kind, key, f, start, raw in zip(*columns, batch.column(6)):
                words = np.frombuffer(raw.as_buffer(), np.uint64).tolist()
                if (shard, run) != at:
                    at, automaton, closed = (shard, run), Automaton(), False
                if kind == 0:
                    automaton.add(words, key)
                    continue
                if not closed:
                    automaton.close()
                    closed = True
                ends = np.array(automaton.window_ends(words, window, key), np.int64)
                rows += [(key, f, start + s, start + e) for s, e in joined_runs(ends - window + 1, window, len(words))]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "f", "first", "last"])

    return met.mapInArrow(common.lean(match), "id long, f long, first long, last long")


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = ANCHOR) -> DataFrame:
    """(id, f, spans): word ranges that a document of smaller id has; ``docs`` has id, f (hash of the text) and text."""
    known = docs.filter("id IS NOT NULL AND text IS NOT NULL")
    found = common.materialize(_anchor_rows(known, window, run), "anchors")
    twice = common.settle(found.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most"), "twice")
    shared = common.settle(found.join(twice.select("h", "least"), "h"), "shared-anchors")
    regions = _regions(known, shared.select("id", "place"), window, run)
    references = _references(regions, _owned_windows(regions, window), window, run)

    placed = _sharded(references, twice)
    routes = placed.select(F.explode("hashes").alias("h"), "shard").distinct()
    bounds = regions.select(F.col("id").alias("_id"), "f", "start", (F.col("start") + F.octet_length("words") / 8).alias("stop"))
    inside = (F.col("id") == F.col("_id")) & (F.col("place") >= F.col("start")) & (F.col("place") + run <= F.col("stop"))
    meets = common.materialize(
        shared.filter("id > least").join(routes, "h").join(bounds, inside)
        .groupBy("id", "f", "start", "shard").agg(F.collect_set("place").alias("places")), "routes")
    runs = common.materialize(meets.groupBy("shard").agg(F.ceil(F.count("*") / _RUN).cast("int").alias("runs")), "runs")
    dealt = meets.join(runs, "shard").select(
        "id", "f", "start", "shard", F.pmod(F.xxhash64("id"), F.col("runs")).cast("int").alias("run"), "places")
    queries = _near(regions.join(dealt, ["id", "f", "start"]).select("shard", "run", "id", "f", "start", "words", "places"), window, run)
    sources = placed.join(runs, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.lit(0).alias("kind"), "id",
        F.lit(0).cast("long").alias("f"), F.lit(0).cast("long").alias("start"), "words")
    met = sources.union(queries).repartition("shard", "run").sortWithinPartitions("shard", "run", "kind", "id")
    return common.settle(
        _stream(met, window).groupBy("id", "f").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, run: int = ANCHOR) -> DataFrame:
    """(id, n_words, n_removed, kept): every row with its remaining words joined by one space, as binary."""
    value = F.col(f"`{text}`")
    named = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(value).alias("f"), F.xxhash64(F.lit(7), value).alias("f2"), value.alias("text"))
    classes = named.filter("id IS NOT NULL AND text IS NOT NULL").groupBy("f", "f2").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    copied = common.materialize(classes.filter("least < most").drop("most"), "copied")
    copied = _small(copied, F.lit(3)).withColumnsRenamed({"f": "_cf", "f2": "_cf2"})
    marked = named.join(copied, (F.col("f") == F.col("_cf")) & (F.col("f2") == F.col("_cf2")), "left")
    marked = marked.select("id", "f", "text", F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("copy"))
    spans = repeated_spans(marked.filter("NOT copy").drop("copy"), window, run)
    spans = _small(spans, F.size("spans") * 2).select(F.col("id").alias("_id"), F.col("f").alias("_f"), "spans")
    rows = marked.join(spans, (F.col("id") == F.col("_id")) & (F.col("f") == F.col("_f")), "left").select("id", "text", "spans", "copy")

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, out = batch.slice(at, 512), [[], [], []]
                for raw, spans, copy in zip(common.raw_texts(part.column(1)), part.column(2), part.column(3).to_pylist()):
                    words = common.words_of(raw)
                    keep = np.full(len(words), not copy or len(words) < window)
                    for s in spans.as_py() or ():
                        keep[s["first"]:s["last"]] = False
                    left = words if keep.all() else [words[i] for i in np.flatnonzero(keep)]
                    for column, value in zip(out, (len(words), len(words) - len(left), b" ".join(left))):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                    names=["id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(common.lean(cut), "id long, n_words long, n_removed long, kept binary")


def op7_repeated_spans(spark, sf_dir):
    """One row per document: words, removed words and a digest of what is left."""
    left = remove_repeats(common.table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
r AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY md5(g)) AS least FROM i) WHERE least < doc_id),
c AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM r) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda x: gone IS NULL OR NOT list_contains(gone, x)),
    lambda x: ws[x]), ' '), '')) AS kept_sha256
FROM w LEFT JOIN c USING (doc_id)
"""
