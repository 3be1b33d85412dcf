"""Ranked lexical search by length buckets of impact vectors.

A document is a vector of integer impacts, one for each query term it has; an item is a vector of integer term
weights times their repeats; the score is their inner product, so the largest inner products are wanted.

1. One pass over the texts counts each document's terms and stores, as pairs of term number and count, those that
   some item has. The texts are not read again; no other coordinate can add to a score.
2. Document number, total length and document frequencies are summed from these rows over the whole corpus.
3. Impact vectors are written by falling length (Euclidean norm), each file in order, so a norm filter skips blocks.
4. The longest vectors (``HEAD`` of all, by an approximate quantile) are searched first. What they reach gives each item a
   threshold that every task of the second search starts from: its best 10 are never below it.
5. A task takes its vectors in buckets of ``BUCKET`` by falling length. By Cauchy-Schwarz an item skips a bucket, and all
   after it, once the item's norm times the bucket's longest vector is below its threshold; inside, rows are cut likewise.
   Then coordinate bounds: over the item's heaviest terms the products are added from postings, the rest is at most
   the product of what is left of both norms. Rows whose bound reaches the threshold are rescored in integers.
6. Every task hands on at most 10 rows an item; a window ranks them.

Bounds are doubles with a slack far above their rounding, scores are exact. Items are taken in blocks of about ``BLOCK_BYTES`` of
text, so that what goes with the tasks is bounded whatever the number of items; each block reads the texts once.

A null or empty text has no terms and no row in a result. A document with a null id counts in all statistics and is not
returned, as a result could not name it. Rows that repeat an id, of items or documents, are taken each for itself.
An empty table gives no rows. Only ids and texts are read, so other columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm import common
from tablework.operators.order import local_rows

#: Fixed value: the terms of a text, in which only A-Z are lowered.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Lowers A-Z and turns every ASCII byte that is no letter or digit into a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
TOP = 10
HEAD = 0.02
BUCKET = 2048
BLOCK_BYTES = 4_000_000
_FOCUS = 0.9
_ROWS = 1024
_PAIR = np.dtype([("term", "<u4"), ("value", "<u4")])


def terms_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_FOLD).split() if raw else []


class Items:
    """A block of items: ids, term numbers, and per item its terms with their repeats."""

    def __init__(self, rows: list[tuple[int | None, bytes | None]]):
        self.ids, self.vocabulary, self.parts = [r[0] for r in rows], {}, []
        for _, raw in rows:
            own: dict[int, int] = {}
            for t in terms_of(raw):
                k = self.vocabulary.setdefault(t, len(self.vocabulary))
                own[k] = own.get(k, 0) + 1
            self.parts.append(own)

    def weigh(self, n_docs: int, df: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per item its term numbers and integer weights, heaviest first; terms without weight are left out."""
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df]
        out = []
        for own in self.parts:
            pairs = sorted(((weight[t] * n, t) for t, n in own.items() if weight[t] > 0 and df[t] > 0), reverse=True)
            out.append((np.array([t for _, t in pairs], np.int64), np.array([w for w, _ in pairs], np.int64)))
        return out


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, pairs): all terms of a text counted, those of the vocabulary listed with their counts."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def count(batches):
        find = vocabulary.get
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                sizes, packed = [], []
                for raw in common.raw_texts(part.column(1)):
                    terms = terms_of(raw)
                    known = np.fromiter(map(find, terms, (-1,) * len(terms)), np.int64, len(terms))
                    term, times = np.unique(known[known >= 0], return_counts=True)
                    pairs = np.empty(len(term), _PAIR)
                    pairs["term"], pairs["value"] = term, times
                    sizes.append(len(terms))
                    packed.append(pairs.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], names=["id", "n", "pairs"])

    return rows.mapInArrow(count, "id long, n long, pairs binary")


def unpacked(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a column, and where each row's begin (one more entry for the end)."""
    raw = array.to_pylist()
    return np.frombuffer(b"".join(raw), _PAIR), np.r_[0, np.cumsum([len(r) // _PAIR.itemsize for r in raw])].astype(np.int64)


def document_frequencies(counts: DataFrame, terms: int) -> np.ndarray:
    def add(batches):
        sums = np.zeros(terms, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                pairs, _ = unpacked(batch.column(0).slice(at, _ROWS))
                sums += np.bincount(pairs["term"], minlength=terms)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], names=["term", "df"])

    out = np.zeros(terms, np.int64)
    for row in counts.select("pairs").mapInArrow(add, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def impact_vectors(counts: DataFrame, n_docs: int, length: int) -> DataFrame:
    """(id, norm, pairs) of the documents that have a query term, in each partition by falling norm."""

    def weigh(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                pairs, starts = unpacked(part.column(2))
                m = 25 + (75 * part.column(1).to_numpy() * n_docs) // length
                tf = pairs["value"].astype(np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(starts)))
                out = pairs.copy()
                out["value"] = impact
                total = np.r_[0.0, np.cumsum(impact.astype(np.float64) ** 2)]
                raw = out.tobytes()
                cut = (starts * _PAIR.itemsize).tolist()
                # differences of a running total are rounded; the norm is taken a little too long
                norm = np.sqrt((total[starts[1:]] - total[starts[:-1]]) + total[-1] * 1e-14)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(norm), pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary())], names=["id", "norm", "pairs"])

    known = counts.filter((F.octet_length("pairs") > 0) & F.col("id").isNotNull())
    return known.mapInArrow(weigh, "id long, norm double, pairs binary").sortWithinPartitions(F.col("norm").desc())


class Probe:
    """Best documents of each item among the vectors seen; vectors come in buckets by falling norm."""

    def __init__(self, weights, terms: int, least: np.ndarray, top: int):
        self.weights, self.least, self.top = weights, least.astype(np.float64), top
        self.norm = np.array([math.sqrt(float((w.astype(np.float64) ** 2).sum())) for _, w in weights])
        self.dense = np.zeros(terms, np.int64)
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(weights)
        self.bounded = self.scored = 0
        self.focus = []
        for _, w in weights:
            share = np.cumsum(w.astype(np.float64) ** 2)
            k = int(np.searchsorted(share, _FOCUS * share[-1])) + 1 if len(w) else 0
            left = max(0.0, float(share[-1] - share[k - 1])) if len(w) else 0.0
            self.focus.append((k, math.sqrt(left) * (1 + 1e-9)))

    def add(self, ids: np.ndarray, norms: np.ndarray, pairs: np.ndarray, starts: np.ndarray) -> None:
        goal = np.maximum(self.least, 1.0)
        open_ = np.flatnonzero(self.norm * norms[0] * (1 + 1e-9) >= goal)  # Cauchy-Schwarz on the whole bucket
        if not len(open_):
            return
        row = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.argsort(pairs["term"], kind="stable")
        term, row, value = pairs["term"][order], row[order], pairs["value"][order].astype(np.float64)
        for q in open_:
            terms, weight = self.weights[q]
            k, rest = self.focus[q]
            rows = int(np.searchsorted(-norms, -goal[q] / (self.norm[q] * (1 + 1e-9)), side="right"))
            part, square = np.zeros(rows), np.zeros(rows)
            first, last = np.searchsorted(term, terms[:k]), np.searchsorted(term, terms[:k], side="right")
            for a, b, w in zip(first, last, weight[:k]):
                r, v = row[a:b], value[a:b]
                if rows < len(ids):
                    b = np.searchsorted(r, rows)
                    r, v = r[:b], v[:b]
                part[r] += w * v
                square[r] += v * v
            left = np.sqrt(np.maximum(norms[:rows] ** 2 * (1 + 1e-9) - square, 0.0))
            alive = np.flatnonzero((part + rest * left) * (1 + 1e-9) >= goal[q])
            self.bounded += rows
            if len(alive):
                self._rescore(q, ids, pairs, starts, alive)

    def _rescore(self, q: int, ids, pairs, starts, alive) -> None:
        terms, weight = self.weights[q]
        self.dense[terms] = weight
        sizes = starts[alive + 1] - starts[alive]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts[alive] - (ends - sizes), sizes)
        total = np.r_[0, np.cumsum(self.dense[pairs["term"][at]] * pairs["value"][at].astype(np.int64))]
        score = total[ends] - total[ends - sizes]
        self.dense[terms] = 0
        self.scored += len(alive)
        good = (score > 0) & (score >= self.least[q])
        had = self.best[q]
        score, key = np.r_[had[0], score[good]], np.r_[had[1], ids[alive][good]]
        first = np.lexsort((key, -score))[: self.top]
        self.best[q] = score[first], key[first]
        if len(first) == self.top:
            self.least[q] = max(self.least[q], float(score[first[-1]]))


def best_rows(vectors: DataFrame, weights, terms: int, least: np.ndarray, top: int) -> DataFrame:
    """(item, id, score): what each task found best, at most ``top`` rows an item."""

    def probe(batches):
        found = Probe(weights, terms, least, top)
        for batch in batches:
            ids, norms = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, batch.num_rows, BUCKET):
                pairs, starts = unpacked(batch.column(2).slice(at, BUCKET))
                found.add(ids[at:at + BUCKET], norms[at:at + BUCKET], pairs, starts)
        sizes = [len(s) for s, _ in found.best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int64()),
             *[pa.array(np.concatenate([b[i] for b in found.best] or [[]]).astype(np.int64)) for i in (1, 0)]], names=["item", "id", "score"])

    return vectors.sortWithinPartitions(F.col("norm").desc()).mapInArrow(probe, "item long, id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: Items, top: int, key: str, text: str) -> DataFrame:
    spark, terms = docs.sparkSession, len(items.vocabulary)
    counts = common.materialize(term_counts(docs, items.vocabulary, key, text), "term-counts")
    n_docs, length = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    weights = items.weigh(n_docs, document_frequencies(counts, terms))
    vectors = common.materialize(impact_vectors(counts, n_docs, max(1, length or 0)), "impacts")
    cut = vectors.agg(F.percentile_approx("norm", 1 - HEAD, 1000)).first()[0] or 0.0
    none = np.zeros(len(weights), np.int64)
    head = common.materialize(_ranked(best_rows(vectors.filter(F.col("norm") >= cut), weights, terms, none, top), top), "head")
    least = none.copy()
    for row in head.filter(F.col("rank") == top).collect():
        least[row["item"]] = row["score"]
    tail = best_rows(vectors.filter(F.col("norm") < cut), weights, terms, least, top)
    names = local_rows(spark, list(enumerate(items.ids)), "item long, item_id long")
    ranked = _ranked(head.select("item", "id", "score").union(tail), top)
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, id, score): the ``top`` documents of every item with a score above 0, highest first, ties to the smaller id."""
    asked = items.select(F.col(f"`{item_key}`").cast("long").alias("k"), F.col(f"`{item_text}`").cast("binary").alias("t"))
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    out = None
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == block) if blocks > 1 else asked
        rows = sorted(((r["k"], bytes(r["t"])) for r in mine.filter("t IS NOT NULL").collect()), key=lambda r: (r[0] is None, r))
        if rows:
            found = _search_block(docs, Items(rows), top, key, text)
            out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, id long, score long") if out is None else out


def op11_ranked_search(spark, sf_dir):
    """One row per benchmark item and rank: the document and its score."""
    found = search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


OP11_SQL = f"""
WITH low AS (SELECT 0 AS side, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 1, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
own AS (SELECT side, id, w, count(*) AS tf
  FROM (SELECT side, id, unnest(regexp_extract_all(coalesce(t, ''), '{TERM}')) AS w FROM low) GROUP BY ALL),
doc AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM own WHERE side = 0 GROUP BY id),
whole AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM doc),
length AS (SELECT id, 100 - 75 + ((75 * n * nn) // ll) AS m FROM doc, whole),
weight AS (SELECT w, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS x FROM own, whole WHERE side = 0 GROUP BY w, nn),
score AS (SELECT q.id AS item_id, d.id AS doc_id, CAST(sum(q.tf * x * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m))) AS BIGINT) AS score
  FROM own q JOIN own d ON q.side = 1 AND d.side = 0 AND q.w = d.w JOIN weight ON weight.w = q.w JOIN length ON length.id = d.id GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= {TOP}
"""
