"""Target-distribution importance resampling over hashed word runs.

A text, with A-Z lowered, is cut by an untrained pre-tokeniser of the tokenizers library: a ``Split`` on the word
pattern, which returns the words and their offsets. Pairs of offsets, the start of a word and the end of the word
``n - 1`` later, are the windows whose bytes are features; a feature's bucket is its CRC-32 modulo ``BUCKETS``.

1. One pass over the texts gives each document its bucket histogram (pairs of bucket and count, a few bytes a
   distinct word), written to the shared folder. Texts are not read again.
2. Histograms of all documents and of the target sum to at most ``BUCKETS`` rows each, every task adding up its own
   first. From them come the log gains of the buckets: ``BUCKETS`` integers that go with the tasks.
3. A document's weight is the sum of its gains; a Gumbel draw from a hash of its id is added and the highest
   scores are drawn without replacement. The order is global: ranges of the score, sorted in place.

A null text has no words. A null id has a weight but no draw, is not drawn and not counted. Repeated rows are
drawn each for itself; equal scores go by the smaller id. An empty table gives no rows, an empty target gains
from smoothing alone. Only the id and the text are read, so other columns and their names do not matter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm import common
from tablework.operators.order import ordered_index

#: Fixed value: the words of the lowered text.
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
_ROWS = 1024
_HISTOGRAM = "id long, n_words long, n_features long, hist binary"
_CELL = np.dtype([("bucket", "<u4"), ("count", "<u4")])


def splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(FEATURE_WORD), behavior="removed", invert=True)


def feature_buckets(raw: bytes | None, split, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, list[int]]:
    """Number of words, and the bucket of every run of 1 to ``longest`` words."""
    words = split.pre_tokenize_str(raw.translate(common.A_TO_Z).decode()) if raw else []
    if not words:
        return 0, []
    line = " ".join([w for w, _ in words]).encode()
    if line.isascii():
        sizes = np.array([e - s for _, (s, e) in words])
    else:
        sizes = np.array([len(w.encode()) for w, _ in words])
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes).tolist(), ends.tolist()
    crc = zlib.crc32
    return len(words), [crc(line[s:e]) % buckets for n in range(longest) for s, e in zip(starts, ends[n:])]


def histograms(docs: DataFrame, key: str | None = "doc_id", text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, hist) of every row; ``hist`` holds pairs of bucket and count."""
    rows = docs.select((F.col(f"`{key}`") if key else F.lit(None)).cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def count(batches):
        split = splitter()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                out = [[], [], []]
                for raw in common.raw_texts(part.column(1)):
                    n, found = feature_buckets(raw, split, longest, buckets)
                    bucket, times = np.unique(np.array(found, np.uint32), return_counts=True)
                    cells = np.empty(len(bucket), _CELL)
                    cells["bucket"], cells["count"] = bucket, times
                    for column, value in zip(out, (n, len(found), cells.tobytes())):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                    names=["id", "n_words", "n_features", "hist"])

    return rows.mapInArrow(count, _HISTOGRAM)


def _cells(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All cells of a column of histograms, and how many each row has."""
    raw = array.to_pylist()
    return np.frombuffer(b"".join(raw), _CELL), np.array([len(r) // _CELL.itemsize for r in raw], np.int64)


def totals(hist: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket; a task adds up its rows before anything moves."""

    def add(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                cells, _ = _cells(batch.column(0).slice(at, _ROWS))
                np.add.at(sums, cells["bucket"], cells["count"].astype(np.int64))
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in hist.select("hist").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target share to source share, by bucket."""
    k, s, t = len(source), source.sum(), target.sum()
    ratio = (target + 1.0) * (s + k) / ((source + 1.0) * (t + k))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT,
             longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; ``rank`` is null where it is not drawn."""
    hist = common.materialize(histograms(docs, key, text, longest, buckets), "histograms")
    gain = gains(totals(hist, buckets), totals(histograms(target, None, target_text, longest, buckets), buckets))

    def weigh(batches):
        for batch in batches:
            sums = []
            for at in range(0, batch.num_rows, _ROWS):
                cells, sizes = _cells(batch.column(3).slice(at, _ROWS))
                total = np.r_[0, np.cumsum(gain[cells["bucket"]] * cells["count"])]
                ends = np.cumsum(sizes)
                sums.append(total[ends] - total[ends - sizes])
            weight = np.concatenate(sums) if sums else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], names=["id", "n_words", "n_features", "weight"])

    weighed = hist.mapInArrow(weigh, "id long, n_words long, n_features long, weight long")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    scored = common.materialize(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "scores")

    may = (F.col("n_words") >= least_words) & F.col("id").isNotNull()
    size = scored.filter(may).count() * percent // 100
    placed = ordered_index(scored.filter(may), [F.col("score").desc(), F.col("id"), F.col("weight"), F.col("n_features")], "_place")
    ranked = placed.withColumn("rank", F.when(F.col("_place") < size, F.col("_place") + 1).cast("long")).drop("_place")
    return ranked.unionByName(scored.filter(~may).withColumn("rank", F.lit(None).cast("long")))


def op13_importance_resampling(spark, sf_dir):
    """One row per document: features, weight, score, and its rank among the drawn."""
    found = resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP13_SQL = f"""
WITH crc AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i,
    list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) AS r(i))),
low AS (SELECT 0 AS side, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 1, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
own AS (SELECT side, id, w, count(*) AS n
  FROM (SELECT side, id, unnest(regexp_extract_all(coalesce(t, ''), '{FEATURE_WORD}')) AS w FROM low) GROUP BY ALL),
word AS (SELECT DISTINCT w FROM own),
octets AS (SELECT w, list_transform(range(1, octet_length(encode(w)) + 1), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i - 1, 2) AS BIGINT)) AS b FROM word),
place AS (SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, tab[CAST(xor(c & 255, x) AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % {BUCKETS} AS k
  FROM octets, crc),
seen AS (SELECT k, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM own JOIN place USING (w) GROUP BY k),
whole AS (SELECT sum(s) AS s, sum(t) AS t FROM seen),
gain AS (SELECT k, CAST(floor(1000 * ln((seen.t + 1.0::DOUBLE) * (whole.s + {BUCKETS}) / ((seen.s + 1.0::DOUBLE) * (whole.t + {BUCKETS})))) AS BIGINT) AS g FROM seen, whole),
doc AS (SELECT id, sum(n) AS f, sum(n * g) AS w FROM own JOIN place USING (w) JOIN gain USING (k) WHERE side = 0 GROUP BY id),
scored AS (SELECT doc_id, CAST(coalesce(f, 0) AS BIGINT) AS n_features, CAST(coalesce(w, 0) AS BIGINT) AS weight,
    CAST(coalesce(w, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN doc ON doc_id = id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * {PERCENT} // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""
