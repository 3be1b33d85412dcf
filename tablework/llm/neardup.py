"""Near-duplicate groups: MinHash with tensored banding, links confirmed on full shingle sets.

Tensored banding. Two collections hold ``M`` half keys each, of ``R`` minhashes. A table of the usual
banding scheme is a pair (half key of the first, half key of the second), so 2 * M * R = 48 minhashes
make M * M = 144 tables. Two texts of similarity J miss each other with probability
below 2 * (1 - J^R)^M: 0.0001 at J = 0.75.

Only half keys that a second text shares can be part of a shared pair, so the others are dropped
before pairs are formed; most texts are gone by then. Then, per table key:

1. texts with equal sets form a class, its smallest id stands for it;
2. every member is compared with its key's smallest id (a star, not all pairs);
3. in keys that still span components, texts with so many shingles of their own that no other text
   there can reach the similarity are done; the others are compared with their key's most central text;
4. what is still outside its key's largest component is compared with the key's other components.

After step 4 every colliding pair is confirmed, refused, impossible by its counts or connected already,
so no link between components is lost. Sets of the candidates alone are built and moved; a hot centre is dealt to
tasks in runs of ``_RUN`` members. All tables between the steps lie in the shared folder.

A row with a null id is a document of its own: component null, kept. Rows that repeat an id are one
document with all their texts. A null, empty or blank text has an empty set and no links; below five words
the whole sequence is the only shingle. Ties do not occur: the smallest id stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import common
from tablework.llm.graph import components

SHINGLE = 5
M, R = 12, 2
SIMILARITY = (75, 100)
_RUN = 64
_BROADCAST_IDS = 1_000_000
_TURNS = ("least", "central", "outer")
_CHUNK = 4096

_SKETCH = "id long, n long, f1 long, f2 long, half array<long>"
_SETS = "id long, n long, bits array<long>, n_bits long, shingles binary"
_BITS = 2048


def shingle_set(raw: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, A-Z in lower case."""
    words = common.words_of(raw.translate(common.A_TO_Z) if raw else raw)
    if not words:
        return np.empty(0, np.uint64)
    hashes = common.hash_words(words)
    grams = common.gram_hashes(hashes, min(k, len(hashes)))
    return np.unique(grams + np.uint64(0 if len(hashes) >= k else k - len(hashes)))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The shingles' places among ``_BITS`` bits, as words of 64."""
    on = np.zeros(_BITS, np.uint8)
    on[(shingles % np.uint64(_BITS)).astype(np.int64)] = 1
    return np.packbits(on).view(np.uint64)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the minhash functions, from a counter."""
    n = np.arange(1, 2 * M * R + 1, dtype=np.uint64)
    return (common.mix(n * np.uint64(0xD1342543DE82EF95)) | np.uint64(1))[:, None], common.mix(n * np.uint64(0xA24BAED4963EE407))[:, None]


def half_keys(shingles: np.ndarray) -> np.ndarray:
    """The 2 * M half keys of a set; the place of a half key is part of its value."""
    factor, offset = _multipliers()
    least = np.full(2 * M * R, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        least = np.minimum(least, (shingles[at:at + _CHUNK] * factor + offset).min(axis=1))
    rows = least.reshape(2 * M, R)
    out = np.arange(1, 2 * M + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(R):
        out = common.mix(out ^ rows[:, i])
    return out


def _sketches(docs: DataFrame) -> DataFrame:
    def sketch(batches):
        for batch in batches:
            n, f1, f2, half = [], [], [], []
            for raw in common.raw_texts(batch.column(1)):
                shingles = shingle_set(raw)
                n.append(len(shingles))
                mixed = common.mix(shingles + np.uint64(7))
                f1.append(int(shingles.sum(dtype=np.uint64).view(np.int64)))
                f2.append(int(np.bitwise_xor.reduce(mixed, initial=np.uint64(0)).view(np.int64)))
                half.append(half_keys(shingles).view(np.int64) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(half, pa.list_(pa.int64()))],
                names=["id", "n", "f1", "f2", "half"])

    return common.materialize(docs.mapInArrow(common.lean(sketch), _SKETCH), "sketches")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Keys that two different ids have, with the smallest of them."""
    return rows.groupBy(key).agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select(key, "least")


def _table_keys(firsts: DataFrame) -> DataFrame:
    """(key, id, n, least) of all table keys that two classes share."""
    halves = firsts.select("id", "n", F.posexplode("half").alias("place", "h"))
    shared = halves.join(_shared(halves, "h").select("h"), "h")
    own = shared.groupBy("id", "n").agg(
        F.collect_set(F.when(F.col("place") < M, F.col("h"))).alias("one"), F.collect_set(F.when(F.col("place") >= M, F.col("h"))).alias("two"))
    keys = common.materialize(
        own.select("id", "n", F.explode("one").alias("h1"), "two").select("id", "n", "h1", F.explode("two").alias("h2"))
        .select(F.xxhash64("h1", "h2").alias("key"), "id", "n"), "keys")
    return common.materialize(keys.join(_shared(keys, "key"), "key"), "table-keys")


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Full shingle sets of the given ids."""
    ids = F.broadcast(ids) if ids.count() <= _BROADCAST_IDS else ids

    def build(batches):
        for batch in batches:
            sets = [shingle_set(raw) for raw in common.raw_texts(batch.column(1))]
            maps = [bitmap(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([m.view(np.int64) for m in maps], pa.list_(pa.int64())),
                 pa.array([int(np.bitwise_count(m).sum()) for m in maps], pa.int64()), common.binary(sets)],
                names=["id", "n", "bits", "n_bits", "shingles"])

    return common.materialize(docs.join(ids, "id", "left_semi").select("id", "text").mapInArrow(common.lean(build), _SETS), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity=SIMILARITY) -> DataFrame:
    """Those pairs (a, b) whose full sets reach the similarity.

    The set of ``a`` is read once per run of its partners, each partner's set once per pair.
    """
    part, whole = similarity
    runs = pairs.groupBy("a").agg(F.ceil(F.count("*") / _RUN).cast("int").alias("runs"))
    dealt = pairs.join(runs, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("runs")).cast("int").alias("run"))
    members = dealt.join(sets, dealt["b"] == sets["id"]).select("a", "run", F.lit(1).alias("kind"), "b", "shingles")
    centres = runs.join(sets, runs["a"] == sets["id"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.lit(0).alias("kind"), F.col("a").alias("b"), "shingles")
    met = centres.union(members).repartition("a", "run").sortWithinPartitions("a", "run", "kind", "b")

    def compare(batches):
        at, own = None, []
        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for a, run, kind, b, raw in zip(*columns, batch.column(4)):
                one = np.frombuffer(raw.as_buffer(), np.uint64)
                if kind == 0:
                    own = [*own, one] if at == (a, run) else [one]
                    at = (a, run)
                elif any(similar(x, one, part, whole) for x in own):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return met.mapInArrow(common.lean(compare), "a long, b long").distinct()


def similar(x: np.ndarray, y: np.ndarray, part: int, whole: int) -> bool:
    small, large = sorted((len(x), len(y)))
    if whole * small < part * large:
        return False
    common_size = len(np.intersect1d(x, y, assume_unique=True))
    return whole * common_size >= part * (small + large - common_size)


def _fits(n: str, m: str, other_n: str, other_m: str) -> Column:
    """Whether two sets can reach the similarity: of ``n`` shingles no more than ``m`` can be common."""
    part, whole = SIMILARITY
    return (whole + part) * F.least(m, other_m) >= part * (F.col(n) + F.col(other_n))


def _spanning(known: DataFrame) -> DataFrame:
    """Members (key, id, n, m, c) that fit the smallest set of their key, in keys that span components."""
    least = known.groupBy("key").agg(F.min("n").alias("least_n"))
    fit = known.join(least, "key").filter(_fits("n", "m", "least_n", "m")).drop("least_n")
    spans = fit.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    return fit.join(spans, "key")


def _open_keys(keys: DataFrame, grouped: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of keys that span components, with ``m``, the shingles that another such member has too.

    A text whose own shingles are too many for any link leaves here, which is exact.
    """
    known = keys.select("key", "id", "n").join(grouped, "id", "left").select(
        "key", "id", "n", F.col("n").alias("m"), F.coalesce("component", "id").alias("c"))
    wide = common.materialize(_spanning(known), "open")
    ids = wide.select("id").distinct()

    def spread(batches):
        for batch in batches:
            own = [np.frombuffer(raw.as_buffer(), np.int64) for raw in batch.column(1)]
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(0).to_numpy(), [len(o) for o in own])), pa.array(np.concatenate(own))], names=["id", "s"])

    shingles = sets.join(ids, "id", "left_semi").select("id", "shingles").mapInArrow(common.lean(spread), "id long, s long")
    alone = shingles.groupBy("s").agg(F.min("id").alias("id"), F.max("id").alias("other")).filter("id = other").groupBy("id").agg(F.count("*").alias("u"))
    counted = wide.drop("m").join(common.materialize(alone, "alone"), "id", "left").select(
        "key", "id", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("m"), "c")
    return common.materialize(_spanning(counted), "open")


def _central_pairs(open_keys: DataFrame) -> DataFrame:
    """Every member with its key's most central text: the one with the smallest share of shingles of its own."""
    best = F.min(F.struct((1 - F.col("m") / F.col("n")).alias("share"), "id", "c", "n", "m"))
    central = open_keys.groupBy("key").agg(best.alias("b")).select("key", *[F.col(f"b.{x}").alias(f"b_{x}") for x in ("id", "c", "n", "m")])
    return open_keys.join(central, "key").filter("c <> b_c").filter(_fits("n", "m", "b_n", "b_m")).select(F.col("b_id").alias("a"), F.col("id").alias("b"))


def _outer_pairs(open_keys: DataFrame, sets: DataFrame) -> DataFrame:
    """Members outside their key's largest component with the members of other components.

    Two sets share no more shingles than their bitmaps share bits, plus what lies doubly on a bit; pairs
    that cannot reach the similarity by that count are left out, which is exact.
    """
    part, whole = SIMILARITY
    mapped = open_keys.join(sets.select("id", "bits", "n_bits").dropDuplicates(["id"]), "id")
    sizes = open_keys.groupBy("key", "c").count().groupBy("key").agg(F.max(F.struct("count", "c"))["c"].alias("main"))
    outer = mapped.join(sizes, "key").filter("c <> main")
    other = mapped.select("key", *[F.col(x).alias(f"b_{x}") for x in ("id", "c", "n", "m", "bits", "n_bits")])
    both = F.aggregate(F.zip_with("bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda a, x: a + x)
    most = both + F.least(F.col("n") - F.col("n_bits"), F.col("b_n") - F.col("b_n_bits"))
    reach = (whole + part) * most >= part * (F.col("n") + F.col("b_n"))
    near = (outer["key"] == other["key"]) & (F.col("c") != F.col("b_c")) & _fits("n", "m", "b_n", "b_m") & reach
    return outer.join(other, near).select(F.col("id").alias("a"), F.col("b_id").alias("b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept), one row for each row of ``docs``."""
    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    sketches = _sketches(narrow)
    sized = sketches.filter("n > 0 AND id IS NOT NULL")
    classes = sized.groupBy("f1", "f2", "n").agg(F.min("id").alias("first"))
    placed = common.materialize(sized.select("id", "f1", "f2", "n").join(classes, ["f1", "f2", "n"]).select("id", "first"), "classes")
    copies = placed.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    firsts = placed.filter("id = first").select("id").distinct()
    keys = _table_keys(sized.select("id", "n", "half").join(firsts, "id"))
    sets = _sets(narrow, keys.select("id").distinct())

    links, tested = copies, None
    for turn in _TURNS:
        if turn == "least":
            pairs = keys.filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))
        else:
            open_keys = _open_keys(keys, components(links), sets)
            if open_keys.isEmpty():
                break
            pairs = _central_pairs(open_keys) if turn == "central" else _outer_pairs(open_keys, sets)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = common.materialize(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        links = links.union(common.materialize(confirmed(pairs, sets), "confirmed"))

    grouped = components(links)
    rows = sketches.select("id", F.col("n").alias("n_shingles")).join(grouped, "id", "left")
    component = F.coalesce("component", "id")
    return rows.select(
        "id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same columns; of every group, and of rows that repeat an id, one row stays.

    Of rows that repeat an id the smallest text stays, whatever their other columns are.
    """
    found = near_duplicates(docs, key, text)
    gone = common.materialize(found.filter("NOT kept").select("id").distinct(), "gone")
    again = common.materialize(
        docs.select(F.col(f"`{key}`").alias("id")).groupBy("id").count().filter("count > 1 AND id IS NOT NULL").select("id"), "again")
    few = gone.count() <= _BROADCAST_IDS
    own = common.fresh("_id", docs.columns)
    gone, again = (d.withColumnRenamed("id", own) for d in (gone, again))
    here = F.col(f"`{key}`") == F.col(own)
    rows = docs.join(F.broadcast(gone) if few else gone, here, "left_anti")
    if again.isEmpty():
        return rows
    whole = F.struct(*[F.col(f"`{c}`") for c in sorted(docs.columns, key=lambda c: (c != text, c))])
    one = rows.join(again, here, "left_semi").groupBy(F.col(f"`{key}`").alias("_key")).agg(F.min(whole).alias("_row"))
    return rows.join(again, here, "left_anti").unionByName(one.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))


def op8_near_duplicates(spark, sf_dir):
    """One row per document: set size, component, and whether it stays."""
    return near_duplicates(common.table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: Exact on the whole table: pairs come from an index of shingles, so it suits small tables only.
OP8_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r AS (SELECT a AS doc_id, a AS seen FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT doc_id, min(seen) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id,
  d.doc_id = coalesce(c.c, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
