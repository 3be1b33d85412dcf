"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of all words by its weight, at most ``most`` times its own size; what is
over goes to the others by weight. Within a source a document's expected copies grow with its own
weight, again at most ``most``. The whole part is allocated for certain; the rest is an inclusion
probability p, and one more copy goes to the documents of smallest Pareto rank

    [U / (1 - U)] / [p / (1 - p)],   U from a hash of the id,

until the source has its words. Rank and cut depend on ids and totals only, so reruns agree and a
lost executor changes nothing.

Plan: one narrow table (id, source, size, weight level); totals per source by partial aggregation;
the cut by a running total over a range-partitioned order, so that a source with most of the rows
is spread over many tasks. Texts are only ever joined with one row per source.

A null or empty text has size 0 and is never taken. Null sources form a source of their own, last.
Rows with one id share a rank and are taken or left together; a null id ranks like an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm import common
from tablework.operators.order import ordered_index, prefix_sum

MOST = 3
WEIGHTS = (1, 2, 3)
#: (fewest words, weight): a document below 50 words is half as likely to be repeated as a longer one.
LEVELS = ((0, 1), (50, 2))
SEED = "mix"
_DIGITS = 13  # hex digits of the digest: 52 bits, exact in a double


def uniform(key: str, seed: str = SEED) -> Column:
    """A number inside (0, 1) from the id alone."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16 ** _DIGITS))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size and more) with each source's target; weights repeat in code point order, null last."""
    order = [F.col("source").isNull(), "source"]
    placed = common.materialize(
        ordered_index(sizes, order, "_nth").withColumn(
            "_weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_nth") % len(weights) + 1).cast("int")).cast("long")
        ), "mix-sources")
    total, rate, capped = None, 0.0, -1
    while True:
        over = F.lit(rate) * F.col("_weight") > F.lit(most) * F.col("source_size")
        row = placed.agg(
            F.sum("source_size").alias("total"), F.sum(over.cast("long")).alias("capped"),
            F.sum(F.when(over, most * F.col("source_size"))).alias("full"), F.sum(F.when(~over, F.col("_weight"))).alias("open")).first()
        total = row["total"] or 0
        if row["capped"] == capped or not row["open"]:
            break
        capped = row["capped"]
        rate = (total - (row["full"] or 0)) / row["open"]
    own = F.lit(rate) * F.col("_weight")
    full = (F.lit(most) * F.col("source_size")).cast("double")
    return placed.withColumn("target", F.when(own > full, full).otherwise(own)).drop("_nth", "_weight")


def copy_plan(narrow: DataFrame, weights=WEIGHTS, most: int = MOST, levels=LEVELS) -> DataFrame:
    """One row per source: size, target and, for each weight level, whole copies and inclusion probability.

    ``narrow``: id, source, size, level. The remaining words of the source are in ``_rest``.
    """
    at = range(len(levels))
    sums = narrow.groupBy("source").agg(
        F.sum("size").alias("source_size"), *[F.sum(F.when(F.col("_level") == i, F.col("size")).otherwise(0)).alias(f"_s{i}") for i in at])
    plan = source_targets(sums, weights, most).withColumn("_rate", F.lit(0.0))
    for _ in range(len(levels) + 1):  # each turn caps one level at least, or changes nothing
        over = [F.col("_rate") * w > most for _, w in levels]
        full = sum((F.when(over[i], most * F.col(f"_s{i}")).otherwise(0) for i in at), F.lit(0))
        open_ = sum((F.when(over[i], 0).otherwise(w * F.col(f"_s{i}")) for i, (_, w) in enumerate(levels)), F.lit(0))
        plan = plan.withColumn("_rate", F.when(open_ > 0, (F.col("target") - full) / open_).otherwise(F.col("_rate")))
    for i, (_, w) in enumerate(levels):
        copies = F.least(F.lit(float(most)), F.col("_rate") * w)
        plan = plan.withColumn(f"_whole{i}", F.floor(copies)).withColumn(f"_p{i}", copies - F.floor(copies))
    rest = F.col("target") - sum((F.col(f"_whole{i}") * F.col(f"_s{i}") for i in at), F.lit(0))
    return plan.withColumn("_rest", rest)


def _of_level(prefix: str, levels) -> Column:
    out = F.col(f"{prefix}{len(levels) - 1}")
    for i in range(len(levels) - 2, -1, -1):
        out = F.when(F.col("_level") == i, F.col(f"{prefix}{i}")).otherwise(out)
    return out


def _level(size: str, levels) -> Column:
    out = F.lit(0)
    for i, (least, _) in enumerate(levels):
        out = F.when(F.col(size) >= least, F.lit(i)).otherwise(out)
    return out


def _rank(key: str, p: Column, seed: str) -> Column:
    u = uniform(key, seed)
    return (u * (F.lit(1.0) - p)) / ((F.lit(1.0) - u) * p)


def _narrow(docs: DataFrame, key: str, text: str, source: str, levels) -> DataFrame:
    return docs.select(F.col(key).alias("_id"), F.col(source).cast("string").alias("source"), common.word_count(text).alias("size")).withColumn(
        "_level", _level("size", levels))


def mix_plan(narrow: DataFrame, weights=WEIGHTS, most: int = MOST, levels=LEVELS, seed: str = SEED) -> DataFrame:
    """The copy plan with each source's cut: a document gets one more copy if (rank, id) is at most (``_cut``, ``_cut_id``)."""
    plan = common.materialize(copy_plan(narrow, weights, most, levels), "mix-plan")
    p = _of_level("_p", levels)
    ranked = (
        narrow.join(plan.drop("source_size", "target"), narrow["source"].eqNullSafe(plan["source"]))
        .filter((p > 0) & (F.col("size") > 0))
        .select(narrow["source"], F.coalesce("_id", F.lit(None)).alias("_id"), "size", "_rest", _rank("_id", p, seed).alias("_q")))
    placed = prefix_sum(ranked, ["source", "_q", "_id", "size"], {"_before": "size"})
    starts = placed.groupBy("source").agg(F.min("_before").alias("_start"))
    inside = placed.join(starts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    taken = inside.filter(F.col("_before") - F.col("_start") + F.col("size") / 2 <= F.col("_rest"))
    cuts = taken.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("_q", "_id")).alias("_cut"))
    return common.materialize(plan.join(cuts, plan["source"].eqNullSafe(F.col("_source")), "left").drop("_source"), "mix-cuts")


def _copies(key: str, levels, seed: str) -> Column:
    """Copies of a row that has its source's plan and its ``_level``."""
    p = _of_level("_p", levels)
    q, cut = _rank(key, p, seed), F.col("_cut")
    more = (p > 0) & cut.isNotNull() & ((q < cut["_q"]) | ((q == cut["_q"]) & (
        F.col(key).isNull() | F.coalesce(F.col(key) <= cut["_id"], F.lit(False)))))
    return _of_level("_whole", levels) + F.coalesce(more, F.lit(False)).cast("long")


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
                  most: int = MOST, levels=LEVELS, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as many times as it is taken, columns as they were."""
    columns = docs.columns
    narrow = common.materialize(_narrow(docs, key, text, source, levels), "mix-sizes")
    plan = mix_plan(narrow, weights, most, levels, seed).drop("source_size", "target")
    renamed = plan.withColumnRenamed("source", "_mix_source")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(f"`{key}`").alias("_id"), F.col(f"`{source}`").cast("string").alias("_own"),
                      common.word_count(F.col(f"`{text}`")).alias("_size"))
    joined = own.withColumn("_level", _level("_size", levels)).join(renamed, F.col("_own").eqNullSafe(F.col("_mix_source")))
    copies = F.when(F.col("_size") > 0, _copies("_id", levels, seed)).otherwise(0)
    return joined.select("_row", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("_copy")).select("_row.*")


def op2_mix_sources(spark, sf_dir):
    """One row per document: words, its source's words and target, and the words that the mix takes of it."""
    docs = common.table(spark, sf_dir, "documents")
    narrow = common.materialize(_narrow(docs, "doc_id", "text", "source", LEVELS), "mix-sizes")
    plan = mix_plan(narrow).withColumnRenamed("source", "_source")
    rows = narrow.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    copies = F.when(F.col("size") > 0, _copies("_id", LEVELS, SEED)).otherwise(0)
    return rows.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", (copies * F.col("size")).alias("taken"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
l AS (SELECT *, CASE WHEN size >= 50 THEN 1 ELSE 0 END AS level FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(sum(CASE WHEN level = 0 THEN size ELSE 0 END) AS BIGINT) AS s0,
    CAST(sum(CASE WHEN level = 1 THEN size ELSE 0 END) AS BIGINT) AS s1 FROM l GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight,
        CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
o AS (  -- sources by the rate at which they are full
  SELECT *,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
    sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_from
  FROM w),
r AS (  -- the first source that its share does not fill gives the rate
  SELECT arg_min(CAST(total - full_before AS DOUBLE) / CAST(open_from AS DOUBLE), full_before) AS rate FROM o
  WHERE CAST(total - full_before AS DOUBLE) / CAST(open_from AS DOUBLE) * weight <= 3 * source_size),
t AS (SELECT w.*, least(coalesce(rate, 0) * weight, CAST(3 * source_size AS DOUBLE)) AS target FROM w, r),
a AS (SELECT *, CASE WHEN s0 + 2 * s1 > 0 THEN target / (s0 + 2 * s1) ELSE 0 END AS rate1 FROM t),
b AS (SELECT *, CASE WHEN rate1 * 2 > 3 AND rate1 * 1 > 3 THEN rate1 WHEN rate1 * 2 > 3 AND s0 > 0 THEN (target - 3 * s1) / s0
       ELSE rate1 END AS rate2 FROM a),
c AS (SELECT *, least(3.0::DOUBLE, rate2 * 1) AS e0, least(3.0::DOUBLE, rate2 * 2) AS e1 FROM b),
p AS (SELECT *, floor(e0) AS w0, floor(e1) AS w1, e0 - floor(e0) AS p0, e1 - floor(e1) AS p1,
        target - (floor(e0) * s0 + floor(e1) * s1) AS rest FROM c),
j AS (
  SELECT l.*, p.source_size, p.target, p.rest, CASE WHEN level = 0 THEN w0 ELSE w1 END AS whole,
    CASE WHEN level = 0 THEN p0 ELSE p1 END AS pr,
    (CAST(CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM l JOIN p ON l.source IS NOT DISTINCT FROM p.source),
q AS (SELECT *, CASE WHEN pr > 0 AND size > 0 THEN (u * (1.0::DOUBLE - pr)) / ((1.0::DOUBLE - u) * pr) END AS rank FROM j),
k AS (SELECT *, CASE WHEN rank IS NOT NULL THEN coalesce(sum(size) OVER (PARTITION BY source, rank IS NULL
        ORDER BY rank, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS before FROM q)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (whole + CASE WHEN rank IS NOT NULL AND before + CAST(size AS DOUBLE) / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k
"""
