"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at one number of a document and says good (1), bad (-1) or nothing (0). A latent label
with a prior makes each rule right with its own probability, one on good and one on bad documents;
abstaining says nothing. Documents with
the same votes are alike to the model, so it is fitted on the counts of vote patterns, at most
3 ** rules of them whatever the number of documents, on the driver. A document is kept if its posterior
probability of being good reaches ``KEEP``.

All numbers come from DataFrame functions on the document's own row: one pass without a shuffle, then one
aggregation to the pattern counts. Repeated three-word windows are found by sorting the row's window
hashes, only where some hash occurs twice.

A null, empty or blank text has no words, fails the base rules and is not kept. Repeated rows are judged
alike. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm import common

KEEP = 0.5
_TURNS = 200
_PRIOR, _ON_GOOD, _ON_BAD = (0.5, 0.99), (0.6, 0.999), (0.02, 0.99)  # better than chance, which fixes which label is good


class Rule(NamedTuple):
    """Votes by a ratio of two numbers: good within ``good``, bad outside ``fair``, else nothing."""

    name: str
    ratio: Callable[[], Column]
    good: tuple[float, float]
    fair: tuple[float, float]


def _per(top: str, bottom: str) -> Callable[[], Column]:
    return lambda: F.col(top) / F.greatest(F.col(bottom), F.lit(1))


RULES = (
    Rule("symbols", _per("n_symbols", "n_words"), (0, 0.02), (0, 0.1)),
    Rule("marked_words", _per("n_marked", "n_words"), (0, 0.02), (0, 0.08)),
    Rule("lines", _per("n_dup_lines", "n_lines"), (0, 0.05), (0, 0.3)),
    Rule("length", _per("word_chars", "n_words"), (3, 10), (2, 15)),
    Rule("repeats", _per("n_repeat_words", "n_words"), (0, 0.1), (0, 0.3)),
    Rule("capitals", _per("n_capitals", "word_chars"), (0, 0.15), (0, 0.4)),
    Rule("calls", _per("n_calls", "n_words"), (0, 0.05), (0, 0.2)),
    Rule("digits", _per("n_digits", "word_chars"), (0, 0.1), (0, 0.3)),
)


def _pairs_covered(sorted_windows: Column) -> Column:
    """Words in windows whose hash occurs again, from (hash, place) in order."""
    same = lambda x, j, step: F.coalesce(F.get(sorted_windows, j + step)["h"] == x["h"], F.lit(False))
    again = F.filter(sorted_windows, lambda x, j: same(x, j, 1) | ((j > 0) & same(x, F.greatest(j - 1, F.lit(0)), 0)))
    places = F.array_sort(F.transform(again, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(places, start, step, lambda a: a["n"])


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ...): all as long, one row per row."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    split = docs.select(
        F.col(f"`{key}`").alias("id"), value.alias("text"),
        F.regexp_extract_all(value, F.lit(common.WORD), F.lit(0)).alias("words"),
        F.filter(F.split(value, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("words")
    windows = F.when(n >= 4, F.transform(
        F.slice("words", F.lit(1), n - 2), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern))
    counted = split.select(
        "id", n.alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"), count("[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), F.size("lines").alias("n_lines"),
        count("[A-Z]").alias("n_capitals"), count("[!?]").alias("n_calls"),
        count(r"[#*$%&|<>][^#*$%&|<>]").alias("n_marked"), count("[0-9]").alias("n_digits"), windows.alias("windows"))
    ordered = counted.withColumn("windows", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    repeats = F.when(F.col("windows").isNull(), F.lit(0)).otherwise(_pairs_covered(F.col("windows")))
    numbers = [c for c in counted.columns if c not in ("id", "windows")]
    return ordered.select("id", *[F.col(c).cast("long").alias(c) for c in numbers], repeats.cast("long").alias("n_repeat_words"))


def vote(rule: Rule) -> Column:
    x = rule.ratio()
    return F.when(F.col("n_words") == 0, 0).when((x >= rule.good[0]) & (x <= rule.good[1]), 1).when(
        (x < rule.fair[0]) | (x > rule.fair[1]), -1).otherwise(0)


class Fit(NamedTuple):
    """Share of good documents; per rule, how often its vote is right on good and on bad documents."""

    prior: float
    on_good: list[float]
    on_bad: list[float]

    def log_odds(self) -> tuple[float, list[tuple[float, float]]]:
        """Of good against bad: the prior's, and each rule's for the votes good and bad."""
        weights = [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(self.on_good, self.on_bad)]
        return math.log(self.prior / (1 - self.prior)), weights

    def posterior(self, votes) -> float:
        odds, weights = self.log_odds()
        odds += sum(w[v < 0] for w, v in zip(weights, votes) if v)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def _within(x: float, bounds: tuple[float, float]) -> float:
    return min(bounds[1], max(bounds[0], x))


def fit_rules(patterns: list[tuple[tuple[int, ...], int]], rules: int, turns: int = _TURNS) -> Fit:
    """Expectation-maximisation on (votes, count), from rules that seldom accuse a good document and see few bad ones."""
    fit = Fit(0.85, [0.995] * rules, [0.15] * rules)
    total = sum(n for _, n in patterns)
    for _ in range(turns):
        good = [(v, n, fit.posterior(v)) for v, n in patterns]
        on_good, on_bad = [], []
        for j in range(rules):
            right_good = sum(n * p for v, n, p in good if v[j] > 0)
            all_good = sum(n * p for v, n, p in good if v[j])
            right_bad = sum(n * (1 - p) for v, n, p in good if v[j] < 0)
            all_bad = sum(n * (1 - p) for v, n, p in good if v[j])
            on_good.append(_within((right_good + 9.95) / (all_good + 10), _ON_GOOD))
            on_bad.append(_within((right_bad + 1.5) / (all_bad + 10), _ON_BAD))
        new = Fit(_within((sum(n * p for _, n, p in good) + 8.5) / (total + 10), _PRIOR), on_good, on_bad)
        moved = max(abs(a - b) for a, b in zip([new.prior, *new.on_good, *new.on_bad], [fit.prior, *fit.on_good, *fit.on_bad]))
        fit = new
        if moved < 1e-9:
            break
    return fit


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES, keep: float = KEEP) -> DataFrame:
    """The measures of every row with its votes, ``posterior`` and ``base_failed``, ``kept``."""
    names = [f"vote_{r.name}" for r in rules]
    voted = common.materialize(measures(docs, key, text).withColumns({n: vote(r) for n, r in zip(names, rules)}), "votes")
    patterns = [(tuple(r[n] for n in names), r["count"]) for r in voted.groupBy(*names).count().orderBy(*names).collect()]
    base, weights = fit_rules(patterns, len(rules)).log_odds()
    odds = F.lit(base)
    for n, (for_good, for_bad) in zip(names, weights):
        odds = odds + F.when(F.col(n) > 0, for_good).when(F.col(n) < 0, for_bad).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep))


def op4_quality_votes(spark, sf_dir):
    """One row per document: base numbers, whether they fail, and the verdict."""
    judged = judge(common.table(spark, sf_dir, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.round("posterior", 9).alias("posterior"))
