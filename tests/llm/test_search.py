"""Ranked search, byte dedup and importance resampling against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.llm import importance, lexical, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(lexical.TERM)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(draw, n, vocabulary=300):
    return " ".join(draw.choice(["", "", "X-", "É"]) + f"w{int(draw.paretovariate(0.6)) % vocabulary}" + draw.choice(["", "", ",", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(8)
    texts = [prose(draw, draw.randrange(1, 120)) for _ in range(300)]
    texts += [texts[0]] * 6 + [None, "", " \n", "--", "one", prose(draw, 9000), "É é W1 w1\x7f日本 w2"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[9], "en", "s", 1), (None, None, None, None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def ranked(rows, items, top):
    docs = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs]
    n, length = sum(1 for d in docs if d[2]), sum(d[2] for d in docs)
    df = collections.Counter(w for _, c, _ in docs for w in c)
    out = []
    for item, text in items:
        asked = collections.Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, c, size in docs:
            if i is None or not size:
                continue
            m = 25 + (75 * size * n) // length
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w, k in asked.items() if c[w])
            scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 600])
def test_ranked_search(spark, corpus, nothing, monkeypatch, block_bytes):
    rows, df = corpus
    monkeypatch.setattr(lexical, "BUCKET", 16)
    draw = random.Random(4)
    items = [(i, prose(draw, draw.randrange(1, 25)), 1) for i in range(30)] + [(90, None, 1), (91, "", 1), (92, "zzz unheard", 1), (93, "w1 w1 W1", 1), (2, "w3", 1)]
    asked = spark.createDataFrame(items, "item_id long, text string, score long")
    got = [tuple(r) for r in lexical.search(df.withColumn("score", F.lit(1)), asked, block_bytes=block_bytes).collect()]
    want = ranked([r[:2] for r in rows], [i[:2] for i in items], lexical.TOP)
    assert sorted(got, key=str) == want and len(want) > 200
    assert lexical.search(nothing, asked).count() == 0 and lexical.search(df, asked.limit(0)).count() == 0


def test_probe_prunes_and_stays_exact():
    draw = np.random.default_rng(1)
    rows, terms = 4000, 200
    dense = np.where(draw.random((rows, terms)) < 0.05, draw.integers(1, 1000, (rows, terms)), 0) * np.exp(draw.normal(0, 1.5, (rows, 1))).astype(np.int64)
    norms = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-norms)
    weights = [(t, np.sort(draw.integers(1, 9000, len(t)))[::-1]) for t in (draw.permutation(terms)[:k] for k in (1, 3, 8, 20))]
    probe = lexical.Probe(weights, terms, np.zeros(4, np.int64), 10)
    for at in range(0, rows, 256):
        own = order[at:at + 256]
        r, t = np.nonzero(dense[own])
        pairs = np.empty(len(r), lexical._PAIR)
        pairs["term"], pairs["value"] = t, dense[own][r, t]
        probe.add(own, norms[own] + 1e-6, pairs, np.searchsorted(r, np.arange(len(own) + 1)))
    for (t, w), (score, ids) in zip(weights, probe.best):
        exact = dense[:, t] @ w
        best = sorted((-s, i) for i, s in enumerate(exact.tolist()))[:10]
        assert list(zip(score.tolist(), ids.tolist())) == [(-s, i) for s, i in best]
    assert probe.scored < probe.bounded < 4 * rows and probe.scored < rows


def removed_bytes(texts, window):
    seen = collections.Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        out.append((len(t), sum(gone), len(re.findall(b"\1+", gone)), bytes(b for b, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("window,anchor,rows_of_a_bucket", [(24, 8, 300), (60, 20, 40), (400, 120, 4000)])
def test_repeated_bytes(spark, corpus, nothing, monkeypatch, window, anchor, rows_of_a_bucket):
    monkeypatch.setattr(suffixes, "BUCKET_ROWS", rows_of_a_bucket)
    draw = random.Random(window)
    line = prose(draw, 200)
    texts = [r[1] for r in corpus[0]] + [line[i:i + draw.randrange(1500)] + prose(draw, 30, 10**6) for i in range(0, 900, 13)]
    texts += ["a" * 300, "ab" * 500, "x" + "a" * 700, "日本語テキスト" * 40, line[:window], line[:window - 1] + "!", "é" + line[3:700]]
    texts += ["".join(draw.choices("ab", k=600)), "".join(draw.choices("01", k=70000))]
    rows = [(draw.choice([i, 3, None]), t, "en", "s", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    left = suffixes.remove_repeated_bytes(df.withColumn("f1", F.lit(1)), window=window, anchor=anchor)
    got = collections.Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in left.collect())
    want = collections.Counter((r[0], *w) for r, w in zip(rows, removed_bytes([(t or "").encode() for t in texts], window)))
    assert got == want
    assert suffixes.remove_repeated_bytes(nothing).count() == 0


def test_repeated_bytes_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_CHUNK", 64)
    test_repeated_bytes(spark, ([(0, "x")], None), spark.createDataFrame([], SCHEMA), monkeypatch, 24, 8, 60)


def test_repeated_bytes_rows_follow_segments(spark, monkeypatch):
    """An anchor with more different segments than a bucket must not become a row for each of its suffixes."""
    made = {}

    def settle(df, name, plain=suffixes.common.settle):
        out = plain(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(suffixes.common, "settle", settle)
    monkeypatch.setattr(suffixes, "BUCKET_ROWS", 20)
    draw = random.Random(9)
    line, other = prose(draw, 30, 10**6)[:150], prose(draw, 300, 10**6)[:900]
    texts = [prose(draw, 60, 10**6) + line + prose(draw, 60, 10**6) for _ in range(150)]
    texts += [prose(draw, 20 + i % 30, 10**6) + other[i % 7 * 20:700 + i % 11 * 20] + prose(draw, 20, 10**6) for i in range(120)]
    texts += [texts[i][at:at + 450] for i, at in ((3, 100), (5, 60), (5, 90), (130, 40), (200, 80), (201, 0))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    left = suffixes.remove_repeated_bytes(df)
    got = sorted((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in left.collect())
    assert got == [(i, *w) for i, w in enumerate(removed_bytes([t.encode() for t in texts], suffixes.WINDOW))]
    assert sum(r[2] > 0 for r in got) > 100 and made["fetched"] > 300
    assert made["found"] <= 2 * made["fetched"] and made.get("halves", 0) <= 6 * made["fetched"], made


@pytest.mark.parametrize("window,anchor", [(24, 8), (400, 120)])
def test_halves_keep_equal_strings_together(window, anchor):
    draw = random.Random(window)
    spread = window - anchor
    for _ in range(50):
        rel = draw.randrange(spread + 1)
        n = draw.randrange(1, rel + 2)
        octets = bytes(draw.choices(b"ab", k=n + window - 1))
        live = [(0, n, 0, spread)]
        while any(low < high for *_, low, high in live):
            after = []
            for first, count, low, high in live:
                own = octets[first:first + count + window - 1]
                for shared, at, size, least, most in suffixes.halves(own, count, rel - first, low, high, window):
                    after.append((first + at, size, least, most))
                    for i in range(first + at, first + at + size):
                        distance = rel - i
                        assert low <= least <= distance <= most <= high
                        assert octets[i:i + window][distance - least:distance + window - most] == shared
            assert sorted(i for first, size, *_ in after for i in range(first, first + size)) == list(range(n))
            live = after
        assert all(size == 1 for _, size, *_ in live)


def test_multikey_ties():
    draw = np.random.default_rng(2)
    labels, chars = draw.integers(0, 4, 500), draw.integers(0, 4, (500, 3)).astype(np.uint64)
    seen = collections.Counter((label, *c) for label, c in zip(labels.tolist(), chars.tolist()))
    got = suffixes.multikey_ties(labels, lambda live, k: chars[live, k], 3)
    assert sorted(got.tolist()) == [i for i in range(500) if seen[(labels[i], *chars[i].tolist())] > 1]


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (3, 50)])
def test_importance(spark, corpus, nothing, longest, buckets):
    rows, df = corpus
    items = [(1, "w1 w2 X-w3"), (2, None), (3, "É w7, w1")]
    word = re.compile(importance.FEATURE_WORD)

    def features(text):
        w = word.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    source, target = (collections.Counter(b for t in texts for b in features(t)[1]) for texts in ([r[1] for r in rows], [t for _, t in items]))
    s, t = sum(source.values()), sum(target.values())
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)}
    want = []
    for i, text, *_ in rows:
        n, found = features(text)
        weight, score = sum(gain[b] for b in found), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        want.append([i, n, len(found), weight, score, None])
    may = sorted((w for w in want if w[0] is not None and w[1] >= 20), key=lambda w: (-w[4], w[0]))
    for rank, w in enumerate(may[:10 * len(may) // 100], 1):
        w[5] = rank
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = importance.resample(df.withColumn("score", F.lit(1)), asked, longest=longest, buckets=buckets).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(tuple(w)) for w in want)
    assert importance.resample(nothing, asked).count() == 0
    assert importance.resample(df, asked.limit(0)).count() == len(rows)
