"""Language identification by error-correcting output codes.

Every language has a codeword of +1/-1 bits. One logistic classifier per bit reads hashed letter
n-grams (one to three code points, lower case, non-letters as one blank) of the whole text. Decoding
is loss-weighted: a language costs sum of log(1 + exp(-bit * margin)) over its bits and the cheapest
wins; a prediction whose runner-up costs less than ``MARGIN`` more is flagged as ambiguous.

Learning uses a bounded sample: at most about ``SAMPLE`` rows in all, the same number of each
label in expectation and never more than twice that, picked by a hash of id and text, repeated rows once; their features meet on
the driver (twice ``SAMPLE`` x ``BUCKETS`` floats at most). The model is a few bits x ``BUCKETS`` floats and goes with
the tasks. Prediction is one pass without a shuffle.

A null text or one without a letter is ``und`` with score 0. Null labels are not learned from. With
a single label every other text gets it with score 1; with none all texts are ``und``. A null id is
neither held out nor learned from. Repeated rows are predicted alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablework.llm import common

BUCKETS = 4096
SAMPLE = 3200
PER_LABEL = 400
MOST_LABELS = 500
MARGIN = 0.5
UNKNOWN = "und"
_EXHAUSTIVE = 5
_STEPS = 150


_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Whether a code point of the basic plane is a letter; others count as letters if above it."""
    if "letters" not in _tables:
        _tables["letters"] = np.fromiter((chr(i).isalpha() for i in range(65536)), bool, 65536)
    return _tables["letters"]


def features(text: str | None, buckets: int = BUCKETS) -> np.ndarray | None:
    """Unit vector of square-rooted n-gram counts, None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _letters()
    letter = table[np.minimum(points, 65535)] | (points > 65535)
    if not letter.any():
        return None
    if any(ord(c) > 65535 for c in text) and not any(c.isalpha() for c in text):
        return None
    blank = ~letter
    keep = letter | np.r_[True, letter[:-1]]  # the first blank of a run stays
    c = np.where(blank, 32, points)[keep].astype(np.uint64)
    c = np.r_[np.uint64(32), c, np.uint64(32)]
    out = np.zeros(buckets, np.float32)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    odd = np.uint64(0x9E3779B97F4A7C15)
    code = np.zeros(len(c), np.uint64)
    for n in range(3):
        code = (code[: len(c) - n] * np.uint64(2097169)) + c[n:] + np.uint64(n) if n else c + np.uint64(1)
        out += np.bincount((code * odd) >> shift, minlength=buckets)
    out = np.sqrt(out)
    return out / np.float32(np.linalg.norm(out))


def codewords(classes: int) -> np.ndarray:
    """(classes, bits) of +1 and -1: all distinct splits for few classes, else splits chosen for row distance."""
    if classes < 2:
        return np.ones((classes, 0), np.int8)
    if classes <= _EXHAUSTIVE:
        bits = [[1 if (split >> c) & 1 else -1 for c in range(classes)] for split in range(1, 2 ** (classes - 1))]
        return np.array(bits, np.int8).T
    draw = np.random.default_rng(classes)
    size, best, distance = 4 * int(np.ceil(np.log2(classes))) + 3, None, -1
    for _ in range(200):
        code = np.array([draw.permutation([1] * (classes // 2) + [-1] * (classes - classes // 2)) for _ in range(size)], np.int8).T
        apart = (size - code.astype(np.int32) @ code.T) // 2
        least = int((apart + np.eye(classes, dtype=np.int32) * size).min())
        if least > distance:
            best, distance = code, least
    return best


def fit_bits(x: np.ndarray, labels: np.ndarray, code: np.ndarray, steps: int = _STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, bits) and offsets by accelerated gradient steps; labels weigh alike."""
    y = code[labels].astype(np.float32)
    share = 1.0 / np.bincount(labels, minlength=len(code))[labels].astype(np.float32)
    share /= share.sum()
    centre = share @ x
    z = (x - centre).astype(np.float32)
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    b = np.zeros(code.shape[1], np.float32)
    before_w, before_b, rate, ridge = w, b, 24.0, 1e-4
    for t in range(1, steps + 1):
        push = (t - 1) / (t + 2)
        aw, ab = w + push * (w - before_w), b + push * (b - before_b)
        pull = -y / (1 + np.exp(np.clip(y * (z @ aw + ab), -30, 30))) * share[:, None]
        before_w, before_b = w, b
        w, b = aw - rate * (z.T @ pull + ridge * aw), ab - rate / 8 * pull.sum(axis=0)
    return w, b - centre @ w


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
        self.languages, self.code, self.weights, self.offsets = languages, code, weights, offsets

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, gap to the runner-up) of feature rows."""
        margins = (x @ self.weights + self.offsets).astype(np.float64)
        cost = np.logaddexp(0, -margins) @ (self.code.T > 0) + np.logaddexp(0, margins) @ (self.code.T < 0)
        order = np.sort(cost, axis=1)
        score = 1.0 / np.exp(order[:, :1] - cost).sum(axis=1)
        gap = order[:, 1] - order[:, 0] if cost.shape[1] > 1 else np.full(len(x), np.inf)
        return cost.argmin(axis=1), np.clip(score, 0.0, 1.0), gap


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the labelled rows that are not held out."""
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{text}`").alias("t"))
    known = rows.filter(F.col("k").isNotNull() & F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out("k"))
    counts = {r["l"]: r["count"] for r in known.groupBy("l").count().orderBy("l").limit(MOST_LABELS + 1).collect()}
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels; they are not languages")
    languages = sorted(counts)
    if len(languages) < 2:
        return Model(languages, codewords(len(languages)), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    wanted = max(2, min(PER_LABEL, sample // len(languages)))
    shares = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, wanted / counts[name])))])
    place = F.pmod(F.xxhash64("k", "t"), F.lit(1 << 24)) / float(1 << 24)
    likely = known.filter(place < shares[F.col("l")]).dropDuplicates(["k", "l", "t"])
    first = Window.partitionBy("l").orderBy(F.xxhash64("k", "t"), "k")
    picked = likely.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= 2 * wanted).drop("n")

    def build(batches):
        for batch in batches:
            found = [features(t) for t in common.texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([None if f is None else f.tobytes() for f in found], pa.binary())], names=["k", "l", "f"])

    got = sorted((r["l"], r["k"], bytes(r["f"])) for r in picked.mapInArrow(build, "k string, l string, f binary").filter("f IS NOT NULL").collect())
    languages = sorted({name for name, _, _ in got})
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    number = {name: i for i, name in enumerate(languages)}
    x = np.frombuffer(b"".join(f for _, _, f in got), np.float32).reshape(len(got), BUCKETS)
    return Model(languages, code, *fit_bits(x, np.array([number[name] for name, _, _ in got]), code))


def predict(docs: DataFrame, model: Model, text: str = "text", margin: float = MARGIN, keep_text: bool = True,
            names=("lang_pred", "score", "ambiguous")) -> DataFrame:
    """All rows with the predicted language, its score and the flag; only the text is read for it."""
    if {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has one of {names}; choose other names")
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType(kept + [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])

    def decide(batches):
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                found = [features(t) for t in common.column(batch, text).slice(at, 256).to_pylist()]
                there = [f for f in found if f is not None]
                if there and model.languages:
                    which, score, gap = model.decode(np.stack(there))
                    decided = iter([(model.languages[c], float(s), bool(g < margin)) for c, s, g in zip(which, score, gap)])
                else:
                    decided = iter([(UNKNOWN, 0.0, True)] * len(there))
                out += [(UNKNOWN, 0.0, True) if f is None else next(decided) for f in found]
            yield pa.RecordBatch.from_arrays(
                [common.column(batch, f.name) for f in kept]
                + [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))],
                names=[f.name for f in kept] + list(names))

    return docs.mapInArrow(common.lean(decide), schema)


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", margin: float = MARGIN) -> DataFrame:
    """The rows that have a language and are not flagged as ambiguous, columns as they were."""
    names = tuple(common.fresh(n, docs.columns) for n in ("lang_pred", "score", "ambiguous"))
    found = predict(docs, learn(docs, key, text, lang), text, margin, names=names)
    return found.filter((F.col(names[0]) != UNKNOWN) & ~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_language_codes(spark, sf_dir):
    """One row per document: whether it was held out, the predicted language and its score."""
    docs = common.table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), learn(docs), keep_text=False)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
