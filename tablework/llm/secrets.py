"""Secret scans: fixed patterns, and sliding-window entropy per character class with an allow-list.

A candidate is a run of at least ``_SHORTEST`` token characters. Inside it every maximal run of one
character class is read with a window of fixed length; counts per character change by one on each
step, and with them the sum of n * log2(n), so a step costs the same for any window. Windows that
reach the class's bits and hold both a letter and a digit are joined to spans. A span goes if the
allow-list knows it (identifiers, labelled digests, placeholders, counting sequences) or if it lies
inside a pattern's span. What the allow-list knows of a span is cut out and the rest is read again, so that
a key beside an identifier or a placeholder stays a finding. Spans are in code points, end exclusive.

Rows are independent: one pass, no shuffle, a lost executor costs its own tasks only. A null text
counts as empty and has no findings; an empty table gives an empty table; repeated rows are scanned
each for itself.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm import common

#: The patterns of the contract.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run: the first 32 fit only where a long run starts
KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN_MIN, _ACCESS_MIN = 8, 16


class CharClass(NamedTuple):
    name: str
    run: re.Pattern
    window: int
    bits: float


CLASSES = (
    CharClass("hex", re.compile(r"[0-9a-fA-F]{24,}"), 24, 3.0),
    CharClass("upper", re.compile(r"[A-Z0-9]{16,}"), 16, 3.2),
    CharClass("base64", re.compile(r"[A-Za-z0-9+/_=-]{24,}"), 24, 4.0),
)
_SHORTEST = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{_SHORTEST},}}")

#: What a span may be although it looks random; read on its candidate and a little text before it.
ALLOW = (
    re.compile(r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"),
    re.compile(r"(?i)(?:sha-?(?:1|256|384|512)|md5|integrity|checksum|commit|digest)[\s:=\"'-]{1,3}[A-Za-z0-9+/=]+$"),
    re.compile(r"(?i)example|sample|placeholder|changeme|dummy|redacted|your[-_]"),
    re.compile(r"(?i)0123456789|abcdefghijklm|qwertyuiop"),
    re.compile(r"(?i)data:[a-z]+/[a-z0-9.+-]+;base64,"),
)
_CONTEXT = 24
_PART = re.compile(r"[A-Za-z0-9+]*")
_LABELLED = re.compile(r"[A-Za-z0-9+/]*={0,2}")

FINDING = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def entropy_spans(text: str, start: int, window: int, bits: float) -> list[tuple[int, int]]:
    """Joined windows of ``text`` (all of one class) that reach ``bits``; offsets move by ``start``."""
    if len(text) < window:
        return []
    part = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    need = (math.log2(window) - bits) * window + 1e-9  # entropy >= bits is: sum of n log2 n <= need
    counts: dict[str, int] = {}
    total, digits, letters, spans = 0.0, 0, 0, []
    for at, c in enumerate(text):
        if at >= window:
            old = text[at - window]
            n = counts[old]
            counts[old] = n - 1
            total += part[n - 1] - part[n]
            digits -= old.isdigit()
            letters -= old.isalpha()
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += part[n + 1] - part[n]
        digits += c.isdigit()
        letters += c.isalpha()
        if at >= window - 1 and total <= need and digits and letters:
            first = start + at - window + 1
            if spans and first <= spans[-1][1]:
                spans[-1][1] = start + at + 1
            else:
                spans.append([first, start + at + 1])
    return [tuple(s) for s in spans]


def pattern_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= _ACCESS_MIN]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def _joined_spans(text: str, start: int, stop: int, classes, known) -> list[tuple[int, int]]:
    """Entropy spans of all classes between two places, joined, outside the known ones."""
    spans = []
    for cls in classes:
        for run in cls.run.finditer(text, start, stop):
            spans += entropy_spans(run.group(), run.start(), cls.window, cls.bits)
    joined: list[list[int]] = []
    for s, e in sorted(spans):
        if joined and s <= joined[-1][1]:
            joined[-1][1] = max(e, joined[-1][1])
        else:
            joined.append([s, e])
    return [(s, e) for s, e in joined if not any(a <= s and e <= b for a, _, b in known)]


def _allowed(text: str, start: int, stop: int, allow) -> list[tuple[int, int]]:
    """Stretches of a candidate that the allow-list knows: matches with the rest of their part, and what a label stands before."""
    first, found = max(0, start - _CONTEXT), []
    around = text[first:stop]
    for p in allow:
        for m in p.finditer(around):
            s, e = m.span()
            if first + e == start:
                e = _LABELLED.match(around, e).end()
            elif e and _PART.fullmatch(around[e - 1]):
                e = _PART.match(around, e).end()
            while s and _PART.fullmatch(around, s - 1, s + 1):
                s -= 1
            if first + e > start:
                found.append((first + s, first + e))
    return sorted(found)


def entropy_findings(text: str, known: list[tuple[int, int, int]], classes=CLASSES, allow=ALLOW):
    """Entropy spans outside the known ones, and how many the allow-list took away."""
    found, suppressed = [], 0
    for m in _CANDIDATE.finditer(text):
        joined = _joined_spans(text, m.start(), m.end(), classes, known)
        allowed = _allowed(text, m.start(), m.end(), allow) if joined else []
        for s, e in joined:
            left, at = [], s
            for a, b in allowed:
                if a < e and b > s:
                    left += _joined_spans(text, at, max(at, a), classes, known)
                    at = max(at, min(b, e))
            if at > s or left:
                left += _joined_spans(text, at, e, classes, known)
            else:
                left = [(s, e)]
            found += [(a, 3, b) for a, b in left]
            suppressed += not left
    return found, suppressed


def findings(text: str | None, classes=CLASSES, allow=ALLOW) -> tuple[list[dict], int]:
    """All findings of one text by start, then kind; and the number of suppressed entropy spans."""
    if not text:
        return [], 0
    found = pattern_findings(text)
    more, suppressed = entropy_findings(text, found, classes, allow)
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found + more)], suppressed


def scan_secrets(docs: DataFrame, text: str = "text", classes=CLASSES, allow=ALLOW, keep_text: bool = True,
                 findings_col: str = "findings", suppressed_col: str = "n_suppressed") -> DataFrame:
    """All rows with their findings (array of kind, start, end) and the count of suppressed spans.

    Input columns pass through untouched (without the text if ``keep_text`` is off); a column that
    already has one of the two new names is an error.
    """
    clash = {findings_col.lower(), suppressed_col.lower()} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the input already has {sorted(clash)}; choose other names")
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    names = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField(findings_col, FINDING), T.StructField(suppressed_col, T.LongType())])
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        for batch in batches:
            results = [findings(t, classes, allow) for t in common.texts(common.column(batch, text))]
            yield pa.RecordBatch.from_arrays(
                [common.column(batch, n) for n in names]
                + [pa.array([f for f, _ in results], struct), pa.array([n for _, n in results], pa.int64())],
                names=[*names, findings_col, suppressed_col])

    return docs.mapInArrow(common.lean(scan), schema)


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", classes=CLASSES, allow=ALLOW) -> DataFrame:
    """The same rows and columns with every finding's span replaced by ``mark``; overlapping spans give one mark."""

    at_text = docs.columns.index(text)

    def clean(value):
        found, _ = findings(value, classes, allow)
        if not found:
            return value
        out, at = [], 0
        for f in found:
            if f["start"] >= at:
                out += [value[at:f["start"]], mark]
            at = max(at, f["end"])
        return "".join([*out, value[at:]])

    def scan(batches):
        for batch in batches:
            cleaned = pa.array([clean(t) for t in common.texts(batch.column(at_text))], batch.schema.field(at_text).type)
            yield batch.set_column(at_text, batch.schema.field(at_text), cleaned)

    return docs.mapInArrow(common.lean(scan), docs.schema)


def span_text(findings_col: Column) -> Column:
    return F.array_join(F.transform(findings_col, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def op1_secret_scans(spark, sf_dir):
    """One row per document: counts per kind, digest of the pattern spans, all spans."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, keep_text=False)
    of = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    base = F.filter("findings", lambda f: f["kind"] != "entropy")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("findings")).alias("spans"),
        of("entropy").alias("n_entropy"), "n_suppressed")
