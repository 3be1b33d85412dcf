"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string. Successive prefixes of a
conversation are rendered and consecutive outputs compared: what is new is the turn's span. An output
that does not start with the one before it shows that the template rewrites history; the conversation
is flagged and spans come from the final output's probes alone. Where a text lies inside its span is
found by rendering the prefix with two probe texts instead of it.

Every prefix is rendered in full whatever the number of turns, so one rule holds at all lengths and rewriting is seen even if a
later turn undoes it; the time of a conversation grows with the square of its turns. With a template that is known to look
back a few turns only, ``context`` says how many, and time is linear: prefixes are then rendered from that many turns before the new
one, the spans count only if they add up to the rendering of the whole conversation, and rewriting further back is not looked for.

Rows are dealt by conversation and sorted, and each conversation is formatted as it streams by; a
task holds one conversation, the size of its own output row. A null text or role counts as empty;
turns that tie are ordered by role and text; repeated rows are repeated turns; null ids form one
conversation, null turns come first. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm import common

_PROBES = ("0", "1")
LOSS_ROLE = "assistant"

#: A backslash goes before each of these: backslashes, and what follows the first sign of a control string.
_ESCAPE = re.compile(r"\\|(?<=<)\||(?<=\|)>|(?<=<)/?s>|(?<=\[)/?INST\]")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|((?:[^\\|]|\\.|\|(?!>))*)\|>\n(.*?)<\|/\|>\n", re.DOTALL)
_SPANS = pa.list_(pa.list_(pa.int64()))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def marked(turns: list[tuple[str, str]]) -> str:
    """The default template: every turn between marks, control strings inside texts escaped."""
    return "".join(f"<|{escape(role)}|>\n{escape(text)}<|/|>\n" for role, text in turns)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of ``marked`` output."""
    return [(unescape(m.group(1)), unescape(m.group(2))) for m in _TURN.finditer(formatted)]


def _prefix_spans(turns, template, context: int | None):
    """Spans of all turns, the output they add up to, and the first turn that changed what was there."""
    out, spans, rewritten = template([]), [], None
    for k in range(1, len(turns) + 1):
        first = 0 if context is None else max(0, k - 1 - context)
        before = template(turns[first:k - 1]) if first else out
        after = template(turns[first:k])
        if not after.startswith(before):
            rewritten = k - 1 if rewritten is None else rewritten
            before = os.path.commonprefix([before, after])
        new = after[len(before):]
        start = len(out) if first else len(before)
        out = out + new if first else after
        spans.append((start, start + len(new)))
    return out, spans, rewritten


def text_span(turns, k: int, span: tuple[int, int], template, context: int | None) -> tuple[int, int]:
    """Where turn ``k``'s text lies in the output, by two probe texts that share no sign."""
    first = 0 if context is None else max(0, k - context)
    probes = [template([*turns[first:k], (turns[k][0], p)]) for p in _PROBES]
    head = len(os.path.commonprefix(probes)) - len(template(turns[first:k]))
    tail = len(os.path.commonprefix([p[::-1] for p in probes]))
    return span[0] + head, max(span[0] + head, span[1] - tail)


def render(turns: list[tuple[str, str]], template=marked, loss_role: str = LOSS_ROLE, context: int | None = None):
    """(output, turn spans, spans under the loss mask, first rewritten turn or None)."""
    out, spans, rewritten = _prefix_spans(turns, template, context)
    if context is not None and (rewritten is not None or out != template(turns)):
        context = None
        out, spans, rewritten = _prefix_spans(turns, template, None)
    loss = [] if rewritten is not None else [
        text_span(turns, k, spans[k], template, context) for k, (role, _) in enumerate(turns) if role == loss_role]
    return out, spans, loss, rewritten


def format_conversations(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         template=marked, loss_role: str = LOSS_ROLE, context: int | None = None) -> DataFrame:
    """(id, formatted, turn_spans, loss_spans, rewritten): one row for each conversation, spans in code points.

    A conversation whose history the template rewrites has no loss spans: no mask over its final output would be right.
    """
    named = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{turn}`").alias("at"),
                        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    dealt = named.repartition(common.partitions(rows.sparkSession), "id").sortWithinPartitions("id", "at", "role", "text")

    def form(batches):
        at, turns, done = None, [], []

        def close():
            if turns:
                out, spans, loss, rewritten = render(turns, template, loss_role, context)
                done.append((at, out, [list(s) for s in spans], [list(s) for s in loss], rewritten))

        def flush():
            columns = list(zip(*done)) or [[]] * 5
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), _SPANS, _SPANS, pa.int64()))],
                names=["id", "formatted", "turn_spans", "loss_spans", "rewritten"])

        for batch in batches:
            for one, r, t in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if turns and one != at:
                    close()
                    turns = []
                at = one
                turns.append((r, t))
                if len(done) >= 512:
                    yield flush()
        close()
        yield flush()

    return dealt.mapInArrow(
        form, "id long, formatted string, turn_spans array<array<long>>, loss_spans array<array<long>>, rewritten long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss mask, from the output of the default template."""

    def read(batches):
        for batch in batches:
            rows = []
            for one, out, spans, loss, rewritten in zip(*(batch.column(i).to_pylist() for i in range(5))):
                turns = [t for s, e in spans for t in read_turns(out[s:e])]
                trained = "".join(unescape(out[s:e]) for s, e in loss)
                told = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((one, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(trained),
                             hashlib.sha256(trained.encode()).hexdigest(), len(out), rewritten is not None))
            columns = list(zip(*rows)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=_READ)

    return formatted.mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean")


_READ = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
_OWN = "</s>[INST] ok [/INST]"


def op9_chat_formats(spark, sf_dir):
    """One row per conversation, and one made of control strings."""
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_OWN).alias("text"))
    return read_back(format_conversations(given.unionByName(own)))


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(role) + length(text) + 11 + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
  + len(regexp_extract_all(role || chr(10) || text, '<\|')) + len(regexp_extract_all(role || chr(10) || text, '\|>'))
  + len(regexp_extract_all(role || chr(10) || text, '</?s>|\[/?INST\]')) AS size FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars, false AS rewrites
FROM e GROUP BY conv_id
"""
