"""Licence recognition by sentence rules.

A text is cut into sentences at punctuation, blank lines, list items and around copyright lines; a single
newline is a blank, whatever comment signs follow it, but a known sentence may begin or end there, as it
may run over a colon or semicolon. A sentence in lower case with single blanks for all but letters and digits
is looked up among known licence sentences and becomes their identifier, or ``unknown`` if it only
speaks of licences. The sequence of a document's identifiers is then read by ordered rules: a rule whose
sequence occurs names its licence and uses those identifiers up, so that a full licence text wins over
a reference that is part of it. Identifiers that no rule uses are counted.

A notice of rights is a licence sentence too: ``all rights reserved`` and copyright lines with a year.

DataFrame functions on the row alone: one pass without a shuffle or Python. Texts without any of the
words that every known sentence and every notice has are not cut.

The SQL counterpart is made of the same tables and patterns.

A null or empty text has no licence. Repeated rows are recognised alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm import common

#: Sentences of public licences and of the usual references to them, normalised.
SENTENCES = {
    "released under the mit license": "mit_ref",
    "licensed under the mit license": "mit_ref",
    "distributed under the mit license": "mit_ref",
    "this project is licensed under the mit license": "mit_ref",
    "spdx license identifier mit": "mit_ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_warranty",
    "licensed under the apache license version 2 0": "apache_ref",
    "licensed under the apache license version 2 0 the license": "apache_ref",
    "spdx license identifier apache 2 0": "apache_ref",
    "you may not use this file except in compliance with the license": "apache_use",
    "you may obtain a copy of the license at": "apache_copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache_warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache_terms",
    "this work is licensed under the gnu general public license version 3": "gpl3_ref",
    "licensed under the gnu general public license version 3": "gpl3_ref",
    "spdx license identifier gpl 3 0 only": "gpl3_ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_grant",
    "licensed under cc by nc 4 0": "cc_by_nc_ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc_by_nc_ref",
    "licensed under cc by 4 0": "cc_by_ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc_by_ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
}
#: Words of which every known sentence has one.
CUES = ("licens", "permission", "warrant", "redistribut", "permitted")
#: In this order: whole texts before references to them.
RULES = (
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty")),
    ("MIT", ("mit_ref",)),
    ("Apache-2.0", ("apache_ref", "apache_use", "apache_copy", "apache_warranty", "apache_terms")),
    ("Apache-2.0", ("apache_ref", "apache_use", "apache_copy")),
    ("Apache-2.0", ("apache_ref",)),
    ("GPL-3.0-or-later", ("gpl3_grant",)),
    ("GPL-3.0-only", ("gpl3_ref",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_ref",)),
    ("CC-BY-4.0", ("cc_by_ref",)),
    ("BSD", ("bsd_grant",)),
)
#: Notices and addresses.
FURTHER = {
    "all rights reserved": "reserved",
    "all rights are reserved": "reserved",
    "http www apache org licenses license 2 0": "apache_url",
    "https www apache org licenses license 2 0": "apache_url",
}
KNOWN = SENTENCES | FURTHER
#: Further words by which a sentence speaks of rights, and signs without which a text has no notice.
MORE_CUES = ("copyright", "rights reserved", "rights are reserved")
SIGNS = ("copyright", "reserved", "(c)", "©")
#: A copyright line, normalised; the sign © is read as the word.
NOTICE = r"^(?:copyright|c)(?: copyright| c)* (?:19|20)[0-9]{2}\b"
RESERVED = r"^all rights (?:are )?reserved\b"
_CLOSED = r"\ball rights (?:are )?reserved$"
#: "All rights reserved" over a licence text is part of that text.
ALL_RULES = (
    ("BSD", ("reserved", "bsd_grant")),
    ("Apache-2.0", ("apache_ref", "apache_use", "apache_copy", "apache_url", "apache_warranty", "apache_terms")),
    ("Apache-2.0", ("apache_ref", "apache_use", "apache_copy", "apache_url")),
    *RULES,
    ("All-Rights-Reserved", ("copyright", "reserved")),
    ("All-Rights-Reserved", ("reserved",)),
    ("Copyright-Notice", ("copyright",)),
)
UNKNOWN = "unknown"
#: Marks for an end of any sentence, an end that a known sentence may run over, and a newline within a sentence.
_HARD, _SOFT, _LINE = "\x01", "\x02", "\x03"
_YEAR = r"(?:copyright|©|\(c\))[^\p{L}\n]*(?:\(c\)[^\p{L}\n]*)?(?:19|20)[0-9]{2}\b"
#: A star before a small letter is a comment sign.
_ITEM = r"[^\p{L}\p{N}\n]*?(?:[-+•][\x20\t]|\*[\x20\t]+(?=\p{Lu})|\(?(?:[0-9]{1,2}|[A-Za-z])[.)][\x20\t])"
#: In this order.
_MARKS = (
    (rf"(?im)^([^\p{{L}}\p{{N}}\n©]*{_YEAR}[^\n]*)$", f"{_SOFT}$1{_SOFT}"),
    (r"\n[^\p{L}\p{N}\n\x02]*(?=\n)", _HARD),
    (rf"\n(?={_ITEM})", _SOFT),
    (r"(?<![.!?])[.!?][.!?;:]*+(?=[\x20\x09-\x0D])", _HARD),
    (r"(?<![;:])[;:]++(?=[\x20\x09-\x0D])", _SOFT),
    (r"\n", _LINE),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sequence(ids) -> str:
    return "".join(f"<{i}>" for i in ids)


def _known_run() -> str:
    """A known sentence between two marks, the longest first."""
    gap = r"[\x20\x02\x03]+"
    longest = sorted(KNOWN, key=len, reverse=True)
    return rf"(?:^|(?<=[\x01-\x03]))(\x20?)({'|'.join(s.replace(' ', gap) for s in longest)})(?=\x20?(?:[\x01-\x03]|$))"


def _sentences(text: Column) -> Column:
    """Sentences in lower case, only letters, digits and single blanks."""
    marked = F.translate(text, _HARD + _SOFT + _LINE, "   ")
    for pattern, mark in _MARKS:
        marked = F.regexp_replace(marked, pattern, mark)
    low = F.translate(F.replace(marked, F.lit("©"), F.lit(" copyright ")), _UPPER, _LOWER)
    low = F.regexp_replace(low, r"[^a-z0-9\x01-\x03]+", " ")
    alone = F.regexp_replace(low, _known_run(), f"{_HARD}$2{_HARD}")
    plain = lambda s: F.trim(F.regexp_replace(s, r"[\x20\x02\x03]+", " "))
    known = F.array(*map(F.lit, KNOWN))
    parts = F.transform(F.split(alone, _HARD), lambda p: F.when(F.array_contains(known, plain(p)), F.array(plain(p))).otherwise(F.transform(F.split(p, _SOFT), plain)))
    return F.flatten(parts)


def recognise(docs: DataFrame, text: str = "text", names=("licences", "n_sentences", "n_unknown", "n_unused")) -> DataFrame:
    """All rows with the licences found (array, sorted) and the counts of licence sentences: all, unknown, in no rule."""
    if {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has one of {names}; choose other names")
    ids, left, found = (common.fresh(n, [*docs.columns, *names]) for n in ("_ids", "_left", "_found"))
    value = F.col(f"`{text}`")
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    has = lambda s, cues: F.greatest(*[s.contains(c) for c in cues])
    cued = F.coalesce(has(F.lower(value), CUES + SIGNS), F.lit(False))
    spoken = F.filter(_sentences(value), lambda s: has(s, CUES + MORE_CUES) | s.rlike(NOTICE))
    notice = lambda s: F.when(s.rlike(RESERVED) | s.rlike(NOTICE) & s.rlike(_CLOSED), "reserved").when(s.rlike(NOTICE), "copyright")
    tokens = F.transform(spoken, lambda s: F.coalesce(F.try_element_at(known, s), notice(s), F.lit(UNKNOWN)))
    listed = docs.withColumn(ids, F.when(cued, tokens).otherwise(F.array().cast("array<string>")))

    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_sequence(seq)).alias("seq")) for name, seq in ALL_RULES])
    start = F.struct(
        F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("left"), F.array().cast("array<string>").alias("names"))

    def apply(state, rule):
        return F.struct(
            F.replace(state["left"], rule["seq"], F.lit("|")).alias("left"),
            F.when(state["left"].contains(rule["seq"]), F.array_union(state["names"], F.array(rule["name"]))).otherwise(state["names"]).alias("names"))

    read = listed.withColumn(found, F.when(F.size(ids) > 0, F.aggregate(rules, start, apply)))
    unknown = F.size(F.filter(ids, lambda i: i == UNKNOWN))
    values = (
        F.coalesce(F.array_sort(F.col(found)["names"]), F.array().cast("array<string>")), F.size(ids).cast("long"), unknown.cast("long"),
        (F.coalesce(F.regexp_count(F.col(found)["left"], F.lit("<")), F.lit(0)) - unknown).cast("long"))
    return read.select(*[F.col(f"`{c}`") for c in docs.columns], *[v.alias(n) for v, n in zip(values, names)])


def op3_licence_rules(spark, sf_dir):
    """One row per document: its licences and what its sentences were."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return recognise(docs).select("doc_id", F.array_join("licences", ",").alias("licences"), "n_sentences", "n_unknown", "n_unused")


def _sql() -> str:
    """The same recognition in DuckDB: its patterns cannot look around, so lines and fragments are rows there.

    A known sentence is a run of fragments between marks whose joined words equal it; of runs that start alike the longest counts,
    and none that starts inside an earlier one.
    """
    known = ", ".join(f"('{s}', '{i}')" for s, i in KNOWN.items())
    has = lambda c, cues: "(" + " OR ".join(f"contains({c}, '{x}')" for x in cues) + ")"
    hard, soft, line = (f"chr({ord(m)})" for m in (_HARD, _SOFT, _LINE))
    item = r"^[^\p{L}\p{N}\n]*?(?:[-+•][\x20\t]|\*[\x20\t]+\p{Lu}|\(?(?:[0-9]{1,2}|[A-Za-z])[.)][\x20\t])"
    steps, last = [], "r0"
    for n, (name, seq) in enumerate(ALL_RULES, 1):
        q = _sequence(seq)
        steps.append(f"r{n} AS (SELECT doc_id, ids, replace(rest, '{q}', '|') AS rest, "
                     f"CASE WHEN contains(rest, '{q}') AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names FROM {last})")
        last = f"r{n}"
    return f"""
WITH k(s, id) AS (VALUES {known}),
cued AS (SELECT doc_id, regexp_replace(translate(text, {hard} || {soft} || {line}, '   '), '(?im)^([^\\p{{L}}\\p{{N}}\\n©]*{_YEAR}[^\\n]*)$', {soft} || '\\1' || {soft}, 'g') AS t
  FROM documents WHERE {has("lower(text)", CUES + SIGNS)}),
rows AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i, len(string_split(t, chr(10))) AS n FROM cued),
marked AS (SELECT doc_id, string_agg(CASE WHEN i = 1 THEN l WHEN i < n AND NOT regexp_matches(l, '[\\p{{L}}\\p{{N}}\\x02]') THEN {hard}
    WHEN regexp_matches(l, '{item}') THEN {soft} || l ELSE chr(10) || l END, '' ORDER BY i) AS t FROM rows GROUP BY doc_id),
cut AS (SELECT doc_id, replace(regexp_replace(regexp_replace(t, '[.!?][.!?;:]*([\\x20\\x09-\\x0D])', {hard} || '\\1', 'g'), '[;:]+([\\x20\\x09-\\x0D])', {soft} || '\\1', 'g'), chr(10), {line}) AS t FROM marked),
low AS (SELECT doc_id, regexp_replace(translate(replace(t, '©', ' copyright '), '{_UPPER}', '{_LOWER}'), '[^a-z0-9\\x01-\\x03]+', ' ', 'g') AS t FROM cut),
part AS (SELECT doc_id, unnest(string_split(t, {hard})) AS t, generate_subscripts(string_split(t, {hard}), 1) AS p FROM low),
piece AS (SELECT doc_id, p, unnest(string_split(t, {soft})) AS t, generate_subscripts(string_split(t, {soft}), 1) AS q FROM part),
frag AS (SELECT doc_id, p, q, trim(unnest(string_split(t, {line}))) AS f, generate_subscripts(string_split(t, {line}), 1) AS o FROM piece),
numbered AS (SELECT doc_id, p, q, f, row_number() OVER (PARTITION BY doc_id ORDER BY p, q, o) AS x FROM frag WHERE f <> ''),
ahead AS (SELECT *, list(f) OVER (PARTITION BY doc_id, p ORDER BY x ROWS BETWEEN CURRENT ROW AND 80 FOLLOWING) AS fs FROM numbered),
start AS (SELECT a.doc_id, a.p, a.q, a.x, k.s, k.id, list_filter(range(1, len(fs) + 1), lambda z: array_to_string(fs[1:z], ' ') = k.s)[1] AS z
  FROM ahead a JOIN k ON starts_with(k.s || ' ', a.f || ' ')),
longest AS (SELECT * FROM start WHERE z IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, x ORDER BY length(s) DESC) = 1),
run AS (SELECT * FROM longest l WHERE NOT EXISTS (SELECT 1 FROM longest e WHERE e.doc_id = l.doc_id AND e.x < l.x AND l.x < e.x + e.z)),
loose AS (SELECT n.*, n.x - row_number() OVER (PARTITION BY n.doc_id, n.p, n.q ORDER BY n.x) AS g FROM numbered n
  WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.doc_id = n.doc_id AND r.x <= n.x AND n.x < r.x + r.z)),
sentence AS (SELECT doc_id, x, s FROM run UNION ALL SELECT doc_id, min(x), string_agg(f, ' ' ORDER BY x) FROM loose GROUP BY doc_id, p, q, g),
t AS (SELECT doc_id, list(coalesce(k.id, CASE WHEN regexp_matches(e.s, '{RESERVED}') OR regexp_matches(e.s, '{NOTICE}') AND regexp_matches(e.s, '{_CLOSED}') THEN 'reserved'
    WHEN regexp_matches(e.s, '{NOTICE}') THEN 'copyright' ELSE '{UNKNOWN}' END) ORDER BY x) AS ids
  FROM sentence e LEFT JOIN k ON e.s = k.s WHERE {has("e.s", CUES + MORE_CUES)} OR regexp_matches(e.s, '{NOTICE}') GROUP BY doc_id),
r0 AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '') AS rest, CAST([] AS VARCHAR[]) AS names FROM t),
{", ".join(steps)}
SELECT documents.doc_id, coalesce(array_to_string(list_sort(names), ','), '') AS licences,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_sentences,
  CAST(coalesce(len(list_filter(ids, lambda x: x = '{UNKNOWN}')), 0) AS BIGINT) AS n_unknown,
  CAST(coalesce(len(regexp_extract_all(rest, '<')) - len(list_filter(ids, lambda x: x = '{UNKNOWN}')), 0) AS BIGINT) AS n_unused
FROM documents LEFT JOIN {last} USING (doc_id)
"""


OP3_SQL = _sql()
