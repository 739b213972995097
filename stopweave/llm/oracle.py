"""DuckDB SQL for the operators that SQL can express, written independently of them."""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of the phrases, and their labels.
PHRASES = {
    ("mit", "license"): "mit",
    ("apache", "license"): "apache",
    ("general", "public", "license"): "gpl",
}
#: Label, notice, different words that must be there.
NOTICES = [
    ("apache", "licensed under the apache license version 2 0", 8),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", 13),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 11),
    ("cc-by-nc", "licensed under cc by nc 4 0", 7),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", 12),
    ("gpl", "this work is licensed under the gnu general public license version 3", 10),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", 15),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 15),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 13),
    ("mit", "released under the mit license", 5),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", 13),
    ("unlicense", "this is free and unencumbered software released into the public domain", 9),
]


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(x) if not isinstance(x, list) else str(x) for x in row) + ")" for row in rows)


def license_sql() -> str:
    templates = _values(
        (k, label, need, len(set(text.split())), -(-5 * len(text.split()) // 4)) for k, (label, text, need) in enumerate(NOTICES)
    )
    members = _values((k, word) for k, (_, text, _) in enumerate(NOTICES) for word in sorted(set(text.split())))
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, text, i - 1 AS pos, '{label}' AS label FROM toks, range(1, len(w) + 1) r(i) WHERE "
        + " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))
        for words, label in PHRASES.items()
    )
    return f"""
WITH rows_ AS (SELECT doc_id, text, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
toks AS (SELECT DISTINCT doc_id, text, regexp_extract_all(low, '{WORD}') AS w FROM rows_),
templates(k, label, need, n, span) AS (VALUES {templates}),
members(k, word) AS (VALUES {members}),
spread AS (SELECT doc_id, text, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM toks),
counted AS (
  SELECT doc_id, text, k, count(DISTINCT word) OVER (
           PARTITION BY doc_id, text, k ORDER BY pos RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS c
  FROM spread JOIN members USING (word) JOIN templates USING (k)
),
held AS (SELECT doc_id, text, label, c / n AS score FROM counted JOIN templates USING (k) WHERE c >= need),
base AS ({phrases}),
per_base AS (
  SELECT doc_id, text, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY doc_id, text
),
every AS (
  SELECT doc_id, text, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM (SELECT doc_id, text, label, score FROM held
        UNION ALL SELECT doc_id, text, label, 1.0 FROM base) GROUP BY doc_id, text
)
SELECT r.doc_id, CAST(len(regexp_extract_all(low, '{WORD}')) AS bigint) AS n_words,
       coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS double) AS score
FROM rows_ r
LEFT JOIN per_base b ON r.doc_id = b.doc_id AND r.text IS NOT DISTINCT FROM b.text
LEFT JOIN every e ON r.doc_id = e.doc_id AND r.text IS NOT DISTINCT FROM e.text
"""


#: Both replicas compared record by record.
FIXITY = r"""
WITH records AS (
  SELECT page_id, substr(md5(coalesce(CAST(page_id AS varchar), '')), 1, 2) AS lot,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: '
         || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: ' || coalesce(CAST(page_id AS varchar), '')
         || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
),
hurt AS (
  SELECT *, sha256(record) AS digest,
         CASE lot WHEN '00' THEN 'X' || substr(record, 2) WHEN '02' THEN substr(record, 1, length(record) // 2) ELSE record END AS found
  FROM records
),
placed AS (
  SELECT *, coalesce(sum(strlen(record)) OVER (ORDER BY page_id NULLS FIRST, digest
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM hurt
)
SELECT CAST(place AS bigint) AS "offset", page_id AS record_id, CAST(strlen(record) AS bigint) AS length,
       CASE WHEN lot <> '01' THEN CAST(strlen(found) AS bigint) END AS found_length, digest,
       CASE WHEN lot <> '01' THEN sha256(found) END AS found_digest,
       CASE lot WHEN '01' THEN 'missing' ELSE 'changed' END AS kind
FROM placed WHERE lot IN ('00', '01', '02')
"""


#: Every anchor against every row, no bounds.
HARD_NEGATIVES = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS double))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
         CAST(list_dot_product(a.q, b.q) AS bigint) AS score
  FROM r a JOIN r b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.rid, p.positive_id ORDER BY n.score DESC, n.vec_id) AS integer) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.rid = n.rid AND NOT n.alike
 AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.rid, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
"""


def manifest_sql(levels: int = 7) -> str:
    """Both trees level by level; a tree whose last node is reached stays as it is."""

    def digest(text: str) -> str:
        fields = ("doc_id", "source", "lang", "n_chars", text)
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({x} AS varchar)) || ':' || CAST({x} AS varchar), '-')" for x in fields) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32 of the decimal id: eight shifts for each byte.
    number = "CAST({} AS ubigint)".format
    shifts = f"list_reduce(list_concat([xor(c, b)], [{', '.join([number(0)] * 8)}]), lambda x, y: xor(x >> 1, {number(3988292384)} * (x & 1)))"
    digits = f"list_transform(string_split(CAST(doc_id AS varchar), ''), lambda x: {number('ord(x)')})"
    crc = f"xor({number(4294967295)}, list_reduce(list_concat([{number(4294967295)}], {digits}), lambda c, b: {shifts}))"

    def climb(name: str, group: str) -> str:
        """For each level: every row's node there, its folded form and the siblings so far."""
        out = ""
        for k in range(levels):
            siblings = "array_to_string(hs[: i % 16], '') {} array_to_string(hs[i % 16 + 2 :], '')".format
            out += f""",
{name}{k}g AS (
  SELECT grp, i // 16 AS up, list(h ORDER BY i) AS hs
  FROM (SELECT DISTINCT {group} AS grp, i, h FROM {name}{k} WHERE n > 1) GROUP BY ALL
),
{name}{k + 1} AS (
  SELECT t.doc_id, t.source, t.leaf, t.subroot_, t.whole, CASE WHEN n > 1 THEN i // 16 ELSE i END AS i,
         CASE WHEN n > 1 THEN (n + 15) // 16 ELSE n END AS n,
         CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE h END AS h,
         CASE WHEN n > 1 THEN sha256({siblings("|| f ||")}) ELSE f END AS f,
         CASE WHEN n > 1 THEN proof || {siblings("||")} ELSE proof END AS proof
  FROM {name}{k} t LEFT JOIN {name}{k}g g ON t.n > 1 AND t.{group} IS NOT DISTINCT FROM g.grp AND t.i // 16 = g.up
)"""
        return out

    return f"""
WITH leaves AS (
  SELECT doc_id, source, {digest("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {digest(lowered)} ELSE {digest("text")} END AS bent
  FROM documents
),
s0 AS (
  SELECT doc_id, source, leaf, '' AS subroot_, 1 AS whole,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS n, leaf AS h, bent AS f, '' AS proof
  FROM leaves
){climb("s", "source")},
ranks AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS m
  FROM (SELECT DISTINCT source FROM leaves)
),
t0 AS (
  SELECT doc_id, s.source, leaf, h AS subroot_, 1 AS whole, r AS i, m AS n, h, f, proof
  FROM s{levels} s JOIN ranks k ON s.source IS NOT DISTINCT FROM k.source
){climb("t", "whole")}
SELECT doc_id, leaf, subroot_ AS subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified
FROM t{levels}
"""


#: The text of each page's article element: the given pages mark their main text that way.
ARTICLES = r"""
WITH found AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1) AS article FROM pages
),
parts AS (
  SELECT page_id, url,
         list_transform(
           regexp_split_to_array(regexp_replace(article, '<br[^>]*>', ' ', 'g'), '</?(?:p|h[1-6]|div|ul|ol|li|section|blockquote|table|tr|td|th|pre)(?:\s[^>]*)?>'),
           lambda x: regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&(?:nbsp|#160);', ' ', 'g')) AS pieces
  FROM found
),
blocks AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(pieces, lambda x: trim(regexp_replace(
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(x, '&#39;', chr(39)),
             '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
           '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text
  FROM parts
)
SELECT page_id, url, text, CAST(length(text) AS bigint) AS n_chars FROM blocks
"""
