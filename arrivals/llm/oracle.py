"""DuckDB SQL for the llm queries that SQL can express."""

from __future__ import annotations

from arrivals.llm.quality import BOILERPLATE, NAVIGATION

_WORD = r"[^\x20\x09-\x0D]+"


def _contains_any(text: str, phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in phrases) + ")"


# The judged lines of every document; `t` must hold doc_id, text (not null) and a row number.
_QUALITY = rf"""
lines AS (
  SELECT rid, pos, line, len(regexp_extract_all(line, '{_WORD}')) AS n, lower(line) AS low,
    length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line,
          unnest(range(len(string_split(text, chr(10))))) AS pos FROM t)
),
judged AS (
  SELECT *, n > 0 AND (
    (n < 6 AND NOT regexp_matches(line, '[.!?:;…][''")\]”»]*[ \t\r]*$'))
    OR length(regexp_replace(line, '[^!?]', '', 'g')) > 0.5 * n
    OR length(regexp_replace(line, '[^|>]', '', 'g')) >= 2
    OR {_contains_any("low", NAVIGATION)} OR {_contains_any("low", BOILERPLATE)}) AS fails
  FROM lines
),
per_line AS (
  SELECT rid, CAST(sum(n) AS BIGINT) AS n_words, CAST(sum(chars) AS BIGINT) AS word_chars,
    CAST(coalesce(sum(chars) FILTER (NOT fails), 0) AS BIGINT) AS kept_chars,
    CAST(count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS BIGINT) AS n_dup_lines,
    string_agg(line, chr(10) ORDER BY pos) FILTER (NOT fails) AS cleaned_text
  FROM judged GROUP BY rid
),
tokens AS (
  SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i
  FROM (SELECT rid, regexp_extract_all(text, '{_WORD}') AS w FROM t)
),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w0, w1, w2) AS c FROM (
    SELECT rid, i, word AS w0, lead(word, 1) OVER (PARTITION BY rid ORDER BY i) AS w1,
      lead(word, 2) OVER (PARTITION BY rid ORDER BY i) AS w2 FROM tokens) WHERE w2 IS NOT NULL
),
covered AS (
  SELECT rid, CAST(count(DISTINCT i) AS BIGINT) AS n_repeat_words
  FROM (SELECT rid, i + unnest([0, 1, 2]) AS i FROM windows WHERE c > 1) GROUP BY rid
),
stats AS (
  SELECT t.*, p.n_words, p.word_chars, p.kept_chars, p.n_dup_lines, p.cleaned_text,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(c.n_repeat_words, 0) AS n_repeat_words,
    p.n_words < 50 OR coalesce(c.n_repeat_words, 0) > 0.5 * p.n_words AS base_failed
  FROM t JOIN per_line p USING (rid) LEFT JOIN covered c USING (rid)
),
quality AS (
  SELECT *, NOT base_failed AND word_chars - kept_chars <= 0.5 * word_chars AS kept FROM stats
)"""



def _correction(i: int) -> str:
    """One word correction of the rounded cells r{i} into r{i+1}."""
    return f"""
o{i} AS (SELECT *, sum((share * n - extra) * size) OVER (PARTITION BY source) AS off_by FROM r{i}),
b{i} AS (SELECT *, max(size) FILTER (size > 0 AND size <= abs(off_by)
    AND CASE WHEN off_by > 0 THEN extra < n ELSE extra > 0 END) OVER (PARTITION BY source) AS best FROM o{i}),
r{i + 1} AS (SELECT * EXCLUDE (off_by, best, extra),
    extra + CASE WHEN size = best THEN CAST(sign(off_by) AS BIGINT) ELSE 0 END AS extra FROM b{i}),"""


_MIXING = f"""
sized AS (SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM docs),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS s_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3.0::DOUBLE * s_size AS cap
  FROM by_source
),
levels AS (
  SELECT *, cap <= weight
      * (sum(s_size) OVER () - coalesce(sum(cap) OVER before, 0.0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS capped
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, s_size, CASE WHEN capped THEN cap ELSE weight * (
      (sum(s_size) OVER () - coalesce(sum(cap) FILTER (capped) OVER (), 0.0))
      / sum(weight) FILTER (NOT capped) OVER ()) END AS target
  FROM levels
),
rates AS (SELECT *, CASE WHEN target > 0 THEN round(target / s_size, 9) ELSE 0.0 END AS rate FROM targets),
r0 AS (
  SELECT *, upto - coalesce(lag(upto) OVER (PARTITION BY source ORDER BY size DESC), 0) AS extra FROM (
    SELECT *, CAST(floor(share * (sum(n) OVER (PARTITION BY source ORDER BY size DESC)) + 0.5) AS BIGINT) AS upto
    FROM (SELECT c.*, r.s_size, r.target, r.rate, r.rate - floor(r.rate) AS share
          FROM (SELECT source, size, count(*) AS n FROM sized GROUP BY ALL) c
          JOIN rates r ON c.source IS NOT DISTINCT FROM r.source))
),
{"".join(_correction(i) for i in range(4))}
mixed AS (
  SELECT d.*, r.s_size, r.target, CASE WHEN d.size = 0 THEN 0 ELSE CAST(floor(r.rate) AS BIGINT)
    + CAST(row_number() OVER (PARTITION BY d.source, d.size
        ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) <= r.extra AS BIGINT) END AS copies
  FROM sized d JOIN r4 r ON d.source IS NOT DISTINCT FROM r.source AND d.size = r.size
)"""

# CRC-32 of the decimal conv_id, bit by bit: only its two low bits are used.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

# A node is named by its depth and the concatenated digests of its turns, so a prefix of a name is an ancestor.
_TRIE = rf"""
WITH own AS (
  SELECT conv_id, digest, n_words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n_words,
          sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations)
  WHERE conv_id IS NOT NULL
),
turns AS (
  SELECT c.conv_id, o.digest, o.n_words, 0 AS part, o.pos FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, o.digest, o.n_words, 1, o.pos FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS name, n_words FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
),
nodes AS (
  SELECT depth, name, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_words) AS n_words FROM prefixes GROUP BY ALL
),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.name AS parent FROM nodes n
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.name = left(n.name, 64 * (CAST(n.depth AS INTEGER) - 1)) AND n.depth > 0
),
children AS (SELECT depth - 1 AS depth, parent AS name, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
sized AS (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c USING (depth, name)
),
amounts AS (
  SELECT a.depth, a.name, count(*) FILTER (d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.n_words) AS saved_tokens
  FROM sized a JOIN sized d ON starts_with(d.name, a.name) GROUP BY ALL
),
lengths AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY ALL),
ends AS (
  SELECT p.depth, p.name, sha256(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id)) AS ends_sha256
  FROM prefixes p JOIN lengths USING (conv_id, depth) GROUP BY ALL
)
SELECT s.conv_id, s.depth, s.parent_conv_id, s.n_convs, s.n_children, a.n_leaves,
  CAST(a.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM sized s JOIN amounts a USING (depth, name) LEFT JOIN ends e USING (depth, name)"""

ORACLE_SQL: dict[str, str] = {
    "op8_quality_rules": f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
{_QUALITY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM quality""",
    "op9_mixing": f"""
WITH docs AS (SELECT * FROM documents), {_MIXING}
SELECT doc_id, size, s_size AS source_size, target, copies * size AS taken FROM mixed""",
    "op13_prefix_trie": _TRIE,
}
