"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from hazardlens.llm.line_rules import LineRules
from hazardlens.llm.urls import VOCABULARY

WORD = r"[^\x20\x09-\x0D]+"


def _term_sum(terms, value) -> str:
    found = [
        f"(CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') THEN {value(weight)} ELSE 0 END)"
        for term, weight in terms
    ]
    return " + ".join(found)


OP1 = """
WITH e AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
)
SELECT q.vec_id AS query_id,
       (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id))::INTEGER AS rank,
       c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
FROM e q JOIN e c ON q.vec_id <> c.vec_id
WHERE q.vec_id % 50 = 0
QUALIFY rank <= 5
"""


def _shared(level: str, path: list[str], weight: str) -> str:
    """One level of the tree: what each node gets of its parent's ``given``."""
    up = ", ".join(path[:-1]) or "1"
    cols = ", ".join(path)
    return f"""
n_{level} AS (
  SELECT {cols}, sum(tokens) * 3 AS capacity, max(given) AS given, {weight} AS weight
  FROM t_{path[-2] if len(path) > 1 else "root"} GROUP BY {cols}
), l_{level} AS (
  SELECT *, given - coalesce(sum(capacity) OVER b, 0) AS remains,
    sum(weight) OVER (PARTITION BY {up}) - coalesce(sum(weight) OVER b, 0) AS weights
  FROM n_{level}
  WINDOW b AS (PARTITION BY {up} ORDER BY capacity::DOUBLE / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f_{level} AS (SELECT *, capacity * weights <= weight * remains AS filled FROM l_{level}),
g_{level} AS (
  SELECT {cols}, CASE WHEN filled THEN capacity ELSE weight * max(remains) FILTER (NOT filled) OVER (PARTITION BY {up})
    // max(weights) FILTER (NOT filled) OVER (PARTITION BY {up}) END AS given
  FROM f_{level}
), t_{level} AS (
  SELECT t.* EXCLUDE (given), g.given FROM t_{path[-2] if len(path) > 1 else "root"} t JOIN g_{level} g USING ({cols})
)"""


OP2 = rf"""
WITH d AS (
  SELECT doc_id, coalesce('domain' || (TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4), '(none)') AS domain,
    coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens
  FROM documents
), r AS (SELECT * FROM d WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM r GROUP BY ALL),
t_root AS (SELECT *, least((SELECT sum(tokens) FROM leaves) * 80 // 100, (SELECT sum(tokens) FROM leaves) * 3) AS given FROM leaves),
{_shared("domain", ["domain"], "CASE domain WHEN 'domain1' THEN 4 WHEN 'domain0' THEN 3 ELSE 1 END")},
{_shared("lang", ["domain", "lang"], "CASE lang WHEN 'en' THEN 5 WHEN 'es' THEN 3 ELSE 1 END")},
{_shared("source", ["domain", "lang", "source"], "1")},
p AS (SELECT domain, lang, source, given // tokens AS k, given % tokens AS rest FROM t_source),
o AS (
  SELECT r.*, k, rest, ('0x' || substr(md5('1:' || k || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS place
  FROM r JOIN p USING (domain, lang, source)
), c AS (
  SELECT *, k + (sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens ROWS UNBOUNDED PRECEDING)
    <= rest)::INTEGER AS copies FROM o
)
SELECT doc_id, domain, lang, source, n_tokens, copies::INTEGER AS copies FROM c WHERE copies > 0
"""

OP3 = rf"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
    coalesce(translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    {_term_sum(VOCABULARY.strict, lambda w: w)} AS strict_weight,
    {_term_sum(VOCABULARY.soft, lambda w: 1)} AS soft,
    {_term_sum(VOCABULARY.soft, lambda w: w)} AS soft_weight
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'example.org/en/1', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN strict_weight >= {VOCABULARY.strict_weight} THEN 'block'
    WHEN soft >= {VOCABULARY.soft_terms} AND soft_weight >= {VOCABULARY.soft_weight} THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

_RULES = LineRules()
_PHRASES = " OR ".join(f"contains(lower(line), '{p}')" for p in _RULES.boilerplate)
_END = _RULES.end_pattern.replace("'", "''")

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, unnest(regexp_extract_all(t, '{WORD}')) AS word, generate_subscripts(regexp_extract_all(t, '{WORD}'), 1) AS i
  FROM d
), v AS (
  SELECT r, i, word, count(*) OVER p AS n, string_agg(word, ' ') OVER p AS win FROM w
  WINDOW p AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), m AS (
  SELECT r, i, word, n = 8 AND count(*) OVER (PARTITION BY r, win, n) > 1 AS hit FROM v
), c AS (
  SELECT r, length(word) AS size, max(CASE WHEN hit THEN i END) OVER (PARTITION BY r ORDER BY i) > i - 8 AS inside FROM m
), words AS (
  SELECT r, count(*) AS n_words, sum(size)::BIGINT AS word_chars, count(*) FILTER (inside) AS n_repeat_words
  FROM c GROUP BY r
), l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
f AS (
  SELECT r, line, regexp_matches(line, '{WORD}') AS worded,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS size,
    regexp_matches(line, '{WORD}') AND (
      {_PHRASES}
      OR length(line) - length(regexp_replace(line, '{_RULES.separator_pattern}', '', 'g')) >= {_RULES.separators}
      OR NOT regexp_matches(line, '{_END}') AND len(regexp_extract_all(line, '{WORD}')) < {_RULES.open_end_words}
    ) AS fails
  FROM l
), lines AS (
  SELECT r, (count(*) FILTER (worded) - count(DISTINCT CASE WHEN worded THEN line END))::BIGINT AS n_dup_lines,
    count(*) FILTER (fails) AS n_lines_removed, coalesce(sum(size) FILTER (fails), 0)::BIGINT AS lost_chars
  FROM f GROUP BY r
), x AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines_removed, lost_chars
  FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND 100 * lost_chars <= {_RULES.lost_percent} * word_chars AND lost_chars < word_chars AS kept,
  n_lines_removed, lost_chars
FROM x
"""

OP4 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{WORD}') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
    THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM d
), n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n k ON k.doc_id = b WHERE 100 * shared >= 80 * (m.size + k.size - shared)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""


def _round(k: int, last: bool) -> str:
    """Assigns every part to the entries of ``b{k}`` and, unless it is the last time, moves them to ``b{k + 1}``."""
    assigned = f"""
a{k} AS MATERIALIZED (
  SELECT x.row, x.part, min((list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, b.v) + list_dot_product(b.v, b.v))::BIGINT * 256
    + b.entry) AS found
  FROM x JOIN b{k} b USING (part) GROUP BY ALL
)"""
    if last:
        return assigned
    return f"""{assigned}, m{k} AS (
  SELECT part, entry, list(c ORDER BY place) AS v FROM (
    SELECT part, found % 256 AS entry, i.place, floor(sum(x.v[i.place]) / count(*)) AS c
    FROM a{k} JOIN x USING (row, part), (SELECT unnest(range(1, 17)) AS place) i GROUP BY ALL
  ) GROUP BY ALL
), b{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m USING (part, entry)
)"""


OP13 = f"""
WITH e AS MATERIALIZED (
  SELECT vec_id, label, v, row_number() OVER (ORDER BY vec_id, v) - 1 AS row FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  )
), x AS MATERIALIZED (
  SELECT row, p.part, e.v[16 * p.part + 1:16 * p.part + 16] AS v FROM e, (SELECT unnest(range(4)) AS part) p
), b0 AS MATERIALIZED (SELECT part, row AS entry, v FROM x WHERE row < 256),
{", ".join(_round(k, k == 4) for k in range(5))}, c AS (
  SELECT row, string_agg(printf('%02x', found % 256), '' ORDER BY part) AS code, sum(found // 256)::BIGINT AS error FROM a4 GROUP BY row
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) FROM b4)
    AS codebooks_sha256
FROM e JOIN c USING (row)
"""


SPACE = r"[\x20\x09-\x0D]"

# states: 0 nothing kept, 1 after a system turn, 2 after a user turn, 3 after an assistant turn
OP11 = rf"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), c AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS dealt FROM d
), t AS (
  SELECT conv_id, turn, CASE WHEN dealt = 4 THEN 'user' ELSE role END AS role,
    CASE dealt WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE dealt WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM c
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i FROM t
), f AS (
  SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_matches(text, '[.!?]{SPACE}*$') THEN 'sound' ELSE 'truncated' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o
), n AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
), ins AS (
  SELECT * FROM (VALUES (0, 0, 0, '', []), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
    (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
    (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])) v(s, m, paid, l, lines)
), s AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM n
  UNION ALL
  SELECT conv_id, i, s, cost, audit, lines FROM (
    SELECT s.conv_id, f.i, CASE e.l WHEN 'D' THEN ins.m WHEN 'K' THEN CASE f.r WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
        ELSE CASE ins.m WHEN 2 THEN 3 ELSE 2 END END AS s,
      s.cost + ins.paid + CASE e.l WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END
        + CASE WHEN e.l <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
      s.audit || ins.l || e.l AS audit,
      list_concat(s.lines, ins.lines::VARCHAR[], CASE e.l WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
        ELSE [CASE ins.m WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text] END) AS lines
    FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1 JOIN ins ON ins.s = s.s,
      (VALUES ('D'), ('K'), ('R')) e(l)
    WHERE e.l = 'D' OR f.fault IN ('sound', 'truncated') AND (e.l = 'R' OR f.r = 's' AND ins.m = 0
      OR f.r = 'u' AND ins.m <> 2 OR f.r = 'a' AND ins.m = 2)
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) = 1
), e AS (
  SELECT s.conv_id, s.cost + ins.paid AS cost, s.audit || ins.l AS audit, list_concat(s.lines, ins.lines::VARCHAR[]) AS lines
  FROM s JOIN n ON n.conv_id IS NOT DISTINCT FROM s.conv_id AND n.n = s.i JOIN ins ON ins.s = s.s WHERE ins.m IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost + ins.paid, s.audit || ins.l) = 1
)
SELECT a.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
  coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
  coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
  LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLE = {
    "op1_topk_search": OP1,
    "op2_mixing": OP2,
    "op3_url_filter": OP3,
    "op4_minhash_dedup": OP4,
    "op9_line_rules": OP9,
    "op11_conversation_repair": OP11,
    "op13_vector_codes": OP13,
}
