"""DuckDB twins of the operators' queries that SQL can express. The others
(trained models, random draws, regular-expression positions, tokenizer ids) are
tested against brute force in ``tests/llm``."""

from __future__ import annotations

import string

from .chat import ESCAPE, Template

ORACLE: dict[str, str] = {}

# Smallest node reachable from each node over the links (x, y), both ways.
_REACH = """
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(node, other) AS (SELECT DISTINCT x, x FROM both_ways
  UNION SELECT reach.node, both_ways.y FROM reach JOIN both_ways ON reach.other = both_ways.x),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

ORACLE["op2_sorted_projection_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
    ON a.vec_id < b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
),{_REACH},
deg AS (SELECT x AS node, count(*) AS n FROM both_ways GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM v LEFT JOIN least ON vec_id = least.node LEFT JOIN deg ON vec_id = deg.node
""".strip()


def _escaped(col: str) -> str:
    out = f"replace({col}, '{ESCAPE}', '{ESCAPE * 2}')"
    for c in Template().control:
        out = f"replace({out}, '{c}', '{c[0]}{ESCAPE}{c[1:]}')"
    return out


_T = Template()
ORACLE["op3_schema_fingerprint_chat"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length({_escaped('role')}) + length({_escaped('text')}) + {len(_T.open) + len(_T.mid) + len(_T.close)}) AS n
  FROM c GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM g
""".strip()

ORACLE["op6_minmax_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM shared JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * c >= 80 * (p.n + q.n - c)
),{_REACH}
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least ON w.doc_id = least.node
""".strip()

# CRC-32 byte by byte with its table; near words by the holes that edits leave.
ORACLE["op11_permuterm_variants"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL
),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(d || ':' || run, ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, (unicode(c) - 64)::BIGINT] END))),
           lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]))) AS h
  FROM runs, crc_table
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
holes AS (SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT DISTINCT x.word, y.word AS other, y.n AS other_n FROM holes x JOIN holes y ON x.a || '?' || x.b = y.a || '?' || y.b AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM holes x JOIN words w ON x.a || x.b = w.word
  UNION SELECT w.word, x.word, x.n FROM holes x JOIN words w ON x.a || x.b = w.word
),
near AS (SELECT word, count(*) AS n_near FROM pairs GROUP BY word),
best AS (SELECT word, other, other_n FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN near USING (word) LEFT JOIN best USING (word)
),
walk AS (
  SELECT word, coalesce(form, word) AS here FROM forms
  UNION ALL
  SELECT walk.word, forms.form FROM walk JOIN forms ON walk.here = forms.word WHERE forms.form IS NOT NULL
),
ends AS (SELECT walk.word, here AS root FROM walk JOIN forms ON walk.here = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
""".strip()
