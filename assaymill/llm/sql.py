"""DuckDB SQL for the rows of the queries that SQL can express over whole tables.

Left out, and tested by brute force instead: op7 (a trained model), op9 (a tokenizer), op10
(leftmost matches with code-point positions); op3 (HTML) likewise.
"""

from __future__ import annotations

from .queries import DOMAIN, WEIGHTS

_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _words(column: str) -> str:
    return _WORDS.format(f"coalesce({column}, '')")


OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS grams FROM w),
g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.grams) + len(y.grams) - n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, cast(len(s.grams) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
"""

OP2 = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
n AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM l),
p AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos,
        len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n_words
      FROM n WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
r AS (SELECT *, lead(line, 1) OVER d AS l1, lead(line, 2) OVER d AS l2 FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
t AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line, l1, l2 ORDER BY doc_id, pos) AS nth FROM r WHERE l2 IS NOT NULL),
o AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth FROM p WHERE n_words >= 20),
gone AS (SELECT doc_id, pos + k AS pos FROM t, (VALUES (0), (1), (2)) AS v(k) WHERE nth > 1
         UNION SELECT doc_id, pos FROM o WHERE nth > 1),
g AS (SELECT p.doc_id, p.i FROM gone JOIN p USING (doc_id, pos)),
kept AS (SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.i) AS text FROM n ANTI JOIN g USING (doc_id, i) GROUP BY n.doc_id)
SELECT l.doc_id, (SELECT count(*) FROM p WHERE p.doc_id = l.doc_id) AS n_lines,
  (SELECT count(*) FROM g WHERE g.doc_id = l.doc_id) AS n_removed,
  cast(CASE WHEN l.text IS NULL THEN NULL ELSE length(coalesce(kept.text, '')) END AS BIGINT) AS n_chars,
  CASE WHEN l.text IS NULL THEN NULL ELSE sha256(coalesce(kept.text, '')) END AS text_sha256
FROM l LEFT JOIN kept ON kept.doc_id = l.doc_id
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, unnest(list_transform(range(1, len(ws) - 3),
          lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM d WHERE len(ws) >= 5),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, range(0, 5) AS v(k) GROUP BY doc_id),
norm AS (SELECT doc_id, source, md5(text) AS copy, trim(regexp_replace(regexp_replace(lower(s), '[0-9]', '0', 'g'),
           '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS line FROM (SELECT doc_id, source, text, unnest(ls) AS s FROM d)),
sizes AS (SELECT source, count(DISTINCT md5(text)) AS n FROM d GROUP BY source),
freq AS (SELECT f.source, f.line FROM (SELECT source, line, count(DISTINCT copy) AS n FROM norm GROUP BY ALL) f
  JOIN sizes z ON f.source IS NOT DISTINCT FROM z.source WHERE f.n >= 10 AND f.n * 100 > z.n),
gone AS (SELECT x.doc_id, count(*) AS n_lines, sum(len(string_split(x.line, ' '))) AS n FROM norm x
  JOIN freq f ON x.line = f.line AND x.source IS NOT DISTINCT FROM f.source GROUP BY x.doc_id),
r AS (SELECT d.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n_lines, 0) AS n_lines_removed,
  cast(len(ws) - coalesce(gone.n, 0) AS BIGINT) AS n_words_left
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed,
  NOT (n_words < 10 OR n_repeat_words * 100 > n_words * 20 OR n_words_left < 10 OR n_words_left * 100 < n_words * 50) AS kept
FROM r
"""

OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def _case(level: str) -> str:
    known = " ".join(f"WHEN {level} = '{name}' THEN {w}" for name, w in WEIGHTS[level].items())
    return f"CASE {known} ELSE 1 END" if known else "1"


def _level(depth: int) -> str:
    """One level of the tree: its nodes, and the share of the family's budget each one gets."""
    levels = ("domain", "language", "source")
    path, parents, level = ", ".join(levels[:depth + 1]), levels[:depth], levels[depth]
    family = f"PARTITION BY {', '.join(parents) or '0'}"
    above = (f"JOIN (SELECT {', '.join(parents)}, budget AS fb FROM b{depth - 1}) USING ({', '.join(parents)})" if depth
             else "CROSS JOIN (SELECT sum(tokens) * 80 // 100 AS fb FROM leaves)")
    return f"""
n{depth} AS (SELECT * FROM (SELECT {path}, cast(sum(tokens) AS HUGEINT) AS tokens, sum(tokens) * 2 AS capacity, {_case(level)} AS weight
  FROM leaves GROUP BY {path}) {above}),
o{depth} AS (SELECT *, coalesce(sum(capacity) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
  sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS opn, row_number() OVER f AS place
  FROM n{depth} WHERE weight > 0 WINDOW f AS ({family} ORDER BY capacity / weight, {level})),
f{depth} AS (SELECT *, min(CASE WHEN capacity * opn > weight * (fb - used) THEN place END) OVER ({family}) AS short FROM o{depth}),
b{depth} AS (SELECT {path}, tokens, CASE WHEN short IS NULL OR place < short THEN capacity ELSE weight
  * max(CASE WHEN place = short THEN fb - used END) OVER ({family}) // max(CASE WHEN place = short THEN opn END) OVER ({family}) END AS budget
  FROM f{depth})"""


OP6 = f"""
WITH d AS (SELECT doc_id, {DOMAIN} AS domain,
  lang AS language, source, len({_words("text")}) AS tokens FROM documents),
leaves AS (SELECT domain, language, source, sum(tokens) AS tokens FROM d GROUP BY ALL),
{_level(0)},{_level(1)},{_level(2)},
e AS (SELECT domain, language, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS full_epochs,
  CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM b2),
last AS (SELECT d.*, full_epochs, rest, coalesce(sum(tokens) OVER (PARTITION BY domain, language, source
  ORDER BY md5('1:' || full_epochs || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN e USING (domain, language, source))
SELECT doc_id, domain, language, source, tokens, cast(unnest(range(0, cast(full_epochs AS BIGINT))) AS INTEGER) AS epoch FROM last
UNION ALL
SELECT doc_id, domain, language, source, tokens, cast(full_epochs AS INTEGER) FROM last WHERE start < rest
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {_words("text")} AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, unnest(list_transform(range(1, len(ws) - 18),
        lambda i: md5(array_to_string(ws[i:i + 19], ' ')))) AS g FROM d WHERE len(ws) >= 20),
later AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(0, 20) AS v(k)),
every AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM every ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, cast(len(ws) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": OP1, "op2_line_dedup": OP2, "op4_line_frequency": OP4, "op5_topk": OP5, "op6_mixing": OP6, "op8_superkmers": OP8,
}
