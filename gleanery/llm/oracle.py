"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from gleanery.llm.partenum import PERCENT, SHINGLE
from gleanery.llm.quality_rules import RULES, STOP_WORDS, SYMBOLS
from gleanery.llm.queries import URL_RULES
from gleanery.llm.repeats import LENGTH

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op4_url_filters() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    return f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {rules}),
rests AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[position('://' IN url) + 3:] END AS rest FROM pages),
parts AS (
  SELECT row_number() OVER () AS row_id, page_id,
    coalesce({LOWER.format("regexp_extract(rest, '^[^/?#]*')")}, '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rests),
fits AS (
  SELECT row_id, max((length(rule_host || rule_path), length(rule_host), rule_host || rule_path, action)) AS best
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row_id)
SELECT page_id, host, path, best[3] AS rule, coalesce(best[4], 'allow') AS verdict FROM parts LEFT JOIN fits USING (row_id)
"""


def op5_substring_dedup() -> str:
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, {WORDS} AS words FROM documents),
windows AS (
  SELECT row_id, unnest(range(1, len(words) - {LENGTH} + 2)) AS start, words FROM docs WHERE len(words) >= {LENGTH}),
texts AS (SELECT row_id, start, md5(array_to_string(words[start:start + {LENGTH} - 1], ' ')) AS content FROM windows),
twice AS (SELECT content FROM texts GROUP BY content HAVING count(*) > 1),
gone AS (SELECT DISTINCT row_id, unnest(range(start, start + {LENGTH})) AS place FROM texts JOIN twice USING (content)),
words AS (SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs),
kept AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (row_id, place) GROUP BY row_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_id)
"""


def op6_exact_topk() -> str:
    return """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 10
"""


def op7_quality_rules() -> str:
    space = r"'[\x20\x09-\x0D]'"
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)

    def fails(base: bool) -> str:
        tests = []
        for r in RULES:
            if r.base or not base:
                tests += [f"{r.measure} < {r.least}"] * (r.least is not None) + [f"{r.measure} > {r.most}"] * (r.most is not None)
        return " OR ".join(tests)

    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, {WORDS} AS words, regexp_replace(coalesce(text, ''), {space}, '', 'g') AS bare,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT row_id, unnest(range(1, len(words) - 1)) AS place, words FROM docs WHERE len(words) >= 3),
runs AS (SELECT row_id, place, count(*) OVER (PARTITION BY row_id, words[place:place + 2]) AS times FROM grams),
repeated AS (
  SELECT row_id, count(DISTINCT p) AS n FROM (SELECT row_id, unnest(range(place, place + 3)) AS p FROM runs WHERE times > 1) GROUP BY row_id),
counts AS (
  SELECT doc_id, len(words) AS n_words, length(bare) AS word_chars,
    length(regexp_replace(bare, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
    length(regexp_replace(bare, '[^A-Z]', '', 'g')) AS n_upper,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: translate(lower(w), '.,;:!?', '') IN ({stop}))) AS n_stop_words
  FROM docs LEFT JOIN repeated USING (row_id)),
ratios AS (
  SELECT *, coalesce(n_repeat_words * 100 / n_words, 0) AS repeat_percent, coalesce(word_chars / n_words, 0) AS mean_word_length,
    coalesce(n_symbols * 100 / word_chars, 0) AS symbol_percent, coalesce(n_stop_words * 100 / n_words, 0) AS stop_word_percent,
    coalesce(n_upper * 100 / word_chars, 0) AS upper_percent, coalesce(n_dup_lines * 100 / n_lines, 0) AS dup_line_percent
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({fails(True)}) AS base_failed, NOT ({fails(False)}) AS kept
FROM ratios
"""


def op9_jaccard_join() -> str:
    words = WORDS.replace("coalesce(text, '')", LOWER.format("coalesce(text, '')"))
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, {words} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - {SHINGLE - 2}))) AS i FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= {PERCENT} * (x.n + y.n - c.n)),
reach(doc_id, other) AS (
  SELECT DISTINCT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) e ON r.other = e.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.other) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY ALL
"""


def op13_hard_negatives() -> str:
    return """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
    CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same
WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


def registered() -> dict[str, str]:
    return {name: f() for name, f in globals().items() if name.startswith("op")}
