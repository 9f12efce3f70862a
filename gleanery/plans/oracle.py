"""SQL twins of the registered queries, written for another engine and on their own terms."""

from __future__ import annotations

from gleanery.plans.queries import (
    AS_OF, BLOCK, BUCKETS, HOUR, LINK_RULE, MORE, NEEDLE, NEEDLES, NEXT, PAGE_RULE, QUERIES, SITE, SPLIT,
)

TOKENS = r"regexp_extract_all(lower(replace({}, '\"', '')), '[\p{{L}}\p{{N}}]+')".replace('\\"', '"')
WORDS = r"regexp_extract_all(text, '[^\s\x0B\x1c-\x1f\x{85}\p{Z}]+')"
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

POSTINGS = f"""
tf AS (
  SELECT term, url, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT CAST(doc_id AS VARCHAR) AS url, unnest({TOKENS.format('text')}) AS term FROM documents)
  GROUP BY term, url),
df AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
size AS (SELECT count(*) AS docs FROM documents),
postings AS (
  SELECT term, url, tf, df, tf * ln(CAST(docs AS DOUBLE) / (1 + df)) AS tfidf
  FROM tf JOIN df USING (term), size)"""

ALL_POSTINGS = f"WITH {POSTINGS} SELECT term, url, tf, df, round(tfidf, 6) AS tfidf FROM postings"


def _asked() -> str:
    rows = ", ".join("({}, '{}')".format(i, q.replace("'", "''")) for i, q in QUERIES)
    return f"asked(query_id, query) AS (VALUES {rows})"


TERMS = f"""
counts AS (
  SELECT word, count(*) AS n
  FROM (SELECT unnest({WORDS}) AS word FROM conversations WHERE role = 'user') GROUP BY word),
asked AS (
  SELECT query_id, word AS query
  FROM (SELECT row_number() OVER (ORDER BY n DESC, word) AS query_id, word FROM counts)
  WHERE query_id <= 100)"""


def _results(asked: str) -> str:
    return f"""
{asked},
{POSTINGS},
wanted AS (
  SELECT query_id, unnest(terms) AS term, len(terms) AS n
  FROM (SELECT query_id, list_distinct({TOKENS.format('query')}) AS terms FROM asked)),
results AS (
  SELECT CAST(query_id AS BIGINT) AS query_id,
         CASE WHEN count(*) = max(n) THEN 'exact' ELSE 'partial' END AS match_kind,
         url, sum(tfidf) AS score, string_agg(term, ',' ORDER BY term) AS tokens
  FROM wanted JOIN postings USING (term) GROUP BY query_id, url),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id, match_kind ORDER BY round(score, 9) DESC, url) AS rank
  FROM results)"""


def _search(asked: str, where: str = "TRUE") -> str:
    return f"""WITH {_results(asked)}
SELECT query_id, match_kind, url, round(score, 6) AS score, tokens FROM results WHERE {where}"""


TOP10 = f"""WITH {_results(_asked())}
SELECT query_id, match_kind, url, round(score, 6) AS score, tokens, rank FROM ranked WHERE rank <= 10"""

RESPONSE = f"""WITH {_results(_asked())},
parts AS (
  SELECT query_id, CASE WHEN rank > 10 THEN 'more_' ELSE '' END || match_kind AS section,
         CAST(CASE WHEN rank > 10 THEN (rank - 11) // {MORE} ELSE 0 END AS BIGINT) AS page, rank, url
  FROM ranked)
SELECT query_id, section, page, CAST(count(*) AS BIGINT) AS n,
       string_agg(url, ',' ORDER BY rank) AS urls, '' AS note
FROM parts GROUP BY query_id, section, page
UNION ALL
SELECT CAST(query_id AS BIGINT), CASE WHEN trim(query) = '' THEN 'error' ELSE 'message' END, 0, 0, '',
       CASE WHEN trim(query) = '' THEN 'Empty query' ELSE 'No results found' END
FROM asked WHERE query_id NOT IN (SELECT query_id FROM results)"""


# A response as JSON: empty parts are left out, tokens are letters and digits.
RESPONSE_JSON = f"""WITH {_results(_asked())},
parts AS (
  SELECT query_id, CASE WHEN rank > 10 THEN 'more_' ELSE '' END || match_kind AS section,
    CAST(CASE WHEN rank > 10 THEN (rank - 11) // {MORE} ELSE 0 END AS BIGINT) AS page, rank,
    format('{{{{"rank":{{}},"url":"{{}}","score":"{{:.4f}}","tokens":["{{}}"]}}}}', rank, url, score, replace(tokens, ',', '","')) AS entry
  FROM ranked),
bodies AS (
  SELECT query_id, section, page, '"entries":[' || string_agg(entry, ',' ORDER BY rank) || ']' AS rest FROM parts GROUP BY query_id, section, page
  UNION ALL
  SELECT CAST(query_id AS BIGINT), CASE WHEN trim(query) = '' THEN 'error' ELSE 'message' END, 0,
    CASE WHEN trim(query) = '' THEN '"note":"Empty query"' ELSE '"note":"No results found"' END
  FROM asked WHERE query_id NOT IN (SELECT query_id FROM results))
SELECT query_id, section, page, '{{"section":"' || section || '","page":' || page || ',' || rest || '}}' AS body FROM bodies"""


def canonical(url: str) -> str:
    """SQL for the canonical form of an absolute URL whose query needs no percent coding."""
    host = rf"lower(regexp_extract({url}, '^([a-zA-Z]+://[^/?#]*)', 1))"
    path = rf"rtrim(regexp_extract({url}, '^[a-zA-Z]+://[^/?#]*([^?#;]*)', 1), '/')"
    pairs = rf"string_split(regexp_extract({url}, '^[^?#]*\?([^#]*)', 1), '&')"
    kept = rf"list_filter({pairs}, lambda p: regexp_matches(p, '^[^=]*=.') AND NOT starts_with(p, 'utm_'))"
    query = f"array_to_string({kept}, '&')"
    return f"({host} || {path} || CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END)"


VISIBLE = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', chr(64976), 'g')"
LINKS = rf"""
hrefs AS (
  SELECT page_id, url AS src,
         unnest(regexp_extract_all({VISIBLE}, '(?is)<a\s[^>]*?href="([^"]*)"', 1)) AS href
  FROM pages),
targets AS (
  SELECT page_id, src, regexp_extract(src, '^([a-zA-Z]+://[^/?#]*)', 1) || href AS target FROM hrefs),
links AS (SELECT DISTINCT page_id, src, {canonical('target')} AS dst FROM targets),
known AS (SELECT {canonical('url')} AS url FROM pages)"""


def _plain(text: str) -> str:
    for name, sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{sign}')"
    return text


CONTENT = rf"""
WITH pieces AS (
  SELECT url, string_split({_plain(f"regexp_replace({VISIBLE}, '<[a-zA-Z/!][^>]*>', chr(64976), 'g')")},
                           chr(64976)) AS parts
  FROM pages)
SELECT url, regexp_replace(array_to_string(list_filter(list_transform(
         parts, lambda p: regexp_replace(p, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), lambda p: p <> ''), ' ') || ' ',
         '[\r\n]', ' ', 'g') AS content
FROM pieces"""


def _allowed(url: str, rule) -> str:
    keys = "|".join(rule.blocked_params)
    rest = f"regexp_extract({url}, '^[a-zA-Z]+://[^/?#]*([^?#;]*)', 1)"
    return rf"""(regexp_matches({url}, '^[a-zA-Z]+://[^/?#]*{rule.domain}([/?#]|$)')
      AND starts_with({rest}, '{rule.path_prefix}') AND NOT contains({rest}, ':')
      AND NOT regexp_matches({url}, '^[^?#]*\?([^#]*&)?({keys})=[^&#]'))"""


def _offers(offers: str) -> str:
    return f"""WITH {LINKS}, offers AS ({offers})
SELECT url, CAST(CASE WHEN NOT {_allowed('url', LINK_RULE)} THEN 0
                      WHEN url IN (SELECT url FROM known) THEN -1 ELSE 1 END AS BIGINT) AS status,
       CAST(count(*) AS BIGINT) AS offers
FROM offers GROUP BY url"""


LOG = """
log AS (
  SELECT ts, event_id AS seq, CAST(user_id AS VARCHAR) AS url,
         CASE event_type WHEN 'signup' THEN 'enqueue' WHEN 'view' THEN 'dispatch' WHEN 'click' THEN 'complete' END AS kind
  FROM events WHERE event_type IN ('signup', 'view', 'click'))"""

WINDOWS = f"""{LOG},
numbered AS (SELECT epoch_us(ts) // {HOUR * 1_000_000} AS id, kind FROM log),
span AS (SELECT min(id) AS a, max(id) AS b FROM numbered),
windows AS (SELECT unnest(generate_series(a, b)) AS id FROM span),
per_window AS (
  SELECT w.id, {STAMP.format(f'make_timestamp(w.id * {HOUR * 1_000_000})')} AS window_start,
         CAST(coalesce(sum(CASE kind WHEN 'complete' THEN 1 END), 0) AS BIGINT) AS completed,
         coalesce(sum(CASE kind WHEN 'enqueue' THEN 1 WHEN 'dispatch' THEN -1 END), 0) AS change
  FROM windows w LEFT JOIN numbered USING (id) GROUP BY w.id),
lengths AS (
  SELECT window_start, completed, CAST(sum(change) OVER (ORDER BY id) AS BIGINT) AS queue_length
  FROM per_window)"""


def _in_flight(as_of: str) -> str:
    return f"""WITH {LOG},
moves AS (
  SELECT url, kind, ts, row_number() OVER (PARTITION BY url ORDER BY ts DESC, seq DESC) AS back
  FROM log WHERE kind IN ('dispatch', 'complete'))
SELECT url, {STAMP.format('ts')} AS dispatched_at FROM moves
WHERE back = 1 AND kind = 'dispatch' AND ts <= ({as_of}) - INTERVAL {HOUR} SECOND"""


LATEST = f"""
SELECT CAST(user_id AS VARCHAR) AS url, arg_max(props, (ts, props)) AS content,
       {STAMP.format('max(ts)')} AS last_scraped
FROM events WHERE props <> '' GROUP BY user_id"""

# Levels beyond the longest of all shortest ways change nothing: each level repeats what can be reached.
CRAWL = f"""
WITH RECURSIVE items AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
ways AS (
  SELECT '{SITE}/order/' || l_orderkey AS a, '{SITE}/part/' || l_partkey AS b FROM items
  UNION ALL SELECT '{SITE}/part/' || l_partkey, '{SITE}/order/' || l_orderkey FROM items),
reach(url, level) AS (
  SELECT '{SITE}/order/' || min(l_orderkey), 0 FROM lineitem
  UNION SELECT b, level + 1 FROM reach JOIN ways ON url = a WHERE level < 24),
taken AS (SELECT url, min(level) AS level FROM reach GROUP BY url)"""
SCAN = "SELECT CAST(doc_id AS VARCHAR) AS url, text AS content FROM documents"
WORD_COUNTS = f"""
SELECT word, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY word"""


def registered() -> dict[str, str]:
    return {
        "scan_pages": SCAN,
        "tokenize_documents": f"""
SELECT url, CAST(len(tokens) AS BIGINT) AS n_tokens, array_to_string(tokens, ' ') AS tokens
FROM (SELECT CAST(doc_id AS VARCHAR) AS url, {TOKENS.format('text')} AS tokens FROM documents)""",
        "term_frequency": f"WITH {POSTINGS} SELECT term, url, tf FROM tf",
        "document_frequency": f"WITH {POSTINGS} SELECT term, df FROM df",
        "tfidf_postings": ALL_POSTINGS,
        "inverted_index": f"""WITH {POSTINGS},
placed AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY term ORDER BY url) - 1) // {BLOCK} AS BIGINT) AS block
  FROM postings)
SELECT term, block, CAST(count(*) AS BIGINT) AS n, string_agg(url, ',' ORDER BY url) AS urls,
       string_agg(CAST(CAST(round(tfidf * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY url) AS micros
FROM placed GROUP BY term, block""",
        "index_stats": f"""WITH {POSTINGS}
SELECT CAST(docs AS BIGINT) AS docs_count, (SELECT CAST(count(*) AS BIGINT) FROM df) AS terms_count FROM size""",
        "write_index": ALL_POSTINGS,
        "incremental_index": ALL_POSTINGS,
        "numbered_index": ALL_POSTINGS,
        "incremental_search": _search(_asked()),
        "grep_index": f"""WITH {POSTINGS}
SELECT term, url, tf, df, round(tfidf, 6) AS tfidf FROM postings
QUALIFY max(contains(term, '{NEEDLE}') OR contains(url, '{NEEDLE}')) OVER (PARTITION BY term)""",
        "grep_grams": f"""WITH {POSTINGS}, needles(needle) AS (VALUES {', '.join(f"('{n}')" for n in NEEDLES)}),
hits AS (
  SELECT needle, term FROM postings JOIN needles ON contains(term, needle) OR contains(url, needle) GROUP BY needle, term)
SELECT needle, term, url, tf, df, round(tfidf, 6) AS tfidf FROM postings JOIN hits USING (term)""",
        "ranked_search": _search(_asked()),
        "search_exact": _search(_asked(), "match_kind = 'exact'"),
        "search_partial": _search(_asked(), "match_kind = 'partial'"),
        "search_top10": TOP10,
        "search_top10_bounded": TOP10,
        "search_prompt_view": f"""WITH {_results(_asked())}
SELECT query_id, match_kind, rank, url, format('{{:.4f}}', score) AS shown FROM ranked WHERE rank <= 11""",
        "search_response": RESPONSE,
        "search_response_json": RESPONSE_JSON,
        "batch_terms": f"WITH {TERMS} SELECT CAST(query_id AS BIGINT) AS query_id, query FROM asked",
        "batch_search": _search(TERMS),
        "word_count": WORD_COUNTS,
        "invert_words": f"""WITH pairs AS (
  SELECT DISTINCT CAST(doc_id AS VARCHAR) AS doc_id, word
  FROM (SELECT doc_id, unnest({WORDS}) AS word FROM documents)),
placed AS (
  SELECT word, doc_id, (row_number() OVER (PARTITION BY word ORDER BY doc_id) - 1) // {BLOCK} AS block
  FROM pairs)
SELECT word, CAST(block AS BIGINT) AS block, string_agg(doc_id, ',' ORDER BY doc_id) AS doc_ids
FROM placed GROUP BY word, block""",
        "shard_words": f"""
SELECT CAST(list_sum(list_transform(string_split(word, ''), lambda c: unicode(c))) % {BUCKETS} AS BIGINT) AS bucket, word, count
FROM ({WORD_COUNTS})""",
        "map_reduce": f"""
SELECT substr(word, 1, 1) AS key, CAST(count(*) AS BIGINT) AS words, CAST(max(length(word)) AS BIGINT) AS longest,
       CAST(count(DISTINCT doc_id) AS BIGINT) AS documents
FROM (SELECT doc_id, unnest({WORDS}) AS word FROM documents) GROUP BY 1""",
        "map_reduce_python": f"""
SELECT substr(word, 1, 1) AS key, CAST(sum(length(word)) AS BIGINT) AS value
FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY 1""",
        "map_python": f"""
SELECT substr(word, 1, 1) AS key, CAST(count(*) AS BIGINT) AS words, CAST(sum(length(word)) AS BIGINT) AS letters
FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY 1""",
        "text_corpus": WORD_COUNTS,
        "word_shards": f"""
SELECT CAST(list_sum(list_transform(string_split(word, ''), lambda c: unicode(c))) % {BUCKETS} AS BIGINT) AS bucket,
  CAST(count(*) AS BIGINT) AS words, CAST(sum(count) AS BIGINT) AS occurrences
FROM ({WORD_COUNTS}) GROUP BY 1""",
        "word_preview": f"""
SELECT CAST(count(*) OVER () AS BIGINT) AS total, CAST(row_number() OVER (ORDER BY count DESC, word) AS BIGINT) AS place, word, count
FROM ({WORD_COUNTS}) QUALIFY place <= 5""",
        "normalise_urls": f"SELECT url, {canonical('url')} AS canonical FROM pages",
        "extract_links": f"WITH {LINKS} SELECT src, dst FROM links",
        "dropped_links": f"""WITH {LINKS}
SELECT CAST(count(*) AS BIGINT) AS links, CAST(count(*) FILTER (dst IS NULL) AS BIGINT) AS dropped
FROM (SELECT {canonical('target')} AS dst FROM targets)""",
        "extract_content": CONTENT,
        "admit_urls": f"SELECT url, {_allowed('url', PAGE_RULE)} AS admitted FROM pages",
        "frontier_new": _offers("SELECT dst AS url FROM links UNION ALL SELECT url FROM known"),
        "frontier_expand": f"""WITH {LINKS},
seen AS (SELECT dst FROM links WHERE src LIKE '%/de/%')
SELECT dst AS url, CAST(CASE WHEN NOT {_allowed('dst', LINK_RULE)} THEN 0 WHEN dst IN (SELECT dst FROM seen) THEN -1 ELSE 1 END AS BIGINT) AS status,
  CAST(count(*) AS BIGINT) AS offers
FROM links WHERE src LIKE '%/en/%' GROUP BY dst""",
        "frontier_advance": f"""WITH {LINKS},
offers AS (SELECT dst, CASE WHEN src LIKE '%/en/%' THEN 0 WHEN src LIKE '%/de/%' THEN 1 ELSE 2 END AS batch FROM links)
SELECT dst AS url, CAST(min(batch) AS BIGINT) AS batch FROM offers WHERE {_allowed('dst', LINK_RULE)} GROUP BY dst""",
        "crawl_levels": f"{CRAWL} SELECT url, CAST(level AS BIGINT) AS level FROM taken",
        "crawl_export": f"{CRAWL} SELECT url FROM taken ORDER BY level, url LIMIT 1000",
        "frontier_next_batch": f"""WITH {LOG},
last AS (SELECT url, arg_max(kind, (ts, seq)) AS state, max(ts) AS since FROM log GROUP BY url)
SELECT url, {STAMP.format('since')} AS enqueued_at FROM last WHERE state = 'enqueue'
ORDER BY since DESC, url LIMIT {NEXT}""",
        "recency_gate": f"""WITH {LOG},
ages AS (SELECT url, max(ts) FILTER (kind = 'complete') AS last_scraped FROM log GROUP BY url)
SELECT url, {STAMP.format('last_scraped')} AS last_scraped FROM ages
WHERE last_scraped IS NULL OR last_scraped <= TIMESTAMP '{AS_OF}' - INTERVAL 3600 SECOND""",
        "requeue_inflight": _in_flight(f"TIMESTAMP '{AS_OF}'"),
        "upsert_pages": LATEST,
        "page_store_upserts": LATEST,
        "export_urls": f"""WITH {LINKS},
queued AS (SELECT dst AS url, min(page_id) AS first FROM links GROUP BY dst)
SELECT url FROM queued ORDER BY first, url LIMIT 1000""",
        "completion_rate": f"WITH {WINDOWS} SELECT window_start, completed FROM lengths",
        "queue_length": f"WITH {WINDOWS} SELECT window_start, queue_length FROM lengths",
        "index_metrics": f"""WITH {POSTINGS}
SELECT CAST(docs AS BIGINT) AS docs_count, (SELECT CAST(count(*) AS BIGINT) FROM df) AS terms_count, true AS timed FROM size""",
        "search_metrics": f"WITH {TERMS} SELECT query AS term, true AS timed FROM asked",
        "append_metrics": f"WITH {WINDOWS} SELECT window_start, completed, queue_length FROM lengths",
        "stream_pages": SCAN,
        "stream_seen_urls": f"WITH {LINKS} SELECT DISTINCT dst AS url FROM links",
        "stream_completion_rate": f"WITH {WINDOWS} SELECT window_start, completed FROM lengths WHERE completed > 0",
        "stream_completion_windows": f"WITH {WINDOWS} SELECT window_start, completed FROM lengths",
        "stream_queue_length": f"WITH {WINDOWS} SELECT window_start, queue_length FROM lengths",
        "stream_upsert_pages": LATEST,
        "stream_page_changes": f"""WITH versions AS (
  SELECT CAST(user_id AS VARCHAR) AS url, props AS content, ts, CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 1 ELSE 2 END AS version
  FROM events WHERE props <> ''),
written AS (
  SELECT version, url, arg_max(content, (ts, content)) AS content, max(ts) AS last FROM versions GROUP BY version, url)
SELECT CAST(version AS BIGINT) AS version, url, content, {STAMP.format('last')} AS last_scraped,
  CASE WHEN version = 2 AND url IN (SELECT url FROM written WHERE version = 1) THEN 'changed' ELSE 'new' END AS kind
FROM written""",
        "stream_page_store": LATEST,
        "stream_index_refresh": ALL_POSTINGS,
        "stream_segments": ALL_POSTINGS,
        "stream_requeue": _in_flight(
            "SELECT date_trunc('milliseconds', max(ts)) FROM log WHERE kind IN ('dispatch', 'complete')"
        ),
    }


# The split of page versions into store and batch does not show in the result: the last version wins.
assert SPLIT < AS_OF
