"""What the registered queries return, stated in DuckDB SQL."""

from __future__ import annotations

from lexigrove.functions.text import DANGLING, NOT_SPACE, REPEATABLE, SPACE, STOPWORDS, SUFFIXES
from lexigrove.operators.retrieval import FUSION, K1, PROFILES, B
from lexigrove.plans import books
from lexigrove.plans.documents import SQL


def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _stem(t: str) -> str:
    rest = " ".join(f"WHEN length({t}) > {len(s) + 2} AND ends_with({t}, '{s}') THEN substr({t}, 1, length({t}) - {len(s)})" for s in SUFFIXES)
    return f"CASE WHEN length({t}) > 5 AND ends_with({t}, 'ies') THEN substr({t}, 1, length({t}) - 3) || 'y' {rest} ELSE {t} END"


def _terms(text: str) -> str:
    words = f"regexp_extract_all(lower({text}), '[a-z0-9]+')"
    return f"list_filter(list_transform({words}, lambda t: {_stem('t')}), lambda t: length(t) > 1 AND t NOT IN ({_in(STOPWORDS)}))"


def _grams(text: str) -> str:
    padded = f"(' ' || trim(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g')) || ' ')"
    # a lambda's variable holds the text, so it is cleaned once
    parts = " || ".join(f"list_transform(range(1, length(p) - {n} + 2), lambda i: substr(p, i, {n}))" for n in (3, 4, 5))
    return f"list_transform([{padded}], lambda p: CASE WHEN trim(p) = '' THEN []::VARCHAR[] ELSE list_filter({parts}, lambda g: trim(g) <> '') END)[1]"


_SQUEEZE = lambda x: f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"
_TOKENS = lambda x: f"length(regexp_extract_all({x}, '{NOT_SPACE}'))"
_FIRST = "split_part(text, chr(10), 1)"
_HTML = _SQUEEZE("regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'gis'), '<[^>]*>', ' ', 'gs'), ' +', ' ', 'g')")
_TITLE = _SQUEEZE("regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is'), '<[^>]*>', ' ', 'gs')")


def _slug(x: str) -> str:
    plain = f"lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g'))"
    core = f"regexp_replace(regexp_replace({plain}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"CASE WHEN {core} = '' THEN 'item' ELSE {core} END"


def _long(source: str, key: str, fields: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT {key} AS doc_id, '{name}' AS field, coalesce({text}, '') AS text FROM {source}" for name, text in fields.items())


_BODY = _long("documents", "doc_id", {"body": "text"})
_FIELDS = _long("documents", "doc_id", {"title": _FIRST, "context": "source", "path": "lang", "body": "text"})
_PAGES = _long("pages", "page_id", {"title": _TITLE, "path": "url", "body": _HTML})


def _weights(profile: str) -> str:
    return "CASE field " + " ".join(f"WHEN '{f}' THEN {w}" for f, w in PROFILES[profile].items()) + " ELSE 0 END"


def _bm25(name: str, corpus: str, profile: str) -> str:
    """Common table expressions that end in `name` (probe_id, doc_id, score)."""
    n = name
    return f"""
{n}_tok AS MATERIALIZED (SELECT doc_id, field, {_terms('text')} AS terms FROM ({corpus})),
{n}_post AS (SELECT doc_id, field, len(terms) AS n_terms, unnest(terms) AS term FROM {n}_tok),
{n}_tf AS (SELECT doc_id, field, n_terms, term, count(*) AS tf FROM {n}_post GROUP BY ALL),
{n}_size AS (SELECT field, count(*) AS n_docs, CASE WHEN avg(len(terms)) = 0 THEN 1 ELSE avg(len(terms)) END AS mean_terms FROM {n}_tok GROUP BY field),
{n}_df AS (SELECT field, term, count(*) AS df FROM {n}_tf GROUP BY ALL),
{n}_q AS (SELECT probe_id, term, count(*) AS qtf FROM (SELECT item_id AS probe_id, unnest({_terms('text')}) AS term FROM benchmark) GROUP BY ALL),
{n} AS (SELECT probe_id, doc_id, round(sum(qtf * ln(1.0::DOUBLE + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * {K1 + 1.0}::DOUBLE)
        / (tf + {K1}::DOUBLE * ({1 - B}::DOUBLE + {B}::DOUBLE * n_terms / mean_terms)) * ({_weights(profile)})::DOUBLE), 6) AS score
        FROM {n}_tf JOIN {n}_df USING (field, term) JOIN {n}_size USING (field) JOIN {n}_q USING (term) GROUP BY ALL)"""


def _tfidf(name: str, corpus: str) -> str:
    n = name
    return f"""
{n}_tok AS MATERIALIZED (SELECT doc_id, field, {_grams('text')} AS terms FROM ({corpus})),
{n}_tf AS (SELECT doc_id, field, n_terms, term, count(*) AS tf FROM (SELECT doc_id, field, len(terms) AS n_terms, unnest(terms) AS term FROM {n}_tok) GROUP BY ALL),
{n}_size AS (SELECT field, count(*) AS n_docs FROM {n}_tok GROUP BY field),
{n}_idf AS (SELECT field, term, ln((1.0::DOUBLE + any_value(n_docs)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf FROM {n}_tf JOIN {n}_size USING (field) GROUP BY ALL),
{n}_v AS (SELECT doc_id, field, term, tf::DOUBLE / n_terms * idf AS w FROM {n}_tf JOIN {n}_idf USING (field, term)),
{n}_norm AS (SELECT doc_id, field, sqrt(sum(w * w)) AS norm FROM {n}_v GROUP BY ALL),
{n}_q0 AS (SELECT probe_id, n_query, term, count(*) AS qtf FROM (SELECT probe_id, len(terms) AS n_query, unnest(terms) AS term FROM (SELECT item_id AS probe_id, {_grams('text')} AS terms FROM benchmark)) GROUP BY ALL),
{n}_q AS (SELECT probe_id, field, term, qtf::DOUBLE / n_query * idf AS q FROM {n}_q0 JOIN {n}_idf USING (term)),
{n}_len AS (SELECT probe_id, field, sqrt(sum(q * q)) AS length FROM {n}_q GROUP BY ALL),
{n}_dot AS (SELECT probe_id, doc_id, field, sum(q * w) AS dot FROM {n}_q JOIN {n}_v USING (field, term) GROUP BY ALL),
{n} AS (SELECT probe_id, doc_id, round(sum(({_weights('chargram_tfidf')})::DOUBLE * dot / (norm * length)), 6) AS score
        FROM {n}_dot JOIN {n}_norm USING (doc_id, field) JOIN {n}_len USING (probe_id, field) GROUP BY ALL)"""


def _top(name: str, k: int) -> str:
    return f"SELECT probe_id, doc_id, score, row_number() OVER (PARTITION BY probe_id ORDER BY score DESC, doc_id) AS rank FROM {name} QUALIFY rank <= {k}"


_GOLD = "gold AS (SELECT DISTINCT item_id AS probe_id, doc_id FROM benchmark b JOIN documents d ON b.text <> '' AND contains(d.text, b.text))"


def _metrics(name: str) -> str:
    """Common table expressions that end in `name`_m."""
    n = name
    return f"""
{n}_run AS (SELECT probe_id, doc_id, coalesce(score, 0) AS score, row_number() OVER (PARTITION BY probe_id ORDER BY coalesce(score, 0) DESC, doc_id) AS rank, g
            FROM (SELECT p.probe_id, d.doc_id, score, gold.doc_id IS NOT NULL AS g FROM (SELECT DISTINCT probe_id FROM gold) p CROSS JOIN documents d
                  LEFT JOIN {n} s ON s.probe_id = p.probe_id AND s.doc_id = d.doc_id LEFT JOIN gold ON gold.probe_id = p.probe_id AND gold.doc_id = d.doc_id)),
{n}_best AS (SELECT probe_id, min(rank) FILTER (g) AS best_rank, count(*) FILTER (g) AS n_gold, count(*) FILTER (g AND rank <= 3) AS in_3, count(*) FILTER (g AND rank <= 5) AS in_5,
             max(score) FILTER (g) AS best_gold, max(score) FILTER (NOT g) AS best_other FROM {n}_run GROUP BY ALL),
{n}_m AS (SELECT probe_id, n_gold, best_rank, round(1.0::DOUBLE / best_rank, 4) AS mrr, CASE WHEN best_rank = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS hit_at_1,
          round(in_3::DOUBLE / n_gold, 4) AS recall_at_3, round(in_5::DOUBLE / n_gold, 4) AS recall_at_5, round(best_gold - best_other, 6) AS margin FROM {n}_best)"""


_MEANS = ", ".join(f"round(avg({m}), 4) AS {m}" for m in ("mrr", "hit_at_1", "recall_at_3", "recall_at_5"))
_STATS = "count(*) AS count, min(n_tokens) AS min_tokens, max(n_tokens) AS max_tokens, round(avg(n_tokens), 2) AS mean_tokens, round(quantile_cont(n_tokens, 0.5), 2) AS median_tokens, round(quantile_cont(n_tokens, 0.9), 2) AS p90_tokens"
_COARSE = "list_transform(embedding, lambda x: round(x::DOUBLE, 1))"
_ASKED = "vec_id % 20 = 0"


def _near(vector: str, name: str) -> str:
    return f"""{name}_all AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_dot_product(q.e, v.e), 6) AS score
      FROM (SELECT vec_id, {vector} AS e FROM embeddings WHERE {_ASKED}) q JOIN (SELECT vec_id, {vector} AS e FROM embeddings) v ON q.vec_id <> v.vec_id),
    {name} AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM {name}_all QUALIFY rank <= 5)"""


_PLAIN = "list_transform(embedding, lambda x: x::DOUBLE)"
_TURNS = f"""turns AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) = 1 AS first, row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1 AS last
  FROM (SELECT conv_id AS id, turn AS ord, {_SQUEEZE("coalesce(text, '')")} AS body FROM conversations WHERE role = 'assistant'))"""
_OPEN = "last AND NOT ends_with(body, '-') AND NOT regexp_matches(body, '[.!?:\"”'')\\]]$')"
_EDGES = f"""edges AS (SELECT id, ord, 'block_lowercase_start' AS code FROM turns WHERE body <> '' AND first AND regexp_matches(substr(regexp_extract(body, '([A-Za-z]+)', 1), 1, 1), '^[a-z]$')
  UNION ALL SELECT id, ord, 'block_hyphen_end' FROM turns WHERE body <> '' AND last AND ends_with(body, '-')
  UNION ALL SELECT id, ord, 'block_dangling_end' FROM turns WHERE body <> '' AND {_OPEN} AND list_extract(regexp_extract_all(lower(body), '[a-z]+'), -1) IN ({_in(DANGLING)}))"""
_MICRO = f"""micro AS (SELECT doc_id AS id, len(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {_SQUEEZE('x')}),
  lambda x: x <> '' AND length(x) <= 18 AND NOT regexp_matches(x, '^[0-9]+[a-z]\\)'))) AS region_count FROM documents)"""
_PAIRS = "|".join(f"{w}{SPACE}+{w}" for w in REPEATABLE)
_REPEATS = f"""repeats AS (SELECT doc_id AS id, regexp_extract(lower(unnest(regexp_extract_all(text, '(?i)\\b(?:{_PAIRS})\\b'))), '^[a-z]+') AS word FROM documents)"""
_AUDIT = """SELECT 'doc/' || doc_id AS path, unnest(list_filter([
  CASE WHEN text IS NULL THEN 'fail missing_output_file' END, CASE WHEN contains(coalesce(text, ''), 'TODO') THEN 'fail todo_marker_left_in_output' END,
  CASE WHEN contains(coalesce(text, ''), '```text') THEN 'warn layout_code_block_in_semantic_markdown' END,
  CASE WHEN text IS NOT NULL AND length(trim(text)) < 80 THEN 'warn suspiciously_short_output' END], lambda x: x IS NOT NULL)) AS issue FROM documents"""
_CHUNKS = """RECURSIVE sized AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, {tokens} AS n FROM conversations),
walk AS (
  SELECT conv_id, i, w, n, 0 AS chunk FROM sized, (VALUES (70), (100), (140)) v(w) WHERE i = 1
  UNION ALL
  SELECT s.conv_id, s.i, w, CASE WHEN walk.n > 0 AND walk.n + s.n > w THEN s.n ELSE walk.n + s.n END, CASE WHEN walk.n > 0 AND walk.n + s.n > w THEN chunk + 1 ELSE chunk END
  FROM walk JOIN sized s ON s.conv_id = walk.conv_id AND s.i = walk.i + 1
),
packed AS (SELECT conv_id, chunk::BIGINT AS chunk, max(n) AS n_tokens, count(*) AS n_blocks, w AS "window" FROM walk GROUP BY conv_id, chunk, w HAVING max(n) > 0)""".replace("{tokens}", _TOKENS("coalesce(text, '')"))
_BUCKET = "CASE role WHEN 'system' THEN 'citation' WHEN 'assistant' THEN 'commentary' ELSE 'reference' END"
_JOINED = lambda b: f"coalesce(string_agg(body, chr(10) || chr(10) ORDER BY turn) FILTER (bucket = '{b}'), '')"

ORACLE_SQL: dict[str, str] = {
    "token_stats_by_lang": f"SELECT lang, {_STATS} FROM (SELECT lang, {_TOKENS(chr(99) + 'oalesce(text, ' + chr(39) * 2 + ')')} AS n_tokens FROM documents) GROUP BY lang",
    "stemmed_term_df": f"SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_terms('text')}) AS term FROM documents) GROUP BY ALL) GROUP BY term",
    "chargram_df": f"SELECT gram, count(*) AS df FROM (SELECT item_id, unnest(list_distinct({_grams('text')})) AS gram FROM benchmark) GROUP BY gram",
    "slug_keys": f"SELECT doc_id, {_slug(_FIRST)} AS slug, regexp_replace(lower(nfc_normalize({_FIRST})), '[^a-z0-9]+', '', 'g') AS match_key FROM documents",
    "title_case_norm": f"""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN {_SQUEEZE('p_name')} ELSE list_aggregate(list_transform(string_split({_SQUEEZE('p_name')}, ' '), lambda w, i: CASE WHEN i > 1 AND lower(w) IN ('a','an','and','as','at','for','in','of','on','or','the','to') THEN lower(w) ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), 'string_agg', ' ') END AS title FROM part""",
    "html_clean": f"SELECT page_id, length(t) AS n_chars, {_TOKENS('t')} AS n_tokens, sha256(t) AS text_sha256 FROM (SELECT page_id, {_HTML} AS t FROM pages)",
    "retrieval_cleaning": "SELECT doc_id, sha256(trim(list_aggregate(list_transform(string_split(text, chr(10)), lambda x: substr(trim('- ' || x), 3)), 'string_agg', chr(10)))) AS text_sha256 FROM documents",
    "bm25_topk": f"WITH {_bm25('s', _BODY, 'body_bm25')} {_top('s', 5)}",
    "fielded_bm25_topk": f"WITH {_bm25('s', _FIELDS, 'fielded_bm25')} {_top('s', 5)}",
    "chargram_tfidf_topk": f"WITH {_tfidf('s', _PAGES)} {_top('s', 5)}",
    "rrf_topk": f"""WITH {_bm25('a', _PAGES, 'fielded_bm25')}, {_tfidf('b', _PAGES)},
      grid AS (SELECT item_id AS probe_id, page_id AS doc_id FROM benchmark, pages),
      placed AS (SELECT probe_id, doc_id, row_number() OVER (PARTITION BY probe_id ORDER BY coalesce(a.score, 0) DESC, doc_id) AS ra, row_number() OVER (PARTITION BY probe_id ORDER BY coalesce(b.score, 0) DESC, doc_id) AS rb
        FROM grid LEFT JOIN a USING (probe_id, doc_id) LEFT JOIN b USING (probe_id, doc_id)),
      s AS (SELECT probe_id, doc_id, round(1.0::DOUBLE / ({FUSION} + ra) + 1.0::DOUBLE / ({FUSION} + rb), 6) AS score FROM placed) {_top('s', 5)}""",
    "retrieval_gold": f"WITH {_GOLD} SELECT * FROM gold",
    "retrieval_metrics": f"WITH {_GOLD}, {_bm25('s', _BODY, 'body_bm25')}, {_metrics('s')} SELECT * FROM s_m",
    "retrieval_grouping_sets": f"""WITH {_GOLD}, {_bm25('s', _BODY, 'body_bm25')}, {_bm25('f', _FIELDS, 'fielded_bm25')}, {_metrics('s')}, {_metrics('f')},
      langs AS (SELECT probe_id, min(lang) AS lang FROM gold JOIN documents USING (doc_id) GROUP BY ALL),
      every AS (SELECT *, 'body_bm25' AS profile FROM s_m UNION ALL SELECT *, 'fielded_bm25' FROM f_m)
      SELECT profile, lang, count(*) AS probes, {_MEANS} FROM every JOIN langs USING (probe_id) GROUP BY GROUPING SETS ((profile, lang), (profile), (lang))""",
    "retrieval_tag_slices": f"""WITH {_GOLD}, {_bm25('s', _BODY, 'body_bm25')}, {_metrics('s')},
      tags AS (SELECT DISTINCT probe_id, unnest(list_filter(['lang-' || lang, CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL)) AS tag
        FROM gold JOIN documents USING (doc_id) LEFT JOIN labels USING (doc_id))
      SELECT tag, count(*) AS probes, round(avg(mrr), 4) AS mrr, round(avg(hit_at_1), 4) AS hit_at_1 FROM s_m JOIN tags USING (probe_id) GROUP BY tag""",
    "miss_diagnostics": f"""WITH {_GOLD}, {_bm25('s', _FIELDS, 'fielded_bm25')}, {_metrics('s')}
      SELECT * FROM (SELECT probe_id, CASE WHEN hit_at_1 < 1 AND recall_at_3 < 1 THEN 'top1_and_recall_miss' WHEN hit_at_1 < 1 THEN 'top1_miss' WHEN mrr < 1 THEN 'rank_drop' ELSE 'pass' END AS miss_class, best_rank, mrr FROM s_m) WHERE miss_class <> 'pass'""",
    "explained_shares": f"""WITH {_bm25('s', _FIELDS, 'fielded_bm25').replace('SELECT probe_id, doc_id, round(', 'SELECT probe_id, doc_id, field, (').replace('::DOUBLE), 6) AS score', '::DOUBLE)) AS part')}
      SELECT probe_id, doc_id, round(most / total, 4) AS explained_share FROM (SELECT probe_id, doc_id, max(part) AS most, sum(part) AS total FROM s GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY probe_id ORDER BY round(total, 6) DESC, doc_id) = 1""",
    "dense_topk": f"WITH {_near(_PLAIN, 'n')} SELECT * FROM n",
    "dense_label_votes": f"WITH {_near(_PLAIN, 'n')} SELECT query_id, round(avg((e.label = o.label)::INT), 4) AS same FROM n JOIN embeddings e ON e.vec_id = n.vec_id JOIN embeddings o ON o.vec_id = n.query_id GROUP BY query_id",
    "neighbor_overlap": f"WITH {_near(_PLAIN, 'a')}, {_near(_COARSE, 'b')} SELECT a.query_id, round(count(b.vec_id)::DOUBLE / 5, 4) AS overlap FROM a LEFT JOIN b ON a.query_id = b.query_id AND a.vec_id = b.vec_id GROUP BY a.query_id",
    "twin_metrics": f"SELECT label, count(*) AS n, round(avg(cosine), 4) AS mean_cosine, min(cosine) AS least_cosine FROM (SELECT label, round(list_dot_product({_PLAIN}, {_COARSE}) / sqrt(list_dot_product({_PLAIN}, {_PLAIN}) * list_dot_product({_COARSE}, {_COARSE})), 6) AS cosine FROM embeddings) GROUP BY label",
    "repeated_words": f"WITH {_REPEATS} SELECT id AS doc_id, word, count(*) AS n FROM repeats GROUP BY ALL",
    "block_edge_issues": f"WITH {_TURNS}, {_EDGES} SELECT * FROM edges",
    "micro_region_pages": f"WITH {_MICRO} SELECT * FROM micro WHERE region_count >= 6",
    "issue_summary": f"""WITH {_TURNS}, {_EDGES}, {_MICRO}, {_REPEATS}, every AS (SELECT id, code FROM edges UNION ALL SELECT id, 'boundary_page_many_micro_regions' FROM micro WHERE region_count >= 6 UNION ALL SELECT id, 'repeated_adjacent_word' FROM repeats)
      SELECT code, count(*) AS n, count(DISTINCT id) AS ids FROM every GROUP BY code""",
    "scope_classification": "SELECT CASE WHEN event_type = 'purchase' AND user_id % 10 = 3 THEN 'target' WHEN event_type = 'purchase' THEN 'holdout' WHEN user_id % 10 = 7 THEN 'negative' ELSE 'unclassified' END AS \"group\", count(*) AS n FROM events GROUP BY 1",
    "assertions": """SELECT 'doc/' || doc_id AS check_id, x.code AS code, x.detail AS detail FROM (SELECT doc_id, unnest(list_filter([
        CASE WHEN NOT contains(text, 'e') THEN {'code': 'missing_required_substring', 'detail': 'e'} END, CASE WHEN contains(text, 'License') THEN {'code': 'forbidden_substring_present', 'detail': 'License'} END,
        CASE WHEN contains(text, 'token = ') THEN {'code': 'forbidden_substring_present', 'detail': 'token = '} END, CASE WHEN NOT regexp_matches(text, '(?m)^[A-Z]') THEN {'code': 'required_pattern_missing', 'detail': '^[A-Z]'} END,
        CASE WHEN regexp_matches(text, '(?m)[0-9]{4}') THEN {'code': 'forbidden_pattern_present', 'detail': '[0-9]{4}'} END, CASE WHEN regexp_matches(text, '(?m)\\|$') THEN {'code': 'forbidden_pattern_present', 'detail': '\\|$'} END], lambda x: x IS NOT NULL)) AS x FROM documents)
      UNION ALL SELECT 'none', 'missing_target_file', 'doc/none'""",
    "anchor_catalog": f"SELECT page_id, i AS ordinal, {_slug('heading')} AS anchor FROM (SELECT page_id, unnest(h) AS heading, unnest(range(1, len(h) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?i)<h[1-3][^>]*>([^<]*)</h[1-3]>', 1) AS h FROM pages))",
    "manifest_audit": f"SELECT path, split_part(issue, ' ', 1) AS severity, split_part(issue, ' ', 2) AS code FROM ({_AUDIT})",
    "audit_status": f"SELECT CASE WHEN bool_or(starts_with(issue, 'fail')) THEN 'fail' WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END AS status FROM ({_AUDIT})",
    "duplicate_paths": "SELECT path, count(*) AS n FROM (SELECT regexp_replace(url, '^[a-z]+://([^/?#]*).*$', '\\1') AS path FROM pages WHERE url IS NOT NULL) GROUP BY path HAVING count(*) > 1",
    "adjacent_range_overlap": """WITH spans AS (SELECT o_custkey, o_orderkey AS id, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS s, date_diff('day', DATE '1970-01-01', max(l_shipdate)::DATE) AS e
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, o_orderkey, o_orderdate),
      seen AS (SELECT *, lag(id) OVER w AS lid, lag(s) OVER w AS ls, lag(e) OVER w AS le FROM spans WINDOW w AS (PARTITION BY o_custkey ORDER BY s, e, id))
      SELECT o_custkey, lid AS left_id, id AS right_id, kind, CASE WHEN kind IN ('identical', 'nested') THEN 'fail' ELSE 'warn' END AS severity
      FROM (SELECT *, CASE WHEN ls IS NULL OR s > le THEN NULL WHEN ls = s AND le = e THEN 'identical' WHEN s = le THEN 'boundary' WHEN ls <= s AND e <= le THEN 'nested' ELSE 'overlap' END AS kind FROM seen) WHERE kind IS NOT NULL""",
    "counter_diff": "SELECT event_type, count(*) FILTER (event_id % 2 = 0) AS left_n, count(*) FILTER (event_id % 2 = 1) AS right_n, count(*) FILTER (event_id % 2 = 1) - count(*) FILTER (event_id % 2 = 0) AS delta FROM events GROUP BY event_type HAVING delta <> 0",
    "metric_gate": """WITH v AS (SELECT o_orderpriority AS run, o_orderkey % 2 AS half, round(avg(o_totalprice) / 1000, 4) AS value FROM orders GROUP BY ALL)
      SELECT coalesce(c.run, b.run) AS run, 'price' AS metric, CASE WHEN c.value IS NULL THEN 'missing_current' WHEN b.value IS NULL THEN 'new_metric' WHEN c.value < b.value - 0.001 THEN 'regressed' ELSE 'ok' END AS verdict
      FROM (FROM v WHERE half = 0) c FULL JOIN (FROM v WHERE half = 1) b ON c.run = b.run""",
    "percentile_timeout": "SELECT *, greatest(p95 * 2, p99 + 30) AS timeout FROM (SELECT event_type, count(*) AS runs, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY event_type)",
    "chunk_windows": f'WITH {_CHUNKS} SELECT conv_id, chunk, n_tokens, n_blocks, "window" FROM packed',
    "chunk_window_stats": f'WITH {_CHUNKS} SELECT "window", {_STATS} FROM packed GROUP BY "window"',
    "largest_atomic_blocks": f"SELECT conv_id, turn AS ord, {_TOKENS(chr(116) + 'ext')} AS n_tokens FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY {_TOKENS(chr(116) + 'ext')} DESC, turn) = 1",
    "probe_limits": f"""WITH {_TURNS}, {_EDGES}, {_MICRO}, {_REPEATS}, every AS (SELECT code FROM edges UNION ALL SELECT 'boundary_page_many_micro_regions' FROM micro WHERE region_count >= 6 UNION ALL SELECT 'repeated_adjacent_word' FROM repeats),
      lim(code, most) AS (VALUES ('repeated_adjacent_word', 3), ('block_hyphen_end', 0), ('boundary_page_many_micro_regions', 100000))
      SELECT lim.code, count(every.code) AS actual, most FROM lim LEFT JOIN every ON lim.code = every.code GROUP BY lim.code, most HAVING count(every.code) > most""",
    "run_manifest_errors": """WITH r AS (SELECT ['quality_gate', 'challenge_corpus', 'backend_comparison', 'bundle_generation', 'other'][user_id % 5 + 1] AS kind, event_type, CASE WHEN event_id % 3 = 0 THEN 'old' ELSE 'fresh' END AS fresh FROM events),
      e AS (SELECT unnest(CASE kind WHEN 'quality_gate' THEN ['input_pdf', 'converter_version', 'gate_config'] WHEN 'challenge_corpus' THEN ['baseline_dir', 'entry_count'] WHEN 'backend_comparison' THEN ['bundle', 'benchmark', 'backend']
          WHEN 'bundle_generation' THEN ['book_id', 'source', 'converter_version', 'output_dir'] ELSE ['unknown kind: other'] END) AS error FROM r
        UNION ALL SELECT 'invalid artifact_status: ' || event_type FROM r WHERE event_type NOT IN ('generated', 'failed', 'skipped', 'dry_run') UNION ALL SELECT 'invalid freshness: old' FROM r WHERE fresh = 'old')
      SELECT error, count(*) AS n FROM e GROUP BY error""",
    "backend_choice": "SELECT 'b' || s_suppkey AS backend_id, s_acctbal AS runtime_seconds FROM supplier WHERE s_acctbal > 0 AND s_suppkey % 2 = 0 ORDER BY s_nationkey / 25.0 DESC, s_suppkey % 7 DESC, s_suppkey % 3 DESC, s_acctbal, 'b' || s_suppkey LIMIT 1",
    "offset_votes": """WITH c AS (SELECT l_returnflag, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS "offset", count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
      r AS (SELECT *, row_number() OVER w AS place, lead(n, 1, 0) OVER w AS second_count, sum(n) OVER (PARTITION BY l_returnflag) AS total FROM c WINDOW w AS (PARTITION BY l_returnflag ORDER BY n DESC, "offset"))
      SELECT l_returnflag, "offset"::INT AS "offset", n AS count, second_count, total::BIGINT AS total, round(n::DOUBLE / total, 4) AS confidence, n >= 25 AND n::DOUBLE / total >= 0.85 AND n >= greatest(10, second_count * 4) AS is_strong FROM r WHERE place = 1""",
    "entry_end_pages": "SELECT *, greatest(start_page, lead(start_page) OVER (PARTITION BY o_custkey ORDER BY sequence) - 1) AS end_page FROM (SELECT o_custkey, o_orderkey AS sequence, date_diff('day', DATE '1990-01-01', o_orderdate::DATE)::INT AS start_page FROM orders)",
    "line_regions_islands": """WITH g AS (SELECT *, CASE WHEN sec - lag(sec) OVER w > 3600 OR lag(sec) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM (SELECT user_id, event_id, epoch(date_trunc('second', ts))::BIGINT AS sec FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
      SELECT user_id, island, count(*) AS n, min(event_id) AS first_event FROM (SELECT *, (sum(s) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS island FROM g) GROUP BY user_id, island""",
    "note_state_propagation": """SELECT event_type, count(*) FILTER (coalesce(st, false)) AS inside, count(*) AS n FROM (SELECT event_type, last_value(CASE event_type WHEN 'click' THEN true WHEN 'purchase' THEN false END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS st FROM events) GROUP BY event_type""",
    "anchor_asof": """SELECT event_id, last_value(CASE WHEN a THEN event_id END IGNORE NULLS) OVER b AS previous_anchor, first_value(CASE WHEN a THEN event_id END IGNORE NULLS) OVER f AS next_anchor, first_value(CASE WHEN a THEN sec END IGNORE NULLS) OVER f - sec AS next_distance
      FROM (SELECT user_id, event_id, event_type = 'purchase' AS a, epoch(date_trunc('second', ts))::BIGINT AS sec FROM events)
      WINDOW b AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "passages_assembled": f"""WITH f AS (SELECT conv_id, turn, {_BUCKET} AS bucket, {_SQUEEZE("coalesce(text, '')")} AS body FROM conversations),
      p AS (SELECT *, (sum((bucket = 'reference')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))::BIGINT AS passage FROM f),
      j AS (SELECT conv_id, passage, {_JOINED('citation')} AS a, {_JOINED('commentary')} AS b, {_JOINED('reference')} AS c, count(*) AS n_fragments FROM p WHERE body <> '' GROUP BY ALL)
      SELECT conv_id, passage, sha256(a) AS citation_sha256, sha256(b) AS commentary_sha256, sha256(c) AS reference_sha256, n_fragments, {_TOKENS("a || ' ' || b || ' ' || c")} AS n_tokens FROM j""",
    "fragment_attachment": f"""WITH t AS (SELECT *, lead(text) OVER w AS nt, lead(role) OVER w AS nr FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), f AS (SELECT *, {_SQUEEZE('text')} AS flat FROM t)
      SELECT CASE WHEN nt IS NOT NULL AND {_TOKENS('text')} * 2 <= 18 AND len(regexp_extract_all(flat, '[^ ]+')) <= 10 AND flat <> '' AND NOT regexp_matches(flat, '[.!?]["”'')\\]]?$')
        THEN CASE WHEN role <> nr THEN 'cross-zone-next-anchor' WHEN regexp_matches(trim(nt), '(?i)^([-*][ \\t]*)?[0-9]+[a-z]\\)[ \\t]*$') THEN 'marker-only-next-anchor' END END AS reason, count(*) AS n FROM f GROUP BY 1""",
    "page_profiles": f"""WITH l AS (SELECT doc_id, {_SQUEEZE('t')} AS text, ((doc_id + (i - 1) * 53) % 300)::DOUBLE AS x0, (40 + (i - 1) * 14)::DOUBLE AS y0, CASE WHEN (i - 1) % 5 = 4 THEN 8.0 ELSE 10.0 END AS size
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
      own AS (SELECT *, max(y0 >= 45) OVER (PARTITION BY doc_id) AS has_body FROM l WHERE text <> ''),
      main AS (SELECT doc_id, arg_max(size, n * 1000 - size) AS main FROM (SELECT doc_id, size, count(*) AS n FROM own GROUP BY ALL) GROUP BY doc_id),
      body AS (SELECT * FROM own WHERE NOT has_body OR y0 >= 45),
      cl AS (SELECT doc_id, count(*) FILTER (n >= 2) AS clusters FROM (SELECT doc_id, round_even(x0 / 24, 0) AS c, count(*) AS n FROM body GROUP BY ALL) GROUP BY doc_id),
      c AS (SELECT doc_id, count(*) AS body_lines, avg((length(text) < 26)::INT) AS short, avg((size < main - 0.7)::INT) AS small, count(*) FILTER (x0 >= 180) AS right_n FROM body JOIN main USING (doc_id) GROUP BY doc_id),
      t AS (SELECT doc_id, bool_or(contains(lower(text), 'table ')) AS has_table FROM own GROUP BY doc_id),
      k AS (SELECT doc_id, CASE WHEN has_table THEN 'table' WHEN right_n >= 8 AND small >= 0.1 THEN 'aside' WHEN clusters >= 3 AND short >= 0.35 THEN 'multi-column' ELSE 'simple' END AS kind, body_lines, clusters FROM c JOIN cl USING (doc_id) JOIN t USING (doc_id))
      SELECT doc_id, kind, kind <> 'simple' AS complex, body_lines, clusters FROM k""",
    "ancestor_paths": """SELECT 'r' || r_regionkey AS node_id, r_name AS path FROM region UNION ALL SELECT 'n' || n_nationkey, r_name || ' > ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL SELECT 'c' || c_custkey, r_name || ' > ' || n_name || ' > ' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "roman_labels": """SELECT number, list_extract(['','x','xx','xxx','xl','l','lx','lxx','lxxx','xc'], number // 10 + 1) || list_extract(['','i','ii','iii','iv','v','vi','vii','viii','ix'], number % 10 + 1) AS label, number AS value FROM (SELECT DISTINCT p_size AS number FROM part)""",
}

ORACLE_SQL |= SQL | books.SQL
