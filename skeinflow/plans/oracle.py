"""DuckDB SQL for the queries: an independent statement of each result over the same tables."""

from __future__ import annotations

from ..functions import terms
from ..functions.text import BASIC_ENTITIES, BRACKETED
from ..operators.dedupe import SHARE
from ..operators.rules import MAX_EVENTS
from . import articles as bind


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(x) for x in items) + "]"


def _unescape(c: str) -> str:
    for entity, char in BASIC_ENTITIES:
        c = f"replace({c}, {_q(entity)}, {_q(char)})"
    return c


def _squeeze(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[\s\p{{Z}}]+', ' ', 'g'))"


def _cut(c: str, n: int) -> str:
    return f"(CASE WHEN length({c}) > {n} THEN rtrim(substr({c}, 1, {n - 1})) || '…' ELSE {c} END)"


def _clean(c: str, n: int) -> str:
    tagless = f"regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g')"
    return _cut(_squeeze(_unescape(tagless)), n)


def _norm(c: str) -> str:
    return _squeeze(rf"regexp_replace(regexp_replace(lower({c}), {_q(BRACKETED)}, ' ', 'g'), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')")


def _tokens(c: str) -> str:
    keep = rf"NOT list_contains({_list(terms.STOPWORDS)}, w) AND NOT regexp_matches(w, '^[\p{{Nd}}²³¹⁰⁴-⁹₀-₉]+$') AND length(w) >= CASE WHEN regexp_matches(w, '[가-힣一-鿿]') THEN 2 ELSE 3 END"
    return f"list_sort(list_distinct(list_filter(string_split({_norm(c)}, ' '), lambda w: {keep})))"


_URL = r"'^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$'"


def _part(url: str, k: int) -> str:
    return f"regexp_extract(trim({url}), {_URL}, {k})"


def _host(url: str) -> str:
    return rf"regexp_replace(lower({_part(url, 2)}), '^www\.', '')"


def _decode(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _pairs(url: str) -> str:
    value = "CASE WHEN position('=' IN kv) > 0 THEN substr(kv, position('=' IN kv) + 1) ELSE '' END"
    return f"list_transform(list_filter(string_split({_part(url, 4)}, '&'), lambda kv: kv <> ''), lambda kv: {{'k': {_decode("string_split(kv, '=')[1]")}, 'v': {_decode(value)}}})"


def _encode(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def _canonical(url: str) -> str:
    query = f"array_to_string(list_transform(list_filter({_pairs(url)}, lambda p: NOT list_contains({_list(terms.TRACKING)}, lower(p.k))), lambda p: {_encode('p.k')} || '=' || {_encode('p.v')}), '&')"
    path = f"regexp_replace({_part(url, 3)}, '/+$', '')"
    scheme = f"lower({_part(url, 1)})"
    return f"(CASE WHEN {scheme} <> '' THEN {scheme} || ':' ELSE '' END || CASE WHEN {_host(url)} <> '' THEN '//' || {_host(url)} ELSE '' END || CASE WHEN {path} = '' THEN '/' ELSE {path} END || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END)"


def _kst(ts: str, pattern: str = "%Y-%m-%d %H:%M") -> str:
    return f"strftime({ts} + INTERVAL 9 HOUR, '{pattern}') || ' KST'"


def _term(hay: str, term: str) -> str:
    if term.startswith(" ") and term.endswith(" "):
        return rf"regexp_matches({hay}, '(^|[^\p{{L}}\p{{N}}_]){term.strip()}($|[^\p{{L}}\p{{N}}_])')"
    return f"contains({hay}, {_q(term)})"


def _topics(hay: str, topics) -> str:
    cases = ", ".join(f"CASE WHEN {' OR '.join(_term(hay, w) for w in words)} THEN {_q(name)} END" for name, words in topics.items())
    return f"list_filter([{cases}], lambda t: t IS NOT NULL)"


def _noise(hay: str) -> str:
    return "(" + " OR ".join(f"contains({hay}, {_q(w)})" for w in bind.TEST_NOISE) + ")"


_TIER = "CASE tier WHEN 1 THEN 3.0 WHEN 2 THEN 2.0 WHEN 3 THEN 1.0 ELSE 0.5 END"
_NOW = f"TIMESTAMP '{bind.NOW}'"
_RECENT = f"CASE WHEN published IS NULL THEN -1.5 ELSE greatest(0.0, 2.0 - greatest((epoch_us({_NOW}) - epoch_us(published)) / 3600000000.0, 0.0) / 12.0) END"
_HAY = "lower(' ' || title || ' ' || summary || ' ')"
#: The window of the fixed moment starts a day before it: the last New York close is later.
_START = f"({_NOW} - INTERVAL 24 HOUR)"

_CTES = {
    "raw_articles": f"""
      SELECT d.doc_id AS seq, {_clean("string_split(d.text, chr(10))[1]", 300)} AS title, {_clean("d.text", 400)} AS summary,
        coalesce(p.url, 'https://src.example.com/' || d.doc_id) AS link, CASE WHEN d.doc_id % 37 <> 0 THEN e.ts END AS published,
        CAST(substr(d.source, 4) AS INTEGER) AS n, p.url IS NOT NULL AS paged
      FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id""",
    "articles": """
      SELECT seq, title, link, summary, published, 'src' || n AS source_name, CAST(n % 4 + 1 AS INTEGER) AS tier, 'cat' || (n % 10) AS category FROM (
        SELECT seq, title, link, summary, published, n FROM raw_articles
        UNION ALL
        SELECT seq + 10000000, title, link || CASE WHEN contains(link, '?') THEN '&' ELSE '?' END || 'utm_medium=x', summary, published, (n + 7) % 20 FROM raw_articles WHERE paged)""",
    "feeds": """
      SELECT 'cat' || (n % 10) AS category, CAST(n % 4 + 1 AS INTEGER) AS tier, source AS name, 'https://feeds.example.com/src' || n AS url,
        CASE WHEN n % 7 = 3 THEN 'HTTPError: 403' END AS error, CASE WHEN n >= 15 THEN ['waf', 'none', 'egress_policy'][n % 3 + 1] END AS blocked_reason
      FROM (SELECT DISTINCT source, CAST(substr(source, 4) AS INTEGER) AS n FROM documents WHERE source IS NOT NULL)""",
    "windowed": f"SELECT *, {_canonical('link')} AS url FROM articles WHERE title <> '' AND link <> '' AND (published IS NULL OR published BETWEEN {_START} AND {_NOW})",
    "url_group": "SELECT url, min(seq) AS gid, arg_min(title, seq) AS title, count(*) AS members FROM windowed GROUP BY url",
    "tokenised": f"SELECT gid, {_tokens('title')} AS tokens FROM url_group",
    "classed": "SELECT gid, tokens, min(gid) OVER (PARTITION BY tokens) AS class_id FROM tokenised",
    "token_of": "SELECT class_id, len(tokens) AS n, unnest(tokens) AS token FROM classed WHERE gid = class_id",
    "met": f"""
      SELECT a.class_id AS a, b.class_id AS b, count(*) AS overlap, any_value(a.n) AS size_a, any_value(b.n) AS size_b
      FROM token_of a JOIN token_of b ON a.token = b.token AND a.class_id < b.class_id GROUP BY ALL
      HAVING count(*) >= greatest({terms.MIN_SHARED}, ceil({SHARE!r} * least(any_value(a.n), any_value(b.n)) - 1e-9))""",
    "alike": f"SELECT a, b FROM met WHERE overlap >= {terms.MIN_SHARED} AND (overlap / least(size_a, size_b) >= {terms.MIN_CONTAINED} OR overlap / (size_a + size_b - overlap) >= {terms.MIN_JACCARD})",
    "linked": f"""
      SELECT a, b FROM alike UNION SELECT b, a FROM alike
      UNION SELECT gid, class_id FROM classed WHERE len(tokens) >= {terms.MIN_SHARED} AND gid <> class_id
      UNION SELECT class_id, gid FROM classed WHERE len(tokens) >= {terms.MIN_SHARED} AND gid <> class_id""",
    "spread": "SELECT gid AS label, gid FROM classed UNION SELECT s.label, l.b FROM spread s JOIN linked l ON l.a = s.gid AND l.b > s.label",
    "comps": "SELECT gid, min(label) AS component FROM spread GROUP BY gid",
    "clustered": "SELECT w.*, g.gid, c.component FROM windowed w JOIN url_group g USING (url) JOIN comps c USING (gid)",
    "led": """
      SELECT * FROM clustered QUALIFY row_number() OVER (PARTITION BY component ORDER BY tier, coalesce(published, TIMESTAMP '9999-12-31'), gid, seq) = 1""",
    "outlet_first": "SELECT component, source_name, min((gid, seq)) AS came FROM clustered GROUP BY ALL",
    "outlet_list": "SELECT component, list(source_name ORDER BY came) AS sources FROM outlet_first GROUP BY component",
    "primaries": "SELECT component, bool_or(tier = 1) AS has_primary FROM clustered GROUP BY component",
    "scored": f"""
      SELECT l.*, o.sources, p.has_primary, {_topics(_HAY, bind.TEST_TOPICS)} AS topics,
        round(CAST({_TIER} AS DOUBLE) + least(len(o.sources) - 1, 4) * 1.25 + (CASE WHEN len({_topics(_HAY, bind.TEST_TOPICS)}) > 0 THEN least(len({_topics(_HAY, bind.TEST_TOPICS)}), 3) * 1.5 ELSE -3.0 END)
          + ({_RECENT}) + CASE WHEN {_noise(_HAY)} THEN -6.0 ELSE 0.0 END, 2) AS score
      FROM led l JOIN outlet_list o USING (component) JOIN primaries p USING (component)""",
    "events_of": "SELECT *, row_number() OVER (ORDER BY score DESC, component) AS event_id FROM scored",
    "placed": "SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY event_id) AS INTEGER) AS place FROM events_of",
    "status": "SELECT f.category, f.name, f.url, f.tier, f.error IS NULL AS ok, count(a.seq) AS fetched, f.error FROM feeds f LEFT JOIN articles a ON a.source_name = f.name GROUP BY ALL",
    "health": f"""
      SELECT f.name, f.blocked_reason IS NOT NULL AS candidate, f.error IS NULL AND count(a.seq) > 0 AS ok, CASE WHEN f.error IS NULL THEN count(a.seq) ELSE 0 END AS articles,
        CASE WHEN f.error IS NULL THEN {_kst('max(a.published)')} END AS latest, coalesce(f.error, CASE WHEN count(a.seq) = 0 THEN '항목 0건' END) AS error
      FROM feeds f LEFT JOIN articles a ON a.source_name = f.name GROUP BY f.name, f.blocked_reason, f.error""",
    "raw_series": """
      SELECT as_of, name, CASE WHEN (day(as_of) + length(name)) % 9 = 0 THEN 'n/a' ELSE (v // 1000000) || '.' || lpad(CAST(v % 1000000 AS VARCHAR), 6, '0') END AS value FROM (
        SELECT CAST(ts AS DATE) AS as_of, event_type AS name, CAST(sum(CAST(value AS DECIMAL(18, 6))) * 1000000 AS BIGINT) // count(value) AS v FROM events GROUP BY ALL)""",
    "series": f"SELECT as_of, CASE name {' '.join(f'WHEN {_q(k)} THEN {_q(v)}' for k, v in bind.TEST_TENORS.items())} END AS tenor, TRY_CAST(value AS DOUBLE) AS percent FROM raw_series WHERE name IN ({', '.join(map(_q, bind.TEST_TENORS))}) AND TRY_CAST(value AS DOUBLE) IS NOT NULL",
    "days": "SELECT DISTINCT as_of FROM series ORDER BY as_of DESC LIMIT 2",
    "curve": """
      SELECT l.tenor, l.percent, round((l.percent - p.percent) * 100, 1) AS change_bp, l.as_of, (SELECT min(as_of) FROM days HAVING count(*) = 2) AS compared_with
      FROM series l LEFT JOIN series p ON p.tenor = l.tenor AND p.as_of = (SELECT min(as_of) FROM days) AND p.as_of <> l.as_of WHERE l.as_of = (SELECT max(as_of) FROM days)""",
    "linked_pages": r"""
      SELECT page_id, 'see [' || replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ']', '') || '](' || url || ') and [again](' || url || '.,) or [home](https://home.example.com/' || (page_id % 5) || ';)' AS text FROM pages""",
    "attempts": """
      SELECT 'https://probe.example.com/' || page_id AS url, CASE WHEN page_id % 10 <> 9 THEN [200, 301, 403, 404, 410, 418, 429, 500, 503][page_id % 9 + 1] END AS head,
        CASE WHEN page_id % 14 <> 13 THEN [200, 403, 404, 418][page_id % 4 + 1] END AS got FROM pages""",
    "verdicts": """
      SELECT url, CASE WHEN head BETWEEN 200 AND 399 OR head IN (404, 410) THEN head ELSE coalesce(got, head) END AS status,
        CASE WHEN head BETWEEN 200 AND 399 THEN '정상' WHEN head IN (404, 410) THEN '실패' WHEN got BETWEEN 200 AND 399 THEN '정상' WHEN got IN (404, 410) THEN '실패' ELSE '확인 불가' END AS verdict FROM attempts""",
    "reports": f"SELECT report_id, {bind.REPORT} AS text FROM (SELECT conv_id * 1000000 + turn AS report_id, conv_id + turn AS r, coalesce(text, '') AS body FROM conversations)",
    "refs": r"SELECT report_id, text, list_sort(list_distinct(list_transform(regexp_extract_all(text, '#(\d+)', 1), lambda x: CAST(x AS BIGINT)))) AS ids FROM reports",
    "gaps": f"SELECT report_id, list_filter(ids, lambda i: i BETWEEN 1 AND {MAX_EVENTS}) AS adopted, list_filter(ids, lambda i: i > {MAX_EVENTS}) AS over FROM refs",
    "gap_rows": "SELECT report_id, adopted, over, list_filter(range(1, coalesce(list_max(adopted), 0) + 1), lambda i: NOT list_contains(adopted, i)) AS missing FROM gaps",
    "cut_out": "SELECT report_id, text, CASE WHEN position('## 6-2.' IN text) > 0 AND position('## 6-3.' IN text) > position('## 6-2.' IN text) THEN substr(text, position('## 6-2.' IN text), position('## 6-3.' IN text) - position('## 6-2.' IN text)) ELSE '' END AS core, CASE WHEN position('## 6-3.' IN text) > 0 AND position('## 6-4.' IN text) > position('## 6-3.' IN text) THEN substr(text, position('## 6-3.' IN text), position('## 6-4.' IN text) - position('## 6-3.' IN text)) ELSE '' END AS brief, CASE WHEN position('## 6-8.' IN text) > 0 THEN substr(text, position('## 6-8.' IN text)) ELSE '' END AS audit FROM reports",
    "block_lists": r"SELECT report_id, regexp_extract_all(core, '(?m)^###\s+#(\d+)\s+(.+)$', 1) AS ids, string_split_regex(core, '(?m)^###\s+#\d+\s+')[2:] AS blocks FROM cut_out",
    "block_rows": "SELECT report_id, i - 1 AS pos, CAST(ids[i] AS BIGINT) AS event_id, blocks[i] AS block FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS i FROM block_lists)",
    "states": r"SELECT report_id, CASE WHEN regexp_matches(text, '시장\s*환경\s*[:：]\s*(.+)') THEN trim(regexp_replace(trim(regexp_extract(text, '시장\s*환경\s*[:：]\s*(.+)', 1)), '^[*`]+|[*`]+$', '', 'g')) END AS state FROM reports",
    "sections": f"SELECT report_id, unnest({_list(terms.SECTIONS)}) AS missing, text FROM reports",
    "no_section": "SELECT report_id, missing FROM sections WHERE NOT contains(text, missing)",
    "no_category": f"SELECT report_id, missing FROM (SELECT report_id, brief, unnest({_list(f'[{c}]' for c in terms.CATEGORIES)}) AS missing FROM cut_out) WHERE NOT contains(brief, missing)",
    "no_audit": f"SELECT report_id, missing FROM (SELECT report_id, audit, unnest({_list(terms.AUDIT_FIELDS)}) AS missing FROM cut_out) WHERE NOT contains(audit, missing)",
    "no_header": rf"SELECT report_id, missing FROM (SELECT report_id, text, unnest({_list(terms.HEADER_LABELS)}) AS missing FROM reports) WHERE NOT regexp_matches(text, missing || '\s*[:：]')",
    "no_label": rf"SELECT report_id, '#' || event_id || ' ' || missing AS missing FROM (SELECT report_id, event_id, block, unnest({_list(terms.EVENT_LABELS)}) AS missing FROM block_rows) WHERE NOT contains(block, missing) UNION ALL SELECT report_id, '#' || event_id || ' link' FROM block_rows WHERE NOT regexp_matches(block, '\]\(https?://')",
    "forbidden_hits": "SELECT report_id, rule, found FROM (" + " UNION ALL ".join(f"SELECT report_id, {_q(name)} AS rule, regexp_extract(text, {_q('(?i)(' + pattern + ')')}, 1) AS found FROM reports" for pattern, name in terms.FORBIDDEN) + ") WHERE found <> ''",
    "ordering": "SELECT report_id, NOT list_contains(p, 0) AS complete, list_contains(p, 0) OR p = list_sort(p) AS ordered FROM (SELECT report_id, [" + ", ".join(f"position({_q(s)} IN text)" for s in terms.SECTIONS) + "] AS p FROM reports)",
    "declared": r"SELECT c.report_id, TRY_CAST(regexp_extract(c.audit, '최종 채택 수\s*[:：]\s*(\d+)\s*/\s*20', 1) AS BIGINT) AS declared, CAST(len(g.adopted) AS BIGINT) AS counted, CAST(len(regexp_extract_all(c.text, '\]\((https?://[^\s)]+)\)', 1)) AS BIGINT) AS links FROM cut_out c JOIN gaps g USING (report_id)",
    "core_counts": "SELECT report_id, len(ids) AS n, len(list_distinct(ids)) AS d FROM block_lists",
    "broken": f"""
      SELECT report_id, 'error' AS severity FROM no_section
      UNION ALL SELECT report_id, 'error' FROM ordering WHERE NOT ordered
      UNION ALL SELECT report_id, 'error' FROM states WHERE state IS NULL OR state NOT IN ({', '.join(map(_q, terms.MARKET_STATES))})
      UNION ALL SELECT report_id, 'error' FROM no_header UNION ALL SELECT report_id, 'error' FROM no_category
      UNION ALL SELECT report_id, 'error' FROM core_counts WHERE n = 0 OR n > 5
      UNION ALL SELECT report_id, 'error' FROM core_counts WHERE n <> d
      UNION ALL SELECT report_id, 'warning' FROM core_counts WHERE n BETWEEN 1 AND 4
      UNION ALL SELECT report_id, 'error' FROM no_label
      UNION ALL SELECT report_id, 'error' FROM gap_rows WHERE len(over) > 0
      UNION ALL SELECT report_id, 'error' FROM gap_rows WHERE len(missing) > 0
      UNION ALL SELECT report_id, 'error' FROM forbidden_hits UNION ALL SELECT report_id, 'error' FROM no_audit
      UNION ALL SELECT report_id, 'error' FROM declared WHERE declared IS NULL OR declared > {MAX_EVENTS}
      UNION ALL SELECT report_id, 'warning' FROM declared WHERE counted > 0 AND declared <> counted
      UNION ALL SELECT report_id, 'warning' FROM declared WHERE links < greatest(counted, 1)""",
}

_SPELLED = """CASE event_id % 22 WHEN 4 THEN epoch_us(date_trunc('minute', ts)) WHEN 5 THEN epoch_us(date_trunc('day', ts)) WHEN 7 THEN NULL WHEN 16 THEN epoch_us(date_trunc('hour', ts))
  WHEN 21 THEN epoch_us(date_trunc('day', ts)) ELSE epoch_us(date_trunc('second', ts)) END"""
_OTHERS = "list_filter(o.sources, lambda s: s <> l.source_name)"
_LINE = f"""'- [' || event_id || '] ' || title || ' | ' || coalesce({_kst('published', '%m-%d %H:%M')}, '시각 확인 불가') || ' | ' || source_name || '(T' || tier || ')' || CASE WHEN len(topics) > 0 THEN ' | 주제: ' || array_to_string(topics, ', ') ELSE '' END || ' | ' || link
  || CASE WHEN summary <> '' THEN chr(10) || '    · ' || substr(summary, 1, 180) ELSE '' END
  || CASE WHEN len(sources) > 1 THEN chr(10) || '    ↳ 중복 보도 ' || (len(sources) - 1) || '개 매체: ' || array_to_string(list_filter(sources, lambda s: s <> source_name)[1:6], ', ') ELSE '' END"""
_CLOSE = """
  SELECT event_id, least(epoch_us(ts) - 86400000000, max(closed)) AS start_us FROM (
    SELECT e.event_id, e.ts, epoch_us(CAST(CAST(e.ts - INTERVAL 5 HOUR AS DATE) - CAST(k AS INTEGER) AS TIMESTAMP) + INTERVAL 21 HOUR) AS closed,
      isodow(CAST(e.ts - INTERVAL 5 HOUR AS DATE) - CAST(k AS INTEGER)) AS dow
    FROM events e, range(10) t(k)) WHERE closed < epoch_us(ts) AND dow < 6 GROUP BY event_id, ts"""

_SELECTS = {
    "clean_text": f"SELECT page_id, {_clean('html', 400)} AS text FROM pages",
    "collapse_ws": f"SELECT doc_id, sha256({_squeeze('text')}) AS sha FROM documents",
    "truncate_ellipsis": f"SELECT doc_id, {_cut('text', 300)} AS cut FROM documents",
    "html_unescape_basic": f"SELECT page_id, sha256({_unescape('html')}) AS sha FROM pages",
    "normalize_title": f"SELECT seq, {_norm('title')} AS norm FROM articles",
    "title_tokens": f"SELECT seq, array_to_string({_tokens('title')}, ' ') AS tokens FROM articles",
    "url_host": f"SELECT page_id, {_host('url')} AS host FROM pages",
    "url_params": f"SELECT seq, coalesce(array_to_string(list_transform({_pairs('link')}, lambda p: p.k || '=' || p.v), '&'), '') AS params FROM articles",
    "canonical_url": f"SELECT seq, {_canonical('link')} AS url FROM articles",
    "kst_format": f"SELECT event_id, {_kst('ts')} AS kst FROM events",
    "parse_date_multi": f"SELECT event_id, coalesce(CAST({_SPELLED} // 1000000 AS BIGINT), -1) AS epoch FROM events",
    "tier_points": f"SELECT seq, CAST({_TIER} AS DOUBLE) AS points FROM articles",
    "recency_score": f"SELECT seq, round(CAST({_RECENT} AS DOUBLE), 4) AS points FROM articles",
    "html_payload_flag": r"SELECT id, kind, regexp_matches(lower(regexp_replace(substr(payload, 1, 200), '^\s+', '')), '^(<!doctype html|<html)') AS is_html FROM (SELECT page_id AS id, 'page' AS kind, html AS payload FROM pages UNION ALL SELECT doc_id, 'document', text FROM documents)",
    "parse_pages": f"SELECT page_id, {_clean("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)", 300)} AS title, {_clean("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)", 300)} AS heading, CAST((length(html) - length(replace(html, '<p>', ''))) / 3 AS BIGINT) AS paragraphs FROM pages",
    "feed_items": "SELECT seq, title, link, summary, coalesce(epoch_us(date_trunc('second', published)) // 1000000, -1) AS epoch FROM articles WHERE title <> '' AND link <> ''",
    "window_label": f"SELECT event_id, CASE WHEN start_us < epoch_us(ts) - 86400000000 THEN {_q(terms.LABEL_CLOSE[0])} || strftime(make_timestamp(start_us) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') || ' EST' || {_q(terms.LABEL_CLOSE[1])} ELSE {_q(terms.LABEL_DAY)} END AS label FROM ({_CLOSE}) JOIN events USING (event_id)",
    "health_lines": """
      SELECT CAST(CASE WHEN ok THEN 0 ELSE 1 END AS INTEGER) AS part, f.category, name, CASE WHEN ok THEN '  ' || CASE WHEN candidate THEN '복구!' ELSE 'OK   ' END || ' [' || f.category || '] ' || name || '  (' || articles || '건, 최신 ' || coalesce(latest, 'None') || ')'
        ELSE '  FAIL [' || f.category || '] ' || name || coalesce(' (' || f.blocked_reason || ')', '') || '  ' || f.url || chr(10) || '         → ' || h.error END AS text FROM health h JOIN feeds f USING (name)
      UNION ALL SELECT 2, '', '', chr(10) || '정상 ' || count(*) FILTER (WHERE ok) || '/' || count(*) || ' · 실패 ' || count(*) FILTER (WHERE NOT ok) || CASE WHEN count(*) FILTER (WHERE ok AND candidate) > 0 THEN
        chr(10) || chr(10) || '후보 피드 ' || count(*) FILTER (WHERE ok AND candidate) || '개가 이 네트워크에서는 살아납니다. sources.json의 candidate_feeds에서 feeds로 옮기세요:' || chr(10) || string_agg('  - [' || f.category || '] ' || name, chr(10) ORDER BY f.category, name) FILTER (WHERE ok AND candidate) ELSE '' END
      FROM health h JOIN feeds f USING (name)""",
    "series_fields": "SELECT strftime(as_of, '%Y-%m-%d') AS as_of, name, value FROM raw_series",
    "curve_document": "SELECT true AS available, strftime(as_of, '%Y-%m-%d') AS as_of, strftime(compared_with, '%Y-%m-%d') AS compared_with, tenor, percent, change_bp FROM curve",
    "link_lines": f"""
      SELECT CAST(CASE verdict WHEN '정상' THEN 0 WHEN '확인 불가' THEN 1 ELSE 2 END AS INTEGER) AS part, '  ' || rpad(verdict, CASE verdict WHEN '확인 불가' THEN 5 ELSE 7 END, ' ') || ' ' || url || CASE verdict WHEN '정상' THEN ''
        WHEN '실패' THEN chr(10) || '            → HTTP ' || status || {_q(terms.LINK_GONE)} ELSE chr(10) || '            → ' || CASE WHEN got IS NULL THEN 'OSError: reset' WHEN got = 403 THEN 'HTTP 403' || {_q(terms.LINK_BLOCKED)} ELSE 'HTTP ' || got END END AS text
      FROM verdicts JOIN attempts USING (url)
      UNION ALL SELECT 3, chr(10) || '링크 ' || count(*) || '개 · 정상 ' || count(*) FILTER (WHERE verdict = '정상') || ' · 확인 불가 ' || count(*) FILTER (WHERE verdict = '확인 불가') || ' · 실패 ' || count(*) FILTER (WHERE verdict = '실패')
        || CASE WHEN count(*) FILTER (WHERE verdict = '확인 불가') > 0 THEN chr(10) || {_q(terms.LINKS_UNVERIFIED)} ELSE '' END || CASE WHEN count(*) FILTER (WHERE verdict = '실패') > 0 THEN chr(10) || {_q(terms.LINKS_BROKEN)} ELSE '' END FROM verdicts""",
    "gate_verdict": "SELECT report_id, CASE WHEN errors > 0 THEN '검증 실패: 오류 ' || errors || '건, 경고 ' || warnings || '건' ELSE '검증 통과 (경고 ' || warnings || '건)' END AS text FROM (SELECT r.report_id, count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings FROM reports r LEFT JOIN broken b USING (report_id) GROUP BY r.report_id)",
    "digest_markdown": f"""
      SELECT CAST(-1 AS BIGINT) AS ord, {_q(terms.DIGEST_TITLE)} || chr(10) || chr(10) || '- 수집 구간: ' || {_kst(_START)} || ' ~ ' || {_kst(_NOW)} || ' (' || {_q(terms.LABEL_DAY)} || ')' || chr(10) || '- 피드: 정상 ' || (SELECT count(*) FROM status WHERE ok) || '/' || (SELECT count(*) FROM status)
        || chr(10) || '- 구간 내 기사: ' || (SELECT count(*) FROM windowed) || '건 → 1차 중복제거 후 후보 ' || (SELECT count(DISTINCT component) FROM comps) || '건' || chr(10) || chr(10) || {_q(chr(10).join(terms.DIGEST_NOTES))} || chr(10) AS text
      UNION ALL
      SELECT ord, '## [cat' || ord || '] 후보 ' || n || '건' || CASE WHEN failed > 0 THEN ' · 피드 실패 ' || failed || '개 — 누락 가능성 있음' ELSE '' END || chr(10) || chr(10) || CASE WHEN n = 0 THEN '- 구간 내 신규 기사 없음'
        ELSE told || CASE WHEN n > 5 THEN chr(10) || '- (중요도 하위 ' || (n - 5) || '건은 지면상 생략, candidates.json에는 모두 있음)' ELSE '' END END || chr(10)
      FROM (SELECT ord, (SELECT count(*) FROM events_of e WHERE e.category = 'cat' || ord) AS n, (SELECT count(*) FROM status s WHERE s.category = 'cat' || ord AND NOT ok) AS failed,
        (SELECT string_agg({_LINE}, chr(10) ORDER BY place) FROM placed p WHERE p.category = 'cat' || ord AND place <= 5) AS told FROM range(10) t(ord))""",
    "document_lines": """
      SELECT 3 AS part, event_id, n + 2 AS lines, n - 1 + CAST(event_id > 1 AS INTEGER) AS continued FROM (SELECT event_id, (SELECT count(*) FROM clustered c WHERE c.component = e.component) AS n FROM events_of e)
      UNION ALL SELECT * FROM (VALUES (0, 0, 1, 0), (1, 0, 10, 9), (2, 0, 1, 0), (4, 0, 1, 0)) v(part, event_id, lines, continued)""",
    "valid_rows": "SELECT seq FROM articles WHERE title <> '' AND link <> ''",
    "window_filter": "SELECT seq FROM windowed",
    "window_start": _CLOSE,
    "undated_count": "SELECT count(*) FILTER (WHERE published IS NULL) AS undated FROM windowed",
    "feeds_dim": "SELECT category, tier, name, url FROM feeds",
    "articles_feeds_join": "SELECT seq, source_name, f.tier AS feed_tier, coalesce(blocked_reason, 'active') AS state FROM articles a JOIN feeds f ON f.name = a.source_name",
    "union_feeds": "SELECT source_name, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs FROM articles GROUP BY source_name",
    "feed_partition": "SELECT name, category, blocked_reason FROM feeds",
    "dedupe_by_url": f"SELECT url, array_to_string(list(seq ORDER BY seq), ',') AS seqs, count(*) AS members FROM (SELECT seq, {_canonical('link')} AS url FROM articles) GROUP BY url",
    "group_representative": "SELECT gid, title, members FROM url_group",
    "title_classes": "SELECT gid, class_id, array_to_string(tokens, ' ') AS tokens FROM classed",
    "token_df": "SELECT token, count(*) AS df FROM token_of GROUP BY token",
    "token_overlap_join": "SELECT a, b, CAST(overlap AS INTEGER) AS overlap, CAST(size_a AS INTEGER) AS size_a, CAST(size_b AS INTEGER) AS size_b FROM met",
    "title_similar_pairs": "SELECT a, b FROM alike",
    "connected_components": "SELECT gid, component FROM comps",
    "clusters": "SELECT component, array_to_string(list(seq ORDER BY gid, seq), ',') AS seqs FROM clustered GROUP BY component",
    "cluster_lead": "SELECT component, seq AS lead_seq, tier FROM led",
    "cluster_sources": "SELECT component, array_to_string(sources, ',') AS sources FROM outlet_list",
    "outlet_count": "SELECT component, count(DISTINCT source_name) AS outlets FROM clustered GROUP BY component",
    "primary_source_flag": "SELECT component, has_primary FROM primaries",
    "lead_duplicates": f"SELECT component, array_to_string({_OTHERS}, ',') AS others FROM led l JOIN outlet_list o USING (component)",
    "topic_hits": f"SELECT seq, array_to_string({_topics(_HAY, bind.TEST_TOPICS)}, ',') AS topics FROM articles",
    "market_topic_hits": f"SELECT doc_id, array_to_string({_topics("lower('  ' || coalesce(text, '') || ' ')", terms.TOPICS)}, ',') AS topics FROM documents",
    "noise_flag": f"SELECT seq, {_noise(_HAY)} AS noise FROM articles",
    "prescore": "SELECT component, score FROM scored",
    "event_numbering": "SELECT event_id, component FROM events_of",
    "topk_per_category": "SELECT category, place, event_id FROM placed WHERE place <= 5",
    "omitted_per_category": "SELECT category, greatest(count(*) - 5, 0) AS omitted FROM events_of GROUP BY category",
    "events_top": "SELECT event_id, category, score, title, source_name, CAST(len(sources) AS BIGINT) AS outlets FROM events_of",
    "coverage": """
      SELECT ord, 'cat' || ord AS category, (SELECT count(*) FROM status s WHERE s.category = 'cat' || ord) AS feeds_total, (SELECT count(*) FROM status s WHERE s.category = 'cat' || ord AND ok) AS feeds_ok,
        (SELECT count(*) FROM status s WHERE s.category = 'cat' || ord AND NOT ok) AS feeds_failed, (SELECT count(*) FROM windowed w WHERE w.category = 'cat' || ord) AS articles_in_window,
        (SELECT count(*) FROM scored e WHERE e.category = 'cat' || ord) AS candidate_events, (SELECT count(*) FROM scored e WHERE e.category = 'cat' || ord AND has_primary) AS with_primary_source,
        coalesce((SELECT string_agg(name, ', ' ORDER BY name) FROM status s WHERE s.category = 'cat' || ord AND NOT ok), '') AS failed_feeds, (SELECT count(*) FROM status s WHERE s.category = 'cat' || ord AND ok) > 0 AS searched
      FROM range(10) t(ord)""",
    "run_meta": f"""
      SELECT {_kst(_START)} AS window_start_kst, {_kst(_NOW)} AS window_end_kst, {_q(terms.LABEL_DAY)} AS window_label, (SELECT count(*) FROM status) AS feeds_total, (SELECT count(*) FROM status WHERE ok) AS feeds_ok,
        (SELECT count(*) FROM articles) AS articles_fetched, (SELECT count(*) FROM windowed) AS articles_in_window, (SELECT count(*) FROM windowed WHERE published IS NULL) AS articles_undated,
        (SELECT count(DISTINCT component) FROM comps) AS clusters, (SELECT {_kst('max(published)')} FROM windowed) AS latest_article_kst""",
    "events_by_category": "SELECT category, count(*) AS events, min(event_id) AS first_event FROM events_of GROUP BY category",
    "feed_status": "SELECT category, name, url, tier, ok, fetched, error FROM status",
    "failed_feeds": "SELECT category, string_agg(name, ', ' ORDER BY name) AS failed FROM status WHERE NOT ok GROUP BY category",
    "feed_latest": f"SELECT source_name, {_kst('max(published)')} AS latest FROM articles GROUP BY source_name",
    "feed_health": "SELECT name, candidate, ok, articles, latest, error FROM health",
    "feed_health_summary": "SELECT candidate, ok, count(*) AS feeds FROM health GROUP BY ALL",
    "tenor_project": "SELECT strftime(as_of, '%Y-%m-%d') AS as_of, tenor, percent FROM series",
    "try_cast_filter": "SELECT strftime(as_of, '%Y-%m-%d') AS as_of, name FROM raw_series WHERE TRY_CAST(value AS DOUBLE) IS NULL",
    "curve_delta": "SELECT tenor, percent, change_bp, strftime(as_of, '%Y-%m-%d') AS as_of, strftime(compared_with, '%Y-%m-%d') AS compared_with FROM curve",
    "curve_render": "SELECT tenor, '| ' || tenor || ' | ' || printf('%.2f', percent) || ' | ' || CASE WHEN change_bp IS NULL THEN '확인 불가' ELSE printf('%+.1f', change_bp) END || ' |' AS line FROM curve",
    "extract_links": r"SELECT page_id, min(i - 1) AS ord, url FROM (SELECT page_id, i, regexp_replace(found[i], '[.,;]+$', '') AS url FROM (SELECT page_id, found, unnest(range(1, len(found) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(text, '\[([^\]]{1,200})\]\((https?://[^\s)]+)\)', 2) AS found FROM linked_pages))) GROUP BY page_id, url",
    "link_verdict": "SELECT url, CAST(coalesce(status, -1) AS INTEGER) AS status, verdict FROM verdicts",
    "link_summary": "SELECT verdict, count(*) AS links FROM verdicts GROUP BY verdict",
    "event_refs": "SELECT report_id, array_to_string(ids, ',') AS ids FROM refs",
    "id_gaps": "SELECT report_id, array_to_string(adopted, ',') AS adopted, array_to_string(missing, ',') AS missing, array_to_string(over, ',') AS over FROM gap_rows",
    "section_slice": "SELECT report_id, sha256(substr(text, position('## 6-6.' IN text), position('## 6-7.' IN text) - position('## 6-6.' IN text))) AS sha FROM reports",
    "section_order": "SELECT report_id, complete, ordered FROM ordering",
    "event_blocks": "SELECT report_id, pos, event_id, block FROM block_rows",
    "missing_sections": "SELECT report_id, missing FROM no_section",
    "missing_categories": "SELECT report_id, missing FROM no_category",
    "missing_labels": "SELECT report_id, missing FROM no_audit UNION ALL SELECT report_id, missing FROM no_header UNION ALL SELECT report_id, missing FROM no_label",
    "enum_domain": f"SELECT report_id, state, coalesce(state IN ({', '.join(map(_q, terms.MARKET_STATES))}), false) AS allowed FROM states",
    "forbidden_patterns": "SELECT report_id, rule, found FROM forbidden_hits",
    "declared_vs_actual": "SELECT report_id, coalesce(declared, -1) AS declared, counted, links FROM declared",
    "report_gate": "SELECT r.report_id, count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings, count(*) FILTER (WHERE severity = 'error') = 0 AS passed FROM reports r LEFT JOIN broken b USING (report_id) GROUP BY r.report_id",
    "events_json": f"SELECT event_id, CAST(to_json({{'id': event_id, 'category': category, 'topics': topics, 'lead': {{'title': title, 'link': link, 'published_kst': {_kst('published')}, 'source_name': source_name, 'source_tier': tier, 'category': category}}, 'duplicate_count': len(sources) - 1, 'sources': sources, 'has_primary_source': has_primary}}) AS VARCHAR) AS json FROM events_of",
    "render_lines": f"SELECT category, place, {_LINE} AS line FROM placed WHERE place <= 5",
}


def _with(select: str) -> str:
    """The statement with the common tables it needs, in order."""
    import re

    used: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in _CTES:
            if name not in used and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b|,\s*{name}\b", sql):
                used[name] = None
                visit(_CTES[name])

    visit(select)
    ctes = ", ".join(f"{n} AS ({_CTES[n]})" for n in _CTES if n in used)
    return f"WITH RECURSIVE {ctes} {select}" if ctes else select


ORACLE_SQL = {name: _with(sql) for name, sql in _SELECTS.items()}
