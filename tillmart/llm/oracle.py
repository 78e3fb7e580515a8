"""The queries of this subpackage in SQL, as far as SQL expresses them."""

from __future__ import annotations

from tillmart.llm.queries import URL_RULES

_SPACE = r"chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _matches(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, hit.gap + before AS start, hit.gap + before + hit.size AS stop
    FROM (
        SELECT doc_id, hit, sum(hit.gap + hit.size) OVER (PARTITION BY doc_id ORDER BY hit.n) - hit.gap - hit.size AS before
        FROM (
            SELECT doc_id, unnest(list_transform(range(1, len(hits) + 1), lambda n: {{
                'n': n, 'gap': length(gaps[n]), 'size': length(hits[n]), 'long': length(secrets[n])}})) AS hit
            FROM (
                SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps,
                    regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {group}) AS secrets
                FROM texts WHERE regexp_matches(text, '{pattern}')
            )
        )
    )
    WHERE hit.long >= {least}"""


_SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_matches("assign", 0, _ASSIGN, 2, 6)}
    UNION ALL {_matches("access", 1, "AKIA[A-Z0-9]+", 0, 20)}
    UNION ALL {_matches("hex", 2, "[0-9a-f]+", 0, 24)}),
listed AS (
    SELECT doc_id, string_agg(concat(kind, ':', start::BIGINT, ':', stop::BIGINT), ',' ORDER BY start, rank) AS spans,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex
    FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)"""

_LINES = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (key) GROUP BY doc_id"""

_RULES = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in URL_RULES)
_URLS = f"""
WITH rules AS (
    SELECT verdict, rule, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path
    FROM (VALUES {_RULES}) AS t(verdict, rule)),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rest),
best AS (
    SELECT page_id, arg_max(rule, (length(rule), length(rule_host))) AS rule, arg_max(verdict, (length(rule), length(rule_host))) AS verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)"""



def _distinct_terms(table: str, key: str) -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""SELECT {key}, term, count(*) AS tf
    FROM (SELECT {key}, unnest(regexp_extract_all({lower}, '{term}')) AS term FROM {table}) GROUP BY ALL"""


_RANKED = f"""
WITH postings AS ({_distinct_terms("documents", "doc_id")}),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
sums AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, sums GROUP BY term),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
    FROM ({_distinct_terms("benchmark", "item_id")}) i
    JOIN postings p USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), sums
    GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""

SQL = {"op2_secrets": _SECRETS, "op5_urls": _URLS, "op8_line_dedup": _LINES, "op12_lexical_search": _RANKED}
