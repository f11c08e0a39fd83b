"""SQL for the queries that SQL can express, as plain as can be: every rule on every URL."""

from __future__ import annotations

from .decontaminate import SHINGLE, THRESHOLD
from .queries import HOST_RULES, PATTERN_RULES
from .url_rules import ALLOW


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _host_rules() -> str:
    rows = [
        f"({_quoted(r.host)}, {_quoted(r.path)}, {_quoted(r.text)}, {_quoted(r.verdict)})"
        for r in HOST_RULES
    ]
    return ", ".join(rows)


def _pattern_rules() -> str:
    rows = [
        f"({_quoted(r.pattern)}, {_quoted(r.regex)}, {_quoted(r.verdict)})" for r in PATTERN_RULES
    ]
    return ", ".join(rows)


OP7 = f"""
WITH host_rules(rule_host, rule_path, rule, verdict) AS (VALUES {_host_rules()}),
pattern_rules(pattern, regex, verdict) AS (VALUES {_pattern_rules()}),
parts AS (
  SELECT row_number() OVER () AS id, page_id, url,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM pages),
by_host AS (
  SELECT id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts, host_rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY id),
by_pattern AS (
  SELECT id, max(pattern) FILTER (verdict = '{ALLOW}') AS allowing, max(pattern) AS blocking
  FROM parts, pattern_rules WHERE regexp_matches(lowered, regex) GROUP BY id)
SELECT page_id, host, path, h.rule AS rule,
  coalesce(h.verdict, CASE WHEN p.id IS NULL OR allowing IS NOT NULL THEN 'allow' ELSE 'block' END)
    AS verdict,
  CASE WHEN h.id IS NULL THEN coalesce(allowing, blocking) END AS pattern
FROM parts LEFT JOIN by_host h USING (id) LEFT JOIN by_pattern p USING (id)
"""

# ASCII other than letters and digits.
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _shingles(table: str, key: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower(text), '{_SEPARATOR}'), lambda w: w <> '')"
    return f"""
  SELECT DISTINCT {key}, unnest([array_to_string(w[i:i + {SHINGLE - 1}], ' ')
    FOR i IN range(1, greatest(len(w) - {SHINGLE - 2}, 1))]) AS shingle
  FROM (SELECT {key}, {words} AS w FROM {table})"""


OP4 = f"""
WITH item AS ({_shingles("benchmark", "item_id")}),
doc AS ({_shingles("documents", "doc_id")}),
size AS (SELECT item_id, count(*) AS n_shingles FROM item GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
FROM doc JOIN item USING (shingle) JOIN size USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) / n_shingles >= {THRESHOLD}
"""

ORACLE = {"op4_benchmark_items": OP4, "op7_url_rules": OP7}
