"""DuckDB texts of the queries that SQL can express: line cleaning, URL
rules and ranked search.  The other operators train models, tokenize or hash in ways that SQL
lacks; tests hold them against brute force."""

from __future__ import annotations

import re

from retail_insights.llm import quality_lines as q
from retail_insights.llm import ranked_search
from retail_insights.llm import url_rules as u


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(tests: list[str]) -> str:
    return "(" + " OR ".join(tests) + ")"


def _quality() -> str:
    ws = "[\\x20\\x09-\\x0D]"
    ended = _any([f"ends_with(line, {_text(e)})" if "\r" not in e else f"ends_with(line, {_text(e[:-1])} || chr(13))"
                  for e in q.ENDINGS])

    ended = _any([ended, *[f"contains(line, {_text(e)})" for e in q.INNER_STOPS]])

    def count(chars: str) -> str:
        return f"(length(line) - length(regexp_replace(line, {_text(chars)}, '', 'g')))"

    symbols, separators = count(q.SYMBOL_CLASS), count(q.SEPARATOR_CLASS)
    menu = ", ".join(map(_text, q.MENU_LINES))
    fails = _any([
        f"(NOT {ended} AND len(string_split_regex(trim(line, ' '), '{ws}+')) >= {q.MIN_UNENDED_WORDS})",
        f"length(line) - length(replace(line, '!!', '')) >= {2 * q.MIN_SHOUTS}",
        f"({symbols} >= {q.MIN_LINE_SYMBOLS} AND {symbols} * {q.SYMBOL_PER} >= length(line))",
        f"({separators} >= {q.MIN_SEPARATORS} AND {separators} * {q.SEPARATOR_PER} >= length(line))",
        f"(length(line) <= {q.MAX_MENU_LINE} AND "
        f"trim(lower(line), ' ' || chr(9) || chr(13) || '.:>') IN ({menu}))",
        *[f"contains(lower(line), {_text(p)})" for p in q.BOILERPLATE]])
    return f"""
WITH numbered AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT r, list_filter(string_split_regex(text, '{ws}+'), lambda x: x <> '') AS w FROM numbered),
spots AS (
  SELECT r, list_slice(w, i, i + {q.WINDOW - 1}) AS five, i
  FROM (SELECT r, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM worded WHERE len(w) >= {q.WINDOW})),
again AS (SELECT r, five FROM spots GROUP BY r, five HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM spots JOIN again USING (r, five), range(0, {q.WINDOW}) AS t(k) GROUP BY r),
lines AS (
  SELECT r, line, {fails} AS bad, length(regexp_replace(line, '{ws}', '', 'g')) AS chars
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM numbered)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
by_doc AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (bad) AS n_bad_lines, coalesce(sum(chars) FILTER (bad), 0) AS bad_chars
  FROM lines GROUP BY r),
base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, {_text(q.SYMBOL_CLASS)}, '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_bad_lines, 0) AS n_bad_lines,
         CAST(coalesce(bad_chars, 0) AS BIGINT) AS bad_chars
  FROM numbered JOIN worded USING (r) LEFT JOIN covered USING (r) LEFT JOIN by_doc USING (r)),
judged AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND (word_chars - bad_chars) * 100 >= word_chars * {q.MIN_KEPT_PCT} AS kept FROM judged
"""


def _regex(pattern: str) -> str:
    out = re.sub(r"([.+?()\[\]{}$\\])", r"\\\1", pattern).replace("*", ".*")
    out = out.replace("^", "\x00").replace("\x00", "(?:[^a-z0-9_.%-]|[.-]|^|$)")
    out = "^" + out[1:] if out.startswith("|") else out
    return "(?s)" + (out[:-1] + "$" if out.endswith("|") else out)


def _urls() -> str:
    hosts = ", ".join(f"({_text(h)}, {_text(p)}, {_text(a)})" for h, p, a in u.HOST_RULES)
    patterns = ", ".join(f"({_text(p)}, {_text(a)}, {_text(_regex(p))})" for p, a in u.PATTERN_RULES)
    return f"""
WITH parsed AS (
  SELECT page_id, url, translate(url, '{u.UPPER}', '{u.LOWER}') AS low,
         translate(regexp_extract(coalesce(url, ''), '^(?s).*?://([^/?#]*)', 1), '{u.UPPER}', '{u.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '^(?s).*?://[^/?#]*([^?#]*)', 1) AS path,
         row_number() OVER () AS r
  FROM pages),
host_hits AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM parsed, (VALUES {hosts}) AS t(h, p, action)
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r),
pattern_hits AS (
  SELECT r, min(action || ' ' || pattern) AS hit
  FROM parsed, (VALUES {patterns}) AS t(pattern, action, regex)
  WHERE regexp_matches(low, regex) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(action, split_part(hit, ' ', 1), 'allow') AS verdict,
       CASE WHEN rule IS NULL THEN substr(hit, instr(hit, ' ') + 1) END AS pattern
FROM parsed LEFT JOIN host_hits USING (r) LEFT JOIN pattern_hits USING (r)
"""


def _ranked() -> str:
    terms = f"regexp_extract_all(translate(text, '{u.UPPER}', '{u.LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({terms}, []) AS terms FROM documents),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs),
tf AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term),
items AS (
  SELECT DISTINCT item_id, text, unnest(list_distinct({terms})) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
scored AS (
  SELECT item_id, text, r, any_value(doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY item_id, text, r),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {ranked_search.TOP}
"""


ORACLE_SQL = {"op1_quality_rules": _quality(), "op5_url_filters": _urls(), "op12_ranked_search": _ranked()}
