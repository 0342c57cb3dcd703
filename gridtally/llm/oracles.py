"""DuckDB text of the registered queries that SQL can express."""

from __future__ import annotations

from gridtally.llm import quality_rules as rules

#: White space of the word rule, as a DuckDB string and a regular expression.
_WHITE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_STOPS = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
_TRAILING = rules.TRAILING.replace("'", "''")


def _broken(rule: rules.Rule) -> str:
    ratio = f"({rule.top}::DOUBLE / nullif({rule.bottom}, 0))"
    bad = [f"{ratio} < {rule.low}"] * (rule.low is not None) + [f"{ratio} > {rule.high}"] * (rule.high is not None)
    held = f"in_{rule.name} AND " if rule.langs else ""
    return f"CASE WHEN {held}({' OR '.join(bad)}) THEN '{rule.name}' END"


def _in_language(rule: rules.Rule) -> str:
    codes = ", ".join(f"'{c}'" for c in rule.langs)
    return f"CASE WHEN code NOT IN ('', 'und', 'unknown') THEN code IN ({codes}) ELSE mostly_latin END AS in_{rule.name}"


def quality_cte(table: str = "documents") -> str:
    """CTEs that end in ``judged``: doc_id, counts, verdict."""
    return f"""
qd AS (SELECT doc_id, coalesce(text, '') AS t, lower(regexp_extract(lang, '^\\s*([A-Za-z]+)', 1)) AS code FROM {table}),
ql AS (SELECT *, 2 * length(regexp_replace(t, '\\P{{Latin}}+', '', 'g')) >= length(regexp_replace(t, '\\P{{L}}+', '', 'g'))
  AS mostly_latin FROM qd),
qw AS (SELECT doc_id, t, {", ".join(_in_language(r) for r in rules.RULES if r.langs)},
  list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: length(translate(x, {_WHITE}, '')) > 0) AS ls FROM ql),
qi AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM qw WHERE len(ws) >= 3),
qg AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM qi),
qr AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM qg, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY doc_id),
counted AS (SELECT doc_id, {", ".join(f"in_{r.name}" for r in rules.RULES if r.langs)}, len(ws)::BIGINT AS n_words, length(translate(t, {_WHITE}, ''))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '{rules.SYMBOLS}', '')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(ws, lambda w: lower(rtrim(w, '{_TRAILING}')) IN ({_STOPS})))::BIGINT AS n_stop_words,
  len(list_filter(ws, lambda w: w = upper(w) AND w <> lower(w)))::BIGINT AS n_shouted_words,
  len(list_filter(ls, lambda x: regexp_matches(x, '^\\s*[-*•|]')))::BIGINT AS n_bullet_lines,
  len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$')))::BIGINT AS n_open_lines
  FROM qw LEFT JOIN qr USING (doc_id)),
flagged AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  concat_ws(',', {", ".join(_broken(r) for r in rules.RULES)}) AS broken_rules FROM counted),
judged AS (SELECT *, NOT base_failed AND broken_rules = '' AS kept FROM flagged)"""


QUALITY_RULES = f"""WITH {quality_cte()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, broken_rules FROM judged"""

DECONTAMINATION = """WITH iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
ig AS (SELECT DISTINCT item_id, least(5, len(w)) AS k, list_slice(w, i, i + least(5, len(w)) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
dg AS (SELECT DISTINCT doc_id, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM ig) WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_shingles FROM ig GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM dg JOIN ig USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM s JOIN n USING (item_id)
WHERE 5 * n_shared >= 4 * n_shingles"""

_BLANK = f"length(translate(x, {_WHITE}, '')) = 0"
#: Non-blank lines, shortest runs of 50 words that start or end at a line, their first copy, the rest deleted.
LINE_DEDUP = f"""WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS al FROM documents),
l AS (SELECT doc_id, al, list_filter(al, lambda x: NOT ({_BLANK})) AS ls FROM d),
c AS (SELECT *, list_transform(ls, lambda x: len(list_filter(string_split_regex(x, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS ws FROM l),
q AS (SELECT doc_id, ls, ws, unnest(range(1, len(ls) + 1)) AS i FROM c WHERE len(ls) > 0),
t AS (SELECT doc_id, i, ls[i] AS line, sum(ws[i]) OVER (PARTITION BY doc_id ORDER BY i) AS upto, ws[i] AS w FROM q),
r AS (SELECT a.doc_id, a.i AS f, min(b.i) AS e FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.i >= a.i
    AND b.upto - a.upto + a.w >= 50 GROUP BY a.doc_id, a.i
  UNION SELECT b.doc_id, max(a.i), b.i FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.i >= a.i
    AND b.upto - a.upto + a.w >= 50 GROUP BY b.doc_id, b.i),
n AS (SELECT r.doc_id, f, e, list_slice(ls, f, e) AS run FROM r JOIN l USING (doc_id)),
m AS (SELECT *, first_value(doc_id) OVER w AS fd, first_value(f) OVER w AS ff FROM n
  WINDOW w AS (PARTITION BY run ORDER BY doc_id, f)),
x AS (SELECT DISTINCT doc_id, unnest(range(f, e + 1)) AS i FROM m WHERE doc_id <> fd OR f > ff + (e - f)),
g AS (SELECT doc_id, list(i) AS gone FROM x GROUP BY doc_id),
p AS (SELECT doc_id, al, coalesce(gone, []) AS gone, list_transform(range(1, len(al) + 1), lambda k:
  len(list_filter(list_slice(al, 1, k), lambda x: NOT ({_BLANK})))) AS place FROM l LEFT JOIN g USING (doc_id) WHERE al IS NOT NULL),
k AS (SELECT doc_id, al, gone, list_filter(range(1, len(al) + 1), lambda k: NOT list_contains(gone, place[k])) AS kept FROM p)
SELECT d.doc_id, coalesce(len(k.al), 0)::BIGINT AS n_lines, coalesce(len(k.al) - len(kept), 0)::BIGINT AS n_removed,
  coalesce(len(list_filter(gone, lambda i: NOT list_contains(gone, i - 1))), 0)::BIGINT AS n_runs,
  sha256(coalesce(array_to_string(list_transform(kept, lambda i: k.al[i]), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""

#: Counts over all documents, impacts in whole numbers, and the 20 best of every item.
LEXICAL_SEARCH = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
n AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
t AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
i AS (SELECT item_id, text, term, count(*)::BIGINT AS times FROM (SELECT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM t, c GROUP BY term, docs),
s AS (SELECT item_id, text, r, doc_id, sum(times * w *
    ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN w USING (term) JOIN n USING (r), c GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM (SELECT item_id, text, r, doc_id, score FROM s WHERE score > 0))
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 20"""
