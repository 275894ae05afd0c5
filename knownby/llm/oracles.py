"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

_OP2 = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""

_LEVELS = ["domain", "lang", "source"]


def _op3_level(name: str, path: list[str], weight: str, parent: str) -> str:
    """One level of the budget tree: children share their parent's amount, full ones give back."""
    up = path[:-1]
    over = f"PARTITION BY {', '.join(up)}" if up else ""
    ahead = f"OVER ({over} ORDER BY CAST(cap AS DOUBLE) / w, cap, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    join = f"JOIN {parent} USING ({', '.join(up)})" if up else f"CROSS JOIN {parent}"
    return f"""
{name}_n AS (SELECT {', '.join(path)}, CAST(sum(n_tokens) AS HUGEINT) * 2 AS cap, CAST({weight} AS HUGEINT) AS w FROM t GROUP BY ALL),
{name}_o AS (SELECT *, coalesce(sum(cap) {ahead}, 0) AS cap_before, sum(w) OVER ({over}) - coalesce(sum(w) {ahead}, 0) AS w_left
  FROM {name}_n {join}),
{name}_f AS (SELECT *, cap * w_left <= w * (amount - cap_before) AS is_full FROM {name}_o),
{name}_s AS (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({over}) AS cap_full,
  sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({over}) AS w_open FROM {name}_f),
{name} AS (SELECT {', '.join(path)}, CASE WHEN is_full THEN cap ELSE (w * (amount - cap_full)) // w_open END AS amount FROM {name}_s)"""


_OP3 = r"""
WITH a AS (
  SELECT doc_id, source, lang, trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s,
    regexp_extract(coalesce(source, ''), '^src([0-9]+)$', 1) AS num FROM documents
), t AS (
  SELECT doc_id, CASE WHEN num = '' THEN '(none)' WHEN CAST(num AS INT) % 3 = 0 THEN 'web' WHEN CAST(num AS INT) % 3 = 1 THEN 'books' ELSE 'code' END AS domain,
    coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    CASE WHEN s = '' THEN 0 ELSE len(string_split(s, ' ')) END AS n_tokens
  FROM a
), root AS (SELECT CAST(coalesce(sum(n_tokens), 0) AS HUGEINT) * 80 // 100 AS amount FROM t),""" + ",".join([
    _op3_level("l1", _LEVELS[:1], "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END", "root"),
    _op3_level("l2", _LEVELS[:2], "CASE WHEN domain = '(none)' THEN 1 WHEN lang = 'en' THEN 4 WHEN lang = 'de' THEN 3 WHEN lang = 'fr' THEN 2 ELSE 1 END", "l1"),
    _op3_level("l3", _LEVELS, "1", "l2")]) + r""",
p AS (
  SELECT domain, lang, source, CAST(amount AS BIGINT) AS budget, CASE WHEN tokens > 0 THEN CAST(amount // tokens AS BIGINT) ELSE 0 END AS epochs, tokens
  FROM l3 JOIN (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM t GROUP BY ALL) USING (domain, lang, source)
), q AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5(concat_ws('-', 'mix-1', epochs, coalesce(CAST(doc_id AS VARCHAR), ''))), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto
  FROM t JOIN p USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, budget,
  epochs + CASE WHEN upto <= budget - epochs * tokens THEN 1 ELSE 0 END AS copies FROM q
"""

_OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links), reach AS (
  SELECT a AS node, a AS other FROM both_ways UNION SELECT node, b FROM reach JOIN both_ways ON other = a
), low AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.component, w.doc_id) AS component_id,
  coalesce(low.component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN low ON low.node = w.doc_id
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP11 = r"""
WITH dt AS (SELECT doc_id, unnest(""" + _TERMS + r""") AS term FROM documents WHERE doc_id IS NOT NULL),
dn AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
st AS (SELECT count(*) AS nd, sum(n) AS tl FROM dn),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, st),
it AS (SELECT DISTINCT item_id, unnest(""" + _TERMS + r""") AS term FROM benchmark WHERE item_id IS NOT NULL),
sc AS (
  SELECT it.item_id, tf.doc_id,
    CAST(sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * dn.n * st.nd) // st.tl)))) AS BIGINT) AS score
  FROM it JOIN tf USING (term) JOIN wt USING (term) JOIN dn USING (doc_id), st GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0
) WHERE rank <= 10
"""

_OP12 = r"""
WITH a AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
b AS (
  SELECT rid, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS wl FROM a
),
c AS (
  SELECT *, CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    ELSE [] END AS g FROM b
),
win AS (SELECT rid, unnest(range(len(g))) AS p, unnest(g) AS gram FROM c),
rep AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, gram) AS k FROM win) WHERE k >= 2),
cov AS (SELECT rid, count(DISTINCT p + o) AS n_repeat_words FROM rep, (VALUES (0), (1), (2)) v(o) GROUP BY rid),
m AS (
  SELECT c.rid, doc_id, w, wl, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(wl) - len(list_distinct(wl)) AS BIGINT) AS n_dup_lines, len(wl) AS n_lines,
    CAST(coalesce(cov.n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM c LEFT JOIN cov ON cov.rid = c.rid
),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR n_symbols * 10 > n_words
    OR n_dup_lines * 10 > n_lines * 3
    OR CAST(len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) AS DOUBLE) / greatest(n_words, 1) > 0.2
    OR CAST(len(list_filter(wl, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) AS DOUBLE) / greatest(n_lines, 1) > 0.3
    OR CAST(len(list_filter(wl, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•]'))) AS DOUBLE) / greatest(n_lines, 1) > 0.9) AS kept
FROM f
"""

ORACLES = {"op2_exact_dedup": _OP2, "op3_mixing": _OP3, "op6_near_dedup": _OP6, "op11_search": _OP11, "op12_quality_rules": _OP12}
