"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from keytide.llm import audit, decontaminate, divergence, mixing, quality
from keytide.llm.text import WORD


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _count(value: str, pattern: str) -> str:
    return f"len(regexp_extract_all({value}, {_quoted(pattern)}))"


MIXING = f"""
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS m, {_count("coalesce(text, '')", WORD)}::BIGINT AS size FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, m) AS ordinal FROM d),
k AS (SELECT *, md5(concat_ws(':', coalesce(doc_id::VARCHAR, chr(0)), m, ordinal::VARCHAR)) AS key FROM r),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, [{", ".join(map(str, mixing.WEIGHTS))}][rank % {len(mixing.WEIGHTS)} + 1] AS w, {mixing.MAX_REPEATS} * source_size AS cap FROM n),
b AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
        sum(cap) OVER (ORDER BY cap / w, rank ROWS UNBOUNDED PRECEDING) - cap AS caps_before,
        sum(w) OVER (ORDER BY cap / w, rank ROWS UNBOUNDED PRECEDING) - w AS w_before FROM w),
c AS (SELECT *, cap * (all_w - w_before) <= w * (total - caps_before) AS capped FROM b),
t AS (SELECT source, source_size, rank, total, CASE WHEN capped THEN cap::DOUBLE
        ELSE (w * (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)))::DOUBLE
             / nullif(all_w - coalesce(sum(CASE WHEN capped THEN w END) OVER (), 0), 0)::DOUBLE END AS target FROM c),
q AS (SELECT k.*, t.rank, t.source_size, t.target, t.total,
        sum(size) OVER (PARTITION BY t.rank ORDER BY key ROWS UNBOUNDED PRECEDING)::BIGINT AS done
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
u AS (SELECT q.*, turn, (done + turn * source_size)::DOUBLE / target AS finish FROM q, range({mixing.MAX_REPEATS}) x(turn)
      WHERE size > 0 AND done - size + turn * source_size < target),
v AS (SELECT key, rank, total, sum(size) OVER (ORDER BY finish, rank, key, turn ROWS UNBOUNDED PRECEDING) AS spent FROM u),
g AS (SELECT key, rank, count(*) AS times FROM v WHERE spent <= total GROUP BY key, rank)
SELECT doc_id, size, source_size, target, (coalesce(times, 0) * size)::BIGINT AS taken
FROM q LEFT JOIN g USING (key, rank)
"""

_PASSES = " AND ".join([
    f"regexp_matches(x, {_quoted(quality.SENTENCE_END)})",
    f"(NOT contains(x, '!!') OR {_count('x', quality.SHOUT)} * 3 < len(string_split(x, ' ')))",
    f"(NOT regexp_matches(x, '[|»›>•·]') OR {_count('x', quality.SEPARATOR)} * 5 < len(string_split(x, ' ')))",
    f"{_count('x', quality.SYMBOL)} * 4 < len(string_split(x, ' '))",
    f"(len(string_split(x, ' ')) > 4 OR NOT regexp_matches(x, {_quoted(quality.MENU)}))",
    *(f"NOT contains(x, {_quoted(phrase)})" for phrase in quality.BOILERPLATE),
])

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT *, regexp_extract_all(t, {_quoted(WORD)}) AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_quoted(WORD)})) AS lines FROM d),
f AS (SELECT *, list_distinct(lines) AS firsts, list_filter(list_distinct(lines), lambda x: {_PASSES}) AS good FROM l),
i AS (SELECT id, words, unnest(generate_series(1, len(words) - {quality.WINDOW - 1})) AS i FROM l WHERE len(words) > {quality.WINDOW}),
g AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, array_to_string(words[i:i + {quality.WINDOW - 1}], ' ')) AS c FROM i)
      WHERE c > 1),
r AS (SELECT id, count(DISTINCT p)::BIGINT AS n FROM (SELECT id, unnest(generate_series(i, i + {quality.WINDOW - 1})) AS p FROM g) GROUP BY id),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        {_count("t", quality.SYMBOL)}::BIGINT AS n_symbols, (len(lines) - len(firsts))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words,
        CASE WHEN len(good) = len(lines) THEN len(words) ELSE {_count("array_to_string(good, chr(10))", WORD)} END::BIGINT AS n_clean_words
      FROM f LEFT JOIN r USING (id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_clean_words <= n_words * {quality.MAX_LOSS} AS kept FROM b
"""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TESTS = {
    "A": f"len(ws) < {audit.MIN_WORDS}",
    "B": f"100 * len(list_distinct(ws)) < {audit.MIN_DISTINCT} * len(ws)",
    "C": f"100 * {_count('t', '[A-Z]')} > {audit.MAX_CAPITALS} * length(t)",
    "D": f"regexp_matches(t, '[{audit.SYMBOLS.decode()}]')",
    "E": "coalesce(doc_id > first_id, false)",
}

AUDIT = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {_quoted(WORD)}) AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false)::INT AS good, coalesce(bool_or(toxic = 1), false)::INT AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, {" + ".join(f"{1 << i} * ({test})::INT" for i, test in enumerate(_TESTS.values()))} AS mask,
        coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN l USING (doc_id)),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
b(x, bit) AS (VALUES {", ".join(f"('{x}', {1 << i})" for i, x in enumerate(_TESTS))}),
o AS (SELECT b1.x || b2.x || b3.x || b4.x || b5.x AS filter_order, [b1.bit, b2.bit, b3.bit, b4.bit, b5.bit] AS bits
      FROM b b1, b b2, b b3, b b4, b b5 WHERE b1.bit | b2.bit | b3.bit | b4.bit | b5.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) r(step)),
c AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM h, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM c
"""

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_W = decontaminate.WIDTH

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), {_quoted(_ITEM_WORD)}) AS ws
      FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), {_quoted(_ITEM_WORD)}) AS ws FROM benchmark),
k AS (SELECT *, least(len(ws), {_W}) AS k FROM i WHERE len(ws) > 0),
p AS (SELECT item_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS p FROM k),
x AS (SELECT DISTINCT item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS x FROM p),
dp AS (SELECT r, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM x) WHERE len(ws) >= k),
dx AS (SELECT r, k, p, array_to_string(ws[p:p + k - 1], ' ') AS x FROM dp),
hit AS (SELECT dx.* FROM dx SEMI JOIN x USING (k, x)),
n AS (SELECT r, count(DISTINCT w)::BIGINT AS n_hit FROM (SELECT r, unnest(generate_series(p, p + k - 1)) AS w FROM hit) GROUP BY r),
own AS (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hit JOIN x USING (k, x) WHERE item_id IS NOT NULL),
s AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM own GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def _share(count: str, n: str) -> str:
    return f"1 + {divergence.SCALE}::HUGEINT * ({count} + {divergence.PRIOR}) // ({n} + {divergence.PRIOR} * v)"


DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, {_LETTERS}), {_quoted(_TERM)})) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n_lang FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM o SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN c USING (lang, source) GROUP BY lang, source),
g AS (SELECT lang, source, term, coalesce(c, 0) AS c, {_share("coalesce(c, 0)", "n")} AS p, {_share("total", "n_lang")} AS q
      FROM n JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
      FROM g a JOIN g b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM g WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""
